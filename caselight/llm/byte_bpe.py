"""Byte-level BPE: encoding by the tokenizers library over Arrow batches, and decoding by the byte table.

A byte-level vocabulary writes each byte as one printable character (``byte_characters``). A text is cut into
pieces by a pattern, each piece is written in those characters, and the library's BPE model merges it. Pieces
repeat, so a task keeps the ids of the pieces it has met; the memory holds at most ``MEMORY`` entries.

Cutting whole texts is cheap because a text may be cut before a single space or line feed that stands between two
other characters that are no white space: the pattern never matches across such a place, and what follows does not
depend on what stands before. The words between such spaces are looked up whole and taken apart when new.

Results for odd input: a null text counts as empty and has no ids; ids decode to bytes, and a character whose bytes
lie in two tokens is put together before it is decoded. Columns other than the two named ones are left out.
"""

from __future__ import annotations

import hashlib
import json
import re
from struct import pack

import numpy as np
from pyspark.sql import DataFrame

from caselight.llm.common import map_rows

MEMORY = 1_000_000  # entries of some 200 bytes
LONG_PIECE = 64
_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else one from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    shifted = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(shifted)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank on each line."""
    import base64

    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _parts(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes]:
    """The two tokens whose merge makes ``token``: merge by lower ranks until two are left."""
    parts = [token[i : i + 1] for i in range(len(token))]
    limit = ranks[token]
    while len(parts) > 2:
        options = [(ranks.get(a + b, limit), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, at = min(options)
        if rank >= limit:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else (b"", b"")


def model_from_ranks(ranks: dict[bytes, int]) -> str:
    """The vocabulary as a model of the tokenizers library, in its JSON form.

    A whole piece that is a token is taken as it is (``ignore_merges``); so does the rank format.
    """
    write = byte_characters()
    spell = {token: "".join(write[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        if len(token) > 1:
            left, right = _parts(token, ranks)
            if left:
                merges.append([spell[left], spell[right]])
    model = {
        "type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": None,
        "fuse_unk": False, "byte_fallback": False, "ignore_merges": True,
        "vocab": {spell[t]: r for t, r in ranks.items()}, "merges": merges,
    }
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [], "normalizer": None,
        "pre_tokenizer": None, "post_processor": None, "decoder": None, "model": model,
    })


class ByteBPE:
    """Encoder and decoder of one vocabulary; strings of special tokens in a text are ordinary text."""

    def __init__(self, tokenizer_json: str, pattern: str):
        import regex
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_str(tokenizer_json).model
        self.vocab = json.loads(tokenizer_json)["model"]["vocab"]
        self.find = regex.compile(pattern).findall
        characters = byte_characters()
        self._spell = {b: c for b, c in enumerate(characters)}
        self._space = characters[ord(" ")]
        self._byte = {c: b for b, c in enumerate(characters)}
        self._pieces: dict[str, bytes] = {}
        self._words: dict[str, bytes] = {}
        self._table: list[bytes] | None = None

    def _piece(self, piece: str) -> bytes:
        """Ids of one match of the pattern."""
        ids = self._pieces.get(piece)
        if ids is None:
            ids = self._merge(piece)
            if len(piece) <= LONG_PIECE:
                if len(self._pieces) >= MEMORY:
                    self._pieces.clear()
                self._pieces[piece] = ids
        return ids

    def _merge(self, piece: str) -> bytes:
        return self._ids(piece.encode("utf-8").decode("latin-1").translate(self._spell))

    def _ids(self, spelled: str) -> bytes:
        ids = [t.id for t in self.model.tokenize(spelled)]
        return pack(f"<{len(ids)}I", *ids)

    def _after_space(self, word: str) -> bytes | None:
        """Ids of a space and ``word``; None if the text must not be cut around ``word``."""
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        if word.isalpha():  # letters are one match, with the space before them
            ids = self._merge(" " + word) if not word.isascii() else self._ids(self._space + word)
        elif word[:-1].isalpha() and word[-1] in ".,":
            ids = (self._words.get(word[:-1]) or self._merge(" " + word[:-1])) + self._piece(word[-1])
        else:
            ids = b"".join([self._piece(p) for p in self.find(" " + word)])
        if len(word) <= LONG_PIECE:
            if len(self._words) >= MEMORY:
                self._words.clear()
            self._words[word] = ids
        return ids

    def encode(self, text: str | None) -> bytes:
        """The ids of the whole text, as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        first, *words = text.split(" ")
        ids = [self._words.get(w) or self._after_space(w) for w in words]
        if None in ids or first[-1:].isspace() or not first:
            return b"".join([self._piece(p) for bit in _CUT.split(text) for p in self.find(bit)])
        return b"".join([self._piece(p) for p in self.find(first)] + ids)

    def token_bytes(self) -> list[bytes]:
        """The bytes of each id, by the byte table."""
        if self._table is None:
            self._table = [b""] * (max(self.vocab.values(), default=-1) + 1)
            for spelled, i in self.vocab.items():
                if all(c in self._byte for c in spelled):
                    self._table[i] = bytes(self._byte[c] for c in spelled)
        return self._table

    def decode_bytes(self, ids: bytes) -> bytes:
        table = self.token_bytes()
        return b"".join([table[i] for i in np.frombuffer(ids, dtype="<u4").tolist()])

    def decode(self, ids: bytes) -> str:
        """The text; bytes that are no UTF-8 (a cut sequence of ids) become U+FFFD."""
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def offsets(self, text: str, ids: bytes) -> list[tuple[int, int]]:
        """Per token, the characters of the text it has a part in; a split character belongs to all its tokens."""
        table, raw = self.token_bytes(), np.frombuffer(text.encode("utf-8"), dtype=np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        ends = np.cumsum([len(table[i]) for i in np.frombuffer(ids, dtype="<u4").tolist()])
        starts = np.concatenate([[0], ends[:-1]]).astype(int)
        return [(int(character[a]), int(character[b - 1]) + 1) for a, b in zip(starts, ends)]


def send_bpe(df: DataFrame, tokenizer_json: str, pattern: str):
    """A vocabulary for the tasks; as large as its file. Use ``task_bpe`` on its value there."""
    return df.sparkSession.sparkContext.broadcast({"json": tokenizer_json, "pattern": pattern})


def task_bpe(sent: dict) -> ByteBPE:
    """The encoder, made once per worker: a broadcast value stays with the worker, and so do the words it has met."""
    if "bpe" not in sent:
        sent["bpe"] = ByteBPE(sent["json"], sent["pattern"])
    return sent["bpe"]


def encode_texts(
    df: DataFrame, tokenizer_json: str, pattern: str, key: str = "doc_id", text: str = "text", with_offsets: bool = False
) -> DataFrame:
    """(key, ids binary, n_tokens[, starts, ends]): ids of each whole text; offsets in code points where asked for."""
    sent, kind = send_bpe(df, tokenizer_json, pattern), dict(df.dtypes)[key]
    extra = ", starts array<int>, ends array<int>" if with_offsets else ""

    def make():
        bpe = task_bpe(sent.value)

        def work(batch):
            texts = batch.column(1).to_pylist()
            ids = [bpe.encode(t) for t in texts]
            out = {"key": batch.column(0), "ids": ids, "n_tokens": [len(i) // 4 for i in ids]}
            if with_offsets:
                spans = [bpe.offsets(t or "", i) if i else [] for t, i in zip(texts, ids)]
                out |= {"starts": [[a for a, _ in s] for s in spans], "ends": [[b for _, b in s] for s in spans]}
            return out

        return work

    rows = map_rows(df.select(key, text), f"key {kind}, ids binary, n_tokens bigint{extra}", make)
    return rows.withColumnRenamed("key", key)


def decode_ids(df: DataFrame, tokenizer_json: str, pattern: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, raw binary, text): bytes and text of each row of ids; null ids count as none."""
    sent, kind = send_bpe(df, tokenizer_json, pattern), dict(df.dtypes)[key]

    def make():
        bpe = task_bpe(sent.value)

        def work(batch):
            raw = [bpe.decode_bytes(i or b"") for i in batch.column(1).to_pylist()]
            return {"key": batch.column(0), "raw": raw, "text": [r.decode("utf-8", "replace") for r in raw]}

        return work

    return map_rows(df.select(key, ids), f"key {kind}, raw binary, text string", make).withColumnRenamed("key", key)


def round_trip_digests(df: DataFrame, tokenizer_json: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode each whole text, decode the ids, and hash both.

    Done in one pass so that ids need not leave the task.
    """
    sent, kind = send_bpe(df, tokenizer_json, pattern), dict(df.dtypes)[key]

    def make():
        bpe = task_bpe(sent.value)
        written = [str(i) for i in range(len(bpe.token_bytes()))]

        def work(batch):
            out = {"key": batch.column(0), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for t in batch.column(1).to_pylist():
                ids = bpe.encode(t)
                numbers = np.frombuffer(ids, dtype="<u4").tolist()
                out["n_tokens"].append(len(numbers))
                out["ids_sha256"].append(hashlib.sha256(",".join([written[i] for i in numbers]).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(bpe.decode_bytes(ids)).hexdigest())
            return out

        return work

    schema = f"key {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return map_rows(df.select(key, text), schema, make).withColumnRenamed("key", key)
