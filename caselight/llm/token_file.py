"""Token files of shuffled planes, written and read in parallel.

A file holds the ids of consecutive documents:

    "TPL1" | chunks | document table | footer (JSON) | length of the footer (4 bytes) | "TPL1"

A chunk is a block of ``block`` ids (the last may be shorter) taken apart into planes: with ``byte`` planes all first
bytes, then all second bytes and so on; with ``bit`` planes all lowest bits, and so on. Each plane is compressed by
zstandard on its own; planes of zeros take no room. The footer has the chunk index (place of each chunk, sizes of its
planes, number of ids), so any range of ids is read by touching its chunks only. The document table has ids and lengths.

Rows are range-sorted by key, one file per range, so the files in order hold the documents in order. A task writes under a
name of its own and its row in the manifest counts only if the task ended, so retried tasks and lost executors leave
nothing wrong behind.

Defined results: a null text is an empty one (only the end id); null keys come first; repeated keys keep one entry each;
an empty table gives a manifest without rows; other columns are left out.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caselight.llm.byte_bpe import send_bpe, task_bpe
from caselight.llm.common import map_rows, stored
from caselight.session import scratch_path

MAGIC = b"TPL1"
BLOCK = 1 << 16
ROWS_AT_ONCE = 8192


def open_path(path: str, mode: str):
    """A stream to a path or URI that the executors share."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    if mode == "w":
        system.create_dir(name.rsplit("/", 1)[0], recursive=True)
        return system.open_output_stream(name)
    return system.open_input_file(name)


def shuffle(ids: np.ndarray, planes: str) -> list[bytes]:
    """The planes of a block, lowest first."""
    raw = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return [raw[:, i].tobytes() for i in range(4)]
    bits = np.unpackbits(raw, axis=1, bitorder="little")
    return [np.packbits(bits[:, i]).tobytes() for i in range(32)]


def unshuffle(planes: list[bytes | None], kind: str, n: int) -> np.ndarray:
    if kind == "byte":
        raw = np.zeros((n, 4), dtype=np.uint8)
        for i, plane in enumerate(planes):
            if plane is not None:
                raw[:, i] = np.frombuffer(plane, dtype=np.uint8)
        return raw.view("<u4").reshape(-1)
    bits = np.zeros((n, 32), dtype=np.uint8)
    for i, plane in enumerate(planes):
        if plane is not None:
            bits[:, i] = np.unpackbits(np.frombuffer(plane, dtype=np.uint8), count=n)
    return np.packbits(bits, axis=1, bitorder="little").view("<u4").reshape(-1)


class Writer:
    """Takes documents one after the other; holds one block at a time."""

    def __init__(self, out, planes: str = "byte", block: int = BLOCK, level: int = 3):
        import zstandard

        self.out, self.planes, self.block, self.zstd = out, planes, block, zstandard.ZstdCompressor(level=level)
        self.at, self.index, self.keys, self.lengths, self.n_ids = len(MAGIC), [], [], [], 0
        self.waiting: list[bytes] = []
        self.n_waiting = 0
        out.write(MAGIC)

    def add(self, key: int | None, ids: bytes) -> None:
        self.keys.append(key)
        self.lengths.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.waiting.append(ids)
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= self.block:
            self._flush(False)

    def _flush(self, everything: bool) -> None:
        ids = np.frombuffer(b"".join(self.waiting), dtype="<u4")
        cut = len(ids) if everything else len(ids) // self.block * self.block
        for start in range(0, cut, self.block):
            part = ids[start : min(start + self.block, cut)]
            packed = [self.zstd.compress(p) if any(p) else b"" for p in shuffle(part, self.planes)]
            self.index.append([self.at, len(part), [len(p) for p in packed]])
            self.out.write(b"".join(packed))
            self.at += sum(map(len, packed))
        self.waiting, self.n_waiting = [ids[cut:].tobytes()], len(ids) - cut

    def close(self) -> None:
        self._flush(True)
        known = np.array([k is not None for k in self.keys], dtype=np.uint8)
        keys = np.array([k or 0 for k in self.keys], dtype="<i8")
        columns = [known, keys, np.array(self.lengths, dtype="<u8")]
        packed = [self.zstd.compress(c.tobytes()) for c in columns]
        self.out.write(b"".join(packed))
        footer = {
            "planes": self.planes, "block": self.block, "ids": self.n_ids, "documents": len(self.keys),
            "chunks": self.index, "table": [self.at, [len(p) for p in packed]],
        }
        footer = json.dumps(footer, separators=(",", ":")).encode()
        self.out.write(footer + struct.pack("<I", len(footer)) + MAGIC)
        self.out.close()


class Reader:
    def __init__(self, source):
        import zstandard

        self.source, self.zstd = source, zstandard.ZstdDecompressor()
        size = source.size()
        source.seek(size - 8)
        tail = source.read(8)
        if tail[4:] != MAGIC:
            raise ValueError("no token file")
        length = struct.unpack("<I", tail[:4])[0]
        source.seek(size - 8 - length)
        self.footer = json.loads(source.read(length))

    def documents(self) -> list[tuple[int | None, int]]:
        """(key, number of ids) in file order."""
        at, sizes = self.footer["table"]
        self.source.seek(at)
        known, keys, lengths = [self.zstd.decompress(self.source.read(s)) for s in sizes]
        known = np.frombuffer(known, dtype=np.uint8).tolist()
        keys, lengths = np.frombuffer(keys, dtype="<i8").tolist(), np.frombuffer(lengths, dtype="<u8").tolist()
        return [(k if is_known else None, n) for is_known, k, n in zip(known, keys, lengths)]

    def chunk(self, number: int) -> np.ndarray:
        at, n, sizes = self.footer["chunks"][number]
        self.source.seek(at)
        planes = [self.zstd.decompress(self.source.read(s)) if s else None for s in sizes]
        return unshuffle(planes, self.footer["planes"], n)

    def ids(self, start: int, count: int) -> np.ndarray:
        """Any range of ids, by the chunk index."""
        end, block = min(start + count, self.footer["ids"]), self.footer["block"]
        if end <= start:
            return np.empty(0, dtype="<u4")
        numbers = range(start // block, (end - 1) // block + 1)
        whole = np.concatenate([self.chunk(i) for i in numbers])
        return whole[start - numbers[0] * block : end - numbers[0] * block]

    def each(self) -> Iterator[tuple[int | None, int, int, int]]:
        """(key, start, number of ids, crc32 of the ids) of each document, one chunk in memory at a time."""
        number, chunk, used, start = -1, np.empty(0, dtype="<u4"), 0, 0
        for key, length in self.documents():
            crc, left = 0, length
            while left:
                if used == len(chunk):
                    number, used = number + 1, 0
                    chunk = self.chunk(number)
                part = chunk[used : used + left]
                crc, used, left = zlib.crc32(part.tobytes(), crc), used + len(part), left - len(part)
            yield key, start, length, crc
            start += length


def write_token_files(
    df: DataFrame, tokenizer_json: str, pattern: str, folder: str | None = None, end_id: int = 0,
    key: str = "doc_id", text: str = "text", planes: str = "byte", block: int = BLOCK,
) -> DataFrame:
    """Write the files and return the manifest (part, path, documents, ids), itself stored beside them."""
    spark = df.sparkSession
    folder = folder or scratch_path(spark, "tokens")
    sent = send_bpe(df, tokenizer_json, pattern)
    end = np.array([end_id], dtype="<u4").tobytes()
    rows = df.select(F.col(key).cast("bigint"), text).repartitionByRange(F.asc_nulls_first(key)).sortWithinPartitions(key)

    def write(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        batches = iter(batches)
        batch = next((b for b in batches if b.num_rows), None)
        if batch is None:
            return
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.tpl"
        bpe, writer = task_bpe(sent.value), Writer(open_path(path, "w"), planes, block)
        while batch is not None:
            for k, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                writer.add(k, bpe.encode(t) + end)
            batch = next(batches, None)
        writer.close()
        names = ["part", "path", "documents", "ids"]
        values = [[part], [path], [len(writer.keys)], [writer.n_ids]]
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], names=names)

    return stored(rows.mapInArrow(write, "part bigint, path string, documents bigint, ids bigint"), "manifest")


def read_token_files(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files; ``start`` counts over all files."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per file
    placed = manifest.withColumn("base", F.coalesce(F.sum("ids").over(earlier), F.lit(0))).select("path", "base")

    def make():
        def work(batch):
            for path, base in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with open_path(path, "r") as source:
                    documents = Reader(source).each()
                    while part := list(islice(documents, ROWS_AT_ONCE)):
                        keys, starts, lengths, sums = zip(*part)
                        yield {"doc_id": keys, "start": [base + s for s in starts], "n_tokens": lengths, "ids_crc32": sums}

        return work

    spread = placed.repartition(max(1, manifest.count()))
    return map_rows(spread, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint", make)


def read_range(spark: SparkSession, manifest: DataFrame, start: int, count: int) -> list[int]:
    """The ids from ``start`` on, over file borders; meant for looking at a few of them."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("ids").over(earlier), F.lit(0)))
    wanted = placed.filter((F.col("base") < start + count) & (F.col("base") + F.col("ids") > start)).orderBy("part")
    found: list[int] = []
    for row in wanted.collect():  # the files that the asked range touches
        with open_path(row.path, "r") as source:
            first = max(0, start - row.base)
            found += Reader(source).ids(first, min(row.ids, start + count - row.base) - first).tolist()
    return found
