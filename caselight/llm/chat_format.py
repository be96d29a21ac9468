"""Chat records of many layouts to canonical turns, and turns to one training text with a loss mask. Built-in functions only.

``turns_of_json``: which known nested paths a JSON record holds is hashed to a fingerprint; each fingerprint selects one of
the declarative ``LAYOUTS``, and the layout says which paths become which turns. A record that holds more known paths
than any layout takes the layout that uses most of them. ``turns_of_table`` does the same with the columns of a table,
once for the whole table.

``format_chats`` writes ``<|im_start|>role\\ntext<|im_end|>\\n`` per turn. Inside roles and texts every ``<|`` (and every
``<\\|``, ``<\\\\|`` ...) gets one more backslash, so no control string can occur there and taking one backslash away gives
the text back. In roles, ``%`` and line feeds are written as %25 and %0A. The mask is (piece, start, length): characters of
the piece of each assistant turn.

Defined results: null texts and roles are empty; turns with the same number are ordered by role and text; a null
conversation id is one conversation; a JSON record that does not parse or fits no layout has no turns and a null layout;
fields outside the layouts are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

START, END = "<|im_start|>", "<|im_end|>"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``paths`` a record must hold; ``turns``: (role, paths joined by a blank line) or ("*", list path, role, text)."""

    name: str
    paths: tuple[str, ...]
    turns: tuple[tuple[str, ...], ...]


LAYOUTS = (
    Layout("messages", ("messages[].content", "messages[].role"), (("*", "messages", "role", "content"),)),
    Layout(
        "system and messages", ("messages[].content", "messages[].role", "system"),
        (("system", "system"), ("*", "messages", "role", "content")),
    ),
    Layout("conversations", ("conversations[].from", "conversations[].value"), (("*", "conversations", "from", "value"),)),
    Layout(
        "system and conversations", ("conversations[].from", "conversations[].value", "system"),
        (("system", "system"), ("*", "conversations", "from", "value")),
    ),
    Layout("turns", ("turns[].role", "turns[].text"), (("*", "turns", "role", "text"),)),
    Layout("prompt and response", ("prompt", "response"), (("user", "prompt"), ("assistant", "response"))),
    Layout("prompt and completion", ("completion", "prompt"), (("user", "prompt"), ("assistant", "completion"))),
    Layout("system, prompt and response", ("prompt", "response", "system"), (("system", "system"), ("user", "prompt"), ("assistant", "response"))),
    Layout("question and answer", ("answer", "question"), (("user", "question"), ("assistant", "answer"))),
    Layout("instruction", ("instruction", "output"), (("user", "instruction"), ("assistant", "output"))),
    Layout("instruction and input", ("input", "instruction", "output"), (("user", "instruction", "input"), ("assistant", "output"))),
    Layout(
        "system, instruction and input", ("input", "instruction", "output", "system"),
        (("system", "system"), ("user", "instruction", "input"), ("assistant", "output")),
    ),
    Layout("turn rows", ("conv_id", "role", "text", "turn"), ()),
)
KNOWN_PATHS = tuple(sorted({p for layout in LAYOUTS for p in layout.paths}))
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fingerprint(paths: list[str] | tuple[str, ...]) -> str:
    """Hash of the known paths that are there, in order."""
    import hashlib

    return hashlib.md5("\n".join(p for p in KNOWN_PATHS if p in set(paths)).encode()).hexdigest()


BY_FINGERPRINT = {fingerprint(layout.paths): layout for layout in LAYOUTS}
WIDEST_FIRST = sorted(LAYOUTS, key=lambda layout: -len(layout.paths))


def layout_of(paths: list[str]) -> Layout | None:
    """By fingerprint, else the widest layout that the paths cover."""
    covered = (layout for layout in WIDEST_FIRST if set(layout.paths) <= set(paths))
    return BY_FINGERPRINT.get(fingerprint(paths)) or next(covered, None)


def schema_paths(kind: DataType, prefix: str = "") -> list[str]:
    """The nested field paths of a schema; list elements are written ``[]``."""
    if isinstance(kind, StructType):
        return [p for f in kind.fields for p in schema_paths(f.dataType, f"{prefix}.{f.name}" if prefix else f.name)]
    if isinstance(kind, ArrayType):
        return schema_paths(kind.elementType, f"{prefix}[]")
    return [prefix]


def _has(record: Column, path: str) -> Column:
    if "[]." not in path:
        return F.try_variant_get(record, f"$.{path}", "variant").isNotNull()
    items, name = path.split("[].")
    listed = F.try_variant_get(record, f"$.{items}", "array<variant>")
    return F.coalesce(F.exists(listed, lambda v: F.try_variant_get(v, f"$.{name}", "variant").isNotNull()), F.lit(False))


def held_paths(record: Column) -> Column:
    """The known paths that a variant holds, in order."""
    return F.array_compact(F.array(*[F.when(_has(record, p), F.lit(p)) for p in KNOWN_PATHS]))


def layout_name(held: Column) -> Column:
    """By the fingerprint of the held paths, else the widest layout they cover, else null."""
    by_print = F.create_map(*[F.lit(x) for mark, layout in BY_FINGERPRINT.items() for x in (mark, layout.name)])
    covered = F.lit(None).cast("string")
    for layout in reversed(WIDEST_FIRST):
        covered = F.when(F.size(F.array_except(F.array(*map(F.lit, layout.paths)), held)) == 0, layout.name).otherwise(covered)
    return F.coalesce(F.try_element_at(by_print, F.md5(F.array_join(held, "\n"))), covered)


def _turn(role: Column, text: Column) -> Column:
    return F.struct(F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text"))


def _role(raw: Column) -> Column:
    named = F.lower(F.trim(raw))
    for name, meant in ROLE_NAMES.items():
        raw = F.when(named == name, F.lit(meant)).otherwise(raw)
    return raw


def _item_turn(role: str, text: str):
    def turn(item: Column) -> Column:
        return _turn(_role(F.try_variant_get(item, f"$.{role}", "string")), F.try_variant_get(item, f"$.{text}", "string"))

    return turn


def _json_turns(record: Column, layout: Layout) -> Column:
    parts = []
    for rule in layout.turns:
        if rule[0] == "*":
            listed = F.try_variant_get(record, f"$.{rule[1]}", "array<variant>")

            parts.append(F.coalesce(F.transform(listed, _item_turn(rule[2], rule[3])), F.array().cast(TURNS)))
        else:
            texts = [F.nullif(F.try_variant_get(record, f"$.{p}", "string"), F.lit("")) for p in rule[1:]]
            text = F.concat_ws("\n\n", *texts)
            only = F.array(_turn(F.lit(rule[0]), text))
            parts.append(F.when(text == "", F.array().cast(TURNS)).otherwise(only) if rule[0] == "system" else only)
    return F.concat(*parts)


def turns_of_json(df: DataFrame, record: str, keep: list[str]) -> DataFrame:
    """``keep``, ``layout`` and ``turns`` of JSON records, each in any of the layouts."""
    parsed = df.select(*keep, F.try_parse_json(record).alias("_record")).withColumn("_held", held_paths(F.col("_record")))
    named = parsed.withColumn("_layout", layout_name(F.col("_held")))
    turns = F.array().cast(TURNS)
    for layout in LAYOUTS:
        if layout.turns:
            turns = F.when(F.col("_layout") == layout.name, _json_turns(F.col("_record"), layout)).otherwise(turns)
    known = F.col("_layout").isin([layout.name for layout in LAYOUTS if layout.turns])
    return named.select(*keep, F.when(known, F.col("_layout")).alias("layout"), turns.cast(TURNS).alias("turns"))


def turns_of_table(df: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, layout, turns) of a table whose columns are in one of the layouts; other columns are ignored."""
    layout = layout_of(schema_paths(df.schema))
    if layout is None:
        raise ValueError(f"no layout has the fields {sorted(schema_paths(df.schema))}")
    if layout.turns:
        held = sorted({p.split("[].")[0] for p in layout.paths})
        return turns_of_json(df.select(key, F.to_json(F.struct(*held)).alias("_raw")), "_raw", [key])
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("_rows"))
    turns = F.transform("_rows", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.select(F.col("conv_id").alias(key), F.lit(layout.name).alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<$1\\|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\\\|", r"<$1|")


def _escape_role(role: Column) -> Column:
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_chats(df: DataFrame, learn_role: str = "assistant") -> DataFrame:
    """Replaces ``turns`` by ``formatted`` and ``loss_mask`` (piece, start, length), all in characters."""
    written = F.transform(
        "turns",
        lambda t: F.concat(F.lit(START), _escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END + "\n")),
    )
    mask = F.transform(
        "turns",
        lambda t, i: F.when(
            t["role"] == learn_role,
            F.struct(
                i.alias("piece"),
                (F.lit(len(START) + 1) + F.length(_escape_role(t["role"]))).alias("start"),
                F.length(escape(t["text"])).alias("length"),
            ),
        ),
    )
    others = [c for c in df.columns if c != "turns"]
    return df.select(*others, F.array_join(written, "").alias("formatted"), F.filter(mask, lambda m: m.isNotNull()).alias("loss_mask"))


def _pieces(formatted: Column) -> Column:
    """The turns as written, without the closing mark."""
    whole = F.split(formatted, r"<\|im_end\|>\n", -1)
    return F.slice(whole, 1, F.size(whole) - 1)  # nothing stands after the last mark


def read_chats(df: DataFrame) -> DataFrame:
    """``turns`` and ``learned`` (the unescaped texts under the mask), from ``formatted`` and ``loss_mask`` alone."""

    def turn(piece: Column) -> Column:
        role = F.substring_index(F.substr(piece, F.lit(len(START) + 1)), "\n", 1)
        text = F.substr(piece, F.length(role) + len(START) + 2)
        return _turn(_unescape_role(role), unescape(text))

    split = df.withColumn("_pieces", _pieces(F.col("formatted")))
    learned = F.transform(
        "loss_mask", lambda m: unescape(F.substr(F.get("_pieces", m["piece"]), m["start"] + 1, m["length"]))
    )
    return split.select(*df.columns, F.transform("_pieces", turn).alias("turns"), learned.alias("learned"))
