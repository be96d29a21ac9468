"""Structured intake: validate records, fill slots over the turns of a session, log safely.

A turn table has ``session_id``, order columns, and one column per intake field, null where the turn
says nothing about it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caselight.functions.rules import INTAKE_DOMAINS, INTAKE_FIELDS, NON_DOMAIN_MARKER, TEAM_FIELD
from caselight.functions.text import blank_to_null, strip, strip_code_fence, title_case
from caselight.operators.conversation import split_running


def clean_team(team: Column) -> Column:
    return title_case(strip(team))


def team_is_valid(team: Column) -> Column:
    """Not blank, and not a single word of letters, which looks like a person's name."""
    cleaned = clean_team(team)
    one_word = F.rlike(cleaned, F.lit(r"^\p{Lu}\p{L}*$"))
    return F.coalesce((F.length(cleaned) > 0) & ~one_word, F.lit(False))


def failing_fields(columns: dict[str, Column] | None = None) -> Column:
    """Names of the fields that are missing or out of their domain, in field order."""
    get = lambda f: (columns or {}).get(f, F.col(f))
    tests = [
        F.when(F.coalesce(get(field).isin(domain), F.lit(False)), F.lit(None).cast("string")).otherwise(field)
        for field, domain in INTAKE_DOMAINS.items()
    ]
    tests.append(F.when(~team_is_valid(get(TEAM_FIELD)), TEAM_FIELD))
    return F.array_compact(F.array(*tests))


def validate(records: DataFrame) -> DataFrame:
    """Adds ``failing`` and brings the team name into its stored form."""
    return records.withColumn("failing", failing_fields()).withColumn(
        TEAM_FIELD, clean_team(F.col(TEAM_FIELD))
    )


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined)."""
    ok = F.size("failing") == 0
    return validated.filter(ok), validated.filter(~ok)


def parse_fenced(text: Column, schema: str) -> Column:
    """JSON after its code fence is taken off; null when it does not parse."""
    bare = strip_code_fence(text)
    return F.when(is_one_json_value(bare), F.from_json(bare, schema))


def is_one_json_value(text: Column) -> Column:
    """Whether the text is one JSON value and nothing else.

    Spark's parsers pass over what follows the first value. Text that stays valid both as the one
    element of a list and as the one member of an object has nothing after it.
    """
    in_list = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))).isNotNull()
    in_object = F.try_parse_json(F.concat(F.lit('{"v":'), text, F.lit("}"))).isNotNull()
    return in_list & in_object


def is_out_of_domain(text: Column) -> Column:
    bare = strip_code_fence(text)
    return F.coalesce(F.get_json_object(bare, "$.error") == NON_DOMAIN_MARKER, F.lit(False))


def fill_slots(turns: DataFrame, order: list[str], block: Column | None = None) -> DataFrame:
    """After each turn: the last non-blank value of each field, what fails, what to ask, the turn number."""
    known = turns.withColumns({f: blank_to_null(F.col(f)) for f in INTAKE_FIELDS})
    running = split_running(known, ["session_id"], order, block, lasts=INTAKE_FIELDS, number="turn")
    filled = running.select(
        "session_id", *order, "turn", *[F.col(f"{f}_so_far").alias(f) for f in INTAKE_FIELDS]
    )
    collected = F.array_compact(F.array(*[F.when(F.col(f).isNotNull(), F.lit(f)) for f in INTAKE_FIELDS]))
    required = F.array(*[F.lit(f) for f in INTAKE_FIELDS])
    checked = filled.withColumn("failing", failing_fields())
    return checked.withColumns(
        {"missing": F.array_except(required, collected), "ask_next": F.get("failing", F.lit(0))}
    )


def completed_sessions(filled: DataFrame) -> DataFrame:
    """First turn of each session at which every field is valid, with the record as it then is."""
    record = F.struct("turn", *INTAKE_FIELDS)
    return (
        filled.filter(F.size("failing") == 0)
        .groupBy("session_id")
        .agg(F.min_by(record, "turn").alias("r"))
        .select("session_id", "r.*")
        .withColumn(TEAM_FIELD, clean_team(F.col(TEAM_FIELD)))
    )


def log_safe(records: DataFrame, *keep: str, banned: tuple[str, ...] = ("text", "message", "raw")) -> DataFrame:
    """Allow-listed columns only, with the fields present and missing by name."""
    leaked = [c for c in keep if c in banned]
    if leaked:
        raise ValueError(f"raw text must not be logged: {leaked}")
    names = lambda present: F.array_compact(
        F.array(*[F.when(F.col(f).isNotNull() == present, F.lit(f)) for f in INTAKE_FIELDS])
    )
    return records.select(
        *keep,
        *INTAKE_FIELDS,
        names(True).alias("fields_extracted"),
        names(False).alias("fields_missing"),
        F.lit(True).alias("log_safe"),
    )
