"""Slot filling on a stream: state per session, one row when a session is complete."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from caselight.functions.rules import INTAKE_DOMAINS, INTAKE_FIELDS, TEAM_FIELD
from caselight.functions.text import blank_to_null
from caselight.operators.intake import clean_team, team_is_valid
from caselight.streaming.ingest import file_stream, run_to_end

_STRINGS = ", ".join(f"{f} string" for f in INTAKE_FIELDS)
OUTPUT = f"session_id long, turn long, {_STRINGS}"
STATE = f"turn long, done boolean, {', '.join(f'v{i} string, ok{i} boolean' for i in range(len(INTAKE_FIELDS)))}"


def _with_validity(turns: DataFrame) -> DataFrame:
    """Field values cleaned and judged by Spark, so that the state function only remembers."""
    known = turns.withColumns({f: blank_to_null(F.col(f)) for f in INTAKE_FIELDS})
    valid = {f"ok_{f}": F.coalesce(F.col(f).isin(d), F.lit(False)) for f, d in INTAKE_DOMAINS.items()}
    valid[f"ok_{TEAM_FIELD}"] = team_is_valid(F.col(TEAM_FIELD))
    return known.withColumns(valid).withColumn(TEAM_FIELD, clean_team(F.col(TEAM_FIELD)))


def _advance(gap_ms: int):
    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()  # the session was left unfinished
            return
        held = list(state.get) if state.exists else [0, False] + [None, False] * len(INTAKE_FIELDS)
        turn, done, slots = held[0], held[1], held[2:]
        # A finished session needs no order and holds nothing back.
        parts = [] if done else list(batches)
        if parts:
            rows = pd.concat(parts).sort_values(["ts", "event_id"], kind="stable")
            columns = [rows[c].tolist() for f in INTAKE_FIELDS for c in (f, f"ok_{f}")]
            for values in zip(*columns):
                turn += 1
                for i in range(0, len(values), 2):
                    if values[i] is not None and values[i] == values[i]:
                        slots[i], slots[i + 1] = values[i], bool(values[i + 1])
                if all(slots[1::2]):
                    done = True
                    break
        else:
            for _ in batches:
                pass
        announce = done and not held[1]
        state.update((turn, done, *slots))
        state.setTimeoutTimestamp(max(state.getCurrentWatermarkMs(), 0) + gap_ms)
        if announce:
            yield pd.DataFrame([[key[0], turn, *slots[0::2]]], columns=["session_id", "turn", *INTAKE_FIELDS])

    return step


def completed_stream(
    spark: SparkSession,
    source: str,
    to_turns: Callable[[DataFrame], DataFrame],
    path: str,
    late: str = "1 hour",
    gap_hours: int = 24 * 365,
    files_per_batch: int | None = 1,
) -> DataFrame:
    """(session_id, turn, fields) at the turn a session first became complete.

    Sessions silent for ``gap_hours`` of event time lose their state. A batch holds a session's
    narrow rows in one task; ``files_per_batch``, one unless said otherwise, bounds that.
    """
    stream = _with_validity(to_turns(file_stream(spark, source, files_per_batch)))
    done = (
        stream.withWatermark("ts", late)
        .groupBy("session_id")
        .applyInPandasWithState(
            _advance(gap_hours * 3_600_000), OUTPUT, STATE, "append", GroupStateTimeout.EventTimeTimeout
        )
    )
    return run_to_end(done, path)
