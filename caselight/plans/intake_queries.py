"""Checked queries on intake and conversations.

Events stand in for intake turns: the event type names the field, ``props.k`` picks its value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caselight.functions import rules
from caselight.functions.text import fill_template, word_count
from caselight.operators import conversation, evaluation, intake
from caselight.plans.ticket_sql import TOKENS
from caselight.registry import query, table, text_literal
from caselight.session import scratch_path
from caselight.sources.stores import read_records
from caselight.streaming import slots

EVENT_FIELDS = {
    "view": "query_type",
    "signup": "regulation_ref",
    "click": "product_area",
    "error": "urgency",
    "purchase": "submitting_team",
}
TEAMS = ["safety desk", "Quality Assurance North", "Mira", "   ", " dossier group south ", "printing team", "Jonas", ""]
VALUES = {**{f: [*d, "unknown", ""] for f, d in rules.INTAKE_DOMAINS.items()}, rules.TEAM_FIELD: TEAMS}
FIELDS = rules.INTAKE_FIELDS


def turns_of(events: DataFrame) -> DataFrame:
    """One turn per event, with the one field it sets."""
    k = F.get_json_object("props", "$.k").cast("long")

    def value(field: str):
        values = VALUES[field]
        return F.get(F.array(*[F.lit(v) for v in values]), (k % len(values)).cast("int"))

    return events.select(
        F.col("user_id").alias("session_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        *[F.when(F.col("event_type") == e, value(f)).alias(f) for e, f in EVENT_FIELDS.items()],
    )


def turns(spark, sf_dir) -> DataFrame:
    return turns_of(table(spark, sf_dir, "events"))


def _filled(spark, sf_dir) -> DataFrame:
    return intake.fill_slots(turns(spark, sf_dir), ["ts", "event_id"])


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"


def _sql_values(field: str) -> str:
    values = VALUES[field]
    return "([" + ", ".join(text_literal(v) for v in values) + f"])[{_K} % {len(values)} + 1]"


_TURNS = "turns AS (SELECT user_id AS session_id, ts, event_id, " + ", ".join(
    f"CASE WHEN event_type = '{e}' THEN {_sql_values(f)} END AS {f}" for e, f in EVENT_FIELDS.items()
) + " FROM events)"
_BLANK = r"nullif(regexp_replace({f}, '^\s+|\s+$', '', 'g'), '')"
_LIST = lambda d: ", ".join(text_literal(v) for v in d)
_TEAM_CLEAN = (
    r"array_to_string(list_transform(string_split(lower(regexp_replace(submitting_team, '^\s+|\s+$', '', 'g')), ' '), "
    r"lambda w: upper(w[1]) || w[2:]), ' ')"
)


def _failing_sql() -> str:
    tests = [
        f"CASE WHEN coalesce({f} IN ({_LIST(d)}), false) THEN NULL ELSE '{f}' END"
        for f, d in rules.INTAKE_DOMAINS.items()
    ]
    tests.append(
        f"CASE WHEN coalesce(length({_TEAM_CLEAN}) > 0 AND NOT regexp_full_match({_TEAM_CLEAN}, "
        r"'\p{Lu}\p{L}*'), false) THEN NULL ELSE 'submitting_team' END"
    )
    return f"concat_ws(',', {', '.join(tests)})"


_FILLED = f"""{_TURNS},
so_far AS (SELECT session_id, ts, event_id,
  row_number() OVER w AS turn,
  {', '.join(f"last_value(CASE WHEN {_BLANK.format(f=f)} IS NOT NULL THEN {f} END IGNORE NULLS) OVER w AS {f}" for f in FIELDS)}
  FROM turns WINDOW w AS (PARTITION BY session_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
filled AS (SELECT *, {_failing_sql()} AS failing,
  concat_ws(',', {', '.join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in FIELDS)}) AS missing FROM so_far)"""


@query(
    "slot_fill",
    f"""WITH {_FILLED} SELECT session_id, event_id, turn, {', '.join(FIELDS)}, failing, missing,
      nullif(split_part(failing, ',', 1), '') AS ask_next FROM filled""",
)
def slot_fill(spark, sf_dir):
    return _filled(spark, sf_dir).select(
        "session_id", "event_id", "turn", *FIELDS,
        F.array_join("failing", ",").alias("failing"), F.array_join("missing", ",").alias("missing"), "ask_next",
    )


_COMPLETE = f"""{_FILLED},
complete AS (SELECT * REPLACE ({_TEAM_CLEAN} AS submitting_team) FROM filled WHERE failing = ''
  QUALIFY row_number() OVER (PARTITION BY session_id ORDER BY turn) = 1)"""


@query("session_complete", f"WITH {_COMPLETE} SELECT session_id, turn, {', '.join(FIELDS)} FROM complete")
def session_complete(spark, sf_dir):
    return intake.completed_sessions(_filled(spark, sf_dir))


@query(
    "stream_slot_fill",
    f"WITH {_COMPLETE} SELECT session_id, turn, {', '.join(FIELDS)} FROM complete",
)
def stream_slot_fill(spark, sf_dir):
    """The same completions, found by a stateful stream over the events."""
    return slots.completed_stream(spark, f"{sf_dir}/events.parquet", turns_of, scratch_path(spark, "slots"))


_RECORDS = "records AS (SELECT event_id, " + ", ".join(
    f"{_sql_values(f)} AS {f}" for f in FIELDS
) + " FROM events)"


def _records(spark, sf_dir) -> DataFrame:
    """One full record per event, many of them invalid."""
    k = F.get_json_object("props", "$.k").cast("long")
    pick = lambda v: F.get(F.array(*[F.lit(x) for x in v]), (k % len(v)).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", *[pick(VALUES[f]).alias(f) for f in FIELDS])


@query(
    "intake_validate",
    f"""WITH {_RECORDS} SELECT event_id, {_failing_sql()} AS failing, {_TEAM_CLEAN} AS submitting_team FROM records""",
)
def intake_validate(spark, sf_dir):
    checked = intake.validate(_records(spark, sf_dir))
    return checked.select("event_id", F.array_join("failing", ",").alias("failing"), "submitting_team")


@query(
    "intake_quarantine",
    f"""WITH {_RECORDS}, checked AS (SELECT event_id, {_failing_sql()} AS failing FROM records)
      SELECT event_id, CASE WHEN failing = '' THEN 'valid' ELSE 'quarantined' END AS lot,
        len(list_filter(string_split(failing, ','), lambda f: f <> '')) AS failures FROM checked""",
)
def intake_quarantine(spark, sf_dir):
    valid, bad = intake.split_valid(intake.validate(_records(spark, sf_dir)))
    lots = [d.withColumn("lot", F.lit(name)) for d, name in ((valid, "valid"), (bad, "quarantined"))]
    return lots[0].unionByName(lots[1]).select(
        "event_id", "lot", F.size("failing").cast("long").alias("failures")
    )


FENCES = ["```json\n{body}\n```", "```{body}```", "  {body}\n", "{body} and more", "```json {body}"]


def _fenced(spark, sf_dir) -> DataFrame:
    body = F.when(
        F.col("event_type") == "error", F.lit('{"error": "' + rules.NON_DOMAIN_MARKER + '"}')
    ).otherwise(F.col("props"))
    shape = F.get(F.array(*[F.lit(f) for f in FENCES]), (F.col("event_id") % len(FENCES)).cast("int"))
    return table(spark, sf_dir, "events").select("event_id", fill_template(shape, {"body": body}).alias("reply"))


_FENCED = (
    "fenced AS (SELECT event_id, replace((["
    + ", ".join(text_literal(f) for f in FENCES)
    + f"])[event_id % {len(FENCES)} + 1], '{{body}}', CASE WHEN event_type = 'error' "
    + "THEN '{\"error\": \"" + rules.NON_DOMAIN_MARKER + "\"}' ELSE props END) AS reply FROM events), "
    + r"""bare AS (SELECT event_id, regexp_replace(regexp_replace(regexp_replace(regexp_replace(reply,
      '^\s+|\s+$', '', 'g'), '^```json|^```', ''), '```$', ''), '^\s+|\s+$', '', 'g') AS bare FROM fenced)"""
)


@query(
    "fenced_json_parse",
    f"""WITH {_FENCED} SELECT event_id, json_valid(bare) AS parsed,
      CASE WHEN json_valid(bare) THEN CAST(json_extract_string(bare, '$.k') AS BIGINT) END AS k,
      CASE WHEN json_valid(bare) THEN json_extract_string(bare, '$.error') END AS error FROM bare""",
)
def fenced_json_parse(spark, sf_dir):
    parsed = _fenced(spark, sf_dir).select(
        "event_id", intake.parse_fenced(F.col("reply"), "k long, error string").alias("r")
    )
    return parsed.select("event_id", F.col("r").isNotNull().alias("parsed"), "r.k", "r.error")


@query(
    "domain_fallback",
    f"""WITH {_FENCED} SELECT event_id,
      CASE WHEN json_valid(bare) AND coalesce(json_extract_string(bare, '$.error') = '{rules.NON_DOMAIN_MARKER}', false)
           THEN 'fallback' ELSE 'extract' END AS route FROM bare WHERE json_valid(bare)""",
)
def domain_fallback(spark, sf_dir):
    replies = _fenced(spark, sf_dir)
    parsed = replies.filter(intake.parse_fenced(F.col("reply"), "k long").isNotNull())
    return parsed.select(
        "event_id", F.when(intake.is_out_of_domain(F.col("reply")), "fallback").otherwise("extract").alias("route")
    )


DEADLINES = [
    "The authority expects our answer within {k} days.",
    "There are {k} business days left for a reply.",
    "This one is pressing, please move it up!",
    "The dossier is scheduled, nobody has named a date.",
    "A {k}-day window for answers has opened, file 5107.",
]
_TIERS = " ".join(f"WHEN days <= {n} THEN '{name}'" for n, name in rules.DEADLINE_TIERS)


@query(
    "deadline_urgency",
    "WITH asked AS (SELECT event_id, replace((["
    + ", ".join(text_literal(d) for d in DEADLINES)
    + f"])[event_id % {len(DEADLINES)} + 1], '{{k}}', ({_K})::VARCHAR) AS text FROM events), "
    + rf"""found AS (SELECT event_id, TRY_CAST(regexp_extract(text,
      '(?i)([0-9]+)[ -]*(?:business |working |calendar )?days?\b', 1) AS BIGINT) AS days FROM asked)
      SELECT event_id, CASE WHEN days IS NULL THEN NULL {_TIERS} ELSE 'routine' END AS urgency FROM found""",
)
def deadline_urgency(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    shape = F.get(F.array(*[F.lit(d) for d in DEADLINES]), (F.col("event_id") % len(DEADLINES)).cast("int"))
    asked = table(spark, sf_dir, "events").select("event_id", fill_template(shape, {"k": k}).alias("text"))
    return asked.select("event_id", rules.deadline_urgency(F.col("text")).alias("urgency"))


_PRESENT = lambda want: "concat_ws(',', " + ", ".join(
    f"CASE WHEN {f} IS {'NOT ' if want else ''}NULL THEN '{f}' END" for f in FIELDS
) + ")"


@query(
    "log_safe_record",
    f"""WITH {_TURNS} SELECT event_id, {', '.join(FIELDS)}, {_PRESENT(True)} AS fields_extracted,
      {_PRESENT(False)} AS fields_missing, true AS log_safe FROM turns""",
)
def log_safe_record(spark, sf_dir):
    with_text = turns(spark, sf_dir).withColumn("text", F.lit("the raw message"))
    safe = intake.log_safe(with_text, "event_id")
    return safe.withColumns(
        {c: F.array_join(c, ",") for c in ("fields_extracted", "fields_missing")}
    )


def _job(spark, sf_dir) -> DataFrame:
    done = intake.completed_sessions(_filled(spark, sf_dir)).withColumnRenamed("turn", "turns_taken")
    return intake.log_safe(done, "session_id", "turns_taken").drop("fields_extracted", "fields_missing")


@query(
    "intake_job",
    f"WITH {_COMPLETE} SELECT session_id, turn AS turns_taken, {', '.join(FIELDS)}, true AS log_safe FROM complete",
)
def intake_job(spark, sf_dir):
    """Turns to records: accumulate, validate, keep what may be logged."""
    return _job(spark, sf_dir)


@query(
    "records_read_back",
    f"""WITH {_COMPLETE} SELECT session_id, turn AS turns_taken, {', '.join(FIELDS)}, true AS log_safe,
      true AS from_json_file FROM complete""",
)
def records_read_back(spark, sf_dir):
    path = scratch_path(spark, "records")
    records = _job(spark, sf_dir)
    records.write.json(path)
    back = read_records(spark, path, records._jdf.schema().toDDL())
    return back.withColumn("from_json_file", F.endswith("file_name", F.lit(".json"))).drop("file_name")


# ---- conversations ------------------------------------------------------------------------

_SPOKEN = """
spoken AS (SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS n,
    CASE role WHEN 'user' THEN 'Human: ' ELSE 'AI: ' END || text AS line
  FROM conversations WHERE role IN ('user', 'assistant'))"""


def _messages(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "conversations")


@query(
    "memory_window",
    f"""WITH {_SPOKEN} SELECT conv_id, turn, coalesce(array_to_string(list(line) OVER (PARTITION BY conv_id ORDER BY n
      ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), chr(10)), '') AS memory FROM spoken""",
)
def memory_window(spark, sf_dir):
    """Two exchanges, because no given session has more than eight messages."""
    remembered = conversation.memory_window(_messages(spark, sf_dir), k=2)
    return remembered.select("conv_id", "turn", F.array_join("memory", "\n").alias("memory"))


@query(
    "memory_full",
    f"""WITH {_SPOKEN} SELECT conv_id, turn, 0::BIGINT AS pages_before,
      coalesce(array_to_string(list(line) OVER (PARTITION BY conv_id ORDER BY n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), chr(10)), {text_literal(conversation.EMPTY_HISTORY)})
        AS history FROM spoken""",
)
def memory_full(spark, sf_dir):
    return conversation.memory_full(_messages(spark, sf_dir)).select("conv_id", "turn", "pages_before", "history")


@query(
    "memory_full_paged",
    f"""WITH {_SPOKEN} SELECT conv_id, turn, greatest((n - 1) // 2, 0)::BIGINT AS pages_before,
      coalesce(array_to_string(list(line) OVER (PARTITION BY conv_id ORDER BY n
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), chr(10)), {text_literal(conversation.EMPTY_HISTORY)})
        AS history FROM spoken""",
)
def memory_full_paged(spark, sf_dir):
    """The whole history again, put together from pages of two lines, which most given sessions fill."""
    messages = _messages(spark, sf_dir)
    whole = conversation.with_pages(conversation.memory_full(messages, 2), conversation.history_pages(messages, 2))
    return whole.select("conv_id", "turn", "pages_before", "history")


_FLAT = r"regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '^\s+|\s+$', '', 'g')"


_SWITCH_SQL = rf"""WITH {_SPOKEN}, flat AS (SELECT *, {_FLAT} AS flat FROM spoken),
      stored AS (SELECT *, CASE WHEN n + 1 < 4 THEN line
          ELSE coalesce(nullif(regexp_extract(flat, '^(.*?[.!?])(\s|$)', 1), ''), flat) END AS kept FROM flat)
      SELECT a.conv_id, a.turn, CASE WHEN a.n + 1 > 4 THEN 'summary' ELSE 'buffer' END AS mode,
        coalesce(string_agg(b.kept, chr(10) ORDER BY b.n), '') AS history
      FROM stored a LEFT JOIN stored b ON b.conv_id = a.conv_id AND b.n < a.n
        AND ((a.n + 1 <= 4) OR b.n + 1 >= 4)
      GROUP BY a.conv_id, a.turn, a.n"""


@query("memory_switch", _SWITCH_SQL)
def memory_switch(spark, sf_dir):
    """The switch is set at turn 4, because no given session has more than eight messages."""
    switched = conversation.memory_switch(_messages(spark, sf_dir), limit=4)
    return switched.select("conv_id", "turn", "mode", "history")


@query("memory_switch_paged", _SWITCH_SQL)
def memory_switch_paged(spark, sf_dir):
    """The same, put together from condensed pages of two lines."""
    messages = _messages(spark, sf_dir)
    switched = conversation.memory_switch(messages, limit=4, page_size=2)
    whole = conversation.with_pages(switched, conversation.condensed_pages(messages, limit=4, page_size=2))
    return whole.select("conv_id", "turn", "mode", "history")


@query(
    "token_usage",
    r"""WITH calls AS (SELECT role, len(regexp_extract_all(text, '\S+')) AS words FROM conversations)
      SELECT role, sum(CASE WHEN role <> 'assistant' THEN words ELSE 0 END)::BIGINT AS input_tokens,
        sum(CASE WHEN role = 'assistant' THEN words ELSE 0 END)::BIGINT AS output_tokens,
        sum(words)::BIGINT AS total_tokens FROM calls GROUP BY role""",
)
def token_usage(spark, sf_dir):
    """Words stand in for tokens."""
    n, spoken_by_model = word_count(F.col("text")), F.col("role") == "assistant"
    calls = _messages(spark, sf_dir).select(
        "role",
        F.when(~spoken_by_model, n).otherwise(F.lit(0)).alias("input_tokens"),
        F.when(spoken_by_model, n).otherwise(F.lit(0)).alias("output_tokens"),
    )
    return evaluation.token_usage(calls, "role")


_TURN_TOKENS = {t: TOKENS.format(text=f"{t}.text") for t in "aq"}


@query(
    "lexical_recall",
    f"""SELECT a.conv_id, a.turn, round(CASE WHEN len({_TURN_TOKENS['q']}) = 0 THEN 0 ELSE
        len(list_intersect(list_distinct({_TURN_TOKENS['q']}), {_TURN_TOKENS['a']}))
        / len(list_distinct({_TURN_TOKENS['q']}))::DOUBLE END, 6) AS recall
      FROM conversations a JOIN conversations q ON q.conv_id = a.conv_id AND q.turn = a.turn - 1
      WHERE a.role = 'assistant' AND q.role = 'user'""",
)
def lexical_recall(spark, sf_dir):
    """Share of a user's words that come back in the reply."""
    messages = _messages(spark, sf_dir)
    asked = messages.filter(F.col("role") == "user").select(
        "conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("question")
    )
    answered = messages.filter(F.col("role") == "assistant").join(asked, ["conv_id", "turn"])
    share = evaluation.lexical_share(F.col("question"), F.col("text"))
    return answered.select("conv_id", "turn", F.round(share, 6).alias("recall"))
