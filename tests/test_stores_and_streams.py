"""Folders, stores, streams."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caselight.operators import hooks, intake
from caselight.plans import intake_queries, tickets_data
from caselight.plans.ticket_queries import reports
from caselight.sources import rows, stores
from caselight.streaming import ingest, slots, triage

SF = "/root/testdata/sf0.001"


def test_folder_ingest(spark, tmp_path):
    (tmp_path / "guides" / "deep").mkdir(parents=True)
    (tmp_path / "guides" / "deep" / "a.md").write_text("# A\ntext", encoding="utf-8")
    (tmp_path / "top.txt").write_text("línea", encoding="utf-8")
    (tmp_path / "guides" / "scan.pdf").write_bytes(b"%PDF")
    (tmp_path / "guides" / "bad.txt").write_bytes(b"\xff\xfe\xfa")
    (tmp_path / "guides" / ".hidden.md").write_text("no", encoding="utf-8")
    documents, rejects = rows.ingest_folder(spark, str(tmp_path))
    assert {tuple(r) for r in documents.collect()} == {("guides/deep/a.md", "guides", "# A\ntext"), ("top.txt", "general", "línea")}
    assert {(r.source, r.reason) for r in rejects.collect()} == {
        ("guides/scan.pdf", "unsupported kind"), ("guides/bad.txt", "unreadable text"),
    }
    folder = rows.load_text_folder(spark, str(tmp_path / "guides" / "deep")).collect()
    assert [tuple(r) for r in folder] == [("a.md", "# A\ntext")]


def test_jsonl_and_records(spark, tmp_path):
    (tmp_path / "qa.jsonl").write_text('{"question": "q", "answer": "a"}\n\n  \n{"question": "r", "answer": "b"}\n')
    assert stores.read_jsonl(spark, str(tmp_path / "qa.jsonl"), "question string, answer string").count() == 2
    for name in ("b", "a"):
        (tmp_path / f"intake_{name}.json").write_text('{"urgency": "%s"}' % name)
    back = stores.read_records(spark, str(tmp_path / "intake_*.json"), "urgency string").collect()
    assert [r.urgency for r in back] == ["a", "b"]


def test_store_is_reused_until_rebuilt(spark, tmp_path):
    path, calls = str(tmp_path / "store"), []

    def build(n):
        def made():
            calls.append(n)
            return spark.range(n)

        return made

    assert stores.persisted(spark, path, build(2)).count() == 2
    assert stores.persisted(spark, path, build(5)).count() == 2
    assert stores.persisted(spark, path, build(5), rebuild=True).count() == 5
    assert calls == [2, 5]


def test_repeated_append_adds_nothing(spark):
    chunks = spark.createDataFrame([("s", 0, "a"), ("s", 1, "b"), ("s", 0, "a")], "source string, ordinal long, text string")
    once = stores.append_chunks(chunks.limit(0), chunks)
    assert once.count() == 2
    assert stores.append_chunks(once.drop("chunk_key"), chunks).count() == 2


@pytest.fixture(scope="module")
def event_folder(spark, tmp_path_factory):
    """The events in several files, oldest first, so that streams run several micro-batches."""
    path = str(tmp_path_factory.mktemp("events") / "files")
    events = spark.read.parquet(f"{SF}/events.parquet").withColumn("part", F.ntile(4).over(Window.orderBy("ts", "event_id")))
    for part in range(1, 5):
        events.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(path)
    return path


def test_slot_stream_equals_batch_over_micro_batches(spark, event_folder, tmp_path):
    stream = slots.completed_stream(
        spark, event_folder, intake_queries.turns_of, str(tmp_path / "s"), late="400 days", files_per_batch=1
    )
    filled = intake.fill_slots(intake_queries.turns(spark, SF), ["ts", "event_id"])
    batch = intake.completed_sessions(filled)
    columns = ["session_id", *intake.INTAKE_FIELDS]
    assert {tuple(r) for r in stream.select(columns).collect()} == {tuple(r) for r in batch.select(columns).collect()}


def test_triage_stream_equals_batch(spark, event_folder, tmp_path):
    chunks = tickets_data.catalogue_chunks(spark, SF)
    stream = triage.triage_stream(
        spark, event_folder, tickets_data.event_tickets_of, str(tmp_path / "t"),
        accounts=tickets_data.accounts(spark, SF), orders=tickets_data.orders(spark, SF), chunks=chunks,
        files_per_batch=2, internal_source=tickets_data.INTERNAL_SOURCE, stop_words=tickets_data.STOP_WORDS,
    )
    shown = ["ticket_id", "draft", "resolution_path", "order_amount"]
    assert {tuple(r) for r in stream.select(shown).collect()} == {tuple(r) for r in reports(spark, SF).select(shown).collect()}


def test_volume_stream_counts_every_ticket(spark, event_folder, tmp_path):
    counts = triage.volume_stream(
        spark, event_folder, tickets_data.event_tickets_of, str(tmp_path / "v"), late="400 days", files_per_batch=1
    )
    assert counts.agg(F.sum("tickets")).first()[0] == spark.read.parquet(event_folder).count()


def test_ingest_stream_takes_each_file_once(spark, tmp_path):
    documents = spark.read.parquet(f"{SF}/documents.parquet").limit(20)
    folder, store = str(tmp_path / "in"), str(tmp_path / "out")
    documents.write.parquet(folder)
    first = ingest.ingest_stream(spark, folder, store).count()
    again = ingest.ingest_stream(spark, folder, store).count()
    documents.withColumn("doc_id", F.col("doc_id") + 1000).write.mode("append").parquet(folder)
    assert first == again and ingest.ingest_stream(spark, folder, store).count() == 2 * first


def test_hooks_run_in_batches(spark):
    frame = spark.createDataFrame([("a b",), ("b a",), ("",), (None,)], "text string")
    vectors = [r.embedding for r in hooks.embed(frame, "text", batch_rows=2).collect()]
    assert vectors[0] == vectors[1] and len(vectors[0]) == 64 and sum(map(abs, vectors[2])) == 0
    labelled = hooks.classify_with(frame, "text", lambda texts: [str(len(t)) for t in texts], "n").collect()
    assert [r.n for r in labelled] == ["3", "3", "0", "0"]
    pairs = spark.createDataFrame([("q", "x" * 600)], "q string, d string")
    length = lambda a, b: [float(len(x)) for x in b]
    assert hooks.score_with(pairs, "q", "d", length).first().score == 600.0
    assert hooks.score_with(pairs, "q", "d", length, right_chars=512).first().score == 512.0


def test_hooks_get_batches_cut_by_bytes(spark):
    frame = spark.range(40, numPartitions=1).selectExpr("id", "repeat('x', 1000000) AS text")
    sizes = hooks.classify_with(frame, "text", lambda texts: [str(len(texts))] * len(texts), "n").select("n").collect()
    assert len(sizes) == 40 and max(int(r.n) for r in sizes) <= 20


def test_scored_batches_do_not_pile_up_in_the_worker(spark):
    frame = spark.range(4000, numPartitions=1).selectExpr("'q' AS q", "repeat(cast(id as string), 25000) AS d")

    def resident(asked, found):
        with open("/proc/self/statm") as file:
            return [int(file.read().split()[1]) * 4096 / 1e6] * len(found)

    used = [r.score for r in hooks.score_with(frame, "q", "d", resident).select("score").collect()]
    assert max(used) < used[0] + 150  # 350 MB of texts pass through


def test_folder_with_rejects_of_each_kind(spark, tmp_path):
    base = tmp_path / "kb (v1.0)+"
    (base / "faq").mkdir(parents=True)
    (base / "faq" / "a.md").write_text("alpha")
    (base / "b.TXT").write_text("beta")
    (base / "big.txt").write_text("x" * 500)
    (base / "bad.md").write_bytes(b"\xff\xfe\xff")
    (base / "c.pdf").write_bytes(b"%PDF")
    (base / ".hidden.md").write_text("no")
    documents, rejects = rows.ingest_folder(spark, str(base), most_bytes=100)
    assert sorted(map(tuple, documents.collect())) == [("b.TXT", "general", "beta"), ("faq/a.md", "faq", "alpha")]
    assert sorted((r.source, r.reason) for r in rejects.collect()) == [
        ("bad.md", "unreadable text"), ("big.txt", "too large"), ("c.pdf", "unsupported kind"),
    ]


def test_text_folder_in_name_order(spark, tmp_path):
    for name in ("b.md", "a.md", "c.txt"):
        (tmp_path / name).write_text(f"text of {name}\nsecond line")
    found = rows.load_text_folder(spark, str(tmp_path)).collect()
    assert [(r.source, r.text) for r in found] == [(n, f"text of {n}\nsecond line") for n in ("a.md", "b.md")]


def test_ingest_runs_take_turns_and_keep_their_status(spark, tmp_path):
    from caselight.streaming import runs

    lease = runs.Lease(spark, str(tmp_path / "lease"))
    assert lease.take("a") and not lease.take("b")
    lease.stale_seconds = -1  # the holder is taken for dead
    assert lease.take("c")
    lease.give_back()
    lease.stale_seconds = 3600
    source = "/root/testdata/sf0.001/documents.parquet"
    done = runs.ingest_run(spark, source, str(tmp_path / "store"), str(tmp_path / "runs"), lease)
    with pytest.raises(Exception):
        runs.ingest_run(spark, str(tmp_path / "missing.parquet"), str(tmp_path / "store2"), str(tmp_path / "runs"), lease)
    status = {r.run_id: r for r in runs.run_status(spark, str(tmp_path / "runs")).collect()}
    assert status[done].status == "succeeded" and status[done].batches >= 1
    assert status[done].rows_in == spark.read.parquet(source).count()
    assert status[done].finished_at >= status[done].started_at
    assert sorted(r.status for r in status.values()) == ["failed", "succeeded"]
    assert lease.take("free again")
