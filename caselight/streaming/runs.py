"""Ingest runs with a status: one run at a time, each start, end and failure written to a runs table.

A run takes a lease first: a file created through the Hadoop file system with ``overwrite=False``, so of two runs
started together exactly one creates it; the other is written down as ``rejected`` and does nothing. A lease older
than ``stale_seconds`` (its owner died) may be taken over. The run then writes ``running``, streams the files of its
source to the chunk store, and writes ``succeeded`` with its statistics, or ``failed`` with the class of the error;
the lease is given back in every case. Statistics come from ``observe`` on the stream (rows and characters per
micro-batch), gathered by a streaming query listener on the driver, so no extra pass over the data counts them.

The runs table is a folder of Parquet rows in the shared folder, one row per change of state; a run's status is its
latest row (``run_status``). Every write is a new file, so concurrent runs never rewrite each other's rows.
"""

from __future__ import annotations

import threading
import time
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from caselight.streaming.ingest import ingest_stream

RUNS_SCHEMA = (
    "run_id string, seq int, status string, at double, batches long, rows_in long, chunks long, chars long, error string"
)
METRICS = "ingest_run"
ROW_METRICS = "ingest_rows"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


@dataclass
class Lease:
    spark: SparkSession
    path: str
    stale_seconds: float = 6 * 3600

    def take(self, owner: str) -> bool:
        """True when this owner now holds the lease; False when a live run holds it."""
        fs, path = _fs(self.spark, self.path)
        for _ in range(2):
            try:
                out = fs.create(path, False)
                out.write(bytearray(f"{owner} {time.time()}", "utf-8"))
                out.close()
                return True
            except Exception:  # noqa: BLE001 - the file exists: someone holds it
                if not fs.exists(path):
                    continue
                age = time.time() - fs.getFileStatus(path).getModificationTime() / 1000
                if age <= self.stale_seconds:
                    return False
                fs.delete(path, False)  # its owner is gone
        return False

    def give_back(self) -> None:
        fs, path = _fs(self.spark, self.path)
        fs.delete(path, False)


class _Gather(StreamingQueryListener):
    """Totals of the observed metrics of one query, and a signal when it has ended."""

    def __init__(self):
        self.query_id = None
        self.batches = self.rows = self.chunks = self.chars = 0
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if self.query_id is not None and str(progress.id) != self.query_id:
            return
        seen, read = progress.observedMetrics.get(METRICS), progress.observedMetrics.get(ROW_METRICS)
        if seen is not None:
            self.batches += 1
            self.chunks += int(seen["chunks"] or 0)
            self.chars += int(seen["chars"] or 0)
        if read is not None:
            self.rows += int(read["rows"] or 0)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if self.query_id is None or str(event.id) == self.query_id:
            self.ended.set()


def _write(spark: SparkSession, runs: str, row: tuple) -> None:
    spark.createDataFrame([row], RUNS_SCHEMA).coalesce(1).write.mode("append").parquet(runs)


def ingest_run(spark: SparkSession, source: str, store: str, runs: str, lease: Lease | None = None) -> str:
    """Run one ingest of ``source`` into ``store`` under the lease; returns the run's id. Its status is in ``runs``."""
    run_id = uuid.uuid4().hex
    lease = lease or Lease(spark, f"{runs}-lease")
    if not lease.take(run_id):
        _write(spark, runs, (run_id, 0, "rejected", time.time(), 0, 0, 0, 0, "another run holds the lease"))
        return run_id
    _write(spark, runs, (run_id, 0, "running", time.time(), 0, 0, 0, 0, None))
    gather = _Gather()
    spark.streams.addListener(gather)
    try:
        def observed(chunks: DataFrame) -> DataFrame:
            return chunks.observe(
                METRICS,
                F.count(F.lit(1)).alias("chunks"),
                F.coalesce(F.sum(F.length("chunk")), F.lit(0)).alias("chars"),
            )

        def counted(documents: DataFrame) -> DataFrame:
            return documents.observe(ROW_METRICS, F.count(F.lit(1)).alias("rows"))

        def started(query):
            gather.query_id = str(query.id)

        ingest_stream(spark, source, store, shape=observed, on_start=started, shape_rows=counted)
        gather.ended.wait(60)
        _write(spark, runs, (run_id, 1, "succeeded", time.time(), gather.batches, gather.rows, gather.chunks, gather.chars, None))
    except Exception as error:  # noqa: BLE001 - every failure is written down, then raised
        _write(spark, runs, (run_id, 1, "failed", time.time(), gather.batches, gather.rows, gather.chunks, gather.chars, type(error).__name__))
        raise
    finally:
        spark.streams.removeListener(gather)
        lease.give_back()
    return run_id


def run_status(spark: SparkSession, runs: str) -> DataFrame:
    """The latest state of every run: run_id, status, started_at, finished_at, batches, rows_in, chunks, chars, error."""
    rows = spark.read.schema(RUNS_SCHEMA).parquet(runs)
    first = rows.groupBy("run_id").agg(F.min("at").alias("started_at"))
    latest = rows.withColumn("_n", F.row_number().over(Window.partitionBy("run_id").orderBy(F.col("seq").desc()))).filter("_n = 1")
    return latest.join(first, "run_id").select(
        "run_id", "status", "started_at", F.when(F.col("status") != "running", F.col("at")).alias("finished_at"),
        "batches", "rows_in", "chunks", "chars", "error",
    )
