"""Continuous triage: new tickets in, case reports and hourly counts out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.operators import triage
from caselight.operators.term_index import save_term_index
from caselight.streaming.ingest import file_stream


def _run(stream: DataFrame, path: str, mode: str, each: Callable[[DataFrame, int], None]) -> None:
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", f"{path}/checkpoint")
        .foreachBatch(each)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def triage_stream(
    spark: SparkSession,
    source: str,
    to_tickets: Callable[[DataFrame], DataFrame],
    path: str,
    accounts: DataFrame,
    orders: DataFrame,
    chunks: DataFrame,
    files_per_batch: int | None = None,
    **options,
) -> DataFrame:
    """Reports of all tickets that have arrived.

    Every micro-batch is one batch job with static tables. It writes the folder of its batch number,
    so a repeated batch replaces its own output.
    """
    index = save_term_index(chunks, f"{path}/index", stop_words=options.get("stop_words"))

    def each(batch: DataFrame, number: int) -> None:
        reports = triage.case_reports(batch, accounts, orders, chunks, index, **options)
        reports.write.mode("overwrite").parquet(f"{path}/data/batch={number}")

    _run(to_tickets(file_stream(spark, source, files_per_batch)), path, "append", each)
    return spark.read.parquet(f"{path}/data").drop("batch")


def volume_stream(
    spark: SparkSession,
    source: str,
    to_tickets: Callable[[DataFrame], DataFrame],
    path: str,
    late: str = "1 hour",
    files_per_batch: int | None = None,
) -> DataFrame:
    """(hour, issue_type, tickets): tumbling hours, tickets later than ``late`` are not counted.

    Changed counts are written per micro-batch; the newest count of an hour holds.
    """
    tickets = to_tickets(file_stream(spark, source, files_per_batch))
    counts = (
        triage.classify(tickets)
        .withWatermark("created_at", late)
        .groupBy(F.window("created_at", "1 hour").alias("w"), "issue_type")
        .agg(F.count("*").alias("tickets"))
        .select(F.col("w.start").alias("hour"), "issue_type", "tickets")
    )

    def each(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/data/batch={number}")

    _run(counts, path, "update", each)
    written = spark.read.parquet(f"{path}/data")
    return written.groupBy("hour", "issue_type").agg(F.max_by("tickets", "batch").alias("tickets"))
