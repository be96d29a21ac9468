"""Incremental folder ingest: new files in, chunks out, each file exactly once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.operators.chunking import char_windows, explode_chunks
from caselight.sources.stores import is_file


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream over Parquet files: one file, a folder, or a glob of them."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if is_file(spark, path):  # a file source watches folders only
        folder, name = path.rsplit("/", 1)
        return reader.option("pathGlobFilter", name).parquet(folder)
    return reader.parquet(path)


def run_to_end(stream: DataFrame, path: str, on_start=None, **options: str) -> DataFrame:
    """Write all that is there to a file sink under ``path`` and read it back.

    The checkpoint next to the output makes a repeated call take up only new files. ``on_start`` is called with the
    started query.
    """
    query = (
        stream.writeStream.format("parquet")
        .option("path", f"{path}/data")
        .option("checkpointLocation", f"{path}/checkpoint")
        .options(**options)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    if on_start is not None:
        on_start(query)
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/data")


def ingest_stream(
    spark: SparkSession, source: str, path: str, size: int = 512, shape=None, on_start=None, shape_rows=None
) -> DataFrame:
    """Chunk store of document files: (doc_id, category, ordinal, chunk).

    ``shape_rows`` and ``shape`` may change the stream of documents and of chunks (as ``observe`` does); ``on_start``
    sees the query.
    """
    documents = file_stream(spark, source).withColumn("category", F.col("lang"))
    documents = shape_rows(documents) if shape_rows else documents
    chunks = explode_chunks(documents, char_windows(F.col("text"), size, 0), "doc_id", "category")
    return run_to_end(shape(chunks) if shape else chunks, path, on_start)
