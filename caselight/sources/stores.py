"""Chunk, vector and record stores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caselight.operators.joins import insert_or_ignore


def has_rows_at(spark: SparkSession, path: str) -> bool:
    """Whether a finished write lies at ``path``, on any file system Spark can reach."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def is_file(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).isFile(hadoop_path)


def stamp(spark: SparkSession, path: str) -> tuple[int, int]:
    """Size and time of change of a file or folder."""
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return (
        files.getContentSummary(hadoop_path).getLength(),
        files.getFileStatus(hadoop_path).getModificationTime(),
    )


def persisted(spark: SparkSession, path: str, build, rebuild: bool = False, **partition) -> DataFrame:
    """The stored table when there is one, else the result of ``build()`` written there."""
    if rebuild or not has_rows_at(spark, path):
        writer = build().write.mode("overwrite")
        if partition.get("by"):
            writer = writer.partitionBy(partition["by"])
        writer.parquet(path)
    return spark.read.parquet(path)


def content_key(source: Column, ordinal: Column, text: Column) -> Column:
    """Same chunk, same key, so that a repeated run adds nothing."""
    return F.sha2(F.concat_ws("\u0001", source, ordinal.cast("string"), text), 256)


def append_chunks(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Target plus the chunks whose content it does not hold yet."""
    key = content_key(F.col("source"), F.col("ordinal"), F.col("text"))
    keyed = incoming.withColumn("chunk_key", key).withColumn("_arrival", F.col("ordinal"))
    return insert_or_ignore(target.withColumn("chunk_key", key), keyed, "chunk_key", "_arrival")


def add_new(spark: SparkSession, path: str, incoming: DataFrame, key: str, finish, by: str) -> None:
    """Append the rows whose key the store at ``path`` does not hold, after ``finish`` (an embedding, say) was put on them.

    Only new rows are finished. Keys are compared before anything is written, so a repeated run adds nothing.
    """
    fresh = incoming
    if has_rows_at(spark, path):
        fresh = incoming.join(spark.read.parquet(path).select(key), key, "left_anti")
    finish(fresh.dropDuplicates([key])).write.mode("append").partitionBy(by).parquet(path)


def write_json_chunks(chunks: DataFrame, path: str) -> None:
    """(text, metadata) rows as JSON lines."""
    chunks.select("text", "metadata").write.mode("overwrite").json(path)


def read_json_chunks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("text string, metadata map<string,string>").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; blank lines give no row."""
    raw = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return raw.select(F.from_json("value", schema).alias("r")).select("r.*")


def ingest_stats(chunks: DataFrame, source: str = "source") -> DataFrame:
    return chunks.agg(F.count_distinct(source).alias("documents"), F.count("*").alias("chunks"))


def read_records(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Saved records of a folder in file-name order."""
    return (
        spark.read.schema(schema)
        .json(path)
        .select("*", F.col("_metadata.file_name").alias("file_name"))
        .orderBy("file_name")
    )
