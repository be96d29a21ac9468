"""Session settings, shared scratch space and bounded driver reads."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key must be split even where that costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Batches handed to Python workers are cut by bytes, so that their memory follows neither texts nor rows of a task.
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


# Only for one machine with small single-block files, as in tests and the benchmark; never set on a cluster.
SPREAD_SETTING = "caselight.spread.small.scans"


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job here relies on; returns the same session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", partitions: int = 8, **extra: str) -> SparkSession:
    """A local session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("caselight")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.driver.memory", os.environ.get("CASELIGHT_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_SETTINGS, SPREAD_SETTING: "true", **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder, because there the
    driver and the tasks are one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
    made = tempfile.mkdtemp(prefix="caselight-")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder, never reused between runs."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Fix ``df`` in the shared folder, so that later branches read one and the same result."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def rows_if_bounded(df: DataFrame, limit: int) -> list | None:
    """Collect ``df`` when it has at most ``limit`` rows, else None; reads ``limit + 1`` rows at most."""
    rows = df.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


# Tables whose rows are worked on long enough to pay for spreading them.
HEAVY_TABLES = ["documents", "pages", "embeddings", "events"]
_splits: dict[tuple[str, str, str], int] = {}


def spread_small_scan(df: DataFrame, name: str, folder: str) -> DataFrame:
    """Spread a table that arrives in fewer pieces than there are cores.

    That is so for one small file with one row group. A large table has splits enough and is left
    alone, so no exchange is added at scale. The number of splits is looked up once per session.
    """
    if name not in HEAVY_TABLES:
        return df
    context = df.sparkSession.sparkContext
    key = (context.applicationId, folder, name)
    if key not in _splits:
        _splits[key] = df._jdf.queryExecution().toRdd().getNumPartitions()
    cores = context.defaultParallelism
    return df.repartition(cores) if _splits[key] < cores else df
