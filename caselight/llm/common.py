"""What the operators of this folder share: reading tables, tasks over Arrow batches, files all executors see."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from caselight.session import scratch_path, tune

# Batches are cut by rows and by bytes, so that a run of very long texts stays small in a Python worker.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Session options for these jobs; returns the same session."""
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)
    return tune(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_rows(
    df: DataFrame, schema: str, make: Callable[[], Callable[[pa.RecordBatch], dict[str, list] | list[dict[str, list]]]]
) -> DataFrame:
    """``make()`` runs once per task and gives the function from a batch to output columns.

    The function may also give a list (or generator) of such column sets, for outputs much larger than inputs.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            found = work(batch)
            for columns in [found] if isinstance(found, dict) else found:
                arrays = [pa.array(columns[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back: later branches see one and the same result,
    and a lost executor costs no more than the tasks it held."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_groups(
    df: DataFrame, keys: list[str], schema: str, make: Callable[[], Callable[[pa.Table], dict[str, list]]], least: int = 1
) -> DataFrame:
    """Rows of equal ``keys`` (whole numbers, no nulls) meet in one task and go to ``make()``'s function as a table.

    For many small groups: rows are hashed and sorted by key and streamed, without a call per group into Spark. Groups must
    be bounded by the caller; those under ``least`` rows are passed over. Key columns come first in the tables.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))
    rest = [c for c in df.columns if c not in keys]
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        held: list[pa.RecordBatch] = []
        last = None
        out: dict[str, list] = {f.name: [] for f in arrow}

        def close_group() -> None:
            if sum(b.num_rows for b in held) >= least:
                for name, values in work(pa.Table.from_batches(held)).items():
                    out[name].extend(values)

        def flush() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)
            for values in out.values():
                values.clear()
            return made

        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(n_keys)], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for start, end in zip(cuts, cuts[1:]):
                own = key[start].tolist()
                if held and own != last:
                    close_group()
                    held = []
                held.append(batch.slice(start, end - start))
                last = own
            if len(out[arrow.names[0]]) >= 4096:
                yield flush()
        if held:
            close_group()
        if out[arrow.names[0]]:
            yield flush()

    return df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of equally long lists of numbers as rows of doubles."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
