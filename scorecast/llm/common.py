"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from scorecast.session import scratch_path

# Rows of text that travel to a Python worker at once: bounds a batch's memory
# when many very long texts meet.
TEXT_ROWS_PER_BATCH = 512


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for operators that carry whole texts."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > TEXT_ROWS_PER_BATCH:
        spark.conf.set(key, str(TEXT_ROWS_PER_BATCH))


def written(df: DataFrame, name: str, partition_by: str | None = None, compression: str | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder, read back.

    Cuts the lineage: a lost executor re-reads files that every machine sees.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
    schema = df.schema
    return spark.read.schema(schema).parquet(path)


def arrow_map(df: DataFrame, schema: str | StructType,
              fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> DataFrame:
    """``mapInArrow`` for operators that carry texts (bounded batches)."""
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


def free_name(taken: list[str], base: str) -> str:
    """A column name that no input column has (case-insensitively)."""
    low = {c.lower() for c in taken}
    name = base
    while name.lower() in low:
        name = "_" + name
    return name


def utf8(col: str):
    """A text column as bytes, null as empty."""
    return F.coalesce(F.col(col).cast("binary"), F.expr("cast('' as binary)"))
