"""S3 + S11: apply a fitted matrix chunk by chunk, restartable.

Chunks are cut by a hash of the Id, so a chunk is the same rows in every run.
Each chunk is written to its own folder; a folder counts as done when Spark
has committed it (its ``_SUCCESS`` file), so after a kill the next call skips
the finished chunks, writes the half-written one anew and goes on. The union of
all chunks is the unchunked result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecast.operators.feature_matrix import FittedMatrix


def _done(spark: SparkSession, path: str) -> bool:
    """Whether a job has committed this folder (any file system Spark reads)."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def chunk_of(id_col: str, chunks: int):
    return F.expr(f"cast(pmod(xxhash64(`{id_col}`), {int(chunks)}) as int)")


def apply_in_chunks(rows: DataFrame, matrix_path: str, out_path: str, chunks: int) -> DataFrame:
    """(Id, feature, value) of all rows through the matrix saved at
    ``matrix_path``, one chunk at a time; chunks already in ``out_path`` are
    not made again. Returns the union of the chunks."""
    spark = rows.sparkSession
    matrix = FittedMatrix.load(spark, matrix_path)
    paths = [f"{out_path}/part-of-{chunks}-{i}" for i in range(chunks)]
    for i, path in enumerate(paths):
        if not _done(spark, path):
            matrix.transform(rows.where(chunk_of("Id", chunks) == i)).write.mode("overwrite").parquet(path)
    return spark.read.schema("Id long, feature string, value double").parquet(*paths)
