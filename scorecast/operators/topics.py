"""Topics and vectors: per-topic top-k, z-scores, dominant topic, one-hot,
cosine neighbours. The factorisation itself is in ``operators.nmf``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecast.functions import vectors as vx
from scorecast.operators.nmf import NMF, NMFModel  # noqa: F401


# --------------------------------------------------------------------------
# top-k per group, two stages (a hot group is spread over salt buckets first)

def top_k_per_group(df: DataFrame, group_cols, order_cols, k: int, salt_col: str | None = None,
                    salt_buckets: int = 64, rank_col: str = "rank") -> DataFrame:
    """The k first rows of each group under ``order_cols``.

    Stage 1 ranks inside (group, salt) buckets and keeps k rows per bucket;
    stage 2 ranks the at most k * salt_buckets survivors per group. A group
    holding a third of all rows is therefore cut down in parallel tasks
    before any single task sees it. ``order_cols`` must end with a unique
    tie key so the result is deterministic.
    """
    group_cols = list(group_cols)
    salt = F.xxhash64(F.col(salt_col) if salt_col else F.struct(*df.columns))
    s = df.withColumn("__salt", F.pmod(salt, F.lit(salt_buckets)))
    w1 = Window.partitionBy(*group_cols, "__salt").orderBy(*order_cols)
    s = s.withColumn("__r1", F.row_number().over(w1)).where(F.col("__r1") <= k)
    w2 = Window.partitionBy(*group_cols).orderBy(*order_cols)
    return (s.withColumn(rank_col, F.row_number().over(w2)).where(F.col(rank_col) <= k)
            .drop("__salt", "__r1"))


# --------------------------------------------------------------------------
# vector column statistics, z-scores, argmax, one-hot

def column_stats(df: DataFrame, vcol: str) -> tuple[list[float], list[float]]:
    """Per-component mean and population sd of an array column.

    ``posexplode`` + ``groupBy(pos)`` is a partial aggregate; only one row
    per component (bounded by the dimension) reaches the driver."""
    rows = (df.select(F.posexplode(vcol).alias("pos", "x")).groupBy("pos")
            .agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")).collect())
    rows = sorted(rows, key=lambda r: r["pos"])
    return [r["m"] for r in rows], [r["s"] for r in rows]


def zscores(df: DataFrame, vcol: str, out: str = "z") -> DataFrame:
    """Per-component z-scores (ddof = 0)."""
    m, s = column_stats(df, vcol)
    return df.withColumn(out, vx.zscore_literal(vcol, m, s))


def dominant(df: DataFrame, vcol: str, out: str = "topic") -> DataFrame:
    """A10: index of the largest component."""
    return df.withColumn(out, vx.argmax(vcol))


def levels(df: DataFrame, col: str) -> list:
    """T12 fit: the ascending levels of a column (null is none). They become
    column names, so they are few by nature."""
    return [r[0] for r in df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col).collect()]


def one_hot(df: DataFrame, col: str, values, prefix: str = "ohe_") -> DataFrame:
    """One indicator column per level of ``values`` (a list, e.g. from
    ``levels``, or a count k for 0..k-1); no level is dropped. Rows of another
    level, or null, hold zeros."""
    values = range(values) if isinstance(values, int) else values
    return df.select("*", *[F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{prefix}{v}") for v in values])


def top_rows_per_component(df: DataFrame, id_col: str, vcol: str, k: int = 3,
                           out_value: str = "value") -> DataFrame:
    """For every component j, the k rows with the largest value (ties by id)."""
    long = df.select(id_col, F.posexplode(vcol).alias("component", out_value))
    return top_k_per_group(long, ["component"], [F.col(out_value).desc(), F.col(id_col)], k,
                           salt_col=id_col)


def cosine_neighbours(df: DataFrame, id_col: str, vcol: str, query_id, k: int = 5,
                      digits: int = 9) -> DataFrame:
    """T14 + T15 + J6 + O4: rows most similar (cosine) to the row ``query_id``.

    The query vector is one row, fetched once and embedded as a literal, so
    scoring is a map over the table (no join, no cross join), followed by a
    TakeOrdered of k rows."""
    q = df.where(F.col(id_col) == F.lit(query_id)).select(vcol).first()
    if q is None:
        raise ValueError(f"no row with {id_col} = {query_id}")
    qv = [float(x) for x in q[0]]
    qn = sum(x * x for x in qv) ** 0.5
    qv = [x / qn for x in qv] if qn else qv
    sim = vx.dot_literal(vx.l2_normalize(vcol), qv)
    return (df.select(id_col, F.round(sim, digits).alias("similarity"))
            .orderBy(F.col("similarity").desc(), F.col(id_col)).limit(k))
