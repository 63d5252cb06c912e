"""Group-by summaries, table summaries, top-k and metric aggregates."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def group_sum(df: DataFrame, by, cols, prefix: str = "Sum") -> DataFrame:
    """A1: group-by sum of several measures (partial + final aggregation)."""
    return df.groupBy(*by).agg(*[F.sum(c).alias(f"{prefix}{c}") for c in cols])


def group_count(df: DataFrame, by, name: str = "profile_count") -> DataFrame:
    """A2: rows per group."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def having_count(df: DataFrame, by, threshold: int, name: str = "profile_count") -> DataFrame:
    """Groups whose row count is above ``threshold``."""
    return group_count(df, by, name).where(F.col(name) > threshold)


def top_k(df: DataFrame, order_cols, k: int, tie_cols=()) -> DataFrame:
    """The k first rows of an ordering, with a tie key so the
    result is deterministic (TakeOrderedAndProject: k rows per task)."""
    return df.orderBy(*order_cols, *tie_cols).limit(k)


def top_groups_by_count(df: DataFrame, key: str, k: int, name: str = "profile_count"):
    """O3: the k largest groups by row count (ties broken by key)."""
    return top_k(group_count(df, [key], name), [F.col(name).desc()], k, [F.col(key).asc()])


def exact_quantiles(df: DataFrame, cols, probs=(0.25, 0.5, 0.75),
                    accuracy: int = 10000) -> dict[str, list[float | None]]:
    """A5: exact quantiles (linear interpolation between two ranks) per column.

    Selection by brackets: a mergeable quantile sketch of the values still in
    question gives two values around each wanted rank, one exact count of the
    values below and at them says whether one of them has the rank, or between
    which values it lies; the rest is asked again. Each round keeps about
    4 / ``accuracy`` of the values (repeated values are settled at once), so
    10^12 rows take four rounds, all columns and ranks side by side, and no
    task holds more than sketches and counts. The counts alone decide: an
    inexact sketch costs rounds, never the result. Nulls are left out, NaN is
    the largest value; a column without values gives nulls.
    """
    cols = list(cols)
    if not cols:
        return {}
    src = df.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    sizes = src.agg(*[F.count(x).alias(x) for x in src.columns]).first()
    # per (column, rank from 0): [low, high, values up to low, values inside]
    open_, found = {}, {}
    for i in range(len(cols)):
        n = sizes[i]
        for p in probs if n else ():
            for r in {math.floor((n - 1) * p), math.ceil((n - 1) * p)}:
                open_[(i, r)] = (None, None, 0, n)

    def inside(i, low, high):
        x = F.col(f"x{i}")
        ok = x.isNotNull()
        if low is not None:
            ok = ok & (x > F.lit(low))
        if high is not None:
            ok = ok & (x < F.lit(high))
        return F.when(ok, x)

    while open_:
        todo = list(open_.items())
        asks = []
        for (i, r), (low, high, below, m) in todo:
            at, slack = (r - below + 0.5) / m, 2.0 / accuracy
            asks.append(F.percentile_approx(
                inside(i, low, high), [max(at - slack, 0.0), min(at + slack, 1.0)], accuracy))
        pairs = src.agg(*[a.alias(f"q{k}") for k, a in enumerate(asks)]).first()
        counts = []
        for k, ((i, r), (low, high, _, _)) in enumerate(todo):
            x = inside(i, low, high)
            for j, v in enumerate(pairs[k]):
                counts += [F.count(F.when(x < F.lit(v), 1)).alias(f"l{k}_{j}"),
                           F.count(F.when(x == F.lit(v), 1)).alias(f"e{k}_{j}")]
        got = src.agg(*counts).first()
        for k, ((i, r), (low, high, below, m)) in enumerate(todo):
            del open_[(i, r)]
            edge, start, end = low, below, below + m
            for j, v in enumerate(pairs[k]):
                first = below + got[f"l{k}_{j}"]
                if r < first:
                    high, end = v, first
                    break
                if r < first + got[f"e{k}_{j}"]:
                    found[(i, r)] = v
                    break
                edge, start = v, first + got[f"e{k}_{j}"]
            if (i, r) not in found:
                open_[(i, r)] = (edge, high, start, end - start)

    def interpolated(i: int, p: float) -> float | None:
        if not sizes[i]:
            return None
        pos = (sizes[i] - 1) * p
        lo, hi = math.floor(pos), math.ceil(pos)
        a, b = found[(i, lo)], found[(i, hi)]
        return a if a == b or lo == hi else (hi - pos) * a + (pos - lo) * b

    return {c: [interpolated(i, p) for p in probs] for i, c in enumerate(cols)}


def summary(df: DataFrame, cols, approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """A5: min, quartiles (linear interpolation), mean and max per numeric column.

    One aggregate computes one struct per column, then the structs are
    exploded to one row per column. Quartiles are exact (``exact_quantiles``),
    or with ``approx=True`` those of the mergeable quantile sketch.
    """
    exact = {} if approx else exact_quantiles(df, cols, accuracy=accuracy)
    structs = []
    for c in cols:
        x = F.col(c).cast("double")
        if approx:
            q = F.percentile_approx(x, [0.25, 0.5, 0.75], accuracy)
            q1, med, q3 = q.getItem(0), q.getItem(1), q.getItem(2)
        else:
            q1, med, q3 = (F.lit(v).cast("double") for v in exact[c])
        structs.append(F.struct(
            F.lit(c).alias("column"), F.min(x).alias("min"), q1.alias("q1"),
            med.alias("median"), F.avg(x).alias("mean"), q3.alias("q3"),
            F.max(x).alias("max"),
            F.count(F.when(F.col(c).isNull(), 1)).alias("n_null")))
    return (df.agg(F.array(*structs).alias("s"))
            .select(F.explode("s").alias("s")).select("s.*"))


def level_counts(df: DataFrame, col: str, k: int = 6, other: str = "(Other)") -> DataFrame:
    """A5 for categoricals: the k most frequent levels, the rest summed as ``other``.

    Top-k is a TakeOrdered over the per-level counts; the remainder is an
    anti join against the k-row table, so no single task sees all levels.
    """
    counts = df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    top = counts.orderBy(F.col("n").desc(), F.col(col).asc()).limit(k)
    # null-safe: a null level among the k must not come back in the rest
    rest = (counts.join(F.broadcast(top.select(F.col(col).alias("__top"))),
                        F.col(col).eqNullSafe(F.col("__top")), "left_anti")
            .agg(F.lit(other).alias("level"), F.sum("n").alias("n"))
            .where(F.col("n").isNotNull()))
    return top.select(F.col(col).cast("string").alias("level"), "n").unionByName(rest)


def rmse(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Mean squared error and its root, one row."""
    d = F.col(label).cast("double") - F.col(pred).cast("double")
    return df.agg(F.avg(d * d).alias("mse")).withColumn("rmse", F.sqrt("mse"))


def max_abs(df: DataFrame, cols) -> DataFrame:
    """Column max |x| (partial + final aggregation; mergeable)."""
    return df.agg(*[F.max(F.abs(F.col(c))).cast("double").alias(c) for c in cols])


def metric_mean_sd(df: DataFrame, by, metric: str) -> DataFrame:
    """Mean and population sd of a metric over folds per parameter set."""
    return df.groupBy(*by).agg(F.avg(metric).alias(f"{metric}_mean"),
                               F.stddev_pop(metric).alias(f"{metric}_std"))
