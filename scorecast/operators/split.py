"""Reproducible, exact splits, folds and samples by hash rank.

Every row gets a 60-bit hash of (seed, key). Within a stratum, rows are
ordered by (hash, key); a stratified split puts the first floor(f * n_s)
rows of each stratum into ``train``, k folds cut each stratum's order at
floor(j * n_s / k), and an exact sample of s rows keeps the s first rows.

A ``row_number`` window partitioned by stratum would send a whole stratum
(half of all rows for a binary label) to one task. Instead the cut points
are *selected* with a radix search over the hash: two grouped counts
(16-bit digits, partial aggregation, a few thousand rows per stratum) find
the bucket that holds each cut, and only the rows of those buckets
(about n / 2^32 each) reach the driver to fix the exact cut. Assignment is
then a comparison against a handful of literals: no shuffle at all.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HASH_HEX = 15  # 60 bits
_SHIFT1, _SHIFT2 = 44, 28
_MASK = 0xFFFF


def row_hash(key: str, seed: int | str) -> Column:
    """60-bit non-negative hash of ``seed:key`` (md5, first 15 hex digits)."""
    s = F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))
    return F.conv(F.substring(F.md5(s), 1, HASH_HEX), 16, 10).cast("long")


def stratum_key(strata: str) -> Column:
    """The stratum as a non-null string: null is a stratum like any other."""
    return F.coalesce(F.concat(F.lit("="), F.col(strata).cast("string")), F.lit("null"))


def _base(df: DataFrame, key: str, seed, strata: str | None) -> DataFrame:
    """The narrow (stratum, key, hash) projection every pass reads, cached
    once so the input's own lineage runs a single time."""
    s_col = stratum_key(strata) if strata else F.lit("")
    return df.select(s_col.alias("__s"), F.col(key).alias("__k"),
                     row_hash(key, seed).alias("__h")).persist(StorageLevel.MEMORY_AND_DISK)


def _strata_counts(base: DataFrame, strata: str | None) -> dict:
    rows = base.groupBy("__s").count().collect()
    if strata is None:
        return {None: sum(r[1] for r in rows)}
    return {r[0]: r[1] for r in rows}


def select_cuts(base: DataFrame, strata: str | None, targets: dict) -> dict:
    """For each stratum s and each rank t in ``targets[s]`` (1-based), return
    the (hash, key) of the row at rank t in (hash, key) order. ``base`` is
    the projection from ``_base``."""
    spark = base.sparkSession
    want = [(s if strata else "", t) for s, ts in targets.items() for t in ts if t > 0]
    if not want:
        return {}
    # ---- pass 1: top 16 bits
    c1 = (base.groupBy("__s", F.shiftright(F.col("__h"), _SHIFT1).alias("__d"))
          .agg(F.count(F.lit(1)).alias("__n")))
    w1 = Window.partitionBy("__s").orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)
    c1 = c1.withColumn("__cum", F.sum("__n").over(w1))
    tdf = spark.createDataFrame(want, "__s " + _stype(base) + ", __t long")
    b1 = (c1.join(F.broadcast(tdf), "__s")
          .where((F.col("__cum") - F.col("__n") < F.col("__t")) & (F.col("__t") <= F.col("__cum")))
          .select("__s", "__t", F.col("__d").alias("__d1"),
                  (F.col("__cum") - F.col("__n")).alias("__below")).collect())
    # ---- pass 2: next 16 bits inside the boundary buckets
    keys1 = sorted({(r["__s"], r["__d1"]) for r in b1})
    k1 = spark.createDataFrame(keys1, "__s " + _stype(base) + ", __d1 long")
    sub = base.withColumn("__d1", F.shiftright(F.col("__h"), _SHIFT1)).join(F.broadcast(k1), ["__s", "__d1"])
    c2 = (sub.groupBy("__s", "__d1", F.shiftright(F.col("__h"), _SHIFT2).bitwiseAND(F.lit(_MASK)).alias("__d"))
          .agg(F.count(F.lit(1)).alias("__n")))
    w2 = Window.partitionBy("__s", "__d1").orderBy("__d").rowsBetween(
        Window.unboundedPreceding, 0)
    c2 = c2.withColumn("__cum", F.sum("__n").over(w2)).collect()
    by_bucket = defaultdict(list)
    for r in c2:
        by_bucket[(r["__s"], r["__d1"])].append((r["__d"], r["__n"], r["__cum"]))
    b2 = []
    for r in b1:
        local = r["__t"] - r["__below"]
        for d, n, cum in by_bucket[(r["__s"], r["__d1"])]:
            if cum - n < local <= cum:
                b2.append((r["__s"], r["__t"], r["__d1"], d, r["__below"] + cum - n))
                break
    # ---- pass 3: the rows of each final bucket (about n / 2^32 per cut)
    keys2 = sorted({(s, d1, d2) for s, _, d1, d2, _ in b2})
    k2 = spark.createDataFrame(keys2, "__s " + _stype(base) + ", __d1 long, __d2 long")
    rows = (base.withColumn("__d1", F.shiftright(F.col("__h"), _SHIFT1))
            .withColumn("__d2", F.shiftright(F.col("__h"), _SHIFT2).bitwiseAND(F.lit(_MASK)))
            .join(F.broadcast(k2), ["__s", "__d1", "__d2"])
            .select("__s", "__d1", "__d2", "__h", "__k").collect())
    cand = defaultdict(list)
    for r in rows:
        cand[(r["__s"], r["__d1"], r["__d2"])].append((r["__h"], r["__k"]))
    for v in cand.values():
        v.sort()
    cuts = defaultdict(dict)
    for s, t, d1, d2, below in b2:
        cuts[s][t] = cand[(s, d1, d2)][t - below - 1]
    return {(s if strata else None): v for s, v in cuts.items()}


def _stype(base: DataFrame) -> str:
    return base.schema["__s"].dataType.simpleString()


def _le(h: Column, k: Column, cut) -> Column:
    ch, ck = cut
    return (h < F.lit(ch)) | ((h == F.lit(ch)) & (k <= F.lit(ck)))


def stratified_split(df: DataFrame, strata: str | None, train_frac: float, seed=44,
                     key: str = "Id", out: str = "split") -> DataFrame:
    """M1: exact per-stratum split, floor(train_frac * n_s) rows to 'train'."""
    base = _base(df, key, seed, strata)
    counts = _strata_counts(base, strata)
    targets = {s: [int(math.floor(train_frac * n))] for s, n in counts.items()}
    cuts = select_cuts(base, strata, targets)
    base.unpersist()
    h, k = row_hash(key, seed), F.col(key)
    cond = F.lit(False)
    for s, ts in targets.items():
        t = ts[0]
        if t <= 0:
            continue
        in_s = F.lit(True) if strata is None else (stratum_key(strata) == F.lit(s))
        cond = cond | (in_s & _le(h, k, cuts[s][t]))
    return df.withColumn(out, F.when(cond, F.lit("train")).otherwise(F.lit("test")))


def stratified_folds(df: DataFrame, strata: str | None, k: int = 5, seed=44,
                     key: str = "Id", out: str = "fold") -> DataFrame:
    """M2: fold 0..k-1; each stratum's (hash, key) order is cut at floor(j*n_s/k)."""
    if k < 2:
        raise ValueError("k must be at least 2")
    base = _base(df, key, seed, strata)
    counts = _strata_counts(base, strata)
    targets = {s: [j * n // k for j in range(1, k)] for s, n in counts.items()}
    cuts = select_cuts(base, strata, targets)
    base.unpersist()
    h, kc = row_hash(key, seed), F.col(key)
    fold = F.lit(0)
    for s, ts in targets.items():
        in_s = F.lit(True) if strata is None else (stratum_key(strata) == F.lit(s))
        part = F.lit(0)
        for t in ts:
            if t <= 0:
                part = part + F.lit(1)  # cut before the first row
            else:
                part = part + F.when(~_le(h, kc, cuts[s][t]), 1).otherwise(0)
        fold = F.when(in_s, part).otherwise(fold)
    return df.withColumn(out, fold.cast("int"))


def exact_sample(df: DataFrame, n: int, seed=44, key: str = "Id") -> DataFrame:
    """Exactly ``min(n, rows)`` rows, chosen uniformly by hash rank."""
    base = _base(df, key, seed, None)
    total = base.count()
    if n >= total or n <= 0:
        base.unpersist()
        return df if n >= total else df.limit(0)
    cut = select_cuts(base, None, {None: [n]})[None][n]
    base.unpersist()
    return df.where(_le(row_hash(key, seed), F.col(key), cut))


def bernoulli_draw(df: DataFrame, n_draws: int, n_rows: int, seed=44,
                   key: str = "Id") -> DataFrame:
    """Rows hit at least once by ``n_draws`` uniform draws with
    replacement, then made unique: each row is kept with probability
    1 - (1 - 1/n)^draws, decided by its own hash (no driver-side index list)."""
    if n_rows <= 0:
        return df.limit(0)
    p = 1.0 - (1.0 - 1.0 / n_rows) ** n_draws
    cut = int(p * (1 << 60))
    return df.where(row_hash(key, seed) < F.lit(cut))
