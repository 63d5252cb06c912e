"""Join helpers: size-checked broadcast, key-set filters, as-of joins.

Broadcasting is only ever applied to a side whose row count is known (from
a bound computed before the join) and whose estimated size is below the
session's broadcast threshold; everything else is left to the planner
(sort-merge / shuffled hash join, with AQE converting to a broadcast join at
runtime when the measured size turns out small and splitting skewed
partitions).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DEFAULT_LIMIT = 64 * 1024 * 1024


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    try:
        v = int(str(conf).lower().rstrip("b"))
    except ValueError:
        v = 10 * 1024 * 1024
    return v if v > 0 else 0


def broadcast_if_bounded(df: DataFrame, max_rows: int, row_bytes: int = 64,
                         limit: int | None = None) -> DataFrame:
    """Broadcast ``df`` only when ``max_rows * row_bytes`` fits the threshold.

    ``max_rows`` must be a proven upper bound on the row count (e.g. the
    number of calendar bins between two known times), not a guess.
    """
    cap = broadcast_limit(df) if limit is None else limit
    if cap and max_rows * row_bytes <= max(cap, 0):
        return F.broadcast(df)
    return df


ROWS_PER_BLOCK = 100_000  # of both sides of an as-of join, on average


def left_join(left: DataFrame, right: DataFrame, on) -> DataFrame:
    """Left outer equi-join on key column(s)."""
    return left.join(right, on, "left")


def keep_keys(df: DataFrame, keys: DataFrame, on: str = "Id") -> DataFrame:
    """Rows whose key is in ``keys`` (left semi join)."""
    return df.join(keys.select(on), on, "left_semi")


def drop_keys(df: DataFrame, keys: DataFrame, on: str = "Id") -> DataFrame:
    """P10: rows whose key is not in ``keys`` (left anti join)."""
    return df.join(keys.select(on), on, "left_anti")


def key_faults(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, n_left, n_right) of every key that is not exactly once on
    either side (null counts as a key that joins nothing). One grouped count
    over both sides' keys; a hot key is counted per task first."""
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    keys = left.select(key, one.alias("l"), none.alias("r")).unionByName(right.select(key, none.alias("l"), one.alias("r")))
    n = keys.groupBy(key).agg(F.sum("l").alias("n_left"), F.sum("r").alias("n_right"))
    return n.where((F.col("n_left") != 1) | (F.col("n_right") != 1) | F.col(key).isNull())


def concat_by_key(left: DataFrame, right: DataFrame, key: str, strict: bool = True, shown: int = 5) -> DataFrame:
    """The columns of two tables side by side, matched by key and proved
    one to one. ``strict`` raises if a key is missing or doubled on a side
    (naming the first few); otherwise such keys are left out, and
    ``key_faults`` lists them. Columns that both tables have are refused."""
    clash = {c.lower() for c in left.columns if c != key} & {c.lower() for c in right.columns if c != key}
    if clash:
        raise ValueError(f"both tables have columns {sorted(clash)}")
    faults = key_faults(left, right, key)
    if strict:
        first = faults.orderBy(key).limit(shown).collect()
        if first:
            raise ValueError("keys not exactly once on both sides: " + ", ".join(
                f"{r[key]} ({r['n_left']}, {r['n_right']})" for r in first))
        return left.join(right, key)
    return left.join(faults.select(key), key, "left_anti").join(right, key)


def asof_join(left: DataFrame, right: DataFrame, time_col: str, by: list[str] | None = None,
              direction: str = "backward", value_cols: list[str] | None = None,
              block: int | None = None, tie_col: str | None = None) -> DataFrame:
    """As-of join of ``right``'s values onto every ``left`` row.

    Right rows of one entity with equal times count once: the one with the
    largest ``tie_col`` (without it, the largest values in column order), so
    the result does not depend on the input's layout. Right rows without a
    time match nothing; a left row without a time gets null values.
    ``block`` is the width of the time blocks; by default the time span is cut
    so that a block holds about ``ROWS_PER_BLOCK`` rows of both sides on
    average.

    ``direction``: 'backward' (last right row with time <= left time),
    'forward' (first right row with time >= left time) or 'nearest'
    (smaller distance; ties go to the later right row).

    Plan: both sides are unioned into one tagged table and the value is
    carried with ``last``/``first(ignorenulls)`` windows. Windows are
    partitioned by the entity key *and* a coarse time block so a hot entity
    is spread over many tasks; the value that must cross a block boundary is
    taken from a per-block summary (one row per entity and block) carried
    forward by a second, small window. No range or cross join is used.
    """
    if direction not in ("backward", "forward", "nearest"):
        raise ValueError("direction must be backward, forward or nearest")
    by = list(by or [])
    value_cols = list(value_cols or [c for c in right.columns if c not in by + [time_col]])
    right = _one_per_time(right, time_col, by, value_cols, tie_col)
    block = block or _default_block(left, right, time_col)
    if direction == "nearest":
        back = _asof_one(right, time_col, by, "backward", value_cols, block, left, extra_prefix="")
        fwd = _asof_one(right, time_col, by, "forward", value_cols, block,
                        back, extra_prefix="__f_")
        # fwd holds back's columns plus __f_ values/time; choose the closer side
        b_dist = F.col(time_col) - F.col("__asof_time")
        f_dist = F.col("__f___asof_time") - F.col(time_col)
        take_f = (F.col("__asof_time").isNull()
                  | (F.col("__f___asof_time").isNotNull() & (f_dist <= b_dist)))
        out = fwd
        for c in value_cols:
            out = out.withColumn(c, F.when(take_f, F.col(f"__f_{c}")).otherwise(F.col(c)))
        return out.drop("__asof_time", "__f___asof_time", *[f"__f_{c}" for c in value_cols])
    out = _asof_one(right, time_col, by, direction, value_cols, block, left, extra_prefix="")
    return out.drop("__asof_time")


def _one_per_time(right: DataFrame, time_col: str, by: list[str], value_cols: list[str],
                  tie_col: str | None) -> DataFrame:
    vals = F.struct(*[F.col(c) for c in value_cols])
    pick = F.max_by(vals, F.struct(F.col(tie_col), vals)) if tie_col else F.max(vals)
    return (right.where(F.col(time_col).isNotNull()).groupBy(*by, time_col).agg(pick.alias("__v"))
            .select(*by, time_col, *[F.col(f"__v.{c}").alias(c) for c in value_cols]))


def _default_block(left: DataFrame, right: DataFrame, time_col: str) -> int:
    r = (left.select(time_col).unionByName(right.select(time_col))
         .agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi"), F.count(F.lit(1)).alias("n")).first())
    if r["lo"] is None:
        return 1
    return max(1, -(-int(r["hi"] - r["lo"] + 1) // max(1, -(-r["n"] // ROWS_PER_BLOCK))))


def _asof_one(right: DataFrame, time_col: str, by: list[str], direction: str,
              value_cols: list[str], block: int | None, left: DataFrame,
              extra_prefix: str) -> DataFrame:
    p = extra_prefix
    vals = value_cols + ["__asof_time"]
    r = right.select(*by, F.col(time_col).alias("__t"),
                     *[F.col(c).alias(f"{p}{c}") for c in value_cols],
                     F.col(time_col).alias(f"{p}__asof_time"),
                     F.lit(0).alias("__side"))
    lcols = left.columns
    l_ = left.select(*[F.col(c) for c in lcols], F.col(time_col).alias("__t"),
                     F.lit(1).alias("__side"))
    pv = [f"{p}{c}" for c in vals]
    u = l_.unionByName(r, allowMissingColumns=True)
    # right rows sort before left rows at equal time for backward, after for forward
    u = u.withColumn("__blk", F.floor(F.col("__t") / F.lit(block)).cast("long"))
    part = by + ["__blk"]
    if direction == "backward":
        w = (Window.partitionBy(*part).orderBy(F.col("__t").asc(), F.col("__side").asc())
             .rowsBetween(Window.unboundedPreceding, 0))
        pick = F.last
    else:
        w = (Window.partitionBy(*part).orderBy(F.col("__t").asc(), F.col("__side").desc())
             .rowsBetween(0, Window.unboundedFollowing))
        pick = F.first
    st = F.struct(*[F.col(c) for c in pv]).alias("__s")
    u = u.withColumn("__s", F.when(F.col("__side") == 0, st))
    u = u.withColumn("__s", pick("__s", ignorenulls=True).over(w))
    # per (entity, block) summary of the boundary value, carried across blocks
    edge = F.max_by if direction == "backward" else F.min_by
    summ = (u.where(F.col("__side") == 0)
            .groupBy(*part)
            .agg(edge(F.struct(*[F.col(c) for c in pv]), F.col("__t")).alias("__e")))
    # every left block takes the edge value of the nearest right block
    # before (backward) or after (forward) it; one row per entity and block
    blocks = u.where(F.col("__side") == 1).select(*part).distinct()
    allb = _null_safe_join(blocks, summ, part, "full")
    ow = Window.partitionBy(*by).orderBy("__blk")
    if direction == "backward":
        carry = F.last("__e", ignorenulls=True).over(
            ow.rowsBetween(Window.unboundedPreceding, -1))
    else:
        carry = F.first("__e", ignorenulls=True).over(
            ow.rowsBetween(1, Window.unboundedFollowing))
    allb = allb.withColumn("__carry", carry)
    u = _null_safe_join(u, allb.select(*part, "__carry"), part, "left")
    u = u.withColumn("__s", F.coalesce("__s", "__carry")).drop("__carry")
    res = u.where(F.col("__side") == 1)
    return res.select(*[F.col(c) for c in lcols],
                      *[F.when(F.col("__t").isNotNull(), F.col(f"__s.{c}")).alias(c) for c in pv])


def _null_safe_join(a: DataFrame, b: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi-join where null keys equal each other (a null entity is an entity)."""
    r = b.select(*[F.col(c).alias(f"__r_{c}") for c in on], *[c for c in b.columns if c not in on])
    cond = F.lit(True)
    for c in on:
        cond = cond & F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    out = a.join(r, cond, how)
    for c in on:
        if how == "full":
            out = out.withColumn(c, F.coalesce(F.col(c), F.col(f"__r_{c}")))
        out = out.drop(f"__r_{c}")
    return out


def clamp(c: Column, lo, hi) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))
