"""Fixed-step resampling, calendar gap fill, trailing rolling summaries,
lagged features and their merge back onto the rows.

Plan shape (global series): scan -> project -> partial/final ``groupBy(bin)``
(one row per bin leaves each map task) -> left join onto a ``range`` calendar
-> window over blocks of the calendar (K rows, K = span / step, independent of
the row count) -> broadcast hash join of the K-row result onto the rows. The only
shuffle of the big side is none: it is probed against the broadcast table.

Per-group series partition the calendar and the window by the group key;
their size is bounded by groups x bins, never by rows per group, so a hot
group does not put its rows into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scorecast.functions.time import (
    DAY, align_up, bin_index, nearest_label_index, seconds_to_ts, step_seconds,
)
from scorecast.operators.joins import broadcast_if_bounded, clamp
from scorecast.session import scratch_path

ROLL_FUNCS = {
    "mean": F.avg, "avg": F.avg, "sum": F.sum, "min": F.min, "max": F.max,
    "sd": F.stddev_samp, "stddev": F.stddev_samp, "count": F.count,
}
BLOCK_BINS = 4096  # bins of a calendar that one window task sorts


def require_cols(cols) -> list[str]:
    """At least one input column is required."""
    cols = list(cols or [])
    if not cols:
        raise ValueError("cols is empty: name the columns to aggregate")
    return cols


def time_bounds(df: DataFrame, time_col: str = "Time") -> tuple[int, int] | None:
    """(min, max) of a time column: one aggregate job, one row to the driver."""
    r = df.agg(F.min(time_col).alias("lo"), F.max(time_col).alias("hi")).first()
    if r is None or r["lo"] is None:
        return None
    return int(r["lo"]), int(r["hi"])


def grid_origin(lo: int, anchor) -> int:
    """Origin of the bin grid: 'first_day' = midnight of the first day,
    'epoch' = 0, or an explicit integer offset in seconds."""
    if anchor == "first_day":
        return (lo // DAY) * DAY
    if anchor == "epoch":
        return 0
    return int(anchor)


def resample(df: DataFrame, cols, time_col: str = "Time", step: int = 604800,
             anchor="first_day", agg: str = "sum", fill=0, by=None,
             bounds: tuple[int, int] | None = None) -> DataFrame:
    """A3/A4 + J5: fixed-step resample, left-closed bins labelled by their right edge.

    Returns ``by + [bin, bin_end, <cols>]``: ``bin`` is the 0-based bin index
    on the grid, ``bin_end`` the right-edge label in epoch seconds. Empty bins
    between the first and last non-empty one are filled with ``fill``
    (``None`` leaves them out). Global series use one grid anchored at
    ``anchor``; grouped series (``by``) use an epoch-anchored grid and a
    calendar per group from its own first to last bin.
    """
    cols = require_cols(cols)
    by = list(by or [])
    if agg not in ("sum", "mean", "avg", "min", "max", "count"):
        raise ValueError(f"unsupported resample aggregate {agg!r}")
    fn = ROLL_FUNCS[agg]
    if by and anchor == "first_day":
        anchor = "epoch"
    if bounds is None and not by:
        bounds = time_bounds(df, time_col)
    origin = grid_origin(bounds[0], anchor) if bounds else 0
    binned = (df.select(*by, F.col(time_col), *cols)
              .withColumn("bin", bin_index(time_col, origin, step))
              .groupBy(*by, "bin")
              .agg(*[fn(c).alias(c) for c in cols]))
    if fill is not None:
        if not by:
            if bounds is None:
                return binned.limit(0).withColumn("bin_end", F.lit(None).cast("long"))
            b_lo = (bounds[0] - origin) // step
            b_hi = (bounds[1] - origin) // step
            n_bins = b_hi - b_lo + 1
            cal = df.sparkSession.range(b_lo, b_hi + 1).withColumnRenamed("id", "bin")
            binned = cal.join(broadcast_if_bounded(binned, n_bins, 16 + 8 * len(cols)),
                              "bin", "left")
        else:
            cal = (binned.groupBy(*by).agg(F.min("bin").alias("lo"), F.max("bin").alias("hi"))
                   .select(*by, F.explode(F.sequence("lo", "hi")).alias("bin")))
            binned = cal.join(binned, by + ["bin"], "left")
        binned = binned.select(*by, "bin", *[F.coalesce(F.col(c), F.lit(fill)).alias(c)
                                             for c in cols])
    return binned.withColumn("bin_end", (F.lit(origin) + (F.col("bin") + 1) * F.lit(step))
                             .cast("long")).select(*by, "bin", "bin_end", *cols)


def rolling(binned: DataFrame, cols, window: int = 4, func: str = "mean", lag: int = 0,
            by=None, order_col: str = "bin", suffix: str = "", drop_incomplete: bool = False,
            block_bins: int = BLOCK_BINS) -> DataFrame:
    """Trailing ``func`` over ``window`` bins, lagged by ``lag`` bins.

    The value at bin i summarises bins i-window-lag+1 .. i-lag and is null
    until that many bins exist. A range frame over the integer bin index
    makes the frame count bins, not rows. ``drop_incomplete`` removes the
    leading rows instead of leaving nulls (``rollapply`` without fill).

    The calendar is cut into blocks of ``block_bins`` bins; the bins a block
    looks back on are dealt to it as well and leave it again behind the
    window. So no task holds the calendar, and a series that holds most rows
    is spread over its blocks.
    """
    cols = require_cols(cols)
    if func not in ROLL_FUNCS:
        raise ValueError(f"unknown summary function {func!r}; use one of {sorted(ROLL_FUNCS)}")
    fn = ROLL_FUNCS[func]
    by = list(by or [])
    reach = window - 1 + lag
    size = max(block_bins, reach, 1)
    at = F.col(order_col)
    own = F.floor(at / size).cast("long")
    # the last ``reach`` bins of a block are what the next block looks back on
    halo = F.pmod(at, F.lit(size)) >= size - reach
    dealt = binned.withColumn("__block", F.explode(
        F.when(halo, F.array(own, own + 1)).otherwise(F.array(own))))
    w = (Window.partitionBy(*by, "__block").orderBy(order_col)
         .rangeBetween(-reach, -lag))
    n = F.count(F.lit(1)).over(w)
    out = dealt.select(
        "*", *[F.when(n == window, fn(F.col(c)).over(w)).cast("double").alias(c + suffix)
               for c in cols])
    out = out.where(F.col("__block") == own).drop("__block")
    if drop_incomplete:
        out = out.where(F.col(cols[0] + suffix).isNotNull())
    return out


def rolling_nearest_features(df: DataFrame, cols, time_col: str = "Time",
                             step: int = 604800, window: int = 4, lag: int = 1,
                             func: str = "mean", suffix: str = "RollingAverage",
                             anchor="first_day", keep_time_col: str = "date_time",
                             ) -> DataFrame:
    """Resample -> gap fill -> lagged rolling summary -> nearest as-of merge.

    Each row gets the rolling values of the bin whose right-edge label is
    nearest to its time (ties go to the later label; times before the first
    or after the last label take the first or last bin). The bin table has
    K = span/step rows and is broadcast behind that bound.
    """
    cols = require_cols(cols)
    bounds = time_bounds(df, time_col)
    if bounds is None:
        return df.select("*", *[F.lit(None).cast("double").alias(c + suffix) for c in cols])
    origin = grid_origin(bounds[0], anchor)
    n_bins = (bounds[1] - origin) // step + 1
    binned = resample(df, cols, time_col, step, origin, "sum", 0, bounds=bounds)
    rolled = rolling(binned, cols, window, func, lag, suffix=suffix).select(
        (F.col("bin") + 1).alias("__j"), *[c + suffix for c in cols])
    j = clamp(nearest_label_index(time_col, origin, step), 1, n_bins)
    out = df.withColumn("__j", j).join(
        broadcast_if_bounded(rolled, n_bins, 16 + 8 * len(cols)), "__j", "left").drop("__j")
    if keep_time_col:
        out = out.withColumn(keep_time_col, seconds_to_ts(time_col))
    return out


def _looked_at(sums: DataFrame, cols, step: int, reach: int, by: list[str]) -> DataFrame:
    """The bins of each group's calendar that a row looks at: its own one and
    the ``reach`` before it, from the group's first bin on, empty ones filled
    with zeros; ``__filled`` is the group's number of non-empty bins. A row's
    aligned time is its own bin's label, so the rest of the calendar meets no
    row: the bins grow with the rows, not with groups x span.

    ``sums``: the non-empty bins, made once and written."""
    path = scratch_path(sums.sparkSession, "group-bins")
    sums.where(F.col("bin").isNotNull()).select(*by, "bin", *cols).write.parquet(path)
    sums = sums.sparkSession.read.parquet(path)
    known = sums.groupBy(*by).agg(F.min("bin").alias("__lo"), F.count(F.lit(1)).alias("__filled"))
    near = F.sequence(F.greatest(F.col("__lo"), F.col("bin") - reach), F.col("bin"))
    # the sums are dealt with the bins they fill, so one aggregate makes both
    dealt = sums.join(known, by).select(*by, "__filled", F.explode(near).alias("__bin"), F.col("bin").alias("__own"), *cols)
    own = F.col("__own") == F.col("__bin")
    binned = dealt.groupBy(*by, "__filled", F.col("__bin").alias("bin")).agg(
        *[F.coalesce(F.max(F.when(own, F.col(c))), F.lit(0)).alias(c) for c in cols])
    return binned.withColumn("bin_end", ((F.col("bin") + 1) * F.lit(step)).cast("long"))


def rolling_merge(df: DataFrame, cols, time_col: str = "Time", step_unit: str = "weeks",
                  step_value: int = 1, func: str = "mean", window: int = 4, by=None,
                  ) -> DataFrame:
    """W4/W5/W6 (+J2, J5, W7): rolling summary lagged one bin, merged back by aligned time.

    Each row's time is aligned strictly up to the next multiple of the step
    (W7); bins carry the same label, the calendar is gap-filled with zeros (a
    group's as far back as its rows look),
    the trailing ``func`` over ``window`` bins is lagged one bin, and the
    result is left-joined on (group, aligned label) (J2). Groups with fewer
    than ``window`` non-empty bins get null features (W6). New columns are
    named ``<col>_roll_<window>_<step_unit>``.
    """
    cols = require_cols(cols)
    by = list(by or [])
    step = step_seconds(step_value, step_unit)
    names = [f"{c}_roll_{window}_{step_unit}" for c in cols]
    # bins on the epoch grid; label = aligned time = (floor(t/step)+1)*step.
    # "__rows" counts the rows of each bin for the short-history guard.
    src = df.select(*by, time_col, *cols, F.lit(1).alias("__rows"))
    filled = F.count(F.when(F.col("__rows") > 0, 1))
    if by:
        binned = _looked_at(resample(src, cols + ["__rows"], time_col, step, "epoch", "sum", None, by=by),
                            cols, step, window, by)
        enough = F.col("__filled") >= window
    else:
        binned = resample(src, cols + ["__rows"], time_col, step, "epoch", "sum", 0, bounds=time_bounds(df, time_col))
        enough = binned.agg(filled).scalar() >= window
    rolled = rolling(binned, cols, window, func, lag=1, by=by, suffix="__r")
    rolled = rolled.select(*by, F.col("bin_end").alias("__aligned"),
                           *[F.when(enough, F.col(c + "__r")).alias(n)
                             for c, n in zip(cols, names)])
    out = df.withColumn("__aligned", align_up(time_col, step))
    return out.join(rolled, by + ["__aligned"], "left").drop("__aligned")


def aligned_sum(df: DataFrame, cols, time_col: str = "Time", step_unit: str = "weeks",
                step_value: int = 1, by=None) -> DataFrame:
    """A4 + W7: sums between period endpoints on the epoch grid, labelled by
    the aligned (next multiple of the step) time, gap-filled with zeros."""
    step = step_seconds(step_value, step_unit)
    by = list(by or [])
    out = resample(df, cols, time_col, step, "epoch", "sum", 0, by=by)
    return out.withColumnRenamed("bin_end", "aligned_time").drop("bin")
