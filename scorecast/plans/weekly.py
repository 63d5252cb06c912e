"""Time-series queries on the order-level helpfulness view (E1 family)."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecast.functions.time import WEEK, seconds_to_ts
from scorecast.operators import timeseries as ts
from scorecast.plans.sqlviews import HELPFULNESS, SHIPMENTS, with_
from scorecast.sources.views import helpfulness, shipments

HCOLS = ["HelpfulnessNumerator", "HelpfulnessDenominator"]


def weekly_rolling_features(spark, sf_dir):
    """Weekly resample (first-day anchor, right label, zero fill), 4-week
    trailing mean lagged one week, merged onto every order by nearest label."""
    return ts.rolling_nearest_features(helpfulness(spark, sf_dir), HCOLS, "Time", WEEK, 4, 1)


_E1_SQL = with_(HELPFULNESS, """
b AS (SELECT (min(Time) // 86400) * 86400 AS t0, max(Time) AS t1 FROM helpfulness),
cal AS (SELECT range AS bin FROM range(0, (SELECT (t1 - t0) // 604800 + 1 FROM b))),
s AS (SELECT (Time - t0) // 604800 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d FROM helpfulness, b GROUP BY 1),
f AS (SELECT cal.bin, coalesce(n, 0) AS n, coalesce(d, 0) AS d FROM cal LEFT JOIN s USING (bin)),
r AS (SELECT bin + 1 AS j,
        CASE WHEN count(*) OVER w = 4 THEN avg(n) OVER w END AS nr,
        CASE WHEN count(*) OVER w = 4 THEN avg(d) OVER w END AS dr
      FROM f WINDOW w AS (ORDER BY bin ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))
""") + """
SELECT h.Id, h.UserId, h.Time, h.HelpfulnessNumerator, h.HelpfulnessDenominator,
       r.nr AS HelpfulnessNumeratorRollingAverage, r.dr AS HelpfulnessDenominatorRollingAverage,
       TIMESTAMP '1970-01-01' + to_seconds(h.Time) AS date_time
FROM helpfulness h, b
JOIN r ON r.j = least(greatest(CAST(floor((2 * (h.Time - b.t0) + 604800) / (2 * 604800)) AS BIGINT), 1),
                      (b.t1 - b.t0) // 604800 + 1)
"""

QUERIES = {"E1_weekly_rolling_features": weekly_rolling_features}
ORACLES = {"E1_weekly_rolling_features": _E1_SQL}


# --------------------------------------------------------------------------
# Weekly resample with calendar gap fill
def a3_resample_weekly(spark, sf_dir):
    """A3 + J5: weekly sums, first-day anchor, right-edge label, empty weeks = 0."""
    out = ts.resample(helpfulness(spark, sf_dir), HCOLS, "Time", WEEK, "first_day", "sum", 0)
    return out.select(seconds_to_ts("bin_end").alias("date_time"), *HCOLS)


_A3_SQL = with_(HELPFULNESS, """
b AS (SELECT (min(Time) // 86400) * 86400 AS t0, max(Time) AS t1 FROM helpfulness),
cal AS (SELECT range AS bin FROM range(0, (SELECT (t1 - t0) // 604800 + 1 FROM b))),
s AS (SELECT (Time - t0) // 604800 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d FROM helpfulness, b GROUP BY 1)
""") + """
SELECT TIMESTAMP '1970-01-01' + to_seconds(b.t0 + (cal.bin + 1) * 604800) AS date_time,
       CAST(coalesce(n, 0) AS BIGINT) AS HelpfulnessNumerator,
       CAST(coalesce(d, 0) AS BIGINT) AS HelpfulnessDenominator
FROM cal LEFT JOIN s USING (bin), b
"""


def a3_resample_shipments(spark, sf_dir):
    """A3 on line items: weekly quantity and price (integer cents) sums."""
    out = ts.resample(shipments(spark, sf_dir), ["Quantity", "PriceCents"], "Time", WEEK,
                      "first_day", "sum", 0)
    return out.select(seconds_to_ts("bin_end").alias("date_time"), "Quantity", "PriceCents")


_A3S_SQL = with_(SHIPMENTS, """
b AS (SELECT (min(Time) // 86400) * 86400 AS t0, max(Time) AS t1 FROM shipments),
cal AS (SELECT range AS bin FROM range(0, (SELECT (t1 - t0) // 604800 + 1 FROM b))),
s AS (SELECT (Time - t0) // 604800 AS bin, sum(Quantity) AS q, sum(PriceCents) AS p
      FROM shipments, b GROUP BY 1)
""") + """
SELECT TIMESTAMP '1970-01-01' + to_seconds(b.t0 + (cal.bin + 1) * 604800) AS date_time,
       CAST(coalesce(q, 0) AS BIGINT) AS Quantity, CAST(coalesce(p, 0) AS BIGINT) AS PriceCents
FROM cal LEFT JOIN s USING (bin), b
"""


# Trailing mean, and the same lagged by one bin
def w1_trailing_mean(spark, sf_dir):
    """4-bin trailing mean of weekly shipment sums, null until 4 bins exist."""
    b = ts.resample(shipments(spark, sf_dir), ["Quantity", "PriceCents"], "Time", WEEK)
    r = ts.rolling(b, ["Quantity", "PriceCents"], 4, "mean", lag=0, suffix="_mean4")
    return r.select(seconds_to_ts("bin_end").alias("date_time"), "Quantity_mean4",
                    "PriceCents_mean4")


def w2_lagged_mean(spark, sf_dir):
    """The 4-bin trailing mean shifted one bin (no leakage of the current bin)."""
    b = ts.resample(shipments(spark, sf_dir), ["Quantity", "PriceCents"], "Time", WEEK)
    r = ts.rolling(b, ["Quantity", "PriceCents"], 4, "mean", lag=1, suffix="_lag_mean4")
    return r.select(seconds_to_ts("bin_end").alias("date_time"), "Quantity_lag_mean4",
                    "PriceCents_lag_mean4")


def _roll_sql(lo, hi, suffix):
    return with_(SHIPMENTS, """
b AS (SELECT (min(Time) // 86400) * 86400 AS t0, max(Time) AS t1 FROM shipments),
cal AS (SELECT range AS bin FROM range(0, (SELECT (t1 - t0) // 604800 + 1 FROM b))),
s AS (SELECT (Time - t0) // 604800 AS bin, sum(Quantity) AS q, sum(PriceCents) AS p
      FROM shipments, b GROUP BY 1),
f AS (SELECT cal.bin, coalesce(q, 0) AS q, coalesce(p, 0) AS p FROM cal LEFT JOIN s USING (bin))
""") + f"""
SELECT TIMESTAMP '1970-01-01' + to_seconds(b.t0 + (bin + 1) * 604800) AS date_time,
       CASE WHEN count(*) OVER w = 4 THEN avg(q) OVER w END AS Quantity{suffix},
       CASE WHEN count(*) OVER w = 4 THEN avg(p) OVER w END AS PriceCents{suffix}
FROM f, b WINDOW w AS (ORDER BY bin ROWS BETWEEN {lo} PRECEDING AND {hi})
"""


# R-style rolling summary (epoch grid, aligned labels, incomplete rows dropped)
def w3_rolling_summary(spark, sf_dir):
    """Weekly sums on the epoch grid labelled by aligned time, rolling
    4-bin mean without fill (the first 3 bins are dropped)."""
    h = helpfulness(spark, sf_dir)
    b = ts.resample(h, HCOLS, "Time", WEEK, "epoch", "sum", 0)
    r = ts.rolling(b, HCOLS, 4, "mean", lag=0, suffix="_r", drop_incomplete=True)
    return r.select(seconds_to_ts("bin_end").alias("Index"),
                    *[F.col(c + "_r").alias(c) for c in HCOLS])


_W3_SQL = with_(HELPFULNESS, """
s AS (SELECT Time // 604800 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d FROM helpfulness GROUP BY 1),
cal AS (SELECT range AS bin FROM range((SELECT min(bin) FROM s), (SELECT max(bin) + 1 FROM s))),
f AS (SELECT cal.bin, coalesce(n, 0) AS n, coalesce(d, 0) AS d FROM cal LEFT JOIN s USING (bin)),
r AS (SELECT bin, count(*) OVER w AS c, avg(n) OVER w AS n4, avg(d) OVER w AS d4
      FROM f WINDOW w AS (ORDER BY bin ROWS BETWEEN 3 PRECEDING AND CURRENT ROW))
""") + """
SELECT TIMESTAMP '1970-01-01' + to_seconds((bin + 1) * 604800) AS Index,
       n4 AS HelpfulnessNumerator, d4 AS HelpfulnessDenominator
FROM r WHERE c = 4
"""


# W4 (+J2, J5, W6, W7): rolling merge, global
def w4_rolling_merge(spark, sf_dir):
    """Lagged 4-week mean merged back onto every order by aligned week."""
    return ts.rolling_merge(helpfulness(spark, sf_dir), HCOLS, "Time", "weeks", 1, "mean", 4)


_W4_SQL = with_(HELPFULNESS, """
s AS (SELECT Time // 604800 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d, count(*) AS rws FROM helpfulness GROUP BY 1),
cal AS (SELECT range AS bin FROM range((SELECT min(bin) FROM s), (SELECT max(bin) + 1 FROM s))),
f AS (SELECT cal.bin, coalesce(n, 0) AS n, coalesce(d, 0) AS d, coalesce(rws, 0) AS rws
      FROM cal LEFT JOIN s USING (bin)),
g AS (SELECT count(*) FILTER (WHERE rws > 0) AS ne FROM f),
r AS (SELECT (bin + 1) * 604800 AS aligned,
        CASE WHEN count(*) OVER w = 4 THEN avg(n) OVER w END AS nr,
        CASE WHEN count(*) OVER w = 4 THEN avg(d) OVER w END AS dr
      FROM f WINDOW w AS (ORDER BY bin ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))
""") + """
SELECT h.*, CASE WHEN g.ne >= 4 THEN r.nr END AS HelpfulnessNumerator_roll_4_weeks,
       CASE WHEN g.ne >= 4 THEN r.dr END AS HelpfulnessDenominator_roll_4_weeks
FROM helpfulness h CROSS JOIN g
LEFT JOIN r ON r.aligned = (h.Time // 604800 + 1) * 604800
"""


# W5 (+W6): the same per user, calendar per user, guard on short histories
def w5_rolling_merge_by_user(spark, sf_dir):
    """W5 + W6: per-user weekly calendars, lagged 4-week mean merged back;
    users with fewer than 4 non-empty weeks get null features."""
    return ts.rolling_merge(helpfulness(spark, sf_dir), HCOLS, "Time", "weeks", 1, "mean", 4,
                            by=["UserId"])


_W5_SQL = with_(HELPFULNESS, """
s AS (SELECT UserId, Time // 604800 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d, count(*) AS rws
      FROM helpfulness GROUP BY 1, 2),
span AS (SELECT UserId, min(bin) AS lo, max(bin) AS hi, count(*) AS ne FROM s GROUP BY 1),
cal AS (SELECT UserId, ne, unnest(generate_series(lo, hi)) AS bin FROM span),
f AS (SELECT cal.UserId, cal.ne, cal.bin, coalesce(n, 0) AS n, coalesce(d, 0) AS d
      FROM cal LEFT JOIN s ON s.UserId = cal.UserId AND s.bin = cal.bin),
r AS (SELECT UserId, (bin + 1) * 604800 AS aligned,
        CASE WHEN ne >= 4 AND count(*) OVER w = 4 THEN avg(n) OVER w END AS nr,
        CASE WHEN ne >= 4 AND count(*) OVER w = 4 THEN avg(d) OVER w END AS dr
      FROM f WINDOW w AS (PARTITION BY UserId ORDER BY bin
                          ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING))
""") + """
SELECT h.*, r.nr AS HelpfulnessNumerator_roll_4_weeks, r.dr AS HelpfulnessDenominator_roll_4_weeks
FROM helpfulness h
LEFT JOIN r ON r.UserId = h.UserId AND r.aligned = (h.Time // 604800 + 1) * 604800
"""


# J5 per group: calendar fill per user
def j5_calendar_fill_by_user(spark, sf_dir):
    """Weekly sums per user on the epoch grid, each user's calendar from
    its first to last week, missing weeks filled with 0."""
    out = ts.resample(helpfulness(spark, sf_dir), HCOLS, "Time", WEEK, "epoch", "sum", 0,
                      by=["UserId"])
    return out.select("UserId", seconds_to_ts("bin_end").alias("week_end"), *HCOLS)


_J5_SQL = with_(HELPFULNESS, """
s AS (SELECT UserId, Time // 604800 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d FROM helpfulness GROUP BY 1, 2),
cal AS (SELECT UserId, unnest(generate_series(min(bin), max(bin))) AS bin FROM s GROUP BY 1)
""") + """
SELECT cal.UserId, TIMESTAMP '1970-01-01' + to_seconds((cal.bin + 1) * 604800) AS week_end,
       CAST(coalesce(n, 0) AS BIGINT) AS HelpfulnessNumerator,
       CAST(coalesce(d, 0) AS BIGINT) AS HelpfulnessDenominator
FROM cal LEFT JOIN s ON s.UserId = cal.UserId AND s.bin = cal.bin
"""


# Sums between period endpoints labelled by aligned time
def a4_period_sum(spark, sf_dir):
    """A4: sums per 2-week period on the epoch grid, labelled by the aligned time."""
    out = ts.aligned_sum(helpfulness(spark, sf_dir), HCOLS, "Time", "weeks", 2)
    return out.select(seconds_to_ts("aligned_time").alias("aligned_time"), *HCOLS)


_A4_SQL = with_(HELPFULNESS, """
s AS (SELECT Time // 1209600 AS bin, sum(HelpfulnessNumerator) AS n,
             sum(HelpfulnessDenominator) AS d FROM helpfulness GROUP BY 1),
cal AS (SELECT range AS bin FROM range((SELECT min(bin) FROM s), (SELECT max(bin) + 1 FROM s)))
""") + """
SELECT TIMESTAMP '1970-01-01' + to_seconds((cal.bin + 1) * 1209600) AS aligned_time,
       CAST(coalesce(n, 0) AS BIGINT) AS HelpfulnessNumerator,
       CAST(coalesce(d, 0) AS BIGINT) AS HelpfulnessDenominator
FROM cal LEFT JOIN s USING (bin)
"""


def w7_align_time(spark, sf_dir):
    """Each event time moved strictly up to the next whole day (epoch grid)."""
    from scorecast.functions.time import align_up
    from scorecast.sources.views import activity
    a = activity(spark, sf_dir)
    return a.select("Id", "Time", align_up("Time", 86400).alias("aligned_time"))


_W7_SQL = """
SELECT event_id AS Id, epoch_us(ts) // 1000000 AS Time,
       CAST(((epoch_us(ts) // 1000000) // 86400 + 1) * 86400 AS BIGINT) AS aligned_time
FROM events
"""


# Daily sums; A2 / O3 / P11: user counts and top users; P6: ratio
def a1_daily_sums(spark, sf_dir):
    """A1 + P7: per-date sums of both vote counts (date from epoch seconds)."""
    from scorecast.operators.aggregates import group_sum
    h = helpfulness(spark, sf_dir).withColumn("date", seconds_to_ts("Time"))
    return group_sum(h, ["date"], HCOLS)


_A1_SQL = with_(HELPFULNESS) + """
SELECT TIMESTAMP '1970-01-01' + to_seconds(Time) AS date,
       CAST(sum(HelpfulnessNumerator) AS BIGINT) AS SumHelpfulnessNumerator,
       CAST(sum(HelpfulnessDenominator) AS BIGINT) AS SumHelpfulnessDenominator
FROM helpfulness GROUP BY 1
"""


def a2_user_counts(spark, sf_dir):
    """A2: rows per user."""
    from scorecast.operators.aggregates import group_count
    return group_count(helpfulness(spark, sf_dir), ["UserId"])


_A2_SQL = with_(HELPFULNESS) + """
SELECT UserId, count(*) AS profile_count FROM helpfulness GROUP BY 1
"""


def o3_top_users(spark, sf_dir):
    """O3: the 6 users with most rows (ties by UserId)."""
    from scorecast.operators.aggregates import top_groups_by_count
    return top_groups_by_count(helpfulness(spark, sf_dir), "UserId", 6)


_O3_SQL = with_(HELPFULNESS) + """
SELECT UserId, count(*) AS profile_count FROM helpfulness GROUP BY 1
ORDER BY profile_count DESC, UserId LIMIT 6
"""


def p11_active_user_rows(spark, sf_dir):
    """P11 + P9: rows of users with more than 15 rows (aggregate threshold, then semi join)."""
    from scorecast.operators.aggregates import having_count
    from scorecast.operators.joins import keep_keys
    h = helpfulness(spark, sf_dir)
    return keep_keys(h, having_count(h, ["UserId"], 15), "UserId")


_P11_SQL = with_(HELPFULNESS) + """
SELECT * FROM helpfulness
WHERE UserId IN (SELECT UserId FROM helpfulness GROUP BY 1 HAVING count(*) > 15)
"""


def p6_helpfulness_ratio(spark, sf_dir):
    """P5 + P6 + P7: ratio numerator/denominator (null when the denominator is 0) and date."""
    from scorecast.functions.text import safe_ratio
    h = helpfulness(spark, sf_dir)
    return h.select("Id", "UserId", seconds_to_ts("Time").alias("date"),
                    safe_ratio("HelpfulnessNumerator", "HelpfulnessDenominator")
                    .alias("HelpfulnessRatio"))


_P6_SQL = with_(HELPFULNESS) + """
SELECT Id, UserId, TIMESTAMP '1970-01-01' + to_seconds(Time) AS date,
       CASE WHEN HelpfulnessDenominator = 0 THEN NULL
            ELSE HelpfulnessNumerator / HelpfulnessDenominator END AS HelpfulnessRatio
FROM helpfulness
"""


def a5_summary(spark, sf_dir):
    """A5: min / quartiles / mean / max of the vote counts and time."""
    from scorecast.operators.aggregates import summary
    return summary(helpfulness(spark, sf_dir), HCOLS + ["Time"])


_A5_SQL = with_(HELPFULNESS) + " " + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min,
       quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
       avg(CAST({c} AS DOUBLE)) AS mean, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3,
       CAST(max({c}) AS DOUBLE) AS max, count(*) FILTER (WHERE {c} IS NULL) AS n_null
       FROM helpfulness""" for c in HCOLS + ["Time"])


def a5_level_counts(spark, sf_dir):
    """A5 for a categorical: 6 most frequent users and '(Other)'."""
    from scorecast.operators.aggregates import level_counts
    return level_counts(helpfulness(spark, sf_dir), "UserId", 6)


_A5L_SQL = with_(HELPFULNESS, """
c AS (SELECT UserId, count(*) AS n FROM helpfulness GROUP BY 1),
t AS (SELECT * FROM c ORDER BY n DESC, UserId LIMIT 6)
""") + """
SELECT CAST(UserId AS VARCHAR) AS level, n FROM t
UNION ALL
SELECT '(Other)' AS level, CAST(sum(n) AS BIGINT) AS n FROM c WHERE UserId NOT IN (SELECT UserId FROM t)
"""


def o1_sorted_features(spark, sf_dir):
    """O1: E1 features sorted by time then key (a range-partitioned sort at the sink)."""
    return weekly_rolling_features(spark, sf_dir).orderBy("date_time", "Id")


QUERIES.update({
    "A3_resample_weekly": a3_resample_weekly,
    "A3_resample_shipments": a3_resample_shipments,
    "W1_trailing_mean": w1_trailing_mean,
    "W2_lagged_mean": w2_lagged_mean,
    "W3_rolling_summary": w3_rolling_summary,
    "W4_rolling_merge": w4_rolling_merge,
    "W5_rolling_merge_by_user": w5_rolling_merge_by_user,
    "J5_calendar_fill_by_user": j5_calendar_fill_by_user,
    "A4_period_sum": a4_period_sum,
    "W7_align_time": w7_align_time,
    "A1_daily_sums": a1_daily_sums,
    "A2_user_counts": a2_user_counts,
    "O3_top_users": o3_top_users,
    "P11_active_user_rows": p11_active_user_rows,
    "P6_helpfulness_ratio": p6_helpfulness_ratio,
    "A5_summary": a5_summary,
    "A5_level_counts": a5_level_counts,
    "O1_sorted_features": o1_sorted_features,
})
ORACLES.update({
    "A3_resample_weekly": _A3_SQL,
    "A3_resample_shipments": _A3S_SQL,
    "W1_trailing_mean": _roll_sql(3, "CURRENT ROW", "_mean4"),
    "W2_lagged_mean": _roll_sql(4, "1 PRECEDING", "_lag_mean4"),
    "W3_rolling_summary": _W3_SQL,
    "W4_rolling_merge": _W4_SQL,
    "W5_rolling_merge_by_user": _W5_SQL,
    "J5_calendar_fill_by_user": _J5_SQL,
    "A4_period_sum": _A4_SQL,
    "W7_align_time": _W7_SQL,
    "A1_daily_sums": _A1_SQL,
    "A2_user_counts": _A2_SQL,
    "O3_top_users": _O3_SQL,
    "P11_active_user_rows": _P11_SQL,
    "P6_helpfulness_ratio": _P6_SQL,
    "A5_summary": _A5_SQL,
    "A5_level_counts": _A5L_SQL,
    "O1_sorted_features": _E1_SQL,
})
