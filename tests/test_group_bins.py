"""The per-group rolling merge makes bins for its rows, not for whole calendars."""

import random
import statistics

import pytest

from scorecast.operators import timeseries as ts

DAY = 86400


def _rows(spark):
    rng = random.Random(8)
    rows = [(i, rng.choice([1, 2, None]), DAY * rng.randint(0, 40), rng.randint(0, 5)) for i in range(80)]
    rows += [(100, 3, 0, 1), (101, 3, DAY * 200_000, 2), (102, 4, None, 3), (103, 1, None, 1), (104, 5, 5, None)]
    return rows, spark.createDataFrame(rows, "Id long, UserId long, Time long, x int")


@pytest.mark.parametrize("func", ["mean", "min", "sd"])
def test_equals_whole_calendars(spark, func):
    rows, df = _rows(spark)
    got = {r["Id"]: r["x_roll_3_days"] for r in ts.rolling_merge(df, ["x"], "Time", "days", 1, func, 3, by=["UserId"]).collect()}
    one = {"mean": statistics.mean, "min": min, "sd": statistics.stdev}[func]
    sums, full = {}, {}
    for _, u, t, x in rows:
        if u is not None and t is not None:
            sums[u, t // DAY] = sums.get((u, t // DAY), 0) + (x or 0)
            full.setdefault(u, set()).add(t // DAY)
    for i, u, t, _ in rows:
        want = None
        if u is not None and t is not None and len(full[u]) >= 3 and t // DAY - 3 >= min(full[u]):
            want = float(one([sums.get((u, t // DAY - k), 0) for k in (1, 2, 3)]))
        assert got[i] == (None if want is None else pytest.approx(want))


def test_bins_grow_with_rows_not_with_span(spark):
    _, df = _rows(spark)
    sums = ts.resample(df, ["x"], "Time", DAY, "epoch", "sum", None, by=["UserId"])
    bins = ts._looked_at(sums, ["x"], DAY, 3, ["UserId"])
    assert bins.where("UserId = 3").count() == 1 + 4      # 200,000 days apart
    assert bins.count() <= 4 * sums.count()
    assert bins.count() == bins.select("UserId", "bin").distinct().count()
