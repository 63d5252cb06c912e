"""Rolling windows over blocks of bins, and exact quantiles by brackets."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorecast.operators import timeseries as ts
from scorecast.operators.aggregates import exact_quantiles, summary


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


@pytest.mark.parametrize("window,lag,func", [(1, 0, "sum"), (4, 1, "mean"), (3, 2, "max")])
@pytest.mark.parametrize("block", [1, 5, 4096])
def test_blocks_equal_one_window(spark, window, lag, func, block):
    rng = random.Random(window * 10 + lag)
    values = {g: [float(rng.randrange(50)) for _ in range(n)] for g, n in (("a", 73), ("b", 4), ("c", 1))}
    lo = {"a": -9, "b": 3, "c": 0}
    rows = [(g, lo[g] + i, v) for g, vs in values.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "g string, bin long, x double")
    out = ts.rolling(df, ["x"], window, func, lag, by=["g"], suffix="_r", block_bins=block)
    assert out.columns == ["g", "bin", "x", "x_r"]
    fn = {"sum": sum, "mean": lambda v: sum(v) / len(v), "max": max}[func]
    want = {}
    for g, vs in values.items():
        for i in range(len(vs)):
            part = vs[i - window - lag + 1:i - lag + 1] if i - window - lag + 1 >= 0 else []
            want[(g, lo[g] + i)] = fn(part) if part else None
    got = {(r["g"], r["bin"]): r["x_r"] for r in out.collect()}
    assert got.keys() == want.keys() and out.count() == len(rows)
    for k, v in want.items():
        assert (got[k] is None) == (v is None) and (v is None or got[k] == pytest.approx(v)), k


def test_no_window_without_partitions(spark):
    df = spark.range(500).select((F.col("id") * 86400).alias("Time"), F.col("id").cast("double").alias("x"))
    for out in (ts.rolling_merge(df, ["x"]), ts.rolling_nearest_features(df, ["x"])):
        lines = [x for x in _plan(out).splitlines() if "SinglePartition" in x]
        # only one-row aggregates may meet in one task
        assert "windowspecdefinition(bin" not in _plan(out).replace(" ", "")
        assert out.count() == 500 and len(lines) <= 2


def test_short_history_gives_null(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 604800, 2.0), *[("b", 604800 * i, 1.0) for i in range(6)]],
                               "u string, Time long, x double")
    out = ts.rolling_merge(df, ["x"], by=["u"]).collect()
    assert all(r["x_roll_4_weeks"] is None for r in out if r["u"] == "a")
    assert [r["x_roll_4_weeks"] for r in sorted(out, key=lambda r: r["Time"]) if r["u"] == "b"] == [None] * 4 + [1.0, 1.0]
    assert all(r["x_roll_4_weeks"] is None for r in ts.rolling_merge(df.where("u = 'a'"), ["x"]).collect())


@pytest.mark.parametrize("accuracy", [10, 10000])
def test_quantiles_equal_numpy(spark, accuracy):
    rng = np.random.default_rng(3)
    n = 3000
    cols = {"normal": rng.normal(size=n), "tied": np.where(rng.random(n) < 0.6, 7.0, rng.integers(0, 9, n).astype(float)),
            "wide": np.exp(rng.normal(size=n) * 200) * np.sign(rng.normal(size=n)), "one": np.full(n, -2.5)}
    names = list(cols)
    df = spark.createDataFrame([tuple(float(cols[c][i]) for c in names) for i in range(n)],
                               ", ".join(f"{c} double" for c in names)).repartition(7)
    probs = (0.0, 0.1, 0.25, 0.5, 0.75, 0.999, 1.0)
    got = exact_quantiles(df, names, probs, accuracy)
    for c in names:
        assert got[c] == pytest.approx(list(np.quantile(cols[c], probs)), rel=1e-12)


def test_quantiles_of_nulls_nan_and_nothing(spark):
    df = spark.createDataFrame([(1.0, None), (None, None), (3.0, None), (float("nan"), None)], "x double, y double")
    got = exact_quantiles(df, ["x", "y"], (0.0, 0.25, 0.5, 1.0))
    assert got["y"] == [None] * 4
    assert got["x"][:3] == [1.0, 2.0, 3.0] and math.isnan(got["x"][3])
    assert exact_quantiles(df.limit(0), ["x"]) == {"x": [None] * 3}
    assert exact_quantiles(df, []) == {}
    r = summary(df.limit(0), ["x"]).first()
    assert r["q1"] is None and r["n_null"] == 0


def test_summary_holds_no_value_map(spark):
    df = spark.range(1000).select((F.col("id") % 97).alias("x"))
    out = summary(df, ["x"])
    assert "percentile(" not in _plan(out)
    r = out.first()
    v = np.arange(1000) % 97
    assert (r["q1"], r["median"], r["q3"]) == tuple(np.quantile(v, (0.25, 0.5, 0.75)))
