"""Invariants of the operators without an exact SQL form."""

import math

from pyspark.sql import functions as F

from scorecast.operators import models as md
from scorecast.operators import topics as tp


def test_one_feature_lasso_close_to_closed_form(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i + (i % 3)) for i in range(50)], "x double, y double")
    slope, icpt = md.fit_one_feature(df, "x", "y", alpha=5.0, l1_ratio=1.0)
    n = 50
    xs = [float(i) for i in range(50)]
    ys = [2.0 * i + (i % 3) for i in range(50)]
    mx, my = sum(xs) / n, sum(ys) / n
    sxy = sum((a - mx) * (b - my) for a, b in zip(xs, ys)) / n
    sxx = sum((a - mx) ** 2 for a in xs) / n
    want = math.copysign(max(abs(sxy) - 5.0, 0.0), sxy) / sxx
    assert abs(slope - want) < 1e-3 * abs(want)
    assert abs(icpt - (my - want * mx)) < 1e-2


def test_one_feature_ridge_closed_form(spark):
    df = spark.createDataFrame([(float(i), 3.0 * i - (i % 4)) for i in range(40)], "x double, y double")
    slope, _ = md.fit_one_feature(df, "x", "y", alpha=100.0, kind="ridge")
    xs = [float(i) for i in range(40)]
    ys = [3.0 * i - (i % 4) for i in range(40)]
    mx, my = sum(xs) / 40, sum(ys) / 40
    sxy = sum((a - mx) * (b - my) for a, b in zip(xs, ys))
    sxx = sum((a - mx) ** 2 for a in xs)
    assert abs(slope - sxy / (sxx + 100.0)) < 1e-6


def test_out_of_fold_covers_each_row_once(spark):
    from pyspark.ml import Pipeline
    df = spark.createDataFrame([(i, i % 3, float(i % 5)) for i in range(30)],
                               "Id long, fold int, label double")
    oof = md.out_of_fold(Pipeline(stages=[md.MeanRegressor()]), df, 3).collect()
    assert sorted(r.Id for r in oof) == list(range(30))
    by_fold = {f: sum(i % 5 for i in range(30) if i % 3 != f) / 20 for f in range(3)}
    assert all(abs(r.score - by_fold[r.fold]) < 1e-12 for r in oof)


def test_passive_aggressive_learns(spark):
    import random
    rnd = random.Random(0)
    rows = []
    for i in range(400):
        idx = sorted(rnd.sample(range(20), 4))
        val = [1.0] * 4
        y = sum(0.5 if j < 10 else -0.5 for j in idx) + 3.0
        rows.append((i, y, idx, val))
    df = spark.createDataFrame(rows, "Id long, label double, idx array<bigint>, val array<double>")
    df = df.repartition(4)
    m = md.PassiveAggressiveRegressor(20, C=1.0, epochs=5).fit(df)
    pred = m.transform(df)
    rmse = md.rmse_of(pred)
    base = math.sqrt(df.agg(F.avg((F.col("label") - 3.0) ** 2)).first()[0] + 0.0)
    assert rmse < base


def _pa_data(spark, n=2000):
    import random
    rnd = random.Random(1)
    rows = []
    for i in range(n):
        idx = sorted(rnd.sample(range(40), 5))
        rows.append((i, sum((j % 7) * 0.2 - 0.5 for j in idx) + 3.0, idx, [1.0] * 5))
    return spark.createDataFrame(rows, "Id long, label double, idx array<bigint>, val array<double>")


def test_passive_aggressive_does_not_depend_on_layout(spark):
    df = _pa_data(spark)
    for rows_per_block, most in ((50_000, 0.15), (100, 0.25)):
        out = []
        for parts in (1, 64, 512):
            m = md.PassiveAggressiveRegressor(40, C=1.0, epochs=3, rows_per_block=rows_per_block).fit(df.repartition(parts))
            out.append(md.rmse_of(m.transform(df)))
        assert max(out) - min(out) < 1e-9 and max(out) < most


def test_online_model_state_survives_a_restart(spark, tmp_path):
    from scorecast.plans.io_stream import OnlineModel
    df = _pa_data(spark, 600)
    batches = [df.where(F.col("Id") % 3 == i) for i in range(3)]
    one = OnlineModel(spark, str(tmp_path / "one"), 40)
    for i, b in enumerate(batches):
        one.apply(b, i)
    two = OnlineModel(spark, str(tmp_path / "two"), 40)
    two.apply(batches[0], 0)
    two = OnlineModel(spark, str(tmp_path / "two"), 40)  # a new driver
    two.apply(batches[0], 0)                             # a replayed batch
    two.apply(batches[1], 1)
    two = OnlineModel(spark, str(tmp_path / "two"), 40)
    two.apply(batches[2], 2)
    a, b = one.model(), two.model()
    assert one.batches() == two.batches() == 3 and abs(a.b - b.b) < 1e-12 and abs(a.w - b.w).max() < 1e-12
    assert md.rmse_of(a.transform(df)) < 0.3


def test_top_k_per_group_salted_equals_plain(spark):
    rows = [(g, i, float((i * 7919) % 101)) for g in range(3) for i in range(500)]
    df = spark.createDataFrame(rows, "g int, Id long, v double")
    got = tp.top_k_per_group(df, ["g"], [F.col("v").desc(), F.col("Id")], 4, salt_col="Id")
    got = sorted((r.g, r.Id) for r in got.collect())
    want = []
    for g in range(3):
        rs = sorted([r for r in rows if r[0] == g], key=lambda r: (-r[2], r[1]))[:4]
        want += [(g, r[1]) for r in rs]
    assert got == sorted(want)
