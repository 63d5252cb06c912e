"""The online model's state crosses the driver as columns, and its sparse rows
reach Python in small batches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from scorecast.operators import models as md
from scorecast.plans.io_stream import OnlineModel
from scorecast.session import scratch_path


def _rows(spark):
    return spark.createDataFrame([(i, float(i % 3), [i % 5, 5 + i % 2], [1.0, 2.0 + i % 4]) for i in range(60)],
                                 "Id long, label double, idx array<bigint>, val array<double>")


def test_state_is_no_row_objects(spark, monkeypatch):
    rows = _rows(spark)

    def rows_are_made(*a, **k):
        raise AssertionError("a row object per index")

    monkeypatch.setattr(type(rows), "toPandas", rows_are_made)
    monkeypatch.setattr(pd.DataFrame, "to_records", rows_are_made)
    online = OnlineModel(spark, scratch_path(spark, "online"), 7)
    online.apply(rows, 0)
    online.apply(rows, 1)
    w, b, scale = online.load(1)
    assert online.batches() == 2 and list(scale) == [1.0] * 5 + [4.0, 5.0]
    want = md.PassiveAggressiveRegressor(7, epochs=2, scale=scale).fit(rows)
    assert np.allclose(w, want.w) and b == pytest.approx(want.b)


def test_rmse_takes_back_no_values(spark):
    rows = _rows(spark)
    m = md.PAModel(np.arange(7.0), 0.5, np.full(7, 2.0))
    scored, _ = m._scored(rows, "p", ["label"])
    assert scored.columns == ["label", "p"]
    p = rows.toPandas()
    want = [float(np.dot(np.arange(7.0)[i] / 2, v)) + 0.5 for i, v in zip(p["idx"], p["val"])]
    assert m.rmse(rows) == pytest.approx(float(np.sqrt(np.mean((p["label"] - want) ** 2))))
    got = m.transform(rows).orderBy("Id").toPandas()
    assert list(got.columns) == [*rows.columns, "prediction"] and np.allclose(got["prediction"], want)


def test_rows_arrive_in_small_batches(spark, monkeypatch):
    monkeypatch.setattr(md, "SPARSE_ROWS_PER_BATCH", 3)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    with md._few_rows(spark):
        sizes = _rows(spark).coalesce(1).mapInPandas(lambda it: (pd.DataFrame({"n": [len(p)]}) for p in it), "n long")
        assert sizes.agg(F.max("n")).first()[0] == 3
    assert spark.conf.get(key) == before
