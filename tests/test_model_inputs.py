"""What the model queries keep and shuffle: no unused columns, one feature fit
per fold, one model's weights at a time."""

from __future__ import annotations

import pytest
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from scorecast.operators import clean as cl
from scorecast.operators import models as md


@pytest.fixture()
def sf_dir(spark, tmp_path):
    words = ["tea", "coffee", "pets", "shop", "taste", "chocolate", "bad", "good"]
    docs = [(i, f"{words[i % 8]} {words[i % 5]} review\n" + " ".join(words[(i * j) % 8] for j in range(1, 9))) for i in range(1, 81)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, i % 2) for i, _ in docs], "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_sorts_no_texts(spark):
    df = spark.createDataFrame([(3, "a", "x", 1), (1, "a", "x", 1), (2, None, "x", 1), (5, None, "x", 1), (None, "n", "n", 2)],
                               "Id long, Summary string, Text string, Score int")
    out = cl.dedupe_keep_first(df, ["Summary", "Text", "Score"])
    assert "SortAggregate" not in _plan(out)
    # rows without an Id: no first row, as before
    assert sorted(map(tuple, out.collect()), key=str) == sorted(
        [(1, "a", "x", 1), (2, None, "x", 1), (None, None, None, None)], key=str)


def test_dedupe_keeps_other_columns_of_the_first_row(spark):
    df = spark.createDataFrame([(2, 0.0, "late"), (1, -0.0, "first"), (3, 1.0, "one")], "Id long, k double, other string")
    got = {r.Id: (str(r.k), r.other) for r in cl.dedupe_keep_first(df, ["k"]).collect()}
    assert got == {1: ("-0.0", "first"), 3: ("1.0", "one")}


def test_model_table_keeps_only_the_named_tokens(spark, sf_dir):
    from scorecast.plans.models import model_table
    slim = model_table(spark, sf_dir)
    assert not [f.name for f in slim.schema.fields if f.dataType.typeName() == "array"]
    named = model_table(spark, sf_dir, "summary_unigrams")
    assert [f.name for f in named.schema.fields if f.dataType.typeName() == "array"] == ["summary_unigrams"]
    both = slim.select("Id", "split", "fold").exceptAll(named.select("Id", "split", "fold"))
    assert both.isEmpty() and slim.count() == named.count()


def test_cross_validation_fits_features_once_per_fold(spark, monkeypatch):
    rows = [(i, ["a"] * (i % 3) + ["b"], float(i % 3), i % 5) for i in range(40)]
    df = spark.createDataFrame(rows, "Id long, words array<string>, label double, fold int")
    prep = md.text_pipeline(None, "words", None, summary_min_df=1.0)
    fits = []
    fit = type(prep).fit
    monkeypatch.setattr(type(prep), "fit", lambda self, *a: fits.append(1) or fit(self, *a))
    models = [LinearRegression(regParam=r, maxIter=20) for r in (0.0, 0.5)]
    scores = md.cross_validate_models(prep, models, df)
    assert len(fits) == 5
    # against a fit of each whole pipeline
    for m, (mean, _) in zip(models, scores):
        errors = []
        for f in range(5):
            p = fit(md.text_pipeline(m, "words", None, summary_min_df=1.0), df.where(F.col("fold") != f))
            errors.append(md.rmse_of(p.transform(df.where(F.col("fold") == f))) ** 2)
        assert mean == pytest.approx(sum(errors) / 5, abs=1e-9)


def test_passive_aggressive_models_are_scored_one_by_one(spark, sf_dir, monkeypatch):
    """Only one model's dense vectors may be on the driver at a time."""
    from scorecast.plans import models as plans
    live, most = [0], [0]
    fit = md.PassiveAggressiveRegressor.fit

    def counted(self, *a, **k):
        live[0] += 1
        most[0] = max(most[0], live[0])
        try:
            return fit(self, *a, **k)
        finally:
            live[0] -= 1
    monkeypatch.setattr(md.PassiveAggressiveRegressor, "fit", counted)
    rows = plans.m11_passive_aggressive(spark, sf_dir).collect()
    assert most[0] == 1 and len(rows) == 6
