"""Score models on the labelled reviews: features, linear models (trees are in
``plans.trees``), grids with k-fold CV, out-of-fold predictions, stacking, online
passive-aggressive learning, prediction sinks and artifacts.

Fitted models have no SQL form, so most queries here are rows-only and are
covered by invariant tests. Where the computation is exactly expressible
(one-feature OLS and ridge, the mean predictor and its fold metrics, max-abs
scaling, prediction files read back) an oracle statement is given.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from scorecast.functions import text as tx
from scorecast.operators import clean as cl
from scorecast.operators import models as md
from scorecast.operators import split as sp
from scorecast.operators import text_features as tf
from scorecast.plans.sqlviews import LABELLED, with_
from scorecast.plans.text import _sql_hash, _sql_word_count
from scorecast.session import partitions_for, scratch_path
from scorecast.sources.views import reviews

SEED = 44
K_FOLDS = 5
NUMERIC = ["summary_count", "text_count", "all_words_count"]
_CACHE: dict = {}


TOKENS = {"summary_unigrams": "Summary", "text_unigrams": "Text"}


def model_table(spark, sf_dir, *tokens):
    """Cleaned labelled reviews with split (50/50 stratified), 5 stratified
    folds inside the train half (-1 for test), word counts and the token columns
    of ``TOKENS`` that are named. Made once per session, data folder and set of
    columns; the reviews are cleaned once, into a written table that the split
    and the folds read their keys from."""
    key = (id(spark), sf_dir, *tokens)
    if key in _CACHE:
        return _CACHE[key]
    lab = cl.clean_reviews(reviews(spark, sf_dir, supervised=True))
    path = scratch_path(spark, "model-rows")
    lab.select("Id", "Score", *NUMERIC, *[tx.tokens(TOKENS[c], 2).alias(c) for c in tokens]).write.parquet(path)
    lab = spark.read.parquet(path)
    n = lab.count()
    lab = sp.stratified_split(lab, "Score", 0.5, SEED)
    train = sp.stratified_folds(lab.where(F.col("split") == "train"), "Score", K_FOLDS, SEED)
    test = lab.where(F.col("split") == "test").withColumn("fold", F.lit(-1))
    t = train.unionByName(test)
    t = t.select("Id", "split", "fold", F.col("Score").cast("double").alias("label"), *NUMERIC,
                 F.col("summary_count").cast("double").alias("summary_count_d"), *tokens)
    # rows with tokens are up to a few KB each
    t = t.repartition(partitions_for(n, 5000), "Id").persist(StorageLevel.MEMORY_AND_DISK)
    t.count()
    _CACHE[key] = t
    return t


def _train_test(spark, sf_dir, *tokens):
    t = model_table(spark, sf_dir, *tokens)
    return t.where(F.col("split") == "train"), t.where(F.col("split") == "test")


# ---- M4 / M5: one-feature closed forms (exact oracles) ------------------------------
_CLEAN_SQL = with_(LABELLED, """
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Summary, Text, Score ORDER BY Id) AS rn
                     FROM labelled) WHERE rn = 1),
c AS (SELECT Id, CAST(Score AS DOUBLE) AS y,
             """ + _sql_word_count("coalesce(replace(Text, '<br />', ' '), '')") + """ AS text_count
      FROM d)""")


def _one_feature(spark, sf_dir, alpha, l1, kind, digits=6):
    c = cl.clean_reviews(reviews(spark, sf_dir, supervised=True)).withColumn("kwords", F.col("text_count") / 1000.0)
    slope, icpt = md.fit_one_feature(c, "kwords", "Score", alpha, l1, kind)
    return spark.createDataFrame([(round(slope, digits), round(icpt, digits))],
                                 "slope double, intercept double")


def m4_ols_one_feature(spark, sf_dir):
    """M4: least squares of the score on the text's thousands of words."""
    return _one_feature(spark, sf_dir, 0.0, 0.0, "enet")


def m5_ridge_one_feature(spark, sf_dir):
    """M5: ridge (alpha = 100 on the un-averaged loss) on thousands of words."""
    return _one_feature(spark, sf_dir, 100.0, 0.0, "ridge")


def m6_lasso_one_feature(spark, sf_dir):
    """M6: lasso (alpha = 0.01) on thousands of words (OWL-QN)."""
    return _one_feature(spark, sf_dir, 0.01, 1.0, "enet", 4)


def m7_enet_one_feature(spark, sf_dir):
    """M7: elastic net (alpha = 0.02, l1_ratio = 0.5) on thousands of words."""
    return _one_feature(spark, sf_dir, 0.02, 0.5, "enet", 4)


def _one_feature_sql(slope: str, digits: int) -> str:
    """Closed form from the centred moments xx, xy of n rows."""
    return _CLEAN_SQL + f"""
, k AS (SELECT y, text_count / 1000.0 AS x FROM c),
m AS (SELECT regr_sxx(y, x) AS xx, regr_sxy(y, x) AS xy, count(*) AS n, avg(y) AS my, avg(x) AS mx FROM k),
s AS (SELECT {slope} AS b, my, mx FROM m)
SELECT round(b, {digits}) AS slope, round(my - b * mx, {digits}) AS intercept FROM s
"""


def _shrunk(alpha: float, l1: float) -> str:
    return f"sign(xy) * greatest(abs(xy) / n - {alpha * l1}, 0) / (xx / n + {alpha * (1 - l1)})"


_M4_SQL = _one_feature_sql("xy / xx", 6)
_M5_SQL = _one_feature_sql("xy / (xx + 100.0)", 6)
_M6_SQL = _one_feature_sql(_shrunk(0.01, 1.0), 4)
_M7_SQL = _one_feature_sql(_shrunk(0.02, 0.5), 4)


# ---- M3 / M12 / M15: linear grid with k-fold CV --------------------------------------
def _linear_grid(train):
    sd = train.agg(F.stddev_samp("label")).first()[0] or 1.0
    lr = md.linear_model(max_iter=50)
    pipe = md.text_pipeline(lr, "summary_unigrams", None, (), summary_min_df=0.0005)
    grid, desc = [], {}
    for l1 in (0.0, 1.0):
        for alpha in (1e-5, 0.01):
            lam, a = md.spark_penalty(alpha, l1, sd, "enet")
            pm = {lr.regParam: lam, lr.elasticNetParam: a,
                  lr.solver: "l-bfgs"}
            grid.append(pm)
            desc[(lam, a)] = {"l1_ratio": l1, "alpha": alpha}
    return pipe, grid, lambda pm: desc[(pm[lr.regParam], pm[lr.elasticNetParam])]


def m12_linear_grid_cv(spark, sf_dir):
    """M3 + M12 + M13 + O2: summary unigram counts -> max-abs -> elastic-net
    linear model; grid l1_ratio {0, 1} x alpha {1e-5, 0.01}, 5-fold CV on the
    train half by mean squared error; results sorted best first."""
    train, _ = _train_test(spark, sf_dir, "summary_unigrams")
    pipe, grid, desc = _linear_grid(train)
    return md.cv_results_table(spark, grid, md.cross_validate(pipe, grid, train), desc)


def _best_linear(spark, sf_dir):
    key = ("best_linear", id(spark), sf_dir)
    if key not in _CACHE:
        train, _ = _train_test(spark, sf_dir, "summary_unigrams")
        pipe, grid, _ = _linear_grid(train)
        scores = md.cross_validate(pipe, grid, train)
        best = min(range(len(grid)), key=lambda i: scores[i][0])
        _CACHE[key] = pipe.copy(grid[best])
    return _CACHE[key]


def m16_oof_predictions(spark, sf_dir):
    """M16 + M18 + U1: out-of-fold predictions of the best linear pipeline for
    every train review, and test predictions of the pipeline refitted on the
    whole train half."""
    train, test = _train_test(spark, sf_dir, "summary_unigrams")
    best = _best_linear(spark, sf_dir)
    oof = md.out_of_fold(best, train, K_FOLDS).select("Id", F.lit("train").alias("split"), "score")
    tp = best.fit(train).transform(test).select("Id", F.lit("test").alias("split"),
                                                F.col("prediction").alias("score"))
    return oof.unionByName(tp)


# ---- M14: grid across estimators ----------------------------------------------------------
def m14_multi_model_grid(spark, sf_dir):
    """M14 + M4-M8 + O7: OLS, ridge, lasso, elastic net and a small forest
    (no scaler) on summary/text unigram counts + word counts, 5-fold CV each;
    one table of all candidates with the best flagged."""
    train, _ = _train_test(spark, sf_dir, "summary_unigrams", "text_unigrams")
    sd = train.agg(F.stddev_samp("label")).first()[0] or 1.0
    n = train.count()
    cands = [("ols", {}, md.linear_model(0.0, 0.0, sd, max_iter=50)),
             ("ridge", {"alpha": 1.0}, md.linear_model(1.0 / n, 0.0, sd, "ridge", max_iter=50)),
             ("ridge", {"alpha": 10.0}, md.linear_model(10.0 / n, 0.0, sd, "ridge", max_iter=50)),
             ("lasso", {"alpha": 0.1}, md.linear_model(0.1, 1.0, sd, max_iter=50)),
             ("elastic_net", {"alpha": 0.1, "l1_ratio": 0.5},
              md.linear_model(0.1, 0.5, sd, max_iter=50)),
             ("random_forest", {"n_estimators": 2, "max_depth": 3},
              RandomForestRegressor(featuresCol="raw_features", numTrees=2, maxDepth=3, seed=SEED))]
    prep = md.text_pipeline(None, "summary_unigrams", "text_unigrams", NUMERIC)
    scores = md.cross_validate_models(prep, [est for _, _, est in cands], train)
    rows = [(name, str(sorted(params.items())), m, sd) for (name, params, _), (m, sd) in zip(cands, scores)]
    best = min(r[2] for r in rows)
    df = spark.createDataFrame(rows, "model string, params string, score double, st_dev double")
    return df.withColumn("best", F.col("score") == F.lit(best)).orderBy("score")


# ---- M11 / M19: passive-aggressive online model with fold scores ---------------------------
def m11_passive_aggressive(spark, sf_dir):
    """M11 + M19 + T6 + A13 + T16: hashed 1-3-gram features of summary and text
    (2^20 buckets each, signed, L2) plus word counts, max-abs scaled; PA-I
    regression scored on each of the 5 train folds, then refitted on the whole
    train half and scored on the test half (RMSE per row of the output)."""
    t = model_table(spark, sf_dir)
    nb = 1 << 20
    r = reviews(spark, sf_dir).select("Id", "Summary", "Text").join(t.select("Id"), "Id", "left_semi")
    hs = tf.hashed_features(r, tx.tokens("Summary", 2), 1, 3, nb)
    ht = tf.hashed_features(r, tx.tokens("Text", 2), 1, 3, nb).withColumn(
        "bucket", F.col("bucket") + F.lit(nb))
    num = t.select("Id", F.posexplode(F.array(*[F.col(c).cast("double") for c in NUMERIC]))
                   .alias("p", "value")).select("Id", (F.col("p") + 2 * nb).alias("bucket"),
                                                "value")
    dim = 2 * nb + len(NUMERIC)
    rows = md.sparse_rows(hs.unionByName(ht).unionByName(num))
    data = t.select("Id", "fold", "split", "label").join(rows, "Id").persist()
    def score(tr, va):
        scale = md.max_abs_sparse(tr, dim)
        return md.PassiveAggressiveRegressor(dim, C=1.0, epochs=3, scale=scale).fit(tr).rmse(va)
    # one model after the other: each holds its dense weights, scale and changes
    # on the driver and fills the cluster by itself
    out = [(f"fold_{f}", score(data.where((F.col("split") == "train") & (F.col("fold") != f)), data.where(F.col("fold") == f)))
           for f in range(K_FOLDS)]
    out.append(("test", score(data.where(F.col("split") == "train"), data.where(F.col("split") == "test"))))
    data.unpersist()
    return spark.createDataFrame(out, "evaluation string, rmse double")


# ---- exact baselines: mean predictor, fold metrics, max-abs, sinks ------------------------
def _split_sql(frac=0.5):
    return f"""
, s1 AS (SELECT *, {_sql_hash('Id')} AS h FROM c),
s2 AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h, Id) AS rn,
              count(*) OVER (PARTITION BY y) AS ns FROM s1),
sp AS (SELECT Id, y, h, CASE WHEN rn <= floor({frac} * ns) THEN 'train' ELSE 'test' END AS split
       FROM s2),
f1 AS (SELECT *, row_number() OVER (PARTITION BY y ORDER BY h, Id) AS rn,
              count(*) OVER (PARTITION BY y) AS ns FROM sp WHERE split = 'train'),
folds AS (SELECT Id, y, CAST({' + '.join(f'CAST(rn > ({j} * ns) // 5 AS INTEGER)' for j in range(1, 5))}
                            AS INTEGER) AS fold FROM f1)"""


def a11_mean_predictor_rmse(spark, sf_dir):
    """MSE and RMSE on the test half of the train-mean predictor."""
    train, test = _train_test(spark, sf_dir)
    m = md.MeanRegressor().fit(train)
    from scorecast.operators.aggregates import rmse
    r = rmse(m.transform(test), "label", "prediction")
    return r.select(F.round("mse", 9).alias("mse"), F.round("rmse", 9).alias("rmse"))


_A11_SQL = _CLEAN_SQL + _split_sql() + """
, m AS (SELECT avg(y) AS mu FROM sp WHERE split = 'train')
SELECT round(avg((y - mu) * (y - mu)), 9) AS mse, round(sqrt(avg((y - mu) * (y - mu))), 9) AS rmse
FROM sp, m WHERE split = 'test'
"""


def m16_oof_mean_predictor(spark, sf_dir):
    """M16 with the mean predictor: every train review scored by the mean of
    the other four folds."""
    train, _ = _train_test(spark, sf_dir)
    from pyspark.ml import Pipeline
    return md.out_of_fold(Pipeline(stages=[md.MeanRegressor()]), train, K_FOLDS)


_M16M_SQL = _CLEAN_SQL + _split_sql() + """
, fm AS (SELECT f.fold, (SELECT avg(y) FROM folds g WHERE g.fold <> f.fold) AS mu
         FROM (SELECT DISTINCT fold FROM folds) f)
SELECT Id, fold, mu AS score FROM folds JOIN fm USING (fold)
"""


def a14_fold_rmse_mean_sd(spark, sf_dir):
    """A14 + A11: held-out RMSE of the mean predictor per fold, then the mean
    and population sd of the five values."""
    oof = m16_oof_mean_predictor(spark, sf_dir)
    train, _ = _train_test(spark, sf_dir)
    j = oof.join(train.select("Id", "label"), "Id")
    per = j.groupBy("fold").agg(F.sqrt(F.avg((F.col("label") - F.col("score")) ** 2)).alias("rmse"))
    from scorecast.operators.aggregates import metric_mean_sd
    out = metric_mean_sd(per.withColumn("k", F.lit(1)), ["k"], "rmse").drop("k")
    return out.select(F.round("rmse_mean", 9).alias("rmse_mean"),
                      F.round("rmse_std", 9).alias("rmse_std"))


_A14_SQL = _CLEAN_SQL + _split_sql() + """
, fm AS (SELECT f.fold, (SELECT avg(y) FROM folds g WHERE g.fold <> f.fold) AS mu
         FROM (SELECT DISTINCT fold FROM folds) f),
per AS (SELECT fold, sqrt(avg((y - mu) * (y - mu))) AS rmse FROM folds JOIN fm USING (fold) GROUP BY fold)
SELECT round(avg(rmse), 9) AS rmse_mean, round(stddev_pop(rmse), 9) AS rmse_std FROM per
"""


def a13_max_abs(spark, sf_dir):
    """Max |x| of the word-count columns over the train half."""
    from scorecast.operators.aggregates import max_abs
    train, _ = _train_test(spark, sf_dir)
    return max_abs(train, NUMERIC)


_A13_SQL = _CLEAN_SQL.replace(" AS text_count\n", " AS text_count,\n" + _sql_word_count(
    "coalesce(replace(Summary, '<br />', ' '), '')") + " AS summary_count\n") + _split_sql().replace(
    "sp AS (SELECT Id, y, h,", "sp AS (SELECT Id, y, h, summary_count, text_count,") + """
SELECT CAST(max(abs(summary_count)) AS DOUBLE) AS summary_count,
       CAST(max(abs(text_count)) AS DOUBLE) AS text_count,
       CAST(max(abs(summary_count + text_count)) AS DOUBLE) AS all_words_count
FROM sp WHERE split = 'train'
"""


def t16_max_abs_scaled(spark, sf_dir):
    """Word counts of every review divided by their train-half max |x|."""
    t = model_table(spark, sf_dir)
    m = a13_max_abs(spark, sf_dir).first()
    return t.select("Id", *[(F.col(c).cast("double") / F.lit(float(m[c]))).alias(c)
                            for c in NUMERIC])


_T16_SQL = _A13_SQL.replace("""SELECT CAST(max(abs(summary_count)) AS DOUBLE) AS summary_count,
       CAST(max(abs(text_count)) AS DOUBLE) AS text_count,
       CAST(max(abs(summary_count + text_count)) AS DOUBLE) AS all_words_count
FROM sp WHERE split = 'train'
""", """, m AS (SELECT CAST(max(abs(summary_count)) AS DOUBLE) AS ms,
              CAST(max(abs(text_count)) AS DOUBLE) AS mt,
              CAST(max(abs(summary_count + text_count)) AS DOUBLE) AS ma
       FROM sp WHERE split = 'train')
SELECT Id, summary_count / ms AS summary_count, text_count / mt AS text_count,
       (summary_count + text_count) / ma AS all_words_count FROM sp, m
""")


def s9_prediction_sink(spark, sf_dir):
    """S9 + S10: test predictions (id, score) of the mean predictor written as
    CSV with a header (no single-file coalesce) to the shared folder, then read
    back with an explicit schema."""
    from scorecast.sources import files
    _, test = _train_test(spark, sf_dir)
    train, _ = _train_test(spark, sf_dir)
    m = md.MeanRegressor().fit(train)
    pred = m.transform(test).select(F.col("Id").alias("id"), F.col("prediction").alias("score"))
    path = scratch_path(spark, "predictions")
    files.write_predictions(pred, path)
    return files.read_predictions(spark, path)


_S9_SQL = _CLEAN_SQL + _split_sql() + """
, m AS (SELECT avg(y) AS mu FROM sp WHERE split = 'train')
SELECT Id AS id, mu AS score FROM sp, m WHERE split = 'test'
"""


def s11_pipeline_round_trip(spark, sf_dir):
    """S11 + T17: the best linear pipeline fitted on the train half, saved to
    the shared folder, loaded back; its test predictions and the assembled
    feature count."""
    train, test = _train_test(spark, sf_dir, "summary_unigrams")
    pm = _best_linear(spark, sf_dir).fit(train)
    path = scratch_path(spark, "pipeline")
    pm.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    n_feat = len(md.assembled_names(loaded))
    return loaded.transform(test).select("Id", F.col("prediction").alias("score"),
                                         F.lit(n_feat).alias("n_features"))


QUERIES = {
    "M4_ols_one_feature": m4_ols_one_feature,
    "M5_ridge_one_feature": m5_ridge_one_feature,
    "M6_lasso_one_feature": m6_lasso_one_feature,
    "M7_enet_one_feature": m7_enet_one_feature,
    "M12_linear_grid_cv": m12_linear_grid_cv,
    "M16_oof_predictions": m16_oof_predictions,
    "M14_multi_model_grid": m14_multi_model_grid,
    "M11_passive_aggressive": m11_passive_aggressive,
    "A11_mean_predictor_rmse": a11_mean_predictor_rmse,
    "M16_oof_mean_predictor": m16_oof_mean_predictor,
    "A14_fold_rmse_mean_sd": a14_fold_rmse_mean_sd,
    "A13_max_abs": a13_max_abs,
    "T16_max_abs_scaled": t16_max_abs_scaled,
    "S9_prediction_sink": s9_prediction_sink,
    "S11_pipeline_round_trip": s11_pipeline_round_trip,
}

ORACLES = {
    "M4_ols_one_feature": _M4_SQL,
    "M5_ridge_one_feature": _M5_SQL,
    "M6_lasso_one_feature": _M6_SQL,
    "M7_enet_one_feature": _M7_SQL,
    "A11_mean_predictor_rmse": _A11_SQL,
    "M16_oof_mean_predictor": _M16M_SQL,
    "A14_fold_rmse_mean_sd": _A14_SQL,
    "A13_max_abs": _A13_SQL,
    "T16_max_abs_scaled": _T16_SQL,
    "S9_prediction_sink": _S9_SQL,
}
