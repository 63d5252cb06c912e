"""Regression models, model selection and scoring on Spark ML.

* linear models (OLS, ridge, lasso, elastic net, the SGD-style grid) map the
  reference's penalty conventions onto ``LinearRegression`` (see
  ``spark_penalty``);
* forests and boosted trees on sparse features are in ``operators.sparse_trees``;
* folds are the exact hash-rank folds of ``operators.split`` and feed
  the cross-validation, which fits the features once per fold;
* out-of-fold predictions are loops over folds of fits that each run
  distributed, submitted from threads;
* ``MeanRegressor`` (a constant model) and ``PassiveAggressiveRegressor``
  (PA-I, per-partition passes with averaged sparse weight deltas) are custom
  estimators.
"""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import CountVectorizer, MaxAbsScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecast.session import configured, partitions_for

# --------------------------------------------------------------------------
# penalties


def spark_penalty(alpha: float, l1_ratio: float, sd_label: float, kind: str = "enet"):
    """Map a penalty to ``LinearRegression(regParam, elasticNetParam)``.

    kind 'enet' (SGD / ElasticNet / Lasso): 1/(2n)|y-Xw|^2 + a*r|w|_1 + a(1-r)/2 |w|^2.
    kind 'ridge': |y-Xw|^2 + a|w|^2, i.e. the 'enet' form with a/n and r=0
    (pass ``alpha`` already divided by n).
    With ``standardization=False`` Spark divides its L2 term by the label's
    sd, so lambda = a*r + a*(1-r)*sd and elasticNetParam = a*r/lambda. The sd
    is the *sample* sd for the L-BFGS/OWL-QN solver and the *population* sd
    for the normal-equation solver (``label_sd`` gives the right one).
    """
    if kind == "ridge":
        l1_ratio = 0.0
    l1 = alpha * l1_ratio
    l2 = alpha * (1.0 - l1_ratio) * sd_label
    lam = l1 + l2
    return (lam, (l1 / lam) if lam > 0 else 0.0)


def label_sd(df: DataFrame, label: str, solver: str) -> float:
    """The label sd Spark's solver divides the L2 term by (see spark_penalty)."""
    f = F.stddev_pop if solver == "normal" else F.stddev_samp
    return df.agg(f(F.col(label).cast("double"))).first()[0] or 1.0


def linear_model(alpha: float = 0.0, l1_ratio: float = 0.0, sd_label: float = 1.0,
                 kind: str = "enet", features: str = "features", label: str = "label",
                 max_iter: int = 100, tol: float = 1e-6, solver: str = "l-bfgs"
                 ) -> LinearRegression:
    """M3-M7: a linear model with the requested penalty (no standardization:
    the features are max-abs scaled upstream, as in the reference).
    ``solver='normal'`` (normal equations, at most 4096 features, no L1) must
    be given the population label sd, ``'l-bfgs'`` (OWL-QN with L1) the
    sample sd - see ``label_sd``."""
    lam, a = spark_penalty(alpha, l1_ratio, sd_label, kind)
    if a > 0.0:
        solver = "l-bfgs"
    return LinearRegression(featuresCol=features, labelCol=label, regParam=lam,
                            elasticNetParam=a, standardization=False, solver=solver,
                            maxIter=max_iter, tol=tol)


def fit_one_feature(df: DataFrame, x: str, y: str, alpha: float = 0.0, l1_ratio: float = 0.0,
                    kind: str = "enet") -> tuple[float, float]:
    """M4-M7 on one feature: (slope, intercept). Without L1 the normal
    equations give the exact closed form; with L1, OWL-QN to tolerance 1e-9."""
    solver = "normal" if l1_ratio == 0.0 else "l-bfgs"
    sd = label_sd(df, y, solver)
    n = df.count()
    a = alpha / n if kind == "ridge" else alpha
    d = VectorAssembler(inputCols=[x], outputCol="features").transform(
        df.select(F.col(x).cast("double").alias(x), F.col(y).cast("double").alias("label")))
    m = linear_model(a, l1_ratio, sd, kind, tol=1e-9, solver=solver).fit(d)
    return float(m.coefficients[0]), float(m.intercept)


# --------------------------------------------------------------------------
# constant model (oracle-checkable baseline for folds and stacking)


class MeanModel(Model, HasPredictionCol):
    def __init__(self, mean: float = 0.0):
        super().__init__()
        self.mean = mean

    def _transform(self, dataset):
        return dataset.withColumn(self.getPredictionCol(), F.lit(float(self.mean)))


class MeanRegressor(Estimator, HasLabelCol, HasPredictionCol, HasFeaturesCol):
    """Predicts the training mean of the label (one aggregate)."""

    def __init__(self, labelCol: str = "label"):
        super().__init__()
        self._set(labelCol=labelCol)

    def _fit(self, dataset):
        m = dataset.agg(F.avg(F.col(self.getLabelCol()).cast("double"))).first()[0]
        return MeanModel(float(m or 0.0))


# --------------------------------------------------------------------------
# pipelines over review features


ALL_TERMS = 2**31 - 1  # the largest vocabulary Spark's vectoriser takes: no cap


def text_pipeline(model, summary_col: str | None = "summary_terms",
                  text_col: str | None = "text_terms", numeric=(),
                  summary_min_df: float = 0.0005, text_min_df: float = 0.001,
                  vocab_size: int = ALL_TERMS, scale: bool = True) -> Pipeline:
    """CountVectorizer branches + numeric columns -> assembler -> max-abs
    scaler -> model (T4, T16, T17). ``maxDF`` is left at its default so every
    common term is kept; the vocabulary is bounded by the document frequency
    thresholds only."""
    stages, inputs = [], []
    if summary_col:
        stages.append(CountVectorizer(inputCol=summary_col, outputCol="summary_dtm",
                                      minDF=summary_min_df, vocabSize=vocab_size))
        inputs.append("summary_dtm")
    if text_col:
        stages.append(CountVectorizer(inputCol=text_col, outputCol="text_dtm",
                                      minDF=text_min_df, vocabSize=vocab_size))
        inputs.append("text_dtm")
    inputs += list(numeric)
    out = "raw_features" if scale else "features"
    stages.append(VectorAssembler(inputCols=inputs, outputCol=out, handleInvalid="keep"))
    if scale:
        stages.append(MaxAbsScaler(inputCol="raw_features", outputCol="features"))
    if model is not None:
        stages.append(model)
    return Pipeline(stages=stages)


def assembled_names(pipeline_model) -> list[str]:
    """Feature names in assembled order, from the vocabularies and inputs."""
    names: list[str] = []
    vocabs = {}
    for st in pipeline_model.stages:
        if hasattr(st, "vocabulary"):
            vocabs[st.getOutputCol()] = st.vocabulary
        if isinstance(st, type(VectorAssembler())) or st.__class__.__name__ == "VectorAssembler":
            for c in st.getInputCols():
                if c in vocabs:
                    names += [f"{c}:{t}" for t in vocabs[c]]
                else:
                    names.append(c)
    return names


def parallel_map(fn, items, parallelism: int = 8):
    """Run independent fits as concurrent Spark jobs submitted from driver
    threads (each fit is itself distributed; small fits are latency-bound)."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    if parallelism <= 1 or len(items) <= 1:
        return [fn(x) for x in items]
    with ThreadPoolExecutor(max_workers=min(parallelism, len(items))) as ex:
        return list(ex.map(fn, items))


def cross_validate_models(prep: Pipeline, models, data: DataFrame, k: int = 5, fold_col: str = "fold",
                          label: str = "label", parallelism: int = 8, metric: str = "mse") -> list[tuple[float, float]]:
    """(mean, population sd) over ``k`` folds of each model's held-out
    metric. The feature stages are fitted once per fold and the fold's features
    kept while all models are fitted on them side by side."""
    ev = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=metric)
    per_fold = []
    for f in range(k):
        parts = [data.where(F.col(fold_col) != f), data.where(F.col(fold_col) == f)]
        for part, name in zip(parts, ("training", "validation")):
            if part.isEmpty():
                raise ValueError(f"The {name} data in fold {f} is empty.")
        fitted = prep.fit(parts[0])
        cols = sorted({m.getOrDefault("featuresCol") for m in models})
        train, held = [fitted.transform(p).select(label, *cols).persist(StorageLevel.MEMORY_AND_DISK) for p in parts]
        per_fold.append(parallel_map(lambda m: ev.evaluate(m.fit(train).transform(held)), models, parallelism))
        train.unpersist()
        held.unpersist()
    out = []
    for scores in zip(*per_fold):
        mean = sum(scores) / k
        out.append((float(mean), math.sqrt(sum((s - mean) ** 2 for s in scores) / k)))
    return out


def cross_validate(pipeline: Pipeline, grid, data: DataFrame, k: int = 5,
                   fold_col: str = "fold", label: str = "label", parallelism: int = 8,
                   metric: str = "mse") -> list[tuple[float, float]]:
    """K-fold CV with the given fold column over ``grid``, whose parameters
    are those of the pipeline's last stage: (mean, sd) per candidate."""
    *prep, model = pipeline.getStages()
    return cross_validate_models(Pipeline(stages=prep), [model.copy(pm) for pm in grid], data, k, fold_col, label,
                                 parallelism, metric)


def cv_results_table(spark, grid, scores, describe) -> DataFrame:
    """M13 + O2: one row per candidate (its parameters, mean and sd metric),
    sorted best first."""
    rows = [{**describe(pm), "score": m, "st_dev": sd} for pm, (m, sd) in zip(grid, scores)]
    return spark.createDataFrame(rows).orderBy("score")


def out_of_fold(pipeline: Pipeline, data: DataFrame, k: int, fold_col: str = "fold",
                id_col: str = "Id", pred: str = "prediction") -> DataFrame:
    """Each row predicted by a model fitted on the other folds; every
    row appears exactly once. Fits run side by side, each distributed."""
    def one(f):
        m = pipeline.fit(data.where(F.col(fold_col) != f))
        return (m.transform(data.where(F.col(fold_col) == f))
                .select(id_col, F.col(fold_col), F.col(pred).alias("score")))
    parts = parallel_map(one, range(k))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rmse_of(df: DataFrame, label: str = "label", pred: str = "prediction") -> float:
    d = F.col(label).cast("double") - F.col(pred).cast("double")
    v = df.agg(F.avg(d * d)).first()[0]
    return math.sqrt(v) if v is not None else float("nan")


# --------------------------------------------------------------------------
# passive-aggressive online regression (M11) on sparse (idx, val) rows


def sparse_rows(long_df: DataFrame, key: str = "Id", index: str = "bucket",
                value: str = "value") -> DataFrame:
    """(key, index, value) long table -> one row per key with sorted parallel
    arrays. The group is one document, bounded by its length."""
    return (long_df.groupBy(key)
            .agg(F.sort_array(F.collect_list(F.struct(F.col(index).cast("long").alias("i"),
                                                      F.col(value).cast("double").alias("v"))))
                 .alias("__e"))
            .select(key, F.col("__e.i").alias("idx"), F.col("__e.v").alias("val")))


def max_abs_sparse(rows: DataFrame, dim: int, default: float = 1.0):
    """A13 / T16 on sparse rows: max |value| per index (partial + final
    aggregate); returned as a dense array of length ``dim`` (the model size);
    indices never seen (or all zero) get ``default``."""
    import numpy as np
    m = np.full(dim, float(default))
    agg = (rows.select(F.explode(F.arrays_zip("idx", "val")).alias("e"))
           .groupBy(F.col("e.idx").alias("i")).agg(F.max(F.abs(F.col("e.val"))).alias("m"))
           .where(F.col("m") > 0).toArrow())  # columns, not a row object per index
    m[agg["i"].to_numpy()] = agg["m"].to_numpy()
    return m


# sparse rows hold some thousand values each: few of them travel at once
SPARSE_ROWS_PER_BATCH = 256


def _few_rows(spark):
    return configured(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(SPARSE_ROWS_PER_BATCH))


def _pa_pass(ys, idx, val, w, b, scale, C, eps):
    """One sequential PA-I pass; w is changed in place, the new b returned.
    Every update depends on the one before, so this is a loop by nature."""
    import numpy as np
    for y, ix, xv in zip(ys, idx, val):
        ix = np.asarray(ix, dtype=np.int64)
        xv = np.asarray(xv, dtype=float) / scale[ix]
        p = float(w[ix] @ xv) + b
        loss = abs(y - p) - eps
        if loss > 0:
            step = math.copysign(min(C, loss / (float(xv @ xv) + 1.0)), y - p)
            w[ix] += step * xv
            b += step
    return b


class PassiveAggressiveRegressor:
    """PA-I regression (epsilon-insensitive loss, aggressiveness C) on sparse rows.

    Rows are dealt by a hash of the key into blocks of about
    ``rows_per_block`` rows and ordered by that hash, so neither the blocks nor
    the order within them depend on the input's layout. Each epoch broadcasts
    the current weights; every block makes one sequential pass and emits its
    sparse weight change; each weight moves by the mean change of the blocks
    that touched it (iterative parameter mixing). The model is a dense vector
    of ``dim`` weights, which bounds what is broadcast and returned. Features
    are divided by ``scale`` (max-abs) inside the task.
    """

    def __init__(self, dim: int, C: float = 1.0, epsilon: float = 0.1, epochs: int = 5,
                 label: str = "label", key: str = "Id", scale=None, rows_per_block: int = 50_000):
        self.dim, self.C, self.epsilon, self.epochs = dim, C, epsilon, epochs
        self.label, self.key, self.scale = label, key, scale
        self.rows_per_block = rows_per_block

    def fit(self, df: DataFrame, init=None) -> "PAModel":
        """``init`` = (w, b) continues from earlier weights (incremental use)."""
        import numpy as np
        spark = df.sparkSession
        blocks = partitions_for(df.count(), self.rows_per_block)
        keyed = df.select(F.xxhash64(F.col(self.key)).alias("__o"), F.col(self.key).alias("__k"),
                          F.col(self.label).cast("double").alias("y"), "idx", "val")
        rows = (keyed.withColumn("__b", F.pmod(F.col("__o"), F.lit(blocks)))
                .repartition(blocks, "__b").sortWithinPartitions("__b", "__o", "__k")
                .persist(StorageLevel.MEMORY_AND_DISK))
        w = np.zeros(self.dim) if init is None else np.array(init[0], dtype=float)
        b = 0.0 if init is None else float(init[1])
        C, eps = self.C, self.epsilon
        scale = self.scale if self.scale is not None else np.ones(self.dim)
        for _ in range(self.epochs):
            bc = spark.sparkContext.broadcast((w, b, scale))

            def run(batches, bc=bc):
                import numpy as np
                import pandas as pd

                def change(wl, bl, w0, b0):
                    nz = np.flatnonzero(wl != w0)
                    return pd.DataFrame({"i": np.append(nz, -1).astype(np.int64),
                                         "d": np.append(wl[nz] - w0[nz], bl - b0)})

                w0, b0, sc = bc.value
                at, wl, bl = None, None, b0
                for pdf in batches:
                    for block, part in pdf.groupby("__b", sort=True):
                        if block != at:
                            if at is not None:
                                yield change(wl, bl, w0, b0)
                            at, wl, bl = block, w0.copy(), b0
                        bl = _pa_pass(part["y"].to_numpy(), part["idx"], part["val"], wl, bl, sc, C, eps)
                if at is not None:
                    yield change(wl, bl, w0, b0)

            # mean changes come back through Arrow (at most dim + 1 rows)
            with _few_rows(spark):
                delta = rows.mapInPandas(run, "i long, d double").groupBy("i").agg(F.avg("d").alias("d")).toArrow()
            ii, dd = delta["i"].to_numpy(), delta["d"].to_numpy()
            b += float(dd[ii < 0].sum())
            w[ii[ii >= 0]] += dd[ii >= 0]
            # the weights of an epoch are read in its one job only
            bc.destroy()
        rows.unpersist()
        return PAModel(w, b, scale)


class PAModel:
    def __init__(self, w, b, scale):
        self.w, self.b, self.scale = w, b, scale

    def rmse(self, df: DataFrame, label: str = "label") -> float:
        """RMSE on ``df``; the broadcast weights are given back at once."""
        scored, bc = self._scored(df, "prediction", [label])
        with _few_rows(df.sparkSession):
            out = rmse_of(scored, label)
        bc.destroy()
        return out

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """W . (x / scale) + b per row; one weighted count per batch."""
        return self._scored(df, out, df.columns)[0]

    def _scored(self, df: DataFrame, out: str, keep: list[str]):
        """``df`` with its prediction; only the columns of ``keep`` come back."""
        df = df.select(*keep, *[c for c in ("idx", "val") if c not in keep])
        spark = df.sparkSession
        bc = spark.sparkContext.broadcast((self.w / self.scale, self.b))
        schema = df.select(*keep).schema.simpleString()[len("struct<"):-1]

        def run(batches):
            import numpy as np
            w, b = bc.value
            for pdf in batches:
                size = pdf["idx"].map(len).to_numpy(dtype=np.int64)
                row = np.repeat(np.arange(len(pdf)), size)
                if len(row):
                    ix = np.concatenate(pdf["idx"].to_list()).astype(np.int64)
                    part = w[ix] * np.concatenate(pdf["val"].to_list()).astype(float)
                else:
                    part = np.empty(0)
                pdf = pdf[keep].copy()
                pdf[out] = np.bincount(row, weights=part, minlength=len(pdf)) + b
                yield pdf
        return df.mapInPandas(run, f"{schema}, {out} double"), bc
