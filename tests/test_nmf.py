"""The factorisation: non-negative, falling, repeatable, independent of its
blocks, and at the least-squares optimum for rows with H fixed."""

import numpy as np

from scorecast.operators import topics as tp
from tests.conftest import SF_SMALL


def _x(spark):
    from scorecast.plans.topics import tfidf_table
    X, _, _ = tfidf_table(spark, SF_SMALL)
    return X.persist()


def _dense(X):
    p = X.toPandas()
    ids, r = np.unique(p["Id"], return_inverse=True)
    terms, c = np.unique(p["term"], return_inverse=True)
    A = np.zeros((len(ids), len(terms)))
    A[r, c] = p["x"]
    return ids, terms, A


def _factor(df, key, col):
    return {r[key]: np.array(r[col]) for r in df.collect()}


def test_nonnegative_falling_and_independent_of_blocks(spark):
    X = _x(spark)
    m1 = tp.NMF(4, 6, seed=7, tol=-1.0).fit(X)
    assert len(m1.losses) == 6 and all(b <= a * (1 + 1e-9) for a, b in zip(m1.losses, m1.losses[1:]))
    m2 = tp.NMF(4, 6, seed=7, tol=-1.0, nnz_per_block=300).fit(X.repartition(3))
    for key, col, a, b in (("Id", "w", m1.W, m2.W), ("term", "h", m1.H, m2.H)):
        a, b = _factor(a, key, col), _factor(b, key, col)
        assert a.keys() == b.keys()
        assert all((x >= 0).all() and np.allclose(x, b[k], rtol=1e-8, atol=1e-10) for k, x in a.items())
    ids, terms, A = _dense(X)
    W, H = _factor(m1.W, "Id", "w"), _factor(m1.H, "term", "h")
    W, H = np.array([W[i] for i in ids]), np.array([H[t] for t in terms])
    # the last recorded loss is that before the last H half step
    assert ((A - W @ H.T) ** 2).sum() <= m1.losses[-1] * (1 + 1e-9)


def test_runs_to_its_tolerance(spark):
    m = tp.NMF(2, seed=3, tol=1e-3).fit(_x(spark))
    falls = [(a - b) / m.losses[0] for a, b in zip(m.losses, m.losses[1:])]
    assert falls[-1] < 1e-3 and all(f >= 1e-3 for f in falls[:-1]) and len(m.losses) < 200
    assert m.ratios[-1] < m.ratios[0]


def test_transform_is_the_least_squares_optimum(spark):
    X = _x(spark)
    m = tp.NMF(3, 5, seed=3, tol=-1.0).fit(X)
    got = _factor(m.transform(X), "Id", "w")
    assert got.keys() == _factor(m.W, "Id", "w").keys()
    ids, terms, A = _dense(X)
    H = _factor(m.H, "term", "h")
    H = np.array([H[t] for t in terms])
    for i, row in zip(ids, A):
        grad = got[i] @ (H.T @ H) - row @ H
        assert (got[i] >= 0).all() and (grad > -1e-4).all() and (np.abs(grad[got[i] > 1e-9]) < 1e-4).all()


def test_empty_and_unknown_terms(spark):
    empty = spark.createDataFrame([], "Id long, term string, x double")
    m = tp.NMF(2, 3).fit(empty)
    assert m.W.count() == 0 and m.H.count() == 0
    m = tp.NMF(2, 3).fit(spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "a", 1.0)], "Id long, term string, x double"))
    new = spark.createDataFrame([(7, "a", 1.0), (8, "zzz", 1.0)], "Id long, term string, x double")
    assert [r["Id"] for r in m.transform(new).collect()] == [7]


def test_one_hot_levels_come_from_the_data(spark):
    df = spark.createDataFrame([(1, 3), (2, 12), (3, None)], "Id long, label int")
    out = tp.one_hot(df, "label", tp.levels(df, "label"))
    assert out.columns == ["Id", "label", "ohe_3", "ohe_12"]
    assert [tuple(r)[2:] for r in out.orderBy("Id").collect()] == [(1, 0), (0, 1), (0, 0)]


def test_superseded_passes_are_given_back(spark):
    import os
    from scorecast.session import shared_dir
    folder = f"{shared_dir(spark)}/scorecast"
    X = spark.createDataFrame([(i, f"t{(i * j) % 7}", 1.0 + i % 3) for i in range(1, 30) for j in range(1, 4)], "Id long, term string, x double")
    X = X.groupBy("Id", "term").sum("x").withColumnRenamed("sum(x)", "x")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    m = tp.NMF(2, 5, seed=7, tol=-1.0).fit(X)
    left = [name.rsplit("-", 1)[0] for name in set(os.listdir(folder)) - before]
    assert len(m.losses) == 5 and left.count("nmf-step") == 1 and left.count("nmf-h") == 1
    assert not {"nmf-w", "nmf-cells", "nmf-input", "nmf-needs"} & set(left)
    assert m.W.count() == 29 and m.H.count() == 7
