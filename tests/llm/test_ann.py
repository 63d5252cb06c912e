import numpy as np
from pyspark.sql import functions as F

from scorecast.llm import ann as A
from scorecast.llm import queries


def brute(rows, k, is_query):
    ok = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v) or not any(v):
            continue
        if i not in ok or list(v) < ok[i]:
            ok[i] = list(v)
    ids = np.array(sorted(ok))
    x = np.array([ok[i] for i in ids], dtype=float)
    out = {}
    for q, v in zip(ids, x):
        if is_query(q):
            s = A.products(x, v)
            o = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[int(q)] = [(int(ids[j]), float(s[j])) for j in o]
    return out


def recall(got, want):
    have = {}
    for r in got:
        have.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    hit = sum(len({a for a, _ in have.get(q, {}).values()} & {a for a, _ in w}) for q, w in want.items())
    for q, h in have.items():
        assert sorted(h) == list(range(1, len(h) + 1))
        order = [h[i] for i in sorted(h)]
        assert order == sorted(order, key=lambda x: (-x[1], x[0])) and q not in {a for a, _ in order}
    return hit / max(1, sum(map(len, want.values())))


def test_recall_with_few_probes(spark):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(40, 16))
    rows = [(i, (centre[i % 40] * 3 + rng.normal(size=16)).tolist()) for i in range(4000)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = A.nearest(df, F.col("id") % 100 == 0, k=10, leaf=64, search_share=0.3, search_least=0).collect()
    assert recall(got, brute(rows, 10, lambda q: q % 100 == 0)) >= 0.9


def test_query_recall(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want = brute(rows, 20, lambda q: q % 20 == 0)
    got = queries.op5_ann_search(spark, sf).collect()
    assert len(got) == sum(map(len, want.values())) and recall(got, want) >= 0.9


def test_hot_vector_ties_and_bad_rows(spark):
    rng = np.random.default_rng(3)
    hot = [1.0, 2.0, 3.0, 4.0]
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=4).tolist()) for i in range(1, 600)]
    rows += [(1000, None), (1020, [0.0] * 4), (1040, [1.0, None, 1.0, 1.0]), (1060, [float("nan")] * 4), (1080, [float("inf")] * 4),
             (None, hot), (60, hot), (60, hot)]
    df = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, score double, v int")
    old, A.CHUNK = A.CHUNK, 50
    try:
        got = A.nearest(df, F.col("id") % 20 == 0, k=5).collect()
    finally:
        A.CHUNK = old
    want = brute(rows, 5, lambda q: q % 20 == 0)
    assert {q: [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q] for q in want} == want
    assert A.nearest(df.limit(0), F.lit(True)).count() == 0
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "vec_id long, embedding array<float>")
    assert [(r["query_id"], r["vec_id"]) for r in A.nearest(few, F.col("id") == 0).collect()] == [(0, 1)]
