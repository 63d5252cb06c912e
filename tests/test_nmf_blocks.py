"""X is made once and stays in its blocks; TF-IDF rows equal the long table."""

import numpy as np
from pyspark.sql import functions as F

from scorecast.operators import nmf
from scorecast.operators import text_features as tf


def _x(spark, n=40):
    return spark.createDataFrame([(i, f"t{(i * j) % 11}", 1.0 + (i + j) % 3) for i in range(1, n) for j in (1, 2, 3)],
                                 "Id long, term string, x double").dropDuplicates(["Id", "term"])


def test_blocks_are_not_shuffled_again(spark, capsys):
    rows, nnz = nmf._kept_rows(_x(spark), "Id")
    x = nmf._Blocks(rows, nnz, 20)
    assert x.nnz == nnz == rows.select(F.explode("xs")).count() and x.n == 39
    assert x.cells.count() > 1
    sent = nmf._written(x.cells.select("block", F.lit(0).alias("place")), "sent")
    x.with_sent(sent, nmf._fit_fn([[1.0]], 1), nmf._STEP).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning") == 1 and "ExistingRDD" in plan
    x.release()


def test_packed_numbers_come_back(spark):
    for kind in (np.int32, np.int64, np.float64):
        for n in (0, 1, 1000):
            a = (np.random.default_rng(n).normal(size=n) * 1e4).astype(kind)
            assert (nmf._unpacked(nmf._packed(a), n, kind) == a).all()


def test_shards_and_blocks_do_not_matter(spark, monkeypatch):
    X = _x(spark).persist()
    one = nmf.NMF(3, 4, tol=-1.0).fit(X)
    monkeypatch.setattr(nmf, "TERMS_PER_SHARD", 3)
    many = nmf.NMF(3, 4, tol=-1.0, nnz_per_block=15).fit(X)
    assert np.allclose(one.losses, many.losses)
    for key, col, a, b in (("Id", "w", one.W, many.W), ("term", "h", one.H, many.H)):
        a, b = ({r[key]: r[col] for r in t.collect()} for t in (a, b))
        assert a.keys() == b.keys() and all(np.allclose(v, b[k]) for k, v in a.items())


def test_settings_are_given_back(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key), spark.conf.get("spark.sql.adaptive.enabled")
    nmf.NMF(2, 1).fit(_x(spark, 5))
    assert (spark.conf.get(key), spark.conf.get("spark.sql.adaptive.enabled")) == before


def test_tfidf_rows_equal_the_long_table(spark, monkeypatch):
    texts = [(1, "a b b c"), (1, "a d"), (2, "b c"), (None, "a c"), (3, None), (4, "zz"), (5, "c c c a")]
    dt = tf.doc_terms(spark.createDataFrame(texts, "Id long, t string"), F.split("t", " "))
    counts, nnz = tf.term_rows(dt)
    assert nnz == dt.count()
    assert {tuple(r) for r in tf.row_terms(counts).collect()} == {tuple(r) for r in dt.collect()}
    vocab = tf.fit_vocabulary(tf.row_terms(counts), 7, min_df=2)
    want = {(r[0], r[1]): r[2] for r in tf.tfidf(tf.apply_vocabulary(dt, vocab), vocab, 7, digits=None).collect()}
    for most in (tf.SENT_TERMS, 0):
        monkeypatch.setattr(tf, "SENT_TERMS", most)
        got = {(r["Id"], t): x for r in tf.tfidf_rows(counts, vocab, 7).collect() for t, x in zip(r["terms"], r["xs"])}
        assert got.keys() == want.keys() and all(abs(got[k] - v) < 1e-12 for k, v in want.items())
