"""Terms are counted where their text is: only texts are dealt by Id."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecast.functions import text as tx
from scorecast.operators import text_features as tf


def _docs(spark):
    rows = [(1, "tea tea cup"), (1, "tea pot"), (2, "pot cup cup"), (None, "tea cup"), (3, None), (4, "")]
    return spark.createDataFrame(rows, "Id long, t string")


def _exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_counts_shuffle_the_texts_only(spark):
    docs = _docs(spark)
    for df in (tf.doc_terms(docs, tx.tokens("t", 2)), tf.ngram_doc_terms(docs, tx.tokens("t", 2), 1, 3),
               tf.hashed_features(docs, tx.tokens("t", 2), 1, 3, 64)):
        assert _exchanges(df) == 1
    got = sorted(map(tuple, tf.doc_terms(docs, tx.tokens("t", 2)).collect()), key=str)
    # rows of one Id are one document, and so are those without an Id
    assert got == sorted([(1, "tea", 3), (1, "cup", 1), (1, "pot", 1), (2, "pot", 1), (2, "cup", 2), (None, "tea", 1), (None, "cup", 1)], key=str)


def test_tfidf_leaves_the_counts_in_place(spark):
    docs = _docs(spark)
    dt = tf.doc_terms(docs, tx.tokens("t", 2))
    vocab = tf.fit_vocabulary(dt, 4, min_df=2)
    out = tf.tfidf(tf.apply_vocabulary(dt, vocab), vocab, 4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    norms = {r.Id: r.n for r in out.groupBy("Id").agg(F.sum(F.col("tfidf") ** 2).alias("n")).collect()}
    assert set(norms) == {1, 2} and all(abs(n - 1) < 1e-6 for n in norms.values())
