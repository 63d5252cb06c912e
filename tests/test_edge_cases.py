"""Hand-made edge cases for cleaning, text statistics, time series, joins,
vocabularies, splits and vectors."""

import datetime as dt
import random

from pyspark.sql import functions as F

from scorecast.functions import text as tx
from scorecast.functions import vectors as vx
from scorecast.operators import clean as cl
from scorecast.operators import joins as jn
from scorecast.operators import split as sp
from scorecast.operators import text_features as tf
from scorecast.operators import timeseries as ts

WEEK = 604800


def test_dedupe_keeps_smallest_id_and_nulls_match(spark):
    df = spark.createDataFrame(
        [(3, "a", "x", 1), (1, "a", "x", 1), (2, None, "y", 2), (5, None, "y", 2), (4, "a", "x", 2)],
        "Id long, Summary string, Text string, Score int")
    out = {r.Id for r in cl.dedupe_keep_first(df, ["Summary", "Text", "Score"]).collect()}
    assert out == {1, 2, 4}


def test_text_statistics_edge_texts(spark):
    rows = [(1, "", ""), (2, "   ", "!!!"), (3, "ab<br />cd", "A1 b2. C3"), (4, None, "Émile _x 9")]
    df = spark.createDataFrame(rows, "Id long, Summary string, Text string")
    df = df.select("Id", tx.fill_empty(tx.remove_breaks("Summary")).alias("Summary"),
                   tx.fill_empty("Text").alias("Text"))
    got = {r.Id: r for r in cl.text_statistics(df).collect()}
    assert got[1].summary_word_count == 0 and got[1].summary_capital_char_ratio == 0.0
    assert got[2].summary_word_count == 0 and got[2].text_word_count == 1
    assert got[3].Summary == "ab cd" and got[3].summary_word_count == 2
    assert got[3].text_digit_count == 3 and got[3].text_capital_letter_count == 2
    assert got[3].text_words_per_sentence == 2 / 2
    # '[aA-zZ]' also matches '_' (the range A-z)
    assert got[4].text_letter_count == 4 + 1 + 1   # m i l e, _, x
    assert got[4].text_capital_letter_count == 0   # 'É' is outside [A-Z]


def test_tokens_and_ngrams(spark):
    df = spark.createDataFrame([(1, "The cat_1 sat, a b"), (2, "")], "Id long, t string")
    r = {x.Id: x for x in df.select("Id", tx.tokens("t", 2).alias("k"),
                                    tx.tokens("t", 1).alias("k1")).collect()}
    assert r[1].k == ["the", "cat_1", "sat"] and r[1].k1 == ["the", "cat_1", "sat", "a", "b"]
    assert r[2].k == []
    g = df.select("Id", tx.ngrams(tx.tokens("t", 2), 1, 3).alias("g")).collect()
    g = {x.Id: x.g for x in g}
    assert g[1] == ["the", "cat_1", "sat", "the cat_1", "cat_1 sat", "the cat_1 sat"]
    assert g[2] == []


def test_resample_gap_fill_and_edges(spark):
    t0 = 86400 * 10
    rows = [(1, t0, 1), (2, t0 + WEEK, 2), (3, t0 + 3 * WEEK + 5, 4)]  # week 2 empty, edge row
    df = spark.createDataFrame(rows, "Id long, Time long, v long")
    out = ts.resample(df, ["v"], "Time", WEEK, "first_day").orderBy("bin").collect()
    assert [r.v for r in out] == [1, 2, 0, 4]
    assert out[0].bin_end == t0 + WEEK      # right-edge label; t0 + WEEK is in bin 1
    one = ts.resample(df.limit(1), ["v"], "Time", WEEK).collect()
    assert len(one) == 1


def test_rolling_lagged_mean_and_guard(spark):
    rows = [(i, 86400 * 7 * i + 100, 1, i) for i in range(6)]
    rows += [(100 + i, 86400 * 7 * i + 100, 2, 1) for i in range(3)]   # user 2: 3 weeks only
    df = spark.createDataFrame(rows, "Id long, Time long, UserId long, v long")
    out = {r.Id: r for r in ts.rolling_merge(df, ["v"], by=["UserId"]).collect()}
    # value at week i = mean of weeks i-4..i-1
    assert out[4].v_roll_4_weeks == (0 + 1 + 2 + 3) / 4
    assert out[5].v_roll_4_weeks == (1 + 2 + 3 + 4) / 4
    assert out[3].v_roll_4_weeks is None
    assert all(out[100 + i].v_roll_4_weeks is None for i in range(3))   # guard


def test_nearest_label_ties_go_later_and_clamp(spark):
    # labels at t0 + k*W; a time exactly between two labels takes the later one
    t0 = 0
    rows = [(1, t0), (2, t0 + WEEK), (3, t0 + 2 * WEEK), (4, t0 + WEEK + WEEK // 2),
            (5, t0 + 3 * WEEK - 1)]
    df = spark.createDataFrame(rows, "Id long, Time long").withColumn("v", F.lit(1))
    j = {r.Id: r.j for r in df.select(
        "Id", jn.clamp(ts.nearest_label_index("Time", t0, WEEK), 1, 3).alias("j")).collect()}
    assert j[1] == 1            # before the first label -> first
    assert j[4] == 2 + 0 or j[4] == 2  # 1.5 weeks: tie between labels 1 and 2 -> 2
    assert j[5] == 3            # after the last label -> last


def _brute_asof(left, right, direction):
    out = {}
    for lid, u, t in left:
        cands = [(rt, v) for ru, rt, v in right if ru == u]
        if direction == "backward":
            c = [x for x in cands if x[0] <= t]
            out[lid] = max(c)[1] if c else None
        else:
            c = [x for x in cands if x[0] >= t]
            out[lid] = min(c)[1] if c else None
    return out


def test_asof_join_matches_brute_force(spark):
    rnd = random.Random(3)
    left = [(i, rnd.randint(0, 3), rnd.randint(0, 10000)) for i in range(300)]
    times = rnd.sample(range(0, 10000), 120)
    right = [(rnd.randint(0, 3), t, float(i)) for i, t in enumerate(times)]
    L = spark.createDataFrame(left, "Id long, u long, t long")
    R = spark.createDataFrame(right, "u long, t long, val double")
    for direction in ("backward", "forward"):
        for block in (None, 700):
            got = {r.Id: r.val for r in jn.asof_join(L, R, "t", ["u"], direction, ["val"],
                                                      block=block).collect()}
            assert got == _brute_asof(left, right, direction), (direction, block)


def test_tag_alignment(spark):
    train = spark.createDataFrame([(1, ["A", "B"]), (2, ["A"])], "Id long, tags array<string>")
    test = spark.createDataFrame([(3, ["C", "A"]), (4, []), (5, None)], "Id long, tags array<string>")
    vocab = train.select(F.explode("tags").alias("tag"))
    out = sorted((r.Id, r.tag, r.n) for r in tf.tag_counts_long(test, "tags", ["A", "B", "C"], vocab).collect()
                 if r.Id != 5)
    assert out == [(3, "A", 1), (3, "B", 0), (4, "A", 0), (4, "B", 0)]


def test_asof_ties_nearest_and_null_keys(spark):
    rnd = random.Random(5)
    left = [(i, rnd.choice([0, 1, None]), rnd.randint(0, 40)) for i in range(80)] + [(99, 0, None)]
    right = [(rnd.choice([0, 1, None]), rnd.randint(0, 40), float(i)) for i in range(120)] + [(0, None, -1.0)]

    def brute(direction):
        out = {}
        for lid, u, t in left:
            c = [(rt, v) for ru, rt, v in right if ru == u and rt is not None and t is not None]
            if direction == "backward":
                c = [x for x in c if x[0] <= t]
            elif direction == "forward":
                c = [x for x in c if x[0] >= t]
            key = {"backward": lambda x: (x[0], x[1]), "forward": lambda x: (-x[0], x[1]),
                   "nearest": lambda x: (-abs(x[0] - t), x[0], x[1])}[direction]
            out[lid] = max(c, key=key)[1] if c else None
        return out

    for direction in ("backward", "forward", "nearest"):
        for parts, block in ((1, None), (7, 6), (13, 1)):
            L = spark.createDataFrame(left, "Id long, u long, t long").repartition(parts)
            R = spark.createDataFrame(right, "u long, t long, val double").repartition(parts)
            got = {r.Id: r.val for r in jn.asof_join(L, R, "t", ["u"], direction, ["val"], block=block,
                                                     tie_col="val").collect()}
            assert got == brute(direction), (direction, parts)


def test_level_counts_with_nulls(spark):
    from scorecast.operators.aggregates import level_counts
    df = spark.createDataFrame([("a",), ("a",), (None,), (None,), (None,), ("b",)], "v string")
    got = {r.level: r.n for r in level_counts(df, "v", 2).collect()}
    assert got == {None: 3, "a": 2, "(Other)": 1}


def test_null_stratum_is_split_and_folded(spark):
    df = spark.createDataFrame([(i, None if i % 2 else 1) for i in range(20)], "Id long, Score int")
    s = sp.stratified_split(df, "Score", 0.5).groupBy("Score", "split").count().collect()
    assert {(r.Score, r.split): r["count"] for r in s} == {(None, "train"): 5, (None, "test"): 5, (1, "train"): 5,
                                                           (1, "test"): 5}
    f = sp.stratified_folds(df, "Score", 5).groupBy("Score", "fold").count().collect()
    assert sorted(r["count"] for r in f) == [2] * 10


def test_csv_inference_reads_all_rows(spark, tmp_path):
    from scorecast.sources import files
    path = str(tmp_path / "csv")
    rows = [(i, 3_000_000_000 if i == 4321 else 5) for i in range(5000)]
    files.write_csv(spark.createDataFrame(rows, "Id long, v long"), path)
    df = files.read_csv_inferred(spark, path)
    assert dict(df.dtypes)["v"] == "bigint" and df.agg(F.max("v")).first()[0] == 3_000_000_000


def test_vocabulary_min_df_and_tfidf_every_doc(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "x z"), (3, "x y")], "Id long, t string")
    dt_ = tf.doc_terms(df, tx.tokens("t", 1))
    v = {r.term: r.df for r in tf.fit_vocabulary(dt_, 3, min_df=2).collect()}
    assert v == {"x": 3, "y": 2}            # term at exactly min_df is kept
    w = {(r.Id, r.term): r.tfidf for r in tf.tfidf(tf.apply_vocabulary(dt_, tf.fit_vocabulary(
        dt_, 3, min_df=1)), tf.fit_vocabulary(dt_, 3, min_df=1), 3).collect()}
    assert w[(2, "x")] > 0                  # a term in every document keeps weight (idf = 1)


def test_split_exact_counts_small_strata(spark):
    rows = [(i, 0) for i in range(7)] + [(100, 1)]   # odd stratum and a stratum of one
    df = spark.createDataFrame(rows, "Id long, Score int")
    s = sp.stratified_split(df, "Score", 0.5).groupBy("Score", "split").count().collect()
    c = {(r.Score, r.split): r["count"] for r in s}
    assert c[(0, "train")] == 3 and c[(0, "test")] == 4
    assert c.get((1, "train"), 0) == 0 and c[(1, "test")] == 1
    f = sp.stratified_folds(df.where("Score = 0"), "Score", 3).groupBy("fold").count().collect()
    assert sorted(r["count"] for r in f) == [2, 2, 3]


def test_exact_sample_size(spark):
    df = spark.range(0, 5000).withColumnRenamed("id", "Id")
    assert sp.exact_sample(df, 123).count() == 123
    assert sp.exact_sample(df, 10000).count() == 5000


def test_argmax_ties_and_zero_norm(spark):
    df = spark.createDataFrame([(1, [1.0, 3.0, 3.0]), (2, [0.0, 0.0])], "Id long, v array<double>")
    r = {x.Id: x for x in df.select("Id", vx.argmax("v").alias("a"),
                                    vx.l2_normalize("v").alias("n")).collect()}
    assert r[1].a == 1 and r[2].a == 0
    assert r[2].n == [None, None]           # 0 / 0 stays undefined, no error


def test_require_cols():
    import pytest
    with pytest.raises(ValueError):
        ts.require_cols([])


def test_timestamp_helpers_are_zone_independent(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        from scorecast.functions.time import epoch_seconds, seconds_to_ts
        df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 5),)], "ts timestamp_ntz")
        r = df.select(epoch_seconds("ts").alias("s"), seconds_to_ts(F.lit(5)).alias("t")).first()
        assert r.s == 1704067205 and r.t == dt.datetime(1970, 1, 1, 0, 0, 5)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
