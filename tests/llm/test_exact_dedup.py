import hashlib
import random
import re

from pyspark.sql import functions as F

from scorecast.llm import exact_dedup as M


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def brute(rows):
    groups = {}
    for at, (d, t) in enumerate(rows):
        groups.setdefault(norm(t), []).append((d is None, d or 0, at))
    out = []
    for at, (d, t) in enumerate(rows):
        g = groups[norm(t)]
        first = min(g)
        out.append((d, None if first[0] else rows[first[2]][0], len(g), at == first[2], hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_edges_against_brute_force(spark):
    long = "word " * 3000
    rows = [(5, "a  b"), (3, "a\tb"), (4, "a b "), (9, None), (8, ""), (7, " "), (6, "\n\n"), (None, "a b"), (None, None),
            (1, long), (2, long + "x"), (11, long.replace(" ", "\r\n")), (12, long[:-1]), (13, "é" * 700), (14, "é" * 700),
            (14, "é" * 700), (15, "é" * 699), (None, "only null id"), (None, "only  null id"), (-2, " x"), (16, "a\x1cb")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for size in (7, 64, 1024):
        assert got(M.exact_groups(df, block_bytes=size)) == brute(rows)


def test_random_texts_of_few_blocks(spark):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice(("ab", "ba")) for _ in range(rng.randint(0, 9)))) for i in rng.sample(range(9999), 600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert got(M.exact_groups(df, block_bytes=2)) == brute(rows)


def test_block_names_are_sorted_and_distinct(spark):
    rng = random.Random(6)
    raw = [bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 40))) for _ in range(400)]
    df = spark.createDataFrame([(bytearray(r),) for r in raw], "raw binary").repartition(5)
    blocks = sorted({r[i:i + 3] for r in raw for i in range(0, max(1, len(r)), 3)})
    names = M._block_names(df, 3, 0)
    key = spark.createDataFrame([(bytearray(b),) for b in blocks], "b binary").select("b", *M._hashes(F.col("b"), 0))
    order = [bytes(r["b"]) for r in key.join(names, ["h1", "h2"]).orderBy("name").collect()]
    assert names.count() == len(blocks) and order == blocks


def test_other_seed_when_hashes_clash(spark, monkeypatch):
    real, seen = M._hashes, []

    def weak(block, seed):
        seen.append(seed)
        return [F.lit(7).cast("long").alias("h1"), F.lit(7).cast("long").alias("h2")] if seed == 0 else real(block, seed)

    monkeypatch.setattr(M, "_hashes", weak)
    rows = [(1, "one text"), (2, "two text"), (3, "one  text")]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert got(M.exact_groups(df)) == brute(rows) and 1 in seen


def test_drop_copies_keeps_columns(spark):
    rows = [(2, "a b", "x", 1), (1, "a  b", "y", 2), (1, "a b", "z", 3), (None, "a b", "n", 4), (3, None, "e", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, name string, row_at int").coalesce(1)
    out = M.drop_exact_copies(df)
    assert out.columns == df.columns
    assert sorted(r["name"] for r in out.collect()) == ["e", "y"]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.exact_groups(empty).count() == 0 and M.drop_exact_copies(empty).count() == 0
