import random
import zlib

import numpy as np
import pytest

from scorecast.llm import packing as P
from scorecast.llm import queries

VOCAB = queries.vocabulary("byte_bpe_50k.json")
HARD = ["a  b\n\n c d's it's 'll x1 1x a.b. (c) \t e\n f", "\n", "", " ", " a ", "a\n b", "don't, \"quote\" — é… ok",
        "<|endoftext|> x <|endoftext|>", "x \n y", "tab\tx y", "´a b ²x x² Ⅷ", "word$$$ word### ,,a", "a\r\nb\r", "😀 😀😀 a😀", "_a_ b_c", " x  y z"]


def test_memo_equals_whole_texts():
    memo = P.WordMemo(VOCAB)
    rng = random.Random(1)
    bits = ["a", " ", "  ", "\n", "B", "é", "1", ".", "'s", "\t", "$$", "ß", "_", " ", "😀", "x"]
    texts = HARD + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 30))) for _ in range(3000)]
    for t in texts:
        assert memo.encode(t) == memo.whole(t), t


def brute_fullest(capacity, items):
    reach = {0}
    for x in items:
        reach |= {r + x for r in reach if r + x <= capacity}
    return max(reach)


def test_fullest_combination():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 4) for _ in range(rng.randint(0, 8))}
        cap = rng.randint(0, 90)
        got = P.fullest(cap, counts, sorted(counts, reverse=True))
        assert all(n <= counts[k] for k, n in got.items())
        assert sum(k * n for k, n in got.items()) == brute_fullest(cap, [k for k, n in counts.items() for _ in range(n)])


def check(rows, ids, capacity):
    docs = {}
    for r in rows:
        docs.setdefault(r["doc_id"], []).append(r)
    for d, ps in docs.items():
        at = 0
        for i, r in enumerate(sorted(ps, key=lambda r: r["piece"])):
            assert r["piece"] == i and r["start"] == at and (r["length"] == capacity or i == 0)
            at += r["length"]
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[d][r["start"]:at], dtype="<u4").tobytes())
        assert at == len(ids[d])
    seqs = {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append(r)
    for ps in seqs.values():
        end = 0
        for r in sorted(ps, key=lambda r: r["offset"]):
            assert r["offset"] == end
            end += r["length"]
        assert end <= capacity
    total = sum(r["length"] for r in rows)
    return len(seqs), -(-total // capacity)


def test_query_round_trip(spark):
    sf = "/root/testdata/sf0.001"
    memo = P.WordMemo(VOCAB)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    ids = {d["doc_id"]: np.frombuffer(memo.whole(d["text"] or ""), dtype="<u4").tolist() + [2] for d in docs}
    n, least = check(queries.op2_best_fit_packing(spark, sf).collect(), ids, 1024)
    assert least <= n <= least * 1.02 + 1


def test_edges(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "", 5), (3, "word " * 20000, 5), (None, "x", 5)], "doc_id long, text string, length int")
    rows = P.best_fit_packing(df, VOCAB, capacity=64, with_ids=True)
    kept = rows.collect()
    assert [r["length"] for r in kept if r["doc_id"] in (1, 2)] == [1, 1]
    memo = P.WordMemo(VOCAB)
    ids = {d: np.frombuffer(memo.whole(t or ""), dtype="<u4").tolist() + [2] for d, t, _ in df.collect()}
    check(kept, ids, 64)
    seqs = P.sequences(rows).collect()
    assert sum(len(s["ids"]) for s in seqs) == sum(map(len, ids.values())) and max(len(s["ids"]) for s in seqs) <= 64
    assert P.best_fit_packing(df.limit(0), VOCAB).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b")], "doc_id long, text string")
    assert P.best_fit_packing(twice, VOCAB).count() == 2


@pytest.mark.parametrize("hot", [1, 500])
def test_ranks_are_dense(spark, hot):
    df = spark.range(3000).selectExpr("id as doc_id", "0 as piece", f"if(id % 3 = 0, {hot}, 7 + id % 5) as length")
    out = P.ranked(df, "length", ["doc_id", "piece"], "rank", rows_per_bucket=16).toPandas()
    for _, g in out.groupby("length"):
        assert sorted(g["rank"]) == list(range(len(g)))
