import re

import numpy as np
import xxhash

from scorecast.llm import components as C
from scorecast.llm import queries
from scorecast.llm import simhash as S


def brute_fp(text, n=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    if not w:
        return 0
    sh = [" ".join(w[i:i + n]) for i in range(len(w) - n + 1)] or [" ".join(w)]
    ones = [0] * 64
    for x in sh:
        h = xxhash.xxh64_intdigest(x.encode(), 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(sh))


def brute_groups(fps, bits=3):
    v = np.array(fps, dtype=np.uint64)
    root = list(range(len(v)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i + 1:] ^ v[i]) <= bits):
            a, b = find(i), find(i + 1 + int(j))
            root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(v))]


def test_fingerprints():
    for t in ["", " \t\n", "One", "one TWO", "a b c", "a b c d", "É é É é x y z", "a b c " * 400, "w" * 100000]:
        assert S.fingerprint(t.encode()) == brute_fp(t), t[:20]


def test_links_of_planted_fingerprints(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 2**63, size=40, dtype=np.uint64)
    fps = []
    for b in base:
        for _ in range(6):
            x = b
            for bit in rng.choice(64, size=rng.integers(0, 5), replace=False):
                x ^= np.uint64(1) << np.uint64(bit)
            fps.append(x)
    fps = sorted(set(fps + [np.uint64(0), np.uint64(7), np.uint64(2**64 - 1)]))
    df = spark.createDataFrame([(int(np.int64(np.uint64(x).astype(np.int64))),) for x in fps], "fp long")
    for cell in (4096, 3):
        old, S.CELL = S.CELL, cell
        try:
            comp = {r["node"]: r["component"] for r in C.components(S.links(df)).collect()}
        finally:
            S.CELL = old
        want = brute_groups(fps)
        got = {}
        for x, w in zip(fps, want):
            s = int(np.uint64(x).astype(np.int64))
            got.setdefault(comp.get(s, s), set()).add(w)
        assert all(len(g) == 1 for g in got.values()) and len(got) == len(set(want))


def test_pivot_bound():
    t = S.PivotTables()
    rng = np.random.default_rng(1)
    x, y = rng.integers(0, 2**64, size=(2, 200), dtype=np.uint64)
    d = np.abs(t.distances(x) - t.distances(y)).max(axis=1)
    assert (d <= np.bitwise_count(x ^ y)).all()


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    fps = [brute_fp(t) for _, t in docs]
    want = {d: (f"{f:016x}", docs[g][0]) for (d, _), f, g in zip(docs, fps, brute_groups(fps))}
    assert {r[0]: (r[1], r[2]) for r in queries.op6_simhash_near_dedup(spark, sf).collect()} == want


def test_edges(spark):
    text = "the quick brown fox jumps over the lazy dog"
    df = spark.createDataFrame([(5, text, "a"), (3, text, "a"), (3, text, "a"), (None, text, "a"), (9, None, "a"), (8, "  ", "a"),
                                (None, "only null here", "a")], "doc_id long, text string, fp string")
    got = sorted((r["doc_id"], r["component_id"]) for r in S.simhash_groups(df).collect() if r["doc_id"] is not None)
    assert got == [(3, 3), (3, 3), (5, 3), (8, 8), (9, 8)]
    kept = S.keep_one_per_group(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or -1) for r in kept.collect()) == [-1, 3, 3, 8]
    assert S.simhash_groups(df.limit(0)).count() == 0 and S.keep_one_per_group(df.limit(0)).count() == 0


def test_components_long_path_and_star(spark):
    rows = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(rows, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 161)) and all(got[i] == 7 for i in range(200, 400)) and got[7] == 7 and 5 not in got
