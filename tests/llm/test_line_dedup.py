import hashlib
import random

from scorecast.llm import line_dedup as M
from scorecast.llm import queries

WS = " \t\n\x0b\x0c\r"
LOW = {c: c + 32 for c in range(65, 91)}


def brute(rows, min_chars=20, min_docs=3):
    def key(x):
        return x.strip(WS).translate(LOW)
    where = {}
    for i, (d, t) in enumerate(rows):
        for k in {key(x) for x in (t or "").split("\n")}:
            if len(k) >= min_chars:
                where.setdefault(k, []).append(-1 if d is None else d)
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (len(where.get(key(x), [])) >= min_docs and max(where[key(x)]) != (-1 if d is None else d))]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()), key=repr)


A, B = "a line of twenty code points", "\tAnother Line that is LONG enough é \r"


def test_edges_against_brute_force(spark):
    rows = [(1, f"{A}\nshort\n{B}"), (2, f"x\n {A.upper()} \nx"), (3, f"{A}\n{A}\n\n"), (4, B), (5, f"{B}\nend"),
            (None, f"{A}\nnull id"), (None, None), (6, ""), (7, None), (8, "short\nshort"), (9, "É" * 19 + "\n" + "é" * 20),
            (10, "é" * 20), (11, "é" * 20), (12, "É" * 20), (13, "z" * 200000 + "\n" + A), (13, "z" * 200000 + "\n" + A)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for batches, fanout in ((1, 2), (3, 2), (7, 3)):
        assert got(M.line_dedup(df, batches=batches, fanout=fanout)) == brute(rows)


def test_random_batches(spark):
    rng = random.Random(3)
    pool = [f"common line number {i} with some words" for i in range(12)]
    rows = [(i, "\n".join(rng.choice(pool) if rng.random() < 0.7 else f"own line {i} {j} of this document" for j in range(rng.randint(0, 8))))
            for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(M.line_dedup(df, batches=6, fanout=2)) == brute(rows)


def test_columns_and_empty(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.line_dedup(empty).count() == 0
    odd = spark.createDataFrame([(1, A, 7, "k"), (2, A, 8, "k"), (3, A, 9, "k")], "doc_id long, text string, n_lines int, k1 string")
    out = M.line_dedup(odd)
    assert out.columns == ["doc_id", "text", "k1", "n_lines", "n_dropped"]
    assert [r["text"] for r in out.orderBy("doc_id").collect()] == ["", "", A]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: (n, x, hashlib.sha256(t.encode()).hexdigest()) for d, n, x, t in brute(docs)}
    assert {r[0]: tuple(r)[1:] for r in queries.op10_line_dedup(spark, sf).collect()} == want
