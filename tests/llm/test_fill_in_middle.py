import hashlib
import random
import re
from collections import Counter

import pytest

from scorecast.llm import fill_in_middle as M
from scorecast.llm import queries


def brute(doc_id, text):
    t = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", t)
    n = len(units)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, t
    lo, hi = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if h4 % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def sha(t):
    return hashlib.sha256((t or "").encode()).hexdigest()


def test_edges_against_brute_force(spark):
    rng = random.Random(1)
    texts = [None, "", " ", "abc", "a1b2", "<P>", "x<S>y", "<M", "<P", "< P>", "é", "日本 text\n\tnaïve", "a" * 100000, "1" * 100000, "\U0001f600ab"]
    rows = [(None if i == 3 else rng.randint(-5, 10**12), rng.choice(texts)) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = M.fill_in_middle(df).collect()
    want = Counter((d, t, *brute(d, t), sha(brute(d, t)[4]), sha(t)) for d, t in rows)
    assert Counter(tuple(r) for r in out) == want
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}


def test_restored_from_output_and_form(spark):
    rows = [(i, f"Some text {i}, naïve – ünits <{i}>\n" * (i % 4)) for i in range(60)]
    out = M.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).drop("text")
    back = M.restored(out)
    assert {(r["doc_id"], r["text"]) for r in back.collect()} == set(rows)


def test_pieces_share_their_buffer():
    whole = M.Piece(memoryview(b"abcdef"), 0, 6)
    parts = M.cut(whole, [2, 2])
    assert [bytes(x) for x in M.stream(parts)] == [b"ab", b"", b"cdef"]
    assert all(p.buffer is whole.buffer for p in parts)
    out = b"".join(M.stream(M.arrange(parts, "spm")))
    assert out == b"<S>cdef<P>ab<M>" and M.digest(M.restore(out, "spm")) == hashlib.sha256(b"abcdef").hexdigest()


def test_clashing_columns_empty_table_and_small_output_batches(spark, monkeypatch):
    df = spark.createDataFrame([(7, "some text", "x", 1.0)], "doc_id long, text string, form string, fim_id double")
    out = M.fill_in_middle(df)
    assert out.columns == ["doc_id", "text", "fim_id", *M.ADDED.fieldNames()]
    assert out.first()["fim_id"] == 1.0 and out.first()["output_sha256"] == sha(brute(7, "some text")[4])
    assert M.fill_in_middle(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    monkeypatch.setattr(M, "BATCH_BYTES", 10)
    rows = [(i, "words and more words " * (i % 3)) for i in range(30)]
    got = M.fill_in_middle(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["fim_text"]) for r in got} == {(d, brute(d, t)[4]) for d, t in rows}


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op12_fill_in_middle"])
def test_queries_against_sql(spark, name):
    import duckdb
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    cur = con.execute(queries.ORACLES[name])
    cols = [c[0] for c in cur.description]
    got = queries.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(cols)
    assert sorted((tuple(r) for r in got.select(*cols).collect()), key=repr) == sorted(cur.fetchall(), key=repr)
