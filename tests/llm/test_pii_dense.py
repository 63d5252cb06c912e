"""Texts with very many matches, and matches across the pieces of a text."""

import time

from test_pii import brute

from scorecast.llm import pii


def test_dense_matches_in_linear_time(spark):
    unit = "é a{0}@b.co +4912345678 1.2.3.4 DE89370400440532013000 "
    texts = ["".join(unit.format(i) for i in range(n)) for n in (250, 25_000)]  # 100,000 matches
    seconds = []
    for t in texts:
        df = spark.createDataFrame([(1, t)], "doc_id long, text string")
        begun = time.monotonic()
        got = pii.find_pii(df).first()["pii"]
        seconds.append(time.monotonic() - begun)
        assert [(s["kind"], s["start"], s["end"]) for s in got if s["kind"] in pii.BASE] == brute(t)
        iban = [s for s in got if s["kind"] == "iban"]
        assert len(iban) == t.count("DE89") and {t[s["start"]:s["end"]] for s in iban} == {"DE89370400440532013000"}
    assert seconds[1] < 60  # a hundred times the matches; 10,000 times the work would take hours


def test_context_across_pieces(spark):
    rows = []
    for shift in range(pii.PIECE - 60, pii.PIECE + 60):
        rows.append((shift, "😀" * shift + " call +4912345678"))
        rows.append((1000 + shift, "x" * shift + " +4912345678 by phone"))
        rows.append((2000 + shift, "call" + " " * 41 + "x" * shift + " +4912345678"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for r in pii.find_pii(df).collect():
        (s,) = r["pii"]
        assert r["text"][s["start"]:s["end"]] == "+4912345678"
        assert s["score"] == pii.SCORES["phone"] + (0.25 if r["doc_id"] < 2000 else 0.0), r["doc_id"]
