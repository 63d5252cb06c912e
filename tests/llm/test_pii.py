import hashlib
import re

from scorecast.llm import pii, queries

KINDS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
         ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
         ("card", r"[0-9]([\x20-]?[0-9])+"),
         ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    return sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def brute(text):
    out = []
    for kind, pat in KINDS:
        for m in re.finditer(pat, text or ""):
            s = m.group()
            d = re.sub("[^0-9]", "", s)
            ok = {"email": True, "ip": all(int(x) <= 255 for x in s.split(".")) if kind == "ip" else None,
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


HARD = [
    "a@b.c@d.e x a@b.com_x@y.com a@b @c.d a.b+c%d-e@f-g.h.i. é@b.co née@b.co",
    "1.2.3.4.5.6.7.8 256.1.1.1 1.256.1.1.1 0001.2.3.255 1.2.3 1..2.3.4 12345678.1.1.1 a1.2.3.4b 1.2.3.4.",
    "4111 1111 1111 1111 4111-1111-1111-1111 4111--1111 1111 1111 1111 41111111111111111 4111 1111  1111 1111",
    "4111111111111111 4222222222222 6011000990139424 378282246310005 6304 0000 0000 0000 000 0000 0000 0000 0000 0000",
    "+1 (017) 555-7713 +1 555 +49.30.1234567 ++491234567 +1(2) +1 (2) 3-4.5 6 7 8 9 0 1 2 3 4 5 6 7 +123456789\n+5",
    "😀 a@b.co 😀 +4912345678 𝔸1.2.3.4 ñ",
    "", " ", None, "9" * 5000, "1 " * 4000, "a" * 5000 + "@", "1." * 3000, "+" * 3000, "@" * 3000,
    "IBAN GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765433 DE89370400440532013000",
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962" password: short',
]


def test_base_spans_equal_plain_patterns(spark):
    df = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.find_pii(df).collect()}
    for i, t in enumerate(HARD):
        base = [(s["kind"], s["start"], s["end"]) for s in got[i]["pii"] if s["kind"] in pii.BASE]
        assert base == brute(t), (i, t and t[:60])


def test_added_kinds_and_context(spark):
    df = spark.createDataFrame([(1, HARD[-2]), (2, HARD[-1]), (3, "call me: +4912345678")], "doc_id long, text string")
    got = {r["doc_id"]: r["pii"] for r in pii.find_pii(df).collect()}
    iban = [(s["start"], s["end"]) for s in got[1] if s["kind"] == "iban"]
    assert [HARD[-2][a:b] for a, b in iban] == ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"]
    assert [s["kind"] for s in got[2]] == ["secret"]
    assert got[3][0]["score"] == pii.SCORES["phone"] + 0.25


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in queries.op3_pii(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for d in docs:
        spans = brute(d["text"])
        r = got[d["doc_id"]]
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert r["base_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert [r[f"n_{k}"] for k, _ in KINDS] == [sum(s[0] == k for s in spans) for k, _ in KINDS]
        assert set(text.split(",")) <= set(r["spans"].split(",")) or not text


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pii.find_pii(empty).count() == 0
    odd = spark.createDataFrame([(None, "a@b.co", "x", 1), (None, "a@b.co", "x", 1), (5, None, None, None)],
                                "doc_id long, text string, pii string, pii_text int")
    rows = pii.find_pii(odd).collect()
    assert len(rows) == 3 and sorted(len(r["pii"]) for r in rows) == [0, 1, 1]
    assert sorted(pii.find_pii(odd).columns) == ["doc_id", "pii", "pii_text", "text"]
