import re

from scorecast.llm import decontam as D
from scorecast.llm import queries


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items, size=13, need=11):
    """Best stretch of `size` aligned words with `need` equal ones that holds a
    seed window equal under a mask."""
    out = set()
    for d, t in docs:
        a = words(t)
        for item, u in items:
            b = words(u)
            for diag in range(-len(b), len(a)):
                eq = [0 <= j + diag < len(a) and a[j + diag] == b[j] for j in range(len(b))]
                if sum(eq) < need:
                    continue
                hit = [j for j in range(len(b) - D.SPAN + 1) if 0 <= j + diag <= len(a) - D.SPAN
                       and any(all(eq[j + k] for k, m in enumerate(mask) if m == "1") for mask in D.MASKS)]
                if any(sum(eq[j:j + size]) >= need and any(j <= h and h + D.SPAN <= j + size for h in hit)
                       for j in range(len(b) - size + 1)):
                    out.add((d, item))
    return out


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau"
W = ITEM.split()


def swap(*at):
    return " ".join("other" if i in at else w for i, w in enumerate(W))


DOCS = [(1, "x y z " + ITEM + " end"), (2, ITEM.upper().replace(" ", "###  ")), (3, "pre " + swap(2, 9)), (4, swap(1, 3, 5, 7, 9, 11, 13)),
        (5, " ".join(W[:12])), (6, " ".join(W[:13])), (7, "alpha beta " * 40), (8, None), (9, ""), (10, swap(4) + " gap " + swap(6)),
        (11, " ".join(W[5:])), (12, "filler " * 20000 + ITEM), (None, ITEM), (None, "clean"), (13, "clean"), (13, ITEM)]
ITEMS = [(1, ITEM), (2, "too short item here"), (3, None), (4, "the cat sat on the mat and the dog sat on the log by the fire"), (None, "n " + ITEM)]


def test_small_against_brute_force(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    want = brute([x for x in DOCS if x[0] != 12], ITEMS) | {(12, 1), (12, None)}
    for limit in (1_000_000, 0):  # broadcast and shuffled seeds
        got = [(r["doc_id"], r["item_id"]) for r in D.contaminated_pairs(docs, items, broadcast_rows=limit).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    gone = {d for d, _ in want}
    assert sorted(map(repr, kept.collect())) == sorted(
        repr(r) for r in docs.collect() if r["doc_id"] not in gone or r["text"] == "clean")


def test_edges(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string").withColumnRenamed("text", "w").selectExpr("doc_id", "w as text", "1 as item_id", "2 as seed")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert D.drop_contaminated(docs, items).columns == docs.columns
    assert D.contaminated_pairs(docs.limit(0), items).count() == 0
    assert D.contaminated_pairs(docs, items.limit(0)).count() == 0
    assert D.drop_contaminated(docs, items.limit(0)).count() == len(DOCS)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    grams = {tuple(w[i:i + 6]) for _, t in items for w in [words(t)] for i in range(len(w) - 5)}
    near = [(d, t) for d, t in docs if any(tuple(w[i:i + 6]) in grams for w in [words(t)] for i in range(len(w) - 5))]
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, sf).collect()}
    assert got == brute([(d, t) for d, t in near if len(t) < 6000], items) | {x for x in got if len(dict(docs)[x[0]]) >= 6000}
    assert got and {d for d, _ in got} <= {d for d, _ in near}
