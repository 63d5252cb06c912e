import random
import re
import zlib
from collections import Counter

import pytest

from scorecast.llm import queries
from scorecast.llm import spelling as M

LOW = {c: c + 32 for c in range(65, 91)}


def brute_counts(rows, min_chars=7, min_count=2, every=31):
    counts = Counter()
    for d, t in rows:
        for r in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            r = r.translate(LOW)
            h = zlib.crc32(f"{'' if d is None else d}:{r}".encode())
            if h % every == 0:
                r = r[:h % len(r)] + r[h % len(r) + 1:]
            if len(r) >= min_chars:
                counts[r] += 1
    return {w: n for w, n in counts.items() if n >= min_count}


def one_error(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=10):
    near = {w: [o for o in counts if one_error(w, o)] for w in counts}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda o: (-counts[o], o), default=None)
        form[w] = best if best and counts[best] >= ratio * n else None
    out = set()
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.add((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def misspelt(rng, w):
    at = rng.randrange(len(w))
    return {0: w[:at] + w[at + 1:], 1: w[:at] + rng.choice("abéÿ") + w[at:], 2: w[:at] + rng.choice("xyÀ÷") + w[at + 1:]}[rng.randrange(3)]


def corpus(rng, words, n):
    rows = []
    for i in range(n):
        text = [w if rng.random() < 0.9 else misspelt(rng, misspelt(rng, w) if rng.random() < 0.3 else w) for w in rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=30)]
        rows.append((i if i % 9 else None, rng.choice((" ", ", ", "1", "\n")).join(text)))
    return rows


@pytest.mark.parametrize("block_words", [4096, 8, 3])
def test_against_brute_force(spark, block_words):
    rng = random.Random(11)
    words = ["language", "languages", "sprache", "informationen", "Straßenbahn", "étranger", "ÉTRANGER", "aaaaaaa", "aaaaaaaa", "aaaaaab",
             "language" * 30, "bbbbbbbbb", "running", "runnings", "cunnings"]
    rows = corpus(rng, words, 150) + [(1, None), (2, ""), (3, "short words only"), (4, "x" * 5000 + " " + "x" * 4999), (4, "x" * 5000 + " " + "x" * 4999)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(M.spelling_forms(df, block_words=block_words)) == brute(brute_counts(rows))


def test_long_chains_of_forms(spark):
    # n grows tenfold with each letter, so the forms make one chain
    rows = [(i, " ".join([w] * n)) for i, (w, n) in enumerate([("abcdefgh", 2), ("abcdefghi", 6), ("abcdefghij", 18), ("abcdefghijk", 54), ("abcdefghijkl", 162)])]
    counts = brute_counts(rows)
    want = brute(counts, ratio=3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(M.spelling_forms(df, ratio=3.0)) == want
    assert sum(r[2] != r[0] for r in want) >= 2


def test_index_tracks_one_error():
    rng = random.Random(2)
    words = list({"".join(rng.choice("abc") for _ in range(rng.randint(4, 7))) for _ in range(300)})
    q, w = M.BitSlices(words).near(words)
    want = {(a, b) for a in words for b in words if one_error(a, b) and len(b) >= len(a)}
    assert {(words[i], words[j]) for i, j in zip(q, w)} == want and len(q) == len(want)


def test_ties_empty_and_clashing_columns(spark):
    rows = [(1, "aaaaaaa " * 2 + "aaaaaab " * 40 + "aaaaaac " * 40, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string")
    assert got(M.spelling_forms(df)) == brute(brute_counts([r[:2] for r in rows]))
    assert M.spelling_forms(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    with pytest.raises(ValueError):
        M.spelling_forms(df, ratio=1.0)


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    out = queries.op13_spelling_variants(spark, sf)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert got(out) == brute(brute_counts(rows))
