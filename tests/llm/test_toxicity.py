import math
import zlib

import numpy as np

from scorecast.llm import queries
from scorecast.llm import toxicity as T


def corpus(n=400):
    rng = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("lo", "mi", "ta", "ne", "ru", "so") for b in ("ba", "di", "ko", "lu", "pe")]
    docs, labels = [], []
    for i in range(n):
        toxic = int(i % 4 == 0)
        text = [str(w) for w in rng.choice(words, size=rng.integers(5, 40))]
        if toxic:
            text += ["grumble"] * int(rng.integers(1, 3)) + [str(rng.choice(["snarlish", "snarling"]))]
        docs.append((i, " ".join(text)))
        labels.append((i, toxic))
    return docs, labels


def test_nearest_equals_brute_force():
    rng = np.random.default_rng(1)
    n_terms = 30
    rows = []
    for i in range(500):
        t = sorted(rng.choice(n_terms, size=rng.integers(0, 6), replace=False).tolist())
        rows.append((i, int(rng.integers(0, 2)), t, rng.integers(1, 4, size=len(t)).tolist()))
    index = T.BlockMaxIndex(rng.random(n_terms) + 0.5, 16).build(rows)
    dense = np.zeros((500, n_terms))
    for i, _, t, c in rows:
        if t:
            dense[i, index.vector(t, c)[0]] = index.vector(t, c)[1]
    for i in range(0, 500, 7):
        got, sims = index.nearest(rows[i][2], rows[i][3], 10)
        s = np.round(dense @ dense[i], 12)
        want = [j for j in np.lexsort((np.arange(500), -s)) if s[j] > 0][:10]
        assert index.ids[got].tolist() == want
        assert np.allclose(sims, s[want])


def test_learns_and_leaves_clean(spark):
    docs, labels = corpus()
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = {r["doc_id"]: r["score"] for r in T.toxicity_scores(d, lab, ~queries.held_out("doc_id")).collect()}
    held = [(out[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum((s >= 0.7) == bool(y) for s, y in held) >= 0.95 * len(held)
    kept = T.drop_toxic(d, lab, ~queries.held_out("doc_id"))
    assert kept.columns == d.columns and 280 <= kept.count() <= 320


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, y in labels]
    a, b = (sorted((r["doc_id"], round(r["score"], 12)) for r in T.toxicity_scores(
        d, spark.createDataFrame(x, "doc_id long, toxic int"), ~queries.held_out("doc_id")).collect()) for x in (labels, flipped))
    assert a == b


def test_edges(spark):
    docs, labels = corpus(120)
    rows = [(i, t, "x", 1) for i, t in docs] + [(None, None, "x", 1), (500, "", "x", 1), (501, "grumble " * 50000, "x", 1),
                                               (7, "grumble snarling", "x", 1), (None, docs[0][1], "x", 1)]
    d = spark.createDataFrame(rows, "doc_id long, text string, score string, terms int")
    lab = spark.createDataFrame(labels + [(None, 1), (8, 1), (9, None), (10, 5)], "doc_id long, toxic int")
    got = T.toxicity_scores(d, lab).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 and not math.isnan(r["score"]) for r in got)
    assert T.drop_toxic(d, lab).columns == d.columns
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in T.toxicity_scores(d, none).collect()} == {0.0}
    assert T.toxicity_scores(d.limit(0), lab).count() == 0
    assert T.drop_toxic(d, none).count() == len(rows)


def brute_scores(docs, labels, learned, s):
    """Scores from the texts, without an index: dense cosines of all terms."""
    words = lambda t: T.WORD.findall(t.lower())
    fit = [(i, docs[i], labels[i]) for i, part in learned if part == 0]
    held = [(i, docs[i], labels[i]) for i, part in learned if part == 1]
    terms = sorted({w for _, t, _ in fit for w in words(t)})
    n, p = len(fit), sum(y for _, _, y in fit)
    weight = {}
    for w in terms:
        a = sum(y for _, t, y in fit if w in words(t))
        b = sum(1 - y for _, t, y in fit if w in words(t))
        c, d = p - a, n - p - b
        chi = n * (a * d - b * c) ** 2 / max((a + b) * (c + d) * (a + c) * (b + d), 1)
        df = sum(w in words(t) for t in docs.values())
        weight[w] = (math.log((1 + len(docs)) / (1 + df)) + 1) * (s.relevance_floor + chi / (chi + s.relevance_half))

    def unit(text):
        c = {w: words(text).count(w) for w in set(words(text)) if w in weight}
        v = {w: (1 + math.log(m)) * weight[w] for w, m in c.items()}
        size = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / size for w, x in v.items()}

    units = [(i, y, unit(t)) for i, t, y in fit]
    base = sum(y for _, _, y in held) / len(held)

    def vote(text):
        q = unit(text)
        sims = [(round(sum(x * v[w] for w, x in q.items() if w in v), 12), i, y) for i, y, v in units]
        best = sorted((-c, i, y) for c, i, y in sims if c > 0)[:s.k]
        return ((sum(-c * y for c, _, y in best) + s.shrink * base) / (sum(-c for c, _, _ in best) + s.shrink),
                [i for _, i, _ in best[:5]])

    slope, shift = T._logistic_fit(np.array([T._logit(vote(t)[0]) for _, t, _ in held]), np.array([float(y) for _, _, y in held]))
    out = {}
    for i, t in docs.items():
        v, near = vote(t)
        out[i] = (1 / (1 + math.exp(-max(-30, min(30, slope * T._logit(v) + shift)))), near)
    return out


def test_scores_equal_brute_force_from_texts(spark):
    docs, labels = corpus(160)
    docs += [(900, ""), (901, "unseen wording"), (902, docs[0][1])]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    s = T.Settings(block=8)
    learned = [(r["id"], r["part"]) for r in T._sample(T._labelled(lab, "doc_id", "toxic", None), s).collect()]
    want = brute_scores(dict(docs), dict(labels), learned, s)
    got = {r["doc_id"]: r for r in T.toxicity_scores(d, lab, settings=s).collect()}
    assert got.keys() == want.keys()
    for i, (score, near) in want.items():
        assert math.isclose(got[i]["score"], score, rel_tol=1e-6), i
        assert got[i]["evidence"] == near, i
    assert got[900]["evidence"] == got[901]["evidence"] == []


def test_every_text_that_shares_a_word_has_evidence(spark):
    docs, labels = corpus(120)
    docs += [(800, "only loba and nothing else known"), (801, "nothing else known")]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    got = {r["doc_id"]: r["evidence"] for r in
           T.toxicity_scores(d, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert [i for i, e in got.items() if not e] == [801]


def test_examples_bounded_by_characters(spark):
    rows = [(i, 0, 0, "x" * 10) for i in range(20)]
    ex = spark.createDataFrame(rows, "id long, toxic int, part int, text string")
    assert T._within_chars(ex, 35).count() == 4 and T._within_chars(ex, 10 ** 6).count() == 20
