"""Decontamination against a brute force that knows nothing of seeds."""

from itertools import combinations

from scorecast.llm import decontam as D

W = [f"w{i}" for i in range(30)]


def swapped(words, at):
    return " ".join("other" if i in at else w for i, w in enumerate(words))


def brute(docs, items, size, need):
    out = set()
    for d, t in docs:
        a = t.split()
        for item, u in items:
            b = u.split()
            n = min(size, len(b))
            for diag in range(-len(b), len(a)):
                eq = [0 <= j + diag < len(a) and a[j + diag] == b[j] for j in range(len(b))]
                if b and any(sum(eq[j:j + n]) >= (need if len(b) >= size else n) for j in range(len(b) - n + 1)):
                    out.add((d, item))
    return out


def test_masks_hit_every_placement():
    size, lost = D.PROVED
    for at in combinations(range(size), lost):
        assert any(all(bit == "0" or o + k not in at for k, bit in enumerate(m))
                   for m in D.MASKS for o in range(size - len(m) + 1)), at
    assert all(m[0] == m[-1] == "1" and len(m) == D.SPAN for m in D.MASKS)


def test_all_substitutions_and_short_items(spark):
    docs = [" ".join(["pre", swapped(W[:13], at), "post"]) for at in combinations(range(13), 2)]
    docs += [" ".join(["pre", swapped(W[:13], at), "post"]) for at in combinations(range(13), 3)][::20]
    docs += [swapped(W, range(r, 30, 5)) for r in range(5)]  # every fifth word of a long passage
    docs += ["s1 s2 s3", "x s1 s2 s3 s4 y", "s1 s2 other s4", "solo", "a solo b", " ".join(W[2:13]), "t0 t1 t2 t3 t4 t5 t6 t7 t8 t9 t10 t11"]
    docs = list(enumerate(docs))
    items = list(enumerate([" ".join(W[:13]), " ".join(W), "s1 s2 s3 s4", "solo", "", " ".join(f"t{i}" for i in range(12))]))
    a, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    for size, need, similarity in ((13, 11, 0.8), (10, 8, 0.8), (13, 8, 0.6), (26, 21, 0.8)):
        got = [(r["doc_id"], r["item_id"], r["word_start"], r["word_end"], r["similarity"]) for r in
               D.contaminated_pairs(a, b, min_overlap=size, min_similarity=similarity).collect()]
        assert {x[:2] for x in got} == brute(docs, items, size, need), (size, need)
        if size == 13 and need == 11:
            assert [x[2:] for x in got if x[:2] == (docs[-6][0], 2)] == [(1, 5, 1.0)]
