"""Toxicity scores from the nearest labelled examples.

Terms are lower-cased words. A bounded sample of labelled rows
(``Settings.toxic_examples``, ``clean_examples``, ``example_chars``) gives the
examples; every word of theirs is a term and is indexed. A weight is
TF-IDF, with document frequencies counted over all documents, times the term's
relevance: ``floor + x / (x + half)`` with x the chi-square of the term's presence
against the label among the examples. It is positive for every term, so all
documents that share a word with an example have neighbours. The examples' unit
vectors form an inverted index whose postings are cut into blocks with the
largest weight of each term per block: the blocks with the highest score bounds
are searched first, then only those whose bound can still reach the ``k`` nearest
examples, so the nearest examples and their cosines are exact. Their
cosine-weighted vote, shrunk towards the base rate, is calibrated by a logistic
curve fitted on further labelled rows (``calibration_rows``) that are not in the
index. The nearest examples are the evidence of a score.

Defined results
  * null or empty text, or no word of any example: the score of a vote without
    evidence; words that no example holds have no part in a cosine;
  * no usable labelled rows: every score is 0;
  * a labelled id with several rows counts once (smallest text), one with
    contradicting labels not at all; null ids are scored and never learned from.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from scorecast.llm.common import arrow_map, free_name, written

WORD = re.compile(r"[^\W\d_]+")
PROBE = 8  # blocks that give the first bound of a search
# A worker's memo of scored texts is emptied beyond this many entries.
MEMO_ENTRIES = 2000


@dataclass(frozen=True)
class Settings:
    """Bounds of the learned model; none of them bounds the scored rows."""

    toxic_examples: int = 1500
    clean_examples: int = 2500
    calibration_rows: int = 2000
    example_chars: int = 40_000_000  # of all sampled texts; the text that crosses it is the last
    relevance_floor: float = 0.02
    relevance_half: float = 25.0
    k: int = 25
    shrink: float = 0.3
    block: int = 64


def text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _lists(values: list[np.ndarray]) -> pa.ListArray:
    flat = np.concatenate(values) if values else np.empty(0, dtype=np.int32)
    ends = np.cumsum([0, *(len(v) for v in values)])
    return pa.ListArray.from_arrays(pa.array(ends, type=pa.int32()), pa.array(flat, type=pa.int32()))


def term_vectors(docs: DataFrame, terms: Broadcast, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` and (terms, counts) of every row: numbers of the known words of
    its text, ascending, with their counts. ``terms`` is a broadcast word list."""
    src = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias(text_col))
    out = StructType([*src.schema.fields[:-1], *(StructField(c, ArrayType(IntegerType())) for c in ("terms", "counts"))])

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = {w: i for i, w in enumerate(terms.value)}
        for b in it:
            ts, cs = [], []
            for t in b.column(len(keep)).to_pylist():
                found = sorted((index[w], n) for w, n in Counter(WORD.findall(t.lower())).items() if w in index)
                pairs = np.array(found, dtype=np.int32).reshape(-1, 2)
                ts.append(pairs[:, 0])
                cs.append(pairs[:, 1])
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _lists(ts), _lists(cs)], names=out.names)

    return arrow_map(src, out, run)


def example_terms(examples: DataFrame) -> tuple[list[str], np.ndarray]:
    """Every word of the (text, toxic) rows, in code-point order, and its
    chi-square against the label."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            n: Counter = Counter()
            pos: Counter = Counter()
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = set(WORD.findall(t.lower()))
                n.update(found)
                if y:
                    pos.update(found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(n), type=pa.string()), pa.array([pos[t] for t in n], type=pa.int64()),
                 pa.array(list(n.values()), type=pa.int64())], names=["term", "pos", "n"])

    total = examples.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("p")).first()
    n_all, p_all = total["n"], total["p"] or 0
    # bounded by Settings.example_chars
    got = (arrow_map(examples.select("text", "toxic"), "term string, pos long, n long", run)
           .groupBy("term").agg(F.sum("pos").alias("a"), F.sum("n").alias("n")).toArrow().sort_by("term"))
    a, n = (got.column(c).to_numpy().astype(float) for c in ("a", "n"))
    b, c = n - a, p_all - a
    d = (n_all - p_all) - b
    chi = n_all * (a * d - b * c) ** 2 / np.maximum((a + b) * (c + d) * (a + c) * (b + d), 1.0)
    return got.column("term").to_pylist(), chi


def _ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The numbers start[i], ..., start[i] + length[i] - 1 of all i, in order."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


@dataclass
class BlockMaxIndex:
    """Inverted index of unit vectors with block maxima."""

    weight: np.ndarray                      # per term: IDF times relevance
    block: int
    ids: np.ndarray = field(init=False)
    toxic: np.ndarray = field(init=False)
    rows: np.ndarray = field(init=False)    # postings by term, then example number
    parts: np.ndarray = field(init=False)   # their weights
    cells: np.ndarray = field(init=False)   # per term: its first (term, block) cell; one more at the end
    blocks: np.ndarray = field(init=False)  # per cell: block, largest weight, first posting (one more)
    maxima: np.ndarray = field(init=False)
    first: np.ndarray = field(init=False)

    def vector(self, terms, counts) -> tuple[np.ndarray, np.ndarray]:
        t = np.asarray(terms, dtype=np.int64)
        w = (1 + np.log(np.asarray(counts, dtype=float))) * self.weight[t]
        return t, w / math.sqrt(float(w @ w)) if len(t) else w

    def build(self, examples: list[tuple]) -> "BlockMaxIndex":
        """examples: (id, toxic, terms, counts); those without terms have no
        cosine and are left out. Similar examples get neighbouring numbers."""
        vecs = [(i, y, *self.vector(t, c)) for i, y, t, c in examples if len(t)]
        vecs.sort(key=lambda v: (int(v[2][np.argmax(v[3])]), v[0]))
        self.ids = np.array([v[0] for v in vecs], dtype=np.int64)
        self.toxic = np.array([v[1] for v in vecs], dtype=float)
        term = np.concatenate([v[2] for v in vecs]) if vecs else np.empty(0, dtype=np.int64)
        row = np.repeat(np.arange(len(vecs)), [len(v[2]) for v in vecs])
        order = np.argsort(term, kind="stable")  # rows stay ascending within a term
        term, self.rows = term[order], row[order]
        self.parts = (np.concatenate([v[3] for v in vecs]) if vecs else np.empty(0))[order]
        cell = term * (len(vecs) // self.block + 1) + self.rows // self.block
        start = np.flatnonzero(np.diff(cell, prepend=-1))
        self.first = np.append(start, len(cell))
        self.blocks = self.rows[start] // self.block
        self.maxima = np.maximum.reduceat(self.parts, start) if len(start) else np.empty(0)
        self.cells = np.searchsorted(term[start], np.arange(len(self.weight) + 1))
        return self

    def _cosines(self, cells: np.ndarray, w: np.ndarray) -> np.ndarray:
        n = self.first[cells + 1] - self.first[cells]
        at = _ranges(self.first[cells], n)
        return np.bincount(self.rows[at], weights=self.parts[at] * np.repeat(w, n), minlength=len(self.ids))

    def nearest(self, terms, counts, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(example numbers, cosines) of the k nearest, exactly; ties go to
        the smaller id. Only examples that share a term are returned."""
        if not len(terms) or not len(self.ids):
            return np.empty(0, dtype=np.int64), np.empty(0)
        t, w = self.vector(terms, counts)
        n = self.cells[t + 1] - self.cells[t]
        cells, w = _ranges(self.cells[t], n), np.repeat(w, n)
        block = self.blocks[cells]
        bound = np.bincount(block, weights=w * self.maxima[cells], minlength=len(self.ids) // self.block + 1)
        live = bound > 0
        if live.sum() > PROBE:
            # the most promising blocks give a lower bound of the k-th cosine;
            # blocks that cannot reach it are not looked at
            probe = np.zeros(len(bound), dtype=bool)
            probe[np.argpartition(-bound, PROBE)[:PROBE]] = True
            s = self._cosines(cells[probe[block]], w[probe[block]])
            if len(s) > k:
                live &= bound >= np.partition(s, len(s) - k)[len(s) - k] - 1e-12
        cos = self._cosines(cells[live[block]], w[live[block]])
        near = np.flatnonzero(cos)
        if len(near) > k:
            near = near[cos[near] >= np.partition(cos[near], len(near) - k)[len(near) - k] - 1e-12]
        best = near[np.lexsort((self.ids[near], -np.round(cos[near], 12)))[:k]]
        return best, cos[best]


@dataclass
class ToxicityModel:
    index: BlockMaxIndex | None
    base: float
    settings: Settings
    slope: float = 1.0
    shift: float = 0.0

    def vote(self, terms, counts) -> tuple[float, np.ndarray]:
        rows, sims = self.index.nearest(terms, counts, self.settings.k)
        s = self.settings.shrink
        return (float(sims @ self.index.toxic[rows]) + s * self.base) / (float(sims.sum()) + s), self.index.ids[rows[:5]]

    def score(self, vote: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, self.slope * _logit(vote) + self.shift))))


def _logit(p: float) -> float:
    p = min(max(p, 1e-6), 1 - 1e-6)
    return math.log(p / (1 - p))


def _logistic_fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve (Newton steps, smoothed targets)."""
    pos, neg = y.sum(), len(y) - y.sum()
    goal = np.where(y > 0, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([(x * (p - goal)).sum() + 1e-3 * a, (p - goal).sum()])
        h = np.array([[(w * x * x).sum() + 1e-3, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-9]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 1e-3), float(b)


def _labelled(labels: DataFrame, id_col: str, label_col: str, learn: Column | None) -> DataFrame:
    lab = labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1))
    if learn is not None:
        lab = lab.filter(learn)
    return (lab.groupBy(F.col(id_col).cast("long").alias("id"))
            .agg(F.min(label_col).alias("toxic"), F.max(label_col).alias("hi"))
            .filter("toxic = hi").select("id", F.col("toxic").cast("int").alias("toxic")))


def _sample(labelled: DataFrame, s: Settings) -> DataFrame:
    """(id, toxic, part): part 0 fits the index, part 1 the calibration. Rows
    are taken in the order of a hash of the id; at most the documented bounds."""
    h = F.xxhash64("id", F.lit("toxicity"))
    calib = F.pmod(F.xxhash64("id", F.lit("part")), F.lit(4)) == 0
    parts = [(labelled.filter(~calib & (F.col("toxic") == 1)), s.toxic_examples, 0),
             (labelled.filter(~calib & (F.col("toxic") == 0)), s.clean_examples, 0),
             (labelled.filter(calib), s.calibration_rows, 1)]
    out = [d.orderBy(h, "id").limit(n).withColumn("part", F.lit(p)) for d, n, p in parts]
    return out[0].union(out[1]).union(out[2])


def _within_chars(examples: DataFrame, bound: int) -> DataFrame:
    """The rows, in the order of a hash of the id, up to the one that crosses
    ``bound`` characters in all. The window sees the sample's rows only."""
    before = Window.orderBy(F.xxhash64("id", F.lit("chars")), "id").rowsBetween(Window.unboundedPreceding, -1)
    kept = (examples.select("id", F.sum(F.length("text")).over(before).alias("before"))
            .filter(F.coalesce("before", F.lit(0)) < bound).select("id"))
    return examples.join(F.broadcast(kept), "id", "left_semi")


def toxicity_scores(docs: DataFrame, labels: DataFrame, learn: Column | None = None, *, id_col: str = "doc_id",
                    text_col: str = "text", label_col: str = "toxic", settings: Settings = Settings()) -> DataFrame:
    """(doc_id, text_key, score, evidence) for every row of ``docs``.

    ``learn`` is a condition on ``labels`` that says which rows may be learned
    from. ``evidence`` holds the ids of the nearest labelled examples.
    """
    context = docs.sparkSession.sparkContext
    # bounded by the settings, and so are its broadcast, its words and vectors
    sample = written(_sample(_labelled(labels, id_col, label_col, learn), settings), "tox-sample")
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    examples = written(_within_chars(written(
        texts.join(F.broadcast(sample), "id").groupBy("id", "toxic", "part").agg(F.min("text").alias("text")),
        "tox-sampled"), settings.example_chars), "tox-examples")
    words, chi = example_terms(examples.filter("part = 0"))
    terms = context.broadcast(words)
    src = texts.withColumn("text_key", text_key("text"))
    vectors = written(term_vectors(src, terms, ["id", "text_key"]), "tox-vectors", compression="zstd")
    shared = context.broadcast(_fit(vectors, examples, terms, chi, settings))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        memo: dict[tuple, tuple[float, list[int]]] = {}
        for b in it:
            scores, ids = [], []
            for t, c in _arrays(b.column(2), b.column(3)):
                key = (t.tobytes(), c.tobytes())
                got = memo.get(key)
                if got is None:
                    if len(memo) >= MEMO_ENTRIES:
                        memo.clear()
                    if m.index is None:
                        got = (0.0, [])
                    else:
                        vote, near = m.vote(t, c)
                        got = (m.score(vote), near.tolist())
                    memo[key] = got
                scores.append(got[0])
                ids.append(got[1])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(scores, type=pa.float64()), pa.array(ids, type=pa.list_(pa.int64()))],
                names=["doc_id", "text_key", "score", "evidence"])

    return arrow_map(vectors, "doc_id long, text_key long, score double, evidence array<long>", run)


def _arrays(terms: pa.Array, counts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The vectors of two list columns of equal lengths."""
    ends = np.cumsum([0, *pc.list_value_length(terms).to_pylist()])
    t, c = terms.flatten().to_numpy(), counts.flatten().to_numpy()
    for i, j in zip(ends[:-1], ends[1:]):
        yield t[i:j], c[i:j]


def _fit(vectors: DataFrame, examples: DataFrame, terms: Broadcast, chi: np.ndarray, settings: Settings) -> ToxicityModel:
    """Document frequencies over all documents; index and calibration from the
    bounded sample."""
    found = term_vectors(examples, terms, ["id", "toxic", "part"]).toArrow().sort_by("id").combine_chunks()
    cols = [found.column(c).to_pylist() for c in ("id", "toxic", "part")]
    lists = [found.column(c).combine_chunks() for c in ("terms", "counts")]
    rows = [(*r, *v) for r, v in zip(zip(*cols), _arrays(*lists))]
    fit = [(i, y, t, c) for i, y, part, t, c in rows if part == 0]
    if not fit:
        return ToxicityModel(None, 0.0, settings)
    n = vectors.count()
    counted = (vectors.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n"))
               .toArrow())  # one row per term of the examples
    df = np.zeros(len(chi))
    df[counted.column("t").to_numpy()] = counted.column("n").to_numpy()
    weight = (np.log((1 + n) / (1 + df)) + 1) * (settings.relevance_floor + chi / (chi + settings.relevance_half))
    near = [r for r in rows if r[2] == 1] or rows
    y = np.array([r[1] for r in near], dtype=float)
    model = ToxicityModel(BlockMaxIndex(weight, settings.block).build(fit), float(y.mean()), settings)
    x = np.array([_logit(model.vote(r[3], r[4])[0]) for r in near])
    if 0 < y.sum() < len(y):
        model.slope, model.shift = _logistic_fit(x, y)
    return model


def drop_toxic(docs: DataFrame, labels: DataFrame, learn: Column | None = None, *, id_col: str = "doc_id",
               text_col: str = "text", reject_at: float = 0.7, **settings) -> DataFrame:
    """The rows of ``docs`` with a score below ``reject_at``."""
    gone = (toxicity_scores(docs, labels, learn, id_col=id_col, text_col=text_col, **settings)
            .filter(F.col("score") >= reject_at).select("doc_id", "text_key").distinct())
    a, b = free_name(docs.columns, "tx_id"), free_name(docs.columns, "tx_key")
    gone = gone.select(F.col("doc_id").alias(a), F.col("text_key").alias(b))
    return docs.join(gone, (text_key(text_col) == F.col(b)) & F.col(id_col).cast("long").eqNullSafe(F.col(a)),
                     "left_anti")
