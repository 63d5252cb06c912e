"""Approximate nearest neighbours by a forest of random-projection trees.

The trees are fitted on a bounded sample (``SAMPLE`` vectors, fewer when they
are very long: ``SAMPLE_VALUES`` components at most): a node splits
by the hyperplane half-way between two of its sampled vectors, down to leaves
of at most ``leaf`` sampled vectors. Every vector of the table is then filed
under one leaf per tree. Largest inner product becomes smallest angle by one
extra coordinate that gives all candidates the same norm.

A query searches all trees through one shared priority queue, ordered by the
smallest margin on the way to a node, until the leaves found hold enough filed
vectors (a share of the table, counted over all trees). Leaves are split into chunks of at most ``CHUNK``
vectors (a common vector fills a leaf), and the pairs (chunk, queries) are
scored as one group each, keeping the ``k`` best of a query per chunk; the
exact inner products of the survivors are ranked again per query.

Sizes: the forest depends on the sample only; chunks grow with the table.

Defined results
  * vectors that are null, zero, or hold null or non-finite components, and
    vectors with a null id take no part; so do vectors of another length than
    the most common one;
  * equal scores rank by smaller id; rows that share an id count once (the
    smallest vector); fewer candidates than ``k`` give fewer rows;
  * an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorecast.llm.common import written

SAMPLE = 20_000
SAMPLE_VALUES = 4_000_000
CHUNK = 4096


@dataclass
class Tree:
    """Inner node i: normal[i], offset[i], children (left, right); children
    below 0 are leaves, numbered from -1 downwards."""

    normal: np.ndarray
    offset: np.ndarray
    left: np.ndarray
    right: np.ndarray
    leaves: int

    def file(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row of x."""
        at = np.full(len(x), 0 if len(self.left) else -1, dtype=np.int64)
        going = np.flatnonzero(at >= 0)
        while len(going):
            node = at[going]
            margin = np.einsum("ij,ij->i", x[going], self.normal[node]) - self.offset[node]
            at[going] = np.where(margin > 0, self.right[node], self.left[node])
            going = going[at[going] >= 0]
        return -at - 1


def grow(x: np.ndarray, leaf: int, rng: np.random.Generator) -> Tree:
    """A tree over the sampled rows x."""
    normal, offset, left, right = [], [], [], []
    leaves = 0
    todo = [(np.arange(len(x)), None, 0)]
    while todo:
        rows, parent, side = todo.pop()
        split = None
        if len(rows) > leaf:
            for _ in range(4):
                a, b = x[rng.choice(rows, 2, replace=False)]
                n = a - b
                if not n.any():
                    continue
                margin = x[rows] @ n
                cut = float(np.median(margin))
                up = margin > cut
                if 0 < up.sum() < len(rows):
                    split = (n, cut, up)
                    break
        if split is None:
            me = -leaves - 1
            leaves += 1
        else:
            me = len(normal)
            normal.append(split[0])
            offset.append(split[1])
            left.append(0)
            right.append(0)
            todo.append((rows[~split[2]], me, 0))
            todo.append((rows[split[2]], me, 1))
        if parent is not None:
            (right if side else left)[parent] = me
    width = x.shape[1]
    return Tree(np.array(normal).reshape(-1, width), np.array(offset), np.array(left, dtype=np.int64),
                np.array(right, dtype=np.int64), max(leaves, 1))


def search(trees: list[Tree], sizes: list[np.ndarray], q: np.ndarray, enough: int) -> list[tuple[int, int]]:
    """(tree, leaf) pairs visited for query q through one priority queue, until
    the leaves hold ``enough`` vectors (counted over all trees)."""
    heap = [(-np.inf, t, 0 if len(tree.left) else -1) for t, tree in enumerate(trees)]
    heapq.heapify(heap)
    dots = [tree.normal @ q - tree.offset for tree in trees]
    scale = [np.sqrt((tree.normal ** 2).sum(axis=1)) for tree in trees]
    out, held = [], 0
    while heap and held < enough:
        bound, t, node = heapq.heappop(heap)
        tree = trees[t]
        while node >= 0:
            m = dots[t][node] / scale[t][node]
            near, far = (tree.right[node], tree.left[node]) if m > 0 else (tree.left[node], tree.right[node])
            heapq.heappush(heap, (max(bound, abs(m)), t, int(far)))
            node = int(near)
        out.append((t, -node - 1))
        held += int(sizes[t][-node - 1])
    return out


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v): the vectors that take part, as double arrays, one per id."""
    v = F.col(vec_col).cast("array<double>")
    fine = F.col(id_col).isNotNull() & F.coalesce(
        F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0),
        F.lit(False))
    rows = vectors.filter(fine).groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(v).alias("v"))
    rows = written(rows.withColumn("d", F.size("v")), "ann-vectors")
    common = rows.groupBy("d").count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.col("d") == (common["d"] if common else 0)).select("id", "v")


def _matrix(col: pa.Array, d: int) -> np.ndarray:
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(-1, d)


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    """Candidates with one more coordinate, all of norm ``most``."""
    return np.hstack([x, np.sqrt(np.maximum(most ** 2 - (x * x).sum(axis=1), 0))[:, None]])


def products(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Inner products in double precision, summed in order of the components,
    so that equal vectors get equal scores wherever they are."""
    out = np.zeros(len(x))
    for j in range(x.shape[1]):
        out += x[:, j] * q[j]
    return out


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vec_col: str = "embedding", *, k: int = 20,
            trees: int = 8, leaf: int = 128, search_share: float = 1.0, search_least: int = 4000, seed: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of every row that
    fits ``is_query`` (a condition on ``id``), by largest inner product.

    A query inspects leaves with at least ``search_least`` filed vectors and at
    least ``search_share`` of the table's number, counted over all trees (a
    vector counts in every tree). Vectors without any structure need a large
    share for a high recall; for clustered ones a small share is enough.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    schema = "query_id long, rank int, vec_id long, score double"
    stats = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d"), F.max(
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    if not stats["n"]:
        return spark.createDataFrame([], schema)
    n, d, most = stats["n"], stats["d"], float(np.sqrt(stats["m"]))
    sample = rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(
        max(1, min(SAMPLE, SAMPLE_VALUES // d))).collect()  # bounded
    x = _lift(np.array([r["v"] for r in sample]), most)
    rng = np.random.default_rng(seed)
    forest = [grow(x, leaf, rng) for _ in range(trees)]
    shared = spark.sparkContext.broadcast(forest)

    def file(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            y = _lift(_matrix(b.column(1), d), most)
            ids = b.column(0).to_numpy()
            for t, tree in enumerate(shared.value):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), t, dtype=np.int32)), pa.array(tree.file(y).astype(np.int32)),
                     b.column(0), b.column(1)], names=["tree", "leaf", "id", "v"])

    filed = written(rows.mapInArrow(file, "tree int, leaf int, id long, v array<double>"), "ann-leaves")
    sizes = [np.zeros(t.leaves, dtype=np.int64) for t in forest]
    for r in filed.groupBy("tree", "leaf").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per leaf
        sizes[r["tree"]][r["leaf"]] = r["n"]
    chunks = [np.maximum(1, -(-s // CHUNK)) for s in sizes]
    plan = spark.sparkContext.broadcast((sizes, chunks))
    enough = max(search_least, int(search_share * n))

    def probe(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sz, ch = plan.value
        for b in it:
            out = []
            for i, q in zip(b.column(0).to_pylist(), _matrix(b.column(1), d)):
                for t, lf in search(shared.value, sz, np.append(q, 0.0), enough):
                    out += [(t, lf, c, i, q) for c in range(int(ch[t][lf]))]
            cols = list(zip(*out)) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], type=pa.int32()), pa.array(cols[1], type=pa.int32()), pa.array(cols[2], type=pa.int32()),
                 pa.array(cols[3], type=pa.int64()), pa.array(list(cols[4]), type=pa.list_(pa.float64()))],
                names=["tree", "leaf", "chunk", "query_id", "q"])

    queries = rows.filter(is_query).mapInArrow(probe, "tree int, leaf int, chunk int, query_id long, q array<double>")
    parts = spark.createDataFrame([(t, lf, int(c)) for t, ch in enumerate(chunks) for lf, c in enumerate(ch) if c > 1]
                                  or [(-1, -1, 1)], "tree int, leaf int, parts int")  # leaves of several chunks only
    count = F.coalesce(F.col("parts"), F.lit(1))
    members = (filed.join(F.broadcast(parts), ["tree", "leaf"], "left")
               .withColumn("chunk", F.pmod(F.xxhash64("id"), count).cast("int")).drop("parts"))

    def score(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        y, ids = np.stack(left["v"].to_numpy()), left["id"].to_numpy()
        asked, qs = right["query_id"].to_numpy(), np.stack(right["q"].to_numpy())
        out = []
        for lo in range(0, len(qs), 256):
            rough = y @ qs[lo:lo + 256].T
            for j, (i, q) in enumerate(zip(asked[lo:lo + 256], qs[lo:lo + 256])):
                r = np.where(ids == i, -np.inf, rough[:, j])
                # all that can be among the k best; the exact scores decide
                least = np.partition(r, len(r) - k)[len(r) - k] if len(r) > k else -np.inf
                near = np.flatnonzero((r >= least - 1e-9 * (1 + abs(least))) & (r > -np.inf)) if np.isfinite(least) \
                    else np.flatnonzero(r > -np.inf)
                s = products(y[near], q)
                best = near[np.lexsort((ids[near], -s))[:k]]
                out.append((np.full(len(best), i), ids[best], products(y[best], q)))
        a, b, c = (np.concatenate(x) for x in zip(*out))
        return pd.DataFrame({"query_id": a, "vec_id": b, "score": c})

    keys = ["tree", "leaf", "chunk"]
    found = (members.groupBy(*keys).cogroup(queries.groupBy(*keys))
             .applyInPandas(score, "query_id long, vec_id long, score double").distinct())
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))  # k rows a chunk
    return (found.withColumn("rank", rank).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
