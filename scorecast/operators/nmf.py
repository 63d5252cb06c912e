"""Non-negative matrix factorisation X ~ W H of a long table (Id, term, x).

Block coordinate descent (a component of all rows, then of all terms, at its
non-negative least-squares optimum). One stopping rule at every size: a pass
that lowers the loss by less than ``tol`` of the first loss is the last. The
projected gradient, as a share of its first value, is reported beside it.

Both factors stay tables. Whole rows of X lie in blocks of about
``nnz_per_block`` values, each packed into byte arrays with its own list of
terms; the blocks are kept once, in a checkpoint of known partitioning, for the
whole fit. H lies in shards, ranges of the sorted terms. A step sends each block
the H rows of the terms it holds, moves the block's W rows, and returns W and,
per shard, the block's partial sums of W^T X; a second step adds these up and
moves H, shard by shard. All of them travel as byte arrays, one per block and
shard, so what crosses the network per step is (terms per block) x k numbers,
not the values of X; only k x k Gram matrices and a few sums reach the driver. Each step's factors are written to the shared folder:
an executor's loss repeats at most one step, and the plan never grows. The
factors of the pass before are given back once a pass is written, and a
step's shuffle files once it has ended, so the disk holds the blocks and two
passes at most, however many a fit takes.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scorecast.session import configured, ensure_checkpoint_dir, partitions_for, scratch_path, shuffle_partitions, shuffles_freed

NNZ_PER_BLOCK = 2_000_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"  # rows of long lists travel in small batches
TERMS_PER_SHARD = 100_000
# a factor's part (H of a shard, W of a block) with its Gram matrix and sums
_PART = "key long, part binary, gram array<double>, moved double, cross double"
_SENT = "block long, shard long, part binary"   # H rows for a block; the block's W has shard -1


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def given_back(df: DataFrame) -> None:
    """Deletes a table that ``_written`` made and no later step reads."""
    spark = df.sparkSession
    for f in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def _written_with(df: DataFrame, name: str, *sums: Column) -> tuple[DataFrame, list[float]]:
    """The written table and sums over it, taken by the job that writes it."""
    seen = Observation()
    out = _written(df.observe(seen, *[F.sum(c).alias(f"s{i}") for i, c in enumerate(sums)]), name)
    return out, [float(seen.get[f"s{i}"] or 0.0) for i in range(len(sums))]


def start_values(key: Column, seed: int, k: int, scale: Column | float) -> Column:
    """k uniform [0, scale) numbers from md5(seed:key:j) (repeatable start)."""
    parts = []
    for j in range(k):
        h = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), key.cast("string"), F.lit(str(j)))), 1, 12), 16, 10)
        parts.append(h.cast("double") / F.lit(float(1 << 48)) * F.lit(scale) + F.lit(1e-6))
    return F.array(*parts)


def descend(w: np.ndarray, gram: np.ndarray, target: np.ndarray, sweeps: int) -> np.ndarray:
    """Moves the rows of ``w`` (in place) towards min |x - w h|^2, w >= 0, with
    gram = h h^T and target = x h^T; returns each row's projected gradient in
    the first sweep."""
    moved = np.zeros(len(w))
    for s in range(sweeps):
        for t in range(w.shape[1]):
            grad = w @ gram[:, t] - target[:, t]
            if s == 0:
                moved += np.abs(np.where(w[:, t] == 0, np.minimum(grad, 0.0), grad))
            if gram[t, t] > 0:
                w[:, t] = np.maximum(w[:, t] - grad / gram[t, t], 0.0)
    return moved


def _pairs(k: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(k) for j in range(i, k)]


def _products(vcol: str, k: int) -> list[Column]:
    return [F.col(vcol)[i] * F.col(vcol)[j] for i, j in _pairs(k)]


def _gram(sums: list[float], k: int) -> list[list[float]]:
    """k x k sum of v v^T from the sums of ``_products``."""
    g = [[0.0] * k for _ in range(k)]
    for x, (i, j) in zip(sums, _pairs(k)):
        g[i][j] = g[j][i] = x
    return g


def gathered(batches, values: int, most: int):
    """The batches as tables of about ``most`` values in the list column of
    the given place."""
    held, size = [], 0
    for b in batches:
        ends = np.cumsum(pc.list_value_length(b.column(values)).fill_null(0).to_numpy())
        cut = np.flatnonzero(ends[1:] // most != ends[:-1] // most) + 1 if b.num_rows else []
        for i, j in zip([0, *cut], [*cut, b.num_rows]):
            if i == j:
                continue
            held.append(b.slice(i, j - i))
            size += int(ends[j - 1] - (ends[i - 1] if i else 0))
            if size >= most:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def flat(t: pa.Table, name: str) -> pa.Array:
    """The values of a list column, end to end."""
    return pa.concat_arrays([c.flatten() for c in t.column(name).chunks])


def lengths(t: pa.Table, name: str) -> np.ndarray:
    return pc.list_value_length(t.column(name)).fill_null(0).to_numpy()


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ..., for ``lens`` numbers of each start."""
    ends = np.cumsum(lens)
    return np.repeat(starts - ends + lens, lens) + np.arange(ends[-1] if len(ends) else 0)


def lists(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def _packed(a: np.ndarray) -> bytes:
    """The bytes of an array by place in the number (first bytes, second bytes,
    ...), compressed."""
    return pa.compress(a.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes(), "zstd", asbytes=True)


def _unpacked(b, n: int, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(b, decompressed_size=n * size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, n).T).view(kind).ravel()


# a block: its row Ids (ascending), where each row's cells end, the cells'
# terms as places in ``terms`` (ascending) and their values
_CELLS = ("block long, n long, nnz long, total double, xx double, ids binary, ends binary, place binary, x binary, "
          "terms array<string>")


def _pack(most: int):
    def run(batches):
        first = TaskContext.get().partitionId() << 32
        for i, t in enumerate(gathered(batches, 1, most)):
            ids, size = t.column("Id").to_numpy(), lengths(t, "xs").astype(np.int64)
            names = flat(t, "terms").dictionary_encode()
            x = flat(t, "xs").to_numpy()
            del t
            order = pc.sort_indices(names.dictionary).to_numpy()
            place = np.empty(len(order), dtype=np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            by_id = np.argsort(ids)
            cell = ranges((np.cumsum(size) - size)[by_id], size[by_id])
            place, x = place[names.indices.to_numpy()][cell], x[cell]
            values = [first + i, len(ids), len(x), float(x.sum()), float((x * x).sum()), _packed(ids[by_id]), _packed(np.cumsum(size[by_id])),
                      _packed(place), _packed(x), names.dictionary.take(order)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([v]) if not isinstance(v, pa.Array) else lists(np.array([0, len(v)]), v) for v in values],
                names=[c.split()[0] for c in _CELLS.split(", ")])

    return run


def _row_ids(batches):
    for b in batches:
        for block, n, ids in zip(*(c.to_pylist() for c in b.columns)):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, block, dtype=np.int64)), pa.array(_unpacked(ids, n, np.int64)),
                                              pa.array(np.arange(n))], names=["block", "Id", "order"])


def as_rows(X: DataFrame, id_col: str = "Id") -> DataFrame:
    """(Id, terms, xs): a long table (Id, term, x) as one row per Id."""
    cell = F.struct("term", F.col("x").cast("double").alias("x"))
    rows = X.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("Id")).agg(F.collect_list(cell).alias("e"))
    return rows.select("Id", F.col("e.term").alias("terms"), F.col("e.x").alias("xs"))


class _Blocks:
    """X, given as ``as_rows`` makes it and with the number of its values, in
    blocks of whole rows: ``cells``, partitioned by block, and their sizes."""

    def __init__(self, rows: DataFrame, nnz: int, nnz_per_block: int):
        spark = rows.sparkSession
        # small tables: as many blocks as there are cores, if a block is worth a task
        tasks = max(partitions_for(nnz, nnz_per_block),
                    min(spark.sparkContext.defaultParallelism, partitions_for(nnz, min(nnz_per_block, 20_000))))
        most = max(1, min(nnz_per_block, 2 * partitions_for(nnz, tasks)))
        packed = rows.select("Id", "terms", "xs").coalesce(tasks).mapInArrow(_pack(most), _CELLS)
        ensure_checkpoint_dir(spark)
        # a checkpoint keeps the partitioning of a plan that is not adaptive
        with configured(spark, "spark.sql.adaptive.enabled", "false"), configured(spark, ARROW_ROWS, "1000"):
            self.cells = packed.repartition(max(shuffle_partitions(spark), tasks), "block").checkpoint()
        s = self.cells.agg(*[F.sum(c) for c in ("nnz", "total", "xx", "n")]).first()
        self.nnz, self.total, self.xx, self.n = s[0] or 0, float(s[1] or 0.0), float(s[2] or 0.0), s[3] or 0

    def terms(self) -> DataFrame:
        return self.cells.select(F.explode("terms").alias("term")).distinct()

    def places(self, vocabulary: DataFrame) -> DataFrame:
        """(block, place, ...) of the blocks' terms that the vocabulary has."""
        return self.cells.select("block", F.posexplode("terms").alias("place", "term")).join(vocabulary, "term").drop("term")

    def rows(self) -> DataFrame:
        return self.cells.select("block", "n", "ids").mapInArrow(_row_ids, "block long, Id long, order long")

    def with_sent(self, sent: DataFrame, fn, schema: str) -> DataFrame:
        """``fn`` on every block with what is sent to it."""
        return self.cells.drop("terms").groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(fn, schema)

    def release(self):
        """Deletes the checkpoint."""
        spark = self.cells.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.cells._jdf.queryExecution().analyzed().rdd().getCheckpointFile().get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class _BlockData:
    """A block's values with rows and terms numbered from 0."""

    def __init__(self, cells: pa.Table):
        c = {name: cells.column(name)[0].as_py() for name in cells.column_names}
        n, nnz, self.block = c["n"], c["nnz"], c["block"]
        self.ids, self.x = _unpacked(c["ids"], n, np.int64), _unpacked(c["x"], nnz, np.float64)
        self.row = np.repeat(np.arange(n), np.diff(_unpacked(c["ends"], n, np.int64), prepend=0))
        self.term = _unpacked(c["place"], nnz, np.int32)

    def xh(self, h: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(self.row, self.x * c[self.term], len(self.ids)) for c in h.T.copy()], axis=1)

    def wx(self, w: np.ndarray, n_terms: int) -> np.ndarray:
        return np.stack([np.bincount(self.term, self.x * c[self.row], n_terms) for c in w.T.copy()], axis=1)


def _matrix(b, k: int) -> np.ndarray:
    return np.frombuffer(b, dtype=np.float64).reshape(-1, k).copy()


def _parts(rows: list[tuple], schema: str) -> pa.Table:
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<double>": pa.list_(pa.float64()), "double": pa.float64()}
    return pa.table({n: pa.array([r[i] for r in rows], kinds[c.split()[1]]) for i, (n, c) in enumerate(zip(names, schema.split(", ")))})


def _upper(m: np.ndarray) -> list[float]:
    g = m.T @ m
    return [float(g[i, j]) for i, j in _pairs(m.shape[1])]


def _stacked(key: str):
    """The rows (key, order, v) of a key as one part."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("order")
        m = flat(t, "v").to_numpy().reshape(t.num_rows, -1)
        return _parts([(t.column(key)[0].as_py(), m.tobytes(), _upper(m), 0.0, 0.0)], _PART)

    return run


def _send(k: int):
    """H rows of a shard for every block that needs some."""
    def run(h: pa.Table, needs: pa.Table) -> pa.Table:
        part = _matrix(h.column("part")[0].as_py(), k)
        rows = [(block, shard, part[np.asarray(idx)].tobytes()) for block, shard, idx in
                zip(needs.column("block").to_pylist(), needs.column("shard").to_pylist(), _each(needs, "idx"))]
        return _parts(rows, _SENT)

    return run


def _each(t: pa.Table, name: str) -> list[np.ndarray]:
    """The lists of a column as arrays."""
    return np.split(flat(t, name).to_numpy(), np.cumsum(lengths(t, name))[:-1]) if t.num_rows else []


_STEP = "block long, shard long, part binary, gram array<double>, moved double, cross double"


def _fit_fn(gram: list[list[float]], sweeps: int):
    hht = np.array(gram)
    k = len(hht)

    def step(cells: pa.Table, sent: pa.Table) -> pa.Table:
        b = _BlockData(cells)
        # terms are in order within a shard and from shard to shard
        got = sorted(zip(sent.column("shard").to_pylist(), (_matrix(p.as_buffer(), k) for c in sent.column("part").chunks for p in c)),
                     key=lambda x: x[0])
        w, h = got[0][1], np.concatenate([m for _, m in got[1:]])
        target = b.xh(h)
        moved = descend(w, hht, target, sweeps)
        wx = b.wx(w, len(h))
        sums = np.split(wx, np.cumsum([len(m) for _, m in got[1:]])[:-1])
        return _parts([(b.block, -1, w.tobytes(), _upper(w), float(moved.sum()), float((w * target).sum())),
                       *((b.block, shard, x.tobytes(), None, None, None) for (shard, _), x in zip(got[1:], sums))], _STEP)

    return step


def _move_fn(gram: list[list[float]], sweeps: int):
    """A shard's H after ``descend`` with the sums of its blocks; its rows: H
    under block -1, the blocks' needs (``idx``) and their sums (``part``)."""
    wtw = np.array(gram)
    k = len(wtw)

    def move(t: pa.Table) -> pa.Table:
        blocks, parts, needs = t.column("block").to_pylist(), t.column("part").combine_chunks(), _each(t, "idx")
        order = sorted(range(len(blocks)), key=lambda i: (blocks[i], parts[i].is_valid))
        h = _matrix(parts[order[0]].as_buffer(), k)
        x = np.zeros_like(h)
        # a block's needs come before its sums; blocks are added in their order
        for i, j in zip(order[1::2], order[2::2]):
            x[needs[i]] += _matrix(parts[j].as_buffer(), k)
        moved = descend(h, wtw, x, sweeps)
        return _parts([(t.column("shard")[0].as_py(), h.tobytes(), _upper(h), float(moved.sum()), 0.0)], _PART)

    return move


def _rows_of(k: int, kind: str):
    """(key, order, vec) of the parts."""
    def run(batches):
        for b in batches:
            for key, part in zip(b.column(0).to_pylist(), b.column(1)):
                m = _matrix(part.as_buffer(), k)
                n = len(m)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key, dtype=np.int64)), pa.array(np.arange(n)),
                                                  lists(np.arange(n + 1) * k, pa.array(m.ravel()))], names=["key", "order", kind])

    return run


def _transform_fn(gram: list[list[float]], max_iter: int, tol: float):
    hht = np.array(gram)
    k = len(hht)

    def step(cells: pa.Table, sent: pa.Table) -> pa.Table:
        b = _BlockData(cells)
        # unknown terms have no part in a row
        places, vecs = sent.column("place").to_numpy(), flat(sent, "h").to_numpy().reshape(-1, k) if sent.num_rows else np.zeros((0, k))
        size = max(int(b.term.max(initial=-1)) + 1, int(places.max(initial=-1)) + 1)
        h, known = np.zeros((size, k)), np.zeros(size, dtype=bool)
        h[places], known[places] = vecs, True
        target = b.xh(h)
        w = np.zeros_like(target)
        # each row stops by itself, so results do not depend on the blocks
        live, first = np.arange(len(w)), None
        for _ in range(max_iter):
            part = w[live]
            moved = descend(part, hht, target[live], 1)
            w[live] = part
            first = moved if first is None else first
            going = moved > tol * first
            live, first = live[going], first[going]
            if not len(live):
                break
        there = np.bincount(b.row, known[b.term], len(w)) > 0
        ids, w = b.ids[there], w[there]
        return pa.table({"Id": pa.array(ids), "w": lists(np.arange(len(ids) + 1) * k, pa.array(w.ravel()))})

    return step


@dataclass
class NMFModel:
    """H (term, h), W (Id, w) of the fitted rows, the loss after each step's
    W half, and each step's projected gradient as a share of the first."""

    k: int
    H: DataFrame
    W: DataFrame | None
    n_terms: int
    losses: list[float] = field(default_factory=list)
    ratios: list[float] = field(default_factory=list)

    def components(self) -> DataFrame:
        """(topic, term, weight) long form of H."""
        return self.H.select("term", F.posexplode("h").alias("topic", "weight"))

    def transform(self, X: DataFrame, id_col: str = "Id", max_iter: int = 200, tol: float = 1e-6, nnz_per_block: int = NNZ_PER_BLOCK) -> DataFrame:
        """(Id, w) of rows with a known term, H fixed: every row's
        non-negative least squares, to its own convergence."""
        with shuffles_freed(X.sparkSession):
            rows, nnz = _kept_rows(X, id_col)
            out = self.transform_rows(rows, nnz, id_col, max_iter, tol, nnz_per_block)
            given_back(rows)
        return out

    def transform_rows(self, rows: DataFrame, nnz: int, id_col: str = "Id", max_iter: int = 200, tol: float = 1e-6,
                       nnz_per_block: int = NNZ_PER_BLOCK) -> DataFrame:
        """``transform`` of (Id, terms, xs), one row per Id, with about ``nnz`` values."""
        with shuffles_freed(rows.sparkSession):
            vocabulary = _written(self.H.select("term", "h"), "nmf-fixed")
            gram = _gram([float(x or 0.0) for x in vocabulary.agg(*[F.sum(c) for c in _products("h", self.k)]).first()], self.k)
            x = _Blocks(rows, nnz, nnz_per_block)
            sent = _written(x.places(vocabulary), "nmf-sent")
            out = x.with_sent(sent, _transform_fn(gram, max_iter, tol), "Id long, w array<double>")
            w = _written(out.select(F.col("Id").alias(id_col), "w"), "nmf-transformed")
            x.release()
            given_back(vocabulary)
            given_back(sent)
        return w


def _kept_rows(X: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """``as_rows``, made once, and the number of its values."""
    rows, (nnz,) = _written_with(as_rows(X, id_col), "nmf-rows", F.size("xs"))
    return rows, int(nnz)


class NMF:
    """K components. ``sweeps`` coordinate sweeps are made per pass over
    X (more of them need fewer passes); the fit ends when a pass lowers the
    loss by less than ``tol`` of the first one, or after ``max_iter`` passes."""

    def __init__(self, k: int = 6, max_iter: int = 200, seed: int = 44, tol: float = 1e-4, sweeps: int = 3, id_col: str = "Id",
                 nnz_per_block: int = NNZ_PER_BLOCK):
        self.k, self.max_iter, self.seed, self.tol, self.sweeps = k, max_iter, seed, tol, sweeps
        self.id_col, self.nnz_per_block = id_col, nnz_per_block

    def fit(self, X: DataFrame) -> NMFModel:
        """The factors of a long table (Id, term, x)."""
        with shuffles_freed(X.sparkSession):
            # the terms and the values are read from one copy: X is made once
            rows, nnz = _kept_rows(X, self.id_col)
            return self.fit_rows(rows, nnz, lambda: given_back(rows))

    def fit_rows(self, rows: DataFrame, nnz: int, taken=lambda: None) -> NMFModel:
        """The factors of (Id, terms, xs), one row per Id, with about ``nnz``
        values; ``taken`` is called when ``rows`` is not read any more."""
        with shuffles_freed(rows.sparkSession):
            x = _Blocks(rows, nnz, self.nnz_per_block)
            taken()
            model = self._fit(x)
            x.release()
        return model

    def _fit(self, x: _Blocks) -> NMFModel:
        k = self.k
        found = _written(x.terms(), "nmf-found")
        n_terms = found.count()
        # the partitions of the sorted terms are the shards
        number, row = F.monotonically_increasing_id(), F.lit((1 << 33) - 1)
        terms = _written(found.repartitionByRange(partitions_for(n_terms, TERMS_PER_SHARD), "term").sortWithinPartitions("term").select(
            "term", F.shiftright(number, 33).alias("shard"), number.bitwiseAND(row).alias("order")), "nmf-terms")
        given_back(found)
        needs = _written(x.places(terms).groupBy("block", "shard").agg(F.sort_array(F.collect_list("order")).alias("idx")), "nmf-needs")
        mean = x.total / max(1, x.n * n_terms)
        scale = (mean / k) ** 0.5 * 2.0 if mean > 0 else 1.0
        gram_sums = [F.get("gram", F.lit(i)) for i in range(len(_pairs(k)))]
        H, sums = _written_with(terms.select("shard", "order", start_values(F.col("term"), self.seed + 1, k, scale).alias("v"))
                                .groupBy("shard").applyInArrow(_stacked("shard"), _PART), "nmf-h", *gram_sums)
        W = _written(x.rows().select("block", "order", start_values(F.col("Id"), self.seed, k, scale).alias("v"))
                     .groupBy("block").applyInArrow(_stacked("block"), _PART), "nmf-w").select(F.col("key").alias("block"), "part")
        hht, losses, ratios, first = _gram(sums, k), [], [], None
        for _ in range(self.max_iter if x.nnz else 0):
            h = H.select(F.col("key").alias("shard"), "part")
            sent = h.groupBy("shard").cogroup(needs.groupBy("shard")).applyInArrow(_send(k), _SENT)
            sent = sent.unionByName(W.select("block", F.lit(-1).cast("long").alias("shard"), "part"))
            out, (*sums, moved, cross) = _written_with(x.with_sent(sent, _fit_fn(hht, self.sweeps), _STEP), "nmf-step",
                                                       *gram_sums, F.col("moved"), F.col("cross"))
            last = [H, W]
            W = out.where("shard = -1").select("block", "part")
            wtw = _gram(sums, k)
            losses.append(x.xx - 2.0 * cross + sum(wtw[i][j] * hht[i][j] for i in range(k) for j in range(k)))
            idx, part = F.lit(None).cast("array<long>").alias("idx"), F.lit(None).cast("binary").alias("part")
            of_shard = (h.select("shard", F.lit(-1).cast("long").alias("block"), idx, "part")
                        .unionByName(needs.select("shard", "block", "idx", part))
                        .unionByName(out.where("shard >= 0").select("shard", "block", idx, "part")))
            H, (*sums, moved_h) = _written_with(of_shard.groupBy("shard").applyInArrow(_move_fn(wtw, self.sweeps), _PART), "nmf-h",
                                                *gram_sums, F.col("moved"))
            hht = _gram(sums, k)
            for table in last:
                given_back(table)
            moved += moved_h
            first = moved if first is None else first
            ratios.append(moved / first if first else 0.0)
            if len(losses) > 1 and losses[-2] - losses[-1] < self.tol * losses[0]:
                break
        given_back(needs)
        h = H.select("key", "part").mapInArrow(_rows_of(k, "h"), "key long, order long, h array<double>").withColumnRenamed("key", "shard")
        ids = x.rows()
        w = W.mapInArrow(_rows_of(k, "w"), "key long, order long, w array<double>").withColumnRenamed("key", "block")
        last = [H, W, terms]
        W = _written(ids.join(w, ["block", "order"]).select(F.col("Id").alias(self.id_col), "w"), "nmf-step")
        H = _written(terms.join(h, ["shard", "order"]).select("term", "h"), "nmf-h")
        for table in last:
            given_back(table)
        return NMFModel(k, H, W, n_terms, losses, ratios)
