"""SimHash near-duplicates with pivot distance tables.

Fingerprint: bit i is 1 if it is set in more than half of the XXH64 hashes
(seed 42) of a document's word shingles, repeats included.

Linking uses distances to reference fingerprints (pivots). With D the Hamming
distance, |D(x, p) - D(y, p)| <= D(x, y) for every pivot p, on the whole
fingerprint as on any block of its bits. The pivots' distance tables are
computed once per block and block value and serve twice:

  * candidates: the 64 bits are cut into ``BLOCKS`` blocks; fingerprints within
    ``max_bits`` bits agree on at least BLOCKS - max_bits blocks, and there all
    their block distances to the pivots are equal. For every choice of that
    many blocks a fingerprint is filed under its block-distance vectors, and
    only fingerprints filed together are compared;
  * discarding: a pair goes when the largest difference of its whole distance
    vectors exceeds ``max_bits``; survivors are verified bit by bit.

Exact copies of a fingerprint are collapsed before anything is compared. A
file with more than ``CELL`` members is cut into chunks by hash and compared
chunk pair by chunk pair in separate tasks. A task emits a spanning forest of
the links it finds, not all pairs of a group; no link between components is
lost.

Defined results
  * null or empty text, or blanks only: fingerprint zero, linked like any
    other; fewer words than a shingle: the whole sequence is the one shingle;
  * null ids never become a component id unless all ids of it are null;
  * repeated rows: one result row each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import arrow_map, free_name, utf8, written
from scorecast.llm.components import components

SEED = 42
BLOCKS = 5
PIVOTS = 64
CELL = 4096
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
# row v: the 8 bits of byte value v, lowest first
_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)
_WORD = np.uint64(1) << np.arange(64, dtype=np.uint64)


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.translate(LOWER_ASCII).split()  # bytes split at ASCII white space
    if not words:
        return 0
    buf = b" ".join(words)
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(buf, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(buf[i:j], SEED) for i, j in
                  zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())], dtype="<u8")
    by = h.view(np.uint8).reshape(-1, 8)
    if len(h) < 256:
        ones = np.unpackbits(by, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    else:
        ones = np.concatenate([np.bincount(by[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(_WORD[2 * ones > len(h)].sum(dtype=np.uint64))


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3) -> DataFrame:
    """(doc_id, text_key, fp): the fingerprint as a signed long and a hash of
    the text, one row per input row."""
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"),
                      utf8(text_col).alias("t"))

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            fps = np.array([fingerprint(t, shingle) for t in b.column(2).to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "text_key", "fp"])

    return arrow_map(src, "doc_id long, text_key long, fp long", run)


class PivotTables:
    """Block distances of every block value to fixed random pivots."""

    def __init__(self, blocks: int = BLOCKS, pivots: int = PIVOTS):
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        self.shift = [np.uint64(x) for x in edges[:-1]]
        self.width = np.diff(edges)
        refs = np.random.default_rng(7).integers(0, 2**64, size=pivots, dtype=np.uint64)
        mix = np.random.default_rng(11).integers(1, 2**62, size=pivots, dtype=np.uint64) | np.uint64(1)
        self.tables, self.keys = [], []
        for s, w in zip(self.shift, self.width):
            values = np.arange(1 << int(w), dtype=np.uint64)
            part = (refs >> s) & np.uint64((1 << int(w)) - 1)
            table = np.bitwise_count(values[:, None] ^ part[None, :])
            self.tables.append(table)
            # the distance vector of a block value as one number
            self.keys.append((table.astype(np.uint64) * mix).sum(axis=1, dtype=np.uint64))

    def _values(self, fps: np.ndarray, i: int) -> np.ndarray:
        return ((fps >> self.shift[i]) & np.uint64((1 << int(self.width[i])) - 1)).astype(np.int64)

    def distances(self, fps: np.ndarray) -> np.ndarray:
        """Distances of whole fingerprints to every pivot (rows x pivots)."""
        out = self.tables[0][self._values(fps, 0)].astype(np.int16)
        for i in range(1, len(self.tables)):
            out += self.tables[i][self._values(fps, i)]
        return out

    def files(self, fps: np.ndarray, agree: int) -> np.ndarray:
        """Candidate keys (rows x choices of ``agree`` blocks)."""
        block = [self.keys[i][self._values(fps, i)] for i in range(len(self.tables))]
        odd = np.uint64(0x9E3779B97F4A7C15)
        out = []
        for k, chosen in enumerate(combinations(range(len(block)), agree)):
            h = np.full(len(fps), k + 1, dtype=np.uint64)
            for i in chosen:
                h = (h ^ block[i]) * odd
                h ^= h >> np.uint64(29)
            out.append(h)
        return np.stack(out, axis=1)


def _forest(fps: np.ndarray, left: np.ndarray, right: np.ndarray, tables: PivotTables, max_bits: int) -> list[tuple[int, int]]:
    """Spanning forest of the links between rows ``left`` and ``right`` of fps."""
    dist = tables.distances(fps)
    root = np.arange(len(fps))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i in left.tolist():
        js = right[right > i] if left is right else right
        js = js[np.abs(dist[js, 0] - dist[i, 0]) <= max_bits]
        if len(js):
            js = js[np.abs(dist[js] - dist[i]).max(axis=1) <= max_bits]
        if len(js):
            js = js[np.bitwise_count(fps[js] ^ fps[i]) <= max_bits]
        for j in js.tolist():
            a, b = find(i), find(j)
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((i, j))
    return out


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """(a, b): links that connect every two of the distinct fingerprints
    ``fp`` at ``max_bits`` differing bits or fewer."""
    agree = BLOCKS - max_bits
    if agree < 1:
        raise ValueError(f"max_bits must be below {BLOCKS}")

    def file(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = PivotTables()
        for b in it:
            v = b.column(0).to_numpy(zero_copy_only=False)
            k = tables.files(v.view(np.uint64), agree)
            yield pa.RecordBatch.from_arrays([pa.array(k.reshape(-1).view(np.int64)), pa.array(np.repeat(v, k.shape[1]))],
                                             names=["file", "fp"])

    filed = written(fps.select("fp").mapInArrow(file, "file long, fp long"), "pivot-files")
    sizes = filed.groupBy("file").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    cells = (filed.join(sizes, "file")
             .withColumn("parts", F.ceil(F.col("n") / CELL).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("file", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "fp"))
    cells = cells.repartition("file", "p", "q").sortWithinPartitions("file", "p", "q")

    def compare(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = PivotTables()

        def cell(p: int, q: int, own: np.ndarray, v: np.ndarray) -> list[tuple[int, int]]:
            u = v.view(np.uint64)
            rows = np.arange(len(u))
            if p == q:
                pairs = _forest(u, rows, rows, tables, max_bits)
            else:
                pairs = _forest(u, rows[own == p], rows[own == q], tables, max_bits)
            return [(int(v[i]), int(v[j])) for i, j in pairs]

        def flush(chunk: np.ndarray) -> pa.RecordBatch:
            out: list[tuple[int, int]] = []
            if len(chunk):
                cut = np.flatnonzero((chunk[1:, :3] != chunk[:-1, :3]).any(axis=1)) + 1
                for part in np.split(chunk, cut):
                    if len(part) > 1:
                        out += cell(int(part[0, 1]), int(part[0, 2]), part[:, 3], part[:, 4].copy())
            a, b = zip(*out) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(a, type=pa.int64()), pa.array(b, type=pa.int64())], names=["a", "b"])

        held = np.empty((0, 5), dtype=np.int64)  # the last cell may go on in the next batch
        for b in it:
            rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in b.columns], axis=1)
            held = np.concatenate([held, rows])
            if len(held):
                last = np.flatnonzero((held[:, :3] != held[-1, :3]).any(axis=1))
                at = last[-1] + 1 if len(last) else 0
                yield flush(held[:at])
                held = held[at:]
        yield flush(held)

    return cells.mapInArrow(compare, "a long, b long").distinct()


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 3,
                   max_bits: int = 3) -> DataFrame:
    """(doc_id, text_key, fingerprint, component_id): component_id is the
    smallest doc_id that links of at most ``max_bits`` bits reach, itself
    included; ``text_key`` tells rows that share an id apart."""
    fp = written(fingerprints(docs, id_col, text_col, shingle=shingle), "simhash")
    distinct = written(fp.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    comp = components(links(distinct, max_bits))
    member = (distinct.join(comp, distinct["fp"] == comp["node"], "left")
              .select("fp", "least", F.coalesce("component", "fp").alias("component")))
    least = member.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = member.join(least, "component").select("fp", "component_id")
    return (fp.join(by_fp, "fp")
            .select("doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def keep_one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group. Rows of the
    group that share that id are all kept; a group of null ids only is kept
    whole."""
    a, b = free_name(docs.columns, "sh_id"), free_name(docs.columns, "sh_key")
    keep = (simhash_groups(docs, id_col, text_col, **settings)
            .filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .select(F.col("doc_id").alias(a), F.col("text_key").alias(b)).distinct())
    return docs.join(keep, (_text_key(text_col) == F.col(b)) & F.col(id_col).cast("long").eqNullSafe(F.col(a)),
                     "left_semi")
