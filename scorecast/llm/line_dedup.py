"""Line de-duplication with levelled sorted runs of line hashes.

The table is taken in a few batches of descending document ids. Each batch is
reduced to one row per line key (128-bit hash, number of documents, largest
document id) and merge-anti-joined against the runs of the earlier batches:
keys that no run holds are *fresh* and fix the document that keeps the line
(earlier batches hold larger ids, so the first sight of a key is its largest
document); keys already held only add to the count. The batch then becomes a
new sorted run of level 0, and ``fanout`` runs of a level are compacted into
one run of the next level. After the last batch the merged runs tell for each
key how many documents hold it and which one keeps it.

Defined results
  * null or empty text: one empty line, nothing to drop;
  * null document id: a document like any other whose id is below all others;
  * repeated rows: rows that share an id count as one document; those of the largest
    id all keep the line;
  * an empty table gives an empty result; columns named like the added ones
    are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import arrow_map, free_name, utf8, written

WHITE = b" \t\n\x0b\x0c\r"
LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def line_key(line: bytes) -> bytes:
    """A line's key: outer white space stripped, A-Z lower-cased."""
    return line.strip(WHITE).translate(LOWER_ASCII)


def _code_points(b: bytes) -> int:
    return len(b) if b.isascii() else len(b.decode("utf-8", "replace"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _hash128(b: bytes) -> tuple[int, int]:
    x = xxhash.xxh3_128_intdigest(b)
    return _signed(x >> 64), _signed(x & 0xFFFFFFFFFFFFFFFF)


def _long_keys(text: bytes, min_chars: int) -> dict[bytes, tuple[int, int]]:
    """Hash of each distinct key of the text that is long enough."""
    keys = {line_key(x) for x in text.split(b"\n") if len(x) >= min_chars}
    return {k: _hash128(k) for k in keys if len(k) >= min_chars and _code_points(k) >= min_chars}


def _text_hash(text_col: str):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(k1, k2, id, th): one row per document and distinct long line key;
    ``th`` is a hash of the whole text."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("t"),
                      _text_hash(text_col).alias("th"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1, k2, ids, ths = [], [], [], []
            for i, t, th in zip(*(c.to_pylist() for c in b.columns)):
                hs = _long_keys(t, min_chars)
                if hs:
                    for x, y in hs.values():
                        k1.append(x)
                        k2.append(y)
                    ids.extend([i] * len(hs))
                    ths.extend([th] * len(hs))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(k1, dtype=np.int64)), pa.array(np.array(k2, dtype=np.int64)),
                 pa.array(ids, type=pa.int64()), pa.array(np.array(ths, dtype=np.int64))],
                names=["k1", "k2", "id", "th"])

    return arrow_map(src, "k1 long, k2 long, id long, th long", run)


class LineRuns:
    """Levelled sorted runs of line hashes in the shared folder.

    A run row is (k1, k2, n, keeper, fresh): ``n`` documents of the batch hold
    the key; ``keeper`` is set, and ``fresh`` true, in the one run that saw the
    key first. Batches must come in descending order of document ids.
    """

    def __init__(self, fanout: int = 3):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def add(self, hashes: DataFrame) -> DataFrame:
        """Merge-anti-join a batch of (k1, k2, id) and add its own run;
        returns the run."""
        # rows that share an id are one document; a batch holds all rows of an id
        own = hashes.select("k1", "k2", "id").distinct().groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keeper"))
        held = self._held()
        if held is None:
            run = own.withColumn("fresh", F.lit(True))
        else:
            # one outer merge gives both sides of the anti join
            run = (own.join(held, ["k1", "k2"], "left")
                   .select("k1", "k2", "n", F.when(F.col("held").isNull(), F.col("keeper")).alias("keeper"),
                           F.col("held").isNull().alias("fresh")))
        run = written(run.sortWithinPartitions("k1", "k2"), "line-run")
        self._push(run, 0)
        return run

    def _held(self) -> DataFrame | None:
        runs = self.runs()
        if not runs:
            return None
        out = runs[0]
        for r in runs[1:]:
            out = out.unionByName(r)
        return out.filter("fresh").select("k1", "k2", F.lit(True).alias("held"))

    def _push(self, run: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = written(_compact(self.levels[level]).sortWithinPartitions("k1", "k2"), "line-run")
            self.levels[level] = []
            self._push(merged, level + 1)

    def totals(self) -> DataFrame | None:
        """(k1, k2, n, keeper) over all runs."""
        runs = self.runs()
        return _compact(runs).drop("fresh") if runs else None


def _compact(runs: list[DataFrame]) -> DataFrame:
    out = runs[0]
    for r in runs[1:]:
        out = out.unionByName(r)
    if len(runs) == 1:
        return out
    return out.groupBy("k1", "k2").agg(F.sum("n").alias("n"), F.max("keeper").alias("keeper"),
                                       F.max("fresh").alias("fresh"))


def _cuts(docs: DataFrame, id_col: str, batches: int) -> list[int]:
    """Descending lower bounds of the batches' id ranges (quantiles)."""
    if batches <= 1:
        return []
    probs = [1 - i / batches for i in range(1, batches)]
    row = docs.agg(F.percentile_approx(F.col(id_col).cast("long"), probs, 10000).alias("q")).first()
    return sorted(set(row["q"] or []), reverse=True)


def line_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
               min_chars: int = 20, min_docs: int = 3, batches: int = 3, fanout: int = 2) -> DataFrame:
    """Drop the lines whose key is at least ``min_chars`` code points long and
    is found in at least ``min_docs`` documents, except in the document with
    the largest id.

    Returns the columns of ``docs`` with the text replaced by its kept lines,
    and ``n_lines`` and ``n_dropped``. ``batches`` is the number of id ranges
    in which a table is taken; a batch grows with the table.
    """
    cuts = _cuts(docs, id_col, batches)
    batch = F.lit(len(cuts))
    for i, c in reversed(list(enumerate(cuts))):
        batch = F.when(F.col("id") >= c, i).otherwise(batch)
    hashes = written(line_hashes(docs, id_col, text_col, min_chars).withColumn("batch", batch.cast("int")),
                     "line-hashes", "batch")
    store = LineRuns(fanout)
    for i in range(len(cuts) + 1):
        store.add(hashes.filter(F.col("batch") == i).select("k1", "k2", "id"))
    # written first: a join of two plain tables can be split where one line is hot
    common = written(store.totals().filter(F.col("n") >= min_docs).select("k1", "k2", "keeper"), "common-lines")
    drops = (hashes.join(common, ["k1", "k2"])
             .filter(~F.col("id").eqNullSafe(F.col("keeper")))
             .groupBy("id", "th").agg(F.collect_set("k1").alias("drop")))
    return _rewritten(docs, drops, id_col, text_col, min_chars)


def _rewritten(docs: DataFrame, drops: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Apply the drop lists (first hash halves of a text's own keys; a list
    only names keys of that very text, so half the hash tells them apart)."""
    names = [c for c in docs.columns if c.lower() not in ("n_lines", "n_dropped")]
    tmp = [free_name(docs.columns, f"ld_{x}") for x in ("th", "id", "drop")]
    th, did, drop = tmp
    hashed = docs.select(*names).withColumn(th, _text_hash(text_col))
    d = drops.select(F.col("th").alias(f"{th}r"), F.col("id").alias(did), F.col("drop").alias(drop))
    joined = hashed.join(d, (F.col(th) == F.col(f"{th}r"))
                         & F.col(id_col).cast("long").eqNullSafe(F.col(did)), "left")
    src = joined.select(*names, drop)
    at = names.index(text_col)
    plain = docs.select(*names).schema
    out_schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain) + ", n_lines long, n_dropped long"

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts, lines, dropped = [], [], []
            for t, gone in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist()):
                raw = (t or "").encode()
                parts = raw.split(b"\n")
                lines.append(len(parts))
                if gone:
                    out = set(gone)
                    hs = {k: h[0] for k, h in _long_keys(raw, min_chars).items()}
                    kept = [x for x in parts if hs.get(line_key(x)) not in out]
                    dropped.append(len(parts) - len(kept))
                    t = b"\n".join(kept).decode()
                else:
                    dropped.append(0)
                texts.append(t or "")
            cols = [b.column(i) for i in range(len(names))]
            cols[at] = pa.array(texts, type=pa.string())
            yield pa.RecordBatch.from_arrays(
                [*cols, pa.array(lines, type=pa.int64()), pa.array(dropped, type=pa.int64())],
                names=[*names, "n_lines", "n_dropped"])

    return arrow_map(src, out_schema, run)
