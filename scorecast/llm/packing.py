"""Best-fit packing of tokenised documents by minimum bin slack.

Every bin (sequence) is filled with the fullest feasible combination of the
lengths still available, found by a bitset subset-sum dynamic programme, and
the combination is removed; the longest remaining length seeds each bin. The
programme works on the histogram of piece lengths, which has at most
``capacity`` rows however large the corpus is: a combination is applied as
often as its scarcest length allows, so the number of steps depends on the
number of distinct lengths and not on the number of documents. Spark computes
the histogram and ranks the pieces of each length (in hash buckets with prefix
sums, so that one common length is spread over tasks); the short list of
combinations then turns a rank into a sequence and an offset.

Defined results
  * null or empty text: the end id alone (one piece of length 1);
  * null ids and repeated rows: every row is packed on its own;
  * an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from scorecast.llm.common import arrow_map, written

END_ID = 2
# A worker's memo of encoded words is emptied beyond this many entries.
MEMO_ENTRIES = 1_000_000


# Byte-level vocabularies write a byte that is no visible Latin-1 character as
# the next character from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
BYTE_CHARS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class WordMemo(dict):
    """Text chunk -> little-endian unsigned 32-bit ids, encoded on first use.

    The byte-level pre-tokeniser starts a new word at every single space
    between two non-blank characters (the space opens the word) and on both
    sides of every single line feed between two non-blank characters, and it
    merges only within words; a word of letters ends at the first other
    character. So a text is the concatenation of its chunks
    there, and a chunk needs to be encoded only once.
    """

    def __init__(self, vocabulary: str):
        super().__init__()
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, chunk: str) -> bytes:
        tail = len(chunk)
        while tail and not chunk[tail - 1].isalnum():
            tail -= 1
        word = chunk[1:tail] if chunk[0] == " " else chunk[:tail]
        if not word.isalpha() or not chunk[tail:].isascii() or " " in chunk[tail:]:
            ids = self.whole(chunk)
        elif tail < len(chunk):
            ids = self[chunk[:tail]] + self[chunk[tail:]]  # a word of letters ends where its letters end
        else:  # one word of letters: nothing to pre-tokenise
            ids = np.array([t.id for t in self.model.tokenize(chunk.encode().decode("latin-1").translate(BYTE_CHARS))],
                           dtype="<u4").tobytes()
        if len(self) >= MEMO_ENTRIES:
            self.clear()
        self[chunk] = ids
        return ids

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def encode(self, text: str) -> bytes:
        if any(s in text for s in self.special):
            return self.whole(text)
        out = []
        lines = text.split("\n")
        feed = self["\n"]
        pending = lines[0]
        for line in lines[1:]:
            if pending and line and not pending[-1].isspace() and not line[0].isspace():
                self._line(pending, out)
                out.append(feed)
                pending = line
            else:
                pending = pending + "\n" + line
        self._line(pending, out)
        return b"".join(out)

    def _line(self, line: str, out: list[bytes]) -> None:
        parts = line.split(" ")
        if len(line) != len(line.strip()) or "" in parts or len(line.split()) != len(parts):
            # runs of blanks: cut only at the single spaces between non-blanks
            chunk = parts[0]
            for p in parts[1:]:
                if chunk and p and not chunk[-1].isspace() and not p[0].isspace():
                    out.append(self[chunk])
                    chunk = " " + p
                else:
                    chunk = chunk + " " + p
            out.append(self[chunk] if chunk else b"")
            return
        out.append(self[parts[0]])
        out.extend([self[" " + p] for p in parts[1:]])


@lru_cache(maxsize=1)
def word_memo(vocabulary: str) -> WordMemo:
    """The memo of a worker process, kept over its tasks."""
    return WordMemo(vocabulary)


def token_pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", *,
                 capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """One row per piece: (doc_id, piece, start, length, ids_crc32[, ids]).

    A document is its token ids and the end id. Documents of more than
    ``capacity`` ids are cut into pieces of ``capacity``; the first piece
    takes the remainder. ``vocabulary`` is the path of a byte-level BPE file
    that every executor can read (part of the installed environment).
    """
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("t"))
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = word_memo(vocabulary)
        for b in it:
            rows: list[tuple] = []
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids = memo.encode(t) + end
                n = len(ids) // 4
                start, piece, size = 0, 0, n - capacity * ((n - 1) // capacity)
                while start < n:
                    part = ids[4 * start:4 * (start + size)]
                    rows.append((doc, piece, start, size, zlib.crc32(part),
                                 *([np.frombuffer(part, dtype="<u4").astype(np.int32)] if with_ids else [])))
                    start, piece, size = start + size, piece + 1, capacity
            cols = list(zip(*rows)) or [()] * (6 if with_ids else 5)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(cols, types)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    return arrow_map(src, "doc_id long, piece int, start long, length long, ids_crc32 long"
                     + (", ids array<int>" if with_ids else ""), run)


def fullest(capacity: int, counts: dict[int, int], lengths: list[int]) -> dict[int, int]:
    """The combination of available ``lengths`` (descending) with the largest
    total within ``capacity``: bit t of a bitset tells whether a total of t can
    be reached; one bitset is kept per length to walk the choice back."""
    mask = (1 << (capacity + 1)) - 1
    reach, layers = 1, []
    for n in lengths:
        if n > capacity:
            continue
        before, left, width = reach, min(counts[n], capacity // n), 1
        while left > 0:  # binary multiples keep the number of shifts small
            take = min(width, left)
            reach |= (reach << (n * take)) & mask
            left -= take
            width *= 2
        layers.append((n, before))
        if reach >> capacity:
            break  # the bin can be filled with the lengths seen so far
    total, out = reach.bit_length() - 1, {}
    for n, before in reversed(layers):
        used = 0
        while not before >> total & 1:
            total -= n
            used += 1
        if used:
            out[n] = used
    return out


def slack_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(length -> copies in a bin, bins)]: every bin holds the longest length
    left and the fullest combination for the rest."""
    counts = {n: c for n, c in histogram.items() if c > 0}
    out: list[tuple[dict[int, int], int]] = []
    lengths = sorted(counts, reverse=True)
    while lengths:
        seed = lengths[0]
        counts[seed] -= 1
        rest = [n for n in lengths if counts[n] > 0]
        pattern = fullest(capacity - seed, counts, rest) if seed < capacity else {}
        counts[seed] += 1
        pattern = {**pattern, seed: pattern.get(seed, 0) + 1}
        times = min(counts[n] // k for n, k in pattern.items())
        for n, k in pattern.items():
            counts[n] -= k * times
        lengths = [n for n in lengths if counts[n] > 0]
        out.append((pattern, times))
    return out


def _slots(patterns: list[tuple[dict[int, int], int]]) -> dict[int, tuple[list, list, list, list]]:
    """Per length: first rank of each pattern, its first sequence, its copies
    per bin and the offset of the first copy."""
    out: dict[int, tuple[list, list, list, list]] = {}
    first_bin = 0
    for pattern, times in patterns:
        offset = 0
        for n in sorted(pattern, reverse=True):
            start, bins, copies, offsets = out.setdefault(n, ([0], [], [], []))
            bins.append(first_bin)
            copies.append(pattern[n])
            offsets.append(offset)
            start.append(start[-1] + pattern[n] * times)
            offset += n * pattern[n]
        first_bin += times
    return out


def ranked(pieces: DataFrame, length_col: str, order: list[str], out: str, rows_per_bucket: int = 4096) -> DataFrame:
    """``pieces`` with the rank (from 0) of each row within its length.

    Rows are ranked in buckets of a hash of ``order``; prefix sums over the
    small (length, bucket) counts shift the buckets, so no task needs all rows
    of one length.
    """
    n = pieces.count()
    buckets = max(16, -(-n // rows_per_bucket))
    b = pieces.withColumn("pk_b", F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = b.groupBy(length_col, "pk_b").agg(F.count(F.lit(1)).alias("pk_n"))
    before = sizes.withColumn("pk_before", F.coalesce(F.sum("pk_n").over(
        W.partitionBy(length_col).orderBy("pk_b").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    row = F.row_number().over(W.partitionBy(length_col, "pk_b").orderBy(*order))
    return (b.withColumn("pk_r", row).join(before.drop("pk_n"), [length_col, "pk_b"])
            .withColumn(out, F.col("pk_r") - 1 + F.col("pk_before")).drop("pk_b", "pk_r", "pk_before"))


def pack(pieces: DataFrame, capacity: int = 1024, length_col: str = "length",
         order: tuple[str, ...] = ("doc_id", "piece")) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset`` of each row.

    ``length_col`` holds lengths from 1 to ``capacity``. The pieces should be
    a written table (they are read three times).
    """
    rows = pieces.groupBy(length_col).agg(F.count(F.lit(1)).alias("n")).collect()  # at most `capacity` rows
    slots = _slots(slack_patterns({r[0]: r["n"] for r in rows}, capacity))
    names = pieces.columns
    at = names.index(length_col)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            seq, off = [], []
            for n, r in zip(b.column(at).to_pylist(), b.column(len(names)).to_pylist()):
                start, bins, copies, offsets = slots[n]
                i = bisect_right(start, r) - 1
                j, k = divmod(r - start[i], copies[i])
                seq.append(bins[i] + j)
                off.append(offsets[i] + k * n)
            yield pa.RecordBatch.from_arrays([*b.columns[:len(names)], pa.array(seq, type=pa.int64()),
                                              pa.array(off, type=pa.int64())],
                                             names=[*names, "sequence_id", "offset"])

    return ranked(pieces, length_col, list(order), "pk_rank").select(*names, "pk_rank").mapInArrow(
        run, schema + ", sequence_id long, offset long")


def best_fit_packing(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", *,
                     capacity: int = 1024, with_ids: bool = False) -> DataFrame:
    """Tokenise ``docs`` and pack the pieces into sequences of ``capacity``."""
    pieces = written(token_pieces(docs, vocabulary, id_col, text_col, capacity=capacity, with_ids=with_ids),
                     "token-pieces")
    return pack(pieces, capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the packed sequences themselves, from pieces packed
    with their ids; at most one capacity of ids per row."""
    return packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))),
                              lambda x: x["ids"])).alias("ids"))
