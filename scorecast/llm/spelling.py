"""Spelling variant grouping with a bit-sliced position index.

Words are the maximal letter runs of all texts (A-Z lower-cased), counted over
the corpus. Two words are near if one inserted, deleted or replaced letter
turns one into the other. A word's form is its commonest near word, if that is
``ratio`` times as common; following the forms leads to its root.

The index of a block of words holds, for each position and letter, a bitset
over the block: which words have that letter there. A query word runs through
it with three sets that are tracked side by side, one step per letter:

    zero      &= has[i][q_i]                                  no error so far
    replaced   = replaced & has[i][q_i]  |  zero & ~has[i][q_i]
    inserted   = inserted & has[i+1][q_i]  |  zero            shifted by one

so one word operation compares 64 words, and many queries of a block go
through it together. The sets of the words as long as the query, or one
longer, then hold the near words; shorter ones find the query in turn.

Only words that can be near meet: for the shorter length ``m`` of a pair, one
error leaves the first or the last ``m // 2`` letters as they are, so words
are dealt by (m, end, those letters), once for their own length and once for
the length below. A pair that both ends find is taken from the first one.
Buckets of more words than a block are cut into block pairs, each a group of
its own; small buckets share a block.

Defined results
  * null or empty text, or one without a word that is long enough: no word;
  * null document id: hashed like an id without digits;
  * repeated rows and ids count each; an empty table gives an empty result;
  * ties between forms: the commonest, then the first in code-point order;
  * words may be of any length (a block's size falls as its words grow);
  * other columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import arrow_map, utf8, written

LOWER_ASCII = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
BLOCK_WORDS = 4096        # words of a block's index
BLOCK_LETTERS = 1 << 20   # ... and letters, for very long words
QUERIES_AT_ONCE = 512
COUNTS_IN_MEMORY = 200_000


# -- words ------------------------------------------------------------------


def typo(doc_id: int | None, run: str, every: int) -> str:
    """The run, less one letter where ``every`` divides its hash with the id."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_count: int, every: int) -> DataFrame:
    """(word, n): counts per task first, then one grouped sum."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("t"))
    letters = re.compile(r"[A-Za-zÀ-ÿ]{%d,}" % min_chars)

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), type=pa.string()), pa.array(list(counts.values()), type=pa.int64())],
                                          names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in batches:
            for i, t in zip(*(c.to_pylist() for c in b.columns)):
                # maximal runs: a shorter one never matches, a match never ends early
                for r, n in Counter(letters.findall(t.translate(LOWER_ASCII).decode("utf-8", "replace"))).items():
                    w = typo(i, r, every)
                    if len(w) >= min_chars:
                        counts[w] += n
                if len(counts) >= COUNTS_IN_MEMORY:
                    yield flush(counts)
                    counts.clear()
        yield flush(counts)

    found = arrow_map(src, "word string, n long", run)
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -- buckets ----------------------------------------------------------------


def _buckets(words: DataFrame, min_chars: int) -> DataFrame:
    """(word, n, m, end, part): every word under the letters that a near word
    shares with it, for pairs whose shorter word has ``m`` letters."""
    def ends(m: Column) -> Column:
        k = F.floor(m / 2).cast("int")
        return F.array(F.struct(m.alias("m"), F.lit("first").alias("end"), F.left("word", k).alias("part")),
                       F.struct(m.alias("m"), F.lit("last").alias("end"), F.right("word", k).alias("part")))

    size = F.length("word")
    return (words.select("word", "n", F.explode(F.concat(ends(size), ends(size - 1))).alias("b"))
            .select("word", "n", "b.*").where(F.col("m") >= min_chars))


def _groups(words: DataFrame, min_chars: int, block_words: int) -> DataFrame:
    """(g, word, n, m, end, asks, held): the rows that one index block and its
    queries need. Buckets of more than a block are cut into ``c`` parts; each
    part's words are asked against each part's index."""
    dealt, key = _buckets(words, min_chars), ["m", "end", "part"]
    rows = F.count(F.lit(1))
    parts = F.ceil(F.greatest(rows / block_words, rows * (F.col("m") + 1) / BLOCK_LETTERS)).cast("int")
    large = dealt.groupBy(*key).agg(parts.alias("c")).where(F.col("c") > 1)
    dealt = dealt.join(large, key, "left").withColumn("c", F.coalesce("c", F.lit(1)))
    short, own = F.length("word") == F.col("m"), F.expr("cast(pmod(xxhash64(word), c) as int)")
    all_parts = F.sequence(F.lit(0), F.col("c") - 1)
    as_index = F.transform(all_parts, lambda j: F.struct(own.alias("i"), j.alias("j"), F.lit(False).alias("asks"), F.lit(True).alias("held")))
    as_query = F.transform(all_parts, lambda i: F.struct(i.alias("i"), own.alias("j"), F.lit(True).alias("asks"), F.lit(False).alias("held")))
    both = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), short.alias("asks"), F.lit(True).alias("held")))
    places = F.when(F.col("c") == 1, both).when(short, F.concat(as_index, as_query)).otherwise(as_index)
    return dealt.select(*key, "word", "n", F.explode(places).alias("p")).select(
        F.concat_ws(":", "m", "end", "p.i", "p.j", "part").alias("g"), "word", "n", "m", "end", "p.asks", "p.held")


# -- the index --------------------------------------------------------------


class BitSlices:
    """Per position and letter, the bitset of the block's words that have it."""

    def __init__(self, words: list[str]):
        self.size = len(words)
        self.lengths = np.array([len(w) for w in words])
        self.longest = int(self.lengths.max())
        codes = _codes(words, self.longest)
        # a row of zeros at the end stands for letters that no word has there
        self.rows, self.bits = [], []
        for at in range(self.longest):
            letters = np.unique(codes[:, at])
            letters = letters[letters > 0]
            row = np.full(256, len(letters))
            row[letters] = np.arange(len(letters))
            self.rows.append(row)
            self.bits.append(np.vstack([self.pack(codes[:, at] == letters[:, None]), np.zeros((1, self.words64), np.uint64)]))

    @property
    def words64(self) -> int:
        return -(-self.size // 64)

    def pack(self, sets: np.ndarray) -> np.ndarray:
        """Rows of booleans over the block as rows of 64-bit words."""
        out = np.zeros((len(sets), self.words64 * 8), dtype=np.uint8)
        packed = np.packbits(sets, axis=1, bitorder="little")
        out[:, :packed.shape[1]] = packed
        return out.view(np.uint64)

    def has(self, at: int, letters: np.ndarray) -> np.ndarray:
        """For each letter, the words that have it at this position."""
        if at >= self.longest:
            return np.zeros((len(letters), self.words64), np.uint64)
        return self.bits[at][self.rows[at][letters]]

    def of_length(self, n: int) -> np.ndarray:
        return self.pack((self.lengths == n)[None, :])[0]

    def near(self, queries: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) places of the words that a replaced or an inserted
        letter makes of a query."""
        order = sorted(range(len(queries)), key=lambda k: len(queries[k]))
        found_q, found_w = [], []
        for lo in range(0, len(order), QUERIES_AT_ONCE):
            block = np.array(order[lo:lo + QUERIES_AT_ONCE])
            for q, w in self._run([queries[k] for k in block]):
                found_q.append(block[q])
                found_w.append(w)
        none = np.zeros(0, dtype=int)
        return np.concatenate([none, *found_q]), np.concatenate([none, *found_w])

    def _run(self, queries: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """``queries`` in ascending length; the ended ones leave in front."""
        ends = np.array([len(q) for q in queries])
        codes = _codes(queries, int(ends[-1]))
        zero = np.repeat(self.pack(np.ones((1, self.size), dtype=bool)), len(queries), axis=0)
        inserted, replaced, gone = zero.copy(), np.zeros_like(zero), 0
        for at in range(int(ends[-1])):
            letters = codes[gone:, at]
            same, shifted = self.has(at, letters), self.has(at + 1, letters)
            replaced = (replaced & same) | (zero & ~same)
            zero = zero & same
            inserted = (inserted & shifted) | zero
            ended = int(np.searchsorted(ends, at + 1, side="right")) - gone
            if ended:
                hits = (replaced[:ended] & self.of_length(at + 1)) | (inserted[:ended] & self.of_length(at + 2))
                q = np.flatnonzero(hits.any(axis=1))
                sets = np.unpackbits(hits[q].view(np.uint8), axis=1, count=self.size, bitorder="little")
                r, w = np.nonzero(sets)
                yield q[r] + gone, w
                zero, inserted, replaced, gone = zero[ended:], inserted[ended:], replaced[ended:], gone + ended


def _codes(words: list[str], longest: int) -> np.ndarray:
    """One byte per letter (all letters are below U+0100), zero behind the end."""
    raw = np.array([w.encode("latin-1") for w in words], dtype=f"S{longest}")
    return raw.view(np.uint8).reshape(len(words), longest)


def _near_in_block(rows: list[tuple]) -> Iterator[tuple[str, str, int]]:
    """(word, near word, its n) of whole groups that share an index."""
    held, asks = [r for r in rows if r[6]], [r for r in rows if r[5]]
    if not held or not asks:
        return
    index = BitSlices([r[1] for r in held])
    for q, w in zip(*(x.tolist() for x in index.near([r[1] for r in asks]))):
        a, b = asks[q], held[w]
        if a[0] != b[0]:
            continue  # another group's word: their own group finds them
        k = a[3] // 2
        if a[4] == "last" and a[1][:k] == b[1][:k]:
            continue  # the pair's first letters find it too
        yield a[1], b[1], b[2]
        if len(b[1]) > len(a[1]):
            yield b[1], a[1], a[2]


def near_words(words: DataFrame, min_chars: int, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(word, other, other_n): every ordered pair of near words of (word, n)."""
    dealt = _groups(words, min_chars, block_words).repartition("g").sortWithinPartitions("g")

    def found(rows: list[tuple]) -> pa.RecordBatch:
        pairs = list(_near_in_block(rows))
        cols = list(zip(*pairs)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, (pa.string(), pa.string(), pa.int64()))],
                                          names=["word", "other", "other_n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: list[tuple] = []    # whole groups that share an index
        group: list[tuple] = []    # the group that is being read
        longest = 0

        def full() -> bool:
            size = len(block) + len(group)
            return bool(block) and (size > block_words or size * longest > BLOCK_LETTERS)

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if group and group[0][0] != row[0]:
                    if len(group) > 1:
                        longest = max(longest, len(group[0][1]) + 1)
                        if full():
                            yield found(block)
                            block, longest = [], len(group[0][1]) + 1
                        block += group
                    group = []
                group.append(row)
        if len(group) > 1:
            block += group
        if block:
            yield found(block)

    return arrow_map(dealt, "word string, other string, other_n long", run)


# -- forms and roots --------------------------------------------------------


def _roots(forms: DataFrame, ratio: float) -> DataFrame:
    """(word, root) of the words that have a form, by doubling the steps."""
    at = written(forms.where(F.col("form").isNotNull()).select("word", F.col("form").alias("root")), "spelling-roots")
    most, least = forms.where(F.col("form").isNotNull()).agg(F.max("form_n"), F.min("n")).first()
    steps, reach = 1, least or 1
    while most and reach * ratio <= most:  # each step's n is ``ratio`` times the last one's
        steps, reach = steps + 1, reach * ratio
    done = 1
    while done < steps:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        at = written(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        done *= 2
    return at


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 7, min_count: int = 2,
                   ratio: float = 10.0, typo_every: int = 31, block_words: int = BLOCK_WORDS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of at least
    ``min_chars`` letters with ``min_count`` occurrences. ``typo_every`` drops a
    letter of one in so many (document, word)s, so that forms can be measured."""
    if min_chars < 4 or ratio <= 1:
        raise ValueError("min_chars must be 4 or more and ratio over 1")
    words = written(word_counts(docs, id_col, text_col, min_chars, min_count, typo_every), "spelling-words")
    pairs = near_words(words, min_chars, block_words)
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")
    near = pairs.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best)
    common = -F.col("best.less") >= ratio * F.col("n")
    forms = written(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("best.other")).alias("form"), F.when(common, -F.col("best.less")).alias("form_n")), "spelling-forms")
    out = forms.join(_roots(forms, ratio), "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
