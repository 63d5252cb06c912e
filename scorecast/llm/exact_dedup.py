"""Exact de-duplication by deterministic block naming.

A text, with each run of white space replaced by one blank, is cut into blocks
of a fixed number of UTF-8 bytes. All distinct blocks of the corpus are sorted
(by their first bytes, then by two 64-bit hashes of the whole block) and
numbered, so equal names mean equal blocks. Adjacent names of a document are
then paired, the distinct pairs sorted and numbered in turn, and so on until
one name is left per document. A document's identity is (rounds, last name):
it is free of collisions, because every name stands for one byte string only.
The hashes are no exception: they are proved one-to-one with the distinct
blocks' bytes; were they not, other seeds would be taken.

What crosses tasks: the distinct blocks' bytes once, behind partial
aggregation; afterwards their first bytes, hashes and integers. Names are fixed
by writing each dictionary to the shared folder, so a lost executor never
renumbers. A round halves the rows, so all rounds together hold at most twice
the rows of the first. Groups of more than one row are written before they are
joined back, so that the rows of a large group are split among tasks.

Defined results
  * null or empty text: the empty text, equal to any other empty one (a text
    of white space only is one blank, which is another text);
  * null document id: ranks behind all others; ``keep_id`` is null only if
    every id of the group is;
  * repeated rows (same id, same text): one of them stays, the first in the
    input's order;
  * an empty table gives an empty result; columns of the input besides id and
    text are not read by ``exact_groups`` and are kept by ``drop_exact_copies``
    (its own working column takes a free name).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import free_name, written

BLOCK_BYTES = 1024
SORT_BYTES = 32  # of a block in its sort key, also what range bounds are drawn from
NO_NAME = -1  # the right half of a pair that ends a document of odd length


def one_blank(text: Column) -> Column:
    """The text with each run of white space as one blank, null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once and held, not copied, while
    higher-order functions go over it."""
    return F.transform(F.array(value), use)[0]


def _cut(raw: Column, size: int, use) -> Column:
    """``use`` of each block of ``size`` bytes (no byte: one empty block, so
    that every document takes part)."""
    last = F.greatest(F.ceil(F.octet_length(raw) / size).cast("int") - 1, F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda i: use(F.substring(raw, i * size + 1, F.lit(size))))


def _hashes(block: Column, seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(2 * seed), block).alias("h1"), F.xxhash64(F.lit(2 * seed + 1), block).alias("h2")]


def _numbered(keys: DataFrame, *by: str) -> DataFrame:
    """Keys in sorted order; ``name`` grows with that order (range partition in
    the high bits, place in it in the low ones)."""
    return keys.orderBy(*by).withColumn("name", F.monotonically_increasing_id())


def _block_names(raw: DataFrame, size: int, seed: int) -> DataFrame:
    """(h1, h2, name) of every distinct block of the column ``raw``."""
    blocks = raw.select(F.explode(_bound(F.col("raw"), lambda r: _cut(r, size, lambda b: b))).alias("block")).distinct()
    keys = blocks.select(F.substring("block", 1, SORT_BYTES).alias("begin"), *_hashes(F.col("block"), seed))
    return written(_numbered(keys, "begin", "h1", "h2").drop("begin"), "block-names")


def _rows(raw: DataFrame, size: int, seed: int) -> DataFrame:
    """(row, id, sha, n, hs): one row per document with its blocks' hashes."""
    def facts(r):
        return F.struct(F.sha2(r, 256).alias("sha"),
                        _cut(r, size, lambda b: F.struct(*_hashes(b, seed))).alias("hs"))
    facts_of = raw.select("id", _bound(F.col("raw"), facts).alias("f"))
    return written(facts_of.select(F.monotonically_increasing_id().alias("row"), "id", "f.sha",
                                   F.size("f.hs").alias("n"), "f.hs"), "document-blocks")


def _identities(rows: DataFrame, names: DataFrame) -> DataFrame:
    """(row, round, name): the identity of every document."""
    own = rows.select("row", "n", F.posexplode("hs").alias("pos", "h"))
    named = own.select("row", "n", "pos", "h.h1", "h.h2").join(names, ["h1", "h2"]).select("row", "n", "pos", "name")
    left = rows.agg(F.max("n")).first()[0] or 0
    found, step = [], 0
    while True:
        found.append(named.where(F.col("n") == 1).select("row", F.lit(step).alias("round"), "name"))
        if left <= 1:
            return reduce(DataFrame.unionByName, found)
        even = F.col("pos") % 2 == 0
        pairs = (named.where(F.col("n") > 1).groupBy("row", "n", F.expr("pos div 2").cast("int").alias("half"))
                 .agg(F.max(F.when(even, F.col("name"))).alias("a"), F.max(F.when(~even, F.col("name"))).alias("b")))
        pairs = written(pairs.select("row", F.expr("(n + 1) div 2").cast("int").alias("n"), F.col("half").alias("pos"), "a",
                                     F.coalesce("b", F.lit(NO_NAME)).alias("b")), "block-pairs")
        names = written(_numbered(pairs.select("a", "b").distinct(), "a", "b"), "pair-names")
        named = pairs.join(names, ["a", "b"]).select("row", "n", "pos", "name")
        left, step = (left + 1) // 2, step + 1


def _named_rows(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """(id, row, sha, round, name) per input row, in the input's order."""
    raw = docs.select(F.col(id_col).alias("id"), one_blank(F.col(text_col)).cast("binary").alias("raw"))
    seed = 0
    while True:
        names = _block_names(raw, size, seed)
        # 128 bits that two blocks share would make the look-up ambiguous
        if names.groupBy("h1", "h2").count().where(F.col("count") > 1).isEmpty():
            break
        seed += 1
    rows = _rows(raw, size, seed)
    return rows.select("row", "id", "sha").join(_identities(rows, names), "row")


def _grouped(named: DataFrame) -> DataFrame:
    """Adds the row that stays (``first``) and the size of each group."""
    named = written(named, "document-names")
    first = F.struct(F.col("id").isNull().alias("no_id"), "id", "row")
    groups = named.groupBy("round", "name").agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("group_size"))
    groups = written(groups.where(F.col("group_size") > 1), "document-groups")
    return named.join(groups, ["round", "name"], "left").withColumns(
        {"first": F.coalesce("first", first), "group_size": F.coalesce("group_size", F.lit(1).cast("long"))})


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per input row: id, keep_id (id of the row that stays), group_size,
    kept, text_sha256 (of the normalised text)."""
    out = _grouped(_named_rows(docs, id_col, text_col, block_bytes))
    return out.select(F.col("id").alias(id_col), F.col("first.id").alias("keep_id"), "group_size",
                      (F.col("row") == F.col("first.row")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The input without the rows that ``exact_groups`` drops, all columns kept.

    The input is written once, so that a row is the same row in both reads."""
    at = free_name(docs.columns, "row_at")
    docs = written(docs.withColumn(at, F.monotonically_increasing_id()), "numbered-documents")
    # the id is what ranks a group's rows: (null last, id, place)
    key = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).alias("id"), F.col(at).alias("at"))
    kept = exact_groups(docs.select(key.alias("key"), F.col(text_col).alias("text")), "key", "text", block_bytes)
    return docs.join(kept.where("kept").select(F.col("key.at").alias(at)), at, "left_semi").drop(at)
