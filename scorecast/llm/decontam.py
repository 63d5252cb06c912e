"""Benchmark decontamination by spaced-seed hashing (built-in functions only).

Texts become words (lower-cased runs of letters and digits) and word hashes.
A spaced seed is a fixed mask over consecutive words that ignores the
positions marked 0, so a hit survives substitutions there. The seed hashes of
the benchmark are joined with those of the corpus; a hit fixes an alignment
(document, item, diagonal). The verification compares the words of item and
document along the diagonal and asks for a stretch of ``min_overlap`` words
with at least ``min_similarity`` equal words. The masks lose none: every
stretch of 13 words with two substitutions holds a hit (all 78 placements are
enumerated in the tests). Where ``min_overlap`` and ``min_similarity`` allow
more substitutions, runs of words short enough that one stays whole take their
place. Items shorter than ``min_overlap`` are looked for whole: all their
words, side by side.

The seed table of the benchmark is broadcast while it has at most
``broadcast_rows`` rows (counted first); beyond that it is joined by shuffle.

Defined results
  * null or empty texts and items (no word) give no row;
  * repeated rows, and rows that share an id, give one row per (id, item) with
    the best of them; a null id is reported as null;
  * empty tables give an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from scorecast.llm.common import free_name, written

# fixed masks (1: compared, 0: ignored); they hit every stretch of PROVED[0]
# words with PROVED[1] substitutions
MASKS = ("111001011", "101100111")
SPAN = 9
PROVED = (13, 2)


def word_hashes(text: Column) -> Column:
    """Hashes of a text's words, in order."""
    words = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def masks_for(size: int, lost: int) -> tuple[str, ...]:
    """Masks that hit every stretch of ``size`` words with ``lost`` substitutions."""
    parts = size // PROVED[0]
    if parts and lost // parts <= PROVED[1]:  # one of the parts has no more than PROVED[1]
        return MASKS
    return ("1" * max(1, size // (lost + 1)),)


def seed_hashes(words: Column, masks: tuple[str, ...] = MASKS) -> Column:
    """Seed hashes of all positions: element p * len(masks) + m belongs to the
    window that starts at word p and to mask m (null where it does not fit)."""
    least = min(len(m) for m in masks)
    at = F.when(F.size(words) >= least, F.sequence(F.lit(0), F.size(words) - least)).otherwise(
        F.array().cast("array<int>"))

    def one(i: Column, m: int) -> Column:
        seed = F.xxhash64(F.lit(m), *[F.get(words, i + k) for k, bit in enumerate(masks[m]) if bit == "1"])
        return seed if len(masks[m]) == least else F.when(i + len(masks[m]) <= F.size(words), seed)

    return F.flatten(F.transform(at, lambda i: F.array(*[one(i, m) for m in range(len(masks))])))


def _seeds(rows: DataFrame, masks: tuple[str, ...], *keep: str) -> DataFrame:
    """(keep..., pos, mask, seed) with one row per position and mask."""
    made = rows.withColumn("seeds", seed_hashes(F.col("w"), masks))
    # the outer form, as the optimizer copies the whole seed expression into a
    # size filter below the inner one
    return (made.select(*keep, F.posexplode_outer("seeds").alias("k", "seed")).filter(F.col("seed").isNotNull())
            .select(*keep, F.floor(F.col("k") / len(masks)).cast("int").alias("pos"),
                    (F.col("k") % len(masks)).alias("mask"), "seed"))


def _text_key(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", *, min_overlap: int = 13,
                  min_similarity: float = 0.8, broadcast_rows: int = 1_000_000) -> DataFrame:
    """(doc_id, item_id, text_key, word_start, word_end, n_equal, similarity):
    the best verified stretch of every contaminated (document row, item).

    ``text_key`` is a hash of the text that tells rows with one id apart;
    word positions are those of the document, end exclusive.
    """
    need = -(-int(round(min_similarity * 1000)) * min_overlap // 1000)
    items = written(benchmark.select(F.col(item_col).alias("item_id"), word_hashes(F.col(item_text_col)).alias("w"))
                    .filter(F.size("w") > 0), "benchmark-words")
    size = F.size("w")
    # at most min_overlap - 1 short lengths
    seen = items.agg(F.sum(size).alias("n"), F.collect_set(F.when(size < min_overlap, size)).alias("short")).first()
    long_masks = masks_for(min_overlap, min_overlap - need)
    masks = (*long_masks, *("1" * n for n in sorted(seen["short"])))
    # an item has the seeds of its own kind only
    own = F.when(F.col("size") >= min_overlap, F.col("mask") < len(long_masks)).otherwise(F.lit(False))
    for m, mask in enumerate(masks[len(long_masks):], len(long_masks)):
        own = own | ((F.col("size") == len(mask)) & (F.col("mask") == m))
    keys = (_seeds(items.withColumn("size", size), masks, "item_id", "size").filter(own)
            .select("seed", "item_id", F.col("pos").alias("item_pos")))
    rows = (seen["n"] or 0) * len(masks)
    if rows <= broadcast_rows:
        keys = F.broadcast(keys)
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), _text_key(text_col).alias("text_key"),
                         F.col(text_col).alias("t"))
    hashed = narrow.select("doc_id", "text_key", word_hashes(F.col("t")).alias("w"))
    hits = (_seeds(hashed, masks, "doc_id", "text_key").join(keys, "seed")
            .select("doc_id", "text_key", "item_id", (F.col("pos") - F.col("item_pos")).alias("diagonal")).distinct())
    hits = written(hits, "seed-hits")
    return _verified(hits, narrow, items, min_overlap, need)


def _verified(hits: DataFrame, docs: DataFrame, items: DataFrame, min_overlap: int,
              min_equal: int) -> DataFrame:
    # a shorter item is one stretch, with all words equal
    size = F.least(F.lit(min_overlap), F.size("iw"))
    need = F.when(F.size("iw") < min_overlap, F.size("iw")).otherwise(min_equal)
    h = hits.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key"), "item_id", "diagonal")
    texts = docs.join(hits.select(F.col("doc_id").alias("hit_id"), F.col("text_key").alias("hit_key")).distinct(),
                      (F.col("text_key") == F.col("hit_key")) & F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi")
    texts = texts.groupBy("doc_id", "text_key").agg(F.first("t").alias("t"))
    words = texts.select("doc_id", "text_key", word_hashes(F.col("t")).alias("dw"))
    both = (h.join(words, (F.col("text_key") == F.col("hit_key")) & F.col("doc_id").eqNullSafe(F.col("hit_id")))
            .join(items.withColumnRenamed("w", "iw").withColumnRenamed("item_id", "own"),
                  F.col("own").eqNullSafe(F.col("item_id"))))
    equal = F.transform(F.col("iw"), lambda x, j: F.when(
        F.get(F.col("dw"), j + F.col("diagonal")).eqNullSafe(x) & (j + F.col("diagonal") >= 0), 1).otherwise(0))
    # running count of equal words: sums[j] = equal words before item word j
    sums = F.aggregate(F.col("eq"), F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))

    def stretch(j: Column) -> Column:
        return F.struct((F.get(F.col("sums"), j + size) - F.get(F.col("sums"), j)).alias("n"), (-j).alias("neg"))

    at = F.sequence(F.lit(0), F.size("iw") - size)
    best = (both.withColumn("eq", equal).withColumn("sums", sums)
            .withColumn("best", F.array_max(F.transform(at, stretch)))
            .filter(F.col("best.n") >= need)
            .withColumn("n_all", F.element_at("sums", -1)).withColumn("size", size))
    start = -F.col("best.neg") + F.col("diagonal")
    return (best.groupBy("doc_id", "item_id", "text_key")
            .agg(F.max(F.struct(F.col("best.n").alias("n"), F.col("n_all"), (-start).alias("neg"), "size")).alias("b"))
            .select("doc_id", "item_id", "text_key", (-F.col("b.neg")).cast("int").alias("word_start"),
                    (-F.col("b.neg") + F.col("b.size")).cast("int").alias("word_end"),
                    F.col("b.n_all").cast("int").alias("n_equal"),
                    (F.col("b.n") / F.col("b.size")).alias("similarity")))


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, **settings) -> DataFrame:
    """One row per contaminated (doc_id, item_id), the best of its rows."""
    c = contamination(docs, benchmark, **settings)
    return (c.groupBy("doc_id", "item_id")
            .agg(F.max(F.struct("similarity", "n_equal", (-F.col("word_start")).alias("neg"), "word_end")).alias("b"))
            .select("doc_id", "item_id", (-F.col("b.neg")).alias("word_start"), F.col("b.word_end").alias("word_end"),
                    F.col("b.n_equal").alias("n_equal"), F.col("b.similarity").alias("similarity")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **settings) -> DataFrame:
    """The rows of ``docs`` without a verified benchmark overlap."""
    found = contamination(docs, benchmark, id_col, text_col, **settings).select("doc_id", "text_key").distinct()
    a, b = free_name(docs.columns, "dc_id"), free_name(docs.columns, "dc_key")
    found = found.select(F.col("doc_id").alias(a), F.col("text_key").alias(b))
    return docs.join(found, (_text_key(text_col) == F.col(b)) & F.col(id_col).cast("long").eqNullSafe(F.col(a)),
                     "left_anti")
