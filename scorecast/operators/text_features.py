"""Text features in long form (Id, term, value) and as ML vectors.

Long tables are the distributed form of a sparse document-term matrix: rows
are dealt by Id while they are still texts, so that ``explode`` of the per-row
term array is aggregated per (Id, term) in the task that made it and no term
is shuffled for it; document frequencies are a second
aggregate, and the vocabulary filter is an equi-join on the term (AQE splits
a skewed term partition; the vocabulary is never collected or broadcast
without a bound).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from scorecast.functions import text as tx
from scorecast.session import configured, scratch_path, shuffle_partitions, shuffles_freed

# a task's share of texts yields some ten times its bytes as n-grams: more tasks
# than the shuffles of plain rows have keep the aggregation in memory
TEXT_TASKS = 8

# --------------------------------------------------------------------------
# Tokens, n-grams, document-term counts with a fitted vocabulary


def written(df: DataFrame, name: str) -> DataFrame:
    """The table written to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_document(df: DataFrame, id_col: str = "Id") -> DataFrame:
    """The rows dealt by Id: an aggregate per (Id, ...) above needs no shuffle."""
    return df.repartition(TEXT_TASKS * shuffle_partitions(df.sparkSession), id_col)


def doc_terms(df: DataFrame, terms: Column, id_col: str = "Id") -> DataFrame:
    """(Id, term, tf): per-document term counts from an array column."""
    return (by_document(df, id_col).select(F.col(id_col).alias(id_col), F.explode(terms).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def ngram_doc_terms(df: DataFrame, toks: Column, n_min: int = 1, n_max: int = 1,
                    id_col: str = "Id") -> DataFrame:
    """T3 + T4: (Id, term, tf) of n-grams. Tokens are projected into a column
    first, so the tokenizer runs once per row and the n-gram lambdas read
    the materialised array."""
    t = by_document(df, id_col).select(F.col(id_col), toks.alias("__toks"))
    return (t.select(F.col(id_col), F.explode(tx.ngrams(F.col("__toks"), n_min, n_max)).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def document_frequency(dt: DataFrame) -> DataFrame:
    """(term, df): number of documents containing each term."""
    return dt.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def fit_vocabulary(dt: DataFrame, n_docs: int, min_df=1, max_df=1.0,
                   max_features: int | None = None) -> DataFrame:
    """T4 fit: terms whose document frequency is within [min_df, max_df].

    A float bound is a fraction of ``n_docs``, an int an absolute count
    (``max_df=1.0`` keeps every term). ``max_features`` keeps the most
    frequent terms (ties by term) - a TakeOrdered, bounded by its argument.
    The vocabulary is a written table: the joins with it know its size, so a
    small one is sent to the counts, which then stay where they are, and a
    large one is met by a shuffle.
    """
    lo = min_df * n_docs if isinstance(min_df, float) else min_df
    hi = max_df * n_docs if isinstance(max_df, float) else max_df
    v = document_frequency(dt).where((F.col("df") >= F.lit(lo)) & (F.col("df") <= F.lit(hi)))
    if max_features:
        v = v.orderBy(F.col("df").desc(), F.col("term")).limit(max_features)
    return written(v, "vocabulary")


def apply_vocabulary(dt: DataFrame, vocab: DataFrame) -> DataFrame:
    """T4 transform: keep (Id, term, tf) rows whose term is in the vocabulary."""
    return dt.join(vocab.select("term"), "term", "left_semi")


def count_vectorize(fit_df: DataFrame, apply_df: DataFrame, col: str, n_min: int = 1,
                    n_max: int = 1, min_df=1, max_df=1.0, id_col: str = "Id",
                    tokenizer=None, stop_words=None):
    """T4: CountVectorizer semantics (lowercase, 2+ char word tokens,
    n-grams n_min..n_max, vocabulary fitted on ``fit_df``). Returns
    (vocabulary, long counts of ``apply_df``)."""
    tok = tokenizer or (lambda c: tx.tokens(c, 2))

    def dterms(df):
        t = tok(F.col(col))
        if stop_words is not None:
            t = tx.remove_stop_words(t, stop_words)
        return ngram_doc_terms(df, t, n_min, n_max, id_col)

    fit_dt = dterms(fit_df)
    vocab = fit_vocabulary(fit_dt, fit_df.count(), min_df, max_df)
    dt = fit_dt if apply_df is fit_df else dterms(apply_df)
    return vocab, apply_vocabulary(dt, vocab)


# --------------------------------------------------------------------------
# T5: TF-IDF with smooth idf and L2 row norm


def tfidf(dt: DataFrame, vocab_df: DataFrame, n_docs: int, id_col: str = "Id",
          digits: int | None = 9) -> DataFrame:
    """T5: idf = ln((1+n)/(1+df)) + 1 over the fitting corpus, value = tf*idf,
    rows L2-normalised. ``vocab_df`` holds (term, df) from the fit. The row
    norm is taken with the document's terms in one aggregate (one row per
    document, bounded by its terms), never a window over a hot term. Rows
    without an Id have no document."""
    idf = vocab_df.select("term", (F.log((F.lit(1.0) + n_docs) / (F.col("df") + 1.0)) + 1.0)
                          .alias("idf"))
    w = dt.join(idf, "term").select(id_col, "term", (F.col("tf") * F.col("idf")).alias("w"))
    docs = w.where(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("__norm"), F.collect_list(F.struct("term", "w")).alias("__e"))
    out = docs.select(id_col, "__norm", F.explode("__e").alias("__e")).select(
        id_col, "__e.term", F.try_divide(F.col("__e.w"), F.col("__norm")).alias("tfidf"))
    if digits is not None:
        out = out.withColumn("tfidf", F.round("tfidf", digits))
    return out


# up to this many terms (some 100 MB in a task) a vocabulary is sent to the rows
SENT_TERMS = 2_000_000


def term_rows(dt: DataFrame, id_col: str = "Id") -> tuple[DataFrame, int]:
    """((Id, terms, tfs), values): the counts of ``doc_terms`` as one written row
    per document, which later passes read in place of the text. The counts of a
    document lie in one task already; a task's documents are collected in
    memory, as they come, without a sort."""
    spark, seen = dt.sparkSession, Observation()
    rows = dt.groupBy(id_col).agg(F.collect_list(F.struct("term", "tf")).alias("e")).select(
        id_col, F.col("e.term").alias("terms"), F.col("e.tf").alias("tfs")).observe(seen, F.sum(F.size("tfs")).alias("n"))
    with shuffles_freed(spark), configured(spark, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", "100000"):
        out = written(rows, "term-rows")
    return out, int(seen.get["n"] or 0)


def row_terms(rows: DataFrame, id_col: str = "Id") -> DataFrame:
    """(Id, term, tf) of ``term_rows``."""
    return rows.select(id_col, F.explode(F.arrays_zip("terms", "tfs")).alias("e")).select(
        id_col, F.col("e.terms").alias("term"), F.col("e.tfs").alias("tf"))


def tfidf_rows(rows: DataFrame, vocab_df: DataFrame, n_docs: int, id_col: str = "Id") -> DataFrame:
    """``tfidf`` of ``term_rows``, unrounded, as (Id, terms, xs): one row per
    document with an Id and a term of the vocabulary. A vocabulary of up to ``SENT_TERMS``
    terms is sent to the rows; a larger one is met by a shuffle."""
    from scorecast.operators.nmf import as_rows, flat, gathered, lengths, lists
    spark = rows.sparkSession
    if vocab_df.count() > SENT_TERMS:
        dt = apply_vocabulary(row_terms(rows, id_col), vocab_df)
        return as_rows(tfidf(dt, vocab_df, n_docs, id_col, None).withColumnRenamed("tfidf", "x"), id_col)
    known = vocab_df.select("term", "df").toArrow()
    idf = np.log((1.0 + n_docs) / (known.column("df").to_numpy().astype(float) + 1.0)) + 1.0
    shared = spark.sparkContext.broadcast((known.column("term").combine_chunks(), idf))

    def run(batches):
        names, idf = shared.value
        for t in gathered(batches, 1, 500_000):
            at = pc.index_in(flat(t, "terms"), value_set=names)
            there = pc.is_valid(at)
            row = np.repeat(np.arange(t.num_rows), lengths(t, "terms"))[there.to_numpy(zero_copy_only=False)]
            w = flat(t, "tfs").filter(there).to_numpy() * idf[at.drop_null().to_numpy()]
            norm, size = np.sqrt(np.bincount(row, w * w, t.num_rows)), np.bincount(row, minlength=t.num_rows)
            kept, offsets = np.flatnonzero(size), np.append(0, np.cumsum(size[size > 0]))
            yield pa.RecordBatch.from_arrays(
                [t.column(0).combine_chunks().take(pa.array(kept)), lists(offsets, flat(t, "terms").filter(there)),
                 lists(offsets, pa.array(w / norm[row]))], names=["Id", "terms", "xs"])

    return rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("Id"), "terms", "tfs").mapInArrow(run, "Id long, terms array<string>, xs array<double>")


# --------------------------------------------------------------------------
# Hashed features (signed, L2-normalised), md5 buckets


def hash_bucket(term: Column, n_features: int) -> Column:
    return (F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long") % F.lit(n_features))


def hash_sign(term: Column) -> Column:
    return F.when(F.conv(F.substring(F.md5(term), 9, 1), 16, 10).cast("int") < 8, 1).otherwise(-1)


def hashed_features(df: DataFrame, toks: Column, n_min: int = 1, n_max: int = 1,
                    n_features: int = 1 << 20, id_col: str = "Id",
                    digits: int | None = 9) -> DataFrame:
    """Stateless signed hashing of n-grams (no vocabulary pass), summed per
    document in the task that holds it, then L2 norm per document. Rows without
    an Id have no document."""
    t = by_document(df, id_col).select(F.col(id_col), toks.alias("__toks")).where(F.col(id_col).isNotNull())
    e = t.select(F.col(id_col), F.explode(tx.ngrams(F.col("__toks"), n_min, n_max)).alias("term"))
    b = (e.groupBy(id_col, hash_bucket(F.col("term"), n_features).alias("bucket"))
         .agg(F.sum(hash_sign(F.col("term"))).cast("double").alias("v")))
    docs = b.groupBy(id_col).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("__n"),
                                 F.collect_list(F.struct("bucket", "v")).alias("__e"))
    out = docs.select(id_col, "__n", F.explode("__e").alias("__e")).select(
        id_col, "__e.bucket", F.try_divide(F.col("__e.v"), F.col("__n")).alias("value"))
    if digits is not None:
        out = out.withColumn("value", F.round("value", digits))
    return out.where(F.col("value") != 0)


# --------------------------------------------------------------------------
# Corpus word frequencies


def word_frequencies(df: DataFrame, col: str, top_n: int = 500, stop_words=None,
                     extra_stop=()) -> DataFrame:
    """Lowercase, delete ASCII punctuation, word tokens, stop words out,
    corpus counts, the ``top_n`` most frequent (ties by term) with weight =
    count / max count. The count is a partial aggregate; only top_n rows
    leave the TakeOrdered."""
    words = list(tx.english_stop_words() if stop_words is None else stop_words) + list(extra_stop)
    t = tx.tokens(tx.delete_ascii_punct(tx.lower(col)), 2, to_lower=False)
    t = tx.remove_stop_words(t, words)
    counts = (df.select(F.explode(t).alias("term")).groupBy("term")
              .agg(F.count(F.lit(1)).alias("n")))
    top = counts.orderBy(F.col("n").desc(), F.col("term")).limit(top_n)
    mx = F.max("n").over(_all())
    return top.select("term", "n", (F.col("n") / mx).alias("weight"))


def _all():
    from pyspark.sql import Window
    return Window.partitionBy()


# --------------------------------------------------------------------------
# Tag counts per row, aligned between train and test

# Token-shape tags used in place of a trained part-of-speech
# model (checked in this order; the first match wins).
SHAPE_TAGS = [
    ("NUM", r"^\p{Nd}+$"),
    ("ALNUM", r"\p{Nd}"),
    ("UPPER", r"^\p{Lu}{2,}$"),
    ("TITLE", r"^\p{Lu}\p{Ll}"),
    ("LOWER", r"^\p{Ll}+$"),
]

# Entity patterns used in place of a trained entity recogniser.
ENTITY_PATTERNS = [
    ("EMAIL", r"[\w.+-]+@[\w-]+\.[\w.]+"),
    ("URL", r"https?://\S+|www\.\S+"),
    ("MONEY", r"[$€£]\s?\p{Nd}+(?:[.,]\p{Nd}+)?"),
    ("PERCENT", r"\p{Nd}+(?:[.,]\p{Nd}+)?\s?%"),
    ("DATE", r"\p{Nd}{4}-\p{Nd}{2}-\p{Nd}{2}|\p{Nd}{1,2}/\p{Nd}{1,2}/\p{Nd}{2,4}"),
    ("NUMBER", r"\p{Nd}+"),
]


def shape_tagger(col: str, stop_words=None, to_lower: bool = False) -> Column:
    """One tag per non-stop word token by token shape."""
    src = F.lower(F.col(col)) if to_lower else F.col(col)
    toks = F.regexp_extract_all(src, F.lit(tx.WORD_CHAR + "+"), F.lit(0))
    words = list(tx.english_stop_words() if stop_words is None else stop_words)
    toks = F.filter(toks, lambda t: ~F.lower(t).isin(words))  # hash-set lookup

    def tag(t):
        e = F.lit("OTHER")
        for name, pat in reversed(SHAPE_TAGS):
            e = F.when(t.rlike(pat), F.lit(name)).otherwise(e)
        return e
    return F.transform(toks, tag)


def entity_counts(df: DataFrame, col: str, prefix: str, id_col: str = "Id") -> DataFrame:
    """Wide counts of each entity pattern (patterns tried in order on
    disjoint matches: a text span counts for the first pattern only)."""
    rest = F.col(col)
    cols = []
    for name, pat in ENTITY_PATTERNS:
        cols.append(F.regexp_count(rest, F.lit(pat)).cast("long").alias(f"{prefix}_{name}"))
        rest = F.regexp_replace(rest, pat, " ")
    return df.select(id_col, *cols)


def tag_counts_long(df: DataFrame, tags_col: str, classes: list[str], vocab: DataFrame,
                    keep=("Id",)) -> DataFrame:
    """T8 + A6 + U2: one row per row and vocabulary tag, (keep..., tag, n),
    zeros included. ``classes`` is the tagger's closed set of tags; ``vocab``
    (one column ``tag``, e.g. the tags of the train half) says which of them
    are counted, so tables counted over one vocabulary have equal tags."""
    counted = (df.select(*keep, F.explode(F.array(*[F.lit(c) for c in classes])).alias("tag"),
                         F.col(tags_col).alias("__tags"))
               .select(*keep, "tag", F.size(F.filter("__tags", lambda x: x == F.col("tag"))).cast("long").alias("n")))
    # at most one row per class
    return counted.join(F.broadcast(vocab.where(F.col("tag").isin(classes)).select("tag").distinct()),
                        "tag", "left_semi")
