"""Table cleaning: keep-first dedupe, fills, drops, renames, recodes, steps."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scorecast.functions import text as tx


def dedupe_keep_first(df: DataFrame, keys, order_col: str = "Id") -> DataFrame:
    """One row per distinct ``keys`` value, the one with the smallest ``order_col``.

    Written as a ``groupBy(keys)`` aggregate rather than a ``row_number``
    window: the aggregate is partial (map-side), so a key shared by a third of
    all rows is reduced to one row per map task before the shuffle instead of
    landing in one task. Nulls in keys compare equal, as in
    ``drop_duplicates``. The kept row's keys are the group's own, so only the
    other columns are carried beside them; with none but a numeric
    ``order_col`` left, the aggregate is a hash aggregate and sorts no texts.
    """
    keys = list(keys)
    # 0.0 and -0.0 are one group: such keys are taken from the row itself
    shared = [f.name for f in df.schema.fields
              if f.name in keys and f.name != order_col and f.dataType.typeName() in ("string", "integer", "long", "boolean")]
    rest = [c for c in df.columns if c not in shared]
    row = F.min(order_col) if rest == [order_col] else F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col))
    kept = df.groupBy(*[F.col(k) for k in keys]).agg(row.alias("__r"))

    def value(c):
        if c in shared:  # no row has an ``order_col``: none is the first
            return F.when(F.col("__r").isNotNull(), F.col(c))
        return F.col("__r") if rest == [order_col] else F.col(f"__r.{c}")
    return kept.select(*[value(c).alias(c) for c in df.columns])


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """Distinct values of one column (partial aggregation)."""
    return df.select(col).distinct()


def drop_cols(df: DataFrame, *cols: str) -> DataFrame:
    """P4."""
    return df.drop(*cols)


def drop_all_null_rows(df: DataFrame) -> DataFrame:
    """Drop rows where every column is null."""
    return df.na.drop(how="all")


def add_prefix(df: DataFrame, prefix: str, cols=None) -> DataFrame:
    """Prefix column names."""
    cols = list(cols or df.columns)
    return df.withColumnsRenamed({c: prefix + c for c in cols})


def recode(df: DataFrame, col: str, mapping: dict, out: str | None = None,
           keep_unmapped: bool = True) -> DataFrame:
    """Map values through a fixed dictionary (a literal map expression:
    no join, no shuffle)."""
    m = F.create_map(*[x for k, v in mapping.items() for x in (F.lit(k), F.lit(v))])
    val = m[F.col(col)]
    if keep_unmapped:
        val = F.coalesce(val, F.col(col).cast("string"))
    return df.withColumn(out or col, val)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of numeric columns (schema filter, no job)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def select_numeric(df: DataFrame, keep=(), exclude=()) -> DataFrame:
    """Keep numeric columns (plus ``keep``)."""
    return df.select(*keep, *[c for c in numeric_columns(df, exclude) if c not in keep])


def apply_step(df: DataFrame, fn: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stateless table-level function as a pipeline step."""
    return df.transform(fn)


def clean_reviews(df: DataFrame, keys=("Summary", "Text", "Score"), break_repl: str = " ",
                  counts: bool = True) -> DataFrame:
    """The shared preamble: keep-first dedupe on ``keys`` (before any other
    change), ``<br />`` -> ``break_repl``, null -> '', and word counts."""
    keys = [k for k in keys if k in df.columns]
    out = dedupe_keep_first(df, keys) if keys else df
    for c in ("Summary", "Text"):
        if c in out.columns:
            out = out.withColumn(c, tx.fill_empty(tx.remove_breaks(c, break_repl)))
    if counts:
        if "Summary" in out.columns:
            out = out.withColumn("summary_count", tx.word_count("Summary"))
        if "Text" in out.columns:
            out = out.withColumn("text_count", tx.word_count("Text"))
        if "Summary" in out.columns and "Text" in out.columns:
            out = out.withColumn("all_words_count", F.col("summary_count") + F.col("text_count"))
    return out


def text_statistics(df: DataFrame) -> DataFrame:
    """The character-level feature pack for Summary and Text.

    Both the letter total (``all_letter_count``) and the capital total
    (``all_capital_char_count``) are kept.
    """
    s, t = "Summary", "Text"
    out = df.select(
        "*",
        tx.word_count(s).alias("summary_word_count"),
        tx.word_count(t).alias("text_word_count"),
        tx.letter_count(s).alias("summary_letter_count"),
        tx.letter_count(t).alias("text_letter_count"),
        tx.capital_count(s).alias("summary_capital_letter_count"),
        tx.capital_count(t).alias("text_capital_letter_count"),
        tx.space_count(s).alias("summary_whitespace_count"),
        tx.space_count(t).alias("text_whitespace_count"),
        tx.chars_per_word(s).alias("summary_chars_per_word"),
        tx.chars_per_word(t).alias("text_chars_per_word"),
        tx.words_per_sentence(s).alias("summary_words_per_sentence"),
        tx.words_per_sentence(t).alias("text_words_per_sentence"),
        tx.digit_count(s).alias("summary_digit_count"),
        tx.digit_count(t).alias("text_digit_count"),
    )
    return out.select(
        "*",
        (F.col("summary_word_count") + F.col("text_word_count")).alias("all_word_count"),
        (F.col("summary_letter_count") + F.col("text_letter_count")).alias("all_letter_count"),
        (F.col("summary_capital_letter_count") + F.col("text_capital_letter_count"))
        .alias("all_capital_char_count"),
        tx.ratio_or_zero("summary_capital_letter_count", "summary_letter_count")
        .alias("summary_capital_char_ratio"),
        tx.ratio_or_zero("text_capital_letter_count", "text_letter_count")
        .alias("text_capital_char_ratio"),
        (F.col("summary_whitespace_count") + F.col("text_whitespace_count"))
        .alias("all_whitespace_count"),
        (F.col("summary_digit_count") + F.col("text_digit_count")).alias("all_digit_count"),
    )
