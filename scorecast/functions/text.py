"""Column expressions for review text: cleaning, statistics, tokens, n-grams.

Everything here is a native Spark expression (whole-stage codegen, no Python
per row). Regex classes are written so Java's engine matches Python 3's
Unicode-aware behaviour on the cases that matter: ``[\\p{L}\\p{N}_]`` for
``\\w`` and ``\\p{Nd}`` for ``\\d``.
"""

from __future__ import annotations

import os
from functools import lru_cache

import pandas as pd

from pyspark.sql import Column
from pyspark.sql import functions as F

# The line-break marker in review text and the ASCII punctuation
# set deleted before word frequencies (Python's string.punctuation).
LINE_BREAK = "<br />"
ASCII_PUNCT = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

WORD_CHAR = r"[\p{L}\p{N}_]"
NON_WORD = r"[^\p{L}\p{N}_\s]"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


@lru_cache(maxsize=1)
def english_stop_words() -> tuple[str, ...]:
    path = os.path.join(os.path.dirname(__file__), "stopwords_en.txt")
    with open(path, encoding="utf-8") as fh:
        return tuple(w.strip() for w in fh if w.strip() and not w.startswith("#"))


# ---- F1-F4: cleaning -------------------------------------------------------
def lower(c) -> Column:
    """F1."""
    return F.lower(_c(c))


def remove_breaks(c, repl: str = " ") -> Column:
    """literal ``<br />`` -> ``repl`` (' ' in model scripts, '' in topic EDA)."""
    return F.replace(_c(c), F.lit(LINE_BREAK), F.lit(repl))


def strip_non_word(c) -> Column:
    """delete characters that are neither word characters nor whitespace."""
    return F.regexp_replace(_c(c), NON_WORD, "")


def delete_ascii_punct(c) -> Column:
    """delete the fixed ASCII punctuation set."""
    return F.translate(_c(c), ASCII_PUNCT, "")


def fill_empty(c) -> Column:
    """Null text -> ''."""
    return F.coalesce(_c(c), F.lit(""))


# ---- F5-F12: statistics ------------------------------------------------------
def word_count(c) -> Column:
    """whitespace-separated words (empty pieces dropped)."""
    return F.size(F.filter(F.split(_c(c), r"\s+"), lambda x: x != "")).cast("long")


def regex_count(c, pattern: str) -> Column:
    return F.regexp_count(_c(c), F.lit(pattern)).cast("long")


def letter_count(c) -> Column:
    """matches of the class ``[aA-zZ]`` (the range A-z, which also
    includes ``[ \\ ] ^ _`` and the backtick) - kept as the reference wrote it."""
    return regex_count(c, "[aA-zZ]")


def capital_count(c) -> Column:
    """F7."""
    return regex_count(c, "[A-Z]")


def digit_count(c) -> Column:
    """Unicode decimal digits."""
    return regex_count(c, r"\p{Nd}")


def char_count(c, ch: str) -> Column:
    return (F.length(_c(c)) - F.length(F.replace(_c(c), F.lit(ch), F.lit("")))).cast("long")


def space_count(c) -> Column:
    """count of ' ' characters."""
    return char_count(c, " ")


def safe_ratio(a, b) -> Column:
    """A / b, null when b is 0 (no ANSI divide-by-zero error)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def ratio_or_zero(a, b) -> Column:
    """F8: a / b with 0 where undefined."""
    return F.coalesce(safe_ratio(a, b), F.lit(0.0))


def chars_per_word(c) -> Column:
    """length / (spaces + 1)."""
    return F.length(_c(c)).cast("double") / (space_count(c) + 1).cast("double")


def words_per_sentence(c) -> Column:
    """spaces / (periods + 1)."""
    return space_count(c).cast("double") / (char_count(c, ".") + 1).cast("double")


# ---- T1-T3: tokens and n-grams ----------------------------------------------
def tokens(c, min_len: int = 2, to_lower: bool = True) -> Column:
    """Word tokens; ``min_len=2`` is the vectoriser default ``\\b\\w\\w+\\b``,
    ``min_len=1`` the plain ``\\w+`` tokenizer."""
    x = F.lower(_c(c)) if to_lower else _c(c)
    pat = WORD_CHAR + ("+" if min_len <= 1 else "{%d,}" % min_len)
    return F.regexp_extract_all(x, F.lit(pat), F.lit(0))


def remove_stop_words(toks, words=None) -> Column:
    """Drop tokens in the stop list (default: Spark's English list)."""
    words = list(english_stop_words() if words is None else words)
    # ``isin`` with a literal list becomes a hash-set lookup (InSet)
    return F.filter(_c(toks), lambda t: ~t.isin(words))


def _gram_fn(t: Column, n: int):
    # one-argument lambda: a second parameter would be bound to the element index
    def f(i):
        return F.array_join(F.slice(t, i + 1, n), " ")
    return f


def ngrams(toks, n_min: int = 1, n_max: int = 1) -> Column:
    """All n-grams for n in [n_min, n_max], space-joined, in document order
    by n then position (one array; no row explosion). ``toks`` should be a
    column reference (see ``with_ngrams``) so the tokenizer runs once per row."""
    t = _c(toks)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        grams = F.transform(F.sequence(F.lit(0), F.size(t) - n), _gram_fn(t, n))
        parts.append(F.when(F.size(t) >= n, grams).otherwise(F.array().cast("array<string>")))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def python_word_tokenizer(min_len: int = 2):
    """A user tokenizer as an Arrow-batched pandas UDF (Python's
    Unicode ``\\w``, lowercase, tokens of ``min_len``+ characters) - the
    escape hatch for tokenizers with no JVM equivalent. Returns a function
    Column -> array<string> usable wherever a tokenizer is accepted."""
    pattern = r"(?u)\b\w{%d,}\b" % max(1, min_len)

    @F.pandas_udf("array<string>")
    def _tok(s: pd.Series) -> pd.Series:
        import re
        rx = re.compile(pattern)
        return s.fillna("").str.lower().map(rx.findall)

    return lambda c: _tok(_c(c))
