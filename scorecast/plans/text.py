"""Cleaning, text statistics, tokens, vocabularies, TF-IDF, hashing,
word frequencies, splits, samples and tag counts on the review view."""

from __future__ import annotations

from pyspark.sql import functions as F

from scorecast.functions import text as tx
from scorecast.operators import clean as cl
from scorecast.operators import split as sp
from scorecast.operators import text_features as tf
from scorecast.plans.sqlviews import LABELLED, REVIEWS, with_
from scorecast.sources.views import reviews

SEED = 44
STATS = [
    "summary_word_count", "text_word_count", "summary_letter_count", "text_letter_count",
    "summary_capital_letter_count", "text_capital_letter_count", "summary_whitespace_count",
    "text_whitespace_count", "summary_chars_per_word", "text_chars_per_word",
    "summary_words_per_sentence", "text_words_per_sentence", "summary_digit_count",
    "text_digit_count", "all_word_count", "all_letter_count", "all_capital_char_count",
    "summary_capital_char_ratio", "text_capital_char_ratio", "all_whitespace_count",
    "all_digit_count",
]

# ---- SQL building blocks (DuckDB) -----------------------------------------
_NONWORD = r"[^\p{L}\p{N}_\s]"
_W2 = r"[\p{L}\p{N}_]{2,}"
_W1 = r"[\p{L}\p{N}_]+"


def _sql_str_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


def _sql_hash(key: str, seed=SEED) -> str:
    return (f"CAST(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 15)) "
            f"AS UBIGINT) AS BIGINT)")


def _sql_ngrams(t: str, n_max: int) -> str:
    parts = [t]
    for n in range(2, n_max + 1):
        parts.append(f"CASE WHEN len({t}) >= {n} THEN list_transform(range(0, len({t}) - {n - 1}), "
                     f"lambda i: array_to_string({t}[i + 1:i + {n}], ' ')) ELSE [] END")
    return parts[0] if len(parts) == 1 else "list_concat(" + ", ".join(parts) + ")"


def _sql_word_count(c: str) -> str:
    return f"CAST(len(list_filter(regexp_split_to_array({c}, '\\s+'), lambda x: x <> '')) AS BIGINT)"


def _sql_split(src: str, frac: float, seed=SEED) -> str:
    return f"""
split_src AS (SELECT *, {_sql_hash('Id', seed)} AS h FROM {src}),
split_rank AS (SELECT *, row_number() OVER (PARTITION BY Score ORDER BY h, Id) AS rn,
                      count(*) OVER (PARTITION BY Score) AS ns FROM split_src),
split AS (SELECT * EXCLUDE (h, rn, ns),
                 CASE WHEN rn <= floor({frac} * ns) THEN 'train' ELSE 'test' END AS split
          FROM split_rank)"""


# ---- P1 ----------------------------------------------------------------------
def p1_dedupe_keep_first(spark, sf_dir):
    """Keep the first (smallest Id) row of each distinct (Summary, Text)."""
    return cl.dedupe_keep_first(reviews(spark, sf_dir), ["Summary", "Text"])


_P1_SQL = with_(REVIEWS) + """
SELECT Id, Summary, Text FROM (
  SELECT *, row_number() OVER (PARTITION BY Summary, Text ORDER BY Id) AS rn FROM reviews)
WHERE rn = 1
"""


# ---- preamble + F5 -------------------------------------------------------------
def f5_clean_word_counts(spark, sf_dir):
    """P1 + F2 + P3 + F5 + P4: dedupe (Summary, Text, Score), line breaks to
    spaces, nulls to '', word counts; text columns dropped."""
    r = cl.clean_reviews(reviews(spark, sf_dir, supervised=True))
    return cl.drop_cols(r, "Summary", "Text")


_F5_SQL = with_(LABELLED, """
d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY Summary, Text, Score ORDER BY Id) AS rn
                     FROM labelled) WHERE rn = 1),
c AS (SELECT Id, Score, coalesce(replace(Summary, '<br />', ' '), '') AS Summary,
             coalesce(replace(Text, '<br />', ' '), '') AS Text FROM d)
""") + f"""
SELECT Id, Score, {_sql_word_count('Summary')} AS summary_count,
       {_sql_word_count('Text')} AS text_count,
       {_sql_word_count('Summary')} + {_sql_word_count('Text')} AS all_words_count
FROM c
"""


# ---- F6-F12 --------------------------------------------------------------------
def f6_text_statistics(spark, sf_dir):
    """Words, letters, capitals, spaces, digits, ratios per review."""
    return cl.text_statistics(reviews(spark, sf_dir)).drop("Summary", "Text")


def _sql_cnt(c, pat):
    return f"CAST(len(regexp_extract_all({c}, '{pat}')) AS BIGINT)"


def _sql_chr(c, ch):
    return f"CAST(length({c}) - length(replace({c}, '{ch}', '')) AS BIGINT)"


def _stats_sql():
    s, t = "Summary", "Text"
    base = {
        "summary_word_count": _sql_word_count(s), "text_word_count": _sql_word_count(t),
        "summary_letter_count": _sql_cnt(s, "[aA-zZ]"), "text_letter_count": _sql_cnt(t, "[aA-zZ]"),
        "summary_capital_letter_count": _sql_cnt(s, "[A-Z]"),
        "text_capital_letter_count": _sql_cnt(t, "[A-Z]"),
        "summary_whitespace_count": _sql_chr(s, " "), "text_whitespace_count": _sql_chr(t, " "),
        "summary_chars_per_word": f"CAST(length({s}) AS DOUBLE) / ({_sql_chr(s, ' ')} + 1)",
        "text_chars_per_word": f"CAST(length({t}) AS DOUBLE) / ({_sql_chr(t, ' ')} + 1)",
        "summary_words_per_sentence": f"CAST({_sql_chr(s, ' ')} AS DOUBLE) / ({_sql_chr(s, '.')} + 1)",
        "text_words_per_sentence": f"CAST({_sql_chr(t, ' ')} AS DOUBLE) / ({_sql_chr(t, '.')} + 1)",
        "summary_digit_count": _sql_cnt(s, r"\p{Nd}"), "text_digit_count": _sql_cnt(t, r"\p{Nd}"),
    }
    inner = ",\n  ".join(f"{v} AS {k}" for k, v in base.items())
    return with_(REVIEWS) + f"""
, b AS (SELECT Id, {inner} FROM reviews)
SELECT *, summary_word_count + text_word_count AS all_word_count,
  summary_letter_count + text_letter_count AS all_letter_count,
  summary_capital_letter_count + text_capital_letter_count AS all_capital_char_count,
  coalesce(CASE WHEN summary_letter_count = 0 THEN NULL
                ELSE summary_capital_letter_count / summary_letter_count END, 0.0) AS summary_capital_char_ratio,
  coalesce(CASE WHEN text_letter_count = 0 THEN NULL
                ELSE text_capital_letter_count / text_letter_count END, 0.0) AS text_capital_char_ratio,
  summary_whitespace_count + text_whitespace_count AS all_whitespace_count,
  summary_digit_count + text_digit_count AS all_digit_count
FROM b
"""


# ---- F1-F3: topic-text cleaning with A12 -----------------------------------
def f3_topic_text_clean(spark, sf_dir):
    """A12 + F1 + F2 + F3: distinct texts (first Id kept), lowercase,
    ``<br />`` removed, non-word characters deleted."""
    r = cl.dedupe_keep_first(reviews(spark, sf_dir).select("Id", "Text"), ["Text"])
    return r.select("Id", tx.strip_non_word(tx.remove_breaks(tx.lower("Text"), ""))
                    .alias("text_clean"))


_F3_SQL = with_(REVIEWS) + f"""
SELECT Id, regexp_replace(replace(lower(Text), '<br />', ''), '{_NONWORD}', '', 'g') AS text_clean
FROM (SELECT *, row_number() OVER (PARTITION BY Text ORDER BY Id) AS rn FROM reviews) WHERE rn = 1
"""


def f4_summary_punct(spark, sf_dir):
    """F1 + F4: lowercase summary with ASCII punctuation deleted."""
    r = reviews(spark, sf_dir)
    return r.select("Id", tx.delete_ascii_punct(tx.lower("Summary")).alias("summary_clean"))


def _sql_punct_translate(c):
    p = tx.ASCII_PUNCT.replace("'", "''")
    return f"translate({c}, '{p}', '')"


_F4_SQL = with_(REVIEWS) + f"""
SELECT Id, {_sql_punct_translate('lower(Summary)')} AS summary_clean FROM reviews
"""


def a12_distinct_texts(spark, sf_dir):
    """Distinct review texts."""
    return cl.distinct_values(reviews(spark, sf_dir), "Text")


_A12_SQL = with_(REVIEWS) + "SELECT DISTINCT Text FROM reviews"


# ---- T1-T3 ------------------------------------------------------------------
def t1_word_tokens(spark, sf_dir):
    """``\\w+`` tokens of the lowercased summary, counted per review."""
    r = reviews(spark, sf_dir)
    return tf.doc_terms(r, tx.tokens("Summary", 1))


_T1_SQL = with_(REVIEWS) + f"""
SELECT Id, term, count(*) AS tf
FROM (SELECT Id, unnest(regexp_extract_all(lower(Summary), '{_W1}')) AS term FROM reviews)
GROUP BY 1, 2
"""


def t2_stop_words_removed(spark, sf_dir):
    """T1 + T2: text tokens with the English stop words removed, per-review counts."""
    r = reviews(spark, sf_dir)
    return tf.doc_terms(r, tx.remove_stop_words(tx.tokens("Text", 1)))


def _t2_sql():
    sw = _sql_str_list(tx.english_stop_words())
    return with_(REVIEWS) + f"""
SELECT Id, term, count(*) AS tf
FROM (SELECT Id, unnest(regexp_extract_all(lower(Text), '{_W1}')) AS term FROM reviews)
WHERE NOT list_contains({sw}, term)
GROUP BY 1, 2
"""


def t3_ngrams_text(spark, sf_dir):
    """1- to 3-grams of 2+ character tokens of the text, per-review counts."""
    r = reviews(spark, sf_dir)
    return tf.ngram_doc_terms(r, tx.tokens("Text", 2), 1, 3)


_T3_SQL = with_(REVIEWS) + f"""
, t AS (SELECT Id, regexp_extract_all(lower(Text), '{_W2}') AS t FROM reviews)
SELECT Id, term, count(*) AS tf FROM (SELECT Id, unnest({_sql_ngrams('t', 3)}) AS term FROM t)
GROUP BY 1, 2
"""


# ---- T4: vocabulary fitted on train, applied to test ------------------------
def t4_dtm_summary(spark, sf_dir):
    """M1 + T4: 1-3-gram count vectoriser on summaries, vocabulary fitted on the
    train half (min_df = 0.0005 of train documents), applied to the test half."""
    lab = sp.stratified_split(reviews(spark, sf_dir, supervised=True), "Score", 0.5, SEED)
    train = lab.where(F.col("split") == "train")
    test = lab.where(F.col("split") == "test")
    _, counts = tf.count_vectorize(train, test, "Summary", 1, 3, min_df=0.0005)
    return counts


_T4_SQL = with_(LABELLED, _sql_split("labelled", 0.5)) + f"""
, toks AS (SELECT Id, split, regexp_extract_all(lower(Summary), '{_W2}') AS t FROM split),
grams AS (SELECT Id, split, unnest({_sql_ngrams('t', 3)}) AS term FROM toks),
dt AS (SELECT Id, split, term, count(*) AS tf FROM grams GROUP BY 1, 2, 3),
ntrain AS (SELECT count(*) AS n FROM split WHERE split = 'train'),
vocab AS (SELECT term FROM dt WHERE split = 'train' GROUP BY term
          HAVING count(*) >= 0.0005 * (SELECT n FROM ntrain))
SELECT term, Id, tf FROM dt WHERE split = 'test' AND term IN (SELECT term FROM vocab)
"""


# ---- T5: TF-IDF -----------------------------------------------------------------
def t5_tfidf(spark, sf_dir):
    """F3 + T2 + T5: distinct cleaned texts, English stop words removed,
    min_df = 5 documents, smooth idf, L2-normalised rows (rounded to 9 places)."""
    txt = tf.written(f3_topic_text_clean(spark, sf_dir), "clean-texts")
    n = txt.count()
    dt = tf.doc_terms(txt, tx.remove_stop_words(tx.tokens("text_clean", 2)))
    vocab = tf.fit_vocabulary(dt, n, min_df=5)
    return tf.tfidf(tf.apply_vocabulary(dt, vocab), vocab, n)


def _t5_sql():
    sw = _sql_str_list(tx.english_stop_words())
    return with_(REVIEWS) + f"""
, d AS (SELECT Id, regexp_replace(replace(lower(Text), '<br />', ''), '{_NONWORD}', '', 'g') AS t
        FROM (SELECT *, row_number() OVER (PARTITION BY Text ORDER BY Id) AS rn FROM reviews)
        WHERE rn = 1),
n AS (SELECT count(*) AS n FROM d),
dt AS (SELECT Id, term, count(*) AS tf
       FROM (SELECT Id, unnest(regexp_extract_all(t, '{_W2}')) AS term FROM d)
       WHERE NOT list_contains({sw}, term) GROUP BY 1, 2),
v AS (SELECT term, count(*) AS df FROM dt GROUP BY 1 HAVING count(*) >= 5),
w AS (SELECT Id, term, tf * (ln((1.0 + (SELECT n FROM n)) / (df + 1.0)) + 1.0) AS w
      FROM dt JOIN v USING (term))
SELECT Id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY Id)), 9) AS tfidf FROM w
"""


# ---- T6: hashing ------------------------------------------------------------------
def t6_hashed_ngrams(spark, sf_dir):
    """T1 + T3 + T6: summary 1-3-grams hashed into 2^20 signed buckets, L2 norm."""
    r = reviews(spark, sf_dir)
    return tf.hashed_features(r, tx.tokens("Summary", 2), 1, 3, 1 << 20)


_T6_SQL = with_(REVIEWS) + f"""
, t AS (SELECT Id, regexp_extract_all(lower(Summary), '{_W2}') AS t FROM reviews),
g AS (SELECT Id, unnest({_sql_ngrams('t', 3)}) AS term FROM t),
b AS (SELECT Id, CAST(CAST(('0x' || substr(md5(term), 1, 8)) AS UBIGINT) % 1048576 AS BIGINT) AS bucket,
             CAST(sum(CASE WHEN CAST(('0x' || substr(md5(term), 9, 1)) AS INTEGER) < 8 THEN 1 ELSE -1 END)
                  AS DOUBLE) AS v
      FROM g GROUP BY 1, 2),
o AS (SELECT Id, bucket, round(v / sqrt(sum(v * v) OVER (PARTITION BY Id)), 9) AS value FROM b)
SELECT * FROM o WHERE value <> 0
"""


# ---- A8: word frequencies -----------------------------------------------------------
def a8_word_frequencies(spark, sf_dir):
    """Top 1000 words of all texts (ASCII punctuation deleted, stop words
    and 'br' removed) with weight relative to the most frequent."""
    return tf.word_frequencies(reviews(spark, sf_dir), "Text", 1000, extra_stop=["br"])


def _a8_sql():
    sw = _sql_str_list(list(tx.english_stop_words()) + ["br"])
    return with_(REVIEWS) + f"""
, c AS (SELECT term, count(*) AS n
        FROM (SELECT unnest(regexp_extract_all({_sql_punct_translate('lower(Text)')}, '{_W2}')) AS term
              FROM reviews)
        WHERE NOT list_contains({sw}, term) GROUP BY 1),
t AS (SELECT * FROM c ORDER BY n DESC, term LIMIT 1000)
SELECT term, n, n / max(n) OVER () AS weight FROM t
"""


# ---- M1 / M2 / S4 / S5: splits, folds, samples ------------------------------------
def m1_stratified_split(spark, sf_dir):
    """M1: exact stratified 50/50 split by hash rank (seed 44)."""
    lab = reviews(spark, sf_dir, supervised=True).select("Id", "Score")
    return sp.stratified_split(lab, "Score", 0.5, SEED)


_M1_SQL = with_(LABELLED, _sql_split("labelled", 0.5)) + "SELECT Id, Score, split FROM split"


def m2_stratified_folds(spark, sf_dir):
    """M2: 5 stratified folds by hash rank (seed 44)."""
    lab = reviews(spark, sf_dir, supervised=True).select("Id", "Score")
    return sp.stratified_folds(lab, "Score", 5, SEED)


def _m2_sql(k=5):
    terms = " + ".join(f"CAST(rn > ({j} * ns) // {k} AS INTEGER)" for j in range(1, k))
    return with_(LABELLED) + f"""
, s AS (SELECT Id, Score, {_sql_hash('Id')} AS h FROM labelled),
r AS (SELECT *, row_number() OVER (PARTITION BY Score ORDER BY h, Id) AS rn,
             count(*) OVER (PARTITION BY Score) AS ns FROM s)
SELECT Id, Score, CAST({terms} AS INTEGER) AS fold FROM r
"""


def s4_exact_sample(spark, sf_dir):
    """Exactly 100 reviews chosen uniformly by hash rank."""
    return sp.exact_sample(reviews(spark, sf_dir).select("Id", "Summary"), 100, SEED)


_S4_SQL = with_(REVIEWS) + f"""
SELECT Id, Summary FROM reviews ORDER BY {_sql_hash('Id')}, Id LIMIT 100
"""


def s5_sample_train_ids(spark, sf_dir):
    """M1 + S5: 80% stratified train ids, then exactly 100 of them sampled."""
    lab = reviews(spark, sf_dir, supervised=True).select("Id", "Score")
    train = sp.stratified_split(lab, "Score", 0.8, SEED).where(F.col("split") == "train")
    return sp.exact_sample(train.select("Id"), 100, seed=7)


_S5_SQL = with_(LABELLED, _sql_split("labelled", 0.8)) + f"""
SELECT Id FROM split WHERE split = 'train' ORDER BY {_sql_hash('Id', 7)}, Id LIMIT 100
"""


def s6_row_count(spark, sf_dir):
    """Row count of the review table."""
    return reviews(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"))


_S6_SQL = "SELECT count(*) AS n_rows FROM documents"


# ---- T8 / T9 / A6 / U2 / P13 ---------------------------------------------------------
def t8_tag_counts_aligned(spark, sf_dir):
    """M1 + T8 + A6 + U2: token-shape tags of summaries, tag vocabulary from
    the train half, counts of every vocabulary tag (zeros included) for every
    train and test row, in long form."""
    lab = sp.stratified_split(reviews(spark, sf_dir, supervised=True), "Score", 0.5, SEED)
    tagged = lab.select("Id", "split", tf.shape_tagger("Summary").alias("tags"))
    vocab = tagged.where(F.col("split") == "train").select(F.explode("tags").alias("tag")).distinct()
    classes = [name for name, _ in tf.SHAPE_TAGS] + ["OTHER"]
    return tf.tag_counts_long(tagged, "tags", classes, vocab, ("Id", "split")).select("Id", "split", "tag", "n")


def _t8_sql():
    sw = _sql_str_list(tx.english_stop_words())
    case = "CASE " + " ".join(
        f"WHEN regexp_matches(x, '{p}') THEN '{n}'" for n, p in tf.SHAPE_TAGS) + " ELSE 'OTHER' END"
    return with_(LABELLED, _sql_split("labelled", 0.5)) + f"""
, tk AS (SELECT Id, split, list_filter(regexp_extract_all(Summary, '{_W1}'),
                                       lambda x: NOT list_contains({sw}, lower(x))) AS t FROM split),
tg AS (SELECT Id, split, list_transform(t, lambda x: {case}) AS tags FROM tk),
vocab AS (SELECT DISTINCT unnest(tags) AS tag FROM tg WHERE split = 'train')
SELECT tg.Id, tg.split, vocab.tag, CAST(len(list_filter(tg.tags, lambda x: x = vocab.tag)) AS BIGINT) AS n
FROM tg CROSS JOIN vocab
"""


def t9_entity_counts(spark, sf_dir):
    """Per-review counts of entity patterns in the text (wide columns)."""
    return tf.entity_counts(reviews(spark, sf_dir), "Text", "Text")


def _t9_sql():
    rest = "Text"
    cols = []
    for name, pat in tf.ENTITY_PATTERNS:
        p = pat.replace("'", "''")
        cols.append(f"CAST(len(regexp_extract_all({rest}, '{p}')) AS BIGINT) AS Text_{name}")
        rest = f"regexp_replace({rest}, '{p}', ' ', 'g')"
    return with_(REVIEWS) + "SELECT Id, " + ",\n  ".join(cols) + " FROM reviews"


def p17_numeric_step(spark, sf_dir):
    """P18 + P17: the statistics pack applied as a table step, then only the
    numeric columns kept (schema filter)."""
    r = cl.apply_step(reviews(spark, sf_dir), cl.text_statistics)
    return cl.select_numeric(r)


def t7_custom_tokenizer(spark, sf_dir):
    """T7 + X1: count vectoriser with a user-supplied tokenizer (a pandas UDF
    running Python's Unicode word tokenizer); summary unigram counts."""
    r = reviews(spark, sf_dir)
    tok = tx.python_word_tokenizer(2)
    return tf.ngram_doc_terms(r, tok("Summary"), 1, 1)


_T7_SQL = with_(REVIEWS) + f"""
SELECT Id, term, count(*) AS tf
FROM (SELECT Id, unnest(regexp_extract_all(lower(Summary), '{_W2}')) AS term FROM reviews)
GROUP BY 1, 2
"""


def p10_test_rows(spark, sf_dir):
    """M1 + P10: labelled reviews whose key is not among the train keys (anti join)."""
    from scorecast.operators.joins import drop_keys
    lab = reviews(spark, sf_dir, supervised=True).select("Id", "Score")
    train = sp.stratified_split(lab, "Score", 0.5, SEED).where(F.col("split") == "train")
    return drop_keys(lab, train, "Id")


_P10_SQL = with_(LABELLED, _sql_split("labelled", 0.5)) + """
SELECT Id, Score FROM labelled WHERE Id NOT IN (SELECT Id FROM split WHERE split = 'train')
"""


QUERIES = {
    "T7_custom_tokenizer": t7_custom_tokenizer,
    "P10_test_rows": p10_test_rows,
    "P1_dedupe_keep_first": p1_dedupe_keep_first,
    "F5_clean_word_counts": f5_clean_word_counts,
    "F6_text_statistics": f6_text_statistics,
    "F3_topic_text_clean": f3_topic_text_clean,
    "F4_summary_punct": f4_summary_punct,
    "A12_distinct_texts": a12_distinct_texts,
    "T1_word_tokens": t1_word_tokens,
    "T2_stop_words_removed": t2_stop_words_removed,
    "T3_ngrams_text": t3_ngrams_text,
    "T4_dtm_summary": t4_dtm_summary,
    "T5_tfidf": t5_tfidf,
    "T6_hashed_ngrams": t6_hashed_ngrams,
    "A8_word_frequencies": a8_word_frequencies,
    "M1_stratified_split": m1_stratified_split,
    "M2_stratified_folds": m2_stratified_folds,
    "S4_exact_sample": s4_exact_sample,
    "S5_sample_train_ids": s5_sample_train_ids,
    "S6_row_count": s6_row_count,
    "T8_tag_counts_aligned": t8_tag_counts_aligned,
    "T9_entity_counts": t9_entity_counts,
    "P17_numeric_step": p17_numeric_step,
}

ORACLES = {
    "T7_custom_tokenizer": _T7_SQL,
    "P10_test_rows": _P10_SQL,
    "P1_dedupe_keep_first": _P1_SQL,
    "F5_clean_word_counts": _F5_SQL,
    "F6_text_statistics": _stats_sql(),
    "F3_topic_text_clean": _F3_SQL,
    "F4_summary_punct": _F4_SQL,
    "A12_distinct_texts": _A12_SQL,
    "T1_word_tokens": _T1_SQL,
    "T2_stop_words_removed": _t2_sql(),
    "T3_ngrams_text": _T3_SQL,
    "T4_dtm_summary": _T4_SQL,
    "T5_tfidf": _t5_sql(),
    "T6_hashed_ngrams": _T6_SQL,
    "A8_word_frequencies": _a8_sql(),
    "M1_stratified_split": _M1_SQL,
    "M2_stratified_folds": _m2_sql(),
    "S4_exact_sample": _S4_SQL,
    "S5_sample_train_ids": _S5_SQL,
    "S6_row_count": _S6_SQL,
    "T8_tag_counts_aligned": _t8_sql(),
    "T9_entity_counts": _t9_sql(),
    "P17_numeric_step": _stats_sql().replace("SELECT Id, ", "SELECT Id, ", 1),
}
