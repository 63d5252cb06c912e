"""Registered queries of the training-data operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecast.llm.ann import nearest
from scorecast.llm.decontam import contaminated_pairs
from scorecast.llm.exact_dedup import exact_groups
from scorecast.llm.fill_in_middle import fill_in_middle
from scorecast.llm.licenses import scan_licenses
from scorecast.llm.line_dedup import line_dedup
from scorecast.llm.packing import best_fit_packing
from scorecast.llm.pii import BASE, find_pii, of_kinds, span_text
from scorecast.llm.simhash import simhash_groups
from scorecast.llm.spelling import spelling_forms
from scorecast.llm.suffix_dedup import suffix_dedup
from scorecast.llm.toxicity import toxicity_scores
from scorecast.llm.url_filter import filter_urls
from scorecast.sources.tables import load_table


def vocabulary(name: str) -> str:
    """Path of an installed public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


URL_RULES = [("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"),
             ("block", "net/es/"), ("block", "net/fr/")]


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url: the rule's, else the language models'."""
    out = filter_urls(load_table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)
    return out.select("page_id", "host", "path", "rule", "verdict", "llr", "p_block")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of 1024 tokens."""
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    return best_fit_packing(docs, vocabulary("byte_bpe_50k.json"), capacity=1024)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and digest of the base kinds,
    all spans, and the spans with their scores."""
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    found = find_pii(docs).select("doc_id", "pii")
    counts = [F.size(of_kinds(F.col("pii"), k)).cast("long").alias(f"n_{k}") for k in BASE]
    scored = F.transform("pii", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"),
                                                      F.format_number(s["score"], 2)))
    return found.select("doc_id", *counts, F.sha2(span_text(of_kinds(F.col("pii"), *BASE)), 256).alias("base_sha256"),
                        span_text(F.col("pii")).alias("spans"), F.array_join(scored, ",").alias("scored"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences recognised in every document that holds a known sentence."""
    return scan_licenses(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op5_ann_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every twentieth one by inner product."""
    vectors = load_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, F.col("id") % 20 == 0, k=20)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints and their components at 3 bits or fewer."""
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    return simhash_groups(docs, shingle=3, max_bits=3).drop("text_key")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item, with the item."""
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    return contaminated_pairs(docs, load_table(spark, sf_dir, "benchmark", "item_id", "text"))


def held_out(id_col: str) -> Column:
    """Rows of this remainder are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document, learned outside the held-out rows."""
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    labels = load_table(spark, sf_dir, "labels", "doc_id", "toxic")
    out = toxicity_scores(docs, labels, ~held_out("doc_id"))
    return out.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                      (F.col("score") >= 0.7).cast("int").alias("predicted"), "evidence")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of 50-byte strings that a smaller document holds are removed."""
    out = suffix_dedup(load_table(spark, sf_dir, "documents", "doc_id", "text"), length=50)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Common long lines dropped except in the largest document."""
    docs = load_table(spark, sf_dir, "documents", "doc_id", "text")
    out = line_dedup(docs, min_chars=20, min_docs=3)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the copy that stays, white space apart."""
    return exact_groups(load_table(spark, sf_dir, "documents", "doc_id", "text"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form, cuts and digests of output and restored text."""
    out = fill_in_middle(load_table(spark, sf_dir, "documents", "doc_id", "text"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of seven letters or more with their commoner form and root."""
    return spelling_forms(load_table(spark, sf_dir, "documents", "doc_id", "text"))


LINE_DEDUP_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), common AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
  SELECT l.doc_id, l.pos, l.line, c.key IS NOT NULL AND l.doc_id <> c.keeper AS gone
  FROM lines l LEFT JOIN common c ON l.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

EXACT_DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept,
       sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)
"""

FILL_IN_MIDDLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || doc_id::VARCHAR) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents
), k AS (
  SELECT *, len(u)::BIGINT AS n, ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM k
), s AS (
  SELECT *, array_to_string(u[1:lo], '') AS p, array_to_string(u[lo + 1:hi], '') AS m, array_to_string(u[hi + 1:], '') AS s FROM c
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM s
"""

QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_pii": op3_pii,
    "op4_license_scan": op4_license_scan,
    "op5_ann_search": op5_ann_search,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_exact_dedup": op11_exact_dedup,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES = {
    "op10_line_dedup": LINE_DEDUP_SQL,
    "op11_exact_dedup": EXACT_DEDUP_SQL,
    "op12_fill_in_middle": FILL_IN_MIDDLE_SQL,
}
