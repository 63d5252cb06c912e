"""Corpus pipeline: stages over the ``documents`` table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scorecast.llm.common import written
from scorecast.llm.decontam import drop_contaminated
from scorecast.llm.line_dedup import line_dedup
from scorecast.llm.packing import best_fit_packing
from scorecast.llm.queries import held_out, vocabulary
from scorecast.llm.simhash import keep_one_per_group
from scorecast.llm.toxicity import drop_toxic
from scorecast.sources.tables import load_table


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxicity: documents with a score of 0.7 or more go."""
    return drop_toxic(docs, load_table(spark, sf_dir, "labels", "doc_id", "toxic"), ~held_out("doc_id"))


def drop_common_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: the text loses the lines found in three documents or more,
    except in the document with the largest id; every document stays."""
    return line_dedup(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash near-dedup: the smallest id of each group stays."""
    return keep_one_per_group(docs, shingle=3, max_bits=3)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a passage of a benchmark
    item go."""
    return drop_contaminated(docs, load_table(spark, sf_dir, "benchmark", "item_id", "text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of 1024 tokens."""
    return best_fit_packing(docs, vocabulary("byte_bpe_50k.json"), capacity=1024)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_common_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

# The fingerprints, the tokenizer and the scores have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written as Parquet and
    read again as the next stage's documents."""
    docs = load_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
