"""Adapters from the data folder's tables to the review-shaped views.

The operators are written against the review schema
(Id, UserId, Time, HelpfulnessNumerator, HelpfulnessDenominator, Score,
Summary, Text); these views give rows in that schema from the given tables.
They only rename and project: every computation happens in the operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scorecast.functions.time import epoch_seconds
from scorecast.sources.tables import load_table


def reviews(spark: SparkSession, sf_dir: str, supervised: bool = False,
            with_lang: bool = False) -> DataFrame:
    """Id, Summary (first line of the text), Text [, Score].

    ``supervised=True`` inner-joins the labels (Score = quality). The join is
    a plain equi-join: AQE turns it into a broadcast join only when the
    runtime size of the labels side is under the broadcast threshold.
    """
    cols = ["doc_id", "text"] + (["lang"] if with_lang else [])
    docs = load_table(spark, sf_dir, "documents", *cols)
    out = docs.select(
        F.col("doc_id").alias("Id"),
        F.substring_index("text", "\n", 1).alias("Summary"),
        F.col("text").alias("Text"),
        *([F.col("lang")] if with_lang else []),
    )
    if supervised:
        labels = load_table(spark, sf_dir, "labels", "doc_id", "quality").select(
            F.col("doc_id").alias("Id"), F.col("quality").alias("Score"))
        out = out.join(labels, "Id", "inner")
    return out


def helpfulness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: Id, UserId, Time, HelpfulnessNumerator, HelpfulnessDenominator.

    Lines are pre-aggregated per order (map-side partial aggregation) before
    the join, so the join shuffles one small row per order instead of every
    line, and the aggregate's hash partitioning on the key is reused by the
    join on the lineitem side.
    """
    lines = (load_table(spark, sf_dir, "lineitem", "l_orderkey", "l_returnflag")
             .groupBy("l_orderkey")
             .agg(F.count(F.lit(1)).cast("int").alias("HelpfulnessDenominator"),
                  F.sum(F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
                  .cast("int").alias("HelpfulnessNumerator")))
    orders = load_table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .select(F.col("o_orderkey").alias("Id"),
                    F.col("o_custkey").alias("UserId"),
                    epoch_seconds("o_orderdate").alias("Time"),
                    F.coalesce("HelpfulnessNumerator", F.lit(0)).alias("HelpfulnessNumerator"),
                    F.coalesce("HelpfulnessDenominator", F.lit(0)).alias("HelpfulnessDenominator")))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time, UserId (supplier), Quantity, PriceCents (integer cents: exact sums)."""
    li = load_table(spark, sf_dir, "lineitem", "l_suppkey", "l_shipdate",
                    "l_quantity", "l_extendedprice")
    return li.select(
        epoch_seconds("l_shipdate").alias("Time"),
        F.col("l_suppkey").alias("UserId"),
        F.col("l_quantity").cast("long").alias("Quantity"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("PriceCents"),
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, UserId, Time, ts, EventType, Value from the event stream table."""
    ev = load_table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    return ev.select(F.col("event_id").alias("Id"), F.col("user_id").alias("UserId"),
                     epoch_seconds("ts").alias("Time"), "ts",
                     F.col("event_type").alias("EventType"), F.col("value").alias("Value"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Id, v (array<double>), label."""
    emb = load_table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return emb.select(F.col("vec_id").alias("Id"),
                      F.col("embedding").cast("array<double>").alias("v"), "label")
