import corpus_pipeline

from scorecast.llm import queries
from scorecast.llm.decontam import contaminated_pairs
from scorecast.llm.line_dedup import line_dedup
from scorecast.llm.simhash import simhash_groups
from scorecast.llm.toxicity import toxicity_scores

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
                                                     "best_fit_packing"]


def test_each_stage_decides_on_what_is_left(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, SF)
        rows = out.collect()
        if name == "best_fit_packing":
            assert {r["doc_id"] for r in rows} == set(before)
            continue
        assert out.columns == docs.columns
        after = {r["doc_id"]: r["text"] for r in rows}
        assert len(rows) == len(after)
        if name == "toxicity":
            labels = spark.read.parquet(f"{SF}/labels.parquet")
            bad = {r["doc_id"] for r in toxicity_scores(docs, labels, ~queries.held_out("doc_id")).filter("score >= 0.7").collect()}
            assert set(after) == set(before) - bad
        elif name == "line_dedup":
            assert after == {r["doc_id"]: r["text"] for r in line_dedup(docs).collect()} and set(after) == set(before)
        elif name == "simhash_near_dedup":
            assert set(after) == {r["component_id"] for r in simhash_groups(docs).collect()}
        elif name == "benchmark_decontamination":
            leaks = {r["doc_id"] for r in contaminated_pairs(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
            assert set(after) == set(before) - leaks
        docs = spark.createDataFrame(rows, docs.schema)


def test_stages_on_awkward_tables(spark):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    empty = spark.createDataFrame([], schema)
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "", "en", "s", 0), (2, "word " * 3000, "en", None, 9),
                                 (2, "word " * 3000, "en", None, 9)], schema)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0
        out = stage(spark, odd, SF)
        assert out.count() >= 3
        if name != "best_fit_packing":
            assert out.columns == odd.columns
