"""A key is counted by documents, as the registered SQL does."""

from scorecast.llm import line_dedup as M

A, B = "a line of twenty code points", "another line of twenty code points"


def test_rows_of_one_id_are_one_document(spark):
    rows = [(5, f"{A}\n{B}"), (5, f"{A}\nx"), (3, f"{A}\n{B}"), (1, B)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted([(5, 0, f"{A}\n{B}"), (5, 0, f"{A}\nx"), (3, 1, A), (1, 1, "")])
    for batches in (1, 3):
        got = M.line_dedup(df, batches=batches).collect()
        assert sorted((r["doc_id"], r["n_dropped"], r["text"]) for r in got) == want
