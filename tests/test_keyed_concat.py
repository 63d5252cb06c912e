"""Side-by-side columns, proved one row per key on both sides."""

import pytest

from scorecast.operators.joins import concat_by_key, key_faults


def _tables(spark, left, right):
    return spark.createDataFrame(left, "Id long, a string"), spark.createDataFrame(right, "Id long, b string")


def test_one_to_one(spark):
    l, r = _tables(spark, [(1, "x"), (2, None)], [(2, "y"), (1, "z")])
    assert {tuple(x) for x in concat_by_key(l, r, "Id").collect()} == {(1, "x", "z"), (2, None, "y")}
    assert key_faults(l, r, "Id").isEmpty()


def test_missing_doubled_and_null_keys(spark):
    l, r = _tables(spark, [(1, "x"), (2, "p"), (2, "q"), (3, "s"), (None, "n")], [(1, "y"), (2, "z"), (4, "t"), (4, "u"), (None, "m")])
    assert {tuple(x) for x in key_faults(l, r, "Id").collect()} == {(2, 2, 1), (3, 1, 0), (4, 0, 2), (None, 1, 1)}
    assert [tuple(x) for x in concat_by_key(l, r, "Id", strict=False).collect()] == [(1, "x", "y")]
    with pytest.raises(ValueError, match=r"2 \(2, 1\)"):
        concat_by_key(l, r, "Id")


def test_clashing_columns_and_empty_tables(spark):
    l, r = _tables(spark, [], [])
    assert concat_by_key(l, r, "Id").count() == 0
    with pytest.raises(ValueError, match="a"):
        concat_by_key(l, r.withColumnRenamed("b", "A"), "Id")
