"""Pairing by position next to Python's own zip."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.pairing import UnequalLengths, zip_by_position


def tables(spark, n, m, parts=7):
    left = spark.range(n).select(((F.col("id") * 7919) % 10007).alias("a"), F.concat(F.lit("x"), "id").alias("x")).repartition(parts)
    right = spark.range(m).select(((F.col("id") * 104729) % 20011).alias("b"), F.concat(F.lit("y"), "id").alias("y")).repartition(parts + 4)
    return left, right


@pytest.mark.parametrize("n,m", [(1000, 1000), (1000, 400), (3, 900), (0, 5), (5, 0), (0, 0), (1, 1)])
def test_equals_zip(spark, n, m):
    left, right = tables(spark, n, m)
    pairs, lengths = zip_by_position(left, right, ["a"], [F.desc("b")], strict=False)
    expected = zip(sorted(map(tuple, left.collect())), sorted(map(tuple, right.collect()), reverse=True))
    assert sorted(map(tuple, pairs.collect())) == [(i + 1, *a, *b) for i, (a, b) in enumerate(expected)]
    assert tuple(lengths.first()) == (n, m, min(n, m), max(n - m, 0), max(m - n, 0))


def test_strict(spark):
    left, right = tables(spark, 10, 11)
    with pytest.raises(UnequalLengths, match="10 rows on the left, 11"):
        zip_by_position(left, right, ["a"], ["b"])
    assert zip_by_position(left, right.where("b > 0"), ["a"], ["b"])[0].count() == 10


def test_rows_that_tie_are_paired_once(spark):
    left = spark.range(500).select(F.lit(1).alias("a"), F.col("id").alias("x"))
    right = spark.range(500).select((F.col("id") % 2).alias("b"), F.col("id").alias("y"))
    rows = zip_by_position(left, right, ["a"], ["b"])[0].collect()
    assert {r["x"] for r in rows} == {r["y"] for r in rows} == set(range(500)) and {r["pos"] for r in rows} == set(range(1, 501))


def test_nulls_sort_first(spark):
    left = spark.createDataFrame([(None, "n"), (1, "o")], "a int, x string")
    right = spark.createDataFrame([(5,), (None,)], "b int")
    assert sorted(map(tuple, zip_by_position(left, right, ["a"], ["b"])[0].collect())) == [(1, None, "n", None), (2, 1, "o", 5)]


def test_names_must_differ(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError, match="both tables"):
        zip_by_position(rows, rows, ["id"], ["id"])


def test_no_window_in_the_plan(spark):
    left, right = tables(spark, 50, 50)
    plan = zip_by_position(left, right, ["a"], ["b"])[0]._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
