"""Positions, interleaving and batches."""

import itertools

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpusloom.operators import batching as B
from corpusloom.operators import ordinal as O
from corpusloom.operators.interleave import first_exhausted, interleave, union_sources
from corpusloom.operators.metrics import best_checkpoint, every_n_steps, metric_rollup, retain_last_k


def test_ordinal_equals_row_number(spark):
    """A group with most rows is spread over several ranges; others share one, and one has no name."""
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 == 9, F.lit(None)).when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("g"), F.col("id") % 40)).alias("g"),
        (F.col("id") * 7919 % 5003).alias("v"),
    )
    got = O.ordinal(df, ["v"], ["g"], out="rn", ranges=9)
    wanted = df.withColumn("rn", F.row_number().over(Window.partitionBy("g").orderBy("v")).cast("bigint"))
    named = lambda rows: sorted((r["g"] or "", r["v"], r["rn"]) for r in rows)
    assert named(got.collect()) == named(wanted.collect())
    falling = O.ordinal(df, [F.desc("v")], out="rn", ranges=5).orderBy("rn").collect()
    assert [r["rn"] for r in falling] == list(range(1, 5001))
    assert [r["v"] for r in falling] == sorted((r["v"] for r in falling), reverse=True)


def test_ordinal_has_no_one_task_window(spark):
    text = O.ordinal(spark.range(100), ["id"])._jdf.queryExecution().toString()
    physical = text.split("== Physical Plan ==")[1]
    # What is summed in one task is one row per range, counted before.
    assert "HashAggregate" in physical.split("Window ")[1].split("Scan")[0]


def test_ordinal_of_nothing(spark):
    assert O.ordinal(spark.range(0), ["id"]).collect() == []
    assert O.ordinal(spark.range(0).withColumn("g", F.lit(1)), ["id"], ["g"]).collect() == []


def test_attach_ordinal_keeps_columns(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "id bigint, text string")
    got = O.attach_ordinal(df, ["id"], ["id"]).orderBy("pos").collect()
    assert [(r["id"], r["text"], r["pos"]) for r in got] == [(1, "a", 1), (2, "b", 2), (3, "c", 3)]


@pytest.mark.parametrize("n, rows", [(2, 2), (9, 5), (0, 5), (None, 5)])
def test_take_n(spark, n, rows):
    assert O.take_n(O.ordinal(spark.range(5), ["id"]), "pos", n).count() == rows


@pytest.mark.parametrize("n, rows", [(2, 2), (9, 5), (0, 5), (None, 5)])
def test_first_n(spark, n, rows):
    df = spark.createDataFrame([(i, f"t{i}") for i in (3, 1, 5, 2, 4)], "id bigint, text string")
    got = sorted((r["pos"], r["id"], r["text"]) for r in O.first_n(df, ["id"], n).collect())
    assert got == [(i, i, f"t{i}") for i in range(1, rows + 1)]


def test_best_checkpoint_is_retained(spark):
    df = spark.range(4000).selectExpr("id % 40 as run_id", "id as step", "rand(5) as value").cache()
    kept = {(r["run_id"], r["step"]) for r in retain_last_k(df).collect()}
    assert {(r["run_id"], r["step"]) for r in best_checkpoint(df).collect()} <= kept
    assert len(kept) == 120


def round_robin(sizes):
    """Pull a row from each source in turn, looking one row ahead; stop when one has no more."""
    streams = [iter(range(1, n + 1)) for n in sizes]
    ahead = [next(s, None) for s in streams]
    out, empty = [], False
    for k in itertools.cycle(range(len(sizes))):
        if empty:
            return out
        row, ahead[k] = ahead[k], next(streams[k], None)
        empty = ahead[k] is None
        if row is not None:
            out.append((k, row))


def test_stopping_point_for_all_small_sizes():
    for sizes in itertools.product(range(5), repeat=3):
        row, source = first_exhausted(sizes)
        kept = [
            (k, j) for j in range(1, 6) for k in range(3) if j <= sizes[k] and (j, k) <= (row, source)
        ]
        assert kept == round_robin(sizes), sizes


@pytest.mark.parametrize("sizes", [(3, 2), (2, 3), (3, 3, 3), (1, 5), (2, 0, 4), (0, 3), (4,)])
def test_interleave(spark, sizes):
    sources = [
        spark.range(n).select((F.col("id") * 3 + 100 * k).alias("id"), F.lit(f"s{k}").alias("name"))
        for k, n in enumerate(sizes)
    ]
    got = interleave(sources, "id").orderBy("pos").collect()
    wanted = round_robin(sizes) if len(sizes) > 1 else [(0, j) for j in range(1, sizes[0] + 1)]
    assert [(r["k"], r["rn"]) for r in got] == wanted
    assert [r["pos"] for r in got] == [(j - 1) * len(sizes) + k + 1 for k, j in wanted]
    assert [r["id"] for r in got] == [(j - 1) * 3 + 100 * k for k, j in wanted]


def test_union_keeps_columns_of_all_sources(spark):
    a, b = spark.createDataFrame([(1, "x")], "id int, text string"), spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in union_sources([a, b]).orderBy("k").collect()] == [(1, "x", 0), (2, None, 1)]
    with pytest.raises(ValueError):
        union_sources([])


def test_batches_are_not_refilled(spark):
    df = B.assign_batches(spark.range(1, 11).withColumnRenamed("id", "pos"), "pos", 4)
    report = B.batch_report(df, ~F.col("pos").isin(2, 5, 6, 7, 8)).orderBy("batch_id").collect()
    assert [(r["n_rows"], r["n_valid"], r["is_empty"]) for r in report] == [(4, 3, False), (4, 0, True), (2, 2, False)]


def test_steps(spark):
    df = spark.range(1, 41).withColumnRenamed("id", "pos")
    assert B.assign_steps(df, "pos", 4, 4).groupBy("step").count().orderBy("step").collect() == [(1, 16), (2, 16), (3, 8)]
    assert B.assign_steps(df, "pos", 4, 4, max_steps=2).count() == 32


def test_rollup_logs_first_and_every_nth(spark):
    df = spark.createDataFrame([("r", s, float(s)) for s in range(1, 46)], "run_id string, step bigint, value double")
    got = {r["step"]: r["value"] for r in metric_rollup(df).collect()}
    assert got == {1: 1.0, 20: sum(range(2, 21)) / 19, 40: sum(range(21, 41)) / 20}
    odd = df.withColumn("value", F.when(F.col("step") == 5, F.lit(float("nan"))).otherwise(F.col("value")))
    values = {r["step"]: r["value"] for r in metric_rollup(odd).collect()}
    assert values[20] != values[20] and values[40] == got[40]


def test_checkpoints(spark):
    rows = [("a", 1, 0.5), ("a", 2, 0.25), ("a", 3, 0.25), ("a", 4, 0.9), ("b", 7, 1.0)]
    df = spark.createDataFrame(rows, "run_id string, step bigint, value double")
    assert sorted(map(tuple, best_checkpoint(df).collect())) == [("a", 2, 0.25), ("b", 7, 1.0)]
    assert sorted(map(tuple, best_checkpoint(df, greater_is_better=True).collect())) == [("a", 4, 0.9), ("b", 7, 1.0)]
    assert sorted(r["step"] for r in retain_last_k(df).collect()) == [2, 3, 4, 7]
    assert sorted(r["step"] for r in retain_last_k(df, k=2).collect()) == [2, 4, 7]
    assert sorted(r["step"] for r in retain_last_k(df, k=1, greater_is_better=True).collect()) == [4, 7]
    assert [r["step"] for r in every_n_steps(spark.range(0, 1501, 250).withColumnRenamed("id", "step")).collect()] == [500, 1000, 1500]


def test_batch_first_and_udf(spark):
    df = B.assign_batches(spark.range(1, 8).withColumnRenamed("id", "pos"), "pos", 3)
    got = B.batch_first(df, "pos", "pos", "first").orderBy("pos").collect()
    assert [r["first"] for r in got] == [1, 1, 1, 4, 4, 4, 7]
    sums = B.collate_udf(df, lambda b: b.groupby("batch_id", as_index=False)["pos"].sum(), "batch_id bigint, pos bigint")
    assert sorted(map(tuple, sums.collect())) == [(0, 6), (1, 15), (2, 7)]
