"""Growing tables and runs that go on."""

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.growing import append_positions, create_positions, read_positions
from corpusloom.operators.ordinal import ordinal
from corpusloom.plans.resume import Stage, manifests, orphans, run_stages


def test_appends_equal_numbering_all(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(0, 4000, 4).select(F.col("id").cast("string").alias("text"), (F.col("id") % 7).alias("a"), F.col("id").alias("b"))
    create_positions(rows, ["a", "b"], path)
    every = rows
    for low, high, step in ((1, 300, 4), (5000, 5100, 1), (2, 4000, 400), (-30, -10, 1)):
        new = spark.range(low, high, step).select(F.col("id").cast("string").alias("text"), (F.col("id") % 7).alias("a"), F.col("id").alias("b"))
        append_positions(new, ["a", "b"], path)
        every = every.unionByName(new)
        got = sorted(map(tuple, read_positions(spark, path, rows).collect()))
        assert got == sorted(map(tuple, ordinal(every, ["a", "b"]).collect()))


def test_untouched_ranges_stay(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(10_000).withColumnRenamed("id", "k")
    create_positions(rows, ["k"], path)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        create_positions(rows, ["k"], path + "2")
        entries = spark.read.parquet(path + "2/directory").count()
        # Beyond the end nothing is rewritten, in the middle one range is.
        assert append_positions(spark.range(20_000, 20_010).withColumnRenamed("id", "k"), ["k"], path + "2") == []
        assert entries > 1 and len(append_positions(spark.createDataFrame([(15_000,)], "k long"), ["k"], path + "2")) == 1
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert [r["pos"] for r in read_positions(spark, path + "2", rows).where("k in (0, 9999, 15000, 20009)").orderBy("k").collect()] == [1, 10_000, 10_001, 10_011]


def test_an_append_that_breaks_off_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(50).withColumnRenamed("id", "k")
    create_positions(rows, ["k"], path)
    bad = spark.range(50, 60).select(F.when(F.col("id") < 55, F.col("id")).otherwise(F.raise_error(F.lit("broken")).cast("long")).alias("k"))
    with pytest.raises(Exception, match="broken"):
        append_positions(bad, ["k"], path)
    assert read_positions(spark, path, rows).agg(F.max("pos")).first()[0] == 50


def test_runs_go_on(spark, tmp_path):
    source, path, ran = str(tmp_path / "in"), str(tmp_path / "run"), []
    spark.range(100).write.parquet(source)

    def stage(name, fn, **parameters):
        def run(df, **given):
            ran.append(name)
            return fn(df, **given)

        return Stage(name, run, parameters)

    even = stage("even", lambda df: df.where("id % 2 = 0"))
    broken = stage("few", lambda df, most: df.where(F.when(F.col("id") < 90, F.col("id") < most).otherwise(F.raise_error(F.lit("killed")).cast("boolean"))), most=20)
    few = stage("few", lambda df, most: df.where(F.col("id") < most), most=20)
    last = stage("last", lambda df: df.withColumn("x", F.col("id") * 2))
    with pytest.raises(Exception, match="killed"):
        run_stages(spark, source, [even, broken, last], path)
    assert ran == ["even", "few"] and manifests(spark, path).count() == 1
    left = orphans(spark, path).collect()
    assert all(r["folder"].startswith("few-") for r in left)
    assert run_stages(spark, source, [even, few, last], path).count() == 10 and ran == ["even", "few", "few", "last"]
    assert run_stages(spark, source, [even, few, last], path).agg(F.sum("x")).first()[0] == 180 and len(ran) == 4
    # Another parameter: that stage and those after it.
    other = few._replace(parameters={"most": 10})
    assert run_stages(spark, source, [even, other, last], path).count() == 5 and ran[4:] == ["few", "last"]
    # More input: all of them.
    spark.range(100, 104).write.mode("append").parquet(source)
    assert run_stages(spark, source, [even, few, last], path).count() == 10 and ran[6:] == ["even", "few", "last"]
    assert {(r["stage"], r["n_rows"]) for r in manifests(spark, path).collect()} >= {("even", 50), ("even", 52), ("few", 10), ("few", 5)}
