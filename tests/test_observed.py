"""Metrics that are taken on the way, and what cannot be read."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.observed import ObservedRun, StreamMetrics, observed_score
from corpusloom.operators.scoring import score_pairs
from corpusloom.sources import quarantine as Q
from corpusloom.sources.sinks import read_scalars


def test_observed_sums_equal_aggregates(spark, tmp_path):
    pairs = spark.createDataFrame([("a b c", "a x c"), ("d", "d e"), (None, "f"), ("", "g")], "reference string, prediction string").repartition(3)
    run = ObservedRun("run1", step=7)
    kept = run.at(pairs, "read").where("reference is not null")
    scored = observed_score(run.at(kept, "kept"), run)
    scored.write.format("noop").mode("overwrite").save()
    total = score_pairs(pairs.where("reference is not null")).agg(F.sum("edits"), F.sum("ref_words")).first()
    assert run.values() == {"read/rows": 4, "kept/rows": 3, "score/rows": 3, "score/edits": total[0], "score/ref_words": total[1], "score/unscored": 0}
    path = str(tmp_path / "scalars")
    run.write(spark, path, "a")
    run.write(spark, path, "a")
    assert {(r["run_id"], r["tag"], r["step"], r["value"]) for r in read_scalars(spark, path).collect()} == {("run1", t, 7, float(v)) for t, v in run.values().items()}
    assert read_scalars(spark, path).count() == 6


def test_points_have_names_of_their_own(spark):
    run = ObservedRun("r")
    run.at(spark.range(1), "x")
    with pytest.raises(ValueError):
        run.at(spark.range(1), "x")


def test_one_scan(spark, tmp_path):
    spark.range(100).write.parquet(str(tmp_path / "t"))
    run = ObservedRun("r")
    rows = run.at(run.at(spark.read.parquet(str(tmp_path / "t")), "all").where("id < 40"), "few", most=F.max("id"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert rows.count() == 40 and run.values() == {"all/rows": 100, "few/rows": 40, "few/most": 39}


def test_streams_are_observed(spark, tmp_path):
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).write.parquet(str(tmp_path / f"in/{part}"))
    path = str(tmp_path / "scalars")
    listener = StreamMetrics(spark, path, {"rows_in": "stream1"})
    spark.streams.addListener(listener)
    try:
        sdf = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
        seen = sdf.observe("rows_in", F.count(F.lit(1)).alias("rows"), F.sum("id").alias("total"))
        query = seen.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(20_000)
    finally:
        spark.streams.removeListener(listener)
    sums = {r["tag"]: r["n"] for r in read_scalars(spark, path).where("run_id = 'stream1'").groupBy("tag").agg(F.sum("value").alias("n")).collect()}
    assert sums == {"rows_in/rows": 30.0, "rows_in/total": 435.0}


SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False), T.StructField("text", T.StringType()), T.StructField("rate", T.DoubleType()),
    T.StructField("tags", T.ArrayType(T.StringType())),
])


def test_json_lines(spark, tmp_path):
    lines = [
        json.dumps({"id": 1, "text": "a", "rate": 0.5, "tags": ["x"]}), '{"id": 2, "text": "b"', "", "not json", json.dumps({"id": "many", "text": "c"}),
        json.dumps({"text": "d"}), json.dumps({"id": 3, "rate": "fast"}), json.dumps({"id": "4", "text": 5, "extra": 1}), "[1, 2]", json.dumps({"id": 5, "text": None}),
    ]
    (tmp_path / "in.json").write_text("\n".join(lines))
    good, bad = Q.read_json_lines(spark, str(tmp_path), SCHEMA)
    assert sorted(map(tuple, good.collect()), key=str) == [(1, "a", 0.5, ["x"]), (4, "5", None, None), (5, None, None, None)]
    rows = bad.collect()
    assert sorted((r["reason"], r["field"] or "") for r in rows) == [("malformed", "")] * 3 + [("missing", "id"), ("wrong type", "id"), ("wrong type", "rate")]
    assert all(r["file"].endswith("in.json") and r["block"] == 0 and r["content"] in lines for r in rows)
    assert {tuple(r) for r in Q.counts_by_reason(bad).collect()} == {("malformed", None, 3), ("missing", "id", 1), ("wrong type", "id", 1), ("wrong type", "rate", 1)}


def test_damaged_files(spark, tmp_path):
    spark.range(50).repartition(3).write.parquet(str(tmp_path / "t"))
    (tmp_path / "t" / "broken.parquet").write_bytes(b"PAR1 this is none")
    rows, bad = Q.read_parquet_files(spark, str(tmp_path / "t"), T.StructType([T.StructField("id", T.LongType())]))
    assert sorted(r["id"] for r in rows.collect()) == list(range(50))
    assert [(r["file"].rsplit("/", 1)[1], r["length"], r["reason"]) for r in bad.collect()] == [("broken.parquet", 17, "unreadable file")]
