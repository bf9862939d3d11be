"""Streams against the same rows as a table, over several micro-batches, restarts and repeats."""

import os

import pytest
from pyspark.sql import functions as F

from corpusloom.functions.text import clean_text
from corpusloom.operators.interleave import interleave
from corpusloom.operators.rows import filter_map
from corpusloom.operators.scoring import score_pairs, wer_corpus
from corpusloom.streaming import streams

SCHEMA = "id bigint, src string, text string"
SOURCES = ["a", "b", "c"]


def rows(first, n):
    texts = ["<SIL>", "well <COMMA> now", "x <NOISE> yes", None, "plain"]
    return [(i, "aabacb"[i % 6], texts[i % 5]) for i in range(first, first + n)]


def arrive(spark, folder, name, data):
    """One more file, and so one more micro-batch."""
    os.makedirs(folder, exist_ok=True)
    spark.createDataFrame(data, SCHEMA).toPandas().to_parquet(f"{folder}/{name}.parquet")
    seconds = 1_700_000_000 + int(name)
    os.utime(f"{folder}/{name}.parquet", (seconds, seconds))


def reading(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def test_clean_goes_on_after_a_restart(spark, tmp_path):
    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    for name, first in (("1", 0), ("2", 10)):
        arrive(spark, folder, name, rows(first, 10))
        streams.append_stream(streams.stream_clean(reading(spark, folder)), out, state).awaitTermination()
    table = spark.createDataFrame(rows(0, 20), SCHEMA)
    wanted = filter_map(table, "text", clean_text(F.col("text")))
    assert sorted(spark.read.parquet(out).collect()) == sorted(wanted.collect())


def test_take(spark, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(3):
        arrive(spark, folder, str(i), rows(10 * i, 10))
    for n, wanted in ((12, 12), (None, 30)):
        out, state = str(tmp_path / f"out{n}"), str(tmp_path / f"state{n}")
        streams.append_stream(streams.stream_take(reading(spark, folder), n), out, state).awaitTermination()
        assert spark.read.parquet(out).count() == wanted


def test_interleave_over_batches(spark, tmp_path):
    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    seen = []
    for name, first, n in (("1", 0, 4), ("2", 4, 9), ("3", 13, 1), ("4", 14, 16)):
        arrive(spark, folder, name, rows(first, n) + [(1000 + first, "other", "x")])
        seen += rows(first, n)
        streams.stream_interleave(reading(spark, folder), "src", SOURCES, "id", out, state).awaitTermination()
        table = spark.createDataFrame(seen, SCHEMA)
        wanted = interleave([table.where(F.col("src") == s) for s in SOURCES], "id")
        got = streams.read_interleaved(spark, out, SOURCES)
        columns = ["pos", "k", "rn", "id", "text"]
        assert got.select(columns).orderBy("pos").collect() == wanted.select(columns).orderBy("pos").collect()


def test_repeated_batch_writes_the_same(spark, tmp_path):
    """A lost state folder makes all batches run again over what they wrote."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    for i in range(3):
        arrive(spark, folder, str(i), rows(7 * i, 7))
    results = []
    for attempt in ("first", "second"):
        state = str(tmp_path / attempt)
        streams.stream_interleave(reading(spark, folder), "src", SOURCES, "id", out, state).awaitTermination()
        results.append(streams.read_interleaved(spark, out, SOURCES).orderBy("pos").collect())
    assert results[0] == results[1] and len(results[0]) > 0


@pytest.mark.parametrize("files", [1, 4])
def test_wer_equals_the_table(spark, tmp_path, files):
    folder, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))
    data = [(i, "x", f"a b{i % 3} c d{i % 4}") for i in range(40)]
    for i in range(files):
        arrive(spark, folder, str(i), data[i::files])

    def pairs(df):
        return df.select(
            F.col("id").alias("step"), F.col("text").alias("reference"),
            F.regexp_replace("text", "b1|d2", "z").alias("prediction"),
        )

    for _ in range(2):
        streams.stream_wer(pairs(reading(spark, folder)), 10, out, state).awaitTermination()
    got = streams.read_wer(spark, out).orderBy("window").collect()
    table = score_pairs(pairs(spark.createDataFrame(data, SCHEMA))).withColumn("window", F.floor(F.col("step") / 10))
    assert got == wer_corpus(table, ["window"]).orderBy("window").collect()
