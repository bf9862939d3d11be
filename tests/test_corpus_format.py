"""The corpus format in batches and streams."""

import time

import pytest
from pyspark.sql import functions as F

from corpusloom.sources.corpus_format import corpus_source, read_corpus, register_corpus_source


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    register_corpus_source(spark)
    path = str(tmp_path_factory.mktemp("corpus") / "t")
    rows = spark.range(3000).select("id", F.when(F.col("id") < 1500, "en").otherwise("de").alias("config"), (F.col("id") % 7).cast("int").alias("n"), F.lit("x").alias("text"))
    rows.repartitionByRange(4, "id").write.option("parquet.block.size", 1024).parquet(path)
    return path


def test_rows_and_columns(spark, corpus):
    rows, plain = spark.read.format("corpus").load(corpus), spark.read.parquet(corpus)
    assert rows.dtypes == plain.dtypes
    assert sorted(map(tuple, rows.collect())) == sorted(map(tuple, plain.collect()))
    narrow = spark.read.format("corpus").schema("id long").load(corpus)
    assert sorted(r[0] for r in narrow.collect()) == list(range(3000))


def test_values_are_chosen_while_reading(spark, corpus):
    plain = spark.read.parquet(corpus)
    for where, test in (
        ({"config": "en"}, "config = 'en'"), ({"config": "de", "n": [1, 3]}, "config = 'de' and n in (1, 3)"), ({"config": "none"}, "false"), ({}, "true"),
        ({"id": 2990}, "id = 2990"),
    ):
        assert sorted(map(tuple, read_corpus(spark, corpus, **where).collect())) == sorted(map(tuple, plain.where(test).collect()))


def test_two_filters_on_one_table(spark, corpus):
    rows = spark.read.format("corpus").load(corpus)
    both = rows.where("config = 'en' and n = 1").unionByName(rows.where("config = 'de' and n = 2"))
    plain = spark.read.parquet(corpus).where("(config = 'en' and n = 1) or (config = 'de' and n = 2)")
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, plain.collect()))


def test_row_groups_are_ruled_out(corpus):
    source = corpus_source()
    kind = source({"path": corpus}).schema()
    every = len(source({"path": corpus, "partitionBytes": "1"}).reader(kind).partitions())
    chosen = source({"path": corpus, "partitionBytes": "1", "where": '{"config": ["en"]}'}).reader(kind).partitions()
    assert 0 < len(chosen) < every


def test_streams_go_on_after_a_restart(spark, tmp_path):
    register_corpus_source(spark)
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for part in range(3):
        spark.range(part * 10, part * 10 + 10).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.05)

    def run():
        stream = spark.readStream.format("corpus").schema("id long").option("path", path).load()
        query = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(out)
        query.awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(out).collect())

    assert run() == list(range(30))
    assert run() == list(range(30))
    spark.range(30, 35).coalesce(1).write.mode("append").parquet(path)
    assert run() == list(range(35))


def test_a_path_is_needed(spark):
    register_corpus_source(spark)
    with pytest.raises(Exception, match="path"):
        spark.read.format("corpus").load().collect()


def test_a_row_group_is_read_in_small_batches(spark, tmp_path, monkeypatch):
    """A task holds some rows of a row group, never all of them."""
    from corpusloom.sources import corpus_format

    path = str(tmp_path / "one")
    spark.range(4000).selectExpr("id", "'en' as config", "repeat(id, 20) as text").coalesce(1).write.parquet(path)
    monkeypatch.setattr(corpus_format, "BATCH_BYTES", 10_000, raising=False)
    source = corpus_format.corpus_source()
    for where, wanted in (("{}", 4000), ('{"id": [7, 8]}', 2), ('{"config": ["en"]}', 4000)):
        one = source({"path": path, "where": where})
        reader = one.reader(spark.read.parquet(path).select("text").schema)
        sizes = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
        assert sum(sizes) == wanted and max(sizes) < 1000
