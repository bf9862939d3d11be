"""Lookups within rows, and vectors from a table in buckets."""

from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions.text import split_ws
from corpusloom.operators import embedding as E
from corpusloom.operators import rowlookup
from corpusloom.operators import vocabulary as V
from corpusloom.operators.rowlookup import lookup_rows
from corpusloom.session import fresh_path

WORDS = [(1, ["a", "b", "zz", None, "a", "q", ""]), (2, []), (3, None), (4, ["zz", "zz"]), (5, ["unknown"]), (6, [None]), (7, ["b"] * 500 + ["zz", "y"])]
IDS = {"a": 0, "b": 1, "": 2, "zz": 3, "y": 4}


def test_head_and_rest(spark):
    df = spark.createDataFrame([(i, "k", w) for i, w in WORDS], "id long, part string, words array<string>").repartition(3)
    entries = spark.createDataFrame(list(IDS.items()), "token string, id long")
    for head in (entries.where("id < 2"), entries, entries.where("false")):
        got = {r["id"]: r["ids"] for r in lookup_rows(df, ["id", "part"], "words", entries.withColumnRenamed("id", "n"), "token", "n", head.withColumnRenamed("id", "n"), "ids").collect()}
        assert got == {i: [IDS.get(w) for w in words or []] for i, words in WORDS}


def test_texts_of_numbers(spark):
    df = spark.createDataFrame([(1, [3, 0, 9, None]), (2, [])], "doc long, ids array<bigint>")
    entries = spark.createDataFrame([(i, t) for t, i in IDS.items()], "id bigint, token string")
    got = {r["doc"]: r["t"] for r in lookup_rows(df, ["doc"], "ids", entries, "id", "token", entries.where("id = 0"), "t").collect()}
    assert got == {1: ["zz", "a", None, None], 2: []}


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, words array<string>")
    entries = spark.createDataFrame([], "token string, n long")
    assert lookup_rows(df, ["id"], "words", entries, "token", "n", entries, "ids").collect() == []


def test_a_table_in_buckets_is_not_shuffled(spark):
    vectors = spark.range(200).select("id", F.array(F.col("id").cast("float"), F.lit(1.0).cast("float")).alias("vector"))
    table = E.store_bucketed(vectors, "vectors_in_buckets", fresh_path(spark, "buckets"), 4)
    rows = spark.createDataFrame([(1, [5, 5, 199, None, 7]), (2, [1000]), (3, [5])], "doc long, ids array<bigint>")
    gathered = E.gather_bucketed(rows, ["doc"], "ids", table, 4)
    assert {r["doc"]: [v[0] for v in r["embeds"]] for r in gathered.collect()} == {1: [5.0, 5.0, 199.0, 7.0], 3: [5.0]}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = E.gather_bucketed(rows, ["doc"], "ids", table, 4)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # One for the ids of a row, one to their buckets, one back to the rows; none for the vectors.
    assert plan.count("Exchange hashpartitioning") == 3 and "Bucketed: true" in plan


def test_rows_with_the_same_key_or_none(spark):
    rows = [(1, ["a", "zz"]), (1, ["zz", "b", "zz"]), (1, ["a", "zz"]), (None, ["y"]), (None, ["a"]), (2, None)]
    df = spark.createDataFrame(rows, "id long, words array<string>").repartition(2)
    entries = spark.createDataFrame(list(IDS.items()), "token string, n long")
    got = [(r["id"], r["ids"]) for r in lookup_rows(df, ["id"], "words", entries, "token", "n", entries.where("n < 2"), "ids").collect()]
    assert sorted(map(str, got)) == sorted(str((i, [IDS[w] for w in words or []])) for i, words in rows)


def test_rows_cut_by_batches(spark, monkeypatch):
    monkeypatch.setattr(rowlookup, "MOST_ELEMENTS", 3)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    try:
        df = spark.createDataFrame(WORDS, "id long, words array<string>").repartition(1)
        entries = spark.createDataFrame(list(IDS.items()), "token string, n long")
        got = {r["id"]: r["ids"] for r in lookup_rows(df, ["id"], "words", entries, "token", "n", entries.where("n = 3"), "ids").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {i: [IDS.get(w) for w in words or []] for i, words in WORDS}


def test_keys_with_two_entries_are_an_error(spark):
    df = spark.createDataFrame([(1, ["a", "b"])], "id long, words array<string>")
    entries = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "token string, n long")
    with pytest.raises(PySparkException, match="more than one entry"):
        lookup_rows(df, ["id"], "words", entries, "token", "n", entries.where("n = 3"), "ids").collect()


def test_texts_are_split_as_by_python(spark):
    spaces = "".join(chr(c) for c in range(0x110000) if chr(c).isspace())
    texts = ["a b  a", " \t the b　", "", "   ", None, "a" + spaces + "b" + "".join(f"{c}the" for c in spaces), "​a﻿b a᠎b é"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc long, text string")
    vocab = V.vocab_build(df, "text")
    counts = Counter(w for t in texts for w in (t or "").split())
    assert [(r["token"], r["uses"]) for r in vocab.orderBy("id").collect()] == sorted(counts.items(), key=lambda c: (-c[1], c[0].encode()))
    coded = V.encode_ids(df, ["doc"], "text", vocab)
    back = V.decode_ids(coded, ["doc"], "ids", vocab, skip=["the"])
    assert {r["doc"]: r["text"] for r in back.collect()} == {i: " ".join(w for w in (t or "").split() if w != "the") for i, t in enumerate(texts)}


def test_invalid_bytes_in_texts(spark):
    df = spark.sql("select 1L as doc, cast(unhex('61FF20C3') as string) as text")
    arrays = df.select("doc", split_ws(F.col("text")).alias("words"))
    words = arrays.first()["words"]
    assert sorted(r["token"] for r in V.vocab_build(df, "text").collect()) == sorted(words)
    vocab = V.vocab_build(arrays, "words")
    assert V.encode_ids(df, ["doc"], "text", vocab).first()["ids"] == V.encode_ids(arrays, ["doc"], "words", vocab).first()["ids"]


def test_unranked_texts(spark):
    vocab = spark.createDataFrame([("a", 900), ("b", 7)], "token string, id bigint")
    df = spark.createDataFrame([(1, "a x b a"), (2, None)], "doc bigint, text string")
    coded = V.encode_ids(df, ["doc"], "text", vocab, ranked=False, unk_id=0)
    assert {r["doc"]: r["ids"] for r in coded.collect()} == {1: [900, 0, 7, 900], 2: []}


def test_decoding_shuffles_places_and_not_texts(spark):
    df = spark.createDataFrame([(1, "the cat the"), (2, "a dog")], "doc long, text string")
    vocab = V.vocab_build(df, "text")
    back = V.decode_ids(V.encode_ids(df, ["doc"], "text", vocab), ["doc"], "ids", vocab)
    plan = back._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" not in plan and "_place" in plan and "array_join" not in plan
