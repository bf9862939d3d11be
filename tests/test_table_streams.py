"""Tables read as streams, kept as one file or as a folder of several."""

import pytest
from pyspark.sql import functions as F

from corpusloom.catalog import streams as Q
from corpusloom.catalog import standins as S
from corpusloom.operators.scoring import score_pairs


@pytest.fixture(params=["file", "folder"])
def kept(request, spark, tmp_path):
    documents = spark.createDataFrame(
        [(i, f"text {i}", "de en es fr".split()[i * 7 % 4], "src0", 6) for i in range(40)],
        "doc_id bigint, text string, lang string, source string, n_chars bigint",
    )
    turns = spark.createDataFrame(
        [(i // 2, i % 2, "user", f"one two three four five {i}") for i in range(60)], "conv_id bigint, turn bigint, role string, text string"
    )
    for name, table in (("documents", documents), ("conversations", turns)):
        if request.param == "file":
            table.toPandas().to_parquet(tmp_path / f"{name}.parquet")
        else:
            table.repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_stream_interleave(spark, kept):
    rows = Q.stream_interleave(spark, kept).orderBy("pos").collect()
    assert [r["pos"] for r in rows] == list(range(1, 38))
    assert [r["k"] for r in rows] == ([0, 1, 2, 3] * 10)[:37]
    of = {k: [r["doc_id"] for r in rows if r["k"] == k] for k in range(4)}
    assert all(ids == sorted(ids) for ids in of.values())


def test_stream_wer(spark, kept):
    got = {r["window"]: (r["edits"], r["ref_words"]) for r in Q.stream_wer(spark, kept).collect()}
    scored = score_pairs(S.as_pairs(spark.read.parquet(f"{kept}/conversations.parquet")))
    sums = scored.groupBy(F.floor(F.col("conv_id") / 20).alias("w")).agg(F.sum("edits").alias("e"), F.sum("ref_words").alias("n"))
    assert got == {r["w"]: (r["e"], r["n"]) for r in sums.collect()} and len(got) == 2


def test_stream_clean_and_take(spark, kept):
    assert Q.stream_take(spark, kept).first().asDict() == {"n": 40, "n_known": 40}
    wanted = S.utterances(spark, kept).where("utterance_id % 12 in (2, 3, 7, 8, 9, 10, 11)").count()
    assert Q.stream_clean(spark, kept).count() == wanted
