"""Word edits against the textbook table."""

import os
import random
import re
import subprocess
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions import words as W
from corpusloom.functions.text import split_ws
from corpusloom.operators.scoring import console_report, prediction_report, score_pairs, wer_corpus


def table_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, above = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def random_pairs(n, longest, seed=3):
    draw = random.Random(seed)
    letters = ["a", "b", "c", "é", "dd", "\U0001f600", "日本"]
    return [
        tuple(draw.choices(letters, k=draw.randint(0, longest)) for _ in range(2)) for _ in range(n)
    ]


def test_edits_of_short_and_long_pairs(spark):
    pairs = random_pairs(1500, 12) + random_pairs(30, 150)
    df = spark.createDataFrame([(i, r, p) for i, (r, p) in enumerate(pairs)], "i int, r array<string>, p array<string>")
    wanted = [table_distance(r, p) for r, p in pairs]
    for counter in (W.word_edits, W.word_edits_native):
        got = df.select("i", counter(F.col("r"), F.col("p")).alias("edits")).collect()
        assert [r["edits"] for r in sorted(got)] == wanted


def test_many_distinct_words(spark):
    for n in (100, 255, 256, 3000):
        reference = [f"w{i}" for i in range(n)]
        df = spark.createDataFrame([(reference, [*reference[1:], reference[n // 2]])], "r array<string>, p array<string>")
        for counter in (W.word_edits, W.word_edits_native):
            assert df.select(counter(F.col("r"), F.col("p"))).first()[0] == 2


def test_missing_side(spark):
    df = spark.createDataFrame([(["a"], None), (None, ["a"])], "r array<string>, p array<string>")
    for counter in (W.word_edits, W.word_edits_native):
        assert [r[0] for r in df.select(counter(F.col("r"), F.col("p"))).collect()] == [None, None]


def test_word_list(spark):
    texts = ["a b", " a  b ", "a\nb c", "a \n b", "", "  ", "a\t\tb", "a b"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = [r["w"] for r in sorted(df.select("i", W.word_list(F.col("t")).alias("w")).collect())]
    assert got == [[w for w in re.sub(r"\s\s+", " ", t).strip().split(" ") if w] for t in texts]


def test_percentage_rounds_like_python(spark):
    draw = random.Random(4)
    rates = [k / 800 for k in range(800)] + [draw.randint(0, 999) / draw.randint(1, 999) for _ in range(3000)]
    df = spark.createDataFrame([(r,) for r in rates], "r double")
    got = df.select("r", W.format_wer(F.col("r")).alias("s")).collect()
    assert [r["s"] for r in got] == [f"{r['r']:.2%}" for r in got]


def test_rate_is_over_the_corpus(spark):
    df = spark.createDataFrame(
        [("g", "a b c d", "a b c d"), ("g", "a", "b"), ("h", "", "x y")], "g string, reference string, prediction string"
    )
    scored = score_pairs(df)
    assert {r["g"]: (r["edits"], r["ref_words"], r["wer"]) for r in wer_corpus(scored, ["g"]).collect()} == {
        "g": (1, 5, 0.2), "h": (2, 0, None)
    }
    assert wer_corpus(scored).first()["wer"] == 3 / 5


def test_known_document_sums(spark):
    """First forty words of each document against the same without every fifth."""
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables here")
    words = F.slice(split_ws(F.col("text")), 1, 40)
    df = spark.read.parquet(path).select("lang", words.alias("r"))
    df = df.withColumn("p", F.filter("r", lambda w, i: i % 5 != 4))
    df = df.withColumn("edits", W.word_edits(F.col("r"), F.col("p")))
    sums = df.groupBy("lang").agg(F.sum("edits").alias("e"), F.sum(F.size("r")).alias("n"))
    assert {r["lang"]: (r["e"], r["n"]) for r in sums.collect()} == {
        "de": (1002, 5026), "en": (4871, 24387), "es": (789, 3960), "fr": (1145, 5730)
    }


def test_reports(spark):
    rows = [("r", i, f"ref {i} " + "x" * 90, f"hyp {i}") for i in range(1, 8)]
    df = spark.createDataFrame(rows, "run string, pos int, reference string, prediction string")
    text = prediction_report(df, ["run"]).first()["text"]
    assert text.startswith(f"**Sample 1**\n\nTruth: {rows[0][2]}\n\nPrediction: hyp 1\n\n---\n**Sample 2**")
    assert text.count("---") == 5
    short = console_report(df, ["run"]).first()["text"]
    assert short.startswith(f"  Truth:      {rows[0][2][:80]}...\n  Prediction: hyp 1...\n")
    assert short.count("Truth") == 3


def test_functions_reach_tasks_without_the_package(tmp_path):
    """Executors have no copy of this package."""
    (tmp_path / "count").write_bytes(cloudpickle.dumps(W._count_edits))
    code = "import pickle; print(pickle.load(open('count', 'rb'))(['a', 'b'], ['b', 'c', 'd']))"
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=environment, capture_output=True, text=True)
    assert run.stdout.strip() == "3", run.stderr
