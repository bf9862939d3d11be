"""The learned rules and the classifier: statistics by brute force, held-out accuracy, odd rows."""

import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.quality_model import QualityScorer, fit_quality_model, quality_score, train
from corpusloom.llm.quality_rules import STATISTICS, add_statistics, base_failed, decided_by, learn_rules, verdict
from corpusloom.llm.queries import op5_quality_rules, op9_quality_scores

WORD = r"[^\x20\x09-\x0d]+"


def statistics(text):
    text = text or ""
    words = re.findall(WORD, text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    covered = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics(spark):
    pick = random.Random(1)
    texts = [None, "", " \n\t", "a", "a b", "a b c", "a a a a", "a b c a b c", "x\n\nx\n x\nx\n", "é|é\x85é é", "a b a b a b a b", "z " * 40_000]
    texts += ["".join(pick.choices(["a", "b", "é", " ", " ", "\n", "#", "<", "\x0b"], k=pick.randint(0, 200))) for _ in range(300)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, n_words string")
    got = {r["doc_id"]: tuple(r[c] for c in STATISTICS) for r in add_statistics(df).collect()}
    assert got == {i: statistics(t) for i, t in enumerate(texts)}


def test_rules_are_learned(spark):
    pick = random.Random(2)
    rows = [(i, 100, share := pick.random() / 2, words := pick.randint(2, 12) * 1.0, int(not (share >= 0.3 and words >= 6))) for i in range(1500)]
    names = "doc_id long, n_words long, symbol_share double, mean_word double, quality int"
    df = spark.createDataFrame(rows, names)
    for other in ("dup_line_share", "repeat_share", "upper_share", "digit_share", "mark_share"):
        df = df.withColumn(other, F.rand(3))
    rules = learn_rules(df, "quality")
    assert {(c.measure, c.at_least, c.threshold) for c in rules[0]} == {("symbol_share", True, 0.3), ("mean_word", True, 5.5)}
    right = df.where((F.col("quality") == 1) == verdict(rules)).count()
    assert right >= 0.99 * len(rows)
    assert df.where(~verdict(rules) & decided_by(rules).isNull()).count() == 0
    assert learn_rules(df.where("quality = 1"), "quality") == [] and learn_rules(df.where("false"), "quality") == []


def folder_of(spark, path, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, kept int, score string").write.parquet(os.path.join(path, "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(os.path.join(path, "labels.parquet"))
    return str(path)


@pytest.mark.parametrize("labels", [[], [(1, None, 0), (None, 1, 0)], [(0, 1, 0), (1, 1, 0)]])
def test_queries_on_odd_tables(spark, tmp_path, labels):
    docs = [(0, None, 1, ""), (1, "", 1, ""), (1, "", 1, ""), (None, "a b c " * 40, 1, ""), (3, "w%d " * 60 % tuple(range(60)), 1, "")]
    folder = folder_of(spark, tmp_path, docs, labels)
    rules = op5_quality_rules(spark, folder).collect()
    assert len(rules) == len(docs) and {r["doc_id"]: r["kept"] for r in rules}[3] is True
    scores = op9_quality_scores(spark, folder).collect()
    assert len(scores) == len(docs) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in scores)


def test_queries_on_empty_tables(spark, tmp_path):
    folder = folder_of(spark, tmp_path, [], [])
    assert op5_quality_rules(spark, folder).collect() == [] and op9_quality_scores(spark, folder).collect() == []


def test_rules_on_the_tables(spark, small):
    docs = {r[0]: r[1] for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    query = op5_quality_rules(spark, small)
    assert "Python" not in query._jdf.queryExecution().toString() and "Arrow" not in query._jdf.queryExecution().toString()
    got = query.collect()
    assert len(got) == len(docs)
    for r in got:
        assert tuple(r[c] for c in STATISTICS) == statistics(docs[r["doc_id"]])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])


def test_held_out_rules(spark):
    sf = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    docs = spark.read.parquet(f"{sf}/documents.parquet").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    measured = add_statistics(docs).where(~base_failed()).drop("text").cache()
    rules = learn_rules(measured.where("doc_id % 3 <> 0"), "quality")
    rest = measured.where("doc_id % 3 = 0")
    assert rest.where((F.col("quality") == 1) == verdict(rules)).count() >= 0.95 * rest.count()


def test_held_out_scores(spark):
    sf = os.environ.get("LLM_SF_DIR", "/root/testdata/sf0.01")
    if not os.path.isdir(sf):
        pytest.skip("no test tables here")
    scored = op9_quality_scores(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["predicted"] == r["quality"] for r in scored) >= 0.93 * len(scored)


def test_scores_do_not_depend_on_what_is_kept():
    model = train(["good plain words"] * 20 + ["bad## words##"] * 20, [1] * 20 + [0] * 20)
    texts = ["good words", None, "", "bad## thing##", "é words é"]
    assert QualityScorer(model).score(texts) == [QualityScorer(model, kept=1).score([t])[0] for t in texts]
    assert QualityScorer(model).score(["good plain words"])[0] > 0.5 > QualityScorer(model).score(["bad## words##"])[0]


def test_scores_of_one_label_and_none(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, quality int")
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    none = fit_quality_model(docs, empty, "quality")
    assert {r[0] for r in docs.select(quality_score(spark, F.col("text"), none)).collect()} == {0.5}
    assert QualityScorer(train(["a"], [1])).score(["b"])[0] > 0.99 and QualityScorer(train(["a"], [0])).score(["b"])[0] < 0.01
