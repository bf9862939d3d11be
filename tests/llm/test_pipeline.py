"""Each stage on the tables and on odd rows, next to what it must keep."""

import os
import re

import pytest

import corpus_pipeline
from corpusloom.llm.common import table
from corpusloom.llm.decontaminate import normalise
from corpusloom.llm.secrets import find_spans
from tests.llm.test_neardup import expected

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KIND = "doc_id long, text string, lang string, source string, n_chars long"


def stage(name, spark, docs, folder):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, folder)


def test_stages_are_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "secrets", "mixture"]


def test_every_stage_on_its_own_input(spark, small, tmp_path):
    docs = table(spark, small, "documents")
    for name, function in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        result = function(spark, docs, small)
        path = os.path.join(tmp_path, name)
        result.write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "mixture":
            break
        assert docs.columns == COLUMNS
        if name == "language":
            assert set(after) == {i for i, r in before.items() if re.search(r"[^\W\d_]", r["text"] or "")}
        if name == "near_dedup":
            groups = expected([(i, r["text"]) for i, r in before.items()], 5, 80)
            assert set(after) == set(groups.values())
        if name == "decontaminate":
            items = [normalise(r["text"]) for r in table(spark, small, "benchmark").collect()]
            exact = {i for i, r in before.items() if any(x in normalise(r["text"]) for x in items)}
            assert exact and not exact & set(after) and len(after) >= len(before) - 1.5 * len(exact)
        if name == "secrets":
            assert set(after) == set(before)
            assert not any(find_spans(r["text"]) for r in after.values())
            for i, r in after.items():
                same = not find_spans(before[i]["text"])
                assert same == (r["text"] == before[i]["text"])
                assert r["n_chars"] == (before[i]["n_chars"] if same else len(r["text"]))
        elif name != "secrets":
            assert all(after[i] == before[i] for i in after)
    assert set(after) <= set(before) and all(r["copies"] in (1, 2) and r["taken"] == r["copies"] * r["size"] for r in after.values())
    sources = {r["source"]: r["target"] for r in after.values()}
    taken = {s: sum(r["taken"] for r in after.values() if r["source"] == s) for s in sources}
    largest = {s: max(len((r["text"] or "").split()) for r in before.values() if r["source"] == s) for s in sources}
    assert all(abs(taken[s] - t) <= largest[s] for s, t in sources.items())


ODD = [
    (1, "der hund und die katze", "de", None, None), (1, "der hund und die katze", "de", None, None),
    (None, None, None, None, None), (None, "the dog and the cat", "en", "a", 19), (2, "", "en", "a", 0), (3, "12 34", None, "b", 5),
    (4, "token = 'abcdefgh12345678' the dog", "en", "b", 34), (5, "DER Hund und die Katze", None, "a", 22),
    (6, "the item of the benchmark is hidden in here with THE passage that leaks, truly", "en", "a", 80),
]


def odd_folder(spark, path, rows):
    spark.createDataFrame(rows, KIND).write.parquet(os.path.join(path, "documents.parquet"))
    items = [(1, "The passage that leaks truly!"), (2, None), (None, "x")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(os.path.join(path, "benchmark.parquet"))
    return str(path)


def test_odd_rows(spark, tmp_path):
    folder = odd_folder(spark, tmp_path, ODD)
    docs = table(spark, folder, "documents")
    kept = stage("language", spark, docs, folder)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "1", "4", "5", "6", "None"]
    kept = stage("near_dedup", spark, kept.cache(), folder)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "4", "6", "None"]
    assert "6" not in [str(r["doc_id"]) for r in stage("decontaminate", spark, docs, folder).collect()]
    clean = {r["doc_id"]: r for r in stage("secrets", spark, docs.where("doc_id = 4"), folder).collect()}
    assert clean[4]["text"] == "[SECRET]' the dog" and clean[4]["n_chars"] == 17
    final = corpus_pipeline.run(spark, folder).collect()
    assert {r["doc_id"] for r in final} <= {1, 4, None}


def test_no_documents(spark, tmp_path):
    folder = odd_folder(spark, tmp_path, [])
    for name, _ in corpus_pipeline.STAGES:
        assert stage(name, spark, table(spark, folder, "documents"), folder).collect() == []


def test_without_any_language(spark, tmp_path):
    folder = odd_folder(spark, tmp_path, [(1, "abc", None, "a", 3), (2, "1", None, "a", 1), (3, None, None, "a", 0)])
    assert [r["doc_id"] for r in stage("language", spark, table(spark, folder, "documents"), folder).collect()] == [1]


@pytest.mark.parametrize("name", ["language", "decontaminate", "secrets"])
def test_rows_are_not_shuffled_by_row_stages(spark, small, name):
    plan = stage(name, spark, table(spark, small, "documents"), small)._jdf.queryExecution().toString()
    assert "Exchange" not in plan.split("== Physical Plan ==")[1]
