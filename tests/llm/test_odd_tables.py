"""Every query on tables of nulls, repeated rows, very long texts and extra columns, and on empty ones."""

import os

import pytest

from __spark_entry__ import oracle_sql, queries
from corpusloom.llm.queries import QUERIES

CLASH = "size int, taken string, spans int, found string, score string, kept int, component_id string, node int, label int, rule int"
KINDS = {
    "documents": f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}",
    "pages": f"page_id long, url string, html string, {CLASH}",
    "labels": f"doc_id long, quality int, toxic int, {CLASH}",
    "benchmark": f"item_id long, text string, {CLASH}",
    "conversations": f"conv_id long, turn long, role string, text string, {CLASH}",
}
LONG = "long words that go on " * 30_000
ROWS = {
    "documents": [(None,) * 5, (1, "", "", "", 0), (1, "", "", "", 0), (2, LONG, "en", "a", len(LONG)), (3, LONG, None, "a", None), (4, "ein satz", "de", None, 8), (None, "ein satz", "de", None, 8), (5, "\x00 ퟿ é <|endoftext|>", "fr", "b", 1)],
    "pages": [(None,) * 3, (1, "", ""), (1, "http://a.example.net/fr/", None), (1, "http://a.example.net/fr/", None)],
    "labels": [(None, None, None), (2, 1, 0), (2, 0, 0), (4, 0, None), (99, 1, 1)],
    "benchmark": [(None, None), (1, ""), (2, "go on long words"), (None, "ein satz")],
    "conversations": [(None,) * 4, (1, None, None, None), (1, 1, "user", LONG), (1, 1, "user", LONG), (2, 0, "", ""), (2, 1, "user", LONG)],
}


def folder(spark, path, rows):
    for name, kind in KINDS.items():
        extra = (1, "x", 2, "y", "z", 3, "w", 4, 5, 6)
        spark.createDataFrame([(*r, *extra) for r in rows.get(name, [])], kind).write.parquet(os.path.join(path, f"{name}.parquet"))
    return str(path)


@pytest.fixture(scope="module")
def odd(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("odd"), ROWS)


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return folder(spark, tmp_path_factory.mktemp("empty"), {})


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(queries()) and {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in QUERIES}
    assert {"op7_licences", "op10_url_verdicts", "op11_prefix_trie", "op13_shards"} <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_odd_rows(spark, odd, name):
    got = QUERIES[name](spark, odd).collect()
    if name == "op4_benchmark_leaks":
        assert {(r["doc_id"], r["item_id"]) for r in got} == {(2, 2), (3, 2), (4, None), (None, None)}
    elif name == "op11_prefix_trie":
        # Conversation 1 goes on after one turn of its own start, that is none of conversation 0.
        assert {(r["conv_id"], r["depth"]) for r in got} >= {(1, 0)} and len({(r["conv_id"], r["depth"]) for r in got}) == len(got)
    else:
        assert len(got) == len(ROWS["pages" if name.startswith("op10") else "documents"])


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    result = QUERIES[name](spark, empty)
    assert result.collect() == [] and result.columns[0] in ("doc_id", "page_id", "conv_id")
