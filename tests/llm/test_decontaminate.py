"""The finder next to plain dynamic programming over whole texts."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.decontaminate import PassageFinder, benchmark_leaks, myers, normalise, original_span
from corpusloom.llm.queries import op4_benchmark_leaks


def nearest(pattern, text):
    """Smallest edit distance of the pattern to any part of the text, row by row."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(pattern, 1):
        last, row[0] = row[0], i
        for j, t in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (p != t))
    return min(row)


@pytest.mark.parametrize("seed", range(60))
def test_bit_parallel_distance(seed):
    pick = random.Random(seed)
    pattern = "".join(pick.choices("abc", k=pick.randint(1, 70)))
    text = "".join(pick.choices("abcd", k=pick.randint(0, 90)))
    assert myers(pattern, text)[0] == nearest(pattern, text)


def edited(pick, text, edits):
    chars = list(text)
    for _ in range(edits):
        at = pick.randrange(len(chars))
        kind = pick.randrange(3)
        chars[at : at + (kind != 0)] = [] if kind == 1 else [pick.choice("abcdefgh ")]
    return "".join(chars)


@pytest.mark.parametrize("seed", range(8))
def test_finder_equals_dynamic_programming(seed):
    pick = random.Random(seed)
    words = ["".join(pick.choices("abcdefgh", k=pick.randint(1, 7))) for _ in range(60)]
    items = [(i, " ".join(pick.choices(words, k=pick.randint(1, 18)))) for i in range(12)]
    texts = []
    for _ in range(25):
        parts = [" ".join(pick.choices(words, k=pick.randint(0, 20)))]
        for _ in range(pick.randint(0, 2)):
            text = pick.choice(items)[1]
            parts += [edited(pick, text, pick.randint(0, len(text) // 9 + 1)), " ".join(pick.choices(words, k=5))]
        texts.append(" ".join(parts))
    finder = PassageFinder(items, 12)
    for text in texts:
        plain = normalise(text)
        due = [(i, d) for i, t in items if (d := nearest(normalise(t), plain)) <= len(normalise(t)) // 12]
        found = finder.find(text)
        assert [(i, d) for i, d, _, _ in found] == due
        for i, distance, start, end in found:
            assert nearest(normalise(dict(items)[i]), normalise(text[start:end])) == distance


def test_positions_in_the_original():
    text = "--  Éa,\n bC! d"
    plain = normalise(text)
    assert plain == "éa bc d"
    for a in range(len(plain)):
        for b in range(a + 1, len(plain) + 1):
            start, end = original_span(text, a, b)
            assert normalise(text[start:end]) == plain[a:b].strip()


def test_nulls_empties_blocks_and_names(spark):
    items = [(1, "the quick brown fox jumps over it"), (2, None), (3, "!!"), (4, "the quick brown fox jumps over it"), (None, "x"), (5, "lazy dogs sleep all day long")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [None, "", "THE quick,brown\nfox jumps -- over it", "the quick brown fox", "lazy dogs sleep all day long " * 20_000]
    docs = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, item_id int")
    for block in (10, 1000):
        got = docs.withColumn("leaks", benchmark_leaks(spark, F.col("text"), bench, block_chars=block)).collect()
        assert [[(x["item_id"], x["distance"]) for x in r["leaks"]] for r in got] == [[], [], [(None, 0), (1, 0), (4, 0)], [(None, 0)], [(5, 0)]]
        assert all(r["item_id"] == 7 for r in got)
    none = docs.select(F.size(benchmark_leaks(spark, F.col("text"), bench.where("false"))).alias("n"))
    assert {r["n"] for r in none.collect()} == {0}


def test_query_equals_plain_search(spark, small):
    docs = [(r[0], normalise(r[1])) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    items = [(r[0], normalise(r[1])) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    got = op4_benchmark_leaks(spark, small).collect()
    assert {(d, i) for d, t in docs for i, b in items if b in t} <= {(r["doc_id"], r["item_id"]) for r in got}
    texts, parts = dict(docs), dict(items)
    assert got and all(nearest(parts[r["item_id"]], texts[r["doc_id"]]) == r["distance"] for r in got)


def test_items_without_an_id_are_searched_for(spark):
    items = spark.createDataFrame([(None, "lazy dogs sleep all day long"), ("x7", "quick brown foxes"), ("3", "banana bread")], "item_id string, text string")
    texts = spark.createDataFrame([(1, "the lazy dogs sleep all day long"), (2, "quick brown foxes, banana bread"), (3, "")], "doc_id int, text string")
    got = texts.select("doc_id", F.explode(benchmark_leaks(spark, F.col("text"), items, block_chars=20)).alias("leak")).select("doc_id", "leak.item_id").collect()
    assert sorted(((r["doc_id"], r["item_id"]) for r in got), key=str) == [(1, None), (2, 3), (2, None)]

