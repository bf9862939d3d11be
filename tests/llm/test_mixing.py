"""Water filling, the flight and landing phases, and the mix as a whole."""

import random

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.common import word_count
from corpusloom.llm.mixing import cyclic_weights, flight, landing, mix_sources, water_fill

KIND = "doc_id long, source string, text string, size string, taken string"


def rows(n, seed=3, sources=("a", "b", None, "é")):
    pick = random.Random(seed)
    return [
        (i, pick.choice(sources), pick.choice([None, "", "x " * pick.randint(1, 60)]), "size", "taken")
        for i in range(n)
    ]


@pytest.mark.parametrize("seed", range(20))
def test_water_filling(seed):
    pick = random.Random(seed)
    sizes = [pick.choice([0, pick.randint(1, 1000)]) for _ in range(pick.randint(1, 9))]
    weights = [pick.choice([5.0, 2.0, 1.0]) for _ in sizes]
    total = 1.5 * sum(sizes)
    targets = water_fill(sizes, weights, total)
    assert sum(targets) == pytest.approx(total)
    assert all(t <= 2 * s + 1e-9 for t, s in zip(targets, sizes))
    # Those below their cap have one share by weight, which no full one exceeds.
    level = {round(t / w, 6) for t, s, w in zip(targets, sizes, weights) if t < 2 * s - 1e-9}
    assert len(level) <= 1
    assert all(t / w <= max(level, default=1e18) + 1e-6 for t, w in zip(targets, weights))


def test_weights_repeat_by_code_point_null_last():
    assert cyclic_weights(["é", None, "b", "Z"]) == {"Z": 5.0, "b": 2.0, "é": 1.0, None: 5.0}


@pytest.mark.parametrize("seed", range(10))
def test_flight_keeps_both_totals(seed):
    pick = random.Random(seed)
    sizes = sorted((pick.choice([0, 7, pick.randint(1, 500)]) for _ in range(200)), reverse=True)
    odds = [0.3] * 200
    after = flight(odds, sizes, seed)
    assert sum(0 < p < 1 for p in after) <= 2
    assert sum(after) == pytest.approx(sum(odds), abs=1e-6)
    assert sum(p * s for p, s in zip(after, sizes)) == pytest.approx(sum(p * s for p, s in zip(odds, sizes)), abs=1e-4)
    landed = landing(after, sizes, odds)
    assert set(landed) <= {0.0, 1.0}
    assert abs(sum(p * s for p, s in zip(landed, sizes)) - 0.3 * sum(sizes)) <= 2


def test_flight_keeps_expectations():
    sizes = [9, 7, 5, 4, 3, 2, 2, 1]
    runs = [flight([0.25] * 8, sizes, seed) for seed in range(2000)]
    for i in range(8):
        assert sum(r[i] for r in runs) / 2000 == pytest.approx(0.25, abs=0.04)


def test_mix(spark):
    docs = spark.createDataFrame(rows(6000), KIND)
    mix = mix_sources(docs, word_count(F.col("text")), group_rows=200).cache()
    got = mix.collect()
    assert len(got) == 6000
    assert mix.columns == ["doc_id", "source", "size", "source_size", "target", "taken", "copies"]
    sizes = {r[0]: len((r[2] or "").split()) for r in rows(6000)}
    by_source = {}
    for r in got:
        assert r["size"] == sizes[r["doc_id"]] and 0 <= r["copies"] <= 2 and r["taken"] == r["copies"] * r["size"]
        by_source.setdefault(r["source"], []).append(r)
    order = ["a", "b", "é", None]
    total = {s: sum(r["size"] for r in by_source[s]) for s in order}
    targets = water_fill([total[s] for s in order], [5.0, 2.0, 1.0, 5.0], 1.5 * sum(total.values()))
    for s, target in zip(order, targets):
        assert {r["source_size"] for r in by_source[s]} == {total[s]}
        assert all(r["target"] == pytest.approx(target) for r in by_source[s])
        assert abs(sum(r["taken"] for r in by_source[s]) - target) <= 0.003 * target


def test_mix_does_not_depend_on_partitions(spark):
    docs = spark.createDataFrame(rows(900), KIND)
    one = mix_sources(docs.repartition(1), word_count(F.col("text")), group_rows=100)
    two = mix_sources(docs.repartition(7, "text"), word_count(F.col("text")), group_rows=100)
    assert sorted(one.collect(), key=lambda r: r[0]) == sorted(two.collect(), key=lambda r: r[0])


def test_mix_of_nothing_repeats_and_nulls(spark):
    empty = spark.createDataFrame([], KIND)
    assert mix_sources(empty, word_count(F.col("text"))).collect() == []
    same = spark.createDataFrame([(None, None, None, "", ""), (1, "a", "x y", "", ""), (1, "a", "x y", "", "")], KIND)
    got = mix_sources(same, word_count(F.col("text"))).collect()
    assert len(got) == 3
    assert [r["taken"] for r in got if r["source"] is None] == [0]


def test_own_weights(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2], "w " * 10, "", "") for i in range(400)], KIND)
    got = mix_sources(docs, word_count(F.col("text")), {"a": 3.0, "b": 1.0}, share=0.5).groupBy("source").sum("taken")
    assert dict(got.collect()) == {"a": 1500, "b": 500}
