"""Components next to a comparison of all pairs of sets, crowded groups, and odd rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

from corpusloom.llm import components, neardup
from corpusloom.llm.components import connected_components
from corpusloom.llm.neardup import Shingler, near_duplicates, signature
from corpusloom.llm.queries import op8_near_duplicates

KIND = "doc_id long, text string, n_shingles string, node int"


def shingles(text, size):
    words = (text or "").encode().lower().split()
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(zip(*(words[i:] for i in range(size))))


def expected(rows, size, percent):
    """doc_id to (n, component), by comparing every two sets that share a shingle."""
    sets = {}
    for i, text in rows:
        sets.setdefault(i, []).append(shingles(text, size))
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(set)
    for i, all_ in sets.items():
        for s in all_:
            for x in s:
                holders[x].add(i)
    for i, all_ in sets.items():
        for j in {j for s in all_ for x in s for j in holders[x]}:
            if j < i and root(i) != root(j) and any(
                100 * len(a & b) >= percent * len(a | b) for a in all_ for b in sets[j] if a & b
            ):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}


def check(spark, rows, size=3, percent=85):
    df = spark.createDataFrame([(i, t, "clash", 1) for i, t in rows], KIND)
    got = near_duplicates(df, shingle_words=size, percent=percent).collect()
    components = expected(rows, size, percent)
    assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == components
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    texts = dict(rows)
    if len(texts) == len(rows):
        assert all(r["n_shingles"] == len(shingles(texts[r["doc_id"]], size)) for r in got)


def changed(pick, words, times):
    words = list(words)
    for _ in range(times):
        words[pick.randrange(len(words))] = pick.choice("abcdefghij") * 3
    return " ".join(words)


def test_groups_of_copies_and_near_copies(spark):
    pick = random.Random(7)
    rows = []
    for size in [1, 1, 2, 3, 5, 8, 40, 300]:
        base = ["w%d" % pick.randrange(4000) for _ in range(pick.randint(30, 160))]
        rows += [changed(pick, base, pick.randint(0, 4)) for _ in range(size)]
    rows += ["Exact  Copy of\nthis text"] * 50 + ["exact copy OF this text"] * 3
    rows += [" ".join("r%d" % pick.randrange(900) for _ in range(60)) for _ in range(150)]
    pick.shuffle(rows)
    check(spark, list(enumerate(rows)))


def test_one_crowded_group(spark):
    pick = random.Random(8)
    base = ["w%d" % i for i in range(120)]
    rows = [changed(pick, base, pick.randint(1, 2)) for _ in range(700)]
    check(spark, list(enumerate(rows)))


def form_letters(count, seed):
    """Letters of one form, most pairs of which lie just below the threshold, and a few links just above it."""
    pick = random.Random(seed)
    base = ["w%d" % i for i in range(300)]
    rows = [list(base) for _ in range(count)]
    for row in rows:
        for place in pick.sample(range(300), 5):
            row[place] = "x%d" % pick.randrange(10**6)
    for i in range(0, count, 8):  # a copy with changes of its own, so that it is a little nearer to one letter
        rows.append(list(rows[i]))
        for place in pick.sample(range(300), 8):
            rows[-1][place] = "y%d" % pick.randrange(10**6)
    pick.shuffle(rows)
    return list(enumerate(" ".join(row) for row in rows))


@pytest.mark.parametrize("window, neighbours", [(64, 1), (2, 1)])
def test_links_among_form_letters_are_found_whatever_the_window(spark, monkeypatch, window, neighbours):
    monkeypatch.setattr(neardup, "WINDOW", window)
    monkeypatch.setattr(neardup, "NEIGHBOURS", neighbours)
    check(spark, form_letters(80, 12))


@pytest.mark.parametrize("crossing, block", [(20, 16), (1000, 16)])
def test_deep_prefixes_and_blocks(spark, monkeypatch, crossing, block):
    monkeypatch.setattr(neardup, "CROSSING", crossing)
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block)
    monkeypatch.setattr(neardup, "HELD_PAIRS", 100)
    monkeypatch.setattr(neardup, "WINDOW", 1)
    check(spark, form_letters(80, 12))


def test_many_form_letters(spark):
    check(spark, form_letters(450, 3))


def test_texts_of_one_id_in_a_crowded_group(spark, monkeypatch):
    monkeypatch.setattr(neardup, "NEIGHBOURS", 1)
    rows = form_letters(60, 5)
    check(spark, [*rows, *((i, text) for (i, _), (_, text) in zip(rows[:6], rows[10:]))])


def test_pairs_that_are_linked_by_now_are_not_looked_up_among_tried_ones(spark, monkeypatch):
    frame, counts = type(spark.range(0)), {"asked": 0, "candidates": 0}
    join, write = frame.join, neardup.write_through

    def counted_join(self, other, on=None, how=None):
        counts["asked"] += self.count() if how == "left_anti" else 0
        return join(self, other, on, how)

    def counted_write(df, name):
        out = write(df, name)
        counts["candidates"] += out.where("b is not null").count() if name.endswith("candidates") else 0
        return out

    monkeypatch.setattr(frame, "join", counted_join)
    monkeypatch.setattr(neardup, "write_through", counted_write)
    pick = random.Random(5)
    words = [f"w{pick.randrange(5000)}" for _ in range(400)]
    check(spark, [(i, changed(pick, words, 1)) for i in range(150)])
    assert counts["candidates"] > 300 > counts["asked"]


def test_default_is_five_words_and_four_fifths(spark):
    pick = random.Random(9)
    base = ["w%d" % i for i in range(200)]
    rows = [changed(pick, base, k % 6) for k in range(40)] + ["a b c d", "a b c d", "a b c e"]
    df = spark.createDataFrame([(i, t, "", 0) for i, t in enumerate(rows)], KIND)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df).collect()}
    assert got == expected(list(enumerate(rows)), 5, 80)


def test_odd_rows(spark):
    rows = [(5, None), (4, ""), (3, " \n"), (2, "a"), (1, "A"), (9, "a b"), (8, "a\tB"), (7, "a b"), (10, "x " * 100_000), (11, "X " * 90_000), (12, "é É")]
    check(spark, rows)
    check(spark, [])


def test_repeated_and_missing_ids(spark):
    long = " ".join("w%d" % i for i in range(50))
    rows = [(1, long), (1, "other words that stand alone here"), (2, "other words that stand alone here"), (3, long), (3, long)]
    check(spark, rows)
    df = spark.createDataFrame([(None, long, "", 0), (None, "nothing like it", "", 0), (4, long, "", 0)], KIND)
    got = {(r["doc_id"], r["component_id"], r["kept"]) for r in near_duplicates(df).collect()}
    assert got == {(None, 4, False), (None, None, True), (4, 4, True)}


def test_query_equals_all_pairs(spark, small):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    got = op8_near_duplicates(spark, small).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == expected(rows, 3, 85)


def test_signatures_estimate_similarity():
    shingler = Shingler(1)
    a = shingler.shingles(" ".join("w%d" % i for i in range(1000)))
    b = shingler.shingles(" ".join("w%d" % i for i in range(100, 1000)))
    assert np.mean(signature(a) == signature(b)) == pytest.approx(0.9, abs=0.1)
    assert len(shingler.shingles("")) == 0 and Shingler(3).shingles("A b").tolist() == Shingler(3).shingles("a B ").tolist()


@pytest.mark.parametrize("seed, most", [(0, 500_000), (1, 60), (2, 200)])
def test_components(spark, monkeypatch, seed, most):
    monkeypatch.setattr(components, "LINKS_PER_TASK", most)
    pick = random.Random(seed)
    links = [(pick.randrange(300), pick.randrange(300)) for _ in range(170)]
    links += [(1000 + i, 1001 + i) for i in range(200)] + [(2000, 2001 + i) for i in range(300)] + [(None, 1), (5, 5)] + links[:9]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in links:
        if u is not None and u != v:
            a, b = root(u), root(v)
            parent[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    got = {r["node"]: r["component"] for r in connected_components(df, "a", "b").collect()}
    assert got == {x: root(x) for x in parent if root(x) != x}
    assert connected_components(df.where("false"), "a", "b").collect() == []
