"""Periodic runs next to a search of every period."""

import hashlib
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.llm.queries import op12_periodic_runs
from corpusloom.llm.runs import LEAST_LENGTH, extensions, find_runs, periodic_runs, recompress


def slow_runs(words):
    """By start, then period; each stretch with its smallest period."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(LEAST_LENGTH, 2 * q):
                found.setdefault((start, length), q)
            i += i == start
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def fast_runs(texts):
    return [[tuple(r) for r in runs.tolist()] for runs in find_runs([np.array(t, dtype=np.int64) for t in texts])]


cyclic = st.tuples(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 2), min_size=1, max_size=12), st.integers(1, 12)).map(
    lambda x: x[0] + x[1] * x[2] + x[0][::-1]
)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.lists(st.integers(0, 1), max_size=90), st.lists(st.integers(0, 9), max_size=90), cyclic), max_size=6))
def test_any_sequences(texts):
    assert fast_runs(texts) == [slow_runs(t) for t in texts]


def test_nested_runs():
    fibonacci = [[0], [0, 1]]
    while len(fibonacci[-1]) < 300:
        fibonacci.append(fibonacci[-1] + fibonacci[-2])
    inner = ([0] * 13 + [1]) * 3
    texts = [fibonacci[-1], inner * 2 + [5], [7] * 500, [0, 1] * 6, [0] * 11, [0] * 12, list(range(40)) * 2, []]
    assert fast_runs(texts) == [slow_runs(t) for t in texts]


def test_long_periods_and_one_word_texts():
    words = list(range(5000)) * 2 + [1]
    assert fast_runs([words, [3] * 200_000]) == [[(0, 10_000, 5000)], [(0, 200_000, 1)]]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=2, max_size=120), st.data())
def test_grammar_gives_exact_extensions(words, data):
    g = recompress(np.array(words, dtype=np.int64))
    i = data.draw(st.integers(0, len(words) - 2))
    j = data.draw(st.integers(i + 1, len(words) - 1))
    ahead = next((k for k in range(len(words) - j) if words[i + k] != words[j + k]), len(words) - j)
    back = next((k for k in range(i + 1) if words[i - k] != words[j - k]), i + 1)
    one = np.array([1])
    assert extensions(g, i + one, j + one, True).tolist() == [ahead]
    assert extensions(g, i + one, j + one, False).tolist() == [back]


def test_grammar_is_small_and_levels_shrink():
    g = recompress(np.random.default_rng(1).integers(0, 2000, 50_000))
    assert len(g.symbol) < 8 * 50_000
    assert len(recompress(np.zeros(50_000, dtype=np.int64)).symbol) < 50_000 + 10


def test_column(spark):
    rows = [(1, "a b " * 10 + "c"), (2, None), (3, " \n"), (4, "x y"), (1, "a b " * 10 + "c")]
    got = spark.createDataFrame(rows, "id long, text string").select("id", periodic_runs(F.col("text")).alias("found")).collect()
    runs = {(r["id"], r["found"]["n_words"], tuple(map(tuple, r["found"]["runs"])), r["found"]["collapsed"]) for r in got}
    assert runs == {(1, 21, ((0, 20, 2),), "a b c"), (2, 0, (), ""), (3, 0, (), ""), (4, 2, (), "x y")} and len(got) == 5


def slow_answer(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        n, g = len(words), h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = slow_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    return (
        len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
        hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest(),
    )


def test_query_equals_every_period(spark, tmp_path):
    rng = np.random.default_rng(3)
    texts = [" ".join(map(str, rng.integers(0, rng.choice([2, 5, 300]), rng.integers(0, 250)))) for _ in range(300)]
    texts += [None, "", "é " * 30, "a\x1cb\x85c " * 20]
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {i: slow_answer(i, t) for i, t in rows}
