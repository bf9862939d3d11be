"""Subword training next to one merge after another in plain Python."""

from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from corpusloom.functions.text import split_ws
from corpusloom.operators import subwords as B


def plain_trainer(counts, n, least=2):
    words = {w: [B.WORD_START + w[0], *w[1:]] for w in counts}
    merges = []
    while len(merges) < n:
        pairs = Counter()
        for w, symbols in words.items():
            for p in zip(symbols, symbols[1:]):
                pairs[p] += counts[w]
        if not pairs:
            break
        best, uses = min(pairs.items(), key=lambda x: (-x[1], x[0]))
        if uses < least:
            break
        merges.append((*best, uses))
        words = {w: B.merged(s, best) for w, s in words.items()}
    return merges


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, uses long")


def rounds_of(counts, n):
    """What training does, with all tables in memory, to test the choice of merges by itself."""
    merges, known = [], {c for w in counts for c in [B.WORD_START + w[0], *w[1:]]}
    while len(merges) < n:
        ranks = {(a, b): r for r, (a, b, _) in enumerate(merges)}
        pairs = Counter()
        for w, uses in counts.items():
            symbols = B.cut(w, ranks)
            for p in zip(symbols, symbols[1:]):
                pairs[p] += uses
        seen = sorted(((a, b, n) for (a, b), n in pairs.items() if n >= 2), key=lambda x: (-x[2], x[:2]))
        batch = B.independent(seen[:20], len(seen) <= 20, known)
        if not batch:
            break
        merges += seen[: len(batch)]
        known |= {a + b for a, b in batch}
    return merges[:n]


@settings(max_examples=300, deadline=None)
@given(st.dictionaries(st.text("abcd", min_size=1, max_size=7), st.integers(1, 9), min_size=1, max_size=14))
def test_batches_are_single_merges(counts):
    assert rounds_of(counts, 30) == plain_trainer(counts, 30)


def test_training_equals_the_plain_trainer(spark, small, monkeypatch):
    monkeypatch.setattr(B, "COMPACT_ROUNDS", 4)
    words = spark.read.parquet(f"{small}/documents.parquet").select(split_ws(F.col("text")).alias("words"))
    counts = B.word_counts(words, "words")
    merges = B.train_merges(counts, 30)
    assert merges == plain_trainer({r["word"]: r["uses"] for r in counts.collect()}, 30) and len(merges) == 30


def test_training_ends_without_pairs(spark):
    assert B.train_merges(frame(spark, {"a": 5, "b": 1}), 10) == []
    assert B.train_merges(frame(spark, {}), 10) == []
    assert B.train_merges(frame(spark, {"ab": 1}), 10) == []
    assert B.train_merges(frame(spark, {"aaaa": 2, "": 9}), 10) == plain_trainer({"aaaa": 2}, 10)


def test_no_documents_are_read_after_the_count(spark, tmp_path):
    counts = frame(spark, {"low": 5, "lower": 2, "newest": 6, "widest": 3})
    merges = B.train_merges(counts, 8)
    assert merges[:3] == [("e", "s", 9), ("es", "t", 9), ("l", "o", 7)] or merges == plain_trainer({"low": 5, "lower": 2, "newest": 6, "widest": 3}, 8)


def test_round_trip_and_ids(spark):
    counts = {"hello": 4, "help": 3, "é": 2}
    merges = plain_trainer(counts, 6)
    rows = spark.createDataFrame([(1, ["hello", "help", "new"]), (2, []), (3, None), (4, ["", None, "é"])], "id long, words array<string>")
    cut = rows.withColumn("tokens", B.subword_tokens(F.col("words"), merges))
    texts = {r["id"]: r["text"] for r in cut.select("id", B.subword_text(F.col("tokens")).alias("text")).collect()}
    assert texts == {1: "hello help new", 2: "", 3: None, 4: "é"}
    vocab = B.subword_vocab(frame(spark, counts), merges)
    tokens = {r["id"]: r["token"] for r in vocab.collect()}
    assert sorted(tokens) == list(range(len(tokens))) and len(set(tokens.values())) == len(tokens)
    ids = {r["id"]: r["ids"] for r in B.subword_ids(cut, ["id"], "tokens", vocab, unk_id=-1).collect()}
    assert "".join(tokens[i] for i in ids[1][:2])[1:].startswith("hello") and -1 in ids[1] and ids[2] == ids[3] == [] and tokens[ids[4][0]] == "▁é"


@pytest.mark.parametrize("n", [1, 2, 3])
def test_fewer_merges_are_a_prefix(spark, n):
    counts = {"banana": 3, "bandana": 2, "ban": 5}
    assert B.train_merges(frame(spark, counts), n) == plain_trainer(counts, 9)[:n]


def test_cutting_goes_piece_by_piece(monkeypatch):
    """A batch is cut in pieces of few words, so a task never holds the subwords of all of its rows."""
    import pyarrow as pa

    from corpusloom.operators import rows

    column = pa.array([["ab"] * 5, None, [], ["c", None, ""], ["ab"] * 30, ["d"]])
    assert list(rows.pieces(column, 8)) == [(0, 4), (4, 5), (5, 6)]
    monkeypatch.setattr(B, "WORDS_AT_ONCE", 8)
    cutter = B._cutter([("▁a", "b", 2)])
    made = list(cutter.func(iter([column])))
    assert [len(part) for part in made] == [4, 1, 1]
    assert sum((part.to_pylist() for part in made), []) == [["▁ab"] * 5, None, [], ["▁c"], ["▁ab"] * 30, ["▁d"]]


def test_first_pairs_are_counted_without_cutting_each_word(monkeypatch):
    """All characters, words of one character, repeated pairs and many words at once, next to a loop over words."""
    words = ["a", "ab", "aaaa", "abab", "▁▁", "é\U0010ffffé\U0010ffff", "\x00\x00b", "", *(f"w{i % 7}{i}" for i in range(40))]
    uses = list(range(1, len(words) + 1))
    expected = []
    for word, n in zip(words, uses):
        symbols = B.cut(word, {}) if word else []
        expected += [(left, right, word, n, c) for (left, right), c in Counter(zip(symbols, symbols[1:])).items()]

    def no_cut(*_):
        raise AssertionError("a word was cut")

    monkeypatch.setattr(B, "cut", no_cut)
    monkeypatch.setattr(B, "WORDS_AT_ONCE", 11)
    change, _ = B._first_pairs()
    batches = [pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(uses, pa.int64())], names=["word", "uses"]).slice(i, 30) for i in (0, 30)]
    batches.append(batches[0].slice(0, 0))
    got = [tuple(r.values()) for b in change(iter(batches)) for r in b.to_pylist()]
    assert sorted(got) == sorted(expected) and len(got) > 100
