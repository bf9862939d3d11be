"""The prefix trie next to a walk over every prefix."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpusloom.llm.queries import op11_prefix_trie
from corpusloom.llm.trie import list_digests, prefix_trie, turn_rows


def slow_trie(sequences):
    """{(conv_id, depth): (parent, n_convs, n_children, n_leaves, saved_tokens, ends)} of {conv: [(role, text)]}."""
    members = {}
    for conv, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(conv)
    result = {}
    for prefix, convs in members.items():
        subtree = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in subtree if len(p) == len(prefix) + 1]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in subtree) for p in subtree)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode().split()) for p in subtree if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(sequences[c]) == len(prefix))))
        parent = min(members[prefix[:-1]]) if prefix else None
        result[min(convs), len(prefix)] = (parent, len(convs), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return result


def rebuilt(table):
    """Conversations with the start of another one, as the query has them."""
    turns = {}
    for conv, turn, role, text in sorted((r for r in table if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        turns.setdefault(conv, []).append((role or "", text or ""))
    result = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        result[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    return result


def found(df):
    names = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = df.collect()
    got = {(r["conv_id"], r["depth"]): tuple(r[n] for n in names) for r in rows}
    assert len(got) == len(rows)
    return got


def trie_of(spark, table):
    turns = turn_rows(spark.createDataFrame(table, "conv_id long, turn long, role string, text string"))
    return found(prefix_trie(turns, turns.select("conv").distinct()))


@pytest.mark.parametrize("seed", range(3))
def test_random_sequences(spark, seed):
    rng = random.Random(seed)
    table = []
    for conv in rng.sample(range(1000), 60):
        start = rng.randrange(3)
        length = rng.choice([1, 2, 3, 5, 8, 9, 17])
        table += [(conv, t, "user", f"turn {t} {start if t < 4 else rng.randrange(2)}" + " more" * (t % 3)) for t in range(length)]
    expected = {}
    for conv, turn, role, text in table:
        expected.setdefault(conv, []).append((role, text))
    assert trie_of(spark, table) == slow_trie(expected)


def test_one_long_conversation_and_many_copies(spark):
    table = [(5, t, "user", f"t{t % 7}") for t in range(70)] + [(c, t, "user", f"t{t}") for c in range(10, 60) for t in range(3)]
    expected = {}
    for conv, turn, role, text in table:
        expected.setdefault(conv, []).append((role, text))
    assert trie_of(spark, table) == slow_trie(expected)


def test_role_and_text_are_kept_apart(spark):
    table = [(1, 0, "a", "bc"), (2, 0, "ab", "c"), (3, 0, None, "abc"), (4, 0, "", "abc")]
    assert {d for _, d in trie_of(spark, table)} == {0, 1} and len(trie_of(spark, table)) == 4


def test_conversations_without_turns(spark):
    turns = turn_rows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))
    convs = spark.createDataFrame([(4,), (2,)], "conv long")
    assert found(prefix_trie(turns, convs)) == slow_trie({4: [], 2: []})
    assert found(prefix_trie(turns, convs.limit(0))) == {}


def test_digests_of_long_lists(spark, monkeypatch):
    rows = spark.range(30_000).select(F.when(F.col("id") % 100 < 90, F.lit(b"hot")).otherwise(F.lit(b"cold")).alias("k"), "id")
    got = {r["conv"]: r["ends_sha256"] for r in list_digests(rows, "k", "id").collect()}
    lists = ([i for i in range(30_000) if (i % 100 < 90) == hot] for hot in (True, False))
    assert got == {v[0]: hashlib.sha256(",".join(map(str, v)).encode()).hexdigest() for v in lists}


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(9)
    table = [(c, t if t else None, rng.choice(["user", None]), rng.choice(["hello there", "", None, "x y z"])) for c in range(-3, 90) for t in range(rng.randrange(1, 7))]
    table = [r for r in table if r[0] not in (20, 40)] + [(None, 0, "user", "no conversation")]
    frame = spark.createDataFrame(table, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(1)).withColumn("pos", F.lit("x"))
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    assert found(op11_prefix_trie(spark, str(tmp_path))) == slow_trie(rebuilt(table))
