"""Transcript cleaning against known cases and random strings."""

import random
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import text as X
from corpusloom.operators.rows import filter_map, tolerant_rows

CLEANED = [
    ("HELLO <COMMA> WORLD <PERIOD>", "HELLO , WORLD ."),
    ("<SIL>", None),
    ("<SIL> a", None),
    ("a", "a"),
    ("<SIL> abc", "abc"),
    ("<SIL><NOISE>", None),
    ("<SIL> a <NOISE>", "a"),
    ("<SIL> <COMMA>", ","),
    ("<FOO> hi", "<FOO> hi"),
    ("xx<NOISE>y", "xx y"),
    ("x<NOISE>y", None),
    ("<MUSIC>　ab ", None),
    ("a​b", "a​b"),
    ("a\x1c b", "a b"),
    ("<sil> ok <Comma>", "<sil> ok <Comma>"),
    ("", None),
    (None, None),
]


def column(spark, values, name="text"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {name} string")


def mapped(spark, values, expression):
    rows = column(spark, values).select("i", expression(F.col("text")).alias("out")).collect()
    return [r["out"] for r in sorted(rows)]


def test_known_cases(spark):
    assert mapped(spark, [t for t, _ in CLEANED], X.clean_text) == [c for _, c in CLEANED]


def expected(text):
    """The cleaning rule, put as set operations over matches of one pattern."""
    garbage = re.compile(r"<(?:SIL|MUSIC|NOISE|OTHER)>")
    for tag in set(garbage.findall(text)):
        if len("".join(text.split(tag)).strip()) < 3:
            return None
    marks = {"<COMMA>": ",", "<PERIOD>": ".", "<QUESTIONMARK>": "?", "<EXCLAMATIONPOINT>": "!"}
    spelled = re.sub(r"<[A-Z]+>", lambda m: marks.get(m[0], m[0]), text)
    return " ".join(garbage.sub(" ", spelled).split()) or None


def random_texts(n, seed=1):
    draw = random.Random(seed)
    spaces = [chr(c) for c in range(0x3001) if chr(c).isspace()]
    parts = ["<SIL>", "<MUSIC>", "<NOISE>", "<OTHER>", "<COMMA>", "<PERIOD>", "<QUESTIONMARK>"]
    parts += ["<EXCLAMATIONPOINT>", "<FOO>", "<", ">", "a", "bc", "é", "\U0001f600", "​", "﻿", *spaces]
    return ["".join(draw.choices(parts, k=draw.randint(0, 9))) for _ in range(n)]


def test_random_texts(spark):
    texts = random_texts(4000)
    assert mapped(spark, texts, X.clean_text) == [expected(t) for t in texts]
    assert mapped(spark, texts, X.strip_ws) == [t.strip() for t in texts]
    assert mapped(spark, texts, X.collapse_ws) == [" ".join(t.split()) for t in texts]
    assert mapped(spark, texts, X.split_ws) == [t.split() for t in texts]


def test_whitespace_is_that_of_python(spark):
    signs = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(signs) if i < 0x4000 or i % 97 == 0], "i int, text string")
    got = df.select("text", F.rlike("text", F.lit(f"[{X.WHITESPACE}]")).alias("space")).collect()
    assert [r["text"] for r in got if r["space"]] == [r["text"] for r in got if r["text"].isspace()]
    assert sum(r["space"] for r in got) == 29


def test_cleaning_twice_changes_nothing(spark):
    once = [t for t in mapped(spark, random_texts(2000, seed=2), X.clean_text) if t is not None]
    assert mapped(spark, once, X.clean_guarded) == once


def test_guard_wants_both_brackets(spark):
    assert mapped(spark, ["a  < b", "a  <COMMA> b", "a  b"], X.clean_guarded) == ["a  < b", "a , b", "a  b"]


def test_filter_map_replaces_and_drops(spark):
    df = filter_map(column(spark, [t for t, _ in CLEANED]), "text", X.clean_text(F.col("text")))
    assert df.columns == ["i", "text"]
    got = {r["i"]: r["text"] for r in df.collect()}
    assert got == {i: c for i, (_, c) in enumerate(CLEANED) if c is not None}


@pytest.mark.parametrize(
    "text, sentence, by_value", [("a", "b", "a"), ("", "b", "b"), (None, "b", "b"), ("  ", "b", "  "), (None, None, "")]
)
def test_fallbacks(spark, text, sentence, by_value):
    both = spark.createDataFrame([(text, sentence)], "text string, sentence string")
    assert both.select(X.text_by_value(both)).first()[0] == by_value
    assert both.select(X.text_fallback_schema(both)).first()[0] == text
    alone = both.select("sentence")
    assert alone.select(X.text_fallback_schema(alone)).first()[0] == sentence
    assert alone.select(X.text_by_value(alone)).first()[0] == (sentence or "")


def test_tolerant_rows(spark):
    df = spark.createDataFrame([(1, 10), (2, 0), (None, 5), (4, None)], "a int, b int")
    kept, rejected = tolerant_rows(
        df, a=F.col("a").isNotNull(), ratio=F.try_divide(F.col("a"), F.col("b")) < 1, b=F.col("b") > 0
    )
    assert [tuple(r) for r in kept.collect()] == [(1, 10)]
    assert {r["reason"]: r["n"] for r in rejected.collect()} == {"a": 1, "ratio": 2}
