"""Token counts next to those of the library whose files they are."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")

from corpusloom.llm.queries import op3_token_counts  # noqa: E402
from corpusloom.llm.tokens import MergeTable, PieceCounter, count_symbols  # noqa: E402

PATH = public_tokenizers.path("byte_bpe_50k.json")
TABLE = MergeTable(PATH)
LIBRARY = tokenizers.Tokenizer.from_file(PATH)


def expected(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_fixed_texts():
    texts = [
        "", "a", "a" * 5000, "ab" * 3000, "<|endoftext|>", "x<|endoftext|><|endoftext|> y", "  \n\n  a\t\t b  ", "\x1c\x85 　 ²³Ⅷ½ ٣ª ǅ",
        "日本語のテキスト", "👍🏽👍", "don't I'LL we're", "\x00 \x1f a", " ", "\n", "œuvre naïve", "1234567890" * 50,
    ]
    assert PieceCounter(TABLE).count(texts) == expected(texts)


def test_characters_of_all_kinds():
    texts = [f"{chr(c)}a {chr(c)}{chr(c)} 1{chr(c)}" for c in [*range(0, 0x2100), *range(0x2100, 0xD800, 11), *range(0xE000, 0x20000, 17)]]
    assert PieceCounter(TABLE).count(texts) == expected(texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=8))
def test_any_text(texts):
    assert PieceCounter(TABLE).count(texts) == expected(texts)


def test_bound_on_kept_pieces_changes_nothing():
    pick = random.Random(2)
    texts = [" ".join("".join(pick.choices("abcde é", k=6)) for _ in range(40)) for _ in range(30)]
    small = PieceCounter(TABLE, kept=10)
    assert [small.count([t])[0] for t in texts] == expected(texts)


def test_merging_of_nothing():
    assert count_symbols([], TABLE).tolist() == [] and count_symbols([b""], TABLE).tolist() == [0]


def test_query(spark, small):
    docs = {r[0]: r[1] or "" for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()}
    counts = dict(zip(docs, expected(list(docs.values()))))
    got = op3_token_counts(spark, small).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r["n_tokens"] == counts[r["doc_id"]] and r["over_limit"] == (r["n_tokens"] > 512)
        assert r["n_bytes"] == len(docs[r["doc_id"]].encode())
