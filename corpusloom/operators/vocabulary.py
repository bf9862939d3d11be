"""Word-level vocabulary: build, extend, encode, decode."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.text import split_ws
from corpusloom.operators import lookup
from corpusloom.operators.lookup import COUNTED_KEYS, frequent_keys, lookup_join
from corpusloom.operators.ordinal import ordinal
from corpusloom.operators.rowlookup import MOST_TEXT_BYTES, filtered, lookup_rows, split_texts
from corpusloom.operators.rows import pieces
from corpusloom.session import write_through

# The audio tokens and the padding token a vocabulary needs.
AUDIO_TOKENS = ("<|audio_start|>", "<|audio_end|>", "<|audio_pad|>", "<|audio_sep|>", "<|audio_chunk|>")
MARKER_TOKEN = "<|audio_chunk|>"
PAD_TOKEN = "[PAD]"

# Bytes a token in the broadcast part of a lookup may have: the first number for any of them, the
# second divided by its rank if that is more. Over all ranks this stays below the lookup's limit.
HEAD_TOKEN_BYTES = 64
HEAD_RANK_BYTES = 4 * 1024 * 1024

# A lookup within rows has so many times the ranks in its head, as Arrow arrays; they stay below the same limit.
ROW_HEADS = 5


def _text_counts(df: DataFrame, text: str) -> DataFrame:
    """``(token, uses)`` of the words of texts, split and counted in Arrow batches first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0)
            for low, high in pieces(texts, MOST_TEXT_BYTES):
                counts = split_texts(texts.slice(low, high - low))[1].value_counts()
                yield pa.RecordBatch.from_arrays(counts.flatten(), ["token", "uses"])

    counted = df.select(F.make_valid_utf8(text).alias("text")).mapInArrow(count, "token string, uses bigint")
    return counted.groupBy("token").agg(F.sum("uses").alias("uses"))


def vocab_build(df: DataFrame, words: str) -> DataFrame:
    """``(token, id, uses)``; ids run from 0 by falling use, then by token. ``words`` is an array, or a text that is split as by ``split_ws``."""
    if isinstance(df.schema[words].dataType, T.StringType):
        counts = _text_counts(df, words)
    else:
        # The inner explode would come with a filter that splits every text a second time.
        tokens = df.select(F.explode_outer(words).alias("token")).where(F.col("token").isNotNull())
        counts = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    ranked = ordinal(counts, [F.desc("uses"), F.col("token")], out="id")
    return ranked.select("token", (F.col("id") - 1).alias("id"), "uses")


def new_tokens(vocab: DataFrame, tokens: Sequence[str]) -> list[tuple[str, int]]:
    """Those of ``tokens`` the vocabulary lacks, with the ids they get."""
    known, last = (
        vocab.agg(
            F.collect_set(F.when(F.col("token").isin(*tokens), F.col("token"))).alias("known"),
            F.coalesce(F.max("id"), F.lit(-1)).alias("last"),
        )
        .first()
    )
    missing = [token for token in dict.fromkeys(tokens) if token not in known]
    return [(token, last + 1 + i) for i, token in enumerate(missing)]


def add_tokens(vocab: DataFrame, tokens: Sequence[str] = AUDIO_TOKENS) -> tuple[DataFrame, int]:
    """The vocabulary with the missing tokens at its end, and how many were added."""
    added = new_tokens(vocab, tokens)
    if not added:
        return vocab, 0
    rows = vocab.sparkSession.createDataFrame(pa.table(list(zip(*added)), names=["token", "id"]))
    return vocab.unionByName(rows, allowMissingColumns=True), len(added)


def token_lookup(
    df: DataFrame, vocab: DataFrame, token: str = "token", ranked: bool = True, unk_id: int | None = None
) -> DataFrame:
    """Add the id of a token; NULL, or ``unk_id``, if the vocabulary does not have it. ``ranked`` is as for ``encode_ids``."""
    entries = vocab.select(F.col("token").alias("_key"), "id")
    keyed = df.withColumn("_key", F.col(token))
    found = _looked_up(keyed, entries, "_key", "_key", ranked)
    return found.withColumn("id", _known(token, unk_id)) if unk_id is not None else found


def _known(token: str, unk_id: int) -> Column:
    return F.when(F.col(token).isNotNull(), F.coalesce("id", F.lit(unk_id).cast("bigint")))


def _head(entries: DataFrame, token: str, used: Sequence[str] = (), heads: int = 1) -> DataFrame:
    """The most used tokens; only one that is long for its rank is left out.

    Special tokens come last in a vocabulary but may be in every sequence, so they belong here
    as well, like the tokens of ``used``.
    """
    most = F.greatest(F.lit(HEAD_TOKEN_BYTES), F.lit(HEAD_RANK_BYTES) / (F.col("id") + 1))
    ranked = (F.col("id") < heads * lookup.HEAD_ROWS) & (F.octet_length(token) <= most)
    return entries.where(ranked | F.col(token).isin(*AUDIO_TOKENS, PAD_TOKEN, *used))


def _looked_up(
    facts: DataFrame, entries: DataFrame, on: str, token: str, ranked: bool, used: Sequence[str] = ()
) -> DataFrame:
    """``lookup_join`` with the head that ranks give, or with the keys that are counted to be frequent."""
    if ranked:
        return lookup_join(facts, entries, on, _head(entries, token, used))
    facts = write_through(facts, "facts")
    frequent = write_through(frequent_keys(facts, on, COUNTED_KEYS), "used")
    return lookup_join(facts, entries, on, entries.join(F.broadcast(frequent), on, "left_semi"))


def _row_head(df: DataFrame, values: str, entries: DataFrame, on: str, token: str, ranked: bool, used: Sequence[str] = ()) -> DataFrame:
    """The head that ranks give, or the entries of the keys that are counted to be frequent."""
    if ranked:
        return _head(entries, token, used, ROW_HEADS)
    text = isinstance(df.schema[values].dataType, T.StringType)
    elements = F.explode_outer(split_ws(F.col(values)) if text else values)
    frequent = frequent_keys(df.select(elements.alias(on)), on, COUNTED_KEYS)
    return entries.join(F.broadcast(write_through(frequent, "used")), on, "left_semi")


def encode_ids(
    df: DataFrame,
    keys: Sequence[str],
    words: str,
    vocab: DataFrame,
    out: str = "ids",
    used: Sequence[str] = (),
    ranked: bool = True,
    unk_id: int | None = None,
) -> DataFrame:
    """``(keys, ids)``: each row's words as ids, in order; an unknown word has a NULL id, or ``unk_id``.

    ``words`` is an array, or a text that is split as by ``split_ws``, in the batches in which its words are looked up. With ``ranked``, ids are ranks by use, as ``vocab_build`` gives them, so the small ones cover
    most of a text and are looked up without a shuffle; ``used`` names words that are frequent
    here whatever their rank, such as those of a prompt. Else the frequent words are counted first.
    """
    entries = vocab.select("token", "id")
    head = _row_head(df, words, entries, "token", "token", ranked, used)
    found = lookup_rows(df, keys, words, entries, "token", "id", head, out)
    if unk_id is not None:
        found = found.withColumn(out, F.transform(out, lambda x: F.coalesce(x, F.lit(unk_id).cast("bigint"))))
    return found


def decode_ids(
    df: DataFrame,
    keys: Sequence[str],
    ids: str,
    vocab: DataFrame,
    skip: Sequence[str] = (),
    out: str = "text",
    ranked: bool = True,
    unk_token: str | None = None,
) -> DataFrame:
    """``(keys, text)``: ids back to words joined by spaces; ids of ``skip`` tokens leave none.

    An unknown id leaves none either, or ``unk_token``. ``ranked`` is as for ``encode_ids``.
    """
    entries = vocab.select("id", "token")
    head = _row_head(df, ids, entries, "id", "token", ranked, skip)

    def joined(tokens: pa.ListArray) -> pa.Array:
        flat = tokens.values if unk_token is None else pc.fill_null(tokens.values, unk_token)
        keep = pc.and_(pc.is_valid(flat), pc.invert(pc.is_in(flat, value_set=pa.array(skip, flat.type))))
        offsets, flat = filtered(tokens.offsets.to_numpy(), flat, keep.to_numpy(zero_copy_only=False))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), flat), " ")

    return lookup_rows(df, keys, ids, entries, "id", "token", head, out, joined, T.StringType())
