"""Subword vocabularies by byte-pair merges, trained on a table of word counts.

Training keeps two tables. The index says which words have a pair of neighbouring symbols; the counts say how often
each pair is used. A round takes the most used pairs, finds the words that have them in the index, and
appends what changes for those words to the index and the counts: pairs that go as negative numbers, new ones as
positive. A word that a round does not touch is not read, and documents are read for their word counts only. How a word is cut follows from
the merges so far, so no table of cut words is kept.

A round makes several merges at once where they are certain to be those of one merge after another, see ``independent``.
"""

from __future__ import annotations

import functools
from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.lookup import regroup
from corpusloom.operators.rows import pieces
from corpusloom.session import fresh_path, write_through

# Fixed value: stands before the first symbol of a word.
WORD_START = "▁"

# Pairs that the driver sees in a round, and words of one task whose cuts are kept, none of them longer than that.
SEEN_PAIRS, KEPT_WORDS, KEPT_LENGTH = 1000, 100_000, 64
# Words that a task cuts at once.
WORDS_AT_ONCE = 100_000
# Folders of the index, by pair, and rounds after which its parts are put together.
INDEX_FOLDERS, COMPACT_ROUNDS = 16, 32

Pair = tuple[str, str]

_CHANGE_KIND = pa.schema([("left", pa.string()), ("right", pa.string()), ("word", pa.string()), ("uses", pa.int64()), ("n", pa.int64())])
_CHANGE_COLUMNS = "left string, right string, word string, uses bigint, n bigint"


def merged(symbols: list[str], pair: Pair) -> list[str]:
    """All occurrences of the pair joined, from left to right."""
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
            out.append(symbols[i] + symbols[i + 1])
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def cut(word: str, ranks: dict[Pair, int]) -> list[str]:
    """The symbols of a word: the earliest merge that applies goes first, until none does."""
    symbols = [WORD_START + word[:1], *word[1:]]
    while len(symbols) > 1:
        known = [p for p in zip(symbols, symbols[1:]) if p in ranks]
        if not known:
            break
        symbols = merged(symbols, min(known, key=ranks.__getitem__))
    return symbols


def independent(seen: Sequence[tuple[str, str, int]], whole: bool, known: set[str]) -> list[Pair]:
    """The first of ``seen`` (left, right, uses; most used first, then by symbols) that may be merged at once.

    They are what single merges would take one after another. A merge changes only pairs that share a symbol with it, and a
    pair that it makes is used no more than the pair it takes the place of. So as long as no pair that is used as often
    as the next one shares a symbol with those taken, the next one's place is certain. A merge that makes
    a symbol there is already ends the round, as it adds to pairs that are not new. ``whole`` says that there are no other pairs;
    else those that are used as often as the last one seen may be incomplete.
    """
    floor = 0 if whole or not seen else seen[-1][2]
    taken: list[Pair] = []
    symbols: set[str] = set()
    for i, (left, right, uses) in enumerate(seen):
        if taken:
            if uses <= floor:
                break
            ties = (p for p in seen[len(taken) :] if p[2] >= uses)
            if any(p[0] in symbols or p[1] in symbols for p in ties):
                break
        taken.append((left, right))
        symbols |= {left, right}
        made = left + right
        if made in known or made in symbols:
            break
        symbols.add(made)
    return taken


def _folder() -> Column:
    return F.pmod(F.xxhash64("left", "right"), F.lit(INDEX_FOLDERS)).cast("int")


def _first_pairs():
    """For words (word, uses) how often each pair of neighbouring characters is in them: ``_changes`` for no merges, without a loop over words.

    A pair is a number: the word's place, the left character with a mark for the first one of a word, and the right one.
    """
    right_bits, left_bits, most, names = 21, 22, WORDS_AT_ONCE, _CHANGE_KIND.names

    def symbols(codes: np.ndarray) -> pa.Array:
        """Characters as texts, each distinct one made once."""
        distinct, at = np.unique(codes, return_inverse=True)
        texts = [WORD_START * (c >> right_bits) + chr(c & ((1 << right_bits) - 1)) for c in distinct.tolist()]
        return pa.array(texts, pa.string()).take(pa.array(at))

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), most):
                words, uses = batch.column(0).slice(low, most), batch.column(1).slice(low, most)
                texts = words.to_pylist()
                lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
                codes = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
                row = np.repeat(np.arange(len(texts)), lengths)
                codes[(np.cumsum(lengths) - lengths)[lengths > 0]] |= 1 << right_bits
                at = np.flatnonzero(row[1:] == row[:-1])
                pairs = (row[at] << (left_bits + right_bits)) | (codes[at] << right_bits) | codes[at + 1]
                pairs, n = np.unique(pairs, return_counts=True)
                place = pa.array(pairs >> (left_bits + right_bits))
                left, right = (pairs >> right_bits) & ((1 << left_bits) - 1), pairs & ((1 << right_bits) - 1)
                yield pa.RecordBatch.from_arrays([symbols(left), symbols(right), words.take(place), uses.take(place), pa.array(n, pa.int64())], names=names)

    return change, _CHANGE_COLUMNS


def _changes(before: dict[Pair, int], after: dict[Pair, int]):
    """For words (word, uses) how often each pair is more or less in them with other merges."""
    kind = _CHANGE_KIND

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for word, uses in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = cut(word, after)
                change = Counter(zip(new, new[1:]))
                old = cut(word, before)
                change.subtract(Counter(zip(old, old[1:])))
                rows += [(left, right, word, uses, n) for (left, right), n in change.items() if n]
            columns = list(zip(*rows)) or [[]] * len(kind)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)

    return change, _CHANGE_COLUMNS


def word_counts(df: DataFrame, words: str) -> DataFrame:
    """``(word, uses)`` of an array column; empty and missing words are none."""
    tokens = df.select(F.explode_outer(words).alias("word")).where("word <> ''")
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("uses"))


def pair_counts(counts: DataFrame) -> DataFrame:
    """``(left, right, uses)`` of neighbouring characters before any merge."""
    change, kind = _first_pairs()
    pairs = counts.select("word", "uses").mapInArrow(change, kind)
    return pairs.groupBy("left", "right").agg(F.sum(F.col("n") * F.col("uses")).alias("uses"))


def train_merges(counts: DataFrame, n_merges: int, least_uses: int = 2) -> list[tuple[str, str, int]]:
    """The merges (left, right, uses when merged) in their order, at most ``n_merges``, of words ``(word, uses)``.

    The most used pair is merged first; of equal ones that of the smaller left, then right symbol. Pairs used less than
    ``least_uses`` times are not merged. Merges are what the vocabulary consists of, so the driver holds them
    all; pairs and words stay in tables, and each round's part of them is written before the next begins.
    """
    spark = counts.sparkSession
    path = fresh_path(spark, "subword-index")
    columns = "left string, right string, word string, uses bigint, n bigint, part int, folder int"
    words = write_through(counts.where("word <> '' and uses > 0").select("word", F.col("uses").cast("bigint").alias("uses")), "words")
    known = {r[0] for r in _characters(words).collect()}

    def store(changes: DataFrame, part: int) -> DataFrame:
        placed = changes.withColumn("folder", _folder()).repartition("folder")
        placed.write.partitionBy("folder").parquet(f"{path}/part={part}")
        return index(part, part)

    def index(low: int, high: int) -> DataFrame:
        return spark.read.schema(columns).parquet(path).where(F.col("part").between(low, high))

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy("left", "right").agg(F.sum(F.col("n") * F.col("uses")).alias("uses"))

    change, kind = _first_pairs()
    merges: list[tuple[str, str, int]] = []
    first, part = 0, 0
    pairs = write_through(totals(store(words.mapInArrow(change, kind), part)), "pairs")
    while len(merges) < n_merges:
        top = pairs.where(F.col("uses") >= least_uses).orderBy(F.desc("uses"), "left", "right").limit(SEEN_PAIRS)
        seen = [tuple(r) for r in top.select("left", "right", "uses").collect()]
        batch = independent(seen, len(seen) < SEEN_PAIRS, known)[: n_merges - len(merges)]
        if not batch:
            break
        before = {(left, right): rank for rank, (left, right, _) in enumerate(merges)}
        merges += [p for p in seen[: len(batch)]]
        known |= {left + right for left, right in batch}
        after = {(left, right): rank for rank, (left, right, _) in enumerate(merges)}
        if len(merges) == n_merges:
            break
        touched = _words_with(index(first, part), batch)
        change, kind = _changes(before, after)
        part += 1
        changed = store(touched.mapInArrow(change, kind), part)
        pairs = write_through(totals_of_both(pairs, totals(changed)), "pairs")
        if part - first == COMPACT_ROUNDS:
            whole = index(first, part).groupBy("left", "right", "word", "uses").agg(F.sum("n").alias("n")).where("n <> 0")
            store(whole, part + 1)
            first = part = part + 1
    return merges


def totals_of_both(pairs: DataFrame, changes: DataFrame) -> DataFrame:
    both = pairs.unionByName(changes).groupBy("left", "right").agg(F.sum("uses").alias("uses"))
    return both.where("uses > 0")


def _characters(words: DataFrame) -> DataFrame:
    """All symbols before any merge."""
    first = F.concat(F.lit(WORD_START), F.substring("word", 1, 1))
    rest = F.array_remove(F.split(F.expr("substring(word, 2)"), ""), "")
    return words.select(F.explode(F.concat(F.array(first), rest))).distinct()


def _words_with(index: DataFrame, batch: Sequence[Pair]) -> DataFrame:
    """``(word, uses)`` that have one of the pairs; only the folders of these pairs are read."""
    spark = index.sparkSession
    table = pa.table([[left for left, _ in batch], [right for _, right in batch]], names=["left", "right"])
    asked = spark.createDataFrame(table)
    folders = sorted({r[0] for r in asked.select(_folder()).collect()})
    near = index.where(F.col("folder").isin(folders)).join(F.broadcast(asked), ["left", "right"], "left_semi")
    present = near.groupBy("left", "right", "word", "uses").agg(F.sum("n").alias("n")).where("n > 0")
    return present.select("word", "uses").distinct()


def subword_vocab(counts: DataFrame, merges: Sequence[tuple[str, str, int]]) -> DataFrame:
    """``(token, id)``: single characters by code point, then what the merges make, in their order."""
    spark = counts.sparkSession
    characters = sorted(r[0] for r in _characters(counts.where("word <> ''")).collect())
    tokens = list(dict.fromkeys([*characters, *(left + right for left, right, _ in merges)]))
    return spark.createDataFrame(pa.table([tokens, pa.array(range(len(tokens)), pa.int64())], names=["token", "id"]))


def _cutter(merges: Sequence[tuple[str, str, int]]):
    ranks = {(left, right): rank for rank, (left, right, *_) in enumerate(merges)}

    most, longest = WORDS_AT_ONCE, KEPT_LENGTH

    def cut_piece(rows: pa.Array, known) -> pa.Array:
        """Each distinct word is cut once; its subwords are taken for every place it has."""
        lengths = pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False)
        coded = pc.list_flatten(rows).dictionary_encode()
        words = coded.dictionary.to_pylist()
        cuts = pa.array([*((known if len(w) <= longest else known.__wrapped__)(w) if w else [] for w in words), []], pa.list_(pa.string()))
        placed = cuts.take(pc.fill_null(coded.indices, len(words)))
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(placed).to_numpy(zero_copy_only=False), dtype=np.int64)])
        offsets = ends[np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])]
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pc.list_flatten(placed), mask=rows.is_null())

    @F.arrow_udf("array<string>")
    def cut_words(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = functools.lru_cache(KEPT_WORDS)(lambda word: cut(word, ranks))
        for column in batches:
            for low, high in pieces(column, most):
                yield cut_piece(column.slice(low, high - low), known)

    return cut_words


def subword_tokens(words: Column, merges: Sequence[tuple[str, str, int]]) -> Column:
    """The subwords of an array of words; characters that training did not see are symbols of their own.

    Words are cut in the row, in pieces of a batch, each distinct one of a piece once; nothing is shuffled. NULL stays NULL, missing
    and empty words have no subwords.
    """
    return _cutter(merges)(words)


def subword_text(tokens: Column) -> Column:
    """Words of subwords again, joined by single spaces."""
    return F.ltrim(F.regexp_replace(F.array_join(tokens, ""), WORD_START, " "))


def subword_ids(df: DataFrame, keys: Sequence[str], tokens: str, vocab: DataFrame, unk_id: int | None = None, out: str = "ids") -> DataFrame:
    """``(keys, ids)``: subwords as ids of ``subword_vocab``, a table of bounded size that is broadcast; unknown ones NULL or ``unk_id``."""
    entries = vocab.select(F.col("token").alias("_token"), F.col("id").alias("_id"))
    placed = df.select(*keys, F.posexplode_outer(tokens).alias("_at", "_token")).join(F.broadcast(entries), "_token", "left")
    if unk_id is not None:
        placed = placed.withColumn("_id", F.when(F.col("_token").isNotNull(), F.coalesce("_id", F.lit(unk_id).cast("bigint"))))
    return regroup(placed, keys, "_at", "_id", out)
