"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a text with up to k edits. Cut into k + 1 pieces, at least
one piece of any such occurrence is untouched. All pieces of all items are searched for at once with
an automaton; each hit gives a window of the text that must hold the item if the piece belongs to
it, and Myers' bit-parallel algorithm finds the smallest edit distance of the item to any part of
the window. Both sides are brought to lower case with single spaces between runs of letters and
digits first, so punctuation, case and line breaks neither hide a passage nor use up its edits.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# One edit is allowed for so many characters of an item.
CHARS_PER_EDIT = 12
# Characters of benchmark text that are broadcast and searched for at a time.
BLOCK_CHARS = 8_000_000
LEAKS = "array<struct<item_id: bigint, distance: int, start: int, end: int>>"
_GAP = re.compile(r"[\W_]+")
_RUN = re.compile(r"[^\W_]+")


def _lower(text: str) -> str:
    """Lower case with as many characters as before."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c if len(c.lower()) != 1 else c.lower() for c in text)


# For texts of the first 256 characters: a space for each that is no letter or digit.
_SPACED = bytes(32 if _GAP.match(chr(i)) else i for i in range(256))


def normalise(text: str | None) -> str:
    """Lower case, with single spaces between runs of letters and digits; empty for no text."""
    if not text:
        return ""
    low = _lower(text)
    try:
        return b" ".join(low.encode("latin-1").translate(_SPACED).split()).decode("latin-1")
    except UnicodeEncodeError:
        return _GAP.sub(" ", low).strip()


def original_span(text: str, start: int, end: int) -> tuple[int, int]:
    """Where the part from ``start`` to ``end`` of the normalised text lies in ``text``."""
    at, first, last = 0, None, 0
    for run in _RUN.finditer(_lower(text)):
        size = run.end() - run.start()
        if at < end and at + size > start:
            if first is None:
                first = run.start() + max(0, start - at)
            last = run.start() + min(size, end - at)
        at += size + 1
        if at >= end:
            break
    return (first or 0, last)


def myers(pattern: str, text: str) -> tuple[int, int]:
    """The smallest edit distance of ``pattern`` to any part of ``text``, and the earliest end of such a part."""
    m = len(pattern)
    if not m:
        return 0, 0
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best, end = m, 0
    get = masks.get
    for j, c in enumerate(text, 1):
        eq = get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | (full & ~(horizontal | plus))
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full
        plus = (down << 1 & full) | (full & ~(vertical | up))
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


def _pieces(start: int, end: int, leaves: int, above: tuple[tuple[int, int, int], ...]) -> Iterator[tuple]:
    """The pieces of a range and, from small to large, the ranges around each that have to match, with their budgets.

    A range of j pieces may have j - 1 edits. If it has no more, one of its halves has no more than
    its own budget, and so on down to a piece without edits.
    """
    if leaves == 1:
        yield start, end, above
        return
    above = ((start, end, leaves - 1), *above)
    left = leaves // 2
    middle = start + (end - start) * left // leaves
    yield from _pieces(start, middle, left, above)
    yield from _pieces(middle, end, leaves - left, above)


class PassageFinder:
    """Finds the items in texts. Items without a letter or digit are never found."""

    def __init__(self, items: Iterable[tuple[int | None, str | None]], chars_per_edit: int = CHARS_PER_EDIT) -> None:
        self.items = [(i, text, len(text) // chars_per_edit) for i, t in items if (text := normalise(t))]
        places: dict[str, list[tuple[int, int, tuple]]] = {}
        for n, (_, text, budget) in enumerate(self.items):
            for a, b, ranges in _pieces(0, len(text), budget + 1, ()):
                places.setdefault(text[a:b], []).append((n, a, ranges))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.empty = not places
        # Copies of a text ask for the same windows again.
        self.distance = lru_cache(maxsize=4096)(self._distance)

    def _distance(self, n: int, window: str) -> tuple[int, int, int]:
        """Distance, start and end of an item within a window."""
        text = self.items[n][1]
        best, end = myers(text, window)
        if best > self.items[n][2]:
            return best, 0, 0
        _, back = myers(text[::-1], window[:end][::-1])
        return best, end - back, end

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) of the nearest occurrence of each item found, the first of equally near ones."""
        if self.empty or not text:
            return []
        plain = normalise(text)
        best: dict[int, tuple[int, int, int]] = {}
        for last, (size, where) in self.automaton.iter(plain):
            for n, offset, ranges in where:
                if best.get(n, (1,))[0] == 0:
                    continue
                begin = last + 1 - size - offset
                _, item, budget = self.items[n]
                # Small ranges first: most chance hits end here.
                if not all(
                    myers(item[a:b], plain[max(0, begin + a - k) : max(0, begin + b + k)])[0] <= k
                    for a, b, k in ranges[:-1]
                ):
                    continue
                low = max(0, begin - budget)
                distance, start, end = self.distance(n, plain[low : max(0, begin + len(item) + budget)])
                if distance <= budget:
                    found = (distance, low + start, low + end)
                    best[n] = min(best.get(n, found), found)
        found = [(self.items[n][0], d, *original_span(text, a, b)) for n, (d, a, b) in best.items()]
        return sorted(found, key=lambda x: (x[0] is not None, x[0] or 0, *x[1:]))


def _finding(shared: Broadcast, chars_per_edit: int):
    @F.arrow_udf(LEAKS)
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        finder = PassageFinder(shared.value, chars_per_edit)
        kind = pa.list_(
            pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
        )
        for column in batches:
            found = [
                [{"item_id": i, "distance": d, "start": a, "end": b} for i, d, a, b in finder.find(value.as_py())]
                for value in column
            ]
            yield pa.array(found, kind)

    return find


def benchmark_leaks(
    spark: SparkSession,
    text: Column,
    items: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    chars_per_edit: int = CHARS_PER_EDIT,
    block_chars: int = BLOCK_CHARS,
) -> Column:
    """The items found in a text as an array of (item_id, distance, start, end) by item_id; empty for null or empty texts.

    Positions are code points of the original text. An item may have one edit for every
    ``chars_per_edit`` of its normalised characters, and may begin and end within a word. Items with a null text and those
    without letters or digits are found nowhere; an item without an id, or of one that is no long, is searched for
    like any other and reported with a null id, first. Items of equal text are all reported; no items, no leaks. The items are
    broadcast in blocks of at most ``block_chars`` characters (and one item), each of which is
    searched for in every text, however long. A column function: repeated rows and other columns stay.
    """
    chosen = items.select(F.col(item_id).try_cast("long").alias("_id"), F.col(item_text).alias("_text"))
    chosen = chosen.where(F.col("_text").isNotNull())
    total = chosen.agg(F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_chars))
    columns = []
    for block in range(blocks):
        part = chosen.where(F.pmod(F.xxhash64("_id", "_text"), F.lit(blocks)) == block) if blocks > 1 else chosen
        shared = spark.sparkContext.broadcast(sorted(map(tuple, part.toLocalIterator()), key=lambda x: (x[0] is not None, x[0] or 0, x[1])))

        columns.append(_finding(shared, chars_per_edit)(text))
    return columns[0] if blocks == 1 else F.array_sort(F.concat(*columns))
