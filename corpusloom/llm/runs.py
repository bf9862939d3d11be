"""Periodic runs of words by recompression.

A run is a stretch of words with smallest period q, at least ``max(LEAST_LENGTH, 2 q)`` long, that no
neighbouring word extends. The words of some texts are one sequence of symbols, with a separator between texts
that equals nothing. Block and pair compression alternate: stretches of one symbol become a symbol of their own
with a length, then symbols are divided into left and right ones by a hash and each left one followed by a right one is
joined with it. Equal stretches are compressed alike but for a few symbols at their borders, and all levels together are
a run-length grammar of about as many nodes as a constant times the words.

How far two places agree is read off that grammar: from the words up to larger and larger equal symbols, then
down again to the first unequal word, jumping over the common part of two blocks at once. For every period q, places that
many words apart as a run must overlap are compared with those q words on, and where the words agree the
grammar gives the exact extension to both sides. Small periods come first; pairs inside a run already found whose period
divides q would give that run again and are left out. All steps take all places of a block at once, in numpy.

Nothing is shuffled: memory is that of a block of ``BLOCK_WORDS`` words, or of the longest text if that has more.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words of a run at least, whatever its period.
LEAST_LENGTH = 12
# Words that are compressed together, unless one text has more; pairs of places compared together.
BLOCK_WORDS, BLOCK_PAIRS = 150_000, 1_000_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Grammar(NamedTuple):
    """All levels of a recompressed sequence, each between two marks that equal nothing, one after the other."""

    symbol: np.ndarray  # the same for equal nodes of a level only
    parent: np.ndarray  # -1 on the last level
    first: np.ndarray  # first child, -1 for words
    last: np.ndarray
    ahead: np.ndarray  # nodes from this one to the end of its block
    behind: np.ndarray


def _blocks(level: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, int] | None:
    """Where blocks start, and the symbols of the next level; nothing if no symbol follows itself."""
    starts = np.flatnonzero(np.r_[True, level[1:] != level[:-1]])
    if len(starts) == len(level):
        return None
    lengths = np.diff(np.r_[starts, len(level)])
    symbols = level[starts].copy()
    long = np.flatnonzero(lengths > 1)
    names, which = np.unique(symbols[long] << 32 | lengths[long], return_inverse=True)
    symbols[long] = fresh + which
    return starts, symbols, fresh + len(names)


def _pairs(level: np.ndarray, fresh: int, turn: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The same for pairs of a left and a right symbol; separators, below 0, are neither."""
    mixed = (level.astype(np.uint64) + np.uint64(turn)) * _MIX
    mixed ^= mixed >> np.uint64(31)
    side = ((mixed * _MIX) >> np.uint64(63)).astype(bool)
    plain = level >= 0
    met = plain[:-1] & plain[1:] & (side[:-1] != side[1:])
    rising, falling = met & side[1:], met & side[:-1]
    at = np.flatnonzero(rising if np.count_nonzero(rising) >= np.count_nonzero(falling) else falling)
    names, which = np.unique(level[at] << 32 | level[at + 1], return_inverse=True)
    symbols = level.copy()
    symbols[at] = fresh + which
    keep = np.ones(len(level), dtype=bool)
    keep[at + 1] = False
    starts = np.flatnonzero(keep)
    return starts, symbols[starts], fresh + len(names)


def recompress(words: np.ndarray) -> Grammar:
    """The grammar of a sequence of numbers from 0 to 2^31 - 1, or below 0 for separators, each of which occurs once and is below -2."""
    level = np.concatenate([[-1], words, [-2]]).astype(np.int64)
    fresh = int(level.max(initial=0)) + 1
    symbols, parents, firsts, lasts, ahead, behind = [], [], [np.full(len(level), -1)], [np.full(len(level), -1)], [], []
    base, turn, by_blocks = 0, 0, True

    def close(starts: np.ndarray | None, blocks: bool) -> None:
        """Take the level as it is; ``starts`` says how the next one covers it."""
        nonlocal base
        n = len(level)
        symbols.append(level)
        one = np.ones(n, dtype=np.int64)
        if starts is None:
            parents.append(np.full(n, -1)), ahead.append(one), behind.append(one)
            return
        of = np.zeros(n, dtype=np.int64)
        of[starts] = 1
        of = np.cumsum(of) - 1
        ends = np.r_[starts[1:], n] - 1
        parents.append(base + n + of)
        if blocks:
            places = np.arange(n)
            ahead.append(ends[of] - places + 1), behind.append(places - starts[of] + 1)
        else:
            ahead.append(one), behind.append(one)
        firsts.append(base + starts), lasts.append(base + ends)
        base += n

    while (both := (level[:-1] >= 0) & (level[1:] >= 0)).any():
        if by_blocks:
            by_blocks = False
            if (found := _blocks(level, fresh)) is None:
                continue
        else:
            by_blocks, turn = True, turn + 1
            found = _pairs(level, fresh, turn)
            if len(found[0]) == len(level):
                continue
        starts, above, fresh = found
        close(starts, blocks=not by_blocks)
        level = above
    close(None, False)
    del both
    return Grammar(*(np.concatenate(c).astype(np.int64 if c is symbols else np.int32) for c in (symbols, parents, firsts, lasts, ahead, behind)))


def extensions(g: Grammar, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
    """How many words agree from places ``a`` and ``b`` of the first level on (or back from them, both included); ``a < b``."""
    edge, run, sign = (g.first, g.ahead, 1) if forward else (g.last, g.behind, -1)
    x, y = a.astype(np.int64), b.astype(np.int64)
    result, open_ = np.zeros(len(x), dtype=np.int64), np.arange(len(x))
    while len(open_):
        same = g.symbol[x] == g.symbol[y]
        # Equal: over what the two blocks have in common, and up where both come to the border of a node.
        i = np.flatnonzero(same)
        step = sign * np.minimum(run[x[i]], run[y[i]])
        p, q = x[i] + step, y[i] + step
        up_p, up_q = g.parent[p], g.parent[q]
        climb = (up_p >= 0) & (edge[up_p] == p) & (edge[up_q] == q)
        x[i], y[i] = np.where(climb, up_p, p), np.where(climb, up_q, q)
        # Unequal: down, or the end.
        i = np.flatnonzero(~same)
        down = edge[x[i]]
        ended = down < 0
        done = i[ended]
        result[open_[done]] = (x[done] - a[open_[done]]) * sign
        x[i], y[i] = np.where(ended, x[i], down), np.where(ended, y[i], edge[y[i]])
        if len(done):
            left = np.ones(len(open_), dtype=bool)
            left[done] = False
            open_, x, y = open_[left], x[left], y[left]
    return result


def _grid(starts: np.ndarray, sizes: np.ndarray, low: int, high: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the first level, and periods from ``low`` to below ``high``, in bounded parts: one place in each stretch a run must have."""
    most = np.minimum(sizes // 2, high - 1)
    counts = np.maximum(most - low + 1, 0)
    of = np.repeat(np.arange(len(sizes)), counts)
    period = low + np.arange(len(of)) - np.repeat(np.cumsum(counts) - counts, counts)
    # So many places in a row agree with those a period on.
    step = np.maximum(LEAST_LENGTH - period, period)
    places = (sizes[of] - 1 - period) // step + 1
    total = np.cumsum(places)
    at = 0
    while at < len(of):
        done = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, done + BLOCK_PAIRS, side="right")))
        n = places[at:to]
        k = np.arange(total[to - 1] - done) - np.repeat(total[at:to] - n - done, n)
        yield np.repeat(starts[of[at:to]], n) + k * np.repeat(step[at:to], n), np.repeat(period[at:to], n)
        at = to


def find_runs(texts: list[np.ndarray]) -> list[np.ndarray]:
    """For each sequence of numbers (from 0 to 2^31 - 1) its runs as rows (start, length, period), by start, then period."""
    empty = np.zeros((0, 3), dtype=np.int64)
    result = [empty] * len(texts)
    held = [i for i, t in enumerate(texts) if len(t) >= LEAST_LENGTH]
    if not held:
        return result
    sizes = np.array([len(texts[i]) for i in held])
    # A mark and then each text with its separator.
    starts = 1 + np.cumsum(sizes + 1) - sizes - 1
    words = np.concatenate([part for k, i in enumerate(held) for part in (texts[i], [-3 - k])])
    g = recompress(words)
    first_level = g.symbol[: len(words) + 2]
    # The run found that covers a place, the longest if there are several.
    covering = np.full(len(first_level), -1)
    found, low = empty, 1
    while low <= int(sizes.max()) // 2:
        new = []
        for at, period in _grid(starts, sizes, low, 2 * low):
            to = at + period
            hit = first_level[at] == first_level[to]
            at, period, to = at[hit], period[hit], to[hit]
            run = covering[at]
            known = (run >= 0) & (run == covering[to])
            known[known] = period[known] % found[run[known], 2] == 0
            at, period, to = at[~known], period[~known], to[~known]
            back = extensions(g, at, to, forward=False)
            length = back - 1 + period + extensions(g, at, to, forward=True)
            kept = length >= np.maximum(LEAST_LENGTH, 2 * period)
            new.append(np.stack([(at - back + 1)[kept], length[kept], period[kept]], axis=1))
        fresh = np.unique(np.concatenate(new), axis=0)
        if len(fresh):
            n, found = len(found), np.concatenate([found, fresh])
            # Of equal stretches the first one has the smallest period, as those found before come first.
            order = np.lexsort((np.arange(len(found)), found[:, 2], found[:, 1], found[:, 0]))
            again = np.zeros(len(found), dtype=bool)
            again[order[1:]] = (found[order[1:], :2] == found[order[:-1], :2]).all(axis=1)
            keep = ~again
            keep[:n] = True
            found = found[keep]
            covering = np.full(len(first_level), -1)
            for r in np.argsort(found[:, 1], kind="stable").tolist():
                covering[found[r, 0] : found[r, 0] + found[r, 1]] = r
        low *= 2
    of = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[of]
    order = np.lexsort((found[:, 2], found[:, 0], of))
    found, of = found[order], of[order]
    borders = np.searchsorted(of, np.arange(len(held) + 1))
    for k, i in enumerate(held):
        result[i] = found[borders[k] : borders[k + 1]]
    return result


def repeats(n: int, runs: np.ndarray) -> np.ndarray:
    """Which of ``n`` words a run contains after its first period."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:-1]) > 0


def _answers(texts: list[str | None]) -> tuple[list[int], list[np.ndarray], list[str]]:
    """Words, runs, and what stays of each text."""
    split = [t.encode().split() if t else [] for t in texts]
    number: dict[bytes, int] = {}
    for words in split:
        if len(words) >= LEAST_LENGTH:
            for word in set(words).difference(number):
                number[word] = len(number)
    coded = [
        np.fromiter(map(number.__getitem__, w), dtype=np.int64, count=len(w)) if len(w) >= LEAST_LENGTH else np.zeros(0, dtype=np.int64)
        for w in split
    ]
    runs, kept = find_runs(coded), []
    for words, own in zip(split, runs):
        if len(own):
            words = [w for w, drop in zip(words, repeats(len(words), own).tolist()) if not drop]
        kept.append(b" ".join(words).decode())
    return [len(w) for w in split], runs, kept


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_FOUND = pa.struct([("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])


def periodic_runs(text: Column) -> Column:
    """``n_words``, ``runs`` (start, length, period; words from 0; by start, then period) and ``collapsed`` of a text.

    Words are split at the six white-space characters of ASCII. ``collapsed`` has the words that no run contains after
    its first period, joined by single spaces. A text that is null, empty or without words has no words, no
    runs and collapses to nothing. A column function: repeated rows and other columns stay as they are. Texts of
    any length are processed whole.
    """

    @F.arrow_udf("struct<n_words: bigint, runs: array<struct<start: bigint, length: bigint, period: bigint>>, collapsed: string>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            counts: list[int] = []
            runs: list[np.ndarray] = []
            kept: list[str] = []
            block: list[str | None] = []
            held, rows = 0, len(column)
            for i, value in enumerate(column):
                block.append(value.as_py())
                # A word and its space take six bytes or so.
                held += len(block[-1] or "") // 6
                if held >= BLOCK_WORDS or i + 1 == rows:
                    for whole, part in zip((counts, runs, kept), _answers(block)):
                        whole += part
                    block, held = [], 0
            flat = np.concatenate([np.zeros((0, 3), dtype=np.int64), *runs])
            offsets = np.cumsum([0, *map(len, runs)])
            each = pa.StructArray.from_arrays([pa.array(flat[:, j]) for j in range(3)], fields=list(_RUN))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each)
            yield pa.StructArray.from_arrays([pa.array(counts, pa.int64()), lists, pa.array(kept, pa.string())], fields=list(_FOUND))

    return find(text)
