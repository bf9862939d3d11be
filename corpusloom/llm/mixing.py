"""Mixing sources to target weights by balanced sampling (the cube method).

Each source has a rate: its target over its size. A document is taken as often as the whole part of
the rate says, and once more with the fraction as its inclusion probability. The probabilities are
moved through the null space of two balancing constraints, the number of documents and the number
of words, until they are 0 or 1: any three undecided documents of a source have a direction that
changes neither total, and a step along it to the border of the unit cube decides at least one of
them. At most two documents of a group stay undecided. Those of all groups are dealt into fewer
groups and go on, until one group per source is left, whose last few documents are the landing
problem: all their outcomes are tried, the one nearest to both totals is taken, and what is left of
the difference is mended with a few small documents of that last group.

Groups are formed by source and a hash of the document's id, never by where a row lies, so a rerun on
another cluster gives the same mix, and a source that holds most of the rows is spread over many
groups of the same size as any other's. Only ids and sizes are shuffled, never texts.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import write_through

# Documents of a source that are balanced together.
GROUP_ROWS = 1024


def water_fill(sizes: Sequence[float], weights: Sequence[float], total: float, cap: float = 2.0) -> list[float]:
    """Share ``total`` by weight; none gets more than ``cap`` times its size, the excess is shared anew.

    If all are at their cap, what is left is not given out. Sizes of 0 get 0.
    """
    targets = [0.0] * len(sizes)
    open_, left = set(range(len(sizes))), float(total)
    while open_:
        weight = sum(weights[i] for i in open_)
        full = [i for i in open_ if left * weights[i] / weight >= cap * sizes[i]]
        if not full:
            for i in open_:
                targets[i] = left * weights[i] / weight
            break
        for i in full:
            targets[i] = cap * sizes[i]
            left -= targets[i]
            open_.discard(i)
        left = max(left, 0.0)
    return targets


def cyclic_weights(sources: Sequence[str | None], cycle: Sequence[float] = (5.0, 2.0, 1.0)) -> dict[str | None, float]:
    """The weights repeat over the sources by code point, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {source: cycle[i % len(cycle)] for i, source in enumerate(ordered)}


def _coin(seed: int, *parts: object) -> float:
    """A number from 0 up to 1 that depends on its arguments only."""
    digest = hashlib.blake2b(repr((seed, *parts)).encode(), digest_size=7).digest()
    return int.from_bytes(digest, "big") / (1 << 56)


def _step(odds: list[float], sizes: list[float], toss: float) -> list[float]:
    """Move two or three probabilities along a direction that keeps the totals, to the border of the cube.

    The direction is the cross product of the rows (1, 1, 1) and (sizes). With two documents, or
    three of one size, the first two trade places.
    """
    if len(odds) == 3:
        a, b, c = sizes
        way = [c - b, a - c, b - a]
        if not any(way):
            way = [1.0, -1.0, 0.0]
    else:
        way = [1.0, -1.0]
    forth = min((1 - p) / w if w > 0 else -p / w for p, w in zip(odds, way) if w)
    back = min(p / w if w > 0 else (p - 1) / w for p, w in zip(odds, way) if w)
    # Forth with probability back / (forth + back): the expected probabilities do not change.
    by = forth if toss * (forth + back) < back else -back
    moved = [p + by * w for p, w in zip(odds, way)]
    return [0.0 if p < 1e-9 else 1.0 if p > 1 - 1e-9 else p for p in moved]


def flight(odds: Sequence[float], sizes: Sequence[float], seed: int) -> list[float]:
    """The flight phase: at most two of the returned probabilities are neither 0 nor 1.

    Large documents should come first: those that stay undecided are then the smallest.
    """
    result, held, tosses = list(odds), [], 0
    for i, p in enumerate(odds):
        if not 0 < p < 1:
            continue
        held.append(i)
        # With equal sizes two documents are enough for a direction.
        while len(held) == 3 or (len(held) == 2 and sizes[held[0]] == sizes[held[1]]):
            tosses += 1
            moved = _step([result[j] for j in held], [float(sizes[j]) for j in held], _coin(seed, tosses))
            for j, p_new in zip(held, moved):
                result[j] = p_new
            held = [j for j in held if 0 < result[j] < 1]
    return result


def landing(odds: Sequence[float], sizes: Sequence[float], start: Sequence[float]) -> list[float]:
    """Decide the last few documents: the outcome whose words, then number, are nearest to what was due.

    What is still missing or too much then is mended with documents that the flight has decided:
    from large to small, one changes sides if that brings the words nearer; then pairs change
    places while that does. ``start`` holds the probabilities before the flight; documents that
    had none to lose or win stay as they are.
    """
    last = [i for i, p in enumerate(odds) if 0 < p < 1]
    words, number = sum(odds[i] * sizes[i] for i in last), sum(odds[i] for i in last)
    best = min(
        itertools.product((0.0, 1.0), repeat=len(last)),
        key=lambda ends: (
            abs(sum(e * sizes[i] for e, i in zip(ends, last)) - words),
            abs(sum(ends) - number),
            ends,
        ),
    )
    result = list(odds)
    for i, end in zip(last, best):
        result[i] = end
    due = sum(p * n for p, n in zip(start, sizes)) - sum(p * n for p, n in zip(result, sizes))
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        change = sizes[i] * (1 - 2 * result[i])
        if 0 < start[i] < 1 and abs(due - change) < abs(due):
            result[i], due = 1 - result[i], due - change
    while pair := _nearest_swap(result, sizes, start, due):
        out, into = pair
        result[out], result[into] = 0.0, 1.0
        due -= sizes[into] - sizes[out]
    return result


def _nearest_swap(
    odds: Sequence[float], sizes: Sequence[float], start: Sequence[float], due: float
) -> tuple[int, int] | None:
    """The taken and the untaken document whose swap brings the words nearest to what is due, if any does."""
    free = [i for i, p in enumerate(start) if 0 < p < 1]
    untaken = sorted((sizes[i], i) for i in free if odds[i] == 0)
    best, pair = abs(due), None
    for out in (i for i in free if odds[i] == 1):
        at = bisect.bisect_left(untaken, (sizes[out] + due, -1))
        for size, into in untaken[max(0, at - 1) : at + 1]:
            left = abs(due - (size - sizes[out]))
            if left < best - 1e-9:
                best, pair = left, (out, into)
    return pair


def _seed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "big")


def _balance(key: str, size: str, odds: str, part: str, parts: str, seed: int):
    def balanced(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values([size, "_mix", key], ascending=[False, True, True], kind="stable", na_position="last")
        start, sizes = frame[odds].tolist(), frame[size].tolist()
        values = flight(start, sizes, _seed(f"{seed}/{frame[part].iat[0]}"))
        if frame[parts].iat[0] == 1:
            values = landing(values, sizes, start)
        frame[odds] = values
        return frame

    return balanced


def mix_sources(
    docs: DataFrame,
    size: Column,
    weights: dict[str | None, float] | None = None,
    share: float = 1.5,
    most_copies: int = 2,
    key: str = "doc_id",
    source: str = "source",
    seed: int = 1,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """How often the mix takes each document: key, source, size, source_size, target, taken, copies.

    ``weights`` names the weight of each source, cyclic 5, 2, 1 if not given; a source without a
    weight in it gets none of the mix. The mix holds ``share`` times all sizes; a source gives
    at most ``most_copies`` times its size.

    One row per row of ``docs``, whatever its columns. Null source: a source of its own. Null or
    empty text: size 0, which takes no words. Null or repeated keys are separate rows, which are
    alike for the sampling if their sizes are. No rows: no rows. What reaches the driver is one row
    per source.
    """
    narrow = write_through(
        docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), size.cast("long").alias("_size")),
        "mixing",
    )
    spark = docs.sparkSession
    per_source = narrow.groupBy("_source").agg(F.sum("_size").alias("size"), F.count(F.lit(1)).alias("rows")).collect()
    per_source = sorted(per_source, key=lambda r: (r["_source"] is None, r["_source"] or ""))
    given = cyclic_weights([r["_source"] for r in per_source]) if weights is None else weights
    wanted = [(r, float(given.get(r["_source"], 0.0))) for r in per_source]
    used = [(r, w) for r, w in wanted if w > 0]
    total = share * sum(r["size"] for r in per_source)
    filled = water_fill([r["size"] for r, _ in used], [w for _, w in used], total, float(most_copies))
    targets = {r["_source"]: t for (r, _), t in zip(used, filled)}
    rows = [
        (r["_source"], r["size"], float(targets.get(r["_source"], 0.0)), max(1, -(-r["rows"] // group_rows)))
        for r in per_source
    ]
    facts = spark.createDataFrame(rows, "_of string, _source_size long, _target double, _parts long")
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(F.lit(0.0))
    whole = F.floor(rate + F.lit(1e-9))
    # One row per source, as many as the driver has just held.
    state = (
        narrow.join(F.broadcast(facts), F.col("_source").eqNullSafe(F.col("_of")))
        .drop("_of")
        .withColumns({"_sure": whole.cast("long"), "_odds": F.greatest(rate - whole, F.lit(0.0))})
        .withColumn("_mix", F.xxhash64(F.lit(seed), "_key", "_size"))
    )

    open_, done, wave = state, [], 0
    parts = max([r[3] for r in rows], default=1)
    while True:
        label = F.concat_ws("/", F.lit(str(wave)), F.coalesce(F.concat(F.lit("s"), "_source"), F.lit("n")), F.pmod(F.xxhash64("_mix", F.lit(wave)), "_parts").cast("string"))
        dealt = open_.withColumn("_part", label)
        kind = dealt.schema
        moved = write_through(
            dealt.groupBy("_part").applyInPandas(_balance("_key", "_size", "_odds", "_part", "_parts", seed), kind),
            "flight",
        ).drop("_part")
        if parts == 1:
            done.append(moved)
            break
        undecided = (F.col("_odds") > 0) & (F.col("_odds") < 1)
        # Sources that had one group have landed; the others keep two rows of a group at most.
        done.append(moved.where(~undecided))
        shrink = F.greatest(F.ceil(F.col("_parts") * 2 / F.lit(group_rows)), F.lit(1)).cast("long")
        open_ = moved.where(undecided).withColumn("_parts", shrink)
        parts, wave = max(1, -(-parts * 2 // group_rows)), wave + 1
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    copies = (F.col("_sure") + F.round("_odds").cast("long")).cast("long")
    return result.select(
        F.col("_key").alias(key),
        F.col("_source").alias(source),
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        (copies * F.col("_size")).alias("taken"),
        copies.alias("copies"),
    )
