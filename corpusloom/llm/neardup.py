"""Near-duplicate documents by a MinHash LSH forest, confirmed on full shingle sets.

Each document has a set of word shingles. Documents of equal sets are one node, whatever their
number. Each tree of the forest is one sorted order of the nodes by a label, a stretch of their MinHash
signature that begins elsewhere in each tree. In sorted order the neighbours of a node are those with
the longest common prefix. A node is compared with up to ``WINDOW`` rows on either side that share at
least ``LEAST_DEPTH`` values of the label with it: where few nodes share so much, these are all of
them; in a crowded region they are those that share more, so the depth adapts to the region. A
sketch of the signature, carried along, ranks them, and the best ``NEIGHBOURS`` that may be similar
enough are the first candidates. Their number grows with the nodes, never with the square of a region.
The orders are made by range partitioning on (tree, label, node), so a region of any size is spread
over as many tasks as it needs.

Candidates are confirmed on the full sets: first the most promising one of each node, then those
whose ends are not connected yet; one whose ends are connected already could not change any
component.

The window, the rank and the edges of ranges leave pairs out, and then both nodes are known to be
crowded. These nodes, and no others, go on in forests of fresh hash functions whose depth adapts: in each tree a node
belongs to the shallowest prefix, from ``LEAST_DEPTH`` values on, whose nodes have no more than
``CROSSING`` pairs of different components each on average. So linked nodes cost nothing, and a
region of unlinked but similar ones is cut as deep as it needs. Within such a prefix all pairs of different
components are compared, by larger sketches. The chance that a tree brings a pair together follows from the depth, for
which the deepest of a node's prefixes in a forest is taken, and a node takes part in further forests until a pair at
the threshold is missed with a chance of less than ``MOST_MISSED``. Work is the number of crowded nodes times trees times ``CROSSING``; no
node is compared with a whole region.

The chance that a pair at exactly the threshold of 0.85 meets in none of the first 16 trees at depth 4 is
below one in 100,000, and it falls with similarity.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import write_through
from corpusloom.llm.components import connected_components

TREES, LEAST_DEPTH = 16, 4
# Values of a label, and how far the labels of two trees begin apart.
DEPTH, STRIDE = 16, 8
# Rows on either side that a node is compared with in each tree, and how many of them are candidates.
WINDOW, NEIGHBOURS = 64, 4
# Values of the prefixes that a crowded node may belong to, pairs of different components per node of a prefix, and
# nodes of its main component that are compared in one task.
DEPTHS, CROSSING, BLOCK_ROWS = (4, 6, 8, 11, 16, 24, 36, 54), 512, 2048
# Chance to miss a pair at the threshold at which a crowded node has had trees enough.
MOST_MISSED = 1e-5
# Hash functions of a fresh forest; four bits of each make its sketch.
_FRESH = 1024
_HASHES = TREES * STRIDE
# Ids whose texts are confirmed are broadcast up to this number, else joined by shuffle.
MOST_BROADCAST_IDS = 4_000_000
# Pairs that a task holds before it hands them on.
HELD_PAIRS = 100_000
# Hashes of words that a worker keeps.
KEPT_WORDS = 400_000

_SEEDS = np.random.default_rng(20240229)
_FACTORS = _SEEDS.integers(1, 1 << 63, _HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERMS = _SEEDS.integers(0, 1 << 63, _HASHES, dtype=np.uint64)
_PLACES = _SEEDS.integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class Shingler:
    """Shingle sets of texts as sorted arrays of 64-bit hashes."""

    def __init__(self, words: int) -> None:
        if not 1 <= words <= len(_PLACES):
            raise ValueError(f"shingles have 1 to {len(_PLACES)} words")
        self.words, self.known = words, {}

    def shingles(self, text: str | None) -> np.ndarray:
        """Of words in lower case (A-Z); with fewer words than a shingle has, all of them are one; none without words."""
        found = text.encode().lower().split() if text else []
        if not found:
            return np.zeros(0, dtype=np.uint64)
        known = self.known
        for word in set(found).difference(known):
            known[word] = xxhash.xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        if len(known) > KEPT_WORDS:
            self.known = {}
        size = min(self.words, len(found))
        count = len(found) - size + 1
        mixed = np.full(count, size, dtype=np.uint64)
        for j in range(size):
            mixed += hashes[j : j + count] * _PLACES[j]
        mixed ^= mixed >> np.uint64(32)
        mixed *= _PLACES[-1]
        mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of each hash function over the set, reduced to 16 bits."""
    least = np.full(_HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 2048):
        part = shingles[at : at + 2048, None] * _FACTORS + _TERMS
        np.minimum(least, part.min(axis=0), out=least)
    return ((least * _PLACES[0]) >> np.uint64(48)).astype(">u2")


def _signed(digest: bytes) -> int:
    return int.from_bytes(digest, "big", signed=True)


def _described(words: int):
    kind = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("sig", pa.binary())]
    )

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            columns: list[list] = [batch.column(0).to_pylist(), [], [], [], []]
            for value in batch.column(1):
                shingles = shingler.shingles(value.as_py())
                columns[1].append(len(shingles))
                if not len(shingles):
                    columns[2].append(None), columns[3].append(None), columns[4].append(None)
                    continue
                digest = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                columns[2].append(_signed(digest[:8])), columns[3].append(_signed(digest[8:]))
                values = signature(shingles)
                columns[4].append(values.tobytes() + values.view(np.uint8)[1::2].tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)

    return describe, "doc_id long, n long, d1 long, d2 long, sig binary"


def _neighbours(percent: int, least_match: int):
    """Candidate pairs (a, b, match) among rows (tree, label, node, component, n, sketch) that come in sorted order.

    A row (a, null, 0) says that the node is crowded: it has more neighbours than could be candidates, more rows of
    its prefix than the window has, or its prefix may go on in another task.
    """
    names = ("tree", "label", "node", "component", "n", "sketch")

    def best_of(mine: np.ndarray, other: np.ndarray, match: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the pairs are among the best of ``mine``, and which rows have more than that."""
        order = np.lexsort((other, -match, mine))
        first = np.flatnonzero(np.r_[True, np.diff(mine[order]) != 0])
        counts = np.diff(np.r_[first, len(order)])
        rank = np.arange(len(order)) - np.repeat(first, counts)
        return order[rank < NEIGHBOURS], mine[order[first[counts > NEIGHBOURS]]]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, last_run, started = None, None, False

        def flagged(nodes: np.ndarray) -> pa.RecordBatch:
            n = len(nodes)
            columns = [pa.array(nodes, pa.int64()), pa.nulls(n, pa.int64()), pa.array(np.zeros(n), pa.int32())]
            return pa.RecordBatch.from_arrays(columns, ["a", "b", "match"])

        for batch in batches:
            rows = len(batch)
            if not rows:
                continue

            def fixed(i: int, width: int) -> np.ndarray:
                return np.frombuffer(b"".join(batch.column(i).to_pylist()), dtype=np.uint8).reshape(rows, width)

            new = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names) if i not in (1, 5)}
            new |= {"label": fixed(1, 2 * DEPTH), "sketch": fixed(5, _HASHES)}
            held = 0 if tail is None else len(tail["node"])
            now = new if tail is None else {k: np.concatenate([tail[k], new[k]]) for k in names}
            tail = {k: v[-WINDOW - 1 :] for k, v in now.items()}
            prefix = np.ascontiguousarray(now["label"][:, : 2 * LEAST_DEPTH]).view(np.uint64)[:, 0]
            same_as_next = np.r_[(prefix[1:] == prefix[:-1]) & (now["tree"][1:] == now["tree"][:-1]), False]
            # How many rows from this one on share its prefix: equal ones are next to each other.
            ends = np.flatnonzero(~same_as_next)
            length = ends[np.searchsorted(ends, np.arange(len(prefix)))] - np.arange(len(prefix))
            found, crowded = [], []
            # Rows with more of their prefix on one side than the window has, and those of the task's first prefix.
            far = np.flatnonzero(length > WINDOW)
            crowded += [far, far + WINDOW + 1]
            run = np.searchsorted(ends, np.arange(len(prefix)))
            if not started:
                crowded.append(np.flatnonzero(run == 0))
                first_run = (now["tree"][0], prefix[0])
                started = True
            elif (now["tree"][0], prefix[0]) == first_run:
                crowded.append(np.flatnonzero(run == 0))
            last_run = now["node"][run == run[-1]]
            yield flagged(np.unique(now["node"][np.concatenate(crowded)]))
            for step in range(1, WINDOW + 1):
                at = np.flatnonzero(length >= step)
                # Pairs within the held rows came with the batch before.
                at = at[at + step >= held]
                if not len(at):
                    if not (length >= step).any():
                        break
                    continue
                to = at + step
                a, b = now["n"][at], now["n"][to]
                near = 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
                near &= now["component"][at] != now["component"][to]
                at, to = at[near], to[near]
                match = (now["sketch"][at] == now["sketch"][to]).sum(axis=1)
                enough = match >= least_match
                found.append((at[enough], to[enough], match[enough]))
            if not found:
                continue
            at, to, match = (np.concatenate(c) for c in zip(*found))
            if not len(at):
                continue
            left, more_left = best_of(at, to, match)
            right, more_right = best_of(to, at, match)
            kept = np.union1d(left, right)
            x, y = now["node"][at[kept]], now["node"][to[kept]]
            more = now["node"][np.unique(np.concatenate([more_left, more_right]))]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate([np.minimum(x, y), more]), pa.int64()),
                    pa.array(np.concatenate([np.maximum(x, y), more]), pa.int64(), mask=np.arange(len(x) + len(more)) >= len(x)),
                    pa.array(np.concatenate([match[kept], np.zeros(len(more), dtype=match.dtype)]), pa.int32()),
                ],
                ["a", "b", "match"],
            )
        # The last prefix may go on in the next task.
        if last_run is not None:
            yield flagged(last_run)

    return pairs, "a long, b long, match int"


def _fresh_functions(turn: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng([20240229, turn])
    return (
        draw.integers(1, 1 << 63, _FRESH, dtype=np.uint64) * np.uint64(2) + np.uint64(1),
        draw.integers(0, 1 << 63, _FRESH, dtype=np.uint64),
    )


def _fresh_signatures(words: int, turn: int):
    """Rows (node, text) as (node, n, keys, sketch): a number for each tree and depth, and four bits of each hash function."""
    kind = pa.schema([("node", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64())), ("sketch", pa.binary())])
    factors, terms = _fresh_functions(turn)
    weights = np.random.default_rng([turn, 7]).integers(1, 1 << 62, max(DEPTHS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            columns: list[list] = [batch.column(0).to_pylist(), [], [], []]
            for value in batch.column(1):
                shingles = shingler.shingles(value.as_py())
                least = np.full(_FRESH, np.iinfo(np.uint64).max, dtype=np.uint64)
                for at in range(0, len(shingles), 256):
                    np.minimum(least, (shingles[at : at + 256, None] * factors + terms).min(axis=0), out=least)
                # A tree's prefixes are made of functions of its own, each prefix of those before it.
                own = (least * _PLACES[1])[: TREES * max(DEPTHS)].reshape(TREES, max(DEPTHS))
                chained = np.cumsum((own >> np.uint64(20)) * weights, axis=1, dtype=np.uint64)[:, [d - 1 for d in DEPTHS]]
                trees = np.arange(TREES, dtype=np.uint64)[:, None] * _PLACES[2] + np.arange(len(DEPTHS), dtype=np.uint64) * _PLACES[3]
                bits = ((least * _PLACES[0]) >> np.uint64(60)).astype(np.uint8)
                columns[1].append(len(shingles))
                columns[2].append(((chained ^ (chained >> np.uint64(29))) * _PLACES[4] + trees).view(np.int64).ravel())
                columns[3].append((bits[: _FRESH // 2] << 4 | bits[_FRESH // 2 :]).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kind)], schema=kind)

    return sign, "node long, n long, keys array<long>, sketch binary"


def _block_pairs(percent: int):
    """All pairs (a, b, match) of different components that may be similar enough among rows (key, block, minor, node, component, n, keys, sketch).

    Rows come sorted by (key, block), a group. Two minor rows are compared in block 0 only. ``keys`` are all groups of a node, filled
    up with 0; a pair is told in the first one that its nodes share.
    """
    names = ("key", "block", "minor", "node", "component", "n")
    least_match = _least_match(percent, _FRESH, 16)
    few = _least_match(percent, _HASHES, 16)

    def compared(now: dict[str, np.ndarray], ends: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = ends[-1]
        left = ends[np.searchsorted(ends, np.arange(rows), side="right")] - np.arange(rows) - 1
        packed = now["sketch"][:rows]
        bits = np.concatenate([packed >> 4, packed & 15], axis=1)
        part = np.ascontiguousarray(bits[:, :_HASHES])
        at, found, held, step = np.flatnonzero(left > 0), [], 0, 0
        while len(at):
            step += 1
            to = at + step
            a, b = now["n"][at], now["n"][to]
            near = now["component"][at] != now["component"][to]
            near &= ~(now["minor"][at] & now["minor"][to]) | (now["block"][at] == 0)
            near &= 100 * np.minimum(a, b) >= percent * np.maximum(a, b)
            x, y = at[near], to[near]
            # A part of the sketch tells most pairs apart.
            maybe = (part[x] == part[y]).sum(axis=1) >= few
            x, y = x[maybe], y[maybe]
            match = (bits[x] == bits[y]).sum(axis=1)
            enough = match >= least_match
            x, y, match = x[enough], y[enough], match[enough]
            if len(x):
                mine = now["keys"][x][:, :, None]
                shared = (mine == now["keys"][y][:, None, :]) & (mine != 0) & (mine < now["key"][x][:, None, None])
                first = ~shared.any(axis=(1, 2))
                found.append((x[first], y[first], match[first]))
                held += len(found[-1][0])
            at = at[left[at] > step]
            if held >= HELD_PAIRS or (held and not len(at)):
                x, y, match = (np.concatenate(c) for c in zip(*found))
                x, y = now["node"][x], now["node"][y]
                columns = [pa.array(np.minimum(x, y), pa.int64()), pa.array(np.maximum(x, y), pa.int64()), pa.array(match, pa.int32())]
                yield pa.RecordBatch.from_arrays(columns, ["a", "b", "match"])
                found, held = [], 0

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = None
        for rows in batches:
            if not len(rows):
                continue
            new = {k: rows.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)}
            new["keys"] = rows.column(len(names)).flatten().to_numpy(zero_copy_only=False).reshape(len(rows), TREES)
            sketches = b"".join(rows.column(len(names) + 1).to_pylist())
            new["sketch"] = np.frombuffer(sketches, dtype=np.uint8).reshape(len(rows), _FRESH // 2)
            now = new if tail is None else {k: np.concatenate([tail[k], v]) for k, v in new.items()}
            unlike = (now["key"][1:] != now["key"][:-1]) | (now["block"][1:] != now["block"][:-1])
            ends = np.flatnonzero(unlike) + 1
            if len(ends):
                yield from compared(now, ends)
            # The last group may go on in the next batch.
            tail = {k: v[ends[-1] :] for k, v in now.items()} if len(ends) else now
        if tail is not None:
            yield from compared(tail, np.array([len(tail["key"])]))

    return pairs, "a long, b long, match int"


def _confirmed(text_a: Column, text_b: Column, words: int, percent: int) -> Column:
    """Whether 100 times the intersection of the full sets is at least ``percent`` times their union."""

    @F.arrow_udf("boolean")
    def confirm(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        shingler = Shingler(words)
        for left, right in batches:
            result, before, a = [], None, np.zeros(0, dtype=np.uint64)
            for x, y in zip(left, right):
                x, y = x.as_py(), y.as_py()
                if x != before:  # candidates of one document mostly follow each other
                    before, a = x, shingler.shingles(x)
                b = shingler.shingles(y)
                both = len(np.intersect1d(a, b, assume_unique=True))
                result.append(bool(both) and 100 * both >= percent * (len(a) + len(b) - both))
            yield pa.array(result, pa.bool_())

    return confirm(text_a, text_b)


def _linked(texts: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose texts are similar enough."""
    ends = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id")))
    ends = write_through(ends.distinct(), "confirmed-ids")
    # Only texts of candidates are shuffled; their ids are broadcast while they are few.
    chosen = F.broadcast(ends) if ends.count() <= MOST_BROADCAST_IDS else ends
    needed = texts.join(chosen, texts["_key"] == ends["_id"], "left_semi")
    first = needed.select(F.col("_key").alias("b"), F.col("_text").alias("_text_b"))
    second = needed.select(F.col("_key").alias("a"), F.col("_text").alias("_text_a"))
    both = pairs.select("a", "b").join(first, "b").join(second, "a")
    sure = both.select("a", "b", _confirmed(F.col("_text_a"), F.col("_text_b"), words, percent).alias("_sure"))
    return write_through(sure.where("_sure").select("a", "b"), "confirmed-links")


def _labels(depth: int) -> list[Column]:
    """The first ``depth`` values of the label in each tree."""
    values = F.substring("sig", 1, 2 * _HASHES)
    twice = F.concat(values, values)
    return [F.substring(twice, 2 * STRIDE * t + 1, 2 * depth) for t in range(TREES)]


def _sketch() -> Column:
    """One byte of each value."""
    return F.substring("sig", 2 * _HASHES + 1, _HASHES).alias("sketch")


def _least_match(percent: int, hashes: int = _HASHES, values: int = 256) -> int:
    """Equal parts of two sketches from which on a pair may be similar enough: five standard deviations below.

    A part has so many ``values``, and parts of unequal hashes are equal by chance.
    """
    share = percent / 100 + (1 - percent / 100) / values
    return int(hashes * share - 5 * (hashes * share * (1 - share)) ** 0.5)


def _placed(nodes: DataFrame, found: DataFrame) -> DataFrame:
    """Nodes with their component."""
    return nodes.join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends are in different components."""
    end_a, end_b = (found.select(F.col("node").alias(c), F.col("component").alias(f"_{c}")) for c in "ab")
    pairs = pairs.join(end_a, "a", "left").join(end_b, "b", "left")
    return pairs.where(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def _candidates(nodes: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b, match) of the forest, and rows (a, null, 0) for crowded nodes."""
    rows = nodes.select(F.posexplode(F.array(*_labels(DEPTH))).alias("tree", "label"), "node", F.col("node").alias("component"), "n", _sketch())
    pairs, kind = _neighbours(percent, _least_match(percent))
    ordered = rows.repartitionByRange("tree", "label", "node").sortWithinPartitions("tree", "label", "node")
    return write_through(
        ordered.mapInArrow(pairs, kind).groupBy("a", "b").agg(F.max("match").alias("match")), "candidates"
    )


def _met(depth: int, percent: int) -> float:
    """What a tree in which a node's prefix has this depth adds to minus the logarithm of the chance to miss a pair."""
    return -math.log1p(-((percent / 100) ** depth))


def _fresh_forest(texts: DataFrame, pending: DataFrame, found: DataFrame, words: int, percent: int, turn: int) -> tuple[DataFrame, DataFrame]:
    """Candidate pairs (a, b, match) of pending nodes, and (node, met): what these trees add for a node."""
    chosen = F.broadcast(pending) if pending.count() <= MOST_BROADCAST_IDS else pending
    sign, kind = _fresh_signatures(words, turn)
    needed = texts.join(chosen, texts["_key"] == pending["node"], "left_semi").select(F.col("_key").alias("node"), "_text")
    # Rows of one id are one document, each text of which counts once.
    signed = needed.mapInArrow(sign, kind).withColumn("mark", F.xxhash64("sketch")).dropDuplicates(["node", "mark"])
    signed = write_through(_placed(signed, found), "fresh")
    steps = len(DEPTHS)
    trees = F.transform(F.sequence(F.lit(0), F.lit(TREES - 1)), lambda t: F.slice("keys", t * steps + 1, F.lit(steps)))
    rows, fitting, deeper = signed.select("node", "mark", "component", F.explode(trees).alias("keys")), [], []
    for step in range(steps):
        keyed = rows.withColumn("key", F.get("keys", F.lit(step)))
        counts = keyed.groupBy("key", "component").agg(F.count("*").alias("c"))
        size = F.sum("c")
        groups = counts.groupBy("key").agg(
            size.alias("size"), (size * size - F.sum(F.col("c") * F.col("c"))).alias("crossing"), F.max(F.struct("c", "component")).alias("lead")
        )
        mixed = groups.where("crossing > 0").withColumn("fits", F.col("crossing") <= 2 * CROSSING * F.col("size"))
        last = step + 1 == steps
        blocks = F.ceil(F.col("size") / BLOCK_ROWS).cast("int").alias("blocks")
        mixed = write_through(mixed.select("key", "fits", blocks, F.col("lead.component").alias("lead")), "prefixes")
        kept = keyed.join(mixed if last else mixed.where("fits"), "key")
        fitting.append(write_through(kept.select("key", "node", "mark", "component", "blocks", "lead", "fits"), "prefix-rows"))
        if last or mixed.where("not fits").isEmpty():
            break
        rows = write_through(keyed.join(mixed.where("not fits").select("key"), "key", "left_semi").drop("key"), "deeper")
        deeper.append(rows.select("node", F.lit(TREES * _met(DEPTHS[step + 1], percent)).alias("met")))
    # Prefixes that a node shares with many are deeper, so all trees count as the deepest one does.
    met = reduce(DataFrame.unionByName, [signed.select("node", F.lit(TREES * _met(DEPTHS[0], percent)).alias("met")), *deeper])
    met = met.groupBy("node").agg(F.min("met").alias("met"))

    every = reduce(DataFrame.unionByName, fitting)
    # All of few other components go to each block of the main one. Where even the deepest prefix has too many, blocks are compared within.
    minor = (F.col("component") != F.col("lead")) & F.col("fits")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    places = F.when(minor, F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own))
    dealt = every.select("key", F.explode(places).alias("block"), minor.alias("minor"), "node", "mark", "component")
    # All groups of a node in which every pair is compared, one of each tree at most.
    groups = F.sort_array(F.collect_list(F.when(F.col("fits"), F.col("key"))))
    groups = F.slice(F.concat(groups, F.array_repeat(F.lit(0).cast("long"), TREES)), 1, TREES)
    own = every.groupBy("node", "mark").agg(groups.alias("keys"))
    dealt = dealt.join(signed.select("node", "mark", "n", "sketch").join(own, ["node", "mark"]), ["node", "mark"])
    dealt = dealt.select("key", "block", "minor", "node", "component", "n", "keys", "sketch")
    pairs, kind = _block_pairs(percent)
    compared = dealt.repartition("key", "block").sortWithinPartitions("key", "block").mapInArrow(pairs, kind)
    return write_through(compared.groupBy("a", "b").agg(F.max("match").alias("match")), "fresh-candidates"), met


def _best(pairs: DataFrame) -> DataFrame:
    """The most promising pair of each second node."""
    best = pairs.groupBy("b").agg(F.max(F.struct("match", (-F.col("a")).alias("_minus"))).alias("x"))
    return write_through(best.select((-F.col("x._minus")).alias("a"), "b"), "best")


def _link_nodes(texts: DataFrame, nodes: DataFrame, words: int, percent: int) -> DataFrame:
    """(node, component) of linked nodes."""
    seen = _candidates(nodes, percent)
    pairs = seen.where("b is not null")
    best = _best(pairs)
    links = _linked(texts, best, words, percent)
    found = connected_components(links, "a", "b")

    def confirm(rest: DataFrame, tried: DataFrame | None = None) -> None:
        """Link what is in different components, similar enough and not among the pairs ``tried``."""
        nonlocal links, found
        rest = write_through(_apart(rest, found), "apart")
        # Most pairs of a crowded region are linked by now, so few are left to be looked up among those tried.
        if tried is not None:
            rest = write_through(rest.join(tried, ["a", "b"], "left_anti"), "rest")
        new = _linked(texts, rest, words, percent)
        if not new.isEmpty():
            links = write_through(links.unionByName(new), "all-links")
            found = connected_components(links, "a", "b")

    confirm(pairs, best)
    tried = pairs.select("a", "b")
    crowded = write_through(seen.where("b is null").select(F.col("a").alias("node")).distinct(), "crowded")
    met = crowded.withColumn("met", F.lit(0.0))
    for turn in count():
        if crowded.isEmpty():
            return found
        pairs, more = _fresh_forest(texts, crowded, found, words, percent, turn)
        pairs = write_through(pairs.join(tried, ["a", "b"], "left_anti"), "untried")
        best = _best(pairs)
        confirm(best)
        confirm(pairs, best)
        tried = tried.unionByName(pairs.select("a", "b"))
        met = write_through(met.unionByName(more).groupBy("node").agg(F.sum("met").alias("met")), "met")
        crowded = write_through(met.where(F.col("met") < -math.log(MOST_MISSED)).select("node"), "crowded")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", shingle_words: int = 5, percent: int = 80
) -> DataFrame:
    """One row per row of ``docs``: its key, ``n_shingles``, ``component_id`` and ``kept``.

    Documents are linked if 100 times the size of the intersection of their shingle sets is at least
    ``percent`` times that of the union. The component is the smallest key that is reachable over
    links; one document of each, that of this key, is kept. Texts that are null or have no word
    have no shingles and are linked with nothing. Rows of the same key are one document, which has
    the links of all its texts. Rows without a key join the component of a document with the same
    set, but link nothing, and are kept if there is none. No rows, no rows.
    """
    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    describe, kind = _described(shingle_words)
    sets = write_through(rows.mapInArrow(describe, kind), "signatures")
    nodes = write_through(sets.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("node")), "nodes")
    members = sets.join(nodes, ["d1", "d2"], "left")
    # Only the row that stands for a node keeps its signature.
    signed = F.when(F.col("doc_id") == F.col("node"), F.col("sig"))
    members = write_through(members.select("doc_id", "n", "node", signed.alias("sig")), "members")

    # Sets of fewer shingles than this can only be linked if they are equal.
    least_size = next(n for n in range(1, 102) if 100 * n >= percent * (n + 1)) if percent < 100 else 1 << 62
    nodes = members.where(F.col("sig").isNotNull() & (F.col("n") >= least_size)).select("node", "n", "sig")
    found = _link_nodes(rows, nodes, shingle_words, percent)
    component = F.coalesce("component", "node", "doc_id")
    return (
        members.drop("sig")
        .join(found, "node", "left")
        .select(
            F.col("doc_id").alias(key),
            F.col("n").alias("n_shingles"),
            component.alias("component_id"),
            F.col("doc_id").eqNullSafe(component).alias("kept"),
        )
    )
