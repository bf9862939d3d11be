"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import write_through

# Links that one task contracts in its memory.
LINKS_PER_TASK = 500_000
_LINKS = "u long, v long"


def _local_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each end of a task's links with the smallest node it reaches over them."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            if a != b:
                parent[max(a, b)] = min(a, b)
    ends = [(x, root(x)) for x in list(parent)]
    ends = [(x, r) for x, r in ends if x != r]
    for at in range(0, len(ends), 100_000):
        part = ends[at : at + 100_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], ["u", "v"]
        )


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node is linked to one other that has no such link itself."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("child")).unionByName(
        edges.select(F.col("v").alias("x"), F.lit(0).alias("child"))
    )
    seen = ends.groupBy("x").agg(F.sum("child").alias("up"), F.min("child").alias("least"))
    return seen.where((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("least") == 0))).isEmpty()


def connected_components(links: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for each node that has a link to another one; the component is its smallest node.

    Links are first contracted in tasks of at most ``LINKS_PER_TASK``. Where that leaves more than
    stars, large and small stars alternate: every node's larger neighbours are linked to its
    smallest one, then the smaller ones and itself, until only stars are left. Each step is a
    minimum by node, which is combined before the shuffle, and a join, in which a node with very
    many links can be split. Every round is written out, so a lost executor repeats one round at
    most. Links with a null end and those of a node to itself say nothing; repeated links count
    once; no links, no rows.
    """
    plain = links.select(F.col(u).cast("long").alias("u"), F.col(v).cast("long").alias("v"))
    plain = plain.where(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    tasks = max(1, -(-plain.count() // LINKS_PER_TASK))
    edges = write_through(plain.coalesce(tasks).mapInArrow(_local_roots, _LINKS), "links")
    while tasks > 1 and not _are_stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = write_through(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        # Large star: larger neighbours of a node go to its smallest one.
        large = both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = write_through(large.where(F.col("u") != F.col("v")).distinct(), "large-star")
        # Small star: a node and its smaller neighbours, all of which are its links now, go to the smallest.
        least = write_through(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
        edges = write_through(small.where(F.col("u") != F.col("v")).distinct(), "small-star")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
