"""Ordered unions of sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.ordinal import ordinal
from corpusloom.session import write_through


def union_sources(sources: Sequence[DataFrame], out: str = "k") -> DataFrame:
    """All sources one after another; ``out`` is the place of the source in the list, from 0."""
    if not sources:
        raise ValueError("no sources")
    numbered = [df.withColumn(out, F.lit(k)) for k, df in enumerate(sources)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), numbered)


def first_exhausted(sizes: Sequence[int]) -> tuple[int, int]:
    """The last (row, source) that a round-robin over sources of these sizes reaches.

    It stops at the first source found to have nothing after its row, or nothing at all.
    """
    return min((max(n, 1), k) for k, n in enumerate(sizes))


def interleave(
    sources: Sequence[DataFrame],
    order_by: str,
    key: Sequence[str] | None = None,
    out: str = "pos",
    limit: int | None = None,
) -> DataFrame:
    """Round-robin over the sources, row by row, until the first of them runs out.

    Rows of a source come in the order of ``order_by``, which is unique within it, as is
    ``key``. Adds ``k`` (source), ``rn`` (row in the source) and ``out`` (row in the result). A
    single source passes through in its own order. A source is read, and whatever filters it has
    are run, once for its keys; ordering looks at the written keys alone. Only rows up to the
    stopping point, or to the ``limit``-th row of the result, are read a second time.
    """
    key = list(key or [order_by])
    narrow = [df.select(*dict.fromkeys([*key, order_by])) for df in sources]
    places = ordinal(write_through(union_sources(narrow), "keys"), [order_by], ["k"], out="rn")
    if len(sources) == 1:
        kept = places.withColumn(out, F.col("rn"))
        only = sources[0]
        if limit:
            kept = kept.where(F.col("rn") <= limit)
            only = only.where(F.col(order_by) <= F.lit(kept.agg(F.max(order_by)).first()[0]))
        return only.withColumn("k", F.lit(0)).join(kept.select(*key, "k", "rn", out), [*key, "k"])

    # One row per configured source.
    counted = {r["k"]: r["n"] for r in places.groupBy("k").agg(F.max("rn").alias("n")).collect()}
    sizes = [counted.get(k, 0) for k in range(len(sources))]
    row, source = first_exhausted(sizes)
    if limit:
        row, source = min((row, source), ((limit - 1) // len(sources) + 1, (limit - 1) % len(sources)))
    kept = places.where((F.col("rn") < row) | ((F.col("rn") == row) & (F.col("k") <= source)))
    kept = kept.withColumn(out, (F.col("rn") - 1) * len(sources) + F.col("k") + 1)

    last = {r["k"]: r["v"] for r in kept.groupBy("k").agg(F.max(order_by).alias("v")).collect()}
    read = [
        df.where(F.col(order_by) <= F.lit(last[k])) if k in last else df.where(F.lit(False))
        for k, df in enumerate(sources)
    ]
    return union_sources(read).join(kept.select(*key, "k", "rn", out), [*key, "k"])
