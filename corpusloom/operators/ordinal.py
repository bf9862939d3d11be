"""Exact positions in an ordered table without a one-task window."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import write_through


def ordinal(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    out: str = "pos",
    ranges: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row within its group.

    Equal to ``row_number()`` over the same partitioning and order, for an order without ties.
    Rows are spread by ranges of (group, order), so a group of any size is split over many
    tasks. The sorted rows are written once; what joins them afterwards is one start value per
    (range, group). Pass key columns only and join wide rows back by key. ``df`` is run twice, for
    the bounds of the ranges and for its rows, so write it first if it is costly to compute.
    """
    groups = list(partition_by)
    order = [*groups, *order_by]
    # Without a number the ranges are merged at run time while they are small.
    ranged = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    placed = write_through(
        ranged.sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()),
        "ordinal",
    ).withColumn("_range", F.shiftright("_row", 33))

    starts = placed.groupBy(*groups, "_range").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = starts.select(
        *(F.col(c).alias(f"_of_{c}") for c in groups),
        F.col("_range").alias("_of_range"),
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
    )
    # A missing group value is a group like any other.
    same = reduce(
        lambda x, y: x & y,
        (placed[c].eqNullSafe(starts[f"_of_{c}"]) for c in groups),
        placed["_range"] == starts["_of_range"],
    )
    return (
        placed.join(starts, same)
        .withColumn(out, F.col("_row") + F.col("_shift") + 1)
        .select(*df.columns, out)
    )


def attach_ordinal(
    df: DataFrame,
    key: Sequence[str],
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    out: str = "pos",
) -> DataFrame:
    """``ordinal`` for wide rows: only key and order columns are sorted and written."""
    narrow = list(dict.fromkeys([*partition_by, *key, *order_by]))
    places = ordinal(df.select(*narrow), order_by, partition_by, out)
    on = list(dict.fromkeys([*partition_by, *key]))
    return df.join(places.select(*on, out), on)


def take_n(df: DataFrame, pos: str, n: int | None) -> DataFrame:
    """The first ``n`` rows by a dense position; no ``n`` means all of them."""
    return df.where(F.col(pos) <= n) if n else df


def first_n(df: DataFrame, order_by: Sequence[str | Column], n: int | None, out: str = "pos") -> DataFrame:
    """The first ``n`` rows of a table in an order without ties, with their position; no ``n`` means all of them.

    Each task keeps its own first ``n`` rows, so nothing is sorted as a whole.
    """
    if not n:
        return attach_ordinal(df, [str(c) for c in order_by], [str(c) for c in order_by], out=out)
    # At most n rows are left to be numbered.
    return df.orderBy(*order_by).limit(n).withColumn(out, F.row_number().over(Window.orderBy(*order_by)).cast("bigint"))
