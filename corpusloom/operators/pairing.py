"""Pairing two tables by position, without a key that both have."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import write_through


class UnequalLengths(ValueError):
    """The tables have different numbers of rows."""


def _numbered(df: DataFrame, order_by: Sequence[str | Column]) -> DataFrame:
    """The rows in sorted ranges, written once, with the range and the place in it."""
    ranged = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    placed = write_through(ranged.withColumn("_row", F.monotonically_increasing_id()), "positions")
    return placed.withColumn("_range", F.shiftright("_row", 33)).withColumn("_place", F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)))


def _ranges(numbered: DataFrame) -> tuple[DataFrame, int]:
    """``(_range, _start)``, where each range begins, and the number of all rows. The driver adds up one number per range."""
    counts = sorted(map(tuple, numbered.groupBy("_range").agg(F.count(F.lit(1))).collect()))
    starts = list(accumulate((n for _, n in counts), initial=0))
    kind = pa.schema([("_range", pa.int64()), ("_start", pa.int64())])
    table = pa.table([[r for r, _ in counts], starts[:-1]], schema=kind)
    return numbered.sparkSession.createDataFrame(table), starts[-1]


def _positions(numbered: DataFrame, starts: DataFrame, pos: str) -> DataFrame:
    """The rows with their position from 1."""
    # One row per range, of which there are no more than shuffle partitions.
    return numbered.join(F.broadcast(starts), "_range").withColumn(pos, F.col("_start") + F.col("_place") + 1).drop("_row", "_range", "_place", "_start")


def zip_by_position(
    left: DataFrame,
    right: DataFrame,
    left_order: Sequence[str | Column],
    right_order: Sequence[str | Column],
    pos: str = "pos",
    strict: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Row i of ``left`` next to row i of ``right``, and a table of lengths.

    Each table is sorted in ranges of its own order, however it is partitioned; ranges become stretches
    of positions, and rows meet by position. No task sees a whole table, and no row is compared with
    more than one other. Orders without ties give the same pairs in every run; rows that tie are in any
    order, but are in it once. Columns of both tables must differ by name.

    The second result is one row ``(n_left, n_right, n_paired, left_surplus, right_surplus)``. With
    ``strict``, tables of unequal length raise ``UnequalLengths``; else rows beyond the shorter
    table have no partner and are left out, as many as the surplus says.
    """
    if both := {*left.columns} & {*right.columns}:
        raise ValueError(f"both tables have columns {sorted(both)}")
    if pos in {*left.columns, *right.columns}:
        raise ValueError(f"a table has a column {pos}")
    sides = [_numbered(df, order) for df, order in ((left, left_order), (right, right_order))]
    (left_starts, n_left), (right_starts, n_right) = map(_ranges, sides)
    if strict and n_left != n_right:
        raise UnequalLengths(f"{n_left} rows on the left, {n_right} on the right")
    paired = min(n_left, n_right)
    first, second = (_positions(side, starts, pos) for side, starts in zip(sides, (left_starts, right_starts)))
    # What has no partner does not go into the join.
    pairs = first.where(F.col(pos) <= paired).join(second.where(F.col(pos) <= paired), pos)
    numbers = {"n_left": n_left, "n_right": n_right, "n_paired": paired, "left_surplus": n_left - paired, "right_surplus": n_right - paired}
    lengths = left.sparkSession.range(1).select(*(F.lit(n).cast("bigint").alias(name) for name, n in numbers.items()))
    return pairs.select(pos, *left.columns, *right.columns), lengths
