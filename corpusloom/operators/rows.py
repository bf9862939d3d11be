"""Row filters that also rewrite the row, and tolerance for bad rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filter_map(df: DataFrame, column: str, value: Column) -> DataFrame:
    """Replace a column and keep only rows where the new value is not NULL.

    A filter over the new column would compute its expression a second time below the
    projection; the generator gives one row or none from a single computation.
    """
    return df.withColumn(column, F.explode(F.array_compact(F.array(value))))


def spread_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows dealt out by the hash of a key, ahead of work that costs far more than moving them.

    A task reads whole row groups, so a table of few large ones gives few tasks, whatever its rows cost afterwards. Give only
    the columns that work needs, before they are made larger. The number of parts is that of shuffle partitions and is kept.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, F.xxhash64(key))


def tolerant_rows(df: DataFrame, **checks: Column) -> tuple[DataFrame, DataFrame]:
    """Rows that pass all checks, and a count of the others by the first check they fail.

    A check that is NULL, as ``try_`` functions give it for a bad value, is failed.
    """
    reason = F.coalesce(
        *(F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items())
    )
    marked = df.withColumn("_reason", reason)
    rejected = (
        marked.where(F.col("_reason").isNotNull())
        .groupBy(F.col("_reason").alias("reason"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return marked.where(F.col("_reason").isNull()).drop("_reason"), rejected


def pieces(column: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """From and below which rows a column of arrays or texts has pieces of at most ``most`` elements or bytes, or of one row that has more.

    A task that works piece by piece holds no more at once than that, however many and long the rows of a batch are.
    """
    length = pc.binary_length if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else pc.list_value_length
    ends = np.cumsum(pc.fill_null(length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    low = 0
    while low < len(ends):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield low, high
        low = high
