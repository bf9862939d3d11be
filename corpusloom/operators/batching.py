"""Batches by position, and padding within them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.sequences import IGNORE_LABEL, ones_then_zeros, pad_right


def assign_batches(df: DataFrame, pos: str, batch_size: int, out: str = "batch_id") -> DataFrame:
    """Number the batches by position; run it before unusable rows are dropped."""
    return df.withColumn(out, F.floor((F.col(pos) - 1) / F.lit(batch_size)))


def assign_steps(
    df: DataFrame, pos: str, batch_size: int, accumulation: int, max_steps: int | None = None
) -> DataFrame:
    """Optimizer steps of ``batch_size * accumulation`` rows, numbered from 1."""
    stepped = df.withColumn("step", F.floor((F.col(pos) - 1) / F.lit(batch_size * accumulation)) + 1)
    return stepped.where(F.col("step") <= max_steps) if max_steps else stepped


def batch_report(df: DataFrame, valid: Column, batch_id: str = "batch_id") -> DataFrame:
    """Rows and valid rows of every batch, of those without any valid row too."""
    return df.groupBy(batch_id).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(valid).alias("n_valid"),
        (F.count_if(valid) == 0).alias("is_empty"),
    )


def batch_max_len(df: DataFrame, ids: str, batch_id: str = "batch_id") -> DataFrame:
    return df.groupBy(batch_id).agg(F.max(F.size(ids)).cast("bigint").alias("max_len"))


def batch_first(df: DataFrame, pos: str, value: str, out: str, batch_id: str = "batch_id") -> DataFrame:
    """The value of a batch's first row on each of its rows."""
    by_batch = Window.partitionBy(batch_id).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.first(value).over(by_batch))


def _longest(ids: str, batch_id: str) -> Column:
    # A batch holds batch_size rows at most, so its window stays small.
    return F.max(F.size(ids)).over(Window.partitionBy(batch_id))


def pad_longest(df: DataFrame, ids: str, pad_id: int, batch_id: str = "batch_id") -> DataFrame:
    """Pad to the longest row of the batch and add ``attention_mask``."""
    long = df.withColumn("_longest", _longest(ids, batch_id))
    return (
        long.withColumn("attention_mask", ones_then_zeros(F.size(ids), F.col("_longest")))
        .withColumn(ids, pad_right(F.col(ids), F.col("_longest"), F.lit(pad_id).cast("bigint")))
        .drop("_longest")
    )


def pad_spliced(
    df: DataFrame,
    embeds: str = "inputs_embeds",
    labels: str = "labels",
    batch_id: str = "batch_id",
    dim: int | None = None,
    mask: str | None = None,
    longest: str | None = None,
) -> DataFrame:
    """Pad spliced vectors with zero vectors and labels with the ignore label.

    ``attention_mask`` is 1 on every position of the sequence itself, text padding included.
    With ``mask``, a column of the sequence's own 0/1 marks, those are kept instead.
    ``longest`` names a column that already has the length of the longest row of the batch.
    """
    wide = df if longest else df.withColumn("_longest", _longest(embeds, batch_id))
    length = F.col(longest or "_longest")
    zero = F.array_repeat(F.lit(0).cast("float"), dim if dim else F.size(F.get(embeds, 0)))
    own = (
        pad_right(F.col(mask), length, F.lit(0).cast("bigint"))
        if mask
        else ones_then_zeros(F.size(embeds), length)
    )
    ignore = F.lit(IGNORE_LABEL).cast("bigint")
    return (
        wide.withColumn("attention_mask", own)
        .withColumn(embeds, pad_right(F.col(embeds), length, zero))
        .withColumn(labels, pad_right(F.col(labels), length, ignore))
        .drop("_longest")
    )


def collate_udf(df: DataFrame, fn, schema: str, batch_id: str | Sequence[str] = "batch_id") -> DataFrame:
    """Any Python function over one batch as a pandas frame."""
    keys = [batch_id] if isinstance(batch_id, str) else list(batch_id)
    return df.groupBy(*keys).applyInPandas(fn, schema)
