"""Many-to-one lookups whose keys are far from evenly used."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import write_through

# Rows of a lookup table that are broadcast for its most used keys.
HEAD_ROWS = 50_000
MOST_HEAD_BYTES = 64 * 1024 * 1024

# Stands for a missing id where ids travel with their place.
NO_ID = (1 << 32) - 1

# Keys that are told apart by counting where ranks are not known.
COUNTED_KEYS = 1000


def head_rows_for(row_bytes: int) -> int:
    """How many lookup rows of this size may be broadcast."""
    return max(1, min(HEAD_ROWS, MOST_HEAD_BYTES // max(1, row_bytes)))


def frequent_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """The ``n`` most used keys. Any other key holds at most one ``n``-th of the rows."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_uses"))
    return counts.orderBy(F.desc("_uses"), key).limit(n).select(key)


def lookup_join(facts: DataFrame, lookup: DataFrame, on: str, head: DataFrame) -> DataFrame:
    """Left join of ``facts`` with a lookup table that has one row per key.

    ``head`` holds the lookup rows of the most used keys and has a fixed largest size, so it is
    broadcast; facts with those keys, or with none, are never shuffled by key. What remains has
    no hot key and is joined in whichever way the planner finds best. ``facts`` are computed once:
    what the broadcast part finds is written out, and both parts go on from there. The key itself is
    not part of the result.
    """
    values = [c for c in lookup.columns if c != on]
    head = head.select(*lookup.columns).withColumn("_found", F.lit(True))
    seen = facts.join(F.broadcast(head), on, "left").withColumn("_done", F.col("_found").isNotNull() | F.col(on).isNull())
    # A key that was found is not needed any more, its value is.
    keep_key = F.when(~F.col("_done"), F.col(on)).alias(on)
    others = [c for c in facts.columns if c != on]
    seen = write_through(seen.select(*others, keep_key, *values, "_done"), "looked-up")
    found = seen.where("_done").drop("_done", on)
    rest = seen.where(~F.col("_done")).drop("_done", *values).join(lookup, on, "left").drop(on)
    return found.unionByName(rest)


def regroup(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str) -> DataFrame:
    """Undo ``posexplode_outer``: the values of each key as an array in the order of ``pos``."""
    pair = F.when(F.col(pos).isNotNull(), F.struct(pos, value))
    return (
        df.groupBy(*keys)
        .agg(F.sort_array(F.collect_list(pair)).alias("_pairs"))
        .select(*keys, F.col(f"_pairs.{value}").alias(out))
    )


def regroup_ids(df: DataFrame, keys: Sequence[str], pos: str, value: str, out: str) -> DataFrame:
    """``regroup`` for ids from 0 to 2^32 - 2, which travel with their place in one number.

    That is a quarter of what a pair takes in the shuffle, and numbers are sorted much faster.
    """
    code = (
        F.when(F.col(value).isNull(), F.lit(NO_ID))
        .when(F.col(value).between(0, NO_ID - 1), F.col(value))
        .otherwise(F.raise_error(F.lit("id out of range")).cast("bigint"))
    )
    packed = F.shiftleft(F.col(pos).cast("bigint"), 32) + code
    collected = F.sort_array(F.collect_list(F.when(F.col(pos).isNotNull(), packed)))

    def unpacked(number: Column) -> Column:
        low = number.bitwiseAND(F.lit(NO_ID))
        return F.when(low != NO_ID, low)

    return (
        df.groupBy(*keys)
        .agg(collected.alias("_packed"))
        .select(*keys, F.transform("_packed", unpacked).alias(out))
    )
