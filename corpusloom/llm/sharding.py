"""Sharding by rendezvous hashing of stable record keys over weighted shards.

Every shard bids for every key, and the lowest bid has it. A bid is ``-ln(u) / weight`` for a number
``u`` that depends on shard and key alone, so a shard's share follows its weight, a new shard takes
keys only into itself, a shard that goes gives its keys to all others, and a changed weight moves keys only
to or from that shard. Bids are made of MD5, which any other system can compute as well.

Shards are found in the row, without a shuffle. Places within a shard come from ``ordinal``, which
spreads each shard over as many ranges as it needs; only ids and numbers are shuffled, never texts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import write_through
from corpusloom.operators.ordinal import ordinal

# Hexadecimal digits of a digest that make the number of a bid: 52 bits, which a double holds.
_DIGITS = 13


def _bid(key: Column, shard: int, weight: float) -> Column:
    digest = F.md5(F.concat(F.lit(f"{shard}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    number = F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double")
    # From 0 to 1, without both.
    return F.log((number + 0.5) / float(1 << (4 * _DIGITS))) / -weight


def rendezvous_shard(key: Column, weights: Mapping[int, float]) -> Column:
    """The shard of a key as an int, of the shards that ``weights`` names with their positive weights.

    It depends on the key's text and the weights alone. All rows without a key, and those of an empty
    one, are in one shard. Equal bids, which need equal digests, go to the smaller shard.
    """
    if not weights or min(weights.values()) <= 0:
        raise ValueError("shards need positive weights")
    bids = [F.struct(_bid(key, s, float(w)).alias("bid"), F.lit(s).alias("shard")) for s, w in sorted(weights.items())]
    return (F.array_min(F.array(*bids)) if len(bids) > 1 else bids[0])["shard"].cast("int")


def shard_records(rows: DataFrame, key: str, weights: Mapping[int, float], order: Sequence[str] = ()) -> DataFrame:
    """``rows`` with their ``shard`` and their ``slot`` in it, numbered from 0 without gaps.

    Slots follow the key (null first), then the columns of ``order``; rows equal in all of these are in any
    order, and a key that holds most rows is spread over many tasks like any other. Give narrow rows and
    join others by their key: they are written once and sorted. Columns named ``shard`` or ``slot`` are
    replaced. No rows, no rows.
    """
    taken = {"shard", "slot", "_tie"}
    others = [c for c in rows.columns if c not in taken]
    placed = rows.select(*others, rendezvous_shard(F.col(key), weights).alias("shard"), F.monotonically_increasing_id().alias("_tie"))
    # Written, so that equal rows keep their ties if a task is repeated.
    numbered = ordinal(write_through(placed, "shards"), [key, *order, "_tie"], ["shard"], out="slot")
    return numbered.select(*others, "shard", (F.col("slot") - 1).alias("slot"))


def moved_records(rows: DataFrame, key: str, before: Mapping[int, float], after: Mapping[int, float]) -> DataFrame:
    """``(from_shard, to_shard, n)``: how many rows change their shard between two sets of weights."""
    both = rows.select(rendezvous_shard(F.col(key), before).alias("from_shard"), rendezvous_shard(F.col(key), after).alias("to_shard"))
    return both.where("from_shard <> to_shard").groupBy("from_shard", "to_shard").agg(F.count("*").alias("n"))


def write_shards(rows: DataFrame, key: str, weights: Mapping[int, float], path: str) -> None:
    """Write whole rows below ``path``, one folder ``shard=<n>`` for each shard.

    Rows are shuffled once by shard; a shard with more than one task's share is split over several tasks, each
    with a file of its own. A column named ``shard`` is replaced.
    """
    placed = rows.withColumn("shard", rendezvous_shard(F.col(key), weights))
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
