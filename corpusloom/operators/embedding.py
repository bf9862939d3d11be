"""Embedding tables: gather by id, vector statistics, vectors for new tokens."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.lookup import COUNTED_KEYS, frequent_keys, head_rows_for, lookup_join, regroup
from corpusloom.session import write_through

# Fixed value: noise on a new vector as a share of the table's standard deviation.
NEW_VECTOR_SCALE = 0.02


def embedding_gather(
    df: DataFrame,
    keys: Sequence[str],
    ids: str,
    embeddings: DataFrame,
    dim: int,
    out: str = "embeds",
    ranked: bool = False,
) -> DataFrame:
    """``(keys, out)``: the vector of each id, in the order of the ids.

    ``embeddings`` is ``(id, vector)``. The vectors of the most used ids are broadcast. Those
    ids are counted first, unless ids are ``ranked`` by use, as ``vocab_build`` gives them.
    """
    exploded = df.select(*keys, F.posexplode_outer(ids).alias("_at", "id"))
    most = head_rows_for(4 * dim)
    if ranked:
        head = embeddings.where(F.col("id") < most)
    else:
        exploded = write_through(exploded, "ids")
        used = write_through(frequent_keys(exploded, "id", min(most, COUNTED_KEYS)), "used")
        head = embeddings.join(F.broadcast(used), "id", "left_semi")
    found = lookup_join(exploded, embeddings.select("id", "vector"), "id", head)
    return regroup(found, keys, "_at", "vector", out)


def store_bucketed(embeddings: DataFrame, table: str, path: str, buckets: int) -> DataFrame:
    """Write ``(id, vector)`` at ``path`` as ``table``, in buckets by id, so that joins by id need not shuffle it again.

    A bucket is read by one task; give as many as the table has tasks' shares.
    """
    writer = embeddings.select("id", "vector").repartition(buckets, "id").write.bucketBy(buckets, "id").sortBy("id")
    writer.mode("overwrite").option("path", path).saveAsTable(table)
    return embeddings.sparkSession.table(table)


def gather_bucketed(df: DataFrame, keys: Sequence[str], ids: str, bucketed: DataFrame, buckets: int, out: str = "embeds") -> DataFrame:
    """``embedding_gather`` from a table of ``store_bucketed``, which stays where it is.

    Each id goes to its bucket once per row, with all its places in it, so an id that is in every row moves as often as there are rows and no
    oftener; vectors are shuffled once, to their rows. Ids without a vector are left out, as are rows without any id.
    """
    placed = df.select(*keys, F.posexplode(ids).alias("_at", "id")).where(F.col("id").isNotNull())
    wanted = placed.groupBy(*keys, "id").agg(F.collect_list("_at").alias("_places"))
    # The number of buckets is that of the shuffle, and the side in buckets needs none.
    met = wanted.repartition(buckets, "id").join(bucketed.hint("merge"), "id")
    pairs = met.select(*keys, F.explode("_places").alias("_at"), "vector")
    return regroup(pairs, keys, "_at", "vector", out)


def vector_mean(df: DataFrame, vector: str) -> DataFrame:
    """``(dim, mean)``: the mean of each dimension over all rows."""
    return (
        df.select(F.posexplode(vector).alias("dim", "value"))
        .groupBy("dim")
        .agg(F.avg(F.col("value").cast("double")).alias("mean"))
    )


def vector_std(df: DataFrame, vector: str) -> DataFrame:
    """One row: the unbiased standard deviation over all elements of all rows."""
    return df.select(F.explode(vector).alias("value")).agg(
        F.stddev_samp(F.col("value").cast("double")).alias("std")
    )


def _noise(*parts: Column) -> Column:
    """A standard normal number that depends on ``parts`` alone, so a retried task repeats it."""

    def uniform(salt: int) -> Column:
        return (F.pmod(F.xxhash64(F.lit(salt), *parts), F.lit(1 << 52)) + 1) / F.lit(float(1 << 52))

    return F.sqrt(F.log(uniform(1)) * -2) * F.cos(uniform(2) * (2 * math.pi))


def init_new_vectors(
    embeddings: DataFrame,
    tokens: Sequence[tuple[str, int]],
    scale: float = NEW_VECTOR_SCALE,
    seed: int = 42,
    vector: str = "vector",
) -> DataFrame:
    """``(token, id, vector)`` for new tokens: the mean vector plus scaled normal noise.

    One pass gives the moments of each dimension; the deviation over all elements follows from
    them. What is left after that pass is one row per dimension.
    """
    value = F.col("value").cast("double")
    moments = (
        embeddings.select(F.posexplode(vector).alias("dim", "value"))
        .groupBy("dim")
        .agg(F.count(value).alias("n"), F.avg(value).alias("mean"), F.var_pop(value).alias("var"))
    )
    total = moments.agg(
        F.sum("n").alias("n"),
        (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("grand"),
        F.collect_list(F.struct("dim", "n", "mean", "var")).alias("dims"),
    )
    spread = F.aggregate(
        "dims",
        F.lit(0.0),
        lambda acc, d: acc + d["n"] * (d["var"] + (d["mean"] - F.col("grand")) * (d["mean"] - F.col("grand"))),
    )
    new = F.array(*(F.struct(F.lit(t).alias("token"), F.lit(i).cast("bigint").alias("id")) for t, i in tokens))
    per_dim = (
        total.select("dims", F.sqrt(spread / (F.col("n") - 1)).alias("std"), F.explode(new).alias("new"))
        .select("new.*", "std", F.explode("dims").alias("d"))
        .select("token", "id", "std", "d.dim", "d.mean")
    )
    noisy = F.col("mean") + _noise(F.lit(seed), F.col("token"), F.col("dim")) * F.col("std") * scale
    return regroup(per_dim.withColumn("value", noisy), ["token", "id"], "dim", "value", "vector")
