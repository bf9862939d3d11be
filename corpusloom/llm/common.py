"""What several of these operators need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.session import fresh_path, write_through

__all__ = ["WORD", "crc_remainder", "documents", "fresh_path", "hash_share", "table", "word_count", "write_through"]

# Words are runs of anything but these six characters.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder, which may be on any file system that Spark reads."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def word_count(text: Column) -> Column:
    """The number of words as a long; no text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_remainder(key: Column, n: int) -> Column:
    """The remainder of the key's checksum, -1 without a key."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % n, F.lit(-1))


def hash_share(key: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on nothing but the key; rows without a key have one too."""
    return F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / float(1 << 30)
