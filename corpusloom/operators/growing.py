"""Positions in a table that grows: an append numbers its own rows and the ranges that they fall into.

Rows lie in sorted ranges, each a folder that is written once. A directory says where every range begins and ends and how many
rows it has; the position of a row is its place in its range after the rows of all ranges before. An append finds
the range of each new row by its key, rewrites ranges that get any, adds ranges for what lies beyond the last
one, and writes a new directory; other ranges are neither read nor written, though the positions in them move. The directory is
written last, so an append that breaks off changes nothing. The driver holds one row per range.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_PLACES = "gen string, range int, owner int"
_KEY = [T.StructField("gen", T.StringType()), T.StructField("range", T.IntegerType()), T.StructField("owner", T.IntegerType())]


def _stored(schema: T.StructType, *places: T.StructField) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_row", T.LongType()), *places])


def _directory(spark: SparkSession, path: str) -> tuple[int, list[Row]]:
    """The newest version of the directory, in order of keys."""
    versions = spark.read.parquet(f"{path}/directory")
    newest = versions.agg(F.max("version")).first()[0]
    return newest, versions.where(F.col("version") == newest).orderBy("first").collect()


def _write_ranges(rows: DataFrame, order_by: Sequence[str], path: str) -> DataFrame:
    """Rows with an ``owner`` in sorted ranges of it; returns their part of a directory."""
    gen, columns = uuid.uuid4().hex, [c for c in rows.columns if c != "owner"]
    ordered = rows.repartitionByRange("owner", *order_by).sortWithinPartitions("owner", *order_by)
    numbered = ordered.withColumn("_row", F.monotonically_increasing_id()).withColumn("range", F.spark_partition_id())
    # A range belongs to one owner, so that none reaches over a range that stays.
    numbered.write.partitionBy("range", "owner").parquet(f"{path}/rows/gen={gen}")
    kind = _stored(rows.select(*columns).schema, *_KEY[1:])
    written = rows.sparkSession.read.schema(kind).parquet(f"{path}/rows/gen={gen}")
    key = F.struct(*order_by)
    ends = (F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("n"), F.min("_row").alias("row0"))
    return written.groupBy("range", "owner").agg(*ends).withColumn("gen", F.lit(gen))


def _commit(entries: DataFrame, path: str, version: int) -> None:
    entries = entries.select("first", "last", "n", "row0", "gen", "range", "owner")
    entries.coalesce(1).write.parquet(f"{path}/directory/version={version}")


def create_positions(rows: DataFrame, order_by: Sequence[str], path: str) -> None:
    """Begin a numbered table at ``path``; ``order_by`` has no ties. Columns named ``range``, ``owner`` or ``gen`` are not allowed."""
    _commit(_write_ranges(rows.withColumn("owner", F.lit(0)), order_by, path), path, 0)


def _owner(entries: Sequence[Row], order_by: Sequence[str]):
    """The range of each key: the last one that begins at or before it, the first one for keys before all, one more beyond the end."""
    firsts = [tuple(e["first"]) for e in entries]
    last = tuple(entries[-1]["last"]) if entries else None

    @F.arrow_udf("int")
    def owner(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for keys in batches:
            found = []
            for value in keys.to_pylist():
                key = tuple(value[c] for c in order_by)
                found.append(len(firsts) if last is None or key > last else max(bisect_right(firsts, key) - 1, 0))
            yield pa.array(found, pa.int32())

    return owner(F.struct(*order_by))


def append_positions(rows: DataFrame, order_by: Sequence[str], path: str) -> list[tuple[str, int, int]]:
    """Add rows; returns the ranges ``(gen, range, owner)`` that were rewritten. Keys are not null."""
    spark = rows.sparkSession
    version, entries = _directory(spark, path)
    staged = f"{path}/staged/{uuid.uuid4().hex}"
    rows.withColumn("owner", _owner(entries, order_by)).write.parquet(staged)
    new = spark.read.parquet(staged)
    touched = [entries[r[0]] for r in new.select("owner").distinct().collect() if r[0] < len(entries)]
    number = {(e["gen"], e["range"], e["owner"]): i for i, e in enumerate(entries)}
    if touched:
        places = [(e["gen"], e["range"], e["owner"]) for e in touched]
        owners = spark.createDataFrame([(*p, number[p]) for p in places], f"{_PLACES}, _owner int")
        old = _rows(spark, path, touched, rows).join(F.broadcast(owners), ["gen", "range", "owner"])
        new = new.unionByName(old.withColumn("owner", F.col("_owner")).select(*new.columns))
    gone = {(e["gen"], e["range"], e["owner"]) for e in touched}
    made = _write_ranges(new, order_by, path)
    before = spark.read.parquet(f"{path}/directory").where(F.col("version") == version).drop("version")
    left_out = spark.createDataFrame(sorted(gone), _PLACES)
    stays = before.join(F.broadcast(left_out), ["gen", "range", "owner"], "left_anti")
    _commit(stays.unionByName(made), path, version + 1)
    return sorted(gone)


def _rows(spark: SparkSession, path: str, entries: Sequence[Row], like: DataFrame) -> DataFrame:
    """The rows of some ranges; no other folder is listed or read."""
    folders = [f"{path}/rows/gen={e['gen']}/range={e['range']}/owner={e['owner']}" for e in entries]
    kind = _stored(like.schema, *_KEY)
    return spark.read.schema(kind).option("basePath", f"{path}/rows").parquet(*folders)


def read_positions(spark: SparkSession, path: str, like: DataFrame, out: str = "pos") -> DataFrame:
    """All rows with their position from 1, columns as those of ``like``."""
    _, entries = _directory(spark, path)
    if not entries:
        return like.where("false").withColumn(out, F.lit(0).cast("long"))
    starts = accumulate((e["n"] for e in entries), initial=0)
    table = [(e["gen"], e["range"], e["owner"], start - e["row0"]) for e, start in zip(entries, starts)]
    shifts = spark.createDataFrame(table, f"{_PLACES}, _shift long")
    found = _rows(spark, path, entries, like).join(F.broadcast(shifts), ["gen", "range", "owner"])
    return found.withColumn(out, F.col("_row") + F.col("_shift") + 1).select(*like.columns, out)
