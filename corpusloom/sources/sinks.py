"""Metric and report tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCALAR_SCHEMA = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("run_id", T.StringType()),
    ]
)
TEXT_SCHEMA = T.StructType(
    [
        T.StructField("tag", T.StringType()),
        T.StructField("step", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("run_id", T.StringType()),
    ]
)

# Folders over which runs are spread by hash, however many there are.
RUN_FOLDERS = 16

# The tags under which evaluation results are kept.
WER_TAG = "eval/wer"
PREDICTIONS_TAG = "eval/predictions"


def run_path(started: Column, root: str = "outputs", job: Column | None = None) -> Column:
    """A run's output folder; runs of a sweep have ``root="multirun"`` and a job number."""
    folder = F.concat(F.lit(f"{root}/"), F.date_format(started, "yyyy-MM-dd/HH-mm-ss"))
    return folder if job is None else F.concat(folder, F.lit("/"), job.cast("string"))


def _write(df: DataFrame, schema: T.StructType, path: str, part: str | None) -> None:
    if part in ("", "-"):
        raise ValueError("a part has a name, and - stands for appended rows")
    fields = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    # Appended rows go into a fixed number of folders. A part has one for each of its runs, as it replaces what these held.
    folder = F.col("run_id") if part else F.pmod(F.xxhash64("run_id"), F.lit(RUN_FOLDERS)).cast("string")
    placed = df.select(*fields).withColumn("part", F.lit(part or "-")).withColumn("folder", folder)
    # By range, so that small runs share a file and a large run gets several.
    order = ["folder", "run_id", "tag", "step"]
    writer = placed.repartitionByRange(*order).sortWithinPartitions("part", *order).write.partitionBy("part", "folder")
    if part is None:
        writer.mode("append").parquet(path)
    else:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)


def write_scalars(df: DataFrame, path: str, part: str | None = None) -> None:
    """Append ``(run_id, tag, step, value)``, or write them as ``part`` of their runs in place of what it held."""
    _write(df, SCALAR_SCHEMA, path, part)


def write_texts(df: DataFrame, path: str, part: str | None = None) -> None:
    """``write_scalars`` for ``(run_id, tag, step, text)``."""
    _write(df, TEXT_SCHEMA, path, part)


def _stored(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("part", T.StringType()), T.StructField("folder", T.StringType())])


def read_scalars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_stored(SCALAR_SCHEMA)).parquet(path).drop("part", "folder")


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_stored(TEXT_SCHEMA)).parquet(path).drop("part", "folder")
