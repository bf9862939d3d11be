"""Reading input of which some cannot be read: good rows go on, the rest is kept with its place and the reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import write_through

# Why something is in quarantine.
MALFORMED, WRONG_TYPE, MISSING, UNREADABLE_FILE = "malformed", "wrong type", "missing", "unreadable file"


def _fits(value: Column, kind: T.DataType) -> Column:
    """Whether a text can be read as a type; an absent one can."""
    return F.lit(True) if isinstance(kind, T.StringType) else value.isNull() | value.try_cast(kind).isNotNull()


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of files with a JSON object per line; every line that is not blank is in one of the two.

    A line that is no object is malformed. A scalar field that cannot be read as its type, or that is null though ``schema``
    does not allow it, is named, the first such one in the order of ``schema``. Quarantined lines come as
    ``(file, block, reason, field, content)``: the file, the byte at which the part of it begins that a task read, and the whole
    line. Lines are read once and written with what was found; both results go on from there.
    """
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = spark.read.text(path).select(F.col("value").alias("content"), *place).where(F.trim("content") != "")
    scalars = {f.name for f in schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))}
    # Scalars as texts first, which any of them can be; then nothing is lost if one has another type.
    loose = T.StructType([T.StructField(f.name, T.StringType() if f.name in scalars else f.dataType) for f in schema.fields])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}
    parsed = lines.withColumn("_row", F.from_json("content", T.StructType([*loose.fields, T.StructField("_bad", T.StringType())]), options))

    def reason(name: str, field: str | None = None) -> Column:
        return F.struct(F.lit(name).alias("reason"), F.lit(field).cast("string").alias("field"))

    row = F.col("_row")
    whole = F.regexp_like("content", F.lit(r"^\s*\{"))
    checks = [F.when(row.isNull() | row["_bad"].isNotNull() | ~whole, reason(MALFORMED))]
    for f in schema.fields:
        if f.name in scalars:
            checks.append(F.when(~_fits(row[f.name], f.dataType), reason(WRONG_TYPE, f.name)))
        if not f.nullable:
            checks.append(F.when(row[f.name].isNull(), reason(MISSING, f.name)))
    judged = write_through(parsed.withColumn("_why", F.coalesce(*checks)), "lines")
    fields = [(row[f.name].try_cast(f.dataType) if f.name in scalars else row[f.name]).alias(f.name) for f in schema.fields]
    good = judged.where(F.col("_why").isNull()).select(*fields)
    return good, judged.where(F.col("_why").isNotNull()).select("file", "block", "_why.reason", "_why.field", "content")


def _plain(path: Column) -> Column:
    """File names as listing and rows both have them."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def read_parquet_files(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """``(rows, quarantine)`` of a folder of Parquet files: rows of all that can be read, ``(file, length, reason)`` of those that give none.

    A file that breaks off gives the rows before that place. Files are listed and rows tell theirs; contents are read once.
    """
    rows = spark.read.schema(schema).option("ignoreCorruptFiles", "true").parquet(path)
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    listed = listed.select(_plain(F.col("path")).alias("file"), "length")
    seen = rows.groupBy(_plain(F.col("_metadata.file_path")).alias("file")).agg(F.count(F.lit(1)).alias("n"))
    bad = listed.join(seen, "file", "left_anti").select("file", "length", F.lit(UNREADABLE_FILE).alias("reason"))
    return rows, bad


def counts_by_reason(quarantine: DataFrame) -> DataFrame:
    """``(reason, field, n)``."""
    return quarantine.groupBy("reason", "field").agg(F.count(F.lit(1)).alias("n"))
