"""Batch runs in stages that go on where an earlier attempt ended.

Each stage's output is a folder of its own, and a manifest row is written after it: the stage, a fingerprint of all it depends
on, the folder, its rows and files. A stage whose fingerprint has a manifest is not run again. The fingerprint
covers the input's files, the stages before and the parameters, so a change makes that stage and those after it run anew. Output
without a manifest is what an attempt left that did not end; ``orphans`` lists it.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from typing import Any, NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MANIFEST = "stage string, fingerprint string, folder string, n_rows long, n_files long"


class Stage(NamedTuple):
    """A name, a function of (DataFrame, **parameters), the parameters, and a version to change with the function."""

    name: str
    run: Callable[..., DataFrame]
    parameters: Mapping[str, Any] = {}
    version: int = 1


def input_fingerprint(spark: SparkSession, path: str) -> str:
    """A digest of the names, lengths and times of all files of a table; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    n, total, size = files.agg(F.count(F.lit(1)), F.sum(each), F.sum("length")).first()
    return hashlib.sha256(f"{n}:{total}:{size}".encode()).hexdigest()


def manifests(spark: SparkSession, path: str) -> DataFrame:
    """All stages that were finished at ``path``, of any attempt."""
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def run_stages(spark: SparkSession, source: str, stages: list[Stage], path: str) -> DataFrame:
    """The result of the last stage over the Parquet table at ``source``; finished stages are read, not run."""
    if len({s.name for s in stages}) < len(stages):
        raise ValueError("stages need names of their own")
    done = {(r["stage"], r["fingerprint"]): r["folder"] for r in manifests(spark, path).collect()}
    mark, df = input_fingerprint(spark, source), spark.read.parquet(source)
    for stage in stages:
        described = json.dumps([mark, stage.name, stage.version, dict(stage.parameters)], sort_keys=True, default=str)
        mark = hashlib.sha256(described.encode()).hexdigest()
        folder = done.get((stage.name, mark))
        if folder is None:
            folder = f"{stage.name}-{uuid.uuid4().hex}"
            result = stage.run(df, **stage.parameters)
            result.write.parquet(f"{path}/data/{folder}")
            written = spark.read.schema(result.schema).parquet(f"{path}/data/{folder}")
            n_rows, n_files = written.agg(F.count(F.lit(1)), F.countDistinct(F.col("_metadata.file_path"))).first()
            # A folder of its own for each row: whole, or not there.
            row = spark.createDataFrame([(stage.name, mark, folder, n_rows, n_files)], _MANIFEST)
            row.coalesce(1).write.mode("append").parquet(f"{path}/manifest")
        df = spark.read.parquet(f"{path}/data/{folder}")
    return df


def orphans(spark: SparkSession, path: str) -> DataFrame:
    """``(folder, n_files, n_bytes)`` of output that no manifest names."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/data")
    folder = F.regexp_extract("path", r"/data/([^/]+)/", 1).alias("folder")
    found = files.groupBy(folder).agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"))
    return found.join(manifests(spark, path).select("folder"), "folder", "left_anti")
