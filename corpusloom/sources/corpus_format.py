"""A source of its own for corpora kept as Parquet, for batches and streams: ``spark.read.format("corpus")``.

A corpus is a folder, or file, of Parquet on a file system that Arrow can open from the driver and every executor. A partition
is a range of row groups of one file. The option ``where`` names values of columns, such as a config and a split: row groups that
statistics rule out are not planned, and rows are filtered as they are read. Only the columns of the schema that is asked for
are read. As a stream, files count in the order of their times and names; the offset is the number of files that were taken.

Filters are an option and not taken over from the plan: Spark 4.1 plans a source once per table, so two filters on
one table would both get what the first one left.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Bytes of row groups that one task reads, unless a single one has more, and bytes of rows that it decodes at once.
PARTITION_BYTES = 128 * 1024 * 1024
BATCH_BYTES = 8 * 1024 * 1024


def corpus_source() -> type:
    """The class of the source. It is made in a function, so that it travels to tasks as a whole; executors need no copy of this package."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

    default_bytes, batch_bytes = PARTITION_BYTES, BATCH_BYTES

    class RowGroups(InputPartition):
        def __init__(self, path: str, groups: list[int]) -> None:
            self.path, self.groups = path, groups

    def opened(path: str):
        from pyarrow import fs

        return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)

    def listed(path: str) -> list[tuple[str, float]]:
        """The Parquet files below a path, by time and name."""
        from pyarrow import fs

        system, inside = opened(path)
        info = system.get_file_info(inside)
        found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(inside, recursive=True))
        prefix = path[: len(path) - len(inside)] if path.endswith(inside) else ""
        files = [f for f in found if f.type == fs.FileType.File and f.path.endswith(".parquet")]
        return [prefix + f.path for f in sorted(files, key=lambda f: (f.mtime_ns or 0, f.path))]

    def expression(where: dict[str, list]):
        """What the option says, for Arrow; nothing if it says nothing."""
        import pyarrow.dataset as ds

        whole = None
        for name, values in where.items():
            one = ds.field(name).isin(values)
            whole = one if whole is None else whole & one
        return whole

    class Reader:
        """What batches and streams have in common."""

        where: dict = {}

        def planned(self, files: list[str]) -> list[RowGroups]:
            import pyarrow.dataset as ds

            found = []
            for path in files:
                system, inside = opened(path)
                fragment = next(iter(ds.dataset(inside, filesystem=system, format="parquet").get_fragments()))
                left = fragment.split_by_row_group(expression(self.where))
                groups, held = [], 0
                for one in left:
                    (group,) = one.row_groups
                    groups.append(group.id)
                    held += group.total_byte_size
                    if held >= self.most:
                        found.append(RowGroups(path, groups))
                        groups, held = [], 0
                if groups:
                    found.append(RowGroups(path, groups))
            return found

        def read(self, partition: RowGroups):
            import pyarrow as pa
            import pyarrow.parquet as pq
            from pyspark.sql.pandas.types import to_arrow_schema

            if partition is None:
                return
            system, inside = opened(partition.path)
            kind, chosen = to_arrow_schema(self.kind), expression(self.where)
            columns = list(dict.fromkeys([*kind.names, *self.where]))
            # Pages are read as they are needed, so a task holds a batch of rows and no row group.
            with pq.ParquetFile(system.open_input_file(inside), buffer_size=1 << 20, pre_buffer=False) as file:
                for group in partition.groups:
                    told = file.metadata.row_group(group)
                    rows = max(1, batch_bytes * told.num_rows // max(1, told.total_byte_size))
                    for batch in file.iter_batches(min(rows, 65536), row_groups=[group], columns=columns, use_threads=False):
                        if chosen is not None:
                            batch = pa.Table.from_batches([batch]).filter(chosen)
                        for part in batch.select(kind.names).cast(kind).to_batches() if chosen is not None else [batch.select(kind.names).cast(kind)]:
                            if part.num_rows:
                                yield part

    class BatchReader(Reader, DataSourceReader):
        def __init__(self, kind, path: str, most: int, where: dict) -> None:
            self.kind, self.path, self.most, self.where = kind, path, most, where

        def partitions(self):
            return self.planned(listed(self.path))

    class StreamReader(Reader, DataSourceStreamReader):
        def __init__(self, kind, path: str, most: int, where: dict, at_once: int) -> None:
            self.kind, self.path, self.most, self.where, self.at_once, self.seen = kind, path, most, where, at_once, 0

        def initialOffset(self) -> dict:
            return {"files": 0}

        def latestOffset(self) -> dict:
            there = len(listed(self.path))
            self.seen = min(there, self.seen + self.at_once) if self.at_once else there
            return {"files": self.seen}

        def partitions(self, start: dict, end: dict):
            self.seen = max(self.seen, end["files"])
            return self.planned(listed(self.path)[start["files"] : end["files"]])

    class CorpusSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "corpus"

        def _options(self) -> tuple[str, int, dict]:
            if "path" not in self.options:
                raise ValueError("a corpus needs a path")
            most = int(self.options.get("partitionBytes", default_bytes))
            return self.options["path"], most, json.loads(self.options.get("where", "{}"))

        def schema(self):
            import pyarrow.parquet as pq
            from pyspark.sql.pandas.types import from_arrow_schema

            files = listed(self._options()[0])
            if not files:
                raise ValueError("a corpus without files needs a schema")
            system, inside = opened(files[0])
            return from_arrow_schema(pq.read_schema(inside, filesystem=system))

        def reader(self, schema):
            return BatchReader(schema, *self._options())

        def streamReader(self, schema):
            return StreamReader(schema, *self._options(), int(self.options.get("maxFilesPerTrigger", 0)))

    return CorpusSource


def register_corpus_source(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(corpus_source())


def read_corpus(spark: SparkSession, path: str, schema: StructType | str | None = None, **where: str | int | Sequence) -> DataFrame:
    """The rows of a corpus whose columns have the given values, or one of several."""
    wanted = {name: [v] if isinstance(v, (str, int)) else list(v) for name, v in where.items()}
    reader = spark.read.format("corpus").option("where", json.dumps(wanted))
    return (reader.schema(schema) if schema else reader).load(path)
