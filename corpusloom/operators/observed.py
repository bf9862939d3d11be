"""Metrics that a job counts while it runs, without another pass over its rows."""

from __future__ import annotations

from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from corpusloom.operators.scoring import score_pairs
from corpusloom.sources.sinks import write_scalars


class ObservedRun:
    """Names points of a plan at which rows are counted; after the job the numbers go to the scalar table of a run.

    Values come with the job's own tasks. A task that is repeated counts once, and so does a stage that is computed
    once; a frame that is used twice in a plan, or by two actions, gives the numbers of the first one that ends.
    """

    def __init__(self, run_id: str, step: int = 0) -> None:
        self.run_id, self.step = run_id, step
        self._points: dict[str, Observation] = {}

    def at(self, df: DataFrame, point: str, **metrics: Column) -> DataFrame:
        """``df`` with aggregates that are taken as its rows go by; the number of rows is always one of them."""
        if point in self._points:
            raise ValueError(f"{point} is observed already")
        self._points[point] = Observation(f"{self.run_id}/{point}")
        return df.observe(self._points[point], F.count(F.lit(1)).alias("rows"), *(c.alias(n) for n, c in metrics.items()))

    def values(self) -> dict[str, float | None]:
        """``point/metric`` and value. Waits for the job, so call it after the action."""
        return {f"{point}/{name}": value for point, seen in self._points.items() for name, value in seen.get.items()}

    def write(self, spark: SparkSession, path: str, part: str | None = None) -> None:
        """Append the values to the scalar table, or put them in place of what ``part`` of the run held."""
        rows = [(self.run_id, tag, self.step, None if v is None else float(v)) for tag, v in self.values().items()]
        kind = pa.schema([("run_id", pa.string()), ("tag", pa.string()), ("step", pa.int64()), ("value", pa.float64())])
        table = pa.table([list(c) for c in zip(*rows)] if rows else [[]] * 4, schema=kind)
        write_scalars(spark.createDataFrame(table), path, part)


def observed_score(pairs: DataFrame, run: ObservedRun, point: str = "score") -> DataFrame:
    """Scored pairs whose word errors are summed up on the way; ``edits`` over ``ref_words`` is the rate."""
    scored = score_pairs(pairs)
    missing = F.count_if(F.col("edits").isNull())
    return run.at(scored, point, edits=F.sum("edits"), ref_words=F.sum("ref_words"), unscored=missing)


class StreamMetrics(StreamingQueryListener):
    """Writes what streams observe under ``names`` to the scalar table, one part per stream and micro-batch.

    A batch that is repeated after a restart writes over its first numbers.
    """

    def __init__(self, spark: SparkSession, path: str, names: Mapping[str, str]) -> None:
        self.spark, self.path, self.names = spark, path, dict(names)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, run_id in self.names.items():
            row = progress.observedMetrics.get(name)
            if row is None:
                continue
            values = [(run_id, f"{name}/{k}", progress.batchId, None if v is None else float(v)) for k, v in row.asDict().items()]
            frame = self.spark.createDataFrame(values, "run_id string, tag string, step long, value double")
            write_scalars(frame, self.path, part=f"{name}-{progress.batchId}")
