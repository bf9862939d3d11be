"""Incremental input: cleaning, sampling, interleaving and scoring of streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.text import clean_text
from corpusloom.operators.interleave import first_exhausted
from corpusloom.operators.ordinal import ordinal
from corpusloom.operators.rows import filter_map
from corpusloom.operators.scoring import score_pairs


def stream_clean(sdf: DataFrame, text: str = "text") -> DataFrame:
    """Clean transcripts and drop unusable ones; the same on a stream and on a table."""
    return filter_map(sdf, text, clean_text(F.col(text)))


def stream_take(sdf: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows to arrive; no ``n`` means all of them."""
    return sdf.limit(n) if n else sdf


def append_stream(sdf: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what is available now to a table; a restart goes on after the last finished batch."""
    return (
        sdf.writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def _each_batch(sdf: DataFrame, fn, checkpoint: str) -> StreamingQuery:
    return (
        sdf.writeStream.foreachBatch(fn)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_wer(sdf: DataFrame, every: int, path: str, checkpoint: str) -> StreamingQuery:
    """Word errors per ``every`` steps of a stream of ``(step, reference, prediction)``.

    Edits and words add up, so each micro-batch writes its own sums and no state is kept. A
    repeated batch writes over its first attempt.
    """

    def sums(batch: DataFrame, batch_id: int) -> None:
        window = F.floor(F.col("step") / F.lit(every)).alias("window")
        scored = score_pairs(batch).groupBy(window).agg(
            F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words")
        )
        scored.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _each_batch(sdf, sums, checkpoint)


def read_wer(spark: SparkSession, path: str) -> DataFrame:
    """``(window, edits, ref_words, wer)`` of everything scored so far."""
    sums = spark.read.parquet(path).groupBy("window").agg(
        F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words")
    )
    return sums.withColumn("wer", F.try_divide(F.col("edits").cast("double"), F.col("ref_words").cast("double")))


def stream_interleave(
    sdf: DataFrame, source: str, sources: Sequence[str], order_by: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Give the rows of a stream their round-robin position as they arrive.

    Rows of a source count in order of arrival, within a micro-batch in order of ``order_by``.
    Each batch writes its rows once, then their positions, found by keys alone, and the running
    row count of every source, so a repeated batch writes the same again. Rows of sources that are
    not listed are left out. ``read_interleaved`` shows the merged sequence.
    """
    names = F.array(*map(F.lit, sources))

    def place(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # One row per configured source.
        before = [0] * len(sources)
        if batch_id > 0:
            for r in spark.read.parquet(f"{path}/totals/batch={batch_id - 1}").collect():
                before[r["k"]] = r["n"]
        numbered = batch.withColumn("k", (F.array_position(names, F.col(source)) - 1).cast("int"))
        rows = f"{path}/rows/batch={batch_id}"
        numbered = numbered.where(F.col("k") >= 0).withColumn("_arrival", F.monotonically_increasing_id())
        numbered.write.mode("overwrite").parquet(rows)
        keys = spark.read.schema(numbered.schema).parquet(rows).select("k", "_arrival", order_by)
        placed = ordinal(keys, [order_by, "_arrival"], ["k"], out="rn")
        arrived = {r["k"]: r["n"] for r in placed.groupBy("k").agg(F.max("rn").alias("n")).collect()}
        totals = [(k, n + arrived.get(k, 0)) for k, n in enumerate(before)]

        offset = F.get(F.array(*(F.lit(n).cast("bigint") for n in before)), F.col("k"))
        moved = placed.select("_arrival", F.col("k").alias("_k"), (F.col("rn") + offset).alias("rn"))
        moved = moved.withColumn("pos", (F.col("rn") - 1) * len(sources) + F.col("_k") + 1).drop("_k")
        moved.write.mode("overwrite").parquet(f"{path}/places/batch={batch_id}")
        spark.createDataFrame(totals, "k int, n bigint").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/totals/batch={batch_id}"
        )

    return _each_batch(sdf, place, checkpoint)


def read_interleaved(spark: SparkSession, path: str, sources: Sequence[str]) -> DataFrame:
    """The merged sequence as far as the sources have arrived."""
    totals = spark.read.parquet(f"{path}/totals").groupBy("k").agg(F.max("n").alias("n"))
    counts = {r["k"]: r["n"] for r in totals.collect()}
    places = spark.read.parquet(f"{path}/places")
    rows = spark.read.parquet(f"{path}/rows").join(places, ["batch", "_arrival"]).drop("batch", "_arrival")
    if len(sources) == 1:
        return rows
    row, last = first_exhausted([counts.get(k, 0) for k in range(len(sources))])
    return rows.where((F.col("rn") < row) | ((F.col("rn") == row) & (F.col("k") <= last)))
