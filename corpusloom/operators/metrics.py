"""Run metrics: cadence, rollup, checkpoint retention and choice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The configured cadences and retention.
PREDICTIONS_EVERY = 500
LOG_EVERY = 20
KEEP_CHECKPOINTS = 3


def every_n_steps(df: DataFrame, step: str = "step", n: int = PREDICTIONS_EVERY) -> DataFrame:
    return df.where((F.col(step) % n == 0) & (F.col(step) > 0))


def metric_rollup(
    df: DataFrame, run: str = "run_id", step: str = "step", value: str = "value", every: int = LOG_EVERY
) -> DataFrame:
    """``(run, step, value)`` as logged: the mean since the last log, NaN included.

    Logged are the first step and every ``every``-th; steps after the last of these are not.
    """
    logged = F.when(F.col(step) == 1, F.lit(1)).otherwise(F.ceil(F.col(step) / every) * every)
    return (
        df.withColumn("_logged", logged)
        .groupBy(run, "_logged")
        .agg(F.avg(value).alias(value), F.max(step).alias("_reached"))
        .where(F.col("_reached") == F.col("_logged"))
        .select(run, F.col("_logged").alias(step), value)
    )


def retain_last_k(
    df: DataFrame,
    run: str = "run_id",
    step: str = "step",
    k: int = KEEP_CHECKPOINTS,
    metric: str = "value",
    greater_is_better: bool = False,
) -> DataFrame:
    """The ``k`` checkpoints that each run keeps: the best one and the newest others.

    If the best one is not among the newest ``k``, it takes the place of the oldest of these. No
    more than ``k`` rows per run and task are shuffled, besides one best row.
    """
    newest = Window.partitionBy(run).orderBy(F.desc(step))
    ranked = df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") <= k)
    rank = -F.col(metric) if greater_is_better else F.col(metric)
    best = (
        df.where(F.col(metric).isNotNull())
        .groupBy(F.col(run).alias("_run"))
        .agg(F.min(F.struct(rank.alias("rank"), F.col(step).alias("step"), F.struct(*df.columns).alias("row"))).alias("_best"))
    )
    both = ranked.join(best, ranked[run].eqNullSafe(best["_run"]), "left")
    replaced = (F.col("_rank") == k) & F.coalesce(F.col("_best.step") < F.col(step), F.lit(False))
    chosen = F.when(replaced, F.col("_best.row")).otherwise(F.struct(*df.columns))
    return both.select(chosen.alias("_kept")).select("_kept.*")


def best_checkpoint(
    df: DataFrame,
    run: str = "run_id",
    step: str = "step",
    metric: str = "value",
    greater_is_better: bool = False,
) -> DataFrame:
    """The best step of each run and its metric; the earliest one of equals."""
    rank = -F.col(metric) if greater_is_better else F.col(metric)
    best = F.min(F.struct(rank.alias("rank"), F.col(step).alias("step"), F.col(metric).alias("metric")))
    return (
        df.where(F.col(metric).isNotNull())
        .groupBy(run)
        .agg(best.alias("_best"))
        .select(run, F.col("_best.step").alias(step), F.col("_best.metric").alias(metric))
    )
