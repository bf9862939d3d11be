"""Evaluation of predictions into the metric and report tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.operators.metrics import PREDICTIONS_EVERY, every_n_steps
from corpusloom.operators.scoring import prediction_report, score_pairs, wer_corpus
from corpusloom.sources.sinks import PREDICTIONS_TAG, WER_TAG, write_scalars, write_texts

# Fixed value: validation rows that are predicted at each evaluation.
EVAL_SAMPLES = 10


def evaluation_scalars(pairs: DataFrame) -> DataFrame:
    """``(run_id, tag, step, value)`` from ``(run_id, step, reference, prediction)``."""
    rates = wer_corpus(score_pairs(pairs), ["run_id", "step"])
    return rates.select("run_id", F.lit(WER_TAG).alias("tag"), "step", F.col("wer").alias("value"))


def evaluation_texts(pairs: DataFrame) -> DataFrame:
    """``(run_id, tag, step, text)`` from ``(run_id, step, pos, reference, prediction)``."""
    texts = prediction_report(pairs, ["run_id", "step"])
    return texts.select("run_id", F.lit(PREDICTIONS_TAG).alias("tag"), "step", "text")


def log_predictions(
    pairs: DataFrame,
    scalars_path: str,
    texts_path: str,
    every: int = PREDICTIONS_EVERY,
    samples: int | None = EVAL_SAMPLES,
    part: str | None = None,
) -> None:
    """Score and report the first rows of every evaluation that falls on the cadence.

    With ``part``, a name for this evaluation, running it again replaces what it wrote.
    """
    due = every_n_steps(pairs, "step", every)
    if samples:
        due = due.where(F.col("pos") <= samples)
    write_scalars(evaluation_scalars(due), scalars_path, part)
    write_texts(evaluation_texts(due), texts_path, part)
