"""Word error rate and prediction reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.words import word_edits, word_edits_native, word_list

# Rows in the text report and in the console report, and the console's text width.
REPORT_ROWS = 5
CONSOLE_ROWS = 3
CONSOLE_WIDTH = 80


def pair_predictions(references: DataFrame, predictions: DataFrame, key: str = "utterance_id") -> DataFrame:
    return references.join(predictions, key)


def score_pairs(
    df: DataFrame, reference: str = "reference", prediction: str = "prediction", native: bool = True
) -> DataFrame:
    """Add ``edits`` and ``ref_words`` to pairs of texts; both are NULL if a text is missing.

    Edits are counted without Python workers, which suits utterances; ``native=False`` counts them
    in Arrow batches, which is faster for texts of thousands of words.
    """
    words = df.withColumn("_ref", word_list(F.col(reference))).withColumn("_pred", word_list(F.col(prediction)))
    counter = word_edits_native if native else word_edits
    scored = words.withColumn("edits", counter(F.col("_ref"), F.col("_pred")))
    counted = F.when(F.col("edits").isNotNull(), F.size("_ref").cast("bigint"))
    return scored.withColumn("ref_words", counted).drop("_ref", "_pred")


def wer_corpus(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All edits over all reference words, overall or per group; not a mean of row rates."""
    return (
        scored.groupBy(*by)
        .agg(F.sum("edits").alias("edits"), F.sum("ref_words").alias("ref_words"))
        .withColumn("wer", F.try_divide(F.col("edits").cast("double"), F.col("ref_words").cast("double")))
    )


def prediction_report(
    df: DataFrame,
    by: Sequence[str],
    pos: str = "pos",
    reference: str = "reference",
    prediction: str = "prediction",
    n: int = REPORT_ROWS,
) -> DataFrame:
    """One text per group with its first ``n`` pairs in order of their dense position."""
    # Fixed value: the layout of one sample.
    sample = F.concat(
        F.lit("**Sample "), F.col(pos).cast("string"), F.lit("**\n\nTruth: "), F.col(reference),
        F.lit("\n\nPrediction: "), F.col(prediction), F.lit("\n\n---"),
    )
    return _joined(df.where(F.col(pos) <= n).withColumn("_sample", sample), by, pos)


def console_report(
    df: DataFrame,
    by: Sequence[str],
    pos: str = "pos",
    reference: str = "reference",
    prediction: str = "prediction",
    n: int = CONSOLE_ROWS,
    width: int = CONSOLE_WIDTH,
) -> DataFrame:
    """The short form: fewer pairs, each text cut to ``width`` characters."""
    # Fixed value: the layout of one sample.
    sample = F.concat(
        F.lit("  Truth:      "), F.substring(reference, 1, width), F.lit("...\n  Prediction: "),
        F.substring(prediction, 1, width), F.lit("...\n"),
    )
    return _joined(df.where(F.col(pos) <= n).withColumn("_sample", sample), by, pos)


def _joined(samples: DataFrame, by: Sequence[str], pos: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct(F.col(pos).alias("at"), F.col("_sample").alias("text"))))
    return (
        samples.groupBy(*by)
        .agg(ordered.alias("_samples"))
        .select(*by, F.array_join(F.col("_samples.text"), "\n").alias("text"))
    )
