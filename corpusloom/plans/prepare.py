"""From configured sources to an ordered, batched, usable set of utterances."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.audio import within_duration
from corpusloom.functions.binding import let
from corpusloom.functions.text import clean_guarded, strip_ws, text_by_value
from corpusloom.operators.batching import assign_batches
from corpusloom.operators.interleave import interleave
from corpusloom.operators.rows import filter_map, tolerant_rows
from corpusloom.sources.corpora import SourceSpec, open_sources, resampled


def load_corpus(
    specs: Sequence[SourceSpec],
    tables: Mapping[str, DataFrame],
    evaluation: bool = False,
    order_by: str = "utterance_id",
    sample_rate: int | None = None,
    max_samples: int | None = None,
) -> DataFrame:
    """One side of the sources: interleaved, limited, with ``pos``.

    Rows of a source come in the order of ``order_by``, which is unique within it.
    """
    rows = interleave(open_sources(specs, tables, evaluation), order_by, limit=max_samples)
    # Only rows that are left get their audio resampled.
    return resampled(rows, sample_rate)


def load_corpora(
    specs: Sequence[SourceSpec],
    tables: Mapping[str, DataFrame],
    order_by: str = "utterance_id",
    sample_rate: int | None = None,
    max_train_samples: int | None = None,
    max_eval_samples: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The training and the validation set; both go through the same plan."""
    return (
        load_corpus(specs, tables, False, order_by, sample_rate, max_train_samples),
        load_corpus(specs, tables, True, order_by, sample_rate, max_eval_samples),
    )


def usable_text(df: DataFrame) -> Column:
    """The transcript a batch is built from; empty or NULL where there is none."""
    return strip_ws(clean_guarded(text_by_value(df)))


def usable_rows(df: DataFrame, samples: Column, sample_rate: int, max_seconds: float) -> DataFrame:
    """Replace ``text`` by the usable transcript or NULL and add ``valid``; no row is dropped yet."""
    short = within_duration(samples, sample_rate, max_seconds)
    text = let(usable_text(df), lambda t: F.when(t != "", t))
    return df.withColumn("text", text).withColumn("valid", F.col("text").isNotNull() & short)


def batched_rows(
    df: DataFrame, pos: str, batch_size: int, samples: Column, sample_rate: int, max_seconds: float
) -> DataFrame:
    """Batches are numbered over all rows and lose their unusable ones; none is refilled."""
    batched = assign_batches(df, pos, batch_size)
    short = batched.where(within_duration(samples, sample_rate, max_seconds))
    return filter_map(short, "text", let(usable_text(df), lambda t: F.when(t != "", t)))


def rejected_rows(df: DataFrame, samples: Column, sample_rate: int, max_seconds: float) -> DataFrame:
    """``(reason, n)``: how many rows ``batched_rows`` leaves out, by the first reason that holds."""
    return tolerant_rows(
        df, duration=within_duration(samples, sample_rate, max_seconds), text=usable_text(df) != ""
    )[1]
