"""Transcribed corpora as source tables, chosen by configuration.

A source table has the columns ``config`` and ``split`` (best as partition columns), a key, a
transcript in ``text`` or ``sentence``, and, where there is audio, ``audio`` as a struct of
``array`` and ``sampling_rate``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.audio import cast_audio
from corpusloom.functions.text import clean_text
from corpusloom.operators.rows import filter_map

# The subset and the language of a source that names none.
DEFAULT_SUBSET = "xs"
DEFAULT_LANGUAGE = "en"


@dataclass(frozen=True)
class SourceSpec:
    """One entry of the configured source list."""

    name: str
    configs: Sequence[str] = ()
    train_splits: Sequence[str] = ()
    eval_splits: Sequence[str] = ()
    subset: str | None = None
    language: str | None = None
    train_split: str | None = None
    eval_split: str | None = None

    def splits(self, evaluation: bool) -> Sequence[str]:
        return self.eval_splits if evaluation else self.train_splits

    def split(self, evaluation: bool) -> str | None:
        return self.eval_split if evaluation else self.train_split


def _select(table: DataFrame, config: str, split: str | None) -> DataFrame:
    return table.where((F.col("config") == config) & (F.col("split") == split))


def multi_config_source(table: DataFrame, spec: SourceSpec, evaluation: bool) -> list[DataFrame]:
    """One stream per config; the i-th config goes with the i-th split."""
    splits = spec.splits(evaluation)
    if len(splits) < len(spec.configs):
        raise ValueError(f"{spec.name}: {len(spec.configs)} configs, {len(splits)} splits")
    return [_select(table, config, split) for config, split in zip(spec.configs, splits)]


def subset_source(table: DataFrame, spec: SourceSpec, evaluation: bool) -> list[DataFrame]:
    """A tagged corpus: one subset, with transcripts cleaned and unusable ones dropped."""
    chosen = _select(table, spec.subset or DEFAULT_SUBSET, spec.split(evaluation))
    return [filter_map(chosen, "text", clean_text(F.col("text")))]


def language_source(table: DataFrame, spec: SourceSpec, evaluation: bool) -> list[DataFrame]:
    """One language of a corpus whose transcripts are called ``sentence``."""
    chosen = _select(table, spec.language or DEFAULT_LANGUAGE, spec.split(evaluation))
    return [chosen.withColumnRenamed("sentence", "text")]


# The source names a configuration may use.
SOURCE_KINDS: dict[str, Callable[[DataFrame, SourceSpec, bool], list[DataFrame]]] = {
    "librispeech_asr": multi_config_source,
    "gigaspeech": subset_source,
    "common_voice": language_source,
}


def open_sources(
    specs: Sequence[SourceSpec],
    tables: Mapping[str, DataFrame],
    evaluation: bool = False,
) -> list[DataFrame]:
    """The streams of all configured sources in list order."""
    streams: list[DataFrame] = []
    for spec in specs:
        if spec.name not in SOURCE_KINDS:
            raise ValueError(f"unknown source {spec.name!r}; known are {sorted(SOURCE_KINDS)}")
        streams += SOURCE_KINDS[spec.name](tables[spec.name], spec, evaluation)
    if not streams:
        raise ValueError("no sources configured")
    return streams


def resampled(df: DataFrame, sample_rate: int | None) -> DataFrame:
    """Audio, if there is any, at one sampling rate."""
    if sample_rate is None or "audio" not in df.columns:
        return df
    return df.withColumn("audio", cast_audio(F.col("audio"), sample_rate))


def read_tables(spark: SparkSession, paths: Mapping[str, str]) -> dict[str, DataFrame]:
    """Source tables from Parquet folders; config and split prune whole folders."""
    return {name: spark.read.parquet(path) for name, path in paths.items()}
