"""Row-level audio expressions: duration, resampling, frame energy, log-mel frames."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.binding import let
from corpusloom.operators.rows import pieces

# The analysis window of the feature extractor.
SAMPLE_RATE = 16000
FRAME_SAMPLES = 400
HOP_SAMPLES = 160
MEL_BANDS = 80
MAX_SAMPLES = 480000

# Frames of one recording that are transformed together, which bounds memory for a long one.
FRAMES_AT_ONCE = 4096
# Samples of several recordings that a task resamples at once.
SAMPLES_AT_ONCE = 1 << 20


def duration_seconds(samples: Column, rate: Column | int) -> Column:
    """Length in seconds; NULL where it cannot be told."""
    per_second = F.lit(rate) if isinstance(rate, int) else rate
    return F.try_divide(samples.cast("double"), per_second.cast("double"))


def within_duration(samples: Column, rate: Column | int, max_seconds: float) -> Column:
    """True up to and including the limit; never NULL."""
    return F.coalesce(duration_seconds(samples, rate) <= max_seconds, F.lit(False))


def resample(samples: Column, rate_in: Column | int, rate_out: int) -> Column:
    """Linear interpolation to another rate, as doubles."""
    rate = (F.lit(rate_in) if isinstance(rate_in, int) else rate_in).cast("bigint")

    def resampled(array: Column) -> Column:
        size = F.size(array).cast("bigint")
        last = F.floor((size * rate_out + (rate - 1)) / rate) - 1

        def at(i: Column) -> Column:
            low = F.floor(i * rate / F.lit(rate_out)).cast("int")
            part = (i * rate % rate_out) / F.lit(float(rate_out))
            left = F.get(array, low).cast("double")
            right = F.get(array, F.least(low + 1, F.size(array) - 1)).cast("double")
            return left * (1 - part) + right * part

        return F.when(size == 0, F.array().cast("array<double>")).otherwise(
            F.transform(F.sequence(F.lit(0).cast("bigint"), last), at)
        )

    return let(samples, resampled)


def _resampler(rate_out: int):
    most = SAMPLES_AT_ONCE

    def resampled(rows: pa.Array, rates: list) -> pa.Array:
        offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(rows), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
        waves = pc.list_flatten(rows).cast(pa.float64()).to_numpy(zero_copy_only=False)
        converted = []
        for low, high, rate in zip(offsets, offsets[1:], rates):
            wave = waves[low:high]
            length = -(-len(wave) * rate_out // int(rate)) if len(wave) else 0
            places = np.arange(length) * int(rate) / rate_out if length else ()
            converted.append(np.interp(places, np.arange(len(wave)), wave) if length else wave)
        ends = np.concatenate([[0], np.cumsum([len(c) for c in converted], dtype=np.int64)])
        values = pa.array(np.concatenate(converted), from_pandas=True)
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=rows.is_null())

    @F.arrow_udf("array<double>")
    def convert(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for arrays, rates in batches:
            for low, high in pieces(arrays, most):
                yield resampled(arrays.slice(low, high - low), rates.slice(low, high - low).to_pylist())

    return convert


def resample_long(samples: Column, rate_in: Column | int, rate_out: int) -> Column:
    """``resample`` for arrays of real audio length, computed on Arrow batches, piece by piece."""
    rate = (F.lit(rate_in) if isinstance(rate_in, int) else rate_in).cast("bigint")
    return _resampler(rate_out)(samples, rate)


def cast_audio(audio: Column, rate: int, arrow: bool = True) -> Column:
    """The audio struct at another sampling rate; rows already at that rate are left alone.

    Where the rate is missing or not positive the samples cannot be brought to another one, so
    their array is NULL.
    """
    change = resample_long if arrow else resample
    array, rate_in = audio.getField("array"), audio.getField("sampling_rate")
    known = F.coalesce(rate_in > 0, F.lit(False))
    differs = rate_in != rate
    changed = change(F.when(known & differs, array), F.when(known, rate_in).otherwise(rate), rate)
    return F.struct(
        F.when(known, F.when(differs, changed.cast("array<float>")).otherwise(array)).alias("array"),
        F.lit(rate).alias("sampling_rate"),
    )


def frame_energy(samples: Column, frame: int = FRAME_SAMPLES, hop: int = HOP_SAMPLES) -> Column:
    """Root mean square of each frame. A frame starts every ``hop`` samples; the last ones are short."""

    def energies(array: Column) -> Column:
        last = F.floor((F.size(array) - 1) / F.lit(hop)).cast("int")

        def rms(part: Column) -> Column:
            total = F.aggregate(part, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double"))
            return F.sqrt(total / F.size(part))

        return F.when(F.size(array) == 0, F.array().cast("array<double>")).otherwise(
            F.transform(
                F.sequence(F.lit(0), last),
                lambda i: let(F.slice(array, i * hop + 1, F.lit(frame)), rms),
            )
        )

    return let(samples, energies)


def _mel_filters(rate: int, n_fft: int, bands: int) -> np.ndarray:
    """Triangular filters on the Slaney mel scale with area normalisation."""
    linear_step, log_start, log_step = 200.0 / 3, 1000.0, np.log(6.4) / 27.0

    def to_mel(hz):
        return np.where(
            hz < log_start,
            hz / linear_step,
            log_start / linear_step + np.log(np.maximum(hz, log_start) / log_start) / log_step,
        )

    def to_hz(mel):
        knee = log_start / linear_step
        return np.where(mel < knee, mel * linear_step, log_start * np.exp(log_step * (mel - knee)))

    bins = np.linspace(0.0, rate / 2, n_fft // 2 + 1)
    edges = to_hz(np.linspace(to_mel(np.float64(0.0)), to_mel(np.float64(rate / 2)), bands + 2))
    rising = (bins - edges[:-2, None]) / (edges[1:-1] - edges[:-2])[:, None]
    falling = (edges[2:, None] - bins) / (edges[2:] - edges[1:-1])[:, None]
    triangles = np.maximum(0.0, np.minimum(rising, falling))
    return triangles * (2.0 / (edges[2:] - edges[:-2]))[:, None]


def _mel_frames(wave: np.ndarray, filters: np.ndarray, n_fft: int, hop: int) -> np.ndarray:
    """Log-mel values of a recording, frames by bands; its edges are mirrored, however short it is."""
    wave = np.pad(wave, n_fft // 2, mode="reflect")
    framed = np.lib.stride_tricks.sliding_window_view(wave, n_fft)[::hop][:-1]
    if not len(framed):
        return np.zeros((0, len(filters)), dtype=np.float32)
    window = np.hanning(n_fft + 1)[:-1]
    parts = [
        np.abs(np.fft.rfft(framed[i : i + FRAMES_AT_ONCE] * window, axis=1)) ** 2 @ filters.T
        for i in range(0, len(framed), FRAMES_AT_ONCE)
    ]
    mel = np.log10(np.maximum(np.concatenate(parts), 1e-10))
    return ((np.maximum(mel, mel.max() - 8.0) + 4.0) / 4.0).astype(np.float32)


def _fitted(array, length: int | None) -> np.ndarray:
    wave = np.asarray(array, dtype=np.float64)
    return wave if length is None else np.pad(wave[:length], (0, max(0, length - len(wave))))


def log_mel(
    df: DataFrame,
    key: str,
    samples: str,
    rate: int = SAMPLE_RATE,
    n_fft: int = FRAME_SAMPLES,
    hop: int = HOP_SAMPLES,
    bands: int = MEL_BANDS,
    length: int | None = MAX_SAMPLES,
) -> DataFrame:
    """Log-mel features, one row per frame: ``(key, frame, mel)``.

    Audio is first cut or zero-padded to ``length`` samples; ``None`` leaves it as it is.
    """
    schema = T.StructType(
        [
            df.schema[key],
            T.StructField("frame", T.LongType()),
            T.StructField("mel", T.ArrayType(T.FloatType())),
        ]
    )

    def features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = _mel_filters(rate, n_fft, bands)
        for batch in batches:
            for name, array in zip(batch[key], batch[samples]):
                if array is None:
                    continue
                wave = _fitted(array, length)
                mel = _mel_frames(wave, filters, n_fft, hop) if len(wave) else ()
                if len(mel):
                    yield pd.DataFrame({key: name, "frame": np.arange(len(mel)), "mel": list(mel)})

    return df.select(key, samples).mapInPandas(features, schema)


def mel_features(
    samples: Column,
    length: int = MAX_SAMPLES,
    rate: int = SAMPLE_RATE,
    n_fft: int = FRAME_SAMPLES,
    hop: int = HOP_SAMPLES,
    bands: int = MEL_BANDS,
) -> Column:
    """The log-mel matrix of a recording cut or zero-padded to ``length`` samples, bands by frames; NULL for NULL."""

    def features(arrays: pd.Series) -> pd.Series:
        filters = _mel_filters(rate, n_fft, bands)
        return pd.Series(
            [None if a is None else list(_mel_frames(_fitted(a, length), filters, n_fft, hop).T) for a in arrays],
            dtype=object,
        )

    return F.pandas_udf(features, "array<array<float>>")(samples)


def frame_mask(samples: Column, length: int = MAX_SAMPLES, hop: int = HOP_SAMPLES) -> Column:
    """1 for each frame of ``mel_features`` that begins inside the recording, 0 for the others."""
    frames = F.lit(length // hop)
    inside = F.least(F.ceil(F.size(samples) / F.lit(hop)).cast("int"), frames)
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return F.concat(F.array_repeat(one, inside), F.array_repeat(zero, frames - inside))
