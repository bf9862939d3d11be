"""Recordings of any length as rows of chunks: ``(key, chunk, samples)``.

Chunk c of a recording has its samples from ``c * size`` on, ``size`` of them but for the last one, and chunks that
would be empty are no rows. What looks over the border of a chunk needs a halo: the last samples before it and the
first ones after it, which ``with_halo`` brings from the neighbours, and no others. So every task holds
a few chunks, however long a recording is, and one that is most of a table is spread like any other.
What belongs to a whole recording, such as its length or its largest value, is an aggregate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions import audio as A
from corpusloom.operators.rows import pieces
from corpusloom.session import write_through

# Samples of a chunk: half a minute at 16 kHz.
CHUNK_SAMPLES = 480_000
# Samples that a task works on at once, unless one chunk has more.
SAMPLES_AT_ONCE = 1 << 20
# Recordings of which some values are cut off, that are broadcast.
MOST_CUTS = 1_000_000


def chunk_recordings(df: DataFrame, key: str, samples: str, size: int = CHUNK_SAMPLES) -> DataFrame:
    """``(key, chunk, samples)`` of recordings that do fit a row; a missing or empty one has no chunks."""
    starts = F.sequence(F.lit(0), F.floor((F.size(samples) - 1) / size).cast("int"))
    chunks = F.when(F.size(samples) > 0, F.transform(starts, lambda c: F.struct(c.cast("long").alias("chunk"), F.slice(samples, c * size + 1, F.lit(size)).alias("samples"))))
    return df.select(key, F.explode(chunks).alias("_c")).select(key, "_c.*")


def whole_recordings(chunks: DataFrame, key: str) -> DataFrame:
    """``(key, samples)`` again, for recordings that fit a row."""
    parts = F.sort_array(F.collect_list(F.struct("chunk", "samples")))
    return chunks.groupBy(key).agg(F.flatten(parts["samples"]).alias("samples"))


def recording_lengths(chunks: DataFrame, key: str) -> DataFrame:
    """``(key, n_samples)``."""
    return chunks.groupBy(key).agg(F.sum(F.size("samples").cast("long")).alias("n_samples"))


def with_halo(chunks: DataFrame, key: str, before: int, after: int) -> DataFrame:
    """``(key, chunk, before, samples, after)``: with so many samples of the neighbours, fewer only at either end of a recording.

    Each chunk hands its border to its two neighbours, so rows meet in groups of three at most. Only borders that are asked for are sent,
    and none ahead of the first chunk. A halo is no longer than a chunk.
    """
    kept = F.array().cast(chunks.schema["samples"].dataType)
    size = F.size("samples")
    sent = [F.struct(F.col("chunk").alias("to"), F.lit(0).alias("role"), F.col("samples").alias("part"))]
    if before:
        sent.append(F.struct((F.col("chunk") + 1).alias("to"), F.lit(1).alias("role"), F.slice("samples", F.greatest(size - before + 1, F.lit(1)), F.lit(before)).alias("part")))
    if after:
        sent.append(F.struct((F.col("chunk") - 1).alias("to"), F.lit(2).alias("role"), F.slice("samples", F.lit(1), F.lit(after)).alias("part")))
    met = chunks.select(key, F.inline(F.array(*sent))).where("to >= 0").groupBy(key, "to")
    parts = [F.max(F.when(F.col("role") == i, F.col("part"))).alias(name) for i, name in enumerate(("samples", "before", "after"))]
    joined = met.agg(*parts).where("samples is not null")
    return joined.select(key, F.col("to").alias("chunk"), F.coalesce("before", kept).alias("before"), "samples", F.coalesce("after", kept).alias("after"))


def fit_chunks(chunks: DataFrame, key: str, length: int, size: int = CHUNK_SAMPLES) -> DataFrame:
    """``(key, chunk, samples, n_set)``: each recording cut or filled with zeros to ``length`` samples, of which ``n_set`` per chunk are its own.

    Only recordings that are too short get chunks of zeros; nothing else is shuffled but the lengths.
    """
    kind = chunks.schema["samples"].dataType
    room = F.least(F.lit(size), length - F.col("chunk") * size).cast("int")

    def filled(part: Column, n: Column) -> Column:
        cut = F.slice(part, F.lit(1), n)
        return F.concat(cut, F.array_repeat(F.lit(0).cast(kind.elementType), n - F.size(cut)))

    own = chunks.where(F.col("chunk") * size < length)
    own = own.select(key, "chunk", filled(F.col("samples"), room).alias("samples"), F.least(F.size("samples"), room).alias("n_set"))
    last = -(-length // size) - 1
    have = chunks.groupBy(key).agg(F.max("chunk").alias("_last")).where(F.col("_last") < last)
    more = have.select(key, F.explode(F.sequence(F.col("_last") + 1, F.lit(last).cast("long"))).alias("chunk"))
    more = more.select(key, "chunk", filled(F.array().cast(kind), room).alias("samples"), F.lit(0).alias("n_set"))
    return own.unionByName(more)


def frame_energies(chunks: DataFrame, key: str, size: int = CHUNK_SAMPLES, frame: int = A.FRAME_SAMPLES, hop: int = A.HOP_SAMPLES) -> DataFrame:
    """``(key, frame, energy)``: root mean squares as of whole recordings, each frame from the chunk in which it begins."""
    if frame - 1 > size:
        raise ValueError("a frame is longer than a chunk")
    kind = T.StructType([chunks.schema[key], T.StructField("frame", T.LongType()), T.StructField("energy", T.DoubleType())])
    most, at_once = SAMPLES_AT_ONCE, A.FRAMES_AT_ONCE

    def energies(start: np.ndarray, own: np.ndarray, waves: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Rows, frames and energies of chunks with what follows them."""
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(waves).to_numpy(zero_copy_only=False), dtype=np.int64)])
        flat = pc.list_flatten(waves)
        values, gaps = flat.cast(pa.float64()).to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)
        first = -(-start // hop)
        # A chunk shorter than a hop may have no frame of its own.
        count = np.maximum(0, (start + own - 1) // hop - first + 1)
        row = np.repeat(np.arange(len(count)), count)
        frames = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        begin = ends[row] + frames * hop - start[row]
        end = np.minimum(begin + frame, ends[row + 1])
        found, missing = np.empty(len(row)), np.zeros(len(row), dtype=bool)
        for low in range(0, len(row), at_once):
            part = slice(low, low + at_once)
            places = begin[part] + np.arange(frame)[:, None]
            inside = places < end[part]
            places = np.minimum(places, len(values) - 1)
            wave = np.where(inside, values[places], 0.0)
            found[part] = np.sqrt((wave * wave).sum(axis=0) / (end - begin)[part])
            if flat.null_count:
                missing[part] = (gaps[places] & inside).any(axis=0)
        return row, frames, pa.array(found, mask=missing)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in pieces(batch.column(3), most):
                part = batch.slice(low, high - low)
                start, own = (part.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (1, 2))
                row, frames, found = energies(start * size, own, part.column(3))
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), pa.array(frames), found], names=[key, "frame", "energy"])

    rows = with_halo(chunks, key, 0, frame - 1)
    return rows.select(key, "chunk", F.size("samples"), F.concat("samples", "after")).mapInArrow(convert, kind)


def _local(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return tuple(np.asarray(batch.column(c)[i].values.to_numpy(zero_copy_only=False), dtype=np.float64) for c in (2, 3, 4))


def log_mel_chunks(
    chunks: DataFrame, key: str, size: int = CHUNK_SAMPLES, rate: int = A.SAMPLE_RATE, n_fft: int = A.FRAME_SAMPLES,
    hop: int = A.HOP_SAMPLES, bands: int = A.MEL_BANDS,
) -> DataFrame:
    """``(key, frame, mel)`` as ``log_mel`` gives it for whole recordings, each frame from the chunk in which its middle lies.

    Only the two ends of a recording are mirrored. Values are cut off at eight below the largest of the recording, an aggregate over
    its frames, for which they are written once, as the floats they end as: rounding keeps their order, so the cut is the same
    before and after it. Where nothing lies below it, frames are done; the other recordings' cuts are broadcast while
    they are at most ``MOST_CUTS``, else joined by shuffle.
    """
    half = n_fft // 2
    if size < n_fft:
        raise ValueError("a chunk is shorter than a frame")
    schema = T.StructType([
        chunks.schema[key], T.StructField("frame", T.LongType()), T.StructField("mel", T.ArrayType(T.FloatType())), T.StructField("least", T.FloatType()), T.StructField("most", T.DoubleType()),
    ])
    most_samples, at_once = SAMPLES_AT_ONCE, A.FRAMES_AT_ONCE

    def frames_of(before: np.ndarray, own: np.ndarray, after: np.ndarray, start: int) -> tuple[int, np.ndarray]:
        """The first frame and the windows of all that have their middle here."""
        ended = len(after) < half
        wave = np.concatenate([before, own, after])
        origin = start - len(before)
        left = max(0, half - start) if origin == 0 else 0
        length = origin + len(wave)
        first, last = -(-start // hop), (start + len(own) - 1) // hop
        if ended:
            last = min(last, length // hop - 1)
        if last < first:
            return first, np.zeros((0, n_fft))
        right = max(0, last * hop + n_fft - half - length)
        wave = np.pad(wave, (left, right), mode="reflect")
        at = np.arange(first, last + 1) * hop - half - (origin - left)
        return first, np.lib.stride_tricks.sliding_window_view(wave, n_fft)[at]

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters, window = A._mel_filters(rate, n_fft, bands), np.hanning(n_fft + 1)[:-1]

        def transformed(keys: pa.Array, held: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
            """Frames of several chunks: the row, the first frame and the windows of each part."""
            counts = [len(part) for _, _, part in held]
            power = np.abs(np.fft.rfft(np.concatenate([part for _, _, part in held]) * window, axis=1)) ** 2 @ filters.T
            mel = np.log10(np.maximum(power, 1e-10))
            level = ((mel + 4.0) / 4.0).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(mel) + 1) * bands, pa.int32()), pa.array(level.ravel()))
            frames = np.concatenate([np.arange(first, first + n) for (_, first, _), n in zip(held, counts)])
            names = keys.take(pa.array(np.repeat([i for i, _, _ in held], counts)))
            return pa.RecordBatch.from_arrays([names, pa.array(frames), lists, pa.array(level.min(axis=1)), pa.array(mel.max(axis=1))], names=schema.names)

        for batch in batches:
            for low, high in pieces(batch.column(3), most_samples):
                rows, held, n = batch.slice(low, high - low), [], 0
                for i in range(len(rows)):
                    first, framed = frames_of(*_local(rows, i), rows.column(1)[i].as_py() * size)
                    for at in range(0, len(framed), at_once):
                        part = framed[at : at + at_once]
                        if n + len(part) > at_once:
                            yield transformed(rows.column(0), held)
                            held, n = [], 0
                        held.append((i, first + at, part))
                        n += len(part)
                if held:
                    yield transformed(rows.column(0), held)

    framed = write_through(with_halo(chunks, key, half, half).where(F.col(key).isNotNull()).mapInArrow(features, schema), "mel")
    ends = framed.groupBy(key).agg(F.min("least").alias("_least"), ((F.max("most") - 8.0 + 4.0) / 4.0).cast("float").alias("_cut"))
    cuts = write_through(ends.where("_least < _cut").select(key, "_cut"), "cuts")
    cuts = F.broadcast(cuts) if cuts.count() <= MOST_CUTS else cuts
    level = F.when(F.col("_cut").isNull(), F.col("mel")).otherwise(F.transform("mel", lambda x: F.greatest(x, F.col("_cut"))))
    return framed.join(cuts, key, "left").select(key, "frame", level.alias("mel"))


class SincFilter:
    """A low-pass filter for changing the rate, as one set of weights for each place between two samples.

    Output n lies at ``n * down / up`` of the input. Its weights reach ``half`` samples to either side: a sinc
    with a Hann window over ``zeros`` of its zeros, cut off at ``rolloff`` times half the lower of the two rates.
    """

    def __init__(self, rate_in: int, rate_out: int, zeros: int = 16, rolloff: float = 0.945) -> None:
        if min(rate_in, rate_out) <= 0:
            raise ValueError("rates are positive")
        common = math.gcd(rate_in, rate_out)
        self.up, self.down = rate_out // common, rate_in // common
        cut = min(1.0, self.up / self.down) * rolloff
        self.half = math.ceil(zeros / cut)
        taps = np.arange(-self.half + 1, self.half + 1)
        away = np.arange(self.up)[:, None] / self.up - taps
        window = np.where(np.abs(away) < zeros / cut, np.cos(np.pi * away * cut / zeros / 2) ** 2, 0.0)
        self.weights = cut * np.sinc(cut * away) * window

    def outputs(self, start: int, n: int) -> tuple[int, int]:
        """The outputs, from and below, that lie at or after sample ``start`` and before ``start + n``."""
        return -(-start * self.up // self.down), -(-(start + n) * self.up // self.down)

    def apply(self, before: np.ndarray, own: np.ndarray, after: np.ndarray, start: int) -> np.ndarray:
        """The outputs that lie in ``own``; beyond the samples given there is silence."""
        low, high = self.outputs(start, len(own))
        pad = np.zeros(self.half)
        wave = np.concatenate([pad, before, own, after, pad])
        shift = len(before) - start + 1
        result = np.empty(high - low)
        if len(result) >= 32 * self.up:
            # Outputs of one place between two samples have the same weights, and their windows follow at equal steps.
            windows = np.lib.stride_tricks.sliding_window_view(wave, 2 * self.half)
            for first in range(low, low + self.up):
                own_weights, own_windows = self.weights[first * self.down % self.up], windows[first * self.down // self.up + shift :: self.down]
                made = result[first - low :: self.up]
                for at in range(0, len(made), 8192):
                    part = made[at : at + 8192]
                    np.matmul(own_windows[at : at + len(part)], own_weights, out=part)
            return result
        for at in range(low, high, 8192):
            n = np.arange(at, min(at + 8192, high)) * self.down
            places = (n // self.up + shift)[:, None] + np.arange(2 * self.half)
            result[at - low : at - low + len(n)] = (wave[places] * self.weights[n % self.up]).sum(axis=1)
        return result


def resample_chunks(chunks: DataFrame, key: str, rate_in: int, rate_out: int, size: int = CHUNK_SAMPLES, **options: float) -> DataFrame:
    """``(key, chunk, start, samples)``: band-limited resampling of all recordings from one rate to another, as doubles.

    ``start`` is the place of a chunk's first sample in the new recording. Chunks border on each other exactly: the result is that of
    whole recordings.
    """
    filter_ = SincFilter(rate_in, rate_out, **options)
    if filter_.half > size:
        raise ValueError("the filter is longer than a chunk")
    most = SAMPLES_AT_ONCE
    schema = T.StructType([chunks.schema[key], T.StructField("chunk", T.LongType()), T.StructField("start", T.LongType()), T.StructField("samples", T.ArrayType(T.DoubleType()))])

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in pieces(batch.column(3), most):
                part = batch.slice(low, high - low)
                starts = [c * size for c in part.column(1).to_pylist()]
                made = [filter_.apply(*_local(part, i), start) for i, start in enumerate(starts)]
                ends = np.concatenate([[0], np.cumsum([len(m) for m in made], dtype=np.int64)])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(made)))
                first = pa.array([filter_.outputs(start, 0)[0] for start in starts], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), first, lists], names=schema.names)

    return with_halo(chunks, key, filter_.half, filter_.half).mapInArrow(convert, schema)
