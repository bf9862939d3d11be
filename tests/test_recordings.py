"""Recordings in chunks next to whole ones."""

import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import audio as A
from corpusloom.operators import recordings as R

RNG = np.random.default_rng(5)
SIZES = [0, 1, 5, 399, 400, 401, 800, 801, 960, 1000, 2007, 4003]


@pytest.fixture(scope="module")
def waves(spark):
    rows = [(i, RNG.normal(size=n).astype(np.float32).tolist()) for i, n in enumerate(SIZES)]
    return spark.createDataFrame([*rows, (99, None)], "id long, samples array<float>")


def by_id(rows, *columns):
    out = {}
    for r in rows.orderBy("id", columns[0]).collect():
        out.setdefault(r["id"], []).append(tuple(r[c] for c in columns))
    return out


@pytest.mark.parametrize("size", [400, 401, 1000, 10_000])
def test_chunks_and_back(waves, size):
    chunks = R.chunk_recordings(waves, "id", "samples", size)
    back = {r["id"]: r["samples"] for r in R.whole_recordings(chunks, "id").collect()}
    assert back == {r["id"]: r["samples"] for r in waves.where("size(samples) > 0").collect()}
    assert {r["id"]: r["n_samples"] for r in R.recording_lengths(chunks, "id").collect()} == {i: n for i, n in enumerate(SIZES) if n}
    haloed = R.with_halo(chunks, "id", 7, 200).collect()
    for r in haloed:
        whole, start = back[r["id"]], r["chunk"] * size
        assert r["before"] == whole[max(0, start - 7) : start] and r["after"] == whole[start + size : start + size + 200]
    assert len(haloed) == chunks.count()


@pytest.mark.parametrize("size", [400, 401, 1000])
def test_frame_energies(waves, size):
    chunks = R.chunk_recordings(waves, "id", "samples", size)
    got = by_id(R.frame_energies(chunks, "id", size), "frame", "energy")
    whole = waves.select("id", F.posexplode(A.frame_energy(F.col("samples"))).alias("frame", "energy"))
    expected = by_id(whole, "frame", "energy")
    assert got.keys() == expected.keys() and all(np.allclose(got[i], expected[i], rtol=1e-12) for i in got)


@pytest.mark.parametrize("size", [400, 401, 1000])
def test_log_mel(waves, size):
    # Shorter ones are mirrored several times, which whole recordings are for.
    long = waves.where("size(samples) > 200")
    got = by_id(R.log_mel_chunks(R.chunk_recordings(long, "id", "samples", size), "id", size), "frame", "mel")
    expected = by_id(A.log_mel(long, "id", "samples", length=None), "frame", "mel")
    assert got.keys() == expected.keys()
    for i in got:
        assert [f for f, _ in got[i]] == [f for f, _ in expected[i]]
        assert np.allclose([m for _, m in got[i]], [m for _, m in expected[i]], atol=1e-6)


@pytest.mark.parametrize("length,size", [(1000, 400), (800, 400), (1, 400), (5000, 401)])
def test_fit(waves, length, size):
    chunks = R.fit_chunks(R.chunk_recordings(waves, "id", "samples", size), "id", length, size)
    whole = {r["id"]: r["samples"] for r in R.whole_recordings(chunks, "id").collect()}
    for r in waves.where("size(samples) > 0").collect():
        assert whole[r["id"]] == (r["samples"] + [0.0] * length)[:length]
    assert {r["id"]: r["n"] for r in chunks.groupBy("id").agg(F.sum("n_set").alias("n")).collect()} == {i: min(n, length) for i, n in enumerate(SIZES) if n}


@pytest.mark.parametrize("rates", [(24000, 16000), (16000, 24000), (44100, 16000), (8000, 8000), (3, 7)])
def test_chunked_resampling_is_that_of_the_whole(waves, rates):
    made = R.resample_chunks(R.chunk_recordings(waves, "id", "samples", 400), "id", *rates, size=400)
    got = by_id(made, "chunk", "start", "samples")
    filter_ = R.SincFilter(*rates)
    none = np.zeros(0)
    for r in waves.where("size(samples) > 0").collect():
        whole = filter_.apply(none, np.array(r["samples"]), none, 0)
        parts = got[r["id"]]
        assert [s for _, s, _ in parts] == np.cumsum([0, *(len(p) for _, _, p in parts[:-1])]).tolist()
        assert len(whole) == -(-len(r["samples"]) * rates[1] // rates[0])
        assert np.allclose(np.concatenate([p for _, _, p in parts]), whole, atol=1e-12)


def test_sines_are_kept_and_what_is_too_high_is_not():
    none, n = np.zeros(0), np.arange(24_000)
    filter_ = R.SincFilter(24_000, 16_000)
    # Up to where the filter begins to fall, and from where it has fallen.
    for hz, most in ((50, 3e-5), (440, 3e-5), (3000, 3e-5), (6000, 2e-3), (6500, 5e-3)):
        made = filter_.apply(none, np.sin(2 * np.pi * hz * n / 24_000), none, 0)
        true = np.sin(2 * np.pi * hz * np.arange(16_000) / 16_000)
        assert np.abs(made - true)[200:-200].max() < most
    for hz, most in ((8500, 7e-3), (9000, 2e-3), (10_000, 4e-4)):
        folded = filter_.apply(none, np.sin(2 * np.pi * hz * n / 24_000), none, 0)
        assert np.abs(folded[200:-200]).max() < most
    linear = np.interp(np.arange(16_000) * 1.5, n, np.sin(2 * np.pi * 9000 * n / 24_000))
    assert np.abs(linear[200:-200]).max() > 0.3


def test_two_hours_stay_in_chunks(spark):
    size, hop, n = 480_000, 160, 2 * 3600 * 16_000
    made = spark.range(n // size, numPartitions=24).select(
        F.lit(1).cast("long").alias("id"), F.col("id").alias("chunk"),
        F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: ((i % 100) / 100.0).cast("float")).alias("samples"),
    )
    frames = R.log_mel_chunks(made, "id", size).select("frame", F.size("mel").alias("bands"))
    found = frames.agg(F.count("*"), F.countDistinct("frame"), F.max("frame"), F.min("bands")).first()
    assert tuple(found) == (n // hop, n // hop, n // hop - 1, 80)


def test_halos_have_limits(spark, waves):
    chunks = R.chunk_recordings(waves, "id", "samples", 100)
    for call in (lambda: R.frame_energies(chunks, "id", 100), lambda: R.log_mel_chunks(chunks, "id", 100), lambda: R.resample_chunks(chunks, "id", 100, 1, size=100)):
        with pytest.raises(ValueError):
            call()


def test_energies_of_chunks_with_gaps_are_made_in_batches(spark):
    """Equal to the row function, missing samples included, with no expression for each sample."""
    rows = [(i, [None if i == 3 and j == 500 else (j * 37 % 101) / 7 for j in range(n)]) for i, n in enumerate((1, 399, 1000, 1601, 2050))]
    waves = spark.createDataFrame(rows, "id bigint, samples array<float>")
    made = R.frame_energies(R.chunk_recordings(waves, "id", "samples", 500), "id", 500)
    assert "MapInArrow" in made._jdf.queryExecution().toString()
    wanted = waves.select("id", F.posexplode(A.frame_energy(F.col("samples"))).alias("frame", "energy"))
    assert sorted(map(str, map(tuple, made.collect()))) == sorted(map(str, map(tuple, wanted.collect())))


def test_samples_of_texts_in_batches(spark):
    from corpusloom.catalog import standins as S

    texts = spark.createDataFrame([(t,) for t in ("", "abc", None, "é→😀", "a\x00b", "x" * 3000)], "text string")
    rows = texts.select(S.text_samples_long(F.col("text")).alias("l"), S.text_samples(F.col("text")).alias("s")).collect()
    assert all(r["l"] == r["s"] for r in rows) and len(rows) == 6


@pytest.mark.parametrize("most", [1_000_000, 0])
def test_log_mel_frames_are_written_as_floats_and_not_shuffled_by_recording(spark, monkeypatch, most):
    """Recordings with silence, whose values are cut off, without it, and none of a key; cuts are broadcast or joined."""
    written, write = {}, R.write_through

    def kept(df, name):
        written[name] = write(df, name)
        return written[name]

    monkeypatch.setattr(R, "write_through", kept)
    monkeypatch.setattr(R, "MOST_CUTS", most)
    noise = RNG.normal(size=4003).astype(np.float32)
    quiet = np.where(np.arange(4003) % 2000 < 1000, noise, 0).astype(np.float32)
    waves = spark.createDataFrame([(1, noise.tolist()), (2, quiet.tolist()), (3, quiet[:900].tolist()), (None, noise.tolist())], "id long, samples array<float>")
    frames = R.log_mel_chunks(R.chunk_recordings(waves, "id", "samples", 500), "id", 500)
    got = by_id(frames, "frame", "mel")
    expected = by_id(A.log_mel(waves.where("id is not null"), "id", "samples", length=None), "frame", "mel")
    assert got.keys() == expected.keys()
    for i in got:
        assert [f for f, _ in got[i]] == [f for f, _ in expected[i]]
        assert np.allclose([m for _, m in got[i]], [m for _, m in expected[i]], atol=1e-6)
    assert written["mel"].schema["mel"].dataType.simpleString() == "array<float>"
    assert {r["id"] for r in written["cuts"].collect()} == {2}
    if most:
        assert "hashpartitioning" not in frames._jdf.queryExecution().toString()


@pytest.mark.parametrize("rates", [(24, 16), (16, 24), (3, 1), (44100, 16000), (1, 1)])
def test_outputs_of_a_phase_are_made_from_steps_through_the_samples(rates):
    """Equal to a sum for each output, on both sides of the number from which on phases are taken together."""
    filter_ = R.SincFilter(*rates)
    for n in (1, 100, 32 * filter_.down - 3, 32 * filter_.down + 40):
        for start, before in ((0, 0), (7 * filter_.half, filter_.half)):
            parts = [RNG.normal(size=k) for k in (before, n, filter_.half)]
            low, high = filter_.outputs(start, n)
            wave = np.concatenate([np.zeros(filter_.half), *parts, np.zeros(filter_.half)])
            at = [(i * filter_.down // filter_.up + before - start + 1, i * filter_.down % filter_.up) for i in range(low, high)]
            wanted = [wave[place : place + 2 * filter_.half] @ filter_.weights[phase] for place, phase in at]
            assert np.allclose(filter_.apply(*parts, start), wanted, rtol=0, atol=1e-12)


def test_windows_are_not_gathered_sample_by_sample():
    filter_, wave = R.SincFilter(24, 16), RNG.normal(size=480_000)
    tracemalloc.start()
    filter_.apply(wave[:0], wave, wave[:0], 0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The padded samples, the result, and a block of windows at most; not its places, samples, weights and products.
    assert peak < 8 * (480_000 + 320_000 + 8192 * 2 * filter_.half) + 1_000_000
