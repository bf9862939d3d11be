"""Vector statistics, scoring chain and audio features against plain loops."""

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from check import difference
from corpusloom.catalog import QUERIES, SQL
from corpusloom.functions import audio as A
from corpusloom.functions import vectors as V
from corpusloom.operators import embedding as E
from corpusloom.operators.lookup import frequent_keys, head_rows_for


def vectors(spark, n=200, dim=8, seed=5):
    rows = np.random.default_rng(seed).normal(3.0, 0.5, (n, dim)).astype(np.float32)
    return rows, spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "id bigint, vector array<float>")


def test_mean_and_std(spark):
    rows, df = vectors(spark)
    exact = rows.astype(np.float64)
    means = [r["mean"] for r in E.vector_mean(df, "vector").orderBy("dim").collect()]
    assert np.allclose(means, exact.mean(axis=0), atol=1e-12)
    assert math.isclose(E.vector_std(df, "vector").first()["std"], exact.std(ddof=1), rel_tol=1e-12)


def test_new_vectors(spark):
    rows, df = vectors(spark, dim=64)
    exact = rows.astype(np.float64)
    new = [(f"<{i}>", 200 + i) for i in range(40)]
    made = {r["token"]: r for r in E.init_new_vectors(df, new).collect()}
    assert {t: r["id"] for t, r in made.items()} == dict(new)
    noise = (np.array([made[t]["vector"] for t, _ in new]) - exact.mean(axis=0)) / (exact.std(ddof=1) * 0.02)
    assert abs(noise.mean()) < 0.05 and abs(noise.std() - 1) < 0.05
    again = {r["token"]: r["vector"] for r in E.init_new_vectors(df.repartition(7), new).collect()}
    assert np.allclose([again[t] for t, _ in new], [made[t]["vector"] for t, _ in new], atol=1e-12)
    other = E.init_new_vectors(df, new[:1], seed=1).first()["vector"]
    assert not np.allclose(other, made["<0>"]["vector"])


def test_scoring_chain(spark):
    rows, df = vectors(spark, n=20)
    draw = np.random.default_rng(6)
    w1, b1, w2, b2 = draw.normal(size=(5, 8)), draw.normal(size=5), draw.normal(size=(5, 5)), draw.normal(size=5)
    got = df.select("id", V.project_vectors(F.col("vector"), w1, b1, w2, b2).alias("v")).orderBy("id").collect()
    for r, x in zip(got, rows.astype(np.float64)):
        x = x / math.sqrt(sum(v * v for v in x) / len(x) + 1e-6)
        hidden = [sum(a * b for a, b in zip(w, x)) + b for w, b in zip(w1, b1)]
        hidden = [0.5 * h * (1 + math.erf(h / math.sqrt(2))) for h in hidden]
        out = [0.01 * (sum(a * b for a, b in zip(w, hidden)) + b) for w, b in zip(w2, b2)]
        assert np.allclose(r["v"], out, atol=1e-12)
    normed = df.select("id", V.rms_norm(F.col("vector")).alias("v")).orderBy("id").first()["v"]
    assert math.isclose(sum(v * v for v in normed) / 8, 1.0, rel_tol=1e-5)


def test_weights_have_a_limit(monkeypatch):
    monkeypatch.setattr(V, "MOST_WEIGHT_BYTES", 100)
    with pytest.raises(ValueError, match="too many"):
        V.project_vectors(None, *(np.zeros((5, 5)) for _ in range(4)))


def test_broadcast_budget():
    assert head_rows_for(64 * 4) == 50_000
    assert head_rows_for(4096 * 4) == 4096
    assert head_rows_for(10**9) == 1


def test_frequent_keys(spark):
    df = spark.createDataFrame([(k,) for k in [3] * 9 + [1] * 4 + [2] * 4 + [5] + [None] * 20], "id bigint")
    assert [r["id"] for r in frequent_keys(df, "id", 3).collect()] == [3, 1, 2]


@pytest.mark.parametrize("rates", [(16000, 8000), (8000, 16000), (44100, 16000), (16000, 16000)])
def test_resample(spark, rates):
    rate_in, rate_out = rates
    wave = np.sin(np.arange(50) / 3).tolist()
    df = spark.createDataFrame([(0, wave), (1, [0.5]), (2, []), (3, None)], "id int, a array<float>")
    got = df.select(
        "id", A.resample(F.col("a"), rate_in, rate_out).alias("n"), A.resample_long(F.col("a"), rate_in, rate_out).alias("l")
    ).orderBy("id").collect()
    length = math.ceil(50 * rate_out / rate_in)
    wanted = np.interp(np.arange(length) * rate_in / rate_out, np.arange(50), np.float32(wave))
    assert np.allclose(got[0]["n"], wanted, atol=1e-9) and np.allclose(got[0]["l"], wanted, atol=1e-9)
    assert got[1]["n"] == got[1]["l"] and set(got[1]["n"]) == {0.5}
    assert got[2]["n"] == [] == got[2]["l"] and got[3]["n"] is None and got[3]["l"] is None


@pytest.mark.parametrize("arrow", [True, False])
def test_cast_audio_per_row(spark, arrow):
    schema = "id int, audio struct<array: array<float>, sampling_rate: int>"
    df = spark.createDataFrame([(0, ([1.0, 2.0], 8)), (1, ([1.0, 2.0, 3.0, 4.0], 32))], schema)
    got = df.select("id", A.cast_audio(F.col("audio"), 16, arrow).alias("a")).orderBy("id").collect()
    assert got[0]["a"]["array"] == [1.0, 1.5, 2.0, 2.0] and got[1]["a"]["array"] == [1.0, 3.0]
    assert {r["a"]["sampling_rate"] for r in got} == {16}


@pytest.mark.parametrize("arrow", [True, False])
def test_unknown_rates_give_no_samples(spark, arrow):
    schema = "id int, audio struct<array: array<float>, sampling_rate: int>"
    df = spark.createDataFrame([(0, ([1.0], None)), (1, ([1.0], 0)), (2, ([1.0], -8)), (3, None), (4, (None, 8)), (5, ([1.0], 16))], schema)
    got = {r["id"]: r["a"]["array"] for r in df.select("id", A.cast_audio(F.col("audio"), 16, arrow).alias("a")).collect()}
    assert got == {0: None, 1: None, 2: None, 3: None, 4: None, 5: [1.0]}


def test_durations(spark):
    df = spark.createDataFrame([(32, 16), (33, 16), (None, 16), (5, 0), (5, None)], "n int, rate int")
    got = [r[0] for r in df.select(A.within_duration(F.col("n"), F.col("rate"), 2.0)).collect()]
    assert got == [True, False, False, False, False]


def test_frame_energy(spark):
    wave = [float(i) for i in range(1, 11)]
    df = spark.createDataFrame([(wave,), ([],), (None,)], "a array<float>")
    got = df.select(A.frame_energy(F.col("a"), frame=4, hop=3).alias("e")).collect()
    wanted = [math.sqrt(np.mean(np.square(wave[i : i + 4]))) for i in (0, 3, 6, 9)]
    assert np.allclose(got[0]["e"], wanted) and got[1]["e"] == [] and got[2]["e"] is None


def test_log_mel(spark):
    """A tone has its peak in the band around it; values follow the published formula."""
    rate, hz = 16000, 1000.0
    wave = np.sin(2 * np.pi * hz * np.arange(3200) / rate).astype(np.float32)
    df = spark.createDataFrame([(1, wave.tolist()), (2, [])], "id bigint, a array<float>")
    got = A.log_mel(df, "id", "a", length=4800).orderBy("id", "frame").collect()
    tone = np.array([r["mel"] for r in got if r["id"] == 1])
    assert tone.shape == (30, 80) and len(got) == 60
    assert math.isclose(tone.max() - 2.0, tone.min(), abs_tol=1e-5)
    filters = A._mel_filters(rate, 400, 80)
    assert tone[5].argmax() in np.flatnonzero(filters[:, int(hz * 400 / rate)])
    frame = np.pad(np.pad(wave, (0, 1600)), 200, mode="reflect")[5 * 160 : 5 * 160 + 400].astype(np.float64)
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(400) / 400)
    spectrum = [abs(sum(frame * window * np.exp(-2j * np.pi * k * np.arange(400) / 400))) ** 2 for k in range(201)]
    wanted = np.log10(np.maximum(filters @ np.array(spectrum), 1e-10))
    assert np.allclose(tone[5], (np.maximum(wanted, tone.max() * 4 - 4 - 8) + 4) / 4, atol=1e-4)
    quiet = np.array([r["mel"] for r in got if r["id"] == 2])
    assert np.allclose(quiet, (-10 + 4) / 4)
    whole = A.log_mel(df, "id", "a", length=None).collect()
    assert len(whole) == 20
    matrix = df.orderBy("id").select(A.mel_features(F.col("a"), 4800).alias("m")).first()["m"]
    assert np.array_equal(np.array(matrix, dtype=np.float32).T, tone.astype(np.float32))


def test_resampling_goes_piece_by_piece(monkeypatch):
    """A batch is resampled in pieces of few samples, so a task never holds those of all of its rows."""
    import pyarrow as pa

    monkeypatch.setattr(A, "SAMPLES_AT_ONCE", 6)
    waves = pa.array([[0.0, 1.0, 2.0], None, [], [3.0, 5.0, 7.0], [0.0, 1.0, None], [4.0]], pa.list_(pa.float32()))
    made = list(A._resampler(2).func(iter([(waves, pa.array([3] * 6))])))
    assert [len(part) for part in made] == [4, 2]
    got = sum((part.to_pylist() for part in made), [])
    assert got == [[0.0, 1.5], None, [], [3.0, 6.0], [0.0, None], [4.0]]


def texts_in(spark, folder, texts):
    rows = list(enumerate(texts))
    spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1).write.parquet(f"{folder}/documents.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["resample", "cast_audio"])
def test_empty_texts_equal_sql(spark, tmp_path, name):
    """An empty text has no samples to take a share of, which is no error."""
    folder = texts_in(spark, tmp_path, ["", "", "", "", "ab c", "x", "d", "e", "\u00e4\U0001f600\u4e2d", "ab" * 400])
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{folder}/documents.parquet/*.parquet'")
    assert difference(QUERIES[name](spark, folder), con.sql(SQL[name])) is None


def test_resample_of_odd_texts(spark, tmp_path):
    """No row for an empty text, one without samples for a missing text, one for a long text."""
    df = QUERIES["resample"](spark, texts_in(spark, tmp_path, ["", None, "a" * 300_000]))
    got = {r["doc_id"]: (r["n"], r["total"]) for r in df.collect()}
    mean = sum(range(1, 200_001)) / 200_000
    assert got == {1: (None, None), 2: (200_000, round(97 / 128 * mean, 4))}


def test_resample_of_broken_texts(spark, tmp_path):
    """Bytes that are no UTF-8 are one sample for each character they begin, as in the other queries over sounds."""
    bad = ("61", "6162ff63", "c3", "eda08041", "61f09f6263e4b878")
    rows = ", ".join(f"({i}L, cast(unhex('{x}') as string))" for i, x in enumerate(bad))
    spark.sql(f"select * from values {rows} as t(doc_id, text)").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["n"], r["total"]) for r in QUERIES["resample"](spark, str(tmp_path)).collect()}
    assert got == {0: (1, 0.7578), 1: (3, 171.9401), 2: (1, 511.9766), 3: (2, 256.4961), 4: (2, 512.3555)}
