"""Queries over vectors and audio arrays."""

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.functions import audio as A
from corpusloom.functions import vectors as V
from corpusloom.functions.sequences import pad_audio as pad
from corpusloom.operators import embedding as E
from corpusloom.operators import recordings as R
from corpusloom.operators.rows import spread_rows
from corpusloom.plans.collate import splice_batch as splice
from corpusloom.session import fresh_path

DIM = 64


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.read_table(spark, sf_dir, "embeddings")


def embedding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings(spark, sf_dir).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))


def weighted_sum(values: Column, share: Column | None = None) -> Column:
    """A sum that changes if any value changes its place, or a share of it; the share of 0 is NULL."""
    weighted = F.transform(values, lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)
    return F.round(total if share is None else F.try_divide(total, share), 4)


@query(
    "vector_mean",
    """select cast(i - 1 as int) as dim, round(avg(cast(embedding[i] as double)), 9) as mean
    from (select embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by i""",
)
def vector_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.vector_mean(embeddings(spark, sf_dir), "embedding").withColumn("mean", F.round("mean", 9))


@query(
    "vector_std",
    "select round(stddev_samp(x), 9) as std from (select cast(unnest(embedding) as double) as x from embeddings)",
)
def vector_std(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.vector_std(embeddings(spark, sf_dir), "embedding").withColumn("std", F.round("std", 9))


@query(
    "init_new_vectors",
    """with means as (select i, avg(cast(embedding[i] as double)) as mean
      from (select embedding, unnest(range(1, len(embedding) + 1)) as i from embeddings) group by i)
    select t.token, (select max(vec_id) from embeddings) + t.nth as id, cast(i - 1 as int) as dim, round(mean, 9) as value
    from means, (values ('<|audio_start|>', 1), ('<|audio_end|>', 2)) as t(token, nth)""",
)
def init_new_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids after the table's last; without noise, so that the vectors can be told in advance."""
    table = embedding_table(spark, sf_dir)
    last = table.agg(F.max("id")).first()[0]
    new = [("<|audio_start|>", last + 1), ("<|audio_end|>", last + 2)]
    made = E.init_new_vectors(table, new, scale=0.0)
    exploded = made.select("token", "id", F.posexplode("vector").alias("dim", "value"))
    return exploded.withColumn("value", F.round("value", 9))


@query(
    "rms_norm",
    """select vec_id, cast(i - 1 as int) as dim, round(cast(embedding[i] as double) / scale, 6) as value
    from (select vec_id, embedding, unnest(range(1, len(embedding) + 1)) as i,
      sqrt(list_sum(list_transform(embedding, lambda x: cast(x as double) * x)) / len(embedding) + 1e-6) as scale
      from embeddings)""",
)
def rms_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = embeddings(spark, sf_dir).select("vec_id", V.rms_norm(F.col("embedding")).alias("vector"))
    return rows.select("vec_id", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 6))


def projector_weights(dim_in: int, dim_out: int, seed: int = 7) -> tuple[np.ndarray, ...]:
    draw = np.random.default_rng(seed)
    return (
        draw.normal(0, 0.01, (dim_out, dim_in)), np.zeros(dim_out),
        draw.normal(0, 1, (dim_out, dim_out)), np.zeros(dim_out),
    )


@query("project_vectors")
def project_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = V.project_vectors(F.col("embedding"), *projector_weights(DIM, 32))
    rows = embeddings(spark, sf_dir).select("vec_id", scored.alias("vector"))
    return rows.select("vec_id", F.posexplode("vector").alias("dim", "value")).withColumn("value", F.round("value", 6))


@query(
    "embedding_gather",
    f"""with {S.TURNS_SQL}, used as (select pos, unnest(ids) as id, generate_subscripts(ids, 1) as spot from turns),
    found as (select pos, spot, embedding from used join embeddings on vec_id = id)
    select t.pos, count(f.spot) as n,
      round(coalesce(sum(spot * cast(embedding[1] as double)), 0), 4) as first_sum,
      round(coalesce(sum(spot * cast(embedding[64] as double)), 0), 4) as last_sum
    from turns t left join found f using (pos) group by t.pos""",
)
def embedding_gather(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = S.turns(spark, sf_dir)
    gathered = E.embedding_gather(turns, ["pos"], "ids", embedding_table(spark, sf_dir), DIM)
    return gathered.select(
        "pos", F.size("embeds").cast("bigint").alias("n"),
        weighted_sum(F.transform("embeds", lambda v: F.get(v, 0))).alias("first_sum"),
        weighted_sum(F.transform("embeds", lambda v: F.get(v, DIM - 1))).alias("last_sum"),
    )


BUCKETS = 8


def bucketed_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "bucketed")
    return E.store_bucketed(embedding_table(spark, sf_dir), f"embeddings_{path.rsplit('-', 1)[1]}", path, BUCKETS)


@query(
    "gather_bucketed",
    f"""with {S.TURNS_SQL}, used as (select pos, unnest(ids) as id, generate_subscripts(ids, 1) as spot from turns),
    found as (select pos, spot, embedding, row_number() over (partition by pos order by spot) as place from used join embeddings on vec_id = id)
    select pos, count(*) as n, round(sum(place * cast(embedding[1] as double)), 4) as first_sum,
      round(sum(place * cast(embedding[64] as double)), 4) as last_sum
    from found group by pos""",
)
def gather_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors of turns from a table in buckets, which is not shuffled."""
    gathered = E.gather_bucketed(S.turns(spark, sf_dir), ["pos"], "ids", bucketed_embeddings(spark, sf_dir), BUCKETS)
    return gathered.select(
        "pos", F.size("embeds").cast("bigint").alias("n"),
        weighted_sum(F.transform("embeds", lambda v: F.get(v, 0))).alias("first_sum"),
        weighted_sum(F.transform("embeds", lambda v: F.get(v, DIM - 1))).alias("last_sum"),
    )


SPLICE_MARKER = 7


@query(
    "splice_batch",
    f"""with {S.BATCHED_TURNS_SQL},
    marked as (select b.batch_id, b.pos, b.ids, list_position(b.ids, {SPLICE_MARKER}) as place, s.embedding as vector
      from batched b join embeddings s on s.vec_id = b.pos % (select count(*) from embeddings)
      where list_position(b.ids, {SPLICE_MARKER}) > 0),
    long as (select *, max(len(ids) + 1) over (partition by batch_id) as longest from marked),
    used as (select pos, place, unnest(ids) as id, generate_subscripts(ids, 1) as spot from marked),
    parts as (
      select pos, case when spot < place then spot else spot + 1 end as spot, embedding as v from used join embeddings on vec_id = id where spot <> place
      union all select pos, place, vector from marked
      union all select pos, place + 1, list_reverse(vector) from marked),
    sums as (select pos, round(sum(spot * cast(v[1] as double)), 4) as first_sum, round(sum(spot * cast(v[64] as double)), 4) as last_sum
      from parts group by pos)
    select batch_id, pos, longest as n, first_sum, last_sum,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i < place then ids[i] when i <= place + 1 then -100 when i <= len(ids) + 1 then ids[i - 1] else -100 end)')} as labels,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) + 1 then 1 else 0 end)')} as attention_mask
    from long join sums using (pos)""",
)
def splice_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn has a segment of two vectors; those with a marker get it."""
    tokens = S.batched_turns(spark, sf_dir).select(
        "batch_id", "pos", F.col("ids").alias("input_ids"), F.col("ids").alias("labels")
    )
    table = embeddings(spark, sf_dir)
    number = F.lit(max(1, table.count()))
    segments = tokens.select("pos", (F.col("pos") % number).alias("vec_id")).join(table, "vec_id").select(
        "pos", F.array(F.col("embedding"), F.reverse(F.col("embedding"))).alias("segment")
    )
    spliced = splice(tokens, segments, embedding_table(spark, sf_dir), SPLICE_MARKER, DIM, strict=False)
    return spliced.select(
        "batch_id", "pos", F.size("inputs_embeds").cast("bigint").alias("n"),
        weighted_sum(F.transform("inputs_embeds", lambda v: F.get(v, 0))).alias("first_sum"),
        weighted_sum(F.transform("inputs_embeds", lambda v: F.get(v, DIM - 1))).alias("last_sum"),
        S.ids_text(F.col("labels")).alias("labels"),
        S.ids_text(F.col("attention_mask")).alias("attention_mask"),
    )


# Audio. The characters of a document are its samples.

SAMPLES_SQL = """sounds as (select doc_id,
  list_transform(list_filter(string_split(text, ''), lambda c: c <> ''), lambda c: cast(unicode(c) / 128 as float)) as a
  from documents)"""


def sounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples of all documents. Texts are dealt out first, as what follows costs far more."""
    texts = spread_rows(S.documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return texts.select("doc_id", S.text_samples(F.col("text")).alias("a"))


def long_sounds(spark: SparkSession, sf_dir: str, longer: int = -1) -> DataFrame:
    """``sounds`` of more than so many samples, computed on Arrow batches."""
    texts = spread_rows(S.documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    if longer >= 0:
        texts = texts.where(F.char_length("text") > longer)
    return texts.select("doc_id", S.text_samples_long(F.col("text")).alias("a"))


@query(
    "pad_audio",
    f"""with {SAMPLES_SQL} select doc_id, 2000 as n, least(len(a), 2000) as n_set,
      round(coalesce(list_sum(list_transform(a[1:2000], lambda x, i: cast(x as double) * i)), 0), 4) as total
    from sounds""",
)
def pad_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sounds(spark, sf_dir).select("doc_id", pad(F.col("a"), 2000).alias("p"))
    return rows.select(
        "doc_id", F.size("p.array").alias("n"),
        F.aggregate("p.mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("n_set"),
        weighted_sum(F.col("p.array")).alias("total"),
    )


@query(
    "resample",
    f"""with {SAMPLES_SQL},
    points as (select doc_id, a, unnest(range(0, (len(a) * 16000 + 23999) // 24000)) as i from sounds),
    mixed as (select doc_id, i, (i * 24000 % 16000) / 16000.0::double as part,
      cast(a[i * 24000 // 16000 + 1] as double) as l, cast(a[least(i * 24000 // 16000 + 2, len(a))] as double) as r from points)
    select doc_id, count(*) as n, round(sum((l * (1 - part) + r * part) * (i + 1)) / count(*), 4) as total from mixed group by doc_id""",
)
def resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As in SQL, an empty text has no samples and so no row. Samples are made in Arrow batches, where a character costs
    bytes and not an object; only texts that are no valid UTF-8 are left to expressions."""
    text = F.col("text")
    texts = spread_rows(S.documents(spark, sf_dir).select("doc_id", text), "doc_id").where(text.isNull() | (text != ""))
    samples = F.coalesce(S.text_samples_long(F.try_validate_utf8(text)), S.text_samples(text))
    rows = texts.select("doc_id", samples.alias("a")).select("doc_id", A.resample_long(F.col("a"), 24000, 16000).alias("r"))
    n = F.size("r").cast("bigint")
    return rows.select("doc_id", n.alias("n"), weighted_sum(F.col("r"), n).alias("total"))


@query(
    "cast_audio",
    f"""with {SAMPLES_SQL},
    rated as (select *, case doc_id % 4 when 0 then 24000 when 1 then 16000 when 2 then 0 end as rate from sounds),
    points as (select doc_id, a, rate, unnest(range(0, (len(a) * 16000 + rate - 1) // rate)) as i from rated where rate > 0),
    mixed as (select doc_id, i, cast(
      cast(a[i * rate // 16000 + 1] as double) * (1 - (i * rate % 16000) / 16000.0::double)
      + cast(a[least(i * rate // 16000 + 2, len(a))] as double) * ((i * rate % 16000) / 16000.0::double) as float) as x from points),
    sums as (select doc_id, count(*) as n, round(sum(cast(x as double) * (i + 1)) / count(*), 4) as total from mixed group by doc_id)
    select doc_id, 16000 as rate, s.n, s.total from rated left join sums s using (doc_id)""",
)
def cast_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Recordings of two rates, of none and of rate 0; the last two, and empty ones, have no samples afterwards."""
    kind = F.col("doc_id") % 4
    rate = F.when(kind == 0, 24000).when(kind == 1, 16000).when(kind == 2, 0)
    audio = F.struct(F.col("a").alias("array"), rate.alias("sampling_rate"))
    rows = sounds(spark, sf_dir).select("doc_id", A.cast_audio(audio, 16000).alias("r"))
    n = F.nullif(F.size("r.array").cast("bigint"), F.lit(0))
    return rows.select(
        "doc_id", F.col("r.sampling_rate").alias("rate"), n.alias("n"), weighted_sum(F.col("r.array"), n).alias("total")
    )


@query(
    "frame_energy",
    f"""with {SAMPLES_SQL},
    frames as (select doc_id, f, a[f * 160 + 1: f * 160 + 400] as part
      from (select doc_id, a, unnest(range(0, (len(a) + 159) // 160)) as f from sounds))
    select doc_id, f as frame, round(sqrt(list_sum(list_transform(part, lambda x: cast(x as double) * x)) / len(part)), 6) as energy
    from frames""",
)
def frame_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sounds(spark, sf_dir).select("doc_id", A.frame_energy(F.col("a")).alias("e"))
    frames = rows.select("doc_id", F.posexplode_outer("e").alias("frame", "energy"))
    return frames.where(F.col("frame").isNotNull()).select("doc_id", F.col("frame").cast("bigint").alias("frame"), F.round("energy", 6).alias("energy"))


@query("log_mel")
def log_mel(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = A.log_mel(sounds(spark, sf_dir), "doc_id", "a", length=None)
    return frames.select(
        "doc_id", "frame", F.round(F.aggregate("mel", F.lit(0.0), lambda acc, x: acc + x), 3).alias("total")
    )


# Recordings in chunks. A text is far shorter than a recording, so chunks are as well.

CHUNK = 1000


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.chunk_recordings(long_sounds(spark, sf_dir), "doc_id", "a", CHUNK)


@query(
    "frame_energy_chunks",
    f"""with {SAMPLES_SQL},
    frames as (select doc_id, f, a[f * 160 + 1: f * 160 + 400] as part
      from (select doc_id, a, unnest(range(0, (len(a) + 159) // 160)) as f from sounds))
    select doc_id, f as frame, round(sqrt(list_sum(list_transform(part, lambda x: cast(x as double) * x)) / len(part)), 6) as energy
    from frames""",
)
def frame_energy_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames across the borders of chunks are those of whole recordings."""
    frames = R.frame_energies(chunks(spark, sf_dir), "doc_id", CHUNK)
    return frames.withColumn("energy", F.round("energy", 6))


@query(
    "fit_chunks",
    f"""with {SAMPLES_SQL}, fitted as (select doc_id, a[1:2500] || list_transform(range(greatest(0, 2500 - len(a))), lambda i: 0::float) as b,
      least(len(a), 2500) as n from sounds where len(a) > 0),
    parts as (select doc_id, c, b[c * 1000 + 1: c * 1000 + 1000] as s, n from (select *, unnest(range(3)) as c from fitted))
    select doc_id, c as chunk, len(s) as n, cast(greatest(0, least(len(s), n - c * 1000)) as int) as n_set,
      round(list_sum(list_transform(s, lambda x, i: cast(x as double) * i)), 4) as total from parts""",
)
def fit_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = R.fit_chunks(chunks(spark, sf_dir), "doc_id", 2500, CHUNK)
    return fitted.select("doc_id", "chunk", F.size("samples").cast("bigint").alias("n"), "n_set", weighted_sum(F.col("samples")).alias("total"))


@query("log_mel_chunks")
def log_mel_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal to ``log_mel`` for texts long enough not to be mirrored more than once."""
    long = long_sounds(spark, sf_dir, A.FRAME_SAMPLES // 2)
    frames = R.log_mel_chunks(R.chunk_recordings(long, "doc_id", "a", CHUNK), "doc_id", CHUNK)
    return frames.select("doc_id", "frame", F.round(F.aggregate("mel", F.lit(0.0), lambda acc, x: acc + x), 3).alias("total"))


# Weights of each place between two samples, and their products with the samples around it, written out.
_SINC_SQL = """bank as (select list(w order by phase) as weights from (
    select phase, list(case when abs(d) < 16 / 0.63 then 0.63 * case when d = 0 then 1 else sin(pi() * 0.63 * d) / (pi() * 0.63 * d) end
      * pow(cos(pi() * d * 0.63 / 32), 2) else 0 end order by j) as w
    from (select phase, j, phase / 2.0::double - (j - 25) as d from range(2) p(phase), range(52) t(j)) group by phase)),
  padded as (select doc_id, len(a) as size, list_transform(range(26), lambda i: 0::double) || list_transform(a, lambda x: x::double)
    || list_transform(range(26), lambda i: 0::double) as wave from sounds),
  cut as (select doc_id, size, unnest(range(0, size, 1000)) as low, wave[unnest(range(0, size, 1000)) + 1 : unnest(range(0, size, 1000)) + 1052] as wave from padded),
  made as (select doc_id, n, list_dot_product(wave[n * 3 // 2 - low + 2 : n * 3 // 2 - low + 53], weights[n * 3 % 2 + 1]) as y
    from (select *, unnest(range((low * 2 + 2) // 3, (least(size, low + 1000) * 2 + 2) // 3)) as n from cut), bank)"""


@query(
    "resample_sinc",
    f"""with {SAMPLES_SQL}, {_SINC_SQL}
    select doc_id, count(*) as n, round(sum(y * (n + 1)) / count(*), 4) as total, round(max(y), 6) as most from made group by doc_id""",
)
def resample_sinc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From 24 to 16 kHz without folding, over the borders of chunks."""
    made = R.resample_chunks(chunks(spark, sf_dir), "doc_id", 24000, 16000, CHUNK, rolloff=0.945)
    values = made.select("doc_id", "start", F.posexplode("samples").alias("at", "y"))
    return values.groupBy("doc_id").agg(
        F.count("*").alias("n"),
        F.round(F.sum(F.col("y") * (F.col("start") + F.col("at") + 1)) / F.count("*"), 4).alias("total"),
        F.round(F.max("y"), 6).alias("most"),
    )
