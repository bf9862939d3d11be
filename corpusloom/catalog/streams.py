"""Queries that read a table as a stream."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.corpora import sql_round_robin
from corpusloom.catalog.registry import query
from corpusloom.session import fresh_path
from corpusloom.streaming import streams


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a stream, be it one file or a folder of files; as a pattern, the path may name either."""
    schema = S.read_table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


@query(
    "stream_clean",
    f"with {S.UTTERANCES_SQL} select utterance_id, {S.sql_clean('text')} as text from utterances "
    f"where ({S.sql_clean('text')}) is not null",
)
def stream_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = S.as_utterances(table_stream(spark, sf_dir, "documents")).select("utterance_id", "text")
    path = fresh_path(spark, "cleaned")
    streams.append_stream(streams.stream_clean(arriving), path, f"{path}-state").awaitTermination()
    return spark.read.schema("utterance_id bigint, text string").parquet(path)


@query(
    "stream_take",
    "select least(count(*), 50) as n, least(count(*), 50) as n_known from documents",
)
def stream_take(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any rows may arrive first; what is told is how many were taken and how many of them are in the table."""
    arriving = table_stream(spark, sf_dir, "documents").select("doc_id", "text")
    path = fresh_path(spark, "taken")
    streams.append_stream(streams.stream_take(arriving, 50), path, f"{path}-state").awaitTermination()
    taken = spark.read.schema("doc_id bigint, text string").parquet(path)
    known = S.read_table(spark, sf_dir, "documents").select("doc_id", "text", F.lit(1).alias("known"))
    found = taken.join(known, ["doc_id", "text"], "left")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count("known").alias("n_known"))


@query(
    "stream_restart",
    f"with {S.UTTERANCES_SQL} select utterance_id, {S.sql_clean('text')} as text from utterances "
    f"where ({S.sql_clean('text')}) is not null",
)
def stream_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream that is started again goes on where it ended and writes nothing twice."""
    path = fresh_path(spark, "restarted")
    for _ in range(2):
        arriving = S.as_utterances(table_stream(spark, sf_dir, "documents")).select("utterance_id", "text")
        streams.append_stream(streams.stream_clean(arriving), path, f"{path}-state").awaitTermination()
    return spark.read.schema("utterance_id bigint, text string").parquet(path)


@query(
    "stream_interleave",
    f"""with sources as (select doc_id, text, cast(list_position(['de','en','es','fr'], lang) - 1 as int) as k from documents),
    {sql_round_robin('sources', 'doc_id')} select pos, k, doc_id, text from merged""",
)
def stream_interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files of the table are one micro-batch, as no most files of a batch are set; the order of arrival is that of the ids."""
    arriving = table_stream(spark, sf_dir, "documents").select("lang", "doc_id", "text")
    path = fresh_path(spark, "interleaved")
    streams.stream_interleave(
        arriving, "lang", S.LANGUAGES, "doc_id", path, f"{path}-state"
    ).awaitTermination()
    return streams.read_interleaved(spark, path, S.LANGUAGES).select("pos", "k", "doc_id", "text")


@query(
    "stream_wer",
    f"""with recursive {S.EDITS_SQL}
    select conv_id // 20 as "window", cast(sum(edits) as bigint) as edits, cast(sum(ref_words) as bigint) as ref_words,
      round(sum(edits) / sum(ref_words), 9) as wer from scored group by 1""",
)
def stream_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    arriving = S.as_pairs(table_stream(spark, sf_dir, "conversations"))
    arriving = arriving.withColumnRenamed("conv_id", "step")
    path = fresh_path(spark, "wer")
    streams.stream_wer(arriving, 20, path, f"{path}-state").awaitTermination()
    return streams.read_wer(spark, path).withColumn("wer", F.round("wer", 9))
