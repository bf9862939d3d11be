"""Queries over configured sources."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.operators.interleave import union_sources as union
from corpusloom.plans.prepare import load_corpora, load_corpus, usable_rows
from corpusloom.operators.batching import assign_batches
from corpusloom.session import fresh_path
from corpusloom.sources.corpora import SourceSpec, open_sources
from corpusloom.sources.corpus_format import read_corpus, register_corpus_source
from corpusloom.streaming.streams import append_stream

WITH = f"with {S.UTTERANCES_SQL} "

MULTI = SourceSpec(
    "librispeech_asr",
    configs=S.LANGUAGES,
    train_splits=("train", "validation", "train", "validation"),
    eval_splits=("validation", "train", "validation", "train"),
)
SUBSET = SourceSpec("gigaspeech", train_split="train", eval_split="validation")
LANGUAGE = SourceSpec("common_voice", train_split="train", eval_split="validation")
SPECS = (MULTI, SUBSET, LANGUAGE)


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The utterances as each kind of source would hold them."""
    base = S.as_utterances(S.read_table(spark, sf_dir, "documents"))
    by_language = base.withColumn("config", F.col("source"))
    plain = by_language.drop("sentence")
    subsets = F.when(F.col("source") == "en", "xs").otherwise(F.col("source"))
    return {
        "librispeech_asr": plain,
        "gigaspeech": plain.withColumn("config", subsets),
        "common_voice": by_language.drop("text"),
    }


_MULTI_SQL = """multi as (
  select k, u.* from utterances u
  join (values (0, 'de', 'train'), (1, 'en', 'validation'), (2, 'es', 'train'), (3, 'fr', 'validation'))
    as c(k, config, split) on u.source = c.config and u.split = c.split)"""


@query("src_multi_config", WITH + f", {_MULTI_SQL} select cast(k as int) as k, utterance_id, text from multi")
def src_multi_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union(open_sources([MULTI], tables(spark, sf_dir))).select("k", "utterance_id", "text")


def stored_corpus(spark: SparkSession, sf_dir: str) -> str:
    """The multi-config corpus as files of its own."""
    register_corpus_source(spark)
    path = fresh_path(spark, "corpus")
    rows = tables(spark, sf_dir)["librispeech_asr"].select("utterance_id", "config", "split", "text")
    rows.write.parquet(path)
    return path


@query("src_corpus_format", WITH + f", {_MULTI_SQL} select cast(k as int) as k, utterance_id, text from multi")
def src_corpus_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows through the corpus format, which reads one config and split at a time."""
    path = stored_corpus(spark, sf_dir)
    parts = [read_corpus(spark, path, config=config, split=split) for config, split in zip(MULTI.configs, MULTI.splits(False))]
    return union(parts).select("k", "utterance_id", "text")


@query(
    "stream_corpus_format",
    WITH + "select utterance_id, source as config, split, text from utterances where source = 'en' or utterance_id < 100",
)
def stream_corpus_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus as a stream of what is available now, in two runs of one query."""
    path, out, checkpoint = stored_corpus(spark, sf_dir), fresh_path(spark, "streamed"), fresh_path(spark, "checkpoint")
    kind = spark.read.parquet(path).schema
    for _ in range(2):
        stream = spark.readStream.format("corpus").schema(kind).option("path", path).load()
        chosen = stream.where("config = 'en' or utterance_id < 100")
        append_stream(chosen, out, checkpoint).awaitTermination()
    return spark.read.schema(kind).parquet(out)


@query(
    "src_subset",
    WITH + f"""select utterance_id, {S.sql_clean('text')} as text from utterances
    where source = 'en' and split = 'train' and ({S.sql_clean('text')}) is not null""",
)
def src_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_sources([SUBSET], tables(spark, sf_dir))[0].select("utterance_id", "text")


@query(
    "src_language",
    WITH + "select utterance_id, sentence as text from utterances where source = 'en' and split = 'train'",
)
def src_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return open_sources([LANGUAGE], tables(spark, sf_dir))[0].select("utterance_id", "text")


_ALL_SQL = f"""{_MULTI_SQL}, streams as (
  select k, utterance_id, text from multi
  union all select 4, utterance_id, {S.sql_clean('text')} from utterances
    where source = 'en' and split = 'train' and ({S.sql_clean('text')}) is not null
  union all select 5, utterance_id, sentence from utterances where source = 'en' and split = 'train')"""


@query(
    "src_registry",
    WITH + f""", {_ALL_SQL} select cast(k as int) as k, count(*) as n, count(text) as n_text,
      cast(coalesce(sum(length(text)), 0) as bigint) as n_chars from streams group by k""",
)
def src_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = union(open_sources(SPECS, tables(spark, sf_dir)))
    return streams.groupBy("k").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("text").alias("n_text"),
        F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n_chars"),
    )


@query("union_sources", WITH + f", {_ALL_SQL} select cast(k as int) as k, utterance_id from streams")
def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return union(open_sources(SPECS, tables(spark, sf_dir))).select("k", "utterance_id")


def sql_round_robin(rows: str, order: str = "utterance_id", n: int = 4) -> str:
    """Interleave a table with a source number ``k``: stop at the first source to run out."""
    return f"""numbered as (select *, row_number() over (partition by k order by {order}) as rn from {rows}),
    ends as (select k, max(rn) as n from numbered group by k),
    cut as (select n as m, k as kmin from ends order by n, k limit 1),
    merged as (select numbered.*, (rn - 1) * {n} + k + 1 as pos from numbered, cut
      where rn < m or (rn = m and k <= kmin))"""


def _sql_side(split: str) -> str:
    return f"""select k, utterance_id from (select *, list_position(['de','en','es','fr'], source) - 1 as k
      from utterances where split = '{split}')"""


@query(
    "src_split_pair",
    WITH + "".join(
        f", {name}_rows as ({_sql_side(split)}), "
        + sql_round_robin(f"{name}_rows").replace("numbered", f"{name}_numbered").replace("ends", f"{name}_ends")
        .replace("cut", f"{name}_cut").replace("merged", f"{name}_merged")
        for name, split in (("t", "train"), ("v", "validation"))
    )
    + """ select 'train' as side, pos, utterance_id from t_merged
    union all select 'validation', pos, utterance_id from v_merged""",
)
def src_split_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = SourceSpec(
        "librispeech_asr", S.LANGUAGES, train_splits=["train"] * 4, eval_splits=["validation"] * 4
    )
    train, validation = load_corpora([spec], tables(spark, sf_dir))
    sides = [
        df.select(F.lit(name).alias("side"), "pos", "utterance_id")
        for name, df in (("train", train), ("validation", validation))
    ]
    return sides[0].unionByName(sides[1])


@query(
    "prepare_corpus",
    WITH + f""", sides as (select *, list_position(['de','en','es','fr'], source) - 1 as k from utterances
        where split = 'train'),
    {sql_round_robin('sides')},
    prepared as (select *, (pos - 1) // 4 as batch_id, {S.sql_usable('text', 'null')} as usable from merged)
    select source, count(*) as n_rows,
      cast(count(*) filter (where usable <> '' and {S.SHORT_ENOUGH}) as bigint) as n_valid,
      count(distinct batch_id) as n_batches,
      cast(sum(case when usable <> '' and {S.SHORT_ENOUGH} then length(usable) else 0 end) as bigint) as n_chars
    from prepared group by source""",
)
def prepare_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources, interleaved, batched and cleaned, counted by source."""
    spec = SourceSpec(
        "librispeech_asr", S.LANGUAGES, train_splits=["train"] * 4, eval_splits=["validation"] * 4
    )
    train = load_corpus([spec], tables(spark, sf_dir))
    batched = assign_batches(train, "pos", 4)
    rows = usable_rows(batched, F.col("n_samples"), 16000, S.MAX_SECONDS)
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("valid").alias("n_valid"),
        F.countDistinct("batch_id").alias("n_batches"),
        F.sum(F.when(F.col("valid"), F.length("text")).otherwise(0)).alias("n_chars"),
    )
