"""Queries over transcripts: cleaning, fallbacks, row filters."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.functions import text as X
from corpusloom.functions.audio import within_duration
from corpusloom.operators.rows import filter_map, tolerant_rows
from corpusloom.plans.collate import instruction_len as template_words
from corpusloom.sources.sinks import run_path as path_of

WITH = f"with {S.UTTERANCES_SQL} "

_LEFT, _RIGHT = "　\t", " \n "


@query("strip_ws", f"select doc_id, {S.sql_strip(f'''('{_LEFT}' || text || '{_RIGHT}')''')} as text from documents")
def strip_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit(_LEFT), F.col("text"), F.lit(_RIGHT))
    return S.documents(spark, sf_dir).select("doc_id", X.strip_ws(padded).alias("text"))


@query("collapse_ws", f"select doc_id, {S.sql_collapse('text')} as text from documents")
def collapse_ws(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.documents(spark, sf_dir).select("doc_id", X.collapse_ws(F.col("text")).alias("text"))


@query(
    "reject_tags",
    WITH + f"select utterance_id, case when {S.sql_rejected('text')} then null else text end as text from utterances",
)
def reject_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.utterances(spark, sf_dir).select("utterance_id", X.reject_tags(F.col("text")).alias("text"))


@query("clean_text", WITH + f"select utterance_id, {S.sql_clean('text')} as text from utterances")
def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.utterances(spark, sf_dir).select("utterance_id", X.clean_text(F.col("text")).alias("text"))


@query("clean_guarded", WITH + f"select utterance_id, {S.sql_guarded('text')} as text from utterances")
def clean_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.utterances(spark, sf_dir).select("utterance_id", X.clean_guarded(F.col("text")).alias("text"))


@query(
    "filter_clean",
    WITH + f"select utterance_id, source, {S.sql_clean('text')} as text from utterances "
    f"where ({S.sql_clean('text')}) is not null",
)
def filter_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = filter_map(S.utterances(spark, sf_dir), "text", X.clean_text(F.col("text")))
    return cleaned.select("utterance_id", "source", "text")


@query(
    "drop_empty",
    WITH + f"select utterance_id, {S.sql_strip('text')} as text from utterances where {S.sql_strip('text')} <> ''",
)
def drop_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    stripped = S.utterances(spark, sf_dir).select("utterance_id", X.strip_ws(F.col("text")).alias("text"))
    return stripped.where(F.col("text") != "")


@query("rename_text", WITH + "select utterance_id, sentence as text from utterances")
def rename_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = S.utterances(spark, sf_dir).select("utterance_id", "sentence")
    return table.withColumnRenamed("sentence", "text")


@query(
    "text_fallback_value",
    WITH + "select utterance_id, coalesce(nullif(text, ''), nullif(sentence, ''), '') as text from utterances",
)
def text_fallback_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = S.utterances(spark, sf_dir)
    return table.select("utterance_id", X.text_by_value(table).alias("text"))


@query(
    "text_fallback_schema",
    WITH + """select utterance_id, 'both' as present, text from utterances
    union all select utterance_id, 'sentence', sentence from utterances
    union all select utterance_id, 'none', '' from utterances""",
)
def text_fallback_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = S.utterances(spark, sf_dir).select("utterance_id", "text", "sentence")
    cases = {"both": both, "sentence": both.drop("text"), "none": both.drop("text", "sentence")}
    picked = [
        table.select("utterance_id", F.lit(name).alias("present"), X.text_fallback_schema(table).alias("text"))
        for name, table in cases.items()
    ]
    return picked[0].unionByName(picked[1]).unionByName(picked[2])


_TEMPLATE_SQL = "'" + X.INSTRUCTION_TEMPLATE + "'"


@query("instruction_text", WITH + f"select utterance_id, {_TEMPLATE_SQL} || text as text from utterances")
def instruction_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.utterances(spark, sf_dir).select("utterance_id", X.instruction_text(F.col("text")).alias("text"))


@query(
    "instruction_len",
    WITH + f"""select utterance_id, len({S.sql_split(_TEMPLATE_SQL)}) as n_prompt,
      len({S.sql_split(f'({_TEMPLATE_SQL} || text)')}) as n_all
    from utterances where text is not null""",
)
def instruction_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        S.utterances(spark, sf_dir)
        .where(F.col("text").isNotNull())
        .select(
            "utterance_id",
            template_words().alias("n_prompt"),
            F.size(X.split_ws(X.instruction_text(F.col("text")))).cast("bigint").alias("n_all"),
        )
    )


@query("max_duration", WITH + f"select utterance_id, n_samples from utterances where {S.SHORT_ENOUGH}")
def max_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = within_duration(F.col("n_samples"), F.col("sampling_rate"), S.MAX_SECONDS)
    return S.utterances(spark, sf_dir).where(short).select("utterance_id", "n_samples")


_DAMAGE = (
    "case when text = '' then 0 when text is null then null else sampling_rate end as rate",
    "case when text = '<SIL>' then null else n_samples end as samples",
)


@query(
    "tolerant_rows",
    WITH + f""", damaged as (select *, {', '.join(_DAMAGE)} from utterances),
    marked as (
      select utterance_id, case when samples is null then 'samples' when rate is null or rate = 0 then 'rate'
        when samples / rate > {S.MAX_SECONDS} then 'duration' when text is null then 'text' end as reason
      from damaged)
    select coalesce(reason, 'kept') as reason, count(*) as n from marked group by 1""",
)
def tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    damaged = S.utterances(spark, sf_dir).selectExpr("*", *_DAMAGE)
    kept, rejected = tolerant_rows(
        damaged,
        samples=F.col("samples").isNotNull(),
        rate=F.try_divide(F.lit(1), F.col("rate")).isNotNull(),
        duration=within_duration(F.col("samples"), F.col("rate"), S.MAX_SECONDS),
        text=F.col("text").isNotNull(),
    )
    counted = kept.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("n"))
    return counted.unionByName(rejected)


@query(
    "run_path",
    """select event_id, 'outputs/' || strftime(ts, '%Y-%m-%d/%H-%M-%S') as path,
      'multirun/' || strftime(ts, '%Y-%m-%d/%H-%M-%S') || '/' || user_id as job_path from events""",
)
def run_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.read_table(spark, sf_dir, "events").select(
        "event_id",
        path_of(F.col("ts")).alias("path"),
        path_of(F.col("ts"), "multirun", F.col("user_id")).alias("job_path"),
    )
