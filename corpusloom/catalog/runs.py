"""Queries over run metrics and their tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.catalog.scoring import numbered_pairs
from corpusloom.functions.text import clean_text
from corpusloom.operators import metrics as M
from corpusloom.operators.observed import ObservedRun, observed_score
from corpusloom.operators.rows import filter_map
from corpusloom.plans.evaluate import evaluation_texts
from corpusloom.plans.evaluate import log_predictions as log_due_predictions
from corpusloom.session import fresh_path
from corpusloom.sources import sinks
from corpusloom.sources.quarantine import counts_by_reason, read_json_lines
from corpusloom.sources.sinks import read_scalars

POINTS = f"with {S.POINTS_SQL}"


@query(
    "metric_rollup",
    f"""{POINTS}, logged as (select *, case when step = 1 then 1 else cast(ceil(step / 20.0) * 20 as bigint) end as spot from points)
    select run_id, spot as step, round(avg(value), 6) as value from logged group by run_id, spot having max(step) = spot""",
)
def metric_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rolled = M.metric_rollup(S.metric_points(spark, sf_dir))
    return rolled.withColumn("value", F.round("value", 6))


@query(
    "retain_last_k",
    f"""{POINTS}, saved as (select * from points where event_type = 'error'),
    placed as (select *, row_number() over (partition by run_id order by step desc) as age,
      first_value(step) over (partition by run_id order by value nulls last, step) as best from saved),
    kept as (select *, max(case when step = best then age end) over (partition by run_id) as best_age from placed)
    select run_id, step, value from kept where step = best or age <= case when best_age <= 3 then 3 else 2 end""",
)
def retain_last_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.retain_last_k(S.metric_points(spark, sf_dir, "error"))


@query(
    "best_checkpoint",
    f"""{POINTS}, saved as (select * from points where event_type = 'error')
    select run_id, step, value from saved
    qualify row_number() over (partition by run_id order by value, step) = 1""",
)
def best_checkpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.best_checkpoint(S.metric_points(spark, sf_dir, "error"))


@query(
    "sink_scalar",
    f"{POINTS} select cast(run_id as varchar) as run_id, event_type as tag, step, value from points",
)
def sink_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = S.read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", F.col("event_type").alias("tag"), "value"
    )
    path = fresh_path(spark, "scalars")
    sinks.write_scalars(S.ordinal(events, ["ts", "event_id"], ["run_id"], out="step"), path)
    return sinks.read_scalars(spark, path)


def evaluation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A role of a conversation is a run, a conversation an evaluation step."""
    return numbered_pairs(spark, sf_dir).select(
        F.col("role").alias("run_id"), F.col("conv_id").alias("step"), "pos", "reference", "prediction"
    )


@query(
    "sink_text",
    f"""with {S.PAIRS_SQL}, numbered as (select *, turn + 1 as pos from pairs)
    select role as run_id, 'eval/predictions' as tag, conv_id as step,
      string_agg('**Sample ' || pos || '**\n\nTruth: ' || reference || '\n\nPrediction: '
      || array_to_string(h, ' ') || '\n\n---', '\n' order by pos) as text
    from numbered where pos <= 5 group by role, conv_id""",
)
def sink_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "texts")
    sinks.write_texts(evaluation_texts(evaluation_pairs(spark, sf_dir)), path)
    return sinks.read_texts(spark, path)


EVERY, SAMPLES = 2, 3


@query(
    "log_predictions",
    f"""with recursive {S.EDITS_SQL},
    due as (select *, turn + 1 as pos from scored where conv_id % {EVERY} = 0 and conv_id > 0 and turn < {SAMPLES}),
    rates as (select role, conv_id, round(sum(edits) / sum(ref_words), 9) as value from due group by role, conv_id),
    told as (select role, conv_id, string_agg('**Sample ' || (turn + 1) || '**\n\nTruth: ' || reference || '\n\nPrediction: '
      || array_to_string(h, ' ') || '\n\n---', '\n' order by turn) as text
      from pairs where conv_id % {EVERY} = 0 and conv_id > 0 and turn < {SAMPLES} group by role, conv_id)
    select role as run_id, conv_id as step, value, text from rates join told using (role, conv_id)""",
)
def log_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second conversation is an evaluation that is due; run twice, it is stored once."""
    scalars, texts = fresh_path(spark, "scalars"), fresh_path(spark, "texts")
    for _ in range(2):
        log_due_predictions(evaluation_pairs(spark, sf_dir), scalars, texts, every=EVERY, samples=SAMPLES, part="first")
    values = sinks.read_scalars(spark, scalars).select("run_id", "step", F.round("value", 9).alias("value"))
    return values.join(sinks.read_texts(spark, texts).select("run_id", "step", "text"), ["run_id", "step"])


# Metrics of a job taken while it runs.


@query(
    "observed_run",
    f"""with recursive {S.EDITS_SQL}, {S.UTTERANCES_SQL},
    cleaned as (select {S.sql_clean('text')} as text from utterances)
    select 'read/rows' as tag, cast(count(*) as double) as value from utterances
    union all select 'kept/rows', count(*) from cleaned where text is not null
    union all select 'kept/characters', coalesce(sum(length(text)), 0) from cleaned where text is not null
    union all select 'score/rows', count(*) from conversations
    union all select 'score/edits', sum(edits) from scored
    union all select 'score/ref_words', sum(ref_words) from scored
    union all select 'score/unscored', (select count(*) from conversations) - count(*) from scored""",
)
def observed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows read and kept by cleaning, and the word errors of a scoring job, read back from the table of scalars."""
    run = ObservedRun("observed")
    cleaned = filter_map(run.at(S.utterances(spark, sf_dir), "read"), "text", clean_text(F.col("text")))
    run.at(cleaned, "kept", characters=F.sum(F.length("text"))).write.parquet(fresh_path(spark, "cleaned"))
    observed_score(S.prediction_pairs(spark, sf_dir), run).write.parquet(fresh_path(spark, "scored"))
    path = fresh_path(spark, "scalars")
    run.write(spark, path, "jobs")
    return read_scalars(spark, path).select("tag", "value")


# Lines of JSON, some of them cut off or with a value of another type.

_LINES_SCHEMA = StructType([StructField("doc_id", LongType(), False), StructField("n_chars", LongType()), StructField("text", StringType())])


def damaged_lines(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    kind = F.col("doc_id") % 20
    values = F.struct(
        F.when(kind != 3, F.col("doc_id")).alias("doc_id"), F.when(kind == 5, "many").otherwise(F.col("n_chars").cast("string")).alias("n_chars"), "text"
    )
    path = fresh_path(spark, "lines")
    rows = S.documents(spark, sf_dir).select(kind.alias("kind"), F.to_json(values).alias("line"))
    cut = F.when(F.col("kind") == 7, F.expr("substring(line, 1, length(line) - 3)")).otherwise(F.col("line"))
    rows.select(cut.alias("value")).write.text(path)
    return read_json_lines(spark, path, _LINES_SCHEMA)


@query("quarantine_rows", "select doc_id, n_chars, length(text) as n from documents where doc_id % 20 not in (3, 5, 7)")
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of all lines that can be read."""
    rows = damaged_lines(spark, sf_dir)[0]
    return rows.select("doc_id", "n_chars", F.length("text").cast("bigint").alias("n"))


@query(
    "quarantine_counts",
    """select case doc_id % 20 when 3 then 'missing' when 5 then 'wrong type' else 'malformed' end as reason,
      case doc_id % 20 when 3 then 'doc_id' when 5 then 'n_chars' end as field, count(*) as n
    from documents where doc_id % 20 in (3, 5, 7) group by 1, 2""",
)
def quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many lines cannot be read, by reason and field."""
    return counts_by_reason(damaged_lines(spark, sf_dir)[1])
