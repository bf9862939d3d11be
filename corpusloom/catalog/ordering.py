"""Queries over positions: ordinals, interleaving, limits, batches."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.corpora import sql_round_robin
from corpusloom.catalog.registry import query
from corpusloom.operators import batching as B
from corpusloom.operators.growing import append_positions, create_positions, read_positions
from corpusloom.operators.interleave import interleave as round_robin
from corpusloom.operators.metrics import every_n_steps as on_cadence
from corpusloom.operators.ordinal import attach_ordinal, first_n, ordinal
from corpusloom.plans.evaluate import EVAL_SAMPLES
from corpusloom.plans.prepare import usable_rows
from corpusloom.plans.resume import Stage, manifests, run_stages
from corpusloom.session import fresh_path

WITH = f"with {S.UTTERANCES_SQL}, placed as (select *, row_number() over (order by utterance_id) as pos from utterances) "

TRAIN_BATCH = 4
ACCUMULATION = 4


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.as_utterances(S.read_table(spark, sf_dir, "documents"))


def placed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal(utterances(spark, sf_dir).select("utterance_id"), ["utterance_id"])


@query(
    "source_ordinal",
    "select lang as source, doc_id as utterance_id, row_number() over (partition by lang order by doc_id) as rn from documents",
)
def source_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = utterances(spark, sf_dir).select("source", "utterance_id")
    return ordinal(ids, ["utterance_id"], ["source"], out="rn")


@query(
    "interleave",
    f"""with {S.UTTERANCES_SQL},
    sources as (select *, cast(list_position(['de','en','es','fr'], source) - 1 as int) as k from utterances),
    {sql_round_robin('sources')}
    select pos, k, rn, utterance_id, text from merged""",
)
def interleave(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = utterances(spark, sf_dir)
    sources = [table.where(F.col("source") == name) for name in S.LANGUAGES]
    return round_robin(sources, "utterance_id").select("pos", "k", "rn", "utterance_id", "text")


@query(
    "interleave_single",
    "select row_number() over (order by doc_id) as pos, cast(0 as int) as k, row_number() over (order by doc_id) as rn, "
    "doc_id as utterance_id from documents where lang = 'fr'",
)
def interleave_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    only = utterances(spark, sf_dir).where(F.col("source") == "fr")
    return round_robin([only], "utterance_id").select("pos", "k", "rn", "utterance_id")


@query("take_n", WITH + "select pos, utterance_id, source, text from placed where pos <= 100")
def take_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_n(utterances(spark, sf_dir), ["utterance_id"], 100).select("pos", "utterance_id", "source", "text")


@query(
    "eval_sample",
    f"select * from (select row_number() over (order by item_id) as pos, item_id, text from benchmark) where pos <= {EVAL_SAMPLES}",
)
def eval_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = S.read_table(spark, sf_dir, "benchmark")
    return first_n(table, ["item_id"], EVAL_SAMPLES).select("pos", "item_id", "text")


@query("assign_batches", WITH + f"select utterance_id, (pos - 1) // {TRAIN_BATCH} as batch_id from placed")
def assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = placed_ids(spark, sf_dir)
    return B.assign_batches(placed, "pos", TRAIN_BATCH).select("utterance_id", "batch_id")


@query(
    "assign_steps",
    WITH + f"select utterance_id, (pos - 1) // {TRAIN_BATCH * ACCUMULATION} + 1 as step from placed",
)
def assign_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = placed_ids(spark, sf_dir)
    return B.assign_steps(placed, "pos", TRAIN_BATCH, ACCUMULATION).select("utterance_id", "step")


@query(
    "empty_batches",
    WITH + f""", checked as (select (pos - 1) // {TRAIN_BATCH} as batch_id,
        {S.sql_usable()} <> '' and {S.SHORT_ENOUGH} as valid from placed)
    select batch_id, count(*) as n_rows, cast(count(*) filter (where valid) as bigint) as n_valid,
      cast(count(*) filter (where valid) = 0 as int) as is_empty from checked group by batch_id""",
)
def empty_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = attach_ordinal(utterances(spark, sf_dir), ["utterance_id"], ["utterance_id"])
    batched = B.assign_batches(placed, "pos", TRAIN_BATCH)
    rows = usable_rows(batched, F.col("n_samples"), 16000, S.MAX_SECONDS)
    return B.batch_report(rows, F.col("valid")).withColumn("is_empty", F.col("is_empty").cast("int"))


@query("every_n_steps", f"with {S.POINTS_SQL} select run_id, step, value from points where step % 20 = 0 and step > 0")
def every_n_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return on_cadence(S.metric_points(spark, sf_dir), n=20)


@query(
    "batch_first",
    f"with {S.BATCHED_TURNS_SQL} select pos, batch_id, len(ids) as n_own, "
    "first_value(len(ids)) over (partition by batch_id order by pos) as n_first from batched",
)
def batch_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.batched_turns(spark, sf_dir).select(
        "pos", "batch_id", F.size("ids").cast("bigint").alias("n_own")
    )
    return B.batch_first(rows, "pos", "n_own", "n_first")


@query(
    "batch_max_len",
    f"with {S.BATCHED_TURNS_SQL} select batch_id, max(len(ids)) as max_len from batched group by batch_id",
)
def batch_max_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.batch_max_len(S.batched_turns(spark, sf_dir), "ids")


@query(
    "collate_udf",
    f"with {S.BATCHED_TURNS_SQL} select batch_id, count(*) as n_rows, cast(sum(len(ids)) as bigint) as n_ids, "
    "max(len(ids)) as max_len from batched group by batch_id",
)
def collate_udf(spark: SparkSession, sf_dir: str) -> DataFrame:
    def measure(batch):
        sizes = batch["ids"].map(len)
        return batch[["batch_id"]].head(1).assign(
            n_rows=len(batch), n_ids=int(sizes.sum()), max_len=int(sizes.max())
        )

    return B.collate_udf(
        S.batched_turns(spark, sf_dir), measure, "batch_id bigint, n_rows bigint, n_ids bigint, max_len bigint"
    )


@query(
    "growing_ordinal",
    "select lang, doc_id, row_number() over (order by coalesce(lang, ''), doc_id) as pos from documents",
)
def growing_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Positions of a table that came in four parts, of which the last lies within one range."""
    rows = S.documents(spark, sf_dir).select(F.coalesce("lang", F.lit("")).alias("lang"), "doc_id")
    part = F.when((F.col("lang") == "en") & F.col("doc_id").between(100, 200), 3).otherwise(F.col("doc_id") % 3)
    path = fresh_path(spark, "growing")
    create_positions(rows.where(part == 0), ["lang", "doc_id"], path)
    for i in (1, 2, 3):
        append_positions(rows.where(part == i), ["lang", "doc_id"], path)
    return read_positions(spark, path, rows)


def _run(spark: SparkSession, sf_dir: str, path: str, most: int) -> DataFrame:
    """Usable texts of one parity, then a count by language."""
    stages = [
        Stage("short", lambda df, most: df.where(F.length("text") <= most), {"most": most}),
        Stage("counted", lambda df: df.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("n_chars"))),
    ]
    return run_stages(spark, f"{sf_dir}/documents.parquet", stages, path)


@query(
    "resumed_run",
    """with c as (select lang, count(*) as n, cast(sum(n_chars) as bigint) as n_chars from documents where length(text) <= 3000 group by lang)
    select lang, n, n_chars, 3 as n_stages from c""",
)
def resumed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that is repeated, and one of another parameter: two stages each, of which one more is run once."""
    path = fresh_path(spark, "run")
    for most in (3000, 3000):
        counted = _run(spark, sf_dir, path, most)
    more = run_stages(spark, f"{sf_dir}/documents.parquet", [Stage("short", lambda df, most: df.where(F.length("text") <= most), {"most": 100})], path)
    more.isEmpty()
    return counted.withColumn("n_stages", F.lit(manifests(spark, path).count()).cast("int"))
