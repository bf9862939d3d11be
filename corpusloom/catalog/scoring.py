"""Queries over prediction pairs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.functions.words import format_wer as percent
from corpusloom.functions.words import word_list
from corpusloom.operators import scoring as W
from corpusloom.operators.pairing import zip_by_position
from corpusloom.operators.rows import spread_rows

WITH = f"with recursive {S.EDITS_SQL} "


@query(
    "pair_predictions",
    f"with {S.PAIRS_SQL} select conv_id, turn, len(r) as n_ref, len(h) as n_pred, array_to_string(h, ' ') as prediction from pairs",
)
def pair_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.prediction_pairs(spark, sf_dir).withColumn("utterance_id", F.struct("conv_id", "turn"))
    references = rows.select("utterance_id", "reference")
    predictions = rows.select("utterance_id", "prediction")
    return W.pair_predictions(references, predictions).select(
        "utterance_id.*",
        F.size(word_list(F.col("reference"))).cast("bigint").alias("n_ref"),
        F.size(F.array_remove(F.split("prediction", " "), "")).cast("bigint").alias("n_pred"),
        "prediction",
    )


# Predictions that share no key with the references: documents by language and id, turns by conversation and turn.
_ZIP_SQL = """left_rows as (select conv_id, turn, row_number() over (order by conv_id, turn) as pos from conversations),
  right_rows as (select lang, doc_id, row_number() over (order by lang desc, doc_id) as pos from documents)"""


def zipped(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    references = S.read_table(spark, sf_dir, "conversations").select("conv_id", "turn")
    predictions = S.documents(spark, sf_dir).select("lang", "doc_id")
    return zip_by_position(references, predictions, ["conv_id", "turn"], [F.desc("lang"), "doc_id"], strict=False)


@query("zip_by_position", f"with {_ZIP_SQL} select pos, conv_id, turn, lang, doc_id from left_rows join right_rows using (pos)")
def zip_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns and documents paired by position in two orders of their own."""
    return zipped(spark, sf_dir)[0]


@query(
    "zip_lengths",
    """with n as (select (select count(*) from conversations) as n_left, (select count(*) from documents) as n_right)
    select n_left, n_right, least(n_left, n_right) as n_paired, greatest(n_left - n_right, 0) as left_surplus,
      greatest(n_right - n_left, 0) as right_surplus from n""",
)
def zip_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows of either table were paired and how many are left over."""
    return zipped(spark, sf_dir)[1]


@query(
    "wer_zipped",
    WITH + """, ordered as (select *, row_number() over (order by conv_id, turn) as pos from scored)
    select pos % 10 as part, cast(sum(edits) as bigint) as edits, cast(sum(ref_words) as bigint) as ref_words from ordered group by pos % 10""",
)
def wer_zipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word errors of references and predictions that only their order connects."""
    pairs = S.prediction_pairs(spark, sf_dir)
    references = pairs.select("conv_id", "turn", "reference")
    predictions = pairs.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "prediction")
    zipped_pairs, _ = zip_by_position(references, predictions, ["conv_id", "turn"], ["c", "t"])
    scored = W.score_pairs(zipped_pairs).withColumn("part", F.col("pos") % 10)
    return W.wer_corpus(scored, ["part"]).drop("wer")


@query(
    "word_edits", WITH + "select conv_id, turn, cast(edits as bigint) as edits, ref_words from scored"
)
def word_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.score_pairs(S.prediction_pairs(spark, sf_dir)).select("conv_id", "turn", "edits", "ref_words")


_SUMS = "cast(sum(edits) as bigint) as edits, cast(sum(ref_words) as bigint) as ref_words"


@query("wer_corpus", WITH + f"select {_SUMS}, round(sum(edits) / sum(ref_words), 9) as wer from scored")
def wer_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = W.score_pairs(S.prediction_pairs(spark, sf_dir))
    return W.wer_corpus(scored).withColumn("wer", F.round("wer", 9))


@query(
    "wer_by_group",
    WITH + f"select role, {_SUMS}, round(sum(edits) / sum(ref_words), 9) as wer from scored group by role",
)
def wer_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = W.score_pairs(S.prediction_pairs(spark, sf_dir))
    return W.wer_corpus(scored, ["role"]).withColumn("wer", F.round("wer", 9))


@query("wer_documents")
def wer_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents, thousands of words long, by language. Too slow for the SQL table method."""
    rows = spread_rows(S.documents(spark, sf_dir).select("doc_id", "lang", "text"), "doc_id")
    pairs = rows.select(
        "lang",
        F.col("text").alias("reference"),
        F.array_join(S.predicted_words(F.col("text")), " ").alias("prediction"),
    )
    return W.wer_corpus(W.score_pairs(pairs, native=False), ["lang"]).withColumn("wer", F.round("wer", 9))


@query(
    "format_wer",
    WITH + "select role, printf('%.2f%%', 100 * sum(edits) / sum(ref_words)) as wer from scored group by role",
)
def format_wer(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = W.score_pairs(S.prediction_pairs(spark, sf_dir))
    return W.wer_corpus(scored, ["role"]).select("role", percent(F.col("wer")).alias("wer"))


_NUMBERED_SQL = "numbered as (select *, row_number() over (partition by conv_id order by turn) as pos from pairs)"


def numbered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs with their position within the conversation; its turns count from 0 without gaps."""
    return S.prediction_pairs(spark, sf_dir).withColumn("pos", F.col("turn") + 1)


@query(
    "prediction_report",
    f"""with {S.PAIRS_SQL}, {_NUMBERED_SQL}
    select conv_id, string_agg('**Sample ' || pos || '**\n\nTruth: ' || reference || '\n\nPrediction: '
      || array_to_string(h, ' ') || '\n\n---', '\n' order by pos) as text
    from numbered where pos <= 5 group by conv_id""",
)
def prediction_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.prediction_report(numbered_pairs(spark, sf_dir), ["conv_id"])


@query(
    "console_report",
    f"""with {S.PAIRS_SQL}, {_NUMBERED_SQL}
    select conv_id, string_agg('  Truth:      ' || substring(reference, 1, 80) || '...\n  Prediction: '
      || substring(array_to_string(h, ' '), 1, 80) || '...\n', '\n' order by pos) as text
    from numbered where pos <= 3 group by conv_id""",
)
def console_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return W.console_report(numbered_pairs(spark, sf_dir), ["conv_id"])
