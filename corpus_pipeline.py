"""The corpus pipeline: documents go through the stages in order, each over all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the shared folder and read
again as the next one's documents. All but the last return the columns of documents. Null columns,
repeated rows and empty tables pass through every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import table, word_count, write_through
from corpusloom.llm.decontaminate import benchmark_leaks
from corpusloom.llm.language import UNKNOWN, fit_language_model, identify_language
from corpusloom.llm.mixing import mix_sources
from corpusloom.llm.neardup import MOST_BROADCAST_IDS, near_duplicates
from corpusloom.llm.secrets import redact_secrets


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in which no language can be recognised: those that are null or have no letter.

    The languages are learned from the documents that name theirs. If none does, nothing can be
    learned, and only documents without a letter are dropped.
    """
    model = fit_language_model(docs)
    if not model.names:
        return docs.where(F.regexp_like(F.coalesce("text", F.lit("")), F.lit(r"\p{L}")))
    found = identify_language(spark, F.col("text"), model)
    return docs.where(found["lang"] != UNKNOWN)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates, that of the smallest id; five-word shingles, 0.8 or more.

    Rows of the same id are one document, of which one row stays. Rows without an id cannot be told
    apart by one and stay.
    """
    found = write_through(near_duplicates(docs), "near-duplicates")
    dropped = found.where(~F.col("kept") & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    # Without a shuffle of texts while the ids are few.
    dropped = F.broadcast(dropped) if dropped.count() <= MOST_BROADCAST_IDS else dropped
    stays = docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    many = repeated.count()
    if not many:
        return stays
    repeated = F.broadcast(repeated) if many <= MOST_BROADCAST_IDS else repeated
    one = stays.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*docs.columns)).alias("row"))
    return stays.join(repeated, "doc_id", "left_anti").unionByName(one.select("row.*")).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item within its edit budget."""
    leaks = benchmark_leaks(spark, F.col("text"), table(spark, sf_dir, "benchmark"))
    return docs.where(F.size(leaks) == 0)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace each secret by a mark, and count the characters of changed documents again. No document is dropped."""
    clean = docs.withColumn("_clean", redact_secrets(F.col("text")))
    changed = ~F.col("_clean").eqNullSafe(F.col("text"))
    count = F.when(changed, F.length("_clean").cast("long")).otherwise(F.col("n_chars"))
    return clean.withColumns({"n_chars": count, "text": F.col("_clean")}).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document that it takes; the texts stay where the stage before wrote them."""
    return mix_sources(docs, word_count(F.col("text"))).where("copies > 0")


STAGES = [
    ("language", language),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("mixture", mixture),
]

# Learned models, sampling and edit distances are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of the folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = write_through(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
