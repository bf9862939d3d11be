"""Queries over token id sequences. Word lengths of a conversation turn stand for its ids."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.functions import sequences as Q
from corpusloom.operators.batching import pad_longest as pad_batch
from corpusloom.operators.batching import pad_spliced as pad_batch_spliced

WITH = f"with {S.BATCHED_TURNS_SQL} "

KEPT = 50
PROMPT = 9
PAD = 3
MARKER = 7


def masked(expression: str) -> str:
    """SQL: the first ids of a list become the ignore label."""
    return f"list_transform({expression}, lambda x, i: case when i <= {PROMPT} then -100 else x end)"


@query("truncate_ids", WITH + f"select pos, {S.sql_ids_text(f'ids[1:{KEPT}]')} as ids from batched")
def truncate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.turns(spark, sf_dir).select("pos", S.ids_text(Q.truncate_ids(F.col("ids"), KEPT)).alias("ids"))


@query("mask_prompt", WITH + f"select pos, {S.sql_ids_text(masked('ids'))} as labels from batched")
def mask_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.turns(spark, sf_dir).select("pos", S.ids_text(Q.mask_prompt(F.col("ids"), PROMPT)).alias("labels"))


@query(
    "mask_pad",
    WITH + f"""select pos,
      {S.sql_ids_text(f'list_transform(ids, lambda x: case when x = {PAD} then -100 else x end)')} as labels
    from batched""",
)
def mask_pad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.turns(spark, sf_dir).select("pos", S.ids_text(Q.mask_pad(F.col("ids"), PAD)).alias("labels"))


@query(
    "pad_longest",
    f"""with {S.BATCHED_TURNS_SQL}, long as (select *, max(len(ids)) over (partition by batch_id) as longest from batched)
    select pos, batch_id,
      {S.sql_ids_text(f'list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then ids[i] else {PAD} end)')} as ids,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then 1 else 0 end)')} as attention_mask
    from long""",
)
def pad_longest(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = pad_batch(S.batched_turns(spark, sf_dir), "ids", PAD)
    return padded.select(
        "pos", "batch_id", S.ids_text(F.col("ids")).alias("ids"), S.ids_text(F.col("attention_mask")).alias("attention_mask")
    )


def marked_turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = S.batched_turns(spark, sf_dir)
    return rows.withColumn("place", Q.marker_pos(F.col("ids"), MARKER, strict=False))


MARKED_SQL = f"{S.BATCHED_TURNS_SQL}, marked as (select *, coalesce(list_position(ids, {MARKER}), 0) as place from batched)"

# The segment of a row: as many ids as the row's position says, modulo five, all below zero.
SEGMENT_SQL = "list_transform(range(0, pos % 5 + 1), lambda i: -1 - i)"


@query("marker_pos", f"with {MARKED_SQL} select pos, cast(place as bigint) as place from marked")
def marker_pos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked_turns(spark, sf_dir).select("pos", "place")


@query(
    "splice_segment",
    f"""with {MARKED_SQL} select pos,
      {S.sql_ids_text(f'list_concat(list_concat(ids[1:place - 1], {SEGMENT_SQL}), ids[place + 1:])')} as ids
    from marked where place > 0""",
)
def splice_segment(spark: SparkSession, sf_dir: str) -> DataFrame:
    segment = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("pos") % 5), lambda i: -1 - i)
    spliced = Q.splice_segment(F.col("ids"), F.col("place"), segment)
    rows = marked_turns(spark, sf_dir).where(F.col("place") > 0)
    return rows.select("pos", S.ids_text(spliced).alias("ids"))


@query(
    "splice_labels",
    f"""with {MARKED_SQL} select pos,
      {S.sql_ids_text('list_concat(list_concat(ids[1:place - 1], list_transform(range(0, pos % 5 + 1), lambda i: -100)), ids[place + 1:])')} as labels
    from marked where place > 0""",
)
def splice_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    spliced = Q.splice_labels(F.col("ids"), F.col("place"), F.col("pos") % 5 + 1)
    rows = marked_turns(spark, sf_dir).where(F.col("place") > 0)
    return rows.select("pos", S.ids_text(spliced).alias("labels"))


@query(
    "pad_spliced",
    f"""with {S.BATCHED_TURNS_SQL}, long as (select *, max(len(ids)) over (partition by batch_id) as longest from batched)
    select pos, batch_id, longest as n,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then ids[i] else -100 end)')} as labels,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then 1 else 0 end)')} as attention_mask,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then 2 * ids[i] else 0 end)')} as embeds
    from long""",
)
def pad_spliced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each id stands for the vector ``[id, 2 * id]``."""
    rows = S.batched_turns(spark, sf_dir).select(
        "pos", "batch_id", F.col("ids").alias("labels"),
        F.transform("ids", lambda x: F.array(x.cast("float"), (2 * x).cast("float"))).alias("inputs_embeds"),
    )
    second = F.transform("inputs_embeds", lambda v: F.get(v, 1).cast("bigint"))
    return pad_batch_spliced(rows, dim=2).select(
        "pos", "batch_id", F.size("inputs_embeds").cast("bigint").alias("n"),
        S.ids_text(F.col("labels")).alias("labels"),
        S.ids_text(F.col("attention_mask")).alias("attention_mask"),
        S.ids_text(second).alias("embeds"),
    )
