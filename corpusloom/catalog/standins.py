"""Transcripts, predictions and run metrics derived from the given tables.

The tables hold no audio and no transcript markup. Each stand-in covers its whole table; the
row's id decides which kind of markup a row gets. Both engines derive it in their own way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.text import GARBAGE_TAGS, PUNCTUATION_TAGS, split_ws
from corpusloom.functions.words import word_list
from corpusloom.operators.ordinal import ordinal
from corpusloom.operators.rows import pieces
from corpusloom.session import read_table

LANGUAGES = ("de", "en", "es", "fr")
MAX_SECONDS = 20

# Expressions that both engines read alike.
_UTTERANCE = {
    "utterance_id": "doc_id",
    "source": "lang",
    "config": "source",
    "split": "case when doc_id % 10 < 8 then 'train' else 'validation' end",
    "text": """case when doc_id % 12 = 0 then '<SIL>'
       when doc_id % 12 = 1 then '<MUSIC> ab'
       when doc_id % 12 = 2 then concat('<NOISE>  ', replace(text, '. ', ' <PERIOD> '))
       when doc_id % 12 = 3 then '<SIL> a <NOISE>'
       when doc_id % 12 = 4 then ''
       when doc_id % 12 = 5 then '   '
       when doc_id % 12 = 6 then cast(null as string)
       else replace(replace(text, ', ', ' <COMMA> '), '. ', ' <PERIOD>  ') end""",
    "sentence": "case when doc_id % 12 in (4, 6, 7) then text else cast(null as string) end",
    "n_samples": "n_chars * 160",
    "sampling_rate": "16000",
}
_SELECT = [f"{expression} as {name}" for name, expression in _UTTERANCE.items()]

UTTERANCES_SQL = f"utterances as (select {', '.join(_SELECT)} from documents)"


def as_utterances(documents: DataFrame) -> DataFrame:
    return documents.selectExpr(*_SELECT)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_utterances(documents(spark, sf_dir))


# SQL text for the rules on strings.

# Python's whitespace, character by character.
WHITESPACE = (
    r"\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def sql_strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WHITESPACE}]+|[{WHITESPACE}]+$', '', 'g')"


def sql_collapse(x: str) -> str:
    return sql_strip(f"regexp_replace({x}, '[{WHITESPACE}]+', ' ', 'g')")


def sql_split(x: str) -> str:
    return f"list_filter(string_split({sql_collapse(x)}, ' '), lambda w: w <> '')"


def sql_words(x: str) -> str:
    spaced = sql_strip(f"regexp_replace({x}, '[{WHITESPACE}]{{2,}}', ' ', 'g')")
    return f"list_filter(string_split({spaced}, ' '), lambda w: w <> '')"


def sql_rejected(x: str) -> str:
    tests = [
        f"(contains({x}, '{tag}') and length({sql_strip(f'''replace({x}, '{tag}', '')''')}) < 3)"
        for tag in GARBAGE_TAGS
    ]
    return "(" + " or ".join(tests) + ")"


def sql_clean(x: str) -> str:
    marks = x
    for tag, mark in PUNCTUATION_TAGS.items():
        marks = f"replace({marks}, '{tag}', '{mark}')"
    for tag in GARBAGE_TAGS:
        marks = f"replace({marks}, '{tag}', ' ')"
    return f"case when {x} is null or {sql_rejected(x)} then null else nullif({sql_collapse(marks)}, '') end"


def sql_guarded(x: str) -> str:
    return f"case when contains({x}, '<') and contains({x}, '>') then {sql_clean(x)} else {x} end"


def sql_usable(text: str = "text", sentence: str = "sentence") -> str:
    """The transcript a batch is built from."""
    value = f"coalesce(nullif({text}, ''), nullif({sentence}, ''), '')"
    return sql_strip(sql_guarded(value))


SHORT_ENOUGH = f"n_samples / sampling_rate <= {MAX_SECONDS}"


# Word lengths of a text stand for token ids.


def text_ids(text: Column) -> Column:
    return F.transform(split_ws(text), lambda w: F.length(w).cast("bigint"))


def sql_ids(x: str) -> str:
    return f"list_transform({sql_split(x)}, lambda w: cast(length(w) as bigint))"


def ids_text(ids: Column) -> Column:
    return F.array_join(ids.cast("array<string>"), " ")


def sql_ids_text(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda e: cast(e as varchar)), ' ')"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns with ids and a dense position."""
    table = read_table(spark, sf_dir, "conversations")
    places = ordinal(table.select("conv_id", "turn"), ["conv_id", "turn"])
    ids = text_ids(F.col("text")).alias("ids")
    return table.select("conv_id", "turn", ids).join(places, ["conv_id", "turn"]).select("pos", "ids")


TURNS_SQL = (
    "turns as (select row_number() over (order by conv_id, turn) as pos, "
    f"{sql_ids('text')} as ids from conversations)"
)


def batched_turns(spark: SparkSession, sf_dir: str, size: int = 4) -> DataFrame:
    return turns(spark, sf_dir).withColumn("batch_id", F.floor((F.col("pos") - 1) / F.lit(size)))


BATCHED_TURNS_SQL = TURNS_SQL + ", batched as (select *, (pos - 1) // 4 as batch_id from turns)"


# Predictions: words of a conversation turn with some left out, changed and doubled.


def predicted_words(text: Column) -> Column:
    def change(w: Column, i: Column) -> Column:
        return (
            F.when(i % 5 == 4, F.array().cast("array<string>"))
            .when(i % 7 == 3, F.array(F.concat(w, F.lit("x"))))
            .when(i % 11 == 10, F.array(w, w))
            .otherwise(F.array(w))
        )

    return F.flatten(F.transform(word_list(text), change))


def as_pairs(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        "conv_id", "turn", "role",
        F.col("text").alias("reference"),
        F.array_join(predicted_words(F.col("text")), " ").alias("prediction"),
    )


def prediction_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_pairs(read_table(spark, sf_dir, "conversations"))


PAIRS_SQL = f"""spoken as (select conv_id, turn, role, text as reference, {sql_words('text')} as r from conversations),
pairs as (
  select conv_id, turn, role, reference, r,
    flatten(list_transform(r, lambda w, i:
      case when (i - 1) % 5 = 4 then cast([] as varchar[])
           when (i - 1) % 7 = 3 then [w || 'x']
           when (i - 1) % 11 = 10 then [w, w]
           else [w] end)) as h
  from spoken)"""

# Word edits by how far each diagonal gets with a given number of edits. A move costs one edit and
# takes a word of both texts, of the reference, or of the prediction; equal words are passed freely.
EDITS_SQL = f"""{PAIRS_SQL},
numbered_pairs as materialized (
  select conv_id * 1000000 + turn as pid, conv_id, turn, role, r, h, len(r) as n, len(h) as m from pairs),
matches as (
  select a.pid, a.i, a.i - b.j as d
  from (select pid, unnest(r) as w, generate_subscripts(r, 1) as i from numbered_pairs) a
  join (select pid, unnest(h) as w, generate_subscripts(h, 1) as j from numbered_pairs) b on a.pid = b.pid and a.w = b.w),
runs as materialized (
  select pid, d, i, count(*) over (partition by pid, d, island order by i desc) as run
  from (select *, i - row_number() over (partition by pid, d order by i) as island from matches)),
reach(pid, e, d, i, n, m) as (
  select p.pid, 0, 0, coalesce(run, 0), n, m
  from numbered_pairs p left join runs on runs.pid = p.pid and runs.d = 0 and runs.i = 1
  union all
  select x.pid, x.e + 1, x.d, x.i + coalesce(run, 0), n, m
  from (
    select pid, e, n, m, d, max(i) as i
    from (
      select pid, e, n, m, d + step_d as d, i + step_i as i
      from (select *, bool_or(d = n - m and i = n) over (partition by pid) as done from reach),
        (values (0, 0), (0, 1), (1, 1), (-1, 0)) as moves(step_d, step_i)
      where not done)
    where i <= n and i - d between 0 and m
    group by pid, e, n, m, d) x
  left join runs on runs.pid = x.pid and runs.d = x.d and runs.i = x.i + 1
),
scored as (
  select p.conv_id, p.turn, p.role, min(e) as edits, any_value(p.n) as ref_words
  from numbered_pairs p join reach on reach.pid = p.pid and reach.d = p.n - p.m and reach.i = p.n
  group by p.conv_id, p.turn, p.role)"""


# Metric points: a user is a run, its events in order of time are the steps.


def metric_points(spark: SparkSession, sf_dir: str, event_type: str | None = None) -> DataFrame:
    events = read_table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), "ts", "event_id", "event_type", "value"
    )
    points = ordinal(events, ["ts", "event_id"], ["run_id"], out="step")
    if event_type:
        points = points.where(F.col("event_type") == event_type)
    return points.select("run_id", "step", "value")


POINTS_SQL = """points as (
  select user_id as run_id, row_number() over (partition by user_id order by ts, event_id) as step,
    value, event_type
  from events)"""


# Audio: the characters of a text as samples.


def text_samples(text: Column) -> Column:
    return F.transform(
        F.array_remove(F.split(text, ""), ""), lambda c: (F.ascii(c) / F.lit(128.0)).cast("float")
    )


def text_samples_long(text: Column) -> Column:
    """``text_samples`` on Arrow batches, for texts of real length; not for a filter, which would compute it again."""

    @F.arrow_udf("array<float>")
    def convert(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in batches:
            for low, high in pieces(column, 1 << 20):
                rows = column.slice(low, high - low)
                texts = ["" if t is None else t for t in rows.to_pylist()]
                ends = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
                samples = (np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32) / 128.0).astype(np.float32)
                yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(samples), mask=rows.is_null())

    return convert(text)
