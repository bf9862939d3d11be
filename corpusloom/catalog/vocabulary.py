"""Queries over the word-level vocabulary and the collator."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.catalog import standins as S
from corpusloom.catalog.registry import query
from corpusloom.functions.text import INSTRUCTION_TEMPLATE, split_ws
from corpusloom.operators import subwords as B
from corpusloom.operators import vocabulary as V
from corpusloom.operators.ordinal import attach_ordinal
from corpusloom.plans.collate import collate as collate_rows
from corpusloom.plans.prepare import batched_rows, usable_text
from corpusloom.session import write_through

VOCAB_SQL = f"""counted as (
    select token, count(*) as uses from (select unnest({S.sql_split('text')}) as token from documents) group by token),
  vocab as (select token, row_number() over (order by uses desc, token) - 1 as id, uses from counted)"""


def document_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = S.documents(spark, sf_dir).select(split_ws(F.col("text")).alias("words"))
    return V.vocab_build(words, "words")


def text_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``document_vocab`` for lookups within rows, which take texts as well; written, as they read it several times."""
    return write_through(V.vocab_build(S.documents(spark, sf_dir), "text"), "vocab")


@query("vocab_build", f"with {VOCAB_SQL} select token, id, uses from vocab")
def vocab_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_vocab(spark, sf_dir)


_ADDED = "[" + ", ".join(f"'{t}'" for t in V.AUDIO_TOKENS) + "]"
EXTENDED_SQL = f"""{VOCAB_SQL}, wanted as (select unnest({_ADDED}) as token, unnest(range(1, 6)) as spot),
  missing as (select token, row_number() over (order by spot) as nth from wanted where token not in (select token from vocab)),
  extended as (select token, id from vocab
    union all select token, (select max(id) from vocab) + nth from missing)"""


@query("add_tokens", f"with {EXTENDED_SQL} select token, id, (select count(*) from missing) as n_added from extended")
def add_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    extended, added = V.add_tokens(document_vocab(spark, sf_dir))
    return extended.select("token", "id", F.lit(added).cast("bigint").alias("n_added"))


@query(
    "token_lookup",
    f"""with {EXTENDED_SQL}, asked as (
      select conv_id, turn, unnest(ws) as token, generate_subscripts(ws, 1) as spot
      from (select conv_id, turn, list_concat({S.sql_split('text')}, ['<|audio_start|>']) as ws from conversations))
    select conv_id, turn, cast(spot - 1 as int) as at, asked.token, coalesce(id, -1) as id from asked left join extended using (token)""",
)
def token_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of each turn, and a special token after them, looked up in the vocabulary of the documents."""
    extended, _ = V.add_tokens(document_vocab(spark, sf_dir))
    words = F.concat(split_ws(F.col("text")), F.array(F.lit("<|audio_start|>")))
    turns = S.read_table(spark, sf_dir, "conversations").where(F.col("text").isNotNull())
    asked = turns.select("conv_id", "turn", F.posexplode(words).alias("at", "token"))
    return V.token_lookup(asked, extended, unk_id=-1).select("conv_id", "turn", "at", "token", "id")


@query(
    "encode_ids",
    f"""with {VOCAB_SQL}, words as (select doc_id, {S.sql_split('text')} as ws from documents),
    placed as (select doc_id, unnest(ws) as token, generate_subscripts(ws, 1) as spot from words),
    coded as (select doc_id, string_agg(cast(id as varchar), ' ' order by spot) as ids from placed join vocab using (token) group by doc_id)
    select doc_id, coalesce(ids, '') as ids from documents left join coded using (doc_id)""",
)
def encode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = V.encode_ids(S.documents(spark, sf_dir), ["doc_id"], "text", text_vocab(spark, sf_dir))
    return coded.select("doc_id", S.ids_text(F.col("ids")).alias("ids"))


@query(
    "decode_ids",
    f"""select doc_id, array_to_string(list_filter({S.sql_split('text')}, lambda w: w <> 'the'), ' ') as text from documents""",
)
def decode_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode again; the word that counts as special is left out."""
    vocab = text_vocab(spark, sf_dir)
    coded = V.encode_ids(S.documents(spark, sf_dir), ["doc_id"], "text", vocab)
    return V.decode_ids(coded, ["doc_id"], "ids", vocab, skip=["the"])


# Subwords.

MERGES = 8


def document_word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.word_counts(S.documents(spark, sf_dir).select(split_ws(F.col("text")).alias("words")), "words")


_CHARACTERS_SQL = f"""{VOCAB_SQL}, cut as (select token, uses,
    list_prepend('▁' || token[1:1], list_filter(string_split(token[2:], ''), lambda c: c <> '')) as s from counted),
  pairs as (select s[i] as "left", s[i + 1] as "right", uses from (select s, uses, unnest(range(1, len(s))) as i from cut))"""


@query(
    "subword_pairs",
    f'''with {_CHARACTERS_SQL} select "left", "right", cast(sum(uses) as bigint) as uses from pairs group by 1, 2''',
)
def subword_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often two characters follow each other within a word."""
    return B.pair_counts(document_word_counts(spark, sf_dir))


@query("subword_merges")
def subword_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first merges of a vocabulary trained on all documents, in their order."""
    merges = B.train_merges(document_word_counts(spark, sf_dir), MERGES)
    rows = [(rank, *merge) for rank, merge in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string, uses bigint")


@query("subword_decode", f"select doc_id, array_to_string({S.sql_split('text')}, ' ') as text from documents")
def subword_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts cut into subwords and joined again."""
    merges = B.train_merges(document_word_counts(spark, sf_dir), MERGES // 2)
    rows = S.documents(spark, sf_dir).select("doc_id", split_ws(F.col("text")).alias("words"))
    tokens = rows.select("doc_id", B.subword_tokens(F.col("words"), merges).alias("tokens"))
    return tokens.select("doc_id", B.subword_text(F.col("tokens")).alias("text"))


# The collator. Word lengths stand for samples, sixteen of them for a second.

RATE = 16
TOKENS = 400
SAMPLES = 320

_TEMPLATE = "'" + INSTRUCTION_TEMPLATE + "'"


def collator_input(table: DataFrame) -> DataFrame:
    raw = F.coalesce("text", "sentence", F.lit(""))
    samples = F.transform(split_ws(raw), lambda w: (F.length(w) / F.lit(8.0)).cast("float"))
    placed = attach_ordinal(table, ["utterance_id"], ["utterance_id"])
    return placed.withColumn("audio", F.struct(samples.alias("array"), F.lit(RATE).alias("sampling_rate")))


COLLATE_SQL = f"""{S.UTTERANCES_SQL},
  placed as (select row_number() over (order by utterance_id) as pos, {S.sql_usable()} as usable,
    list_transform({S.sql_split("coalesce(text, sentence, '')")}, lambda w: length(w) / 8) as samples from utterances),
  kept as (select (pos - 1) // 4 as batch_id, pos, samples, {S.sql_split(f'({_TEMPLATE} || usable)')} as words
    from placed where usable <> '' and len(samples) / {RATE} <= {S.MAX_SECONDS}),
  base as (select token, count(*) as uses from (select unnest({S.sql_split('usable')}) as token from placed) group by token),
  ranked as (select token, row_number() over (order by uses desc, token) - 1 as id from base),
  specials as (select unnest(list_concat({S.sql_split(_TEMPLATE)}, ['[PAD]'])) as token,
    unnest(range(1, len({S.sql_split(_TEMPLATE)}) + 2)) as spot),
  missing as (select token, row_number() over (order by spot) as nth from specials where token not in (select token from ranked)),
  vocab as (select token, id from ranked union all select token, (select max(id) from ranked) + nth from missing),
  tokens as (select batch_id, pos, unnest(words) as token, generate_subscripts(words, 1) as spot from kept),
  coded as (select batch_id, pos, list(id order by spot)[1:{TOKENS}] as ids from tokens join vocab using (token) group by batch_id, pos),
  padded as (select batch_id, pos, ids, max(len(ids)) over (partition by batch_id) as longest,
    (select id from vocab where token = '[PAD]') as pad, len({S.sql_split(_TEMPLATE)}) as prompt from coded),
  filled as (select *, list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then ids[i] else pad end) as input_ids from padded)"""


def collator_vocab(rows: DataFrame) -> tuple[DataFrame, int]:
    """A vocabulary of the usable texts, the template and the padding token."""
    base = V.vocab_build(rows.select(split_ws(F.col("text")).alias("words")), "words")
    vocab, _ = V.add_tokens(base, [*INSTRUCTION_TEMPLATE.split(), V.PAD_TOKEN])
    return vocab, vocab.where(F.col("token") == V.PAD_TOKEN).first()["id"]


@query(
    "collate",
    f"""with {COLLATE_SQL}
    select f.batch_id, f.pos, {S.sql_ids_text('input_ids')} as input_ids,
      {S.sql_ids_text('list_transform(range(1, longest + 1), lambda i: case when i <= len(ids) then 1 else 0 end)')} as attention_mask,
      {S.sql_ids_text('list_transform(input_ids, lambda x, i: case when i <= prompt or x = pad then -100 else x end)')} as labels,
      {SAMPLES} as n_samples,
      round(coalesce(list_sum(list_transform(samples[1:{SAMPLES}], lambda x, i: x * i)), 0), 3) as sample_sum,
      cast(least(len(samples), {SAMPLES}) as bigint) as n_set
    from filled f join kept using (pos)""",
)
def collate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = S.utterances(spark, sf_dir).select("utterance_id", "text", "sentence")
    vocab, pad_id = collator_vocab(table.select(usable_text(table).alias("text")))
    valid = batched_rows(collator_input(table), "pos", 4, F.size("audio.array"), RATE, S.MAX_SECONDS)
    batch = collate_rows(
        valid.withColumn("samples", F.col("audio.array")), vocab, pad_id,
        max_tokens=TOKENS, audio="samples", audio_samples=SAMPLES,
    )
    weighted = F.transform("audio_values", lambda x, i: x.cast("double") * (i + 1))
    total = F.aggregate(weighted, F.lit(0.0), lambda acc, x: acc + x)
    return batch.select(
        "batch_id", "pos",
        S.ids_text(F.col("input_ids")).alias("input_ids"),
        S.ids_text(F.col("attention_mask")).alias("attention_mask"),
        S.ids_text(F.col("labels")).alias("labels"),
        F.size("audio_values").alias("n_samples"),
        F.round(total, 3).alias("sample_sum"),
        F.aggregate("audio_attention_mask", F.lit(0).cast("bigint"), lambda acc, x: acc + x).alias("n_set"),
    )
