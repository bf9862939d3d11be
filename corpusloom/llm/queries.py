"""One query per operator over its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions.binding import let
from corpusloom.llm.common import WORD, crc_remainder, documents, table, word_count, write_through
from corpusloom.llm.decontaminate import benchmark_leaks
from corpusloom.llm.language import fit_language_model, identify_language
from corpusloom.llm.licences import licence_scan
from corpusloom.llm.licences import oracle_sql as licence_sql
from corpusloom.llm.mixing import mix_sources
from corpusloom.llm.neardup import near_duplicates
from corpusloom.llm.quality_model import fit_quality_model, quality_score
from corpusloom.llm.quality_rules import GRIDS, STATISTICS, add_statistics, base_failed, learn_rules, verdict
from corpusloom.llm.runs import periodic_runs
from corpusloom.llm.secrets import joined_spans, secret_spans
from corpusloom.llm.sharding import rendezvous_shard, shard_records
from corpusloom.llm.tokens import token_count
from corpusloom.llm.trie import borrow_heads, prefix_trie, turn_rows
from corpusloom.llm.urls import judge_url, url_host, url_path

BASE_KINDS = ("assign", "access", "hex")
MOST_TOKENS = 512
LEAST_QUALITY = 0.3
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often the mix of all documents takes each, by the cube method."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    mix = mix_sources(docs, word_count(F.col("text")))
    return mix.select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the plain patterns, spans of all."""
    found = documents(spark, sf_dir).select("doc_id", secret_spans(F.col("text")).alias("found"))
    spans = F.col("found")

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(kind).alias(f"n_{kind}") for kind in BASE_KINDS),
        F.sha2(joined_spans(spans, BASE_KINDS).cast("binary"), 256).alias("base_sha256"),
        joined_spans(spans).alias("spans"),
    )


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    import public_tokenizers

    docs = documents(spark, sf_dir)
    tokens = token_count(spark, F.col("text"), public_tokenizers.path("byte_bpe_50k.json"))
    counted = docs.select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), tokens.alias("n_tokens")
    )
    return counted.withColumn("over_limit", F.col("n_tokens") > MOST_TOKENS)


def op4_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item, its distance and its place."""
    leaks = benchmark_leaks(spark, F.col("text"), table(spark, sf_dir, "benchmark"))
    found = documents(spark, sf_dir).select("doc_id", F.explode(leaks).alias("leak"))
    return found.select("doc_id", "leak.*")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every document and the verdict of the base rules and the learned ones."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    columns = ["doc_id", *dict.fromkeys([*STATISTICS, *GRIDS])]
    measured = write_through(add_statistics(docs).select(*columns), "statistics")
    marks = table(spark, sf_dir, "labels").select("doc_id", "quality")
    rules = learn_rules(measured.where(~base_failed()).join(marks, "doc_id"), "quality")
    judged = measured.withColumn("base_failed", base_failed())
    return judged.select("doc_id", *STATISTICS, "base_failed", (~F.col("base_failed") & verdict(rules)).alias("kept"))


def op6_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from three quarters of them."""
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    held_out = crc_remainder(F.col("doc_id"), 4) == 2
    model = fit_language_model(docs.where(~held_out))
    found = docs.select(
        "doc_id", held_out.alias("held_out"), identify_language(spark, F.col("text"), model).alias("found")
    )
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), "found.score")


def op7_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences of every document and the known licence sentences in it."""
    found = documents(spark, sf_dir).select("doc_id", licence_scan(F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        F.size("found.sentences").cast("long").alias("n_sentences"),
        F.array_join("found.sentences", ",").alias("sentences"),
        F.array_join("found.licences", ",").alias("licences"),
    )


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate component of every document: three-word shingles, similarity of 85 % or more."""
    return near_duplicates(documents(spark, sf_dir).select("doc_id", "text"), shingle_words=3, percent=85)


def op9_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document, learned from four fifths of the labels."""
    docs = documents(spark, sf_dir).select("doc_id", "text")
    held_out = crc_remainder(F.col("doc_id"), 5) == 0
    marks = table(spark, sf_dir, "labels").where(~held_out)
    model = fit_quality_model(docs.where(~held_out), marks, "quality")
    scored = docs.select(
        "doc_id", held_out.alias("held_out"), quality_score(spark, F.col("text"), model).alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= LEAST_QUALITY, 1).otherwise(0))


def op10_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's url."""
    parts = table(spark, sf_dir, "pages").select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    judged = parts.withColumn("judged", judge_url(spark, F.col("host"), F.col("path"), URL_RULES))
    return judged.select("page_id", "host", "path", "judged.rule", "judged.verdict")


DONORS, BORROWED = 20, 4


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each rebuilt with up to three turns of another one at its start."""
    turns = write_through(turn_rows(table(spark, sf_dir, "conversations")), "numbered")
    n = crc_remainder(F.col("conv"), BORROWED)
    return prefix_trie(*borrow_heads(turns, F.col("conv") - F.col("conv") % DONORS, n, BORROWED - 1))


def _with_planted_run(doc_id: Column, text: Column) -> Column:
    """The text, or for every tenth checksum its words with a stretch that goes round at the end; without an id the text."""
    h = F.crc32(doc_id.cast("string").cast("binary"))

    def planted(words: Column) -> Column:
        n, g = F.size(words), F.floor(h / 10)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        cycle = F.slice(words, a + 1, p)
        rounds = F.ceil((n - a) / p).cast("int")
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a), F.flatten(F.array_repeat(cycle, rounds))), F.lit(1), n), " ")

    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    changed = F.when((h % 10 == 0) & F.regexp_like(text, F.lit(WORD)), let(words, planted))
    return F.coalesce(changed, text)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of words of every document, the longest of them, and digests of all and of the text without repeats."""
    docs = documents(spark, sf_dir)
    found = docs.select("doc_id", periodic_runs(_with_planted_run(F.col("doc_id"), F.col("text"))).alias("found"))
    best = F.array_max(F.transform("found.runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("found.runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    found = found.select(
        "doc_id",
        F.size("found.runs").cast("long").alias("n_runs"),
        best.alias("best"),
        F.sha2(F.concat(F.array_join(lines, "\n"), F.when(F.size("found.runs") > 0, "\n").otherwise("")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("found.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
    return found.select(
        "doc_id",
        "n_runs",
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        "runs_sha256",
        "collapsed_sha256",
    )


SHARDS = 8


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard and slot of every document by its id, and its shard with one shard more."""
    text = F.coalesce("text", F.lit(""))
    rows = documents(spark, sf_dir).select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("key").alias("law"),
        rendezvous_shard(F.col("doc_id"), dict.fromkeys(range(SHARDS + 1), 1)).alias("grown_shard"),
    )
    return shard_records(rows, "doc_id", dict.fromkeys(range(SHARDS), 1), order=["size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"
    )


OP10_SQL = r"""
with parts as (
  select page_id,
    translate(case when strpos(url, '://') > 0 then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*') else '' end,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    case when strpos(url, '://') > 0
      then regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) else '' end as path
  from pages
),
rules(rule_host, rule_path, verdict) as (
  values ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
    ('net', '/es/', 'block'), ('net', '/fr/', 'block')
),
fitting as (
  select p.page_id, p.host, p.path, r.rule_host || r.rule_path as rule, r.verdict,
    row_number() over (partition by p.page_id order by length(r.rule_host || r.rule_path) desc nulls last) as place
  from (select coalesce(page_id, null) as page_id, coalesce(host, '') as host, coalesce(path, '') as path from parts) p
  left join rules r on (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)
)
select page_id, host, path, rule, coalesce(verdict, 'allow') as verdict from fitting where place = 1
"""

# The checksum of a list of bytes ``b``: a table from its rule, then one step for each byte.
CRC_TABLE = """
crc_table as (
  select list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda p, q: xor(p >> 1, 3988292384 * (p & 1))) order by i) as steps
  from (select range::bigint as i from range(256))
)
"""


def _crc(digits: str) -> str:
    """SQL for the unsigned checksum of a short ASCII string; ``steps`` is in scope."""
    codes = f"list_transform(string_split({digits}, ''), lambda x: ascii(x)::bigint)"
    step = "lambda p, q: xor(p >> 8, steps[(xor(p, q) & 255) + 1])"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), {step}), 4294967295)"


OP11_SQL = rf"""
with {CRC_TABLE},
turns as (
  select conv_id as conv, coalesce(role, '') as role, coalesce(text, '') as said,
    row_number() over (partition by conv_id order by turn nulls first) as pos
  from conversations where conv_id is not null
),
convs as (
  select conv, conv - conv % {DONORS} as donor, {_crc("conv::varchar")} % {BORROWED} as h
  from (select distinct conv from turns), crc_table
),
lengths as (select conv, max(pos) as n from turns group by conv),
lent as (
  select c.conv, c.h, c.donor, least(c.h, coalesce(l.n, 0)) as n from convs c left join lengths l on l.conv = c.donor
),
rebuilt as (
  select l.conv, t.pos, t.role, t.said from lent l join turns t on t.conv = l.donor and t.pos <= l.h
  union all
  select l.conv, t.pos - l.h + l.n, t.role, t.said from lent l join turns t on t.conv = l.conv and t.pos > l.h
),
named as (
  select conv, pos as depth, said,
    md5(string_agg(md5(length(role) || ':' || role || said), '' order by pos) over (partition by conv order by pos)) as name
  from rebuilt
  union all
  select conv, 0, '', '' from convs
),
path as (
  select *, lag(name) over (partition by conv order by depth) as up, max(depth) over (partition by conv) as last from named
),
nodes as (
  select name, depth, any_value(up) as up, min(conv) as conv, count(*) as n,
    coalesce(string_agg(conv::varchar, ',' order by conv) filter (depth = last), '') as ends,
    (count(*) - 1) * any_value(len(regexp_extract_all(said, '[^ 	-
]+'))) as saved
  from path group by name, depth
),
families as (
  select a.*, p.conv as parent, (select count(*) from nodes b where b.up = a.name and b.depth = a.depth + 1) as children
  from nodes a left join nodes p on p.name = a.up and p.depth = a.depth - 1
),
totals as (
  select p.name, sum((f.children = 0)::int)::bigint as leaves, sum(f.saved)::bigint as saved
  from families f join path p on p.conv = f.conv and p.depth <= f.depth group by p.name
)
select f.conv as conv_id, f.depth::bigint as depth, f.parent as parent_conv_id, f.n as n_convs, f.children as n_children,
  t.leaves as n_leaves, t.saved as saved_tokens, sha256(f.ends) as ends_sha256
from families f join totals t on t.name = f.name
"""

_BIDS = ", ".join(f"md5('{s}:' || coalesce(doc_id::varchar, ''))[1:13]" for s in range(SHARDS + 1))
OP13_SQL = rf"""
with {CRC_TABLE},
bytes as (
  select doc_id, [{_BIDS}] as bids, coalesce(text, '') as text from documents
),
summed as (
  select doc_id, bids, octet_length(encode(text)) + 1 as size,
    xor(list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)),
      lambda p, q: xor(p >> 8, steps[(xor(p, q) & 255) + 1])), 4294967295) as text_crc32
  from bytes, crc_table
),
placed as (
  select *, list_position(bids[1:{SHARDS}], list_max(bids[1:{SHARDS}])) - 1 as shard, list_position(bids, list_max(bids)) - 1 as grown
  from summed
)
select doc_id, size::bigint as size, text_crc32::bigint as text_crc32, 'key' as law, shard::integer as shard,
  row_number() over (partition by shard order by doc_id nulls first, size, text_crc32) - 1 as slot, grown::integer as grown_shard
from placed
"""

QUERIES = {
    f.__name__: f
    for f in (
        op1_mix_sources, op2_secrets, op3_token_counts, op4_benchmark_leaks, op5_quality_rules, op6_languages, op7_licences,
        op8_near_duplicates, op9_quality_scores, op10_url_verdicts, op11_prefix_trie, op12_periodic_runs, op13_shards,
    )
}
SQL = {"op7_licences": licence_sql(), "op10_url_verdicts": OP10_SQL, "op11_prefix_trie": OP11_SQL, "op13_shards": OP13_SQL}
