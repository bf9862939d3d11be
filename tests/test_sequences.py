"""Arrays, vocabulary, collator and splicing."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from corpusloom.functions import sequences as Q
from corpusloom.operators import lookup
from corpusloom.operators import vocabulary as V
from corpusloom.operators.batching import pad_longest, pad_spliced
from corpusloom.operators.embedding import embedding_gather
from corpusloom.plans.collate import collate, splice_batch, splice_errors
from corpusloom.plans.prepare import batched_rows

IDS = "id bigint, ids array<bigint>"


def rows_of(spark, *lists):
    return spark.createDataFrame([(i, ids) for i, ids in enumerate(lists)], IDS)


def applied(df, expression):
    return [r["out"] for r in sorted(df.select("id", expression.alias("out")).collect())]


def test_masks_and_truncation(spark):
    df = rows_of(spark, [5, 0, 7, 8], [5], [], None)
    assert applied(df, Q.truncate_ids(F.col("ids"), 2)) == [[5, 0], [5], [], None]
    assert applied(df, Q.mask_prompt(F.col("ids"), 2)) == [[-100, -100, 7, 8], [-100], [], None]
    assert applied(df, Q.mask_pad(F.col("ids"), 0)) == [[5, -100, 7, 8], [5], [], None]
    assert applied(df, Q.mask_pad(F.col("ids"))) == [[5, 0, 7, 8], [5], [], None]


def test_splice(spark):
    df = rows_of(spark, [1, 2, 99, 4, 99], [99], [99, 1], [1, 99])
    place = Q.marker_pos(F.col("ids"), 99)
    assert applied(df, place) == [3, 1, 1, 2]
    labels = Q.splice_labels(F.col("ids"), place, F.lit(3))
    assert applied(df, labels) == [
        [1, 2, -100, -100, -100, 4, 99], [-100] * 3, [-100, -100, -100, 1], [1, -100, -100, -100]
    ]
    segment = F.array(*(F.lit(v).cast("bigint") for v in (7, 8)))
    assert applied(df, Q.splice_segment(F.col("ids"), place, segment))[0] == [1, 2, 7, 8, 4, 99]
    none = F.array().cast("array<bigint>")
    assert applied(df, Q.splice_segment(F.col("ids"), place, none)) == [[1, 2, 4, 99], [], [1], [1]]


def test_missing_marker(spark):
    df = rows_of(spark, [4])
    with pytest.raises(PySparkException, match="not found"):
        df.select(Q.marker_pos(F.col("ids"), 99)).collect()
    lenient = Q.marker_pos(F.col("ids"), 99, strict=False)
    assert applied(df, lenient) == [0]
    assert applied(df, Q.splice_segment(F.col("ids"), lenient, F.col("ids"))) == [None]


def test_pad_audio(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0] * 5), (2, [])], "id int, a array<float>")
    got = df.select("id", Q.pad_audio(F.col("a"), 3).alias("p")).orderBy("id").select("p.*").collect()
    assert [(r["array"], r["mask"]) for r in got] == [
        ([1.0, 2.0, 0.0], [1, 1, 0]), ([1.0] * 3, [1, 1, 1]), ([0.0] * 3, [0, 0, 0])
    ]


def test_pad_longest_is_per_batch(spark):
    df = rows_of(spark, [1, 2, 3], [4], [5, 6], []).withColumn("batch_id", F.floor(F.col("id") / 2))
    got = pad_longest(df, "ids", 9).orderBy("id").collect()
    assert [(r["ids"], r["attention_mask"]) for r in got] == [
        ([1, 2, 3], [1, 1, 1]), ([4, 9, 9], [1, 0, 0]), ([5, 6], [1, 1]), ([9, 9], [0, 0])
    ]


TEXTS = ["the cat the dog", "", "dog the unknown", "the the the bird é"]


def texts(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc bigint, text string")
    return df.select("doc", F.array_remove(F.split("text", " "), "").alias("words"))


@pytest.fixture(params=[50_000, 1, 0])
def head_rows(request, monkeypatch):
    """The lookup's broadcast part: all of the vocabulary, the most used token alone, nothing."""
    monkeypatch.setattr(lookup, "HEAD_ROWS", request.param)


def test_vocabulary(spark, head_rows):
    df = texts(spark)
    vocab = V.vocab_build(df.where("doc <> 2"), "words")
    assert [(r["token"], r["id"], r["uses"]) for r in vocab.orderBy("id").collect()] == [
        ("the", 0, 5), ("bird", 1, 1), ("cat", 2, 1), ("dog", 3, 1), ("é", 4, 1)
    ]
    coded = V.encode_ids(df, ["doc"], "words", vocab)
    assert [r["ids"] for r in coded.orderBy("doc").collect()] == [[0, 2, 0, 3], [], [3, 0, None], [0, 0, 0, 1, 4]]
    back = V.decode_ids(coded, ["doc"], "ids", vocab, skip=["the"])
    assert [r["text"] for r in back.orderBy("doc").collect()] == ["cat dog", "", "dog", "bird é"]
    longer, added = V.add_tokens(vocab, ["the", "<|a|>", "cat", "<|b|>", "<|a|>"])
    assert added == 2
    assert {r["token"]: r["id"] for r in longer.where("id > 4").collect()} == {"<|a|>": 5, "<|b|>": 6}
    assert V.add_tokens(longer, ["<|b|>"])[1] == 0
    asked = spark.createDataFrame([("the",), ("nowhere",), (None,)], "token string")
    found = {r["token"]: r["id"] for r in V.token_lookup(asked, longer).collect()}
    assert found == {"the": 0, "nowhere": None, None: None}


def test_hot_unknown_word_is_split_at_run_time(spark):
    """A third of all words is one that the vocabulary lacks, so nothing broadcast has it."""
    settings = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    before = {name: spark.conf.get(name, None) for name in settings}
    token = F.when(F.col("id") % 3 == 0, F.lit("unknown")).otherwise(F.concat(F.lit("t"), F.col("id") % 5000))
    facts = spark.range(0, 400_000, 1, 8).select(F.col("id").alias("row"), token.alias("token"))
    table = spark.range(5000).select(F.concat(F.lit("t"), F.col("id")).alias("token"), "id")
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        out = lookup.lookup_join(facts, table, "token", table.where("id < 10"))
        rows = out.groupBy(F.col("id").isNull().alias("unknown")).agg(F.countDistinct("row").alias("n"))
        assert {r["unknown"]: r["n"] for r in rows.collect()} == {True: 133_334, False: 266_666}
        assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_ids_keep_their_place_and_range(spark):
    most = lookup.NO_ID - 1
    rows = [(1, 2, 7), (1, 0, most), (1, 1, None), (2, None, None), (3, 100_000, 0), (3, 5, 1)]
    df = spark.createDataFrame(rows, "doc bigint, at int, id bigint")
    got = lookup.regroup_ids(df, ["doc"], "at", "id", "ids").orderBy("doc").collect()
    assert [r["ids"] for r in got] == [[most, None, 7], [], [1, 0]]
    with pytest.raises(PySparkException, match="out of range"):
        lookup.regroup_ids(df.withColumn("id", F.col("id") + 1), ["doc"], "at", "id", "ids").collect()


def test_long_tokens_do_not_swell_the_broadcast_part(spark):
    entries = spark.createDataFrame([("a" * 3_000_000, 0), ("b" * 3_000_000, 1), ("c", 2)], "token string, id bigint")
    assert [r["id"] for r in V._head(entries, "token").collect()] == [0, 2]


def test_special_tokens_are_looked_up_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(lookup, "HEAD_ROWS", 1)
    entries = spark.createDataFrame([("the", 0), ("a", 1), ("<|audio_chunk|>", 2), ("[PAD]", 3), ("User:", 4)], "token string, id bigint")
    assert sorted(r["id"] for r in V._head(entries, "token", ["User:"]).collect()) == [0, 2, 3, 4]


@pytest.mark.parametrize("ranked", [True, False])
def test_gather_keeps_order(spark, head_rows, ranked, monkeypatch):
    monkeypatch.setattr("corpusloom.operators.embedding.COUNTED_KEYS", 1)
    table = spark.createDataFrame([(i, [float(i), -float(i)]) for i in range(5)], "id bigint, vector array<float>")
    df = rows_of(spark, [4, 0, 4, 2], []).withColumnRenamed("id", "doc")
    got = embedding_gather(df, ["doc"], "ids", table, 2, ranked=ranked)
    assert [r["embeds"] for r in got.orderBy("doc").collect()] == [
        [[4.0, -4.0], [0.0, 0.0], [4.0, -4.0], [2.0, -2.0]], []
    ]


def utterances(spark):
    rows = [
        (1, "hi <COMMA> you", None, 2), (2, "<SIL>", None, 2), (3, "", "a b c", 2), (4, None, None, 2),
        (5, "ok", None, 9), (6, "   ", None, 2), (7, None, "<MUSIC> x", 1), (8, "fine then", None, 2),
        (9, "edge", None, 4),
    ]
    df = spark.createDataFrame(rows, "pos bigint, text string, sentence string, n int")
    return df.withColumn("audio", F.array_repeat(F.lit(0.5).cast("float"), F.col("n")))


def test_collate(spark):
    template = "say <|audio_chunk|> : "
    valid = batched_rows(utterances(spark), "pos", 4, F.size("audio"), 2, 2.0)
    assert [(r["batch_id"], r["pos"], r["text"]) for r in valid.orderBy("pos").collect()] == [
        (0, 1, "hi , you"), (0, 3, "a b c"), (1, 8, "fine then"), (2, 9, "edge")
    ]
    vocab = spark.createDataFrame(
        [(w, i) for i, w in enumerate("[PAD] say <|audio_chunk|> : hi , you a b c fine then edge".split())],
        "token string, id bigint",
    )
    out = collate(valid, vocab, 0, template, max_tokens=5, audio="audio", audio_samples=3).orderBy("pos").collect()
    assert [(r["pos"], r["input_ids"], r["attention_mask"], r["labels"]) for r in out] == [
        (1, [1, 2, 3, 4, 5], [1] * 5, [-100, -100, -100, 4, 5]),
        (3, [1, 2, 3, 7, 8], [1] * 5, [-100, -100, -100, 7, 8]),
        (8, [1, 2, 3, 10, 11], [1] * 5, [-100, -100, -100, 10, 11]),
        (9, [1, 2, 3, 12], [1] * 4, [-100, -100, -100, 12]),
    ]
    assert out[0]["audio_values"] == [0.5, 0.5, 0.0] and out[0]["audio_attention_mask"] == [1, 1, 0]
    assert out[3]["audio_values"] == [0.5] * 3
    nothing = collate(valid.where("pos < 0"), vocab, 0, template)
    assert nothing.collect() == [] and nothing.columns == ["batch_id", "pos", "input_ids", "attention_mask", "labels"]


@pytest.mark.parametrize("mode", ["reference", "strict"])
def test_splice_batch(spark, mode):
    tokens = spark.createDataFrame(
        [(0, 1, [1, 99, 2], [-100, -100, 2], [1, 1, 1]), (0, 2, [99, 3, 0], [-100, 3, -100], [1, 1, 0]),
         (1, 3, [99], [-100], [1])],
        "batch_id bigint, pos bigint, input_ids array<bigint>, labels array<bigint>, attention_mask array<bigint>",
    )
    segments = spark.createDataFrame(
        [(1, [[9.0, 9.0]]), (2, [[8.0, 8.0], [7.0, 7.0]]), (3, [[6.0, 6.0]])], "pos bigint, segment array<array<float>>"
    )
    table = spark.createDataFrame([(i, [float(i), 0.0]) for i in (0, 1, 2, 3, 99)], "id bigint, vector array<float>")
    out = splice_batch(tokens, segments, table, 99, 2, mask_mode=mode).orderBy("pos").collect()
    assert [r["inputs_embeds"] for r in out] == [
        [[1, 0], [9, 9], [2, 0], [0, 0]], [[8, 8], [7, 7], [3, 0], [0, 0]], [[6, 6]]
    ]
    assert [r["labels"] for r in out] == [[-100, -100, 2, -100], [-100, -100, 3, -100], [-100]]
    padding = 1 if mode == "reference" else 0
    assert [r["attention_mask"] for r in out] == [[1, 1, 1, 0], [1, 1, 1, padding], [1]]


def test_pad_spliced_alone(spark):
    df = spark.createDataFrame(
        [(0, 1, [[1.0, 2.0]], [5]), (0, 2, [[1.0, 1.0], [2.0, 2.0]], [6, 7])],
        "batch_id bigint, pos bigint, inputs_embeds array<array<float>>, labels array<bigint>",
    )
    first = pad_spliced(df).orderBy("pos").first()
    assert (first["inputs_embeds"], first["labels"], first["attention_mask"]) == ([[1, 2], [0, 0]], [5, -100], [1, 0])


def test_wrong_rows_are_told_or_raised(spark):
    kind = "batch_id bigint, pos bigint, input_ids array<bigint>, labels array<bigint>"
    rows = [(0, 1, [1, 99], [1, 99]), (0, 2, [1, 1], [1, 1]), (0, 3, [99], [99]), (0, 4, [99, 5], [99, 5]), (0, 5, [99, 2], [99, 2])]
    tokens = spark.createDataFrame(rows, kind)
    segments = spark.createDataFrame([(p, [[9.0]]) for p in (1, 2, 4, 5)], "pos bigint, segment array<array<float>>")
    table = spark.createDataFrame([(1, [1.0]), (2, None)], "id bigint, vector array<float>")
    wrong = {r["pos"]: r["reason"] for r in splice_errors(tokens, segments, table, 99).collect()}
    assert wrong == {2: "no marker", 3: "no segment", 4: "unknown id", 5: "unknown id"}
    out = splice_batch(tokens, segments, table, 99, 1, strict=False).collect()
    assert [(r["pos"], r["inputs_embeds"], r["labels"]) for r in out] == [(1, [[1.0], [9.0]], [1, -100])]
    for pos, reason in wrong.items():
        with pytest.raises(PySparkException, match="marker id 99 not found|" + reason):
            splice_batch(tokens.where(F.col("pos") == pos), segments, table, 99, 1).collect()


def test_unknown_and_unranked_ids(spark):
    vocab = spark.createDataFrame([("a", 900), ("b", 7)], "token string, id bigint")
    words = spark.createDataFrame([(1, ["a", "x", "b", "a"]), (2, []), (3, None)], "doc bigint, words array<string>")
    coded = V.encode_ids(words, ["doc"], "words", vocab, ranked=False, unk_id=0).orderBy("doc").collect()
    assert [r["ids"] for r in coded] == [[900, 0, 7, 900], [], []]
    ids = spark.createDataFrame([(1, [7, 3, 900])], "doc bigint, ids array<bigint>")
    assert V.decode_ids(ids, ["doc"], "ids", vocab, ranked=False, unk_token="?").first()["text"] == "b ? a"
    asked = spark.createDataFrame([("b",), ("x",), (None,)], "token string")
    found = {r["token"]: r["id"] for r in V.token_lookup(asked, vocab, ranked=False, unk_id=0).collect()}
    assert found == {"b": 7, "x": 0, None: None}


def test_inputs_are_read_once(spark, tmp_path):
    path = str(tmp_path / "texts")
    spark.range(0, 400, 1, 8).selectExpr("id as doc", "array('a', concat('w', id % 50), 'b') as words").write.parquet(path)
    runs = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            runs.add(len(batch))
            yield batch

    words = spark.read.parquet(path).mapInArrow(counted, "doc bigint, words array<string>")
    vocab = V.vocab_build(spark.read.parquet(path), "words")
    runs.value = 0
    assert V.encode_ids(words, ["doc"], "words", vocab).count() == 400
    assert runs.value == 400


def test_collate_with_features(spark):
    rows = [(0, 1, "hi there", [0.5] * 500), (0, 2, "a", [0.1] * 3000), (1, 3, "x", [])]
    df = spark.createDataFrame(rows, "batch_id bigint, pos bigint, text string, sound array<float>")
    vocab = V.vocab_build(spark.createDataFrame([(["hi", "a"],)], "words array<string>"), "words")
    out = collate(df, vocab, 0, audio="sound", audio_samples=1600, features=True, unk_id=1).orderBy("pos").collect()
    assert set(out[0].asDict()) == {"batch_id", "pos", "input_ids", "attention_mask", "labels", "input_features", "audio_attention_mask"}
    assert all(len(r["input_features"]) == 80 and len(r["input_features"][0]) == 10 for r in out)
    assert [sum(r["audio_attention_mask"]) for r in out] == [4, 10, 0] and {len(r["audio_attention_mask"]) for r in out} == {10}
    assert all(x is not None for r in out for x in r["input_ids"])
