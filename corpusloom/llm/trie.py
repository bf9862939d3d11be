"""The trie of all prefixes of turn sequences, by van Emde Boas recursion.

Sequences of up to 2^k turns are cut at half depth. Equal cut prefixes get one name, the smallest
conversation that has them; the distinct upper halves make an upper trie, the distinct lower halves
a forest below each name. Both are built by the same recursion, all tries and forests of one height
in one step, so k steps lead to single turns, which are the nodes. Every step works on distinct
halves with the number of conversations that have them: copies of a conversation, however many, are one
row after the first aggregation, which is combined before its shuffle.

Halves are compared by digests, made from the turns upwards: the digest of 2^j turns is that of its two
halves. Texts stay where they are. A conversation is never gathered: its turns are rows, and a
conversation that holds most of them is spread over many tasks.

Totals of subtrees then go upwards in k steps. In each, the totals of the lower trees below a cut
prefix are summed and grafted on that node and its ancestors in the upper trie, which then is part of a
trie of twice the height.

What comes last is a list of conversations per node, of which a digest is asked for. Numbers are sorted in ranges, joined
to pieces of bounded size in parallel, and the pieces of a node stream through its digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import word_count, write_through
from corpusloom.operators.ordinal import ordinal

# Numbers that are joined to one piece of text at most.
PIECE_NUMBERS = 4096


def _digest(*parts: Column) -> Column:
    """16 bytes of SHA-256 over binary parts that no other parts of this number have."""
    return F.unhex(F.substring(F.sha2(F.concat(*parts), 256), 1, 32))


def turn_rows(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv, pos, digest, tokens)``: the turns of each conversation, numbered from 1.

    Turns are ordered by ``turn``, null first; equal ones by their digest. A null role or text is an empty
    one. Rows without a conversation are left out. Repeated rows are turns of their own.
    """
    said, by = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (text, role))
    # The length keeps role and text apart.
    digest = _digest(F.lit(b"turn"), F.octet_length(by).cast("string").cast("binary"), F.lit(b":"), by.cast("binary"), said.cast("binary"))
    turns = rows.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("_turn"),
        digest.alias("digest"),
        word_count(said).alias("tokens"),
        F.monotonically_increasing_id().alias("_tie"),
    )
    return ordinal(write_through(turns, "turns"), ["_turn", "digest", "_tie"], ["conv"]).select("conv", "pos", "digest", "tokens")


def borrow_heads(turns: DataFrame, donor: Column, n: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Turns and ``(conv)`` of conversations that start with the first ``n`` turns of a donor in place of their own.

    ``donor`` and ``n`` are expressions over ``conv``; ``n`` is at most ``most``. A donor that has fewer turns gives all of
    them, an absent one none. A conversation without turns stays in the second table.
    """
    convs = turns.groupBy("conv").agg(F.max("pos").alias("_own")).select("conv", donor.alias("_donor"), n.cast("long").alias("_n"))
    heads = write_through(turns.where(F.col("pos") <= most), "heads")
    held = heads.groupBy(F.col("conv").alias("_donor")).agg(F.max("pos").alias("_held"))
    convs = convs.join(held, "_donor", "left").withColumn("_lent", F.least("_n", F.coalesce("_held", F.lit(0))))
    convs = write_through(convs.select("conv", "_donor", "_n", "_lent"), "borrowers")
    lent = convs.join(heads.withColumnRenamed("conv", "_donor"), "_donor").where(F.col("pos") <= F.col("_n"))
    own = turns.join(convs, "conv").where(F.col("pos") > F.col("_n"))
    own = own.withColumn("pos", F.col("pos") - F.col("_n") + F.col("_lent"))
    columns = ["conv", "pos", "digest", "tokens"]
    return lent.select(*columns).unionByName(own.select(*columns)), convs.select("conv")


def _halves(turns: DataFrame, longest: int) -> list[DataFrame]:
    """For each j the stretches of 2^j turns: ``(conv, at, hash, left, right)``; of the turns themselves without halves.

    The last one has one stretch for each conversation, the whole of it.
    """
    levels = [turns.select("conv", (F.col("pos") - 1).alias("at"), F.col("digest").alias("hash"))]
    for _ in range((longest - 1).bit_length()):
        is_left = F.col("at") % 2 == 0
        level = levels[-1].groupBy("conv", F.shiftright("at", 1).alias("up")).agg(
            F.max(F.when(is_left, F.col("hash"))).alias("left"), F.max(F.when(~is_left, F.col("hash"))).alias("right")
        )
        both = _digest(F.lit(b"both"), F.col("left"), F.coalesce("right", F.lit(b"")))
        levels.append(write_through(level.select("conv", F.col("up").alias("at"), both.alias("hash"), "left", "right"), "stretches"))
    return levels


def _named(levels: list[DataFrame], first: int) -> DataFrame:
    """Nodes ``(up, at, hash, conv, n)``: the parent's name, turns above, last turn, own name, conversations; names are smallest conversations."""
    least_and_number = (F.min("conv").alias("conv"), F.sum("n").alias("n"))
    top = levels[-1].select(F.lit(first).cast("long").alias("up"), "at", "hash", "conv", F.lit(1).cast("long").alias("n"))
    forests = write_through(top.groupBy("up", "at", "hash").agg(*least_and_number), "forests")
    for level in reversed(levels[1:]):
        # Both halves read what is shuffled here once.
        cut = forests.drop("hash").join(level.select("conv", "at", "left", "right"), ["conv", "at"])
        uppers = cut.groupBy("up", "at", F.col("left").alias("hash")).agg(*least_and_number)
        names = uppers.select("up", "at", F.col("hash").alias("left"), F.col("conv").alias("name"))
        lowers = cut.where("right is not null").join(names, ["up", "at", "left"])
        lowers = lowers.groupBy(F.col("name").alias("up"), "at", F.col("right").alias("hash")).agg(*least_and_number)
        halves = uppers.withColumn("at", F.col("at") * 2).unionByName(lowers.withColumn("at", F.col("at") * 2 + 1))
        forests = write_through(halves, "forests")
    return forests


def _grafted(nodes: DataFrame, deepest: int, sums: list[str]) -> DataFrame:
    """Nodes ``(conv, depth, up, sums)`` of depths from 1 to ``deepest``, with the sums over their subtrees."""
    height = max(deepest - 1, 0).bit_length()
    totals = nodes
    # Each node at the bottom of a trie (conv, depth) with those above it in that trie (over, over_depth) and their parents.
    lines = nodes.select("conv", "depth", F.col("conv").alias("over"), F.col("depth").alias("over_depth"), "up")
    for j in range(height):
        half = 1 << j
        tops = totals.where((F.col("depth") - 1) % (2 * half) == half)
        grafts = tops.groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(*(F.sum(c).alias(f"_{c}") for c in sums))
        gained = lines.join(grafts, ["conv", "depth"]).groupBy(F.col("over").alias("conv"), F.col("over_depth").alias("depth"))
        gained = gained.agg(*(F.sum(f"_{c}").alias(f"_{c}") for c in sums))
        more = [(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in sums]
        totals = write_through(totals.join(gained, ["conv", "depth"], "left").select("conv", "depth", "up", *more), "totals")
        if j + 1 == height:
            break
        # Lines of a lower trie go on where its top hangs.
        lower = lines.where(F.col("depth") % (2 * half) == 0)
        hung = lower.where((F.col("over_depth") - 1) % (2 * half) == half)
        hung = hung.select("conv", "depth", F.col("up").alias("_cut"), (F.col("over_depth") - 1).alias("_cut_depth"))
        above = lines.select(F.col("conv").alias("_cut"), F.col("depth").alias("_cut_depth"), "over", "over_depth", "up")
        above = hung.join(above, ["_cut", "_cut_depth"])
        lines = write_through(lower.unionByName(above.select(*lines.columns)), "lines")
    return totals


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows (hash, number) as rows (hash, first number, numbers joined by commas), the end of a task's last piece included."""
    held: tuple[bytes, int, list[str]] | None = None
    kind = pa.schema([("hash", pa.binary()), ("first", pa.int64()), ("piece", pa.string())])
    for batch in batches:
        done = []
        for key, number in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if held is None or held[0] != key or len(held[2]) >= PIECE_NUMBERS:
                if held:
                    done.append((held[0], held[1], ",".join(held[2])))
                held = (key, number, [])
            held[2].append(str(number))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)
    if held:
        last = (held[0], held[1], ",".join(held[2]))
        yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(last, kind)], schema=kind)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces as rows (smallest number, SHA-256 of all numbers joined by commas)."""
    key, first, digest = None, 0, hashlib.sha256()
    kind = pa.schema([("conv", pa.int64()), ("ends_sha256", pa.string())])
    for batch in batches:
        done = []
        for new, number, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if new != key:
                if key is not None:
                    done.append((first, digest.hexdigest()))
                key, first, digest = new, number, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(piece.encode())
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), kind)], schema=kind)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([digest.hexdigest()])], schema=kind)


def list_digests(rows: DataFrame, key: str, number: str) -> DataFrame:
    """``(conv, ends_sha256)``: for each key its smallest number, and the SHA-256 of all its numbers, ascending, joined by commas.

    Numbers of a key, however many, are never held together.
    """
    plain = rows.select(F.col(key).alias("hash"), F.col(number).alias("number"))
    ordered = plain.repartitionByRange("hash", "number").sortWithinPartitions("hash", "number")
    pieces = ordered.mapInArrow(_pieces, "hash binary, first long, piece string")
    together = pieces.repartition("hash").sortWithinPartitions("hash", "first")
    return together.mapInArrow(_streamed, "conv long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per distinct prefix of the sequences ``turns (conv, pos, digest, tokens)``; ``convs`` lists all, also those without turns.

    A node is known by its ``depth`` and the smallest conversation that has it (``conv_id``). The others are
    ``parent_conv_id``, ``n_convs``, ``n_children``, ``n_leaves`` of its subtree, ``saved_tokens`` (over its subtree, the tokens of
    each last turn times the conversations but one) and ``ends_sha256``, the digest of the conversations that end there.
    Positions of a conversation run from 1 without gaps. Without conversations there are no nodes.
    """
    convs = write_through(convs.select("conv"), "conversations")
    first = convs.agg(F.min("conv")).first()[0]
    turns = write_through(turns, "sequences")
    deepest = turns.agg(F.coalesce(F.max("pos"), F.lit(0))).first()[0]
    # A mark after the last turn, which no turn's digest equals, makes ends nodes like any other.
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("_length"))
    marks = convs.join(lengths, "conv", "left").select(
        "conv", (F.coalesce("_length", F.lit(0)) + 1).alias("pos"), F.lit(bytes(16)).alias("digest"), F.lit(0).cast("long").alias("tokens")
    )
    levels = _halves(turns.select(*marks.columns).unionByName(marks), deepest + 1)
    named = _named(levels, first if first is not None else 0)
    named = named.withColumn("depth", F.col("at") + 1).drop("at")
    is_end = F.col("hash") == F.lit(bytes(16))

    digests = list_digests(levels[-1], "hash", "conv")
    ends = named.where(is_end).join(digests, "conv").select(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth"), "ends_sha256")
    said = named.where(~is_end)
    children = said.groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count("*").alias("n_children"))
    root = convs.groupBy().agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0")
    root = root.select("conv", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("up"), "n", F.lit(0).cast("long").alias("tokens"))
    # A node's last turn is that of the conversation that names it.
    spoken = said.join(turns.select("conv", F.col("pos").alias("depth"), "tokens"), ["conv", "depth"])
    nodes = spoken.select(*root.columns).unionByName(root)
    nodes = nodes.join(children, ["conv", "depth"], "left").join(ends, ["conv", "depth"], "left")
    nodes = write_through(
        nodes.select(
            "conv", "depth", "up", "n",
            F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
            F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("long").alias("n_leaves"),
            ((F.col("n") - 1) * F.col("tokens")).alias("saved_tokens"),
        ),
        "nodes",
    )
    sums = ["n_leaves", "saved_tokens"]
    below = nodes.where("depth > 0").select("conv", "depth", "up", *sums)
    totals = _grafted(below, deepest, sums)
    # The root has what the trees below it have: one row of two numbers.
    whole = totals.where("depth = 1").agg(*(F.coalesce(F.sum(c), F.lit(0)) for c in sums)).first()
    top = nodes.where("depth = 0").withColumns({c: F.col(c) + F.lit(n) for c, n in zip(sums, whole)})
    rest = nodes.where("depth > 0").drop(*sums).join(totals.drop("up"), ["conv", "depth"])
    return rest.select(*top.columns).unionByName(top).select(
        F.col("conv").alias("conv_id"), "depth", F.col("up").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    )
