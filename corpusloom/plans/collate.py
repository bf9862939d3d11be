"""Token, label and audio arrays of a batch, and audio spliced into token sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.audio import MAX_SAMPLES, frame_mask, mel_features
from corpusloom.functions.sequences import (
    mask_pad,
    mask_prompt,
    marker_pos,
    pad_audio,
    splice_labels,
    splice_segment,
    truncate_ids,
)
from corpusloom.functions.text import INSTRUCTION_TEMPLATE, instruction_text, split_ws
from corpusloom.operators.batching import pad_longest, pad_spliced
from corpusloom.operators.embedding import embedding_gather
from corpusloom.operators.vocabulary import encode_ids


def instruction_len(template: str = INSTRUCTION_TEMPLATE) -> Column:
    """Words in the template; a constant that the optimizer folds."""
    return F.size(split_ws(F.lit(template))).cast("bigint")


def collate(
    df: DataFrame,
    vocab: DataFrame,
    pad_id: int | None,
    template: str = INSTRUCTION_TEMPLATE,
    max_tokens: int | None = None,
    audio: str | None = None,
    audio_samples: int = MAX_SAMPLES,
    features: bool = False,
    unk_id: int | None = None,
) -> DataFrame:
    """Batched usable rows to ``(batch_id, pos, input_ids, attention_mask, labels)``.

    Takes ``(batch_id, pos, text)``. Only these are tokenised and shuffled; an ``audio`` array
    column is padded where it lies and joined by ``pos`` at the end, as ``audio_values`` and the
    mask of its samples, or, with ``features``, as the matrix ``input_features`` and the mask of its
    frames. ``unk_id`` stands for words that the vocabulary lacks, which are NULL otherwise.
    """
    words = df.select("batch_id", "pos", split_ws(instruction_text(F.col("text"), template)).alias("words"))
    coded = encode_ids(
        words, ["batch_id", "pos"], "words", vocab, out="input_ids", used=template.split(), unk_id=unk_id
    )
    if max_tokens is not None:
        coded = coded.withColumn("input_ids", truncate_ids(F.col("input_ids"), max_tokens))
    padded = pad_longest(coded, "input_ids", 0 if pad_id is None else pad_id)
    labels = mask_pad(mask_prompt(F.col("input_ids"), instruction_len(template)), pad_id)
    batch = padded.select("batch_id", "pos", "input_ids", "attention_mask", labels.alias("labels"))
    if audio is None:
        return batch
    if features:
        matrix = df.select(
            "pos",
            mel_features(F.col(audio), audio_samples).alias("input_features"),
            frame_mask(F.col(audio), audio_samples).alias("audio_attention_mask"),
        )
        return batch.join(matrix, "pos").select(*batch.columns, "input_features", "audio_attention_mask")
    sounds = df.select("pos", pad_audio(F.col(audio), audio_samples).alias("_audio"))
    return batch.join(sounds, "pos").select(
        *batch.columns,
        F.col("_audio.array").alias("audio_values"),
        F.col("_audio.mask").alias("audio_attention_mask"),
    )


# Why a row cannot be spliced.
NO_MARKER, NO_SEGMENT, UNKNOWN_ID = "no marker", "no segment", "unknown id"


def splice_errors(tokens: DataFrame, segments: DataFrame, embeddings: DataFrame, marker_id: int) -> DataFrame:
    """``(pos, reason)`` of the rows that cannot be spliced, one row each with the first reason that holds.

    A row needs the marker, a segment, and a vector for each of its other ids.
    """
    placed = tokens.select("pos", "input_ids", marker_pos(F.col("input_ids"), marker_id, strict=False).alias("_place"))
    held = segments.where(F.col("segment").isNotNull()).select("pos", F.lit(True).alias("_held"))
    ids = placed.select("pos", "_place", F.posexplode("input_ids").alias("_at", "id")).where("_at + 1 <> _place")
    known = embeddings.where(F.col("vector").isNotNull()).select("id")
    unknown = ids.join(known, "id", "left_anti").select("pos").distinct().withColumn("_unknown", F.lit(True))
    reason = (
        F.when(F.coalesce(F.col("_place"), F.lit(0)) == 0, F.lit(NO_MARKER))
        .when(F.col("_held").isNull(), F.lit(NO_SEGMENT))
        .when(F.col("_unknown").isNotNull(), F.lit(UNKNOWN_ID))
    )
    checked = placed.join(held, "pos", "left").join(unknown, "pos", "left")
    return checked.select("pos", reason.alias("reason")).where("reason is not null")


def splice_batch(
    tokens: DataFrame,
    segments: DataFrame,
    embeddings: DataFrame,
    marker_id: int,
    dim: int,
    mask_mode: str = "reference",
    strict: bool = True,
    ranked: bool = False,
) -> DataFrame:
    """Vectors of token sequences with each row's own segment in place of the marker.

    ``tokens`` is ``(batch_id, pos, input_ids, labels)``, with ``attention_mask`` too for
    ``mask_mode="strict"``; ``segments`` is ``(pos, segment)`` with an array of vectors;
    ``embeddings`` is ``(id, vector)``. In mode ``reference`` text padding counts as sequence, in
    mode ``strict`` it keeps its own mask. With ``strict``, a row without marker or segment, or
    with an id that has no vector, raises an error; else such rows are left out, and
    ``splice_errors`` names them. ``ranked`` is as for ``embedding_gather``. ``tokens`` is read
    several times; write it first if it is costly to compute.
    """
    if mask_mode not in ("reference", "strict"):
        raise ValueError(mask_mode)
    wrong = splice_errors(tokens, segments, embeddings, marker_id)
    # With ``strict`` every row goes on, and the first wrong one that is met ends the job.
    if strict:
        marked = tokens.join(wrong, "pos", "left")
    else:
        marked = tokens.join(wrong, "pos", "left_anti").withColumn("reason", F.lit(None).cast("string"))
    marked = marked.withColumn("_place", marker_pos(F.col("input_ids"), marker_id, strict=False))
    # Lengths are known before any vector is fetched, so vectors are shuffled once, to their row.
    sized = marked.join(segments.select("pos", F.size("segment").alias("_added")), "pos", "left")
    lengths = F.size("input_ids") - 1 + F.col("_added")
    sized = sized.withColumn("_longest", F.max(lengths).over(Window.partitionBy("batch_id")))
    labels = splice_labels(F.col("labels"), F.col("_place"), F.col("_added"))
    own = F.concat(
        F.slice("attention_mask", F.lit(1), F.col("_place").cast("int") - 1),
        F.array_repeat(F.lit(1).cast("bigint"), F.col("_added")),
        F.slice("attention_mask", F.col("_place").cast("int") + 1, F.size("attention_mask")),
    ) if mask_mode == "strict" else F.lit(None).cast("array<bigint>")
    rows = sized.select(
        "batch_id", "pos", "_place", "_longest", labels.alias("labels"), own.alias("_mask"), "reason"
    )

    vectors = embedding_gather(marked, ["pos"], "input_ids", embeddings, dim, out="inputs_embeds", ranked=ranked)
    told = F.raise_error(F.concat(F.lit("row "), F.col("pos").cast("string"), F.lit(": "), F.col("reason")))
    whole = splice_segment(F.col("inputs_embeds"), F.col("_place"), F.col("segment"))
    checked = F.when(F.col("reason").isNotNull(), told.cast("array<array<float>>")).otherwise(whole)
    spliced = (
        vectors.join(rows, "pos")
        .join(segments.select("pos", "segment"), "pos", "left")
        .withColumn("inputs_embeds", checked)
        .drop("segment", "_place", "reason")
    )
    padded = pad_spliced(
        spliced, dim=dim, mask="_mask" if mask_mode == "strict" else None, longest="_longest"
    )
    return padded.select("batch_id", "pos", "inputs_embeds", "attention_mask", "labels")
