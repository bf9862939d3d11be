"""Operators on one row's arrays: truncation, label masks, splicing, padding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: label positions with this id take no part in the loss.
IGNORE_LABEL = -100


def repeat_id(value: int, times: Column) -> Column:
    return F.array_repeat(F.lit(value).cast("bigint"), times.cast("int"))


def truncate_ids(ids: Column, n: int) -> Column:
    return F.slice(ids, 1, n)


def mask_prompt(ids: Column, prompt_length: Column | int) -> Column:
    """The first ``prompt_length`` positions become the ignore label."""
    length = F.lit(prompt_length) if isinstance(prompt_length, int) else prompt_length
    masked = F.least(length, F.size(ids))
    return F.concat(
        repeat_id(IGNORE_LABEL, masked),
        F.slice(ids, (masked + 1).cast("int"), (F.size(ids) - masked).cast("int")),
    )


def mask_pad(labels: Column, pad_id: int | None = None) -> Column:
    """Labels equal to the pad id become the ignore label, real tokens of that id included."""
    if pad_id is None:
        return labels
    ignore = F.lit(IGNORE_LABEL).cast("bigint")
    return F.transform(labels, lambda x: F.when(x == pad_id, ignore).otherwise(x))


def marker_pos(ids: Column, marker: int, strict: bool = True) -> Column:
    """1-based place of the first marker id; absent is an error, or 0 if not ``strict``."""
    place = F.array_position(ids, F.lit(marker).cast("bigint"))
    if not strict:
        return place
    return F.when(
        place == 0, F.raise_error(F.lit(f"marker id {marker} not found")).cast("bigint")
    ).otherwise(place)


def splice_segment(values: Column, place: Column, segment: Column) -> Column:
    """Put ``segment`` where the marker is; NULL for a row without one."""
    at = place.cast("int")
    return F.when(
        place >= 1,
        F.concat(
            F.slice(values, F.lit(1), at - 1),
            segment,
            F.slice(values, at + 1, F.size(values) - at),
        ),
    )


def splice_labels(labels: Column, place: Column, segment_length: Column) -> Column:
    """The labels that belong to ``splice_segment``: the segment takes no part in the loss."""
    return splice_segment(labels, place, repeat_id(IGNORE_LABEL, segment_length))


def pad_right(values: Column, length: Column | int, fill: Column) -> Column:
    wanted = F.lit(length) if isinstance(length, int) else length
    return F.concat(values, F.array_repeat(fill, F.greatest(wanted - F.size(values), F.lit(0)).cast("int")))


def ones_then_zeros(ones: Column, length: Column | int) -> Column:
    """An attention mask of ``length`` entries, the first ``ones`` of them set."""
    wanted = F.lit(length) if isinstance(length, int) else length
    used = F.least(ones, wanted)
    return F.concat(repeat_id(1, used), repeat_id(0, wanted - used))


def pad_audio(samples: Column, n: int) -> Column:
    """Samples cut or zero-padded to ``n``, and their mask."""
    fill = F.lit(0).cast("float")
    return F.struct(
        pad_right(F.slice(samples, 1, n), n, fill).alias("array"),
        ones_then_zeros(F.size(samples), n).alias("mask"),
    )
