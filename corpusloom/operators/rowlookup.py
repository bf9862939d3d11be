"""Many-to-one lookups of all elements of an array, with the row kept whole.

The head of the lookup table, of limited size, is broadcast, and each row finds its elements there, in Arrow batches. What is written
for a row are places in that head. Only elements that the head lacks become rows of their own, are joined with the table by key, and are
sorted in behind their row, whose values are then put together. So what is shuffled grows with the rare elements, not with all of them,
no key of that join is hot, and no group is gathered in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.operators.rows import pieces
from corpusloom.session import write_through

# Instead of a place in the head: an element that the head lacks, and one that is NULL.
_LACKING, _NULL = -1, -2

# Elements, or bytes of text, that a task looks up or puts together at once.
MOST_ELEMENTS = 1_000_000
MOST_TEXT_BYTES = 8 * 1024 * 1024


def _as_lists(column: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets from 0 and elements; a missing array has no elements."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32), pc.list_flatten(column)


def filtered(offsets: np.ndarray, flat: pa.Array, keep: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Offsets and elements of lists without those elements that are not to be kept."""
    if keep.all():
        return offsets, flat
    return np.concatenate([[0], np.cumsum(keep)])[offsets].astype(np.int32), flat.filter(pa.array(keep))


def split_texts(texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and elements of ``text.split()``: Arrow parts words at the same characters, and has empty ones at the ends."""
    offsets, flat = _as_lists(pc.utf8_split_whitespace(texts))
    return filtered(offsets, flat, pc.not_equal(flat, "").to_numpy(zero_copy_only=False))


def _in_head(shared, key_name: str):
    most = {True: MOST_ELEMENTS, False: MOST_TEXT_BYTES}

    def looked(column: pa.Array, keys: pa.Array, place_of: pa.Array) -> pa.Array:
        offsets, flat = _as_lists(column) if pa.types.is_list(column.type) else split_texts(column)
        found = pc.index_in(flat, value_set=keys)
        found = place_of.take(found) if place_of.null_count else found
        lacking = pc.and_(pc.is_null(found), pc.is_valid(flat)).to_numpy(zero_copy_only=False)
        place = pc.fill_null(found, _NULL).to_numpy(zero_copy_only=False).copy()
        place[lacking] = _LACKING
        missing = np.concatenate([[0], np.cumsum(lacking)])[offsets].astype(np.int32)
        lists = (
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(place)),
            pa.ListArray.from_arrays(pa.array(missing), flat.filter(pa.array(lacking))),
        )
        return pa.StructArray.from_arrays(lists, ["place", "missing"])

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        keys, values = shared.value
        # An entry without a value counts as lacking.
        place_of = pa.array(np.arange(len(keys)), pa.int32(), mask=pc.is_null(values).to_numpy(zero_copy_only=False))
        for column in batches:
            parts = list(pieces(column, most[pa.types.is_list(column.type)])) or [(0, 0)]
            yield pa.concat_arrays([looked(column.slice(low, high - low), keys, place_of) for low, high in parts])

    return F.arrow_udf(find, f"struct<place: array<int>, missing: array<{key_name}>>")


def _put(shared, keys: Sequence[str], out: str, finish: Callable[[pa.ListArray], pa.Array] | None):
    most = MOST_ELEMENTS

    def values_of(place: pa.Array, late: pa.Array, values: pa.Array) -> pa.Array:
        offsets, flat = _as_lists(place)
        index = flat.to_numpy(zero_copy_only=False).copy()
        index[index == _LACKING] = len(values) + np.arange(len(late))
        both = pa.concat_arrays([values, late.cast(values.type)])
        lists = pa.ListArray.from_arrays(pa.array(offsets), both.take(pa.array(index, mask=index == _NULL)))
        return lists if finish is None else finish(lists)

    def whole_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
        """Rows, and the values of all elements that they lack, from batches that may end between a row and its elements."""
        held: list[pa.RecordBatch] = []

        def all_held() -> tuple[pa.RecordBatch, pa.Array]:
            batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            is_row = pc.less(batch["_nth"], 0)
            return batch.filter(is_row), batch["_late"].filter(pc.invert(is_row))

        for batch in batches:
            starts = np.flatnonzero(batch["_nth"].to_numpy(zero_copy_only=False) < 0)
            if len(starts):
                held.append(batch.slice(0, starts[-1]))
                if sum(map(len, held)):
                    yield all_held()
                held = [batch.slice(starts[-1])]
            elif len(batch):
                held.append(batch)
        if held:
            yield all_held()

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values = shared.value[1]
        for rows, late in whole_rows(batches):
            done = 0
            for low, high in pieces(rows["_place"], most):
                part = rows.slice(low, high - low)
                n = pc.sum(pc.equal(pc.list_flatten(part["_place"]), _LACKING)).as_py() or 0
                found = values_of(part["_place"], late.slice(done, n), values)
                done += n
                yield pa.RecordBatch.from_arrays([*(part[k] for k in keys), found], [*keys, out])
            if done != len(late):
                raise ValueError("a key has more than one entry")

    return put


def lookup_rows(
    df: DataFrame,
    keys: Sequence[str],
    values: str,
    entries: DataFrame,
    on: str,
    value: str,
    head: DataFrame,
    out: str,
    finish: Callable[[pa.ListArray], pa.Array] | None = None,
    kind: T.DataType | None = None,
) -> DataFrame:
    """``(keys, out)``: for each element of the array ``values`` the ``value`` of the entry with that key ``on``, in order; NULL without one.

    ``values`` may also be a text, whose elements are its words, as ``split_ws`` gives them. ``keys`` are what the result takes over of a row;
    they may repeat or be missing. ``head`` holds the entries of the most used keys and has a fixed largest size: it comes to the driver and
    goes to every task. A missing array is an empty one. ``finish`` makes of the arrays of a batch what the result holds, of type ``kind``.
    """
    spark = df.sparkSession
    table = head.select(on, value).toArrow()
    shared = spark.sparkContext.broadcast(tuple(c.combine_chunks() for c in table.columns))
    key_kind, value_kind = (entries.schema[name].dataType for name in (on, value))
    text = isinstance(df.schema[values].dataType, T.StringType)
    found = _in_head(shared, key_kind.simpleString())(F.make_valid_utf8(values) if text else F.col(values))
    looked = df.select(*keys, F.monotonically_increasing_id().alias("_row"), found.alias("_f")).select(
        *keys, "_row", F.col("_f.place").alias("_place"), F.col("_f.missing").alias("_missing")
    )
    looked = write_through(looked, "looked-up")
    rows = looked.select(*keys, "_row", F.lit(-1).alias("_nth"), "_place", F.lit(None).cast(value_kind).alias("_late"), "_missing")
    done = rows.where(F.size("_missing") == 0).drop("_missing")
    rest = rows.where(F.size("_missing") > 0)
    asked = rest.select("_row", F.posexplode("_missing").alias("_nth", "_key"))
    late = asked.join(entries.select(F.col(on).alias("_key"), F.col(value).alias("_late")), "_key", "left").drop("_key")
    # Each row comes right before the values that its elements have late.
    rest = rest.drop("_missing").unionByName(late, allowMissingColumns=True)
    rest = rest.repartition("_row").sortWithinPartitions("_row", "_nth")
    kinds = [T.StructField(k, df.schema[k].dataType) for k in keys]
    schema = T.StructType([*kinds, T.StructField(out, kind or T.ArrayType(value_kind))])
    put = _put(shared, keys, out, finish)
    return done.mapInArrow(put, schema).unionByName(rest.mapInArrow(put, schema))
