"""Fill-in-the-middle: texts cut at two places between units, and their pieces put in another order.

A unit is a word with the blanks before it, or the blanks at a text's end.  The pieces of all texts of an Arrow batch
are made at once: units as one list array, flattened with the index of the text each belongs to, numbered within it,
filtered by role, made into lists again and joined.  No text is handled by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from logweir.llm.common import in_small_batches

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 42
#: Texts in a hundred that are cut, and cut texts in a hundred whose suffix comes first.
CUT = 50
SUFFIX_FIRST = 80

#: A byte that UTF-8 never holds, set between units.
_BORDER = b"\xff"
_UNIT_ENDS = rb"([^\x20\x09-\x0D])([\x20\x09-\x0D])"


def units(texts: pa.Array) -> pa.Array:
    """The units of each text (large binary), as lists; an empty text gives one empty unit."""
    marked = pc.replace_substring_regex(texts, pattern=_UNIT_ENDS, replacement=rb"\1" + _BORDER + rb"\2")
    return pc.split_pattern(marked, pattern=_BORDER)


def _remainder(number: pa.Array, by: pa.Array) -> pa.Array:
    return pc.subtract(number, pc.multiply(pc.divide(number, by), by))


def _offsets(counts: pa.Array) -> pa.Array:
    return pa.array(np.concatenate(([0], np.cumsum(counts.to_numpy()))).astype(np.int32))


def pieces(texts: pa.Array, first: pa.Array, second: pa.Array) -> tuple[pa.Array, list[pa.Array]]:
    """The number of units of each text, and its prefix, middle and suffix by two numbers that choose the cuts."""
    lists = units(texts)
    count = pc.if_else(pc.equal(pc.binary_length(texts), 0), pa.scalar(0, pa.int64()), pc.cast(pc.list_value_length(lists), pa.int64()))
    places = pc.add(count, 1)
    one, two = _remainder(first, places), _remainder(second, places)
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    flat, parent = pc.list_flatten(lists), pc.list_parent_indices(lists)
    start = pc.take(pa.array(lists.offsets.to_numpy()[:-1].astype(np.int64)), parent)
    ordinal = pc.subtract(pa.array(np.arange(len(flat), dtype=np.int64)), pc.subtract(start, int(lists.offsets[0].as_py())))
    # An empty text's empty unit belongs to no role.
    real = pc.less(ordinal, pc.take(count, parent))
    before, within = pc.less(ordinal, pc.take(low, parent)), pc.less(ordinal, pc.take(high, parent))
    roles = [
        (before, low),
        (pc.and_(within, pc.invert(before)), pc.subtract(high, low)),
        (pc.and_(real, pc.invert(within)), pc.subtract(count, high)),
    ]
    return count, [pc.binary_join(pa.ListArray.from_arrays(_offsets(n), flat.filter(role)), pa.scalar(b"", flat.type)) for role, n in roles]


def _joined(*parts: pa.Array | str) -> pa.Array:
    values = [pa.scalar(p.encode(), pa.large_binary()) if isinstance(p, str) else p for p in parts]
    return pc.binary_join_element_wise(*values, pa.scalar(b"", pa.large_binary()))


def _formed(batch: pa.RecordBatch, cut: int, suffix_first: int) -> pa.RecordBatch:
    texts = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
    count, (prefix, middle, suffix) = pieces(texts, batch.column("h1"), batch.column("h2"))
    marked = pa.array(np.zeros(len(texts), bool))
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked = pc.or_(marked, pc.match_substring(texts, mark))
    hundred = pa.array(np.full(len(texts), 100, np.int64))
    unfit = pc.or_(pc.equal(count, 0), pc.or_(marked, pc.greater_equal(_remainder(batch.column("h3"), hundred), cut)))
    order = pc.if_else(pc.less(_remainder(batch.column("h4"), hundred), suffix_first), "spm", "psm")
    form = pc.if_else(unfit, "plain", order)
    psm = _joined(PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle)
    spm = _joined(SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle)
    output = pc.if_else(unfit, texts, pc.if_else(pc.equal(order, "spm"), spm, psm))

    def length(piece: pa.Array) -> pa.Array:
        return pc.if_else(unfit, pa.scalar(None, pa.int64()), pc.utf8_length(piece.cast(pa.large_string())).cast(pa.int64()))

    return pa.RecordBatch.from_arrays(
        [batch.column("id"), count, form.cast(pa.string()), length(prefix), length(middle), output.cast(pa.string())],
        names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
    )


def transform(documents: DataFrame, key: str = "doc_id", text: str = "text", seed: int = SEED, cut: int = CUT, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row of ``documents``; other columns are not read.

    The cuts, whether a text is cut and which form it takes follow from a hash of seed and id alone, so a lost task
    gives the same rows again, and rows with one id are cut alike.  A text that is empty or null, or that holds one of
    the marks, stays as it is (form ``plain``; lengths of its pieces are null).  A null id is hashed as an empty one.
    A very long text is one element of its batch and is held a few times over.  Repeated rows are kept; an empty
    table gives an empty result.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    hashes = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    read = in_small_batches(documents).select(F.col(key).alias("id"), F.col(text).alias("text"), *hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _formed(batch, cut, suffix_first)

    made = [("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType()), ("output", StringType())]
    return read.mapInArrow(run, StructType([read.schema["id"], *[StructField(name, kind) for name, kind in made]]))


def restored(output: Column, form: Column) -> Column:
    """The text that an output of ``transform`` was made of."""
    part = F.split(output, "<[PSM]>")
    return (
        F.when(form == "psm", F.concat(part[1], part[3], part[2]))
        .when(form == "spm", F.concat(part[2], part[3], part[1]))
        .otherwise(output)
    )
