"""Fill-in-the-middle transformation of whole texts, as a pipeline of pyarrow.compute kernels.

A batch of texts is split into units (a run of ASCII letters, or one other code point), the lists are
flattened next to the number of their row, every unit gets its ordinal and from it its role, the units
of a role are filtered, put back into lists and joined to pieces, and the pieces are joined with
markers. Nothing is shuffled and no unit is touched by Python code. Batches are cut into slices of
``SLICE_BYTES`` of text (or one longer text), so the arrays of a task stay bounded.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 4 << 20

#: What marks prefix, suffix and middle in an output.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: A unit in UTF-8 bytes, and the byte that ends it; that byte occurs in no UTF-8 text.
UNIT = rb"([A-Za-z]+|[\x00-\x40\x5B-\x60\x7B-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
END = b"\xff"

RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()),
    T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType()),
])
_RESULT = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.large_string())])


def draws(key: Column, seed: int = 1) -> list[Column]:
    """Four numbers below 2**32 of a row: the first groups of 8 digits of the hex SHA-256 of ``seed:key``; a null key is empty."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]


def cut_slices(texts: pa.Array, most: int) -> Iterator[tuple[int, int]]:
    """(first row, number of rows) of runs of texts of at most ``most`` bytes, or one longer text."""
    ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
    row = 0
    while row < len(texts):
        before = ends[row - 1] if row else 0
        end = max(row + 1, int(np.searchsorted(ends, before + most, "right")))
        yield row, end - row
        row = end


def pieces(units: pa.Array, role: pa.Array, wanted: int, counts: pa.Array) -> pa.Array:
    """The units of one role, back in lists of ``counts`` units and each list joined to one piece."""
    chosen = units.filter(pc.equal(role, pa.scalar(wanted, pa.int8())))
    ends = pc.cumulative_sum(counts)
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends.cast(pa.int64())])
    return pc.binary_join(pa.LargeListArray.from_arrays(offsets, chosen), pa.scalar(b"", chosen.type))


def transformed(texts: pa.Array, draw: list[pa.Array], plain_percent: int, spm_percent: int) -> pa.Array:
    """The result struct of a slice of texts (large_binary, no nulls)."""
    lists = pc.split_pattern(pc.replace_substring_regex(texts, pattern=UNIT, replacement=b"\\1" + END), END)
    n = pc.subtract(pc.list_value_length(lists), 1).cast(pa.int64())  # what follows the last end is empty
    choices = pc.add(n, 1)
    h1, h2 = (pc.subtract(h, pc.multiply(pc.divide(h, choices), choices)) for h in draw[:2])
    low, high = pc.min_element_wise(h1, h2), pc.max_element_wise(h1, h2)
    units, parents = pc.list_flatten(lists), pc.list_parent_indices(lists)
    firsts = pc.subtract(pc.cumulative_sum(pc.add(n, 1)), pc.add(n, 1))
    ordinal = pc.subtract(pa.array(np.arange(len(units))), firsts.take(parents))
    # 0 prefix, 1 middle, 2 suffix, 3 the empty string after the last end
    at_least = [pc.greater_equal(ordinal, x.take(parents)).cast(pa.int8()) for x in (low, high, n)]
    role = pc.add(pc.add(at_least[0], at_least[1]), at_least[2])
    prefix = pieces(units, role, 0, low)
    middle = pieces(units, role, 1, pc.subtract(high, low))
    suffix = pieces(units, role, 2, pc.subtract(n, high))

    def percent(h: pa.Array) -> pa.Array:
        return pc.subtract(h, pc.multiply(pc.divide(h, 100), 100))

    marked = pc.or_(pc.or_(pc.match_substring(texts, PREFIX), pc.match_substring(texts, SUFFIX)), pc.match_substring(texts, MIDDLE))
    plain = pc.or_(pc.or_(pc.equal(n, 0), marked), pc.greater_equal(percent(draw[2]), plain_percent))
    spm = pc.and_(pc.invert(plain), pc.less(percent(draw[3]), spm_percent))
    p, s, m = (pa.scalar(x.encode(), texts.type) for x in (PREFIX, SUFFIX, MIDDLE))
    joined = pc.binary_join_element_wise(p, prefix, s, suffix, m, middle, pa.scalar(b"", texts.type))
    turned = pc.binary_join_element_wise(s, suffix, p, prefix, m, middle, pa.scalar(b"", texts.type))
    output = pc.if_else(plain, texts, pc.if_else(spm, turned, joined)).cast(pa.large_string())
    form = pc.if_else(plain, "plain", pc.if_else(spm, "spm", "psm"))
    chars = [pc.if_else(plain, pa.scalar(None, pa.int64()), pc.utf8_length(x.cast(pa.large_string())).cast(pa.int64())) for x in (prefix, middle)]
    return pa.StructArray.from_arrays([n, form.cast(pa.string()), *chars, output], fields=list(_RESULT))


def fill_in_middle(docs: DataFrame, key: str = "doc_id", seed: int = 1, plain_from: int = 90, spm_below: int = 20, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """``docs`` with a struct column ``fim``: n, form, prefix_chars, middle_chars, output.

    A text of n units is cut after the smaller and after the larger of two drawn numbers of units, 0 to
    n, into prefix, middle and suffix. form is ``plain`` (output is the text) for an empty text, a text
    that holds a marker, and where the third draw modulo 100 is ``plain_from`` or more; else ``spm``
    (suffix first) where the fourth draw modulo 100 is below ``spm_below``; else ``psm``. Draws depend on
    ``seed`` and ``key`` alone, so equal rows get equal results and reruns agree. Null texts are empty;
    null keys draw as an empty key; whole texts of any length are cut. Every row and every other column
    passes unchanged; a column already named ``fim`` is replaced.
    """
    docs = docs.drop("fim")
    schema = T.StructType([*docs.schema.fields, T.StructField("fim", RESULT)])
    dealt = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs["text"].cast("string").alias("text"), F.struct(*draws(docs[key], seed)).alias("draws"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, draw = batch.column(0).flatten(), batch.column(2).flatten()
            texts = batch.column(1).cast(pa.large_binary()).fill_null(b"")
            for first, n in cut_slices(texts, slice_bytes):
                fim = transformed(texts.slice(first, n), [d.slice(first, n) for d in draw], plain_from, spm_below)
                yield pa.RecordBatch.from_arrays([*[c.slice(first, n) for c in rows], fim], names=[*schema.names])

    return dealt.mapInArrow(run, schema)


def restored(output: pa.Array, form: pa.Array) -> pa.Array:
    """The exact texts behind outputs: the pieces between the markers, in the order that the form gives."""
    plain, spm = pc.equal(form, "plain"), pc.equal(form, "spm")
    parts = pc.split_pattern_regex(pc.if_else(plain, PREFIX + SUFFIX + MIDDLE, output), "<[PSM]>")
    one, two, three = (pc.list_element(parts, i) for i in (1, 2, 3))
    ordered = pc.binary_join_element_wise(pc.if_else(spm, two, one), three, pc.if_else(spm, one, two), pa.scalar("", parts.type.value_type))
    return pc.if_else(plain, output, ordered)


def restore(transformed: DataFrame, column: str = "fim") -> DataFrame:
    """``transformed`` with a string column ``restored``: the texts rebuilt from output and form of a ``fill_in_middle`` struct alone.

    A null struct gives null; every row and every other column passes unchanged; a column already named
    ``restored`` is replaced.
    """
    docs = transformed.drop("restored")
    schema = T.StructType([*docs.schema.fields, T.StructField("restored", T.StringType())])
    parts = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), F.col(column)["output"].alias("output"), F.col(column)["form"].alias("form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, output = batch.column(0).flatten(), batch.column(1).cast(pa.large_string())
            for first, n in cut_slices(output.cast(pa.large_binary()).fill_null(b""), SLICE_BYTES):
                texts = restored(output.slice(first, n), batch.column(2).slice(first, n))
                yield pa.RecordBatch.from_arrays([*[c.slice(first, n) for c in rows], texts], names=[*schema.names])

    return parts.mapInArrow(run, schema)
