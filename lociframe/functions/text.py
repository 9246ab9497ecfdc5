"""Missing tokens, lenient number parsing, alias columns and list cells.

Files carry every cell as text; inside the engine a missing value is NULL. Which tokens count
as missing differs per input, so it is a parameter everywhere.
"""
from __future__ import annotations

from collections.abc import Iterable, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

EMPTY = ("",)
MISSING = ("", "NA")
LIST_SEPARATORS = r"[;,|]\s*"


def present(col: Column, missing: Sequence[str] = MISSING) -> Column:
    """The value, or NULL where it is one of the ``missing`` tokens."""
    return F.when(~col.cast("string").isin(*missing), col)


def column_of(df: DataFrame, name: str, ignore_case: bool = False) -> Column | None:
    """The column called ``name``, or None when the table has no such column."""
    if name in df.columns:
        return df[f"`{name}`"]
    if ignore_case:
        for existing in df.columns:
            if existing.lower() == name.lower():
                return df[f"`{existing}`"]
    return None


def first_present(
    df: DataFrame,
    names: Iterable[str],
    default: str | None = None,
    missing: Sequence[str] = EMPTY,
    ignore_case: bool = False,
) -> Column:
    """Row-wise first non-missing value among the columns of ``names`` that exist."""
    found = [c for c in (column_of(df, n, ignore_case) for n in names) if c is not None]
    options = [present(c.cast("string"), missing) for c in found]
    if default is not None:
        options.append(F.lit(default))
    return F.coalesce(*options) if options else F.lit(None).cast("string")


def to_double(col: Column) -> Column:
    """Number or NULL; never fails on bad text."""
    value = col.try_cast("double")
    return F.when(~F.isnan(value), value)


def to_long(col: Column) -> Column:
    """Integer part of a number written in any form (``12``, ``1e3``, ``7.9``), or NULL."""
    return to_double(col).try_cast("bigint")


def spread_missing(key: Column, *by: str) -> Column:
    """A join key as text; rows without one get keys of many that match nothing, so they do not meet in one task."""
    return F.coalesce(key.cast("string"), F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*by), F.lit(4096)).cast("string")))


def split_terms(
    col: Column,
    pattern: str = LIST_SEPARATORS,
    drop: Sequence[str] = ("NA",),
    strip: str | None = None,
) -> Column:
    """A list cell as a sorted array of distinct terms; a missing cell gives an empty array."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), pattern), lambda x: F.trim(x))
    kept = F.filter(parts, lambda x: (x != "") & ~x.isin(*drop) if drop else x != "")
    if strip:
        kept = F.transform(kept, lambda x: F.replace(x, F.lit(strip), F.lit("")))
    return F.array_sort(F.array_distinct(kept))


def split_members(col: Column) -> Column:
    """Gene names of a membership cell, in the order written, repeats kept."""
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), r"[,;]\s*"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: ~x.isin("", "NA"))


def labels(*pairs: tuple[Column, str]) -> Column:
    """Array of the labels whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(name)) for cond, name in pairs]))


def joined(items: Column, empty: str, sep: str = ";") -> Column:
    """Array rendered as one cell, ``empty`` where it has no element."""
    return F.when(F.size(items) > 0, F.array_join(items, sep)).otherwise(F.lit(empty))


@F.pandas_udf(StringType())
def general_format(values: pd.Series) -> pd.Series:
    """``%.6g`` text of a number, for text sinks only."""
    return values.map(lambda v: None if pd.isna(v) else f"{v:.6g}")
