"""Running totals and minima over a whole ordered table, without a window over the whole table.

Rows are dealt to ranges of the order. A window runs inside each range only; what the ranges before
(or after) a range add up to is one number per range, from a list that has one entry per range. Rows keep
the number of their range in a written table, so both levels see the same ranges whatever is replayed.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable

PART = "_part"


def range_parts(df: DataFrame, order: Sequence[str | Column], keys: Sequence[str] = ()) -> DataFrame:
    """``df`` with the number of its range in ``_part``: ranges follow keys and order, and equal rows share one."""
    return durable(df.repartitionByRange(*[F.col(k) for k in keys], *order).withColumn(PART, F.spark_partition_id()))


def _ahead(how: str, listed: Column, index: Column, backwards: bool) -> Column:
    """What the ranges passed before entry ``index`` of the list come to; NULL for none."""
    passed = F.slice(listed, index + 2, F.size(listed)) if backwards else F.slice(listed, F.lit(1), index)
    totals = F.transform(passed, lambda x: x["t"])
    if how != "sum":
        return F.array_min(totals) if how == "min" else F.array_max(totals)
    return F.when(F.size(totals) > 0, F.aggregate(F.slice(totals, 2, F.size(totals)), F.get(totals, F.lit(0)), lambda a, t: a + t))


def running(
    parts: DataFrame, order: Sequence[str | Column], values: Mapping[str, Column], keys: Sequence[str] = (), how: str = "sum",
    backwards: bool = False, exclusive: bool = False,
) -> DataFrame:
    """Add to the rows of ``range_parts`` the sum, ``min`` or ``max`` of each value over all rows up to and including the row.

    ``order`` must be that of the ranges and settle every pair of rows of the same keys; ``backwards`` passes the
    ranges from the last one on and takes the reversed order. ``exclusive`` leaves the row itself out: a sum
    starts at zero, a minimum or maximum at NULL. Key columns must not be NULL.
    """
    keys = list(keys)
    fold = {"sum": F.sum, "min": F.min, "max": F.max}[how]
    inside = Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1 if exclusive else 0)
    local = parts.select("*", *[fold(c).over(inside).alias(f"_in_{n}") for n, c in values.items()])
    totals = parts.groupBy(*keys, PART).agg(*[fold(c).alias(f"_t_{n}") for n, c in values.items()])
    lists = totals.groupBy(*keys).agg(*[F.array_sort(F.collect_list(F.struct(F.col(PART).alias("part"), F.col(f"_t_{n}").alias("t")))).alias(f"_l_{n}") for n in values])
    at = next(iter(values))
    entries = F.transform(f"_l_{at}", lambda x, i: F.struct(x["part"].alias(PART), *[_ahead(how, F.col(f"_l_{n}"), i, backwards).alias(f"_ahead_{n}") for n in values]))
    joined = local.join(lists.select(*keys, F.inline(entries)), [*keys, PART])

    def combined(name: str) -> Column:
        here, ahead = F.col(f"_in_{name}"), F.col(f"_ahead_{name}")
        if how == "sum":
            return F.coalesce(here, F.lit(0)) + F.coalesce(ahead, F.lit(0))
        return F.least(here, ahead) if how == "min" else F.greatest(here, ahead)

    return joined.select(*[F.col(c) for c in parts.columns], *[combined(n).alias(n) for n in values])
