"""Shared summary steps: medians, histograms and Nx statistics that survive a dominant group."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import durable
from .scans import range_parts, running

#: Distance of the cuts around the middle, as a share of the rows, and the sketch's accuracy (errors of one row in so many).
MARGIN, ACCURACY = 1 / 256, 10_000


def median_candidates(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Distinct values (keys, ``_v``, ``_n``) that may be a group's middle ones, with the group's ``_total`` and the rows ``_before`` them.

    A sketch of ranks, combined before the shuffle, gives two cuts just below and above the middle of each
    group; exact counts then tell in which of the three zones the middle ranks lie. The cuts are kept, so
    counts and values are held against the same ones. A zone between the cuts has about one row in
    ``1 / MARGIN / 2``, however the values are spread; a sketch that misses costs work, not exactness.
    """
    keys = list(keys)
    rows = df.filter(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    cuts = durable(rows.groupBy(*keys).agg(
        F.percentile_approx("_v", [0.5 - MARGIN, 0.5 + MARGIN], ACCURACY).alias("_cuts"), F.count(F.lit(1)).alias("_total")))
    zone = F.when(F.col("_v") < F.get("_cuts", F.lit(0)), 0).when(F.col("_v") <= F.get("_cuts", F.lit(1)), 1).otherwise(2)
    counted = rows.groupBy(*keys, "_v").agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.join(cuts, keys).select(*keys, "_v", "_n", "_total", zone.alias("_zone"))
    inside = [F.sum(F.when(F.col("_zone") == z, F.col("_n")).otherwise(0)) for z in range(3)]
    sizes = placed.groupBy(*keys, "_total").agg(F.array(*inside).alias("_in"))
    zones = sizes.select(*keys, "_total", F.posexplode("_in").alias("_zone", "_size"), F.aggregate(
        F.slice("_in", F.lit(1), F.col("_zone")), F.lit(0).cast("bigint"), lambda a, n: a + n).alias("_before"))
    first, second = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    middle = zones.filter((F.col("_before") < second) & (F.col("_before") + F.col("_size") >= first)).select(*keys, "_zone", "_before")
    return placed.join(middle, [*keys, "_zone"])


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """Exact median per group, averaging the two middle values of an even count.

    Only the candidates around the middle rank are put in order, so no task sorts or holds a whole group.
    """
    keys = list(keys)
    inside = Window.partitionBy(*keys, "_zone").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = median_candidates(df, keys, value).withColumn("_rank", F.col("_before") + F.sum("_n").over(inside))
    first, second = F.floor((F.col("_total") + 1) / 2), F.floor((F.col("_total") + 2) / 2)
    return ranked.groupBy(*keys).agg(
        ((F.min(F.when(F.col("_rank") >= first, F.col("_v"))) + F.min(F.when(F.col("_rank") >= second, F.col("_v")))) / 2)
        .alias(out)
    )


def length_histogram(
    df: DataFrame, keys: Sequence[str], value: str, bin_size: int, zero_row: bool = False
) -> DataFrame:
    """Fixed-width bins with count, group total and percent; ``zero_row`` adds an empty bin 0 row per group."""
    keys = list(keys)
    start = (F.floor(F.col(value) / bin_size) * bin_size).cast("bigint")
    counts = df.filter(F.col(value).isNotNull()).groupBy(*keys, start.alias("bin_start")).agg(
        F.count(F.lit(1)).alias("raw_count")
    )
    group = Window.partitionBy(*keys)
    out = counts.withColumn("total_count", F.sum("raw_count").over(group)).withColumn(
        "percent", F.col("raw_count") / F.col("total_count") * 100
    )
    if zero_row:
        zeros = out.groupBy(*keys).agg(F.max("total_count").alias("total_count")).select(
            *keys, F.lit(0).cast("bigint").alias("bin_start"), F.lit(0).cast("bigint").alias("raw_count"), "total_count",
            F.lit(0.0).alias("percent"),
        )
        out = out.unionByName(zeros)
    return out.withColumn("bin_size", F.lit(bin_size))


def nx_statistics(df: DataFrame, keys: Sequence[str], length: str, thresholds: Sequence[int] = (50, 90)) -> DataFrame:
    """N and L values per group: the length at which the longest sequences reach the share, and how many they are.

    One row per distinct length is scanned, in ranges of descending length.
    """
    keys = list(keys)
    by_length = df.groupBy(*keys, length).agg(F.count(F.lit(1)).alias("_n"))
    down = [F.col(length).desc()]
    parts = range_parts(by_length, down, keys)
    bases = F.col("_n") * F.col(length)
    ranked = running(parts, down, {"_acc": bases, "_rank": F.col("_n")}, keys)
    totals = parts.groupBy(*keys).agg(F.sum(bases).alias("_total"))
    ranked = ranked.join(totals, keys) if keys else ranked.withColumn("_total", totals.scalar())
    measures = []
    for share in thresholds:
        target = F.col("_total") * (share / 100)
        reached = F.col("_acc") >= target
        # Sequences of this length still needed once the longer ones are spent.
        needed = F.ceil((target - (F.col("_acc") - bases)) / F.nullif(F.col(length), F.lit(0)))
        count = F.col("_rank") - F.col("_n") + F.greatest(needed, F.lit(1))
        measures.append(F.max(F.when(reached, F.col(length))).alias(f"N{share}"))
        measures.append(F.min(F.when(reached, count)).cast("bigint").alias(f"L{share}"))
    return ranked.groupBy(*keys).agg(*measures)


def benjamini_hochberg(df: DataFrame, p: str, q: str, sets: Sequence[str] = ()) -> DataFrame:
    """Add false-discovery-rate values ``q`` to ``df``, one correction per combination of ``sets``.

    Equal p-values share one q-value, so the distinct p-values with their counts are scanned: ranks as a
    running sum, then the minimum of p m / rank from the largest p-value down. The rows are worked out
    once and kept, since counts and result both read them.
    """
    keys = list(sets)
    df = durable(df)
    levels = df.groupBy(*keys, p).agg(F.count(F.lit(1)).alias("_ties"))
    parts = range_parts(levels, [p], keys)
    ranked = running(parts, [p], {"_rank": F.col("_ties")}, keys)
    totals = parts.groupBy(*keys).agg(F.sum("_ties").alias("_m"))
    ranked = ranked.join(totals, keys) if keys else ranked.withColumn("_m", totals.scalar())
    rates = ranked.withColumn("_rate", F.col(p) * F.col("_m") / F.col("_rank"))
    lowest = running(rates, [F.col(p).desc()], {"_low": F.col("_rate")}, keys, "min", backwards=True)
    return df.join(lowest.select(*keys, p, F.least(F.lit(1.0), "_low").alias(q)), [*keys, p])


def first_by(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """First row per key in ``order``: an aggregate with map-side combine instead of a window."""
    return df.groupBy(*keys).agg(F.min_by(F.struct(*values), order).alias("_r")).select(*keys, "_r.*")


def last_by(df: DataFrame, keys: Sequence[str], order: str, values: Sequence[str]) -> DataFrame:
    """Last row per key in ``order``, for inputs where a later line replaces an earlier one."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*values), order).alias("_r")).select(*keys, "_r.*")
