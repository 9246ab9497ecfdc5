"""Binned tracks along sequences: coverage, depth, methylation, class shares and repeat totals."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import covered_length, merge_intervals, tile_windows, windowed_sum

# Repeat categories and the text that marks them in a repeat line.
REPEAT_CATEGORIES = {
    "DNA Transposons": "DNA",
    "SINEs": "SINE",
    "LINE": "LINE",
    "LTR": "LTR",
    "Unknown": "Unknown",
    "Satellite": "Satellite",
    "Simple_repeat": "Simple_repeat",
}

# Bin widths of the coverage tracks by kind of feature.
TRACK_BINS = {"mRNA": 5_000, "CDS": 100_000, "tRNA": 100_000, "repeat": 5_000, "sRNA": 500_000, "pseudogene": 100_000}


def binned_coverage(features: DataFrame, bin_size: int, keys: Sequence[str] = ("seqid",)) -> DataFrame:
    """Share of each fixed bin covered by at least one feature; bins without coverage are absent.

    Features are united first, so a base counts once, and each united stretch is cut at bin
    borders; single bases are never listed.
    """
    keys = list(keys)
    merged = merge_intervals(features, keys)
    first, last = F.floor(F.col("start0") / bin_size), F.floor((F.col("end0") - 1) / bin_size)
    pieces = merged.select(*keys, "start0", "end0", F.explode(F.sequence(first, last)).alias("_b"))
    low = F.col("_b") * bin_size
    inside = F.least(F.col("end0"), low + bin_size) - F.greatest(F.col("start0"), low)
    return pieces.groupBy(*keys, low.cast("bigint").alias("start")).agg(F.sum(inside).alias("covered_bp")).select(
        *keys, "start", (F.col("start") + bin_size - 1).alias("end"), "covered_bp", (F.col("covered_bp") / bin_size).alias("fraction"))


def track_intervals(features: DataFrame, kind: str) -> DataFrame:
    """Intervals of one coverage track from annotation rows, on the position numbers as written.

    Gene and coding tracks take the matching feature types, the others take every row.
    """
    rows = features.filter(F.col("type").contains(kind)) if kind in ("mRNA", "CDS") else features
    return rows.select("seqid", F.col("start").alias("start0"), (F.col("end") + 1).alias("end0"))


def windowed_depth(depth: DataFrame, bin_size: int = 10_000, row_order: str = "_row") -> DataFrame:
    """Summed depth over bin width; of a repeated position the last row counts."""
    single = depth.groupBy("seqid", "pos").agg(F.max_by("depth", row_order).alias("depth"))
    start = (F.floor(F.col("pos") / bin_size) * bin_size).cast("bigint")
    return single.groupBy("seqid", start.alias("start")).agg((F.sum("depth") / bin_size).alias("value")).select(
        "seqid", "start", (F.col("start") + bin_size - 1).alias("end"), "value")


def windowed_methylation(sites: DataFrame, bin_size: int = 100_000, row_order: str | Column = "_row") -> DataFrame:
    """Mean methylation level of the positions in each bin; of a repeated position the last row counts."""
    level = F.try_divide(F.col("methylated"), F.col("total"))
    single = sites.groupBy("seqid", "pos").agg(F.max_by(level, row_order).alias("level"))
    start = (F.floor(F.col("pos") / bin_size) * bin_size).cast("bigint")
    return single.groupBy("seqid", start.alias("start")).agg(F.avg("level").alias("value")).select(
        "seqid", "start", (F.col("start") + bin_size - 1).alias("end"), "value")


def class_distribution(features: DataFrame, bin_size: int = 500_000, mode: str = "start_bin") -> DataFrame:
    """Length share of each class per bin.

    ``start_bin`` books a feature's whole length where it starts (the share can exceed 1);
    ``clipped`` cuts it at bin borders.
    """
    if mode == "start_bin":
        cells = features.select(
            "seqid", "class", (F.floor(F.col("start0") / bin_size) * bin_size).cast("bigint").alias("start"),
            (F.col("end0") - F.col("start0")).alias("bp"))
    else:
        rows = features.filter("end0 > start0").select("seqid", "class", "start0", "end0", F.explode(F.sequence(
            F.floor(F.col("start0") / bin_size), F.floor((F.col("end0") - 1) / bin_size))).alias("_b"))
        low = F.col("_b") * bin_size
        cells = rows.select("seqid", "class", low.cast("bigint").alias("start"), (
            F.least("end0", low + bin_size) - F.greatest("start0", low)).alias("bp"))
    return cells.groupBy("seqid", "class", "start").agg(F.sum("bp").alias("bp")).select(
        "seqid", "class", "start", (F.col("start") + bin_size - 1).alias("end"), (F.col("bp") / bin_size).alias("fraction"))


def repeat_labels(line: Column) -> Column:
    """All categories a repeat line belongs to; every line belongs to ``all repeat``."""
    marks = [F.when(line.contains(mark), F.lit(name)) for name, mark in REPEAT_CATEGORIES.items()]
    return F.array_compact(F.array(F.lit("all repeat"), *marks))


def category_coverage(intervals: DataFrame, genome_size: float, labels: Column, categories: Sequence[str] | None = None) -> DataFrame:
    """Distinct covered bases per category and their percentage of the genome.

    ``labels`` is an array column of the categories of a row. Listed categories without a row
    are reported with zero.
    """
    tagged = intervals.select("seqid", "start0", "end0", F.explode(labels).alias("category"))
    covered = covered_length(tagged, ["category", "seqid"], by=["category"])
    if categories is not None:
        zero = covered.sparkSession.createDataFrame([(c, 0) for c in categories], "category string, covered_bp bigint")
        covered = covered.unionByName(zero).groupBy("category").agg(F.sum("covered_bp").alias("covered_bp"))
    percent = F.col("covered_bp") / genome_size * 100 if genome_size > 0 else F.lit(0.0)
    return covered.select("category", F.col("covered_bp").alias("coverage_bp"), percent.alias("coverage_percent"))


def tile_depth(lengths: DataFrame, depth: DataFrame, width: int = 100_000, step: int | None = None) -> DataFrame:
    """Total and mean depth per tile window; windows without depth are listed with zero."""
    sums = windowed_sum(depth, ["depth"], width, step).select("seqid", "start0", F.col("depth").alias("total_depth"))
    tiles = tile_windows(lengths, width, step).join(sums, ["seqid", "start0"], "left").na.fill(0, ["total_depth"])
    return tiles.withColumn("mean_depth", F.col("total_depth") / (F.col("end0") - F.col("start0")))


def gc_depth(depth_tiles: DataFrame, gc_tiles: DataFrame) -> DataFrame:
    """GC share against mean depth per window."""
    return depth_tiles.select("seqid", "start0", "end0", "mean_depth").join(gc_tiles.select("seqid", "start0", "gc"), ["seqid", "start0"])


def contaminated_contigs(hits: DataFrame, lengths: DataFrame, min_fraction: float = 0.5) -> DataFrame:
    """Contigs whose united hits to one lineage cover at least ``min_fraction`` of them.

    ``hits`` has seqid, start0, end0 and lineage.
    """
    covered = covered_length(hits, ["seqid", "lineage"])
    rated = covered.join(lengths.select("seqid", "length"), "seqid").withColumn("hit_fraction", F.col("covered_bp") / F.col("length"))
    return rated.filter(F.col("hit_fraction") >= min_fraction).select("seqid", "lineage", "covered_bp", "length", "hit_fraction")


def without_contigs(sequences: DataFrame, excluded: DataFrame) -> DataFrame:
    """Sequences that are not listed."""
    return sequences.join(excluded.select("seqid").distinct(), "seqid", "left_anti")
