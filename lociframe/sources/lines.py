"""Text lines with a stable order, header tables and id lists."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import MISSING, present

#: File paths, or lines that are already a frame (path, line, ``_row``), as ``read_lines`` returns them.
Paths = str | Sequence[str] | DataFrame

#: Parts into which the lines of a split are dealt where they meet what was counted for it.
SHARES = 64


def path_list(paths: Paths) -> list[str]:
    return [paths] if isinstance(paths, str) else list(paths)


def read_lines(spark: SparkSession, paths: Paths, line_separator: str | None = None) -> DataFrame:
    """Lines (path, line, ``_row``) of plain or gzip files, carriage returns removed; lines given as a frame are taken as they are.

    ``_row`` orders lines as they stand in the file, across the splits of a large file.
    """
    if isinstance(paths, DataFrame):
        return paths.select("path", "line", "_row")
    reader = spark.read
    if line_separator:
        reader = reader.option("lineSep", line_separator)
    lines = reader.text(path_list(paths)).select("value", "_metadata.file_path", "_metadata.file_block_start")
    order = F.struct(F.col("file_path").alias("path"), F.col("file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return lines.select(F.col("file_path").alias("path"), F.regexp_replace("value", "\r$", "").alias("line"), order.alias("_row"))


def data_lines(lines: DataFrame, comment: str = "#") -> DataFrame:
    """Lines that are neither blank nor comments."""
    return lines.filter((F.trim("line") != "") & ~F.col("line").startswith(comment))


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Add the 1-based line number within each file.

    Lines of one split are numbered consecutively by the reader, so only one count per split has
    to be added up. The lines of a split are dealt over ``SHARES`` copies of its count, so a split of any size
    (of lines given as a frame) is no single task's.
    """
    keys = ["path", F.col("_row.block").alias("_block")]
    splits = lines.groupBy(*keys).agg(F.min("_row.line").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    spread = offsets.select("path", "_block", "_first", "_before", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SHARES - 1).cast("bigint"))).alias("_share"))
    dealt = lines.withColumn("_block", F.col("_row.block")).withColumn("_share", F.pmod(F.xxhash64("_row.line"), F.lit(SHARES).cast("bigint")))
    # One row per key and a left join: where nobody reads the numbers, Spark leaves the join out.
    single = spread.groupBy("path", "_block", "_share").agg(F.min("_first").alias("_first"), F.min("_before").alias("_before"))
    numbered = dealt.join(single, ["path", "_block", "_share"], "left")
    return numbered.withColumn("line_number", F.col("_before") + F.col("_row.line") - F.col("_first") + 1).drop("_block", "_share", "_first", "_before")


def cell(cells: Column, index: int) -> Column:
    """Cell of a split line, NULL where the line is shorter."""
    return F.get(cells, F.lit(index))


def text_cell(cells: Column, index: int) -> Column:
    """Cell of a split line, NULL where it is absent, empty or NA."""
    return present(cell(cells, index), MISSING)


def split_tabs(lines: DataFrame, least: int = 1) -> DataFrame:
    """Lines split at tabs into ``c``; shorter ones are left out. Exploded, so that a line is split once and not again for each filter."""
    return lines.select("*", F.explode(F.array(F.split("line", "\t"))).alias("c")).filter(F.size("c") >= least)


def header_of(lines: DataFrame, chooser: Column | None = None) -> list[str]:
    """Column names from the first line (or the first that satisfies ``chooser``) of the first file."""
    rows = lines if chooser is None else lines.filter(chooser)
    first = rows.agg(F.min_by("line", "_row").alias("line")).first()["line"]
    if first is None:
        raise ValueError("no header line found")
    return first.lstrip("#").split("\t")


def read_table(spark: SparkSession, paths: Paths, ordered: bool = False) -> DataFrame:
    """Header TSV with quoted cells; NA and empty cells are NULL, all columns text.

    ``ordered`` adds ``_row`` for inputs where the order of lines decides. An empty input is an
    error.
    """
    table = spark.read.csv(path_list(paths), sep="\t", header=True, escape='"', nullValue="NA", quote='"')
    if not table.columns:
        raise ValueError(f"no header in {paths}")
    table = table.select(*[F.regexp_replace(F.col(f"`{c}`"), "\r$", "").alias(c.rstrip("\r")) for c in table.columns],
                         *([F.struct(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                                     F.monotonically_increasing_id().alias("line")).alias("_row")] if ordered else []))
    return table


def read_ids(spark: SparkSession, paths: Paths, name: str = "gene_id") -> DataFrame:
    """Distinct first words of the lines; comment lines are skipped."""
    words = data_lines(read_lines(spark, paths)).select(F.get(F.split(F.trim("line"), r"\s+"), F.lit(0)).alias(name))
    return words.distinct()


def require_rows(df: DataFrame, label: str) -> DataFrame:
    """The table itself; an empty one is an error."""
    if df.isEmpty():
        raise ValueError(f"empty {label}")
    return df


def read_manifest(spark: SparkSession, path: str, required: Sequence[str]) -> list[dict[str, str | None]]:
    """Manifest rows. A manifest names files, so it is read on the driver; missing columns are an error."""
    table = read_table(spark, path)
    lost = sorted(set(required) - set(table.columns))
    if lost:
        raise ValueError("manifest lacks columns: " + ", ".join(lost))
    return [r.asDict() for r in table.collect()]


def union_species(frames: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Tables of several species as one, with a ``species`` column."""
    if not frames:
        raise ValueError("no input given")
    return reduce(DataFrame.unionByName, [df.drop("species").withColumn("species", F.lit(s)) for s, df in frames])
