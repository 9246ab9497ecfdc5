"""Writers. Each writes a folder of part files in parallel; nothing passes through the driver."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import wrapped
from ..operators.scans import PART, range_parts, running

# Drawing colours of repeat classes, by the text that marks the class in a line.
REPEAT_COLOURS = {
    "LINE/": "#3399ff",
    "SINE/": "#800080",
    "DNA/": "#ff6666",
    "LTR/": "#00cc44",
    "RC/": "#ff6600",
    "Low_complexity": "#d1d1e0",
    "Satellite": "#ff99ff",
    "Simple_repeat": "#8686ac",
}
OTHER_REPEAT_COLOUR = "#f2f2f2"


def write_table(df: DataFrame, path: str, columns: Sequence[str] | None = None, form: str = "tsv", mode: str = "errorifexists") -> None:
    """Fixed columns; in text form absent columns and missing values become NA."""
    columns = list(columns or df.columns)
    if form == "parquet":
        df.select(*columns).write.mode(mode).parquet(path)
        return
    cells = [F.coalesce(F.nullif(F.col(f"`{c}`").cast("string"), F.lit("")), F.lit("NA")) if c in df.columns else F.lit("NA") for c in columns]
    df.select(*[v.alias(c) for v, c in zip(cells, columns)]).write.mode(mode).csv(path, sep="\t", header=True, escape='"', quote='"')


def fasta_text(seqid: Column, seq: Column, width: int = 60) -> Column:
    """One record as text lines."""
    return F.concat(F.lit(">"), seqid.cast("string"), F.lit("\n"), wrapped(seq, width))


def natural_order(name: str) -> list[Column]:
    """Sort columns that put chr2 before chr10: text before the first number, that number, then the whole name."""
    number = F.regexp_extract(name, r"^\D*0*(\d{1,38})", 1)
    return [F.regexp_extract(name, r"^(\D*)", 1), F.when(number != "", number.cast("decimal(38,0)")).otherwise(-1), F.col(name)]


def genomic_order(df: DataFrame, natural: bool = False) -> list[Column]:
    """Sort columns of located rows: sequence, start, end and the names the table has."""
    sequence = natural_order("seqid") if natural else [F.col("seqid")]
    return sequence + [F.col(c) for c in ("start0", "start", "end0", "end", "region_id", "feature_id", "transcript_id", "id", "name") if c in df.columns]


def count_order(count: str, *keys: str) -> list[Column]:
    """Sort columns of a tally: largest counts first, then the keys."""
    return [F.col(count).desc(), *[F.col(k) for k in keys]]


def numbered(df: DataFrame, order: Sequence[str | Column], name: str = "row_number") -> DataFrame:
    """Rows with their number in the order, from 1: counted by ranges of the order, so no task holds the table.

    The order must settle every pair of rows; of equal rows either may come first.
    """
    return running(range_parts(df, order), order, {name: F.lit(1).cast("bigint")}).drop(PART)


def in_order(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in a total order over part files: each part is sorted, and the parts' names follow the order."""
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def write_fasta(sequences: DataFrame, path: str, width: int = 60, mode: str = "errorifexists", order: Sequence[str | Column] | None = None) -> None:
    """Records wrapped at ``width``, in ``order`` across part files or as the rows are given; part files concatenated are one file."""
    rows = in_order(sequences, order) if order else sequences
    rows.select(fasta_text(F.col("seqid"), F.col("seq"), width)).write.mode(mode).text(path)


def bed_text(df: DataFrame, name: Column, score: Column, strand: Column | None = None) -> DataFrame:
    cells = [F.col("seqid"), F.col("start0"), F.col("end0"), name, score, strand if strand is not None else F.col("strand")]
    return df.select(F.concat_ws("\t", *[F.coalesce(c.cast("string"), F.lit("NA")) for c in cells]).alias("value"))


def intron_bed(introns: DataFrame) -> DataFrame:
    """BED lines of introns: transcript and number as name, length as score."""
    return bed_text(introns, F.concat(F.col("transcript_id"), F.lit(".intron"), F.col("intron_number").cast("string")), F.col("length"))


def write_counts(df: DataFrame, path: str, count: str, keys: Sequence[str], columns: Sequence[str] | None = None, mode: str = "errorifexists") -> None:
    """A tally as text table, largest counts first across part files."""
    write_table(in_order(df, count_order(count, *keys)), path, columns, mode=mode)


def write_bed(df: DataFrame, path: str, name: str = "region_id", score: Column | None = None, mode: str = "errorifexists", natural: bool = False) -> None:
    """BED6, sorted by place across part files; ``natural`` sorts chr2 before chr10."""
    ordered = in_order(df, [*(natural_order("seqid") if natural else ["seqid"]), "start0", "end0", name])
    bed_text(ordered, F.col(name), F.lit(0) if score is None else score).write.mode(mode).text(path)


def write_lines(df: DataFrame, column: str, path: str, mode: str = "errorifexists") -> None:
    """One value per line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode(mode).text(path)


def write_lists(df: DataFrame, keys: Sequence[str], line: Column, path: str, mode: str = "errorifexists") -> None:
    """One folder per key with one line per row, for member lists of families, species or nodes."""
    df.select(*keys, line.cast("string").alias("value")).write.mode(mode).partitionBy(*keys).text(path)


def write_ordered_lines(df: DataFrame, line: str, order: str, path: str, mode: str = "errorifexists") -> None:
    """Lines in a given order across part files."""
    in_order(df, [order]).select(F.col(line).alias("value")).write.mode(mode).text(path)


def partition_lines(partitions: DataFrame) -> DataFrame:
    """Gene ranges of a supermatrix as ``gene = start-end``."""
    return partitions.select(F.format_string("%s = %d-%d", "gene", "start", "end").alias("value"))


def field_values(df: DataFrame) -> DataFrame:
    """A one-row summary as field/value rows."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).unpivot([], df.columns, "field", "value")


def repeat_gff(repeats: DataFrame) -> DataFrame:
    """Repeat annotation as GFF3 lines with a colour per class; a line marked for two classes appears in both."""
    c = F.col("c")
    at = lambda i: F.get(c, F.lit(i))
    forward = F.col("strand") != "-"
    target = F.concat_ws(" ", at(9), at(10), F.when(forward, at(11)).otherwise(at(13)), at(12))
    notes = F.concat(F.lit("Div="), at(1), F.lit(";Del="), at(2), F.lit(";Ins="), at(3), F.lit(";SWscore="), at(0))
    plain = F.concat_ws("\t", at(4), F.lit("RepeatMasker-4.0.1"), F.lit("similarity"), at(5), at(6), at(0), F.col("strand"), F.lit("."),
                        F.concat(F.lit("Target="), target, F.lit(";"), notes))
    marked = [(F.col("_p").contains(mark), F.lit(colour)) for mark, colour in REPEAT_COLOURS.items()]
    colours = F.when(reduce(or_, [m for m, _ in marked]), F.array_compact(F.array(*[F.when(m, colour) for m, colour in marked]))).otherwise(F.array(F.lit(OTHER_REPEAT_COLOUR)))
    # The line is made once and looked through for every mark.
    lines = repeats.select(F.explode(F.array(plain)).alias("_p"))
    return lines.select("_p", F.explode(colours).alias("_c")).select(F.concat("_p", F.lit(";color="), "_c").alias("value"))


def trim_read_names(regions: DataFrame, name: str = "region_id") -> DataFrame:
    """Regions of paired reads under the read's name: the mate suffix, two characters, is cut off."""
    return regions.withColumn(name, F.substring(F.col(name), F.lit(1), F.greatest(F.length(name) - 2, F.lit(0))))
