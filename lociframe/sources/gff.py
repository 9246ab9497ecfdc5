"""GFF3/GTF annotation and BED regions."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import first_present, present, to_long
from .lines import Paths, cell, data_lines, read_lines, read_table, split_tabs, with_line_numbers


def parse_attributes(text: Column) -> Column:
    """Attribute map of ``key=value`` or ``key "value"`` parts; the last of a repeated key counts."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda p: F.trim(p)), lambda p: p.contains("=") | p.contains(" "))
    entries = F.transform(parts, lambda p: F.when(
        p.contains("="), F.struct(F.substring_index(p, "=", 1).alias("k"), F.substring(p, F.instr(p, "=") + 1, F.length(p)).alias("v"))
    ).otherwise(F.struct(F.regexp_extract(p, r"^(\S*) ", 1).alias("k"), F.regexp_replace(F.regexp_extract(p, r"(?s)^\S* (.*)$", 1), r'^[\s"]+|[\s"]+$', "").alias("v"))))

    def latest(found: Column) -> Column:
        # Later entries replace earlier ones without depending on the session's map policy.
        keys = F.array_distinct(F.transform(found, lambda e: e["k"]))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: F.element_at(F.filter(found, lambda e: e["k"] == k), -1)["v"]))

    # Under a name of their own the entries are found once, not once for each key.
    return F.get(F.transform(F.array(entries), latest), F.lit(0))


def read_gff(spark: SparkSession, paths: Paths, species: str = "genome") -> DataFrame:
    """Annotation features with attribute map, id and parent list; lines with fewer than nine columns are skipped.

    ``line`` keeps the text and ``line_number`` the place in the file.
    """
    lines = split_tabs(data_lines(with_line_numbers(read_lines(spark, paths))), 9)
    attrs = parse_attributes(cell(F.col("c"), 8))
    rows = lines.select(
        F.lit(species).alias("species"), cell(F.col("c"), 0).alias("seqid"), cell(F.col("c"), 1).alias("source"), cell(F.col("c"), 2).alias("type"),
        to_long(cell(F.col("c"), 3)).alias("start"), to_long(cell(F.col("c"), 4)).alias("end"), cell(F.col("c"), 5).alias("score"),
        cell(F.col("c"), 6).alias("strand"), cell(F.col("c"), 7).alias("phase"), F.explode(F.array(attrs)).alias("attrs"), cell(F.col("c"), 8).alias("attributes"),
        "line", "line_number", "_row")  # exploded, so that attributes are parsed once and not again for each filter on ids and parents
    parents = F.filter(F.split(F.coalesce(F.try_element_at("attrs", F.lit("Parent")), F.lit("")), ","), lambda p: p != "")
    return rows.select("*", F.nullif(F.try_element_at("attrs", F.lit("ID")), F.lit("")).alias("id"), parents.alias("parents"))


def overlap_features(features: DataFrame, types: Sequence[str] | None = None) -> DataFrame:
    """Annotation features as intervals for overlap work; ID, then Name, then type and line number name them."""
    rows = features.filter(F.col("type").isin(*types)) if types else features
    name = F.nullif(F.try_element_at("attrs", F.lit("Name")), F.lit(""))
    return rows.filter("start is not null and end is not null and end >= start").select(
        "seqid", F.greatest(F.lit(0), F.col("start") - 1).cast("bigint").alias("start0"), F.col("end").alias("end0"), F.col("type").alias("ftype"),
        F.coalesce("id", name, F.concat_ws("_", "type", F.col("line_number").cast("string"))).alias("feature_id"))


def read_bed(spark: SparkSession, paths: Paths, label: str = "region", region_set: str | None = None) -> DataFrame:
    """Regions (region_set, region_id, seqid, start0, end0, score, strand).

    Lines with fewer than three columns, bad numbers or no length are skipped; unnamed regions
    are called after ``label`` and their line number.
    """
    lines = split_tabs(data_lines(with_line_numbers(read_lines(spark, paths))), 3)
    c = F.col("c")
    named = present(cell(c, 3), ("",))
    rows = lines.select(
        F.lit(region_set or label).alias("region_set"), F.coalesce(named, F.concat(F.lit(f"{label}_"), F.col("line_number").cast("string"))).alias("region_id"),
        cell(c, 0).alias("seqid"), to_long(cell(c, 1)).alias("start0"), to_long(cell(c, 2)).alias("end0"), cell(c, 4).alias("score"),
        F.coalesce(cell(c, 5), F.lit("+")).alias("strand"))
    return rows.filter("start0 is not null and end0 is not null and end0 > start0")


def bed_features(regions: DataFrame) -> DataFrame:
    """BED regions in the role of features."""
    return regions.select("seqid", "start0", "end0", F.lit("BED_feature").alias("ftype"), F.col("region_id").alias("feature_id"))


REGION_COLUMNS = ("region_id", "seqid", "start0", "end0", "strand", "source", "region_type", "score", "attributes")


def standardize_regions(
    spark: SparkSession, paths: Paths, form: str, source: str = "external_caller", region_type: str = "region", types: Sequence[str] | None = None
) -> DataFrame:
    """Region calls of any caller in one shape. ``form`` is bed, gff or tsv.

    A table with a ``start0`` column is 0-based, one with ``start`` 1-based.
    """
    def unnamed(number: Column) -> Column:
        return F.concat(F.lit(f"{region_type}_"), number.cast("string"))

    nothing = F.lit(None).cast("string")
    if form == "bed":
        lines = split_tabs(data_lines(with_line_numbers(read_lines(spark, paths))), 3)
        c = F.col("c")
        rows = lines.select(
            F.coalesce(present(cell(c, 3), ("",)), unnamed(F.col("line_number"))).alias("region_id"), cell(c, 0).alias("seqid"), to_long(cell(c, 1)).alias("start0"),
            to_long(cell(c, 2)).alias("end0"), cell(c, 5).alias("strand"), F.lit(source).alias("source"), F.lit(region_type).alias("region_type"),
            cell(c, 4).alias("score"), nothing.alias("attributes"))
    elif form == "gff":
        features = read_gff(spark, paths)
        if types:
            features = features.filter(F.col("type").isin(*types))
        dot = ("", ".")
        rows = features.select(
            F.coalesce("id", F.nullif(F.try_element_at("attrs", F.lit("Name")), F.lit("")), unnamed(F.col("line_number"))).alias("region_id"), "seqid",
            F.greatest(F.lit(0), F.col("start") - 1).cast("bigint").alias("start0"), F.col("end").alias("end0"), "strand",
            F.coalesce(present(F.col("source"), dot), F.lit(source)).alias("source"), F.coalesce(present(F.col("type"), dot), F.lit(region_type)).alias("region_type"),
            present(F.col("score"), dot).alias("score"), "attributes")
    elif form == "tsv":
        table = read_table(spark, paths, ordered=True)
        zero_based = "start0" in table.columns
        start = to_long(first_present(table, ["start0", "start"]))
        number = F.col("_row.line") + 1
        rows = table.select(
            F.coalesce(first_present(table, ["region_id", "id", "ID"]), unnamed(number)).alias("region_id"), first_present(table, ["seqid", "chrom", "chromosome"]).alias("seqid"),
            (start if zero_based else F.greatest(F.lit(0), start - 1).cast("bigint")).alias("start0"), to_long(first_present(table, ["end"])).alias("end0"),
            first_present(table, ["strand"]).alias("strand"), first_present(table, ["source"], source).alias("source"),
            first_present(table, ["region_type"], region_type).alias("region_type"), first_present(table, ["score"]).alias("score"),
            first_present(table, ["attributes"]).alias("attributes")).filter("seqid is not null and start0 is not null and end0 is not null")
    else:
        raise ValueError("form must be bed, gff or tsv")
    return rows.select(*REGION_COLUMNS)
