"""Assembly quality reports of a whole cohort at once.

Input is one row per report file (path, text); the output has rows for every file.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import to_double

BUSCO_COLUMNS = (
    "sample", "input_file", "mode", "lineage", "busco_version", "complete_percent", "single_copy_percent", "duplicated_percent", "fragmented_percent",
    "missing_percent", "complete_count", "single_copy_count", "duplicated_count", "fragmented_count", "missing_count", "total_buscos", "summary_file",
)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def busco_summary(reports: DataFrame, mode: str | None = None, lineage: str | None = None, input_file: str | None = None) -> DataFrame:
    """Completeness figures of text and JSON reports in one table."""
    text = F.col("text")

    def found(pattern: str) -> Column:
        value = F.regexp_extract(text, pattern, 1)
        return F.when(value != "", value)

    def line_count(label: str) -> Column:
        return found(rf"(?m)^\s*(\d+)\s+{label}")

    def json(*paths: str) -> Column:
        return F.coalesce(*[F.get_json_object(text, p) for p in paths])

    def result(*names: str) -> Column:
        return json(*[f"$.results['{n}']" for n in names], *[f"$['{n}']" for n in names])

    shares = r"C:([0-9.]+)%\[S:([0-9.]+)%,D:([0-9.]+)%\],F:([0-9.]+)%,M:([0-9.]+)%,n:(\d+)"
    share = lambda i: F.when(F.regexp_extract(text, shares, i) != "", F.regexp_extract(text, shares, i))
    from_text = {
        "lineage": found(r"(?i)lineage dataset[^:\n]*:\s*(\S+)"), "busco_version": found(r"BUSCO version[^:\n]*:\s*([^\n]*\S)"),
        "complete_percent": share(1), "single_copy_percent": share(2), "duplicated_percent": share(3), "fragmented_percent": share(4),
        "missing_percent": share(5), "complete_count": line_count("Complete BUSCOs"), "single_copy_count": line_count("Complete and single-copy BUSCOs"),
        "duplicated_count": line_count("Complete and duplicated BUSCOs"), "fragmented_count": line_count("Fragmented BUSCOs"),
        "missing_count": line_count("Missing BUSCOs"), "total_buscos": F.coalesce(line_count("Total BUSCO groups searched"), share(6)),
    }
    from_json = {
        "lineage": json("$.lineage_dataset", "$.lineage"), "busco_version": json("$.busco_version", "$.version"),
        "complete_percent": result("Complete percentage", "C"), "single_copy_percent": result("Single copy percentage", "S"),
        "duplicated_percent": result("Multi copy percentage", "D"), "fragmented_percent": result("Fragmented percentage", "F"),
        "missing_percent": result("Missing percentage", "M"), "complete_count": result("Complete BUSCOs"), "single_copy_count": result("Single copy BUSCOs"),
        "duplicated_count": result("Multi copy BUSCOs"), "fragmented_count": result("Fragmented BUSCOs"), "missing_count": result("Missing BUSCOs"),
        "total_buscos": result("Total BUSCO groups searched", "n"),
    }
    is_json = F.col("path").endswith(".json")
    sample = F.regexp_replace(F.regexp_replace(file_name(F.col("path")), r"^short_summary(\.specific)?\.", ""), r"\.(json|txt)$", "")
    values = {n: F.when(is_json, from_json[n]).otherwise(from_text[n]) for n in from_text}
    values["lineage"] = F.coalesce(values["lineage"], F.lit(lineage).cast("string"))
    fixed = {"sample": sample, "input_file": F.lit(input_file).cast("string"), "mode": F.lit(mode).cast("string"), "summary_file": F.col("path")}
    return reports.select(*[({**values, **fixed}[c]).alias(c) for c in BUSCO_COLUMNS])


def lai_grade(score: Column) -> Column:
    """Quality word of an assembly index value."""
    return F.when(score >= 20, "gold").when(score >= 10, "reference").when(score >= 5, "draft").when(score.isNotNull(), "low")


def _lines(reports: DataFrame) -> DataFrame:
    return reports.select("path", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line")).withColumn("line", F.trim("line")).filter("line <> ''")


def lai_summary(reports: DataFrame, sample: str = "genome") -> DataFrame:
    """Assembly index rows per region; a file without any row is reported as missing.

    A header line is a comment that names the LAI column; the last one before a row names the
    row's columns when their numbers agree.
    """
    def header(line: Column) -> Column:
        clean = F.trim(F.regexp_replace(line, "^#+", ""))
        return F.when(line.startswith("#") & clean.rlike(r"\bLAI\b") & clean.rlike(r"\s"), F.split(clean, r"\s+"))

    headers = _lines(reports).select("path", "line_no", header(F.col("line")).alias("h")).filter("h is not null")
    per_file = headers.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("line_no", "h"))).alias("_all"))
    rows = _lines(reports).filter(~F.col("line").startswith("#")).join(per_file, "path", "left").select(
        "path", "line_no", F.split("line", r"\s+").alias("c"),
        F.element_at(F.concat(F.array(F.lit(None).cast("array<string>")), F.transform(
            F.filter(F.coalesce("_all", F.array().cast("array<struct<line_no:int,h:array<string>>>")), lambda x: x["line_no"] < F.col("line_no")),
            lambda x: x["h"])), -1).alias("h"))
    named = F.when(F.size("h") == F.size("c"), F.map_from_arrays("h", "c"))
    rows = rows.filter(F.size("c") >= 2).withColumn("_m", named).withColumn("_n", F.filter("c", lambda v: to_double(v).isNotNull())).filter(F.size("_n") > 0)

    def pick(*names: str) -> Column:
        return F.coalesce(*[F.nullif(F.try_element_at("_m", F.lit(n)), F.lit("")) for n in names])

    raw, neutral = pick("raw_LAI", "Raw_LAI", "raw_lai"), pick("neutral_LAI", "Neutral_LAI", "neutral_lai")
    number_at = lambda i, n: F.when((F.size("c") > n) & to_double(F.get("c", F.lit(i))).isNotNull(), F.get("c", F.lit(i)))
    score = F.coalesce(pick("LAI", "lai"), neutral, F.element_at("_n", -1))
    out = rows.select(
        F.lit(sample).alias("sample"), F.coalesce(pick("Chr", "chr", "region", "Region"), F.get("c", F.lit(0))).alias("region"),
        F.coalesce(pick("Start", "start"), number_at(1, 2)).alias("start"), F.coalesce(pick("End", "end"), number_at(2, 3)).alias("end"),
        raw.alias("raw_lai"), neutral.alias("neutral_lai"), score.alias("lai_score"), lai_grade(to_double(score)).alias("quality_status"),
        F.col("path").alias("lai_file"))
    nothing = F.lit(None).cast("string")
    filled = reports.filter(F.length("text") > 0)
    empty = filled.join(out.select(F.col("lai_file").alias("path")), "path", "left_anti").select(
        F.lit(sample).alias("sample"), *[nothing.alias(c) for c in ("region", "start", "end", "raw_lai", "neutral_lai", "lai_score")],
        F.lit("missing").alias("quality_status"), F.col("path").alias("lai_file"))
    return out.unionByName(empty)


def merqury_summary(reports: DataFrame, sample: str = "genome") -> DataFrame:
    """k-mer quality values, completeness and spectra as sample/metric/value rows."""
    name = file_name(F.col("path"))
    kmer = reports.filter((name == "final_kmer.txt") & (F.length("text") > 0)).select(
        F.lit(sample).alias("sample"), F.lit("final_kmer").alias("metric"), F.trim(F.regexp_replace("text", r"\s+$", "")).alias("value"), F.col("path").alias("source_file"))
    rows = _lines(reports.filter(name != "final_kmer.txt")).filter(~F.col("line").startswith("#")).select(
        "path", F.split("line", r"\s+").alias("c")).filter(F.size("c") >= 2)
    first = F.regexp_replace(F.get("c", F.lit(0)), ":+$", "")
    last = F.element_at("c", -1)
    entry = lambda m, v: F.struct(m.alias("metric"), v.alias("value"))
    full = F.array(entry(F.lit("assembly"), F.get("c", F.lit(0))), entry(F.lit("kmer_error_rate"), F.try_element_at("c", F.lit(-2))), entry(F.lit("kmer_qv"), last))
    is_qv = F.col("path").endswith(".qv")
    complete = F.lower(file_name(F.col("path"))).contains("completeness") & (F.size("c") >= 3)
    plain = F.when(complete & ~is_qv, F.concat(F.get("c", F.lit(0)), F.lit("_completeness"))).otherwise(first)
    entries = F.when(is_qv & (F.size("c") >= 4), full).otherwise(F.array(entry(plain, last)))
    out = rows.select("path", F.inline(entries)).select(F.lit(sample).alias("sample"), "metric", "value", F.col("path").alias("source_file"))
    return out.unionByName(kmer)
