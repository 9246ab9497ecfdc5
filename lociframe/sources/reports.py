"""Outputs of annotation, similarity, repeat, methylation, synteny and family tools."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import first_present, present, split_members, to_double, to_long
from ..operators.scans import PART, range_parts
from ..operators.synteny import pair_label
from .lines import Paths, cell, data_lines, header_of, path_list, read_lines, read_table, split_tabs, text_cell, with_line_numbers

OUTFMT6 = ("query_id", "subject_id", "pident", "length", "mismatch", "gapopen", "qstart", "qend", "sstart", "send", "evalue", "bitscore")


def read_hits(spark: SparkSession, paths: Paths) -> DataFrame:
    """Twelve-column similarity hits with typed numbers; ``line`` keeps the text."""
    lines = split_tabs(data_lines(read_lines(spark, paths)), 12)
    c = F.col("c")
    text = {"query_id": 0, "subject_id": 1}
    rows = lines.select(
        *[cell(c, i).alias(n) for n, i in text.items()], *[(to_double if n in ("pident", "evalue", "bitscore") else to_long)(cell(c, i)).alias(n)
                                                           for i, n in enumerate(OUTFMT6) if n not in text], "line", "_row")
    return rows.filter("evalue is not null and bitscore is not null")


def read_best_hits(spark: SparkSession, paths: Paths) -> DataFrame:
    """Hits for annotation: subject, and the last column as description when there are more than twelve."""
    lines = split_tabs(data_lines(read_lines(spark, paths)), 2)
    c = F.col("c")
    return lines.select(cell(c, 0).alias("query_id"), cell(c, 1).alias("subject_id"), F.when(F.size(c) > 12, F.element_at(c, -1)).alias("description"), "_row")


DOMAIN_COLUMNS = {
    "Query_id": 0, "Subject_id": 4, "Subject_DB": 3, "Query_start": 6, "Query_end": 7, "E_value": 8, "Subject_annotation": 5, "InterPro_id": 11,
    "InterPro_annotation": 12, "GO_terms": 13,
}


def read_interproscan(spark: SparkSession, paths: Paths) -> DataFrame:
    """Domain hits in ten named columns; short lines are filled with NULL."""
    lines = split_tabs(data_lines(read_lines(spark, paths)))
    return lines.select(*[text_cell(F.col("c"), i).alias(n) for n, i in DOMAIN_COLUMNS.items()])


def pfam_domains(domains: DataFrame) -> DataFrame:
    """The Pfam rows of a domain table, as input of ``terms.domain_architecture``."""
    return domains.filter("Subject_DB = 'Pfam' and Query_id is not null and Subject_id is not null").select(
        F.col("Query_id").alias("query_id"), F.col("Subject_id").alias("domain_id"), F.col("Query_start").alias("start"), F.col("Query_end").alias("end"))


def read_kofam(spark: SparkSession, paths: Paths, keep_all: bool = False) -> DataFrame:
    """Orthology detail rows; a leading star marks the ones that pass."""
    lines = data_lines(read_lines(spark, paths)).withColumn("_c", F.split(F.trim("line"), r"\s+"))
    star = F.get("_c", F.lit(0)) == "*"
    rows = lines.select("_row", star.cast("int").cast("string").alias("pass"), F.when(star, F.slice("_c", F.lit(2), F.size("_c"))).otherwise(F.col("_c")).alias("c")).filter(F.size("c") >= 5)
    c = F.col("c")
    tail = F.array_join(F.slice(c, F.lit(6), F.size(c)), " ")
    table = rows.select(
        cell(c, 0).alias("Query_id"), cell(c, 1).alias("KO"), cell(c, 2).alias("threshold"), cell(c, 3).alias("score"), cell(c, 4).alias("E_value"), "pass",
        F.nullif(tail, F.lit("")).alias("description"), "_row")
    return table if keep_all else table.filter("pass = '1'")


def kofam_hits(table: DataFrame) -> DataFrame:
    """Columns for ``terms.kofam_gene_ko``; rows without a numeric e-value are left out."""
    return table.select(F.col("Query_id").alias("query_id"), F.col("KO").alias("ko"), to_double(F.col("E_value")).alias("evalue"), "_row").filter("evalue is not null")


def read_eggnog(spark: SparkSession, paths: Paths) -> DataFrame:
    """Ortholog annotation with or without its preamble; without a header the columns are named 0, 1, 2, ..."""
    lines = read_lines(spark, paths)
    header = lines.filter(F.col("line").startswith("#") & ~F.col("line").startswith("##"))
    names = None if header.isEmpty() else header_of(header)
    rows = split_tabs(data_lines(lines))
    if names is None:
        width = rows.agg(F.max(F.size("c"))).first()[0] or 0
        names = [str(i) for i in range(width)]
        names = ["query" if i == 0 else "COG_category" if i == 6 else n for i, n in enumerate(names)]
    return rows.select(*[cell(F.col("c"), i).alias(n) for i, n in enumerate(names)], "_row")


def read_cx(spark: SparkSession, paths: Paths, min_coverage: int = 1) -> DataFrame:
    """Methylation sites (seqid, pos0, context, methylated, total, ``_row``) with enough coverage."""
    c = F.col("c")
    lines = split_tabs(data_lines(read_lines(spark, paths)), 6)
    rows = lines.select(
        cell(c, 0).alias("seqid"), to_long(cell(c, 1)).alias("pos"), to_long(cell(c, 3)).alias("methylated"), to_long(cell(c, 4)).alias("_un"),
        context_label(cell(c, 5)).alias("context"), "_row").filter("pos is not null and methylated is not null and _un is not null")
    return rows.select("seqid", "pos", F.greatest(F.lit(0), F.col("pos") - 1).cast("bigint").alias("pos0"), "context", "methylated",
                       (F.col("methylated") + F.col("_un")).alias("total"), "_row").filter(F.col("total") >= min_coverage)


def context_label(raw: Column) -> Column:
    """CG, CHG or CHH of a cytosine context written as a label or as bases."""
    text = F.upper(raw)
    return (
        F.when(text.startswith("CG"), "CG").when(text.startswith("CHG"), "CHG").when(text.startswith("CHH"), "CHH")
        .when(text.rlike("^C.G"), "CHG").when(text.startswith("C"), "CHH").otherwise(present(text, ("",))))


def read_depth(spark: SparkSession, paths: Paths) -> DataFrame:
    """Depth rows (seqid, pos, depth, ``_row``)."""
    lines = data_lines(read_lines(spark, paths)).withColumn("c", F.split(F.trim("line"), r"\s+"))
    c = F.col("c")
    return lines.select(cell(c, 0).alias("seqid"), to_long(cell(c, 1)).alias("pos"), to_double(cell(c, 2)).alias("depth"), "_row").filter("pos is not null and depth is not null")


def read_repeatmasker(spark: SparkSession, paths: Paths) -> DataFrame:
    """Repeat annotation rows; header lines and lines with bad numbers are skipped, C strands become minus."""
    # Exploded, so that a line is made and split once: of plain columns, each filter below would do it again.
    lines = read_lines(spark, paths).select("_row", F.explode(F.array(F.ltrim("line"))).alias("line"))
    header = reduce(or_, [F.col("line").startswith(mark) for mark in ("SW", "score", "perc", "#")])
    rows = lines.filter((F.col("line") != "") & ~header).select("*", F.explode(F.array(F.split(F.rtrim("line"), r"\s+"))).alias("c")).filter(F.size("c") >= 11)
    c = F.col("c")
    kind = F.split(cell(c, 10), "/", 2)
    whole = lambda i: F.when(cell(c, i).rlike(r"^[+-]?\d+$"), cell(c, i).try_cast("bigint"))
    table = rows.select(
        cell(c, 4).alias("seqid"), whole(5).alias("start"), whole(6).alias("end"), F.when(cell(c, 8) == "C", "-").otherwise(cell(c, 8)).alias("strand"),
        cell(c, 9).alias("repeat_name"), F.coalesce(present(F.get(kind, F.lit(0)), ("",)), F.lit("NA")).alias("repeat_class"),
        F.coalesce(F.get(kind, F.lit(1)), F.lit("NA")).alias("repeat_family"), to_double(cell(c, 1)).alias("divergence"), to_double(cell(c, 2)).alias("deletion"),
        to_double(cell(c, 3)).alias("insertion"), "line", "c", "_row")
    good = table.filter("start is not null and end is not null and divergence is not null and deletion is not null and insertion is not null")
    return good.withColumn("length", F.greatest(F.lit(0), F.col("end") - F.col("start") + 1).cast("bigint"))


def repeat_intervals(repeats: DataFrame) -> DataFrame:
    """Repeats as half-open intervals, with either order of the two positions."""
    return repeats.select("seqid", (F.least("start", "end") - 1).alias("start0"), F.greatest("start", "end").alias("end0"), *[
        c for c in repeats.columns if c not in ("seqid", "start", "end")])


DOMAIN_FIELDS = (
    "domain_id", "seqid", "start", "end", "strand", "class_path", "class_level_1", "class_level_2", "class_level_3", "domain_gene", "domain_type", "source_header",
)


def te_domains(records: DataFrame) -> DataFrame:
    """Domain table from the headers of transposon domain sequences (``read_fasta`` with repeats kept)."""
    header = F.col("header")
    token = F.regexp_replace(F.get(F.split(header, r"\s+"), F.lit(0)), "^>+", "")

    def found(text: Column, pattern: str, group: int = 1) -> Column:
        return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))

    place = r"^([^:|]+):(\d+)-(\d+)"
    loose = r"^([^:]+):(\d+)-(\d+)"
    before_pipe = F.get(F.split(token, r"\|", 2), F.lit(0))
    at = lambda i: F.coalesce(found(token, place, i), found(before_pipe, loose, i))
    tail = F.coalesce(found(header, r"Classification=([^;\s]+)"), F.lit("NA"))
    after_pipe = F.get(F.split(token, r"\|", 2), F.lit(1))
    prefix = present(F.get(F.split(F.coalesce(after_pipe, F.lit("")), "/"), F.lit(0)))
    path = F.when(prefix.isNull(), tail).otherwise(F.concat_ws("/", prefix, tail))
    gene = found(header, r"(?:gene|Gene)=([^;\s]+)")
    levels = F.when(path == "NA", F.array(F.lit("NA"))).otherwise(F.split(F.replace(path, F.lit("-"), F.lit("/")), "/"))
    level = lambda i: F.coalesce(F.get(levels, F.lit(i)), F.lit("NA"))
    return records.select(
        token.alias("domain_id"), at(1).alias("seqid"), at(2).try_cast("bigint").alias("start"), at(3).try_cast("bigint").alias("end"),
        found(header, r"[sS]trand=([+-])").alias("strand"), path.alias("class_path"), level(0).alias("class_level_1"), level(1).alias("class_level_2"),
        level(2).alias("class_level_3"), F.coalesce(gene, F.lit("NA")).alias("domain_gene"), domain_type(gene).alias("domain_type"), header.alias("source_header"))


def domain_type(gene: Column) -> Column:
    """RT and TPase spellings under one name, other genes as they are."""
    upper = F.upper(gene)
    tpase = upper.contains("TPASE") | upper.contains("TRANSPOSASE") | upper.contains("DDE")
    return F.when((upper == "RT") | upper.contains("RVT"), "RT").when(tpase, "TPase").otherwise(F.coalesce(gene, F.lit("NA")))


def te_domain_counts(domains: DataFrame) -> DataFrame:
    keys = ["class_level_1", "class_level_2", "class_level_3", "domain_type"]
    return domains.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def located_domains(domains: DataFrame) -> DataFrame:
    """Domains with half-open positions, as input of ``regions.domains_by_region``."""
    return domains.select("*", F.greatest(F.lit(0), F.col("start") - 1).cast("bigint").alias("start0"), F.col("end").alias("end0"))


def read_orthogroup_table(spark: SparkSession, paths: Paths) -> DataFrame:
    """Members (family_id, species, gene_id) of a wide table with gene lists in its cells."""
    table = read_table(spark, paths)
    names = ["Orthogroup", "orthogroup", "family_id", "Family ID"]
    keys = [c for c in table.columns if c in names] or [table.columns[0]]
    species = [c for c in table.columns if c not in keys]
    wide = table.select(first_present(table, keys).alias("family_id"), *[F.col(f"`{c}`") for c in species])
    cells = wide.unpivot("family_id", species, "species", "cell").filter("family_id is not null")
    members = F.flatten(F.transform(split_members(F.col("cell")), lambda m: F.split(m, r"\s+")))
    return cells.select(F.rtrim(F.col("family_id"), F.lit(":")).alias("family_id"), "species", F.explode(members).alias("gene_id")).filter("gene_id <> ''")


def read_orthogroup_text(spark: SparkSession, paths: Paths) -> DataFrame:
    """Members (family_id, gene_id, source) of one-line-per-group text in its tab, colon or blank form.

    ``gene--source`` is taken apart at the last double dash. Of a repeated group the last line counts.
    """
    line = F.trim(F.col("line"))
    lines = read_lines(spark, paths).filter(line != "").withColumn("line", line)
    tab, colon = F.col("line").contains("\t"), F.col("line").contains(":")
    words = F.split("line", r"\s+")
    group = F.when(tab, F.rtrim(F.get(F.split("line", "\t"), F.lit(0)), F.lit(":"))).when(colon, F.trim(F.get(F.split("line", ":", 2), F.lit(0)))).otherwise(
        F.rtrim(F.get(words, F.lit(0)), F.lit(":")))
    tabbed = F.flatten(F.transform(F.slice(F.split("line", "\t"), F.lit(2), F.size(F.split("line", "\t"))), lambda c: split_members(c)))
    spaced = F.split(F.trim(F.get(F.split("line", ":", 2), F.lit(1))), r"\s+")
    members = F.when(tab, tabbed).when(colon, spaced).otherwise(F.slice(words, F.lit(2), F.size(words)))
    rows = lines.select(group.alias("family_id"), members.alias("members"), "_row")
    last = rows.groupBy("family_id").agg(F.max_by("members", "_row").alias("members"))
    flat = last.select("family_id", F.explode("members").alias("m")).filter("m <> ''")
    return flat.select("family_id", F.when(F.col("m").contains("--"), F.regexp_extract("m", "^(.*)--(.*)$", 1)).otherwise(F.col("m")).alias("gene_id"),
                       F.when(F.col("m").contains("--"), F.regexp_extract("m", "^(.*)--(.*)$", 2)).otherwise("NA").alias("source"))


def read_nodes(spark: SparkSession, paths: Paths) -> DataFrame:
    """Node and parent pairs."""
    rows = data_lines(read_lines(spark, paths)).withColumn("c", F.split(F.trim("line"), r"\s+")).filter(F.size("c") >= 2)
    return rows.select(cell(F.col("c"), 0).alias("node"), cell(F.col("c"), 1).alias("parent"))


def read_lineage_table(spark: SparkSession, paths: Paths, species: str | None = None) -> DataFrame:
    """Wide per-query table of hits by taxon group.

    The header tells how many groups there are; their e-values and bitscores become maps by
    group. A line whose width differs from the header is an error.
    """
    lines = read_lines(spark, paths).filter(F.trim("line") != "")
    is_header = F.col("line").rlike(r"^#?Query_id(\t|$)")
    names = header_of(lines, is_header)
    if (len(names) - 11) % 2:
        raise ValueError("unsupported number of columns in the lineage table header")
    n = (len(names) - 11) // 2
    rows = lines.filter(~is_header).withColumn("c", F.split("line", "\t"))
    wrong = F.raise_error(F.concat(F.lit("column count differs from the header: "), F.get("c", F.lit(0))))
    rows = rows.withColumn("c", F.when(F.size("c") == len(names), F.col("c")).otherwise(wrong))
    c = F.col("c")

    def by_group(start: int) -> Column:
        return F.map_from_arrays(F.array(*[F.lit(x) for x in names[start:start + n]]), F.slice(c, start + 1, n)) if n else F.create_map()

    return rows.select(
        F.lit(species).cast("string").alias("species"), cell(c, 0).alias("query_id"), cell(c, 1).alias("self_evalue"), by_group(2).alias("donor_evalues"),
        cell(c, 2 + n).alias("alien_index"), cell(c, 3 + n).alias("alien_index_taxon"), cell(c, 4 + n).alias("self_bitscore"), by_group(5 + n).alias("donor_bitscores"),
        cell(c, 5 + 2 * n).alias("bitscore_delta"), cell(c, 6 + 2 * n).alias("bitscore_delta_percent"), cell(c, 7 + 2 * n).alias("bit_ratio"),
        cell(c, 8 + 2 * n).alias("h_taxon"), cell(c, 9 + 2 * n).alias("donor_bitscore"), cell(c, 10 + 2 * n).alias("donor_taxon_count"), F.col("path").alias("source_file"))


def _species(pair: str | None, ref: str | None, query: str | None) -> tuple[str, str]:
    first, second = pair_label(pair or "")
    return ref or first, query or second


def _stretches(lines: DataFrame, ranged: bool) -> DataFrame:
    """Lines with ``_b``, the stretch of the file they stand in: its splits, or, for lines given as a frame, whose splits may be of any size, kept ranges of the order."""
    if not ranged:
        return lines.withColumn("_b", F.col("_row.block"))
    return range_parts(lines, ["_row"], ["path"]).withColumnRenamed(PART, "_b")


def read_synteny(
    spark: SparkSession, paths: Paths, form: str, pair: str | None = None, ref_species: str | None = None, query_species: str | None = None
) -> DataFrame:
    """Synteny links of anchor, simple or table files in one shape.

    Anchor blocks are separated by comment lines. Block numbers come from counting separators
    per split first and inside the split second, so a large file is numbered by many tasks; lines
    given as a frame are counted by ranges of their order, which are kept.
    """
    ref, query = _species(pair, ref_species, query_species)
    lines = read_lines(spark, paths).filter(F.trim("line") != "")
    ranged = isinstance(paths, DataFrame)
    if form == "anchor":
        marked = _stretches(lines, ranged).withColumn("_mark", F.col("line").startswith("#").cast("int"))
        earlier = Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        starts = marked.groupBy("path", "_b").agg(F.sum("_mark").alias("_marks")).withColumn("_before", F.coalesce(F.sum("_marks").over(earlier), F.lit(0)))
        inside = Window.partitionBy("path", "_b").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
        numbered = marked.withColumn("_in", F.sum("_mark").over(inside)).join(starts.select("path", "_b", "_before"), ["path", "_b"])
        rows = numbered.filter("_mark = 0").withColumn("c", F.split(F.trim("line"), r"\s+")).filter(F.size("c") >= 2)
        c = F.col("c")
        block = F.greatest(F.col("_before") + F.col("_in"), F.lit(1)).cast("string")
        first, second, score = cell(c, 0), cell(c, 1), cell(c, 2)
    elif form == "simple":
        # Only usable lines carry a block number.
        rows = split_tabs(_stretches(lines.filter(~F.col("line").startswith("#")), ranged), 4)
        rows = rows.withColumn("_k", F.row_number().over(Window.partitionBy("path", "_b").orderBy("_row")))
        counts = rows.groupBy("path", "_b").agg(F.count(F.lit(1)).alias("_n"))
        before = Window.partitionBy("path").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).select("path", "_b", "_before")
        rows = rows.join(offsets, ["path", "_b"])
        c = F.col("c")
        block = (F.col("_before") + F.col("_k")).cast("string")
        first, second, score = F.concat_ws("..", cell(c, 0), cell(c, 1)), F.concat_ws("..", cell(c, 2), cell(c, 3)), cell(c, 4)
    elif form == "table":
        return _synteny_table(spark, paths, ref, query)
    else:
        raise ValueError("form must be anchor, simple or table")
    return rows.select(
        F.concat(F.lit("block_"), block).alias("block_id"), first.alias("ref_gene"), second.alias("query_gene"), F.lit(ref).alias("ref_species"),
        F.lit(query).alias("query_species"), score.alias("score"), F.lit(form).alias("source_format"))


def _synteny_table(spark: SparkSession, paths: Paths, ref: str, query: str) -> DataFrame:
    numbered = split_tabs(data_lines(with_line_numbers(read_lines(spark, paths))))
    named = F.array_contains("c", "ref_gene") | F.array_contains("c", "query_gene") | F.array_contains("c", "block_id")
    head = numbered.filter(named).agg(F.min_by("c", "_row").alias("c")).first()["c"] or []
    rows = numbered.filter(~named) if head else numbered
    c = F.col("c")

    def value(names: Sequence[str], position: int | None, default: str | None = None) -> Column:
        options = [present(cell(c, head.index(n)), ("",)) for n in names if n in head]
        if position is not None:
            options.append(cell(c, position))
        return F.coalesce(*options, F.lit(default).cast("string"))

    unnamed = F.concat(F.lit("block_"), F.col("line_number").cast("string"))
    return rows.select(
        F.coalesce(value(["block_id"], None), unnamed).alias("block_id"), value(["ref_gene", "gene1"], 0).alias("ref_gene"), value(["query_gene", "gene2"], 1).alias("query_gene"),
        value(["ref_species"], None, ref).alias("ref_species"), value(["query_species"], None, query).alias("query_species"), value(["score"], 2).alias("score"),
        F.lit("table").alias("source_format"))


def read_simple_blocks(spark: SparkSession, paths: Paths) -> DataFrame:
    """First and last genes of synteny blocks, as input of ``synteny.link_coordinates``."""
    rows = split_tabs(data_lines(read_lines(spark, paths)), 4)
    return rows.select(*[cell(F.col("c"), i).alias(n) for i, n in enumerate(("ref_first", "ref_last", "query_first", "query_last"))])


def read_reports(spark: SparkSession, paths: Paths) -> DataFrame:
    """One row per report file (path, text)."""
    return spark.read.text(path_list(paths), wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def read_newick(spark: SparkSession, paths: Paths) -> DataFrame:
    """Trees (tree_id, newick), one per file."""
    return read_reports(spark, paths).select(F.col("path").alias("tree_id"), F.trim("text").alias("newick"))


def read_ko_lists(spark: SparkSession, paths: Paths) -> DataFrame:
    """Gene and KO text (gene_id, ko) of a background file; of a repeated gene the last line counts."""
    lines = data_lines(read_lines(spark, paths)).withColumn("c", F.split("line", "\t", 2))
    return lines.groupBy(cell(F.col("c"), 0).alias("gene_id")).agg(F.max_by(F.coalesce(cell(F.col("c"), 1), F.lit("")), "_row").alias("ko"))


def gene_kos(background: DataFrame) -> DataFrame:
    """Long gene/KO table of ``KO!KO`` text, remarks after a bar removed; genes without KO keep a NULL row."""
    cleaned = F.regexp_replace(F.regexp_replace("ko", r"\|[^!]*!*", "!"), "!$", "")
    kos = F.filter(F.split(cleaned, "!"), lambda k: k != "")
    return background.select("gene_id", F.explode_outer(kos).alias("ko_id"))


def read_gene_lists(spark: SparkSession, paths: Paths, extension: str = "glist") -> DataFrame:
    """Genes of many list files (list_name, gene_id); the list is the file name without its extension."""
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), rf"\.{extension}$", "")
    return read_lines(spark, paths).filter(F.trim("line") != "").select(name.alias("list_name"), F.get(F.split("line", "\t"), F.lit(0)).alias("gene_id"))


def read_ko_map(spark: SparkSession, paths: Paths) -> DataFrame:
    """KO to pathway rows of ``KO<tab>path path`` text."""
    rows = split_tabs(data_lines(read_lines(spark, paths)), 2)
    return rows.select(cell(F.col("c"), 0).alias("ko_id"), F.explode(F.split(cell(F.col("c"), 1), r"\s+")).alias("pathway_id")).filter("pathway_id <> ''")


def read_pathway_titles(spark: SparkSession, paths: Paths) -> DataFrame:
    """Pathway titles and levels of four-column text."""
    rows = split_tabs(data_lines(read_lines(spark, paths)), 2)
    return rows.select(*[cell(F.col("c"), i).alias(n) for i, n in enumerate(("pathway_id", "pathway_name", "level1", "level2"))])


def species_kos(spark: SparkSession, paths: Paths, code: str) -> DataFrame:
    """Gene and KO text of one species (three-letter code) from the headers of a reference FASTA."""
    wanted = F.col("line").rlike(rf"^>{code.lower()}:.*[\s;]\s*K\d+")
    lines = read_lines(spark, paths).filter(wanted)
    body = F.regexp_replace("line", rf"^>{code.lower()}:", "")
    kos = F.regexp_extract_all(F.regexp_replace(body, r"^\S+", ""), F.lit(r"(?:^|[\s;])(K\d+)(?=[\s;]|$)"), F.lit(1))
    return lines.select(F.regexp_extract(body, r"^(\S+)", 1).alias("gene_id"), F.array_join(kos, "!").alias("ko"))
