"""Annotation terms: counts, pathways, categories, domain architectures and over-representation."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.stats import hypergeometric_tail
from ..functions.text import first_present, present, split_terms, to_long
from .summaries import benjamini_hochberg, last_by

# One-letter functional categories of clusters of orthologous groups.
COG_NAMES = {
    "A": "RNA processing and modification",
    "B": "Chromatin structure and dynamics",
    "C": "Energy production and conversion",
    "D": "Cell cycle control, cell division, chromosome partitioning",
    "E": "Amino acid transport and metabolism",
    "F": "Nucleotide transport and metabolism",
    "G": "Carbohydrate transport and metabolism",
    "H": "Coenzyme transport and metabolism",
    "I": "Lipid transport and metabolism",
    "J": "Translation, ribosomal structure and biogenesis",
    "K": "Transcription",
    "L": "Replication, recombination and repair",
    "M": "Cell wall/membrane/envelope biogenesis",
    "N": "Cell motility",
    "O": "Posttranslational modification, protein turnover, chaperones",
    "P": "Inorganic ion transport and metabolism",
    "Q": "Secondary metabolites biosynthesis, transport and catabolism",
    "R": "General function prediction only",
    "S": "Function unknown",
    "T": "Signal transduction mechanisms",
    "U": "Intracellular trafficking, secretion, and vesicular transport",
    "V": "Defense mechanisms",
    "W": "Extracellular structures",
    "Y": "Nuclear structure",
    "Z": "Cytoskeleton",
}


def gene_terms(annotation: DataFrame, term_column: str, id_column: str = "transcript_id", strip: str | None = None) -> DataFrame:
    """Long gene/term table of a list column, distinct."""
    return (
        annotation.select(present(F.col(id_column)).alias("gene_id"), split_terms(F.col(term_column), strip=strip).alias("_t"))
        .filter("gene_id is not null").select("gene_id", F.explode("_t").alias("term_id")).distinct()
    )


def term_counts(pairs: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Distinct genes per term, and the term's name when a lookup is given; the genes themselves are the rows of ``gene_terms``."""
    out = pairs.groupBy("term_id").agg(F.count_distinct("gene_id").alias("gene_count"))
    if names is not None:
        out = out.join(names.select("term_id", "term_name"), "term_id", "left")
    return out


def name_lookup(raw: DataFrame, ids: Sequence[str], names: Sequence[str], row_order: str | None = None) -> DataFrame:
    """term_id/term_name lookup under alias columns."""
    table = raw.select(
        first_present(raw, ids).alias("term_id"), first_present(raw, names, "NA").alias("term_name"),
        *([raw[row_order].alias("_order")] if row_order else []),
    ).filter("term_id is not null")
    return last_by(table, ["term_id"], "_order", ["term_name"]) if row_order else table


def gene_pathways(gene_kos: DataFrame, ko_map: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Gene, KO and pathway rows of all mapped KOs."""
    rows = gene_kos.join(ko_map.select("ko_id", "pathway_id").distinct(), "ko_id")
    if names is not None:
        rows = rows.join(names.select("pathway_id", "pathway_name", "level1", "level2"), "pathway_id", "left")
    return rows


def _pathway_genes(gene_kos: DataFrame, mapping: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Genes of each pathway, counted by ``measures`` over one row per pathway and gene.

    Rows are dealt by gene before they meet their pathways, so that the many rows of a gene become one per pathway where
    they stand; only counts travel after that.
    """
    carried = [c for c in gene_kos.columns if c != "ko_id"]
    # A given number of parts is kept as it is; parts merged by their size on arrival would be too large once pathways are met.
    parts = int(gene_kos.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    once = gene_kos.repartition(parts, "gene_id").join(mapping.select("ko_id", "pathway_id").distinct(), "ko_id").select("pathway_id", *carried).distinct()
    return once.groupBy("pathway_id").agg(*[c.alias(n) for n, c in measures.items()])


def pathway_counts(gene_kos: DataFrame, ko_map: DataFrame, names: DataFrame | None = None) -> DataFrame:
    """Distinct genes and KOs per pathway; the genes and KOs themselves are the rows of ``gene_pathways``."""
    mapped = ko_map.select("ko_id", "pathway_id").distinct()
    out = _pathway_genes(gene_kos.select("gene_id", "ko_id"), mapped, {"gene_count": F.count("gene_id")})
    kos = mapped.join(gene_kos.select("ko_id").distinct(), "ko_id", "left_semi").groupBy("pathway_id").agg(F.count("ko_id").alias("ko_count"))
    out = out.join(kos, F.equal_null(out["pathway_id"], kos["pathway_id"])).select(out["pathway_id"], "gene_count", "ko_count")
    if names is not None:
        out = out.join(names.select("pathway_id", "pathway_name", "level1", "level2"), "pathway_id", "left")
    return out


def unmapped_terms(gene_kos: DataFrame, ko_map: DataFrame) -> DataFrame:
    """KO and gene rows of KOs without any pathway."""
    return gene_kos.join(ko_map.select("ko_id").distinct(), "ko_id", "left_anti").select("ko_id", "gene_id").distinct()


def category_letters(value: Column) -> Column:
    """Distinct upper-case letters of a category cell; a cell without one gives a NULL category."""
    letters = F.array_sort(F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce(value, F.lit(""))), F.lit("([A-Z])"), F.lit(1))))
    return F.when((F.size(letters) == 0) | value.isin("NA", "-"), F.array(F.lit(None).cast("string"))).otherwise(letters)


def category_name(category: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in COG_NAMES.items() for x in pair])
    return F.when(category.isNotNull(), F.coalesce(F.try_element_at(table, category), F.lit("Unmapped category")))


def gene_categories(table: DataFrame, id_columns: Sequence[str] = ("query", "query_name"),
                    category_columns: Sequence[str] = ("COG_category", "COG cat", "COG_category_id", "cog_category")) -> DataFrame:
    """Long gene/category table; ``source_column`` names the column the category came from."""
    missing = ("", "-")
    sources = [c for c in category_columns if c in table.columns]
    found = F.coalesce(*[F.when(present(table[f"`{c}`"], missing).isNotNull(), F.lit(c)) for c in sources], F.lit(None).cast("string"))
    return (
        table.select(
            first_present(table, id_columns, None, ("", "-", "NA")).alias("gene_id"),
            F.explode(category_letters(first_present(table, category_columns, None, missing))).alias("category"),
            found.alias("source_column"),
        ).filter("gene_id is not null").withColumn("category_name", category_name(F.col("category")))
    )


def category_proportions(pairs: DataFrame) -> DataFrame:
    """Distinct genes per category, as count, share of all genes and log2 of the share."""
    genes = pairs.select("gene_id").distinct().agg(F.count(F.lit(1)).alias("n"))
    counts = pairs.select("category", "gene_id").distinct().groupBy("category").agg(F.count(F.lit(1)).alias("gene_count"))
    return counts.withColumn("proportion", F.col("gene_count") / genes.scalar()).select(
        "category", category_name(F.col("category")).alias("category_name"), "gene_count", "proportion",
        F.log2("proportion").alias("log2_proportion"),
    )


def domain_architecture(domains: DataFrame, id_column: str = "query_id") -> DataFrame:
    """Ordered domains of each protein: architecture, count, ordered ids and spans.

    The cell is the result itself; a protein's domain list is as long as the protein allows.
    """
    ordered = F.array_sort(F.collect_list(F.struct(
        F.coalesce(to_long(F.col("start")), F.lit(0)).alias("start"), F.coalesce(to_long(F.col("end")), F.lit(0)).alias("end"),
        F.col("domain_id").alias("id"),
    )))
    grouped = domains.filter(F.col(id_column).isNotNull() & F.col("domain_id").isNotNull()).groupBy(id_column).agg(ordered.alias("_d"))
    ids = F.transform("_d", lambda d: d["id"])
    spans = F.transform("_d", lambda d: F.concat(d["id"], F.lit(":"), d["start"].cast("string"), F.lit("-"), d["end"].cast("string")))
    return grouped.select(
        id_column, F.array_join(ids, "|").alias("domain_architecture"), F.size("_d").alias("domain_count"),
        F.array_join(ids, ";").alias("domains_ordered"), F.array_join(spans, ";").alias("domain_spans"),
    )


def architecture_frequency(architectures: DataFrame, id_column: str = "query_id") -> DataFrame:
    """Proteins per architecture; the proteins themselves are the rows of ``domain_architecture``."""
    return architectures.filter(F.col(id_column).isNotNull()).groupBy("domain_architecture").agg(F.count(F.lit(1)).alias("gene_count"))


def term_enrichment(
    pairs: DataFrame,
    universe: DataFrame,
    foreground: DataFrame,
    min_count: int = 1,
) -> DataFrame:
    """Right-tail over-representation of each term in the foreground, with false-discovery rates.

    ``universe`` lists every annotated gene (with or without terms); foreground genes outside it
    do not count. Only per-term counts reach the test.
    """
    genes = universe.select("gene_id").distinct()
    marked = genes.join(foreground.select("gene_id").distinct().withColumn("_fg", F.lit(1)), "gene_id", "left")
    totals = marked.agg(F.count(F.lit(1)).alias("background_total"), F.count("_fg").alias("foreground_total"))
    flagged = pairs.select("gene_id", "term_id").distinct().join(marked, "gene_id")
    counts = flagged.groupBy("term_id").agg(
        F.count("_fg").alias("foreground_with_term"), F.count(F.lit(1)).alias("background_with_term")
    ).filter(F.col("foreground_with_term") >= min_count)
    sized = counts.select(
        "*", totals.select("foreground_total").scalar().alias("foreground_total"),
        totals.select("background_total").scalar().alias("background_total"),
    )
    a = F.col("foreground_with_term")
    b = F.col("foreground_total") - a
    c = F.col("background_with_term") - a
    d = F.col("background_total") - F.col("foreground_total") - c
    tested = benjamini_hochberg(sized.withColumn("p_value", hypergeometric_tail(a, b, c, d)), "p_value", "q_value")
    return tested.select(
        "term_id", "foreground_with_term", "foreground_total", "background_with_term", "background_total", "p_value", "q_value"
    )


def foreground_terms(pairs: DataFrame, universe: DataFrame, foreground: DataFrame) -> DataFrame:
    """Term and gene rows of the foreground genes that the test counts."""
    genes = universe.select("gene_id").distinct().join(foreground.select("gene_id").distinct(), "gene_id", "left_semi")
    return pairs.select("term_id", "gene_id").distinct().join(genes, "gene_id", "left_semi").select("term_id", "gene_id")


def top_terms(
    enrichment: DataFrame, names: DataFrame | None = None, max_terms: int | None = None, max_q: float = 0.05,
    plot_group: str = "target",
) -> DataFrame:
    """Report of the best terms: significant ones with names, lowest q-value first; ``max_terms`` limits the report when given."""
    kept = enrichment.filter(F.col("q_value") <= max_q)
    if names is not None:
        kept = kept.join(names.select("term_id", "term_name", "ontology"), "term_id", "left")
    else:
        kept = kept.withColumn("term_name", F.lit(None).cast("string")).withColumn("ontology", F.lit(None).cast("string"))
    named = kept.withColumn("term_name", F.coalesce("term_name", F.col("term_id").cast("string")))
    report = named.select(
        "term_id", "term_name", "ontology", "p_value", "q_value", F.col("foreground_with_term").alias("foreground_count"),
        "foreground_total", F.col("background_with_term").alias("background_count"), "background_total",
        F.lit(plot_group).alias("plot_group"), F.concat_ws(" ", F.col("term_id").cast("string"), "term_name").alias("label"),
    ).orderBy("q_value", "p_value", "term_id")
    return report if max_terms is None else report.limit(max_terms)


def pathway_enrichment(
    foreground: DataFrame, background: DataFrame, ko_map: DataFrame, titles: DataFrame
) -> DataFrame:
    """Pathways of a foreground gene/KO table tested against a background gene/KO table.

    Both tables have gene_id and ko_id (NULL for a gene without KO, which still counts as a
    gene). Only titled pathways hit by the foreground are tested.
    """
    titled = ko_map.select("ko_id", "pathway_id").distinct().join(titles.select("pathway_id").distinct(), "pathway_id", "left_semi")

    def per_pathway(table: DataFrame, count: str) -> DataFrame:
        return _pathway_genes(table.select("gene_id", "ko_id"), titled, {count: F.count(F.lit(1))})

    n_fg = foreground.select("gene_id").distinct().agg(F.count(F.lit(1)))
    n_bg = background.select("gene_id").distinct().agg(F.count(F.lit(1)))
    counted = per_pathway(foreground, "foreground_genes").join(
        per_pathway(background, "background_genes"), "pathway_id", "left"
    ).na.fill(0, ["background_genes"]).select("*", n_fg.scalar().alias("_fg"), n_bg.scalar().alias("_bg"))
    a, marked, draws, n = (F.col(c) for c in ("foreground_genes", "background_genes", "_fg", "_bg"))
    tail = F.when(a <= F.least(marked, draws), hypergeometric_tail(a, draws - a, marked - a, n - draws - marked + a)).otherwise(0.0)
    tested = benjamini_hochberg(counted.withColumn("p_value", tail), "p_value", "q_value")
    return tested.join(titles, "pathway_id").drop("_fg", "_bg")


def pathway_tally(foreground: DataFrame, ko_map: DataFrame, titles: DataFrame) -> DataFrame:
    """The same report without a background: number of genes and KOs per titled pathway; ``gene_pathways`` has their rows."""
    counts = gene_pathways(foreground, ko_map).groupBy("pathway_id").agg(F.count_distinct("gene_id").alias("foreground_genes"), F.count_distinct("ko_id").alias("foreground_kos"))
    return counts.join(titles, "pathway_id")


def select_ko(gene_lists: DataFrame, background: DataFrame) -> DataFrame:
    """KO text of each listed gene found in the background, for any number of lists at once."""
    return gene_lists.select("list_name", "gene_id").join(background.select("gene_id", "ko"), "gene_id").select(
        "list_name", "gene_id", "ko"
    )


def kofam_gene_ko(hits: DataFrame, max_evalue: float, row_order: str = "_row") -> DataFrame:
    """KOs per gene with e-value below the cutoff, first-seen order, joined by ``!``."""
    first = hits.filter(F.col("evalue") < max_evalue).groupBy("query_id", "ko").agg(F.min(row_order).alias("_first"))
    ordered = F.array_sort(F.collect_list(F.struct("_first", "ko")))
    return first.groupBy("query_id").agg(F.array_join(F.transform(ordered, lambda x: x["ko"]), "!").alias("kos"))
