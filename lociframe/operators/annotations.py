"""Merging annotation sources into one table, and selecting genes from it."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import MISSING, column_of, first_present, joined, labels, present

MERGED_COLUMNS = (
    "transcript_id", "gene_id", "seqid", "start", "end", "strand", "cds_len", "phase_ok", "start_ok", "terminal_stop",
    "internal_stop", "ambiguous_nt", "Pfam_ids", "InterPro_ids", "GO_terms", "eggNOG_ortholog", "COG_category", "KEGG_ko",
    "Kofam_ko", "SwissProt_best_hit", "SwissProt_description", "NR_best_hit", "NR_description",
)


def domain_sets(domains: DataFrame) -> DataFrame:
    """Pfam, InterPro and GO sets per query as sorted list cells."""
    def cell(values: Column, name: str) -> Column:
        return joined(F.array_sort(F.collect_set(values)), "NA").alias(name)

    go = F.filter(F.split(F.coalesce(present(F.col("GO_terms")), F.lit("")), r"\|"), lambda x: x != "")
    per_query = domains.filter("Query_id is not null").select(
        "Query_id", F.when(F.col("Subject_DB") == "Pfam", present(F.col("Subject_id"))).alias("pfam"),
        present(F.col("InterPro_id")).alias("interpro"), F.explode_outer(go).alias("go"),
    ).distinct()
    return per_query.groupBy(F.col("Query_id").alias("transcript_id")).agg(
        cell(F.col("pfam"), "Pfam_ids"), cell(F.col("interpro"), "InterPro_ids"), cell(F.col("go"), "GO_terms")
    )


def best_hits(hits: DataFrame, row_order: str = "_row") -> DataFrame:
    """First row of each query in file order: subject, and the description column when there is one."""
    description = F.col("description") if "description" in hits.columns else F.lit(None).cast("string")
    return hits.groupBy(F.col("query_id").alias("transcript_id")).agg(
        F.min_by(F.struct(F.col("subject_id").alias("hit"), description.alias("description")), row_order).alias("_b")
    ).select("transcript_id", "_b.*")


def merge_annotations(
    transcripts: DataFrame,
    cds_check: DataFrame | None = None,
    domains: DataFrame | None = None,
    orthologs: DataFrame | None = None,
    kofam: DataFrame | None = None,
    swissprot: DataFrame | None = None,
    nr: DataFrame | None = None,
    row_order: str | None = "_row",
) -> DataFrame:
    """One row per transcript with everything known about it.

    Each source is first brought to one row per transcript (the last row of a repeated key
    counts, the first for best hits), so the left joins cannot multiply rows. Sources that were
    not given leave NULL columns and add no join.
    """
    out = transcripts.select("transcript_id", "gene_id", "seqid", "start", "end", "strand")

    def last_row(df: DataFrame, key: Column, columns: dict[str, Column]) -> DataFrame:
        table = df.select(key.alias("transcript_id"), F.struct(*[c.alias(n) for n, c in columns.items()]).alias("_v"),
                          (df[row_order] if row_order and row_order in df.columns else F.lit(0)).alias("_order"))
        return table.filter("transcript_id is not null").groupBy("transcript_id").agg(
            F.max_by("_v", F.struct("_order", "_v")).alias("_v")).select("transcript_id", "_v.*")

    def text(df: DataFrame, names: Sequence[str]) -> Column:
        return first_present(df, names, None, MISSING)

    checks = ("phase_ok", "start_ok", "terminal_stop", "internal_stop", "ambiguous_nt")
    sides: list[tuple[DataFrame | None, list[str]]] = [
        (None if cds_check is None else last_row(cds_check, cds_check["transcript_id"], {
            "cds_len": text(cds_check, ["cds_len", "len"]), **{c: text(cds_check, [c]) for c in checks}}), ["cds_len", *checks]),
        (None if domains is None else domain_sets(domains), ["Pfam_ids", "InterPro_ids", "GO_terms"]),
        (None if orthologs is None else last_row(orthologs, text(orthologs, ["#query", "query"]), {
            "eggNOG_ortholog": text(orthologs, ["seed_ortholog", "eggNOG_ortholog"]),
            "COG_category": text(orthologs, ["COG_category"]), "KEGG_ko": text(orthologs, ["KEGG_ko"])}),
         ["eggNOG_ortholog", "COG_category", "KEGG_ko"]),
        (None if kofam is None else last_row(kofam, text(kofam, ["Query_id"]), {"Kofam_ko": text(kofam, ["KO"])}), ["Kofam_ko"]),
    ]
    for hits, prefix in ((swissprot, "SwissProt"), (nr, "NR")):
        names = [f"{prefix}_best_hit", f"{prefix}_description"]
        sides.append((None if hits is None else best_hits(hits).select(
            "transcript_id", F.col("hit").alias(names[0]), F.col("description").alias(names[1])), names))
    for side, names in sides:
        if side is not None:
            out = out.join(side, "transcript_id", "left")
        else:
            out = out.select("*", *[F.lit(None).cast("string").alias(n) for n in names])
    return out.select(*MERGED_COLUMNS)


def term_set(df: DataFrame, columns: Sequence[str]) -> Column:
    """Distinct terms of several list columns; blanks separate terms too."""
    cells = [F.split(F.coalesce(c.cast("string"), F.lit("")), "[;,| ]+") for c in (column_of(df, n) for n in columns) if c is not None]
    if not cells:
        return F.array().cast("array<string>")
    return F.filter(F.array_distinct(F.concat(*cells)), lambda x: ~x.isin("", "NA"))


def select_by_function(
    annotation: DataFrame,
    pfam: Sequence[str] = (),
    ko: Sequence[str] = (),
    keyword: str | None = None,
    candidates: DataFrame | None = None,
    id_column: str = "transcript_id",
) -> DataFrame:
    """Genes matching any criterion, with the reasons. The keyword is a case-insensitive regular
    expression over all columns of the row."""
    own = first_present(annotation, [id_column, "transcript_id", "gene_id"])
    gene = column_of(annotation, "gene_id")
    gene = F.lit(None).cast("string") if gene is None else gene.cast("string")
    tests: list[tuple[Column, str]] = []
    if pfam:
        tests.append((F.arrays_overlap(term_set(annotation, ["Pfam_ids"]), F.array(*map(F.lit, pfam))), "pfam"))
    if ko:
        tests.append((F.arrays_overlap(term_set(annotation, ["KEGG_ko", "Kofam_ko", "KO_ids"]), F.array(*map(F.lit, ko))), "ko"))
    if keyword:
        whole = F.concat_ws("\t", *[annotation[f"`{c}`"].cast("string") for c in annotation.columns])
        tests.append((whole.rlike(f"(?i){keyword}"), "keyword"))
    rows = annotation.select(own.alias("id"), gene.alias("gene_id"), *[t.alias(f"_is_{n}") for t, n in tests]).filter("id is not null")
    found = [(F.col(f"_is_{n}"), n) for _, n in tests]
    if candidates is not None:
        listed = candidates.select(F.col("gene_id").cast("string").alias("_listed")).distinct()
        by_id = listed.select(F.col("_listed").alias("id"), F.lit(True).alias("_by_id"))
        by_gene = listed.select(F.col("_listed").alias("gene_id"), F.lit(True).alias("_by_gene"))
        rows = rows.join(by_id, "id", "left").join(by_gene, "gene_id", "left")
        found.append((F.col("_by_id").isNotNull() | F.col("_by_gene").isNotNull(), "candidate"))
    reasons = labels(*found)
    return rows.withColumn("_r", reasons).filter(F.size("_r") > 0).select("id", "gene_id", F.array_join("_r", ";").alias("reason"))


def candidate_context(
    candidates: DataFrame,
    coordinates: DataFrame,
    annotation: DataFrame | None = None,
    introns: DataFrame | None = None,
    synteny: DataFrame | None = None,
) -> DataFrame:
    """Candidates with location, annotation, intron and synteny context.

    ``coordinates`` (id, seqid, start, end, strand, priority) and the other sources are looked
    up by query id, then by gene id, then by transcript id, whichever is found first.
    """
    if annotation is not None:
        notes = annotation.select(
            first_present(annotation, ["gene_id", "transcript_id", "query_id", "ID"]).alias("query_id"),
            first_present(annotation, ["gene_id"]).alias("_gene"), first_present(annotation, ["transcript_id"]).alias("_tx"),
            first_present(annotation, ["Pfam_ids", "pfam", "Pfam"]).alias("Pfam_ids"),
            first_present(annotation, ["KEGG_ko", "KO", "ko"]).alias("KEGG_ko"),
            first_present(annotation, ["description", "SwissProt_description", "eggnog_desc"]).alias("description"),
        ).filter("query_id is not null")
        columns = ["_gene", "_tx", "Pfam_ids", "KEGG_ko", "description"]
        notes = notes.groupBy("query_id").agg(F.max(F.struct(*columns)).alias("_n")).select("query_id", "_n.*")
        base = candidates.withColumn("query_id", F.col("query_id").cast("string")).join(notes, "query_id", "left")
    else:
        nothing = F.lit(None).cast("string")
        base = candidates.withColumn("query_id", F.col("query_id").cast("string")).select(
            "*", *[nothing.alias(c) for c in ("_gene", "_tx", "Pfam_ids", "KEGG_ko", "description")])
    base = base.withColumn("gene_id", F.coalesce("_gene", "query_id")).withColumn("transcript_id", F.coalesce("_tx", "query_id"))
    keys = ("query_id", "gene_id", "transcript_id")

    def look_up(df: DataFrame, table: DataFrame, value: str) -> DataFrame:
        """Left joins over the fallback keys; ``table`` has one row per ``id`` and a struct ``value``."""
        for i, key in enumerate(keys):
            df = df.join(table.select(F.col("id").alias(key), F.col(value).alias(f"_{value}{i}")), key, "left")
        return df.withColumn(value, F.coalesce(*[F.col(f"_{value}{i}") for i in range(len(keys))])).drop(
            *[f"_{value}{i}" for i in range(len(keys))])

    located = coordinates.groupBy(F.col("id").cast("string").alias("id")).agg(
        F.min(F.struct("priority", "seqid", "start", "end", "strand")).alias("loc"))
    out = look_up(base, located, "loc")
    if introns is not None:
        flag = introns.select(
            F.explode(F.array_distinct(F.array_compact(F.array("gene_id", "transcript_id")))).alias("id"),
            "is_short_intron", "at_content", "is_at_rich",
        ).filter("id <> 'NA'")
        metrics = flag.groupBy("id").agg(F.struct(
            F.count(F.lit(1)).alias("intron_count"), F.count_if("is_short_intron").alias("short_intron_count"),
            F.avg("at_content").alias("mean_intron_at"), F.avg(F.col("is_at_rich").cast("int")).alias("at_rich_intron_ratio"),
        ).alias("intron"))
        out = look_up(out, metrics, "intron")
    else:
        out = out.withColumn("intron", F.lit(None).cast(
            "struct<intron_count:bigint,short_intron_count:bigint,mean_intron_at:double,at_rich_intron_ratio:double>"))
    if synteny is not None:
        status = synteny.select(
            first_present(synteny, ["gene_id", "query_id", "transcript_id"]).alias("id"),
            first_present(synteny, ["synteny_support_status", "status", "support"], "present").alias("syn"),
        ).filter("id is not null").groupBy("id").agg(F.max("syn").alias("syn"))
        out = look_up(out, status, "syn").withColumn("syn", F.coalesce("syn", F.lit("missing")))
    else:
        out = out.withColumn("syn", F.lit("not_tested"))
    absent = [n for n, given in (("functional_annotation", annotation), ("intron_details", introns), ("synteny", synteny)) if given is None]
    high = (F.col("candidate_status") == "candidate") & F.col("syn").isin("absent", "missing", "not_tested")
    return out.select(
        "query_id", "gene_id", "transcript_id", "loc.seqid", "loc.start", "loc.end", "loc.strand", "best_donor_taxon",
        "best_donor_group", "alien_index", "bitscore_delta", "Pfam_ids", "KEGG_ko", "description", "intron.intron_count",
        "intron.short_intron_count", "intron.mean_intron_at", "intron.at_rich_intron_ratio",
        F.col("syn").alias("synteny_support_status"), F.lit(";".join(absent) or "none").alias("missing_data_note"),
        F.when(high, "high").otherwise("review").alias("validation_priority"),
    )
