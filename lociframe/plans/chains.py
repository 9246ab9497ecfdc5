"""Whole analyses as chains of operators.

Each function takes tables and returns the tables of every step by name. Nothing runs until a
result is written; inputs that are not given leave out the steps that need them. A table that
several steps read is written once to the shared folder when ``keep`` is set, otherwise Spark
plans every result from the sources.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotations, coverage, families, genes, hits, matrices, regions, rules, sequences, synteny, terms
from ..session import durable
from ..sources import gff, reports


def functional_annotation(
    features: DataFrame, cds_check: DataFrame | None = None, domains: DataFrame | None = None, orthologs: DataFrame | None = None,
    kofam: DataFrame | None = None, swissprot: DataFrame | None = None, nr: DataFrame | None = None, ko_map: DataFrame | None = None,
    pathway_names: DataFrame | None = None, foreground: DataFrame | None = None, keep: bool = False,
) -> dict[str, DataFrame]:
    """Merged annotation, term counts, pathways, categories, architectures and the over-representation test."""
    merged = annotations.merge_annotations(genes.annotated_transcripts(features), cds_check, domains, orthologs, kofam, swissprot, nr)
    if keep:
        merged = durable(merged)
    go = terms.gene_terms(merged, "GO_terms")
    pfam = terms.gene_terms(merged, "Pfam_ids")
    out = {"annotation": merged, "gene_go": go, "go_counts": terms.term_counts(go), "gene_pfam": pfam, "pfam_counts": terms.term_counts(pfam)}
    kos = terms.gene_terms(merged, "KEGG_ko", strip="ko:").unionByName(terms.gene_terms(merged, "Kofam_ko", strip="ko:")).distinct().withColumnRenamed("term_id", "ko_id")
    if ko_map is not None:
        out |= {"gene_pathways": terms.gene_pathways(kos, ko_map, pathway_names), "pathway_counts": terms.pathway_counts(kos, ko_map, pathway_names),
                "unmapped": terms.unmapped_terms(kos, ko_map)}
    if orthologs is not None:
        categories = terms.gene_categories(orthologs)
        out |= {"gene_categories": categories, "category_counts": terms.category_proportions(categories)}
    if domains is not None:
        architectures = terms.domain_architecture(reports.pfam_domains(domains))
        out |= {"architectures": architectures, "architecture_counts": terms.architecture_frequency(architectures)}
    if foreground is not None:
        universe = merged.select(F.col("transcript_id").alias("gene_id"))
        out |= {"go_enrichment": terms.term_enrichment(go, universe, foreground), "go_foreground": terms.foreground_terms(go, universe, foreground)}
    return out


def go_handoff(enrichment: DataFrame, names: DataFrame | None = None, max_terms: int | None = None, max_q: float = 0.05) -> DataFrame:
    """Report of the significant terms of a functional annotation."""
    return terms.top_terms(enrichment, names, max_terms, max_q)


def candidate_screen(
    lineage: DataFrame, features: DataFrame, ingroup: str, donors: Sequence[str], annotation: DataFrame | None = None, introns: DataFrame | None = None,
    synteny_status: DataFrame | None = None, classified: DataFrame | None = None, **limits: float,
) -> dict[str, DataFrame]:
    """Transfer candidates of one species: filter, context and the set to validate."""
    judged = hits.filter_lineage_table(lineage, ingroup, donors, **limits)
    accepted = judged.filter("candidate_status = 'candidate'")
    context = annotations.candidate_context(accepted, genes.feature_coordinates(features), annotation, introns, synteny_status)
    out = {"candidates": accepted, "rejected": judged.filter("candidate_status = 'rejected'"), "counts": hits.status_counts(judged, "candidate_status"), "context": context}
    if classified is not None:
        out["validation"] = hits.validation_set(context, classified)
    return out


def transfer_events(
    lineage: DataFrame, species: DataFrame, members: DataFrame, counts: DataFrame, nodes: DataFrame, donors: Sequence[str], excluded: Sequence[str] = ("unknown",),
    groups: DataFrame | None = None, min_ratio: float = 0.3,
) -> dict[str, DataFrame]:
    """Several species: condition matrices, orthogroup inputs, events on the tree by genes and, with ``groups``, by families."""
    candidates = hits.condition_candidates(lineage, donors, excluded)
    columns = hits.donor_columns(candidates, donors)
    matrix = hits.condition_matrices(candidates, species, columns)
    inputs = hits.orthogroup_inputs(candidates)
    flagged = families.flag_families(members, inputs.select("gene_id", "source").groupBy("gene_id").agg(F.max("source").alias("source")), min_ratio)
    events = families.node_events(counts, nodes, flagged.filter("is_hgt_family").select("family_id", "majority_source"))
    out = {"candidates": candidates, "matrix": matrix, "inputs": inputs, "flagged": flagged, "events": events, "event_summary": families.event_summary(events),
           "sources": families.source_breakdown(events)}
    if groups is not None:
        mapping = families.map_families(groups, members)
        mapped = families.node_events(counts, nodes, families.mapped_sources(mapping))
        out |= {"mapping": mapping, "mapped_events": mapped, "mapped_event_summary": families.event_summary(mapped), "mapped_sources": families.source_breakdown(mapped)}
    out |= {"node_handoff": matrices.event_handoff(out["event_summary"]), "source_handoff": matrices.source_handoff(out["sources"])}
    return out


def region_context(target_regions: DataFrame, features: DataFrame, sites: DataFrame | None = None, scheme: Sequence[int] = (25, 100, 25), flank: int = 2000) -> dict[str, DataFrame]:
    """Feature enrichment of regions and the methylation along the target regions."""
    out = {"enrichment": regions.region_enrichment(target_regions, features), "details": regions.region_enrichment_details(target_regions, features)}
    if sites is not None:
        chosen = target_regions.filter("region_set = 'target'")
        out |= {"profile": regions.methylation_profile(chosen, sites, scheme, flank), "profile_summary": regions.methylation_totals(chosen, sites, scheme, flank)}
    return out


def repeat_context(
    domains: DataFrame | None = None, target: DataFrame | None = None, background: DataFrame | None = None, repeats: DataFrame | None = None,
    substitution_rate: float | None = None,
) -> dict[str, DataFrame]:
    """Transposon domains by region, and repeat divergence."""
    out = {}
    if domains is not None:
        out["domain_counts"] = reports.te_domain_counts(domains)
        if target is not None:
            out["domains_by_region"] = regions.domains_by_region(reports.located_domains(domains), target, background)
    if repeats is not None:
        detail = sequences.te_divergence(repeats, substitution_rate)
        out |= {"divergence": detail, "divergence_summary": sequences.te_divergence_summary(detail)}
    return out


def gene_structure(features: DataFrame, genome_lengths: DataFrame | None = None, species: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The structure tables of a cohort with their plot forms."""
    tables = genes.gff_structure(features, genome_lengths)
    return tables | {"matrix": matrices.structure_matrix(tables["metrics"], species), "plot_rows": matrices.plot_rows(tables["distributions"])}


def intron_features(features: DataFrame, genome: DataFrame | None = None, only: Sequence[str] | None = None, **options) -> dict[str, DataFrame]:
    """All, short and unique introns with their summaries; ``only`` names the tables that are wanted, as the summary runs jobs of its own."""
    found = genes.introns(features, genome=genome, **options)
    unique = genes.unique_introns(found)
    tables = {
        "introns": lambda: found, "short": lambda: found.filter("is_short_intron"), "unique": lambda: unique, "members": lambda: genes.intron_members(found),
        "summary": lambda: genes.intron_summary(found), "sequences": lambda: genes.intron_sequence_summary(unique)}
    return {name: make() for name, make in tables.items() if only is None or name in only}


def gene_families(
    peptides: Mapping[str, DataFrame], counts: DataFrame, species: Sequence[str], members: DataFrame, targets: DataFrame, alignments: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Prefixed peptides of all species, family shapes, members of target families and the supermatrix."""
    prefixed = None
    for name, records in peptides.items():
        part = sequences.prefix_ids(records, name)
        prefixed = part if prefixed is None else prefixed.unionByName(part)
    out = {"families": families.family_summary(counts, species), "members": families.family_members(members, targets, prefixed)}
    if prefixed is not None:
        out["peptides"] = prefixed
    if alignments is not None:
        names = counts.select("species").distinct()
        out |= {f"supermatrix_{k}": v for k, v in sequences.supermatrix(alignments, names).items()}
    return out


def target_family(
    annotation: DataFrame, rule_table: DataFrame, peptides: DataFrame, found_hits: DataFrame | None = None, seeds: DataFrame | None = None, expression: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Rule evidence, target genes with tip table and sequences, and their expression."""
    evidence = rules.family_evidence(annotation, rule_table, found_hits, seeds)
    targets = evidence.select("gene_id").distinct()
    kept = peptides.join(targets.select(F.col("gene_id").alias("seqid")), "seqid", "left_semi")
    out = {"evidence": evidence, "summary": rules.evidence_summary(evidence), "targets": targets, "tips": families.family_inputs(targets, annotation, evidence),
           "peptides": kept, "missing": families.missing_targets(targets, peptides)}
    if expression is not None:
        details = matrices.gene_set_expression(expression, matrices.family_map(evidence, targets))
        out |= {"expression": details, "expression_summary": matrices.expression_summary(details)}
    return out


def family_changes(wide_counts: DataFrame, tips: Sequence[str], gain_loss: DataFrame | None = None, shape: DataFrame | None = None, max_copy: int | None = None) -> dict[str, DataFrame]:
    """Checked inference input, gain/loss summaries and filtered families."""
    checked = families.check_counts(wide_counts, tips)
    long = families.to_long_counts(wide_counts)
    out = {"accepted": checked.filter("reason is null").drop("reason"), "rejected": checked.filter("reason is not null").select("Family ID", "reason"),
           "cafe": families.cafe_matrix(wide_counts, tips), "filtered": families.filter_families(long, max_copy)}
    if gain_loss is not None:
        normal = families.normalize_gain_loss(gain_loss)
        out |= {"gain_loss": families.gain_loss_summary(normal, shape), "nodes": families.node_totals(normal)}
    return out


def synteny_context(links: DataFrame, target_regions: DataFrame | None = None, located_genes: DataFrame | None = None, metric: str = "blocks") -> dict[str, DataFrame]:
    """Pair summary, heat map and the synteny of regions."""
    summary = synteny.synteny_summary(links)
    out = {"summary": summary, "heatmap": synteny.synteny_heatmap(summary, metric, True)}
    if target_regions is not None and located_genes is not None:
        per_gene = synteny.links_per_gene(links)
        out |= {"regions": regions.region_synteny(target_regions, located_genes, per_gene), "region_details": regions.region_synteny_details(target_regions, located_genes, per_gene)}
    return out


def family_integration(
    candidates: DataFrame, taxonomy: DataFrame | None = None, members: DataFrame | None = None, evidence: DataFrame | None = None, gain_loss: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Refined donors and the family context of candidates."""
    refined = hits.refine_donors(candidates, taxonomy)
    whole = families.candidate_integration(candidates, refined, members, evidence, gain_loss)
    return {"refined": refined, "refined_summary": hits.refined_summary(refined), "integrated": whole, "integrated_summary": families.integration_summary(whole)}


def plot_matrices(
    sets: Mapping[str, DataFrame] | None = None, expression: DataFrame | None = None, evolution: DataFrame | None = None, candidates: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Membership, expression and status matrices for plotting."""
    out = {}
    if sets:
        out |= {"membership": matrices.membership_matrix(sets), "set_sizes": matrices.membership_sizes(sets)}
    if expression is not None:
        out["expression"] = matrices.expression_matrix(expression)
    if evolution is not None:
        out["evolution"] = matrices.status_matrix(evolution, "target_family_id", "evolution_status")
    if candidates is not None:
        out["candidates"] = matrices.status_matrix(candidates, "query_id", "target_family_status")
    return out


def enrichment_from_files(spark, target: str, feature_file: str, form: str, background: str | None = None, types: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Region enrichment straight from BED regions and BED or GFF features."""
    sets = gff.read_bed(spark, target, "target")
    if background:
        sets = sets.unionByName(gff.read_bed(spark, background, "background"))
    features = gff.bed_features(gff.read_bed(spark, feature_file, "feature")) if form == "bed" else gff.overlap_features(gff.read_gff(spark, feature_file), types)
    return {"enrichment": regions.region_enrichment(sets, features, with_background=background is not None), "details": regions.region_enrichment_details(sets, features)}


def coverage_tracks(features: DataFrame, kinds: Sequence[str] = ("mRNA", "CDS")) -> dict[str, DataFrame]:
    """Binned coverage of each kind of feature at its usual bin width."""
    return {k: coverage.binned_coverage(coverage.track_intervals(features, k), coverage.TRACK_BINS[k]) for k in kinds}
