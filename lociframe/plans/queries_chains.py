"""Tables of whole analyses, held against the SQL of the step that makes them."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import chains, queries_families, queries_genes, queries_hits, queries_regions, queries_terms
from .catalogue import CHECKS, Source, query, rounded


def step(name: str):
    """Register a query under its function's name with the SQL of the query of a step."""
    def register(build):
        build = query()(build)
        CHECKS[build.__name__] = CHECKS[name]
        return build

    return register


@step("region_enrichment_details")
def chain_region_context(t: Source) -> DataFrame:
    return chains.region_context(t.regions, t.features, t.sites)["details"]


@step("te_divergence")
def chain_repeat_context(t: Source) -> DataFrame:
    repeats = t.lineitem.select(
        F.col("l_returnflag").alias("repeat_class"), F.col("l_linestatus").alias("repeat_family"), (F.col("l_discount") * 100).alias("divergence"),
        F.col("l_quantity").cast("bigint").alias("length"))
    return rounded(chains.repeat_context(repeats=repeats, substitution_rate=1e-8)["divergence_summary"], "mean_divergence", "median_divergence", "mean_insertion_time_mya")


@step("structure_metrics")
def chain_gene_structure(t: Source) -> DataFrame:
    return rounded(chains.gene_structure(queries_genes._features(t), species=["sp"])["metrics"].select("metric", "value"), "value")


@step("unique_introns")
def chain_intron_features(t: Source) -> DataFrame:
    return chains.intron_features(queries_genes._features(t), only=["unique"])["unique"]


@step("synteny_heatmap")
def chain_synteny_context(t: Source) -> DataFrame:
    return chains.synteny_context(queries_families._links(t), t.regions, queries_regions._genes(t), "linked_gene_pairs")["heatmap"]


@step("condition_matrices")
def chain_transfer_events(t: Source) -> DataFrame:
    species = t.orders.select(F.col("o_orderstatus").alias("species"))
    members = t.lineitem.select(F.col("l_partkey").cast("string").alias("family_id"), F.col("l_orderkey").alias("gene_id"))
    tables = chains.transfer_events(queries_hits.lineage(t), species, members, t.node_counts, t.node_parent, ["donor_a", "donor_b"])
    return rounded(tables["matrix"], "donor_a_prop", "donor_b_prop")


@step("top_terms")
def chain_term_handoff(t: Source) -> DataFrame:
    names = t.part.groupBy(F.col("p_brand").alias("term_id")).agg(F.min("p_type").alias("term_name")).withColumn("ontology", F.lit("part"))
    return rounded(chains.go_handoff(queries_terms._enrichment(t), names, 10, 0.999), "p_value", "q_value")


@step("membership_matrix")
def chain_plot_matrices(t: Source) -> DataFrame:
    sets = {n: t.orders.filter(c).select(F.col("o_orderkey").alias("gene_id")) for n, c in queries_families.SETS.items()}
    return chains.plot_matrices(sets)["membership"]


@step("refine_donors_summary")
def chain_family_integration(t: Source) -> DataFrame:
    known = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).otherwise(-F.col("o_orderkey") - 1)
    taxonomy = t.orders.select(known.alias("query_id"), F.col("o_orderpriority").alias("refined_donor_taxon"), F.col("o_orderstatus").alias("lineage"))
    return chains.family_integration(queries_hits.scored(t), taxonomy)["refined_summary"]


@step("rule_evidence_summary")
def chain_target_family(t: Source) -> DataFrame:
    part = t.part.select(F.col("p_partkey").cast("string").alias("transcript_id"), "p_name", "p_type", F.concat(F.lit("NA;"), "p_brand", F.lit(", "), "p_type").alias("terms"))
    key = F.col("o_orderkey").cast("string")
    seeds = t.orders.select(F.when(F.col("o_orderstatus") == "P", key).otherwise(F.translate(key, "0123456789", "abcdefghij")).alias("gene_id"))
    peptides = t.dna.select(F.col("seqid").cast("string").alias("seqid"), "seq")
    return chains.target_family(part, queries_terms._rule_table(t), peptides, t.hits.filter("evalue <= 3e-5"), seeds)["summary"]
