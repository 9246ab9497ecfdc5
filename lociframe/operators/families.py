"""Gene families in long form (family_id, species, copies): shape, filters, events and integration."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import column_of, first_present, joined, labels, spread_missing, to_double, to_long
from .hits import source_rank

METRICS = ("gain", "loss", "expansion", "contraction")
EVENTS = (*METRICS, "total")


def column_values(df: DataFrame, column: str) -> list[str]:
    """Distinct values that are to become output columns, for callers without a manifest of them.

    A plan has to know its columns, so these names, and nothing else, come to the driver.
    """
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().toLocalIterator())


def to_long_counts(wide: DataFrame, species: Sequence[str] | None = None) -> DataFrame:
    """family_id/species/copies rows of a wide count table whose first column is the family."""
    first = wide.columns[0]
    names = list(species or [c for c in wide.columns if c != first and c.lower() != "total" and not c.startswith("_")])
    cells = wide.select(F.col(f"`{first}`").alias("family_id"), *[F.col(f"`{c}`").cast("string") for c in names])
    return cells.unpivot("family_id", names, "species", "raw").select(
        "family_id", "species", F.coalesce(to_long(F.col("raw")), F.lit(0)).alias("copies"))


def family_summary(counts: DataFrame, species: Sequence[str]) -> DataFrame:
    """Copies, occupancy and shape flags per family over a fixed species list."""
    known = counts.filter(F.col("species").isin(*species) & (F.col("copies") > 0)).groupBy("family_id", "species").agg(
        F.sum("copies").alias("copies"))
    every = F.array(*[F.lit(s) for s in species])
    per = known.groupBy("family_id").agg(
        F.sum("copies").alias("total_copies"), F.count(F.lit(1)).alias("species_present"),
        F.count_if(F.col("copies") == 1).alias("_single"), F.map_from_entries(F.collect_list(F.struct("species", "copies"))).alias("_m"),
    )
    # Families whose every count is zero keep their row.
    families = counts.select("family_id").distinct().join(per, "family_id", "left").na.fill(0, ["total_copies", "species_present", "_single"])
    copies = F.transform(every, lambda s: F.concat_ws(":", s, F.coalesce(F.try_element_at("_m", s), F.lit(0)).cast("string")))
    there = F.filter(every, lambda s: F.coalesce(F.try_element_at("_m", s), F.lit(0)) > 0)
    n = len(species)
    return families.select(
        "family_id", "total_copies", "species_present", F.lit(n).alias("species_total"),
        (F.col("species_present") / n).alias("occupancy"), (F.col("_single") == n).alias("single_copy_all_species"),
        (F.col("species_present") == n).alias("core_family"), (F.col("species_present") == 1).alias("lineage_specific"),
        joined(there, "NA").alias("present_species"), F.array_join(copies, ";").alias("copy_counts"),
    )


def filter_families(
    counts: DataFrame, max_copy: int | None = None, min_species: int = 1, remove_all_zero: bool = False
) -> DataFrame:
    """Families with the reasons that would remove them; ``reason`` is NULL for families to keep."""
    shape = counts.groupBy("family_id").agg(
        F.sum("copies").alias("_sum"), F.max("copies").alias("_max"), F.count_if(F.col("copies") > 0).alias("_present"))
    tests = []
    if remove_all_zero:
        tests.append((F.col("_sum") == 0, "all_zero"))
    if max_copy is not None:
        tests.append((F.col("_max") > max_copy, "max_copy"))
    tests.append((F.col("_present") < min_species, "min_species"))
    reasons = labels(*tests)
    return shape.select("family_id", F.when(F.size(reasons) > 0, F.array_join(reasons, ";")).alias("reason"))


def count_matrix(counts: DataFrame, species: Sequence[str], id_name: str = "family_id") -> DataFrame:
    """Families by species in the given order, absent counts as zero."""
    return counts.groupBy(F.col("family_id").alias(id_name)).agg(
        *[F.coalesce(F.sum(F.when(F.col("species") == s, F.col("copies"))), F.lit(0)).alias(s) for s in species])


def check_counts(wide: DataFrame, tips: Sequence[str], row_order: str = "_row") -> DataFrame:
    """Wide count rows checked for inference input: counts of the tree's tips, plus ``reason``.

    A count that is no number or negative rejects the row, as does a family id seen on an
    earlier line. A tip without a column is an error.
    """
    first = wide.columns[0]
    lost = sorted(set(tips) - set(wide.columns[1:]))
    if lost:
        raise ValueError("tree tips missing from count table: " + ", ".join(lost))
    parsed = {t: to_long(F.coalesce(F.when(F.col(f"`{t}`") != "", F.col(f"`{t}`")), F.lit("0"))) for t in tips}
    bad = {t: F.coalesce(v < 0, F.lit(True)) for t, v in parsed.items()}
    first_line = wide.groupBy(F.col(f"`{first}`").alias("_fam")).agg(F.min(row_order).alias("_first"))
    rows = wide.join(first_line, wide[first] == F.col("_fam"))
    reasons = labels((F.col(row_order) > F.col("_first"), "duplicate_family_id"), *[(c, f"invalid_count:{t}") for t, c in bad.items()])
    return rows.select(
        F.col("_fam").alias("Family ID"), *[F.when(bad[t], F.lit(0)).otherwise(parsed[t]).alias(t) for t in tips],
        F.when(F.size(reasons) > 0, F.array_join(reasons, ";")).alias("reason"))


def cafe_matrix(wide: DataFrame, tips: Sequence[str]) -> DataFrame:
    """Description, family id and species columns; empty counts become 0."""
    first = wide.columns[0]
    species = [c for c in wide.columns[1:] if c.lower() != "total" and not c.startswith("_")]
    lost = sorted(set(tips) - set(species))
    if lost:
        raise ValueError("tree tips missing from count table: " + ", ".join(lost))
    return wide.select(
        F.col(f"`{first}`").alias("Desc"), F.col(f"`{first}`").alias("Family ID"),
        *[F.coalesce(F.when(F.col(f"`{s}`") != "", F.col(f"`{s}`")), F.lit("0")).alias(s) for s in species])


def family_members(members: DataFrame, targets: DataFrame, id_map: DataFrame | None = None) -> DataFrame:
    """Distinct members of the target families under their mapped ids."""
    kept = members.join(targets.select("family_id").distinct(), "family_id", "left_semi").select("family_id", "gene_id")
    if id_map is not None:
        kept = kept.join(id_map.select(F.col("original_id").alias("gene_id"), "prefixed_id"), "gene_id", "left").select(
            "family_id", F.coalesce("prefixed_id", "gene_id").alias("gene_id"))
    return kept.distinct()


def family_fasta(members: DataFrame, proteins: DataFrame) -> DataFrame:
    """Sequences of each family's members; members without a sequence are left out."""
    return members.select("family_id", F.col("gene_id").alias("seqid")).join(proteins.select("seqid", "seq"), "seqid")


def node_events(counts: DataFrame, nodes: DataFrame, sources: DataFrame) -> DataFrame:
    """Gain, loss, expansion, contraction and presence of each flagged family at each node.

    Every node is compared with its parent one step up. Rows exist only where node or parent
    has a count, so families are never multiplied with all nodes.
    """
    flagged = counts.join(sources.select("family_id"), "family_id", "left_semi").filter("copies > 0")
    tree = nodes.select("node", "parent").distinct()
    as_node = flagged.join(tree, flagged["species"] == tree["node"]).select(
        "family_id", "node", "parent", F.col("copies").alias("node_count"), F.lit(0).cast("bigint").alias("parent_count"))
    as_parent = flagged.join(tree, flagged["species"] == tree["parent"]).select(
        "family_id", "node", "parent", F.lit(0).cast("bigint").alias("node_count"), F.col("copies").alias("parent_count"))
    pair = as_node.unionByName(as_parent).groupBy("family_id", "node", "parent").agg(
        F.max("node_count").alias("node_count"), F.max("parent_count").alias("parent_count"))
    n, p = F.col("node_count"), F.col("parent_count")
    events = labels(
        ((n > 0) & (p == 0), "gain"), ((n == 0) & (p > 0), "loss"), ((n > 1) & (p == 1), "expansion"),
        ((n == 1) & (p > 1), "contraction"), (n > 0, "total"))
    return pair.select("*", F.explode(events).alias("event")).join(
        sources.select("family_id", "majority_source"), "family_id")


def event_summary(events: DataFrame) -> DataFrame:
    """Events per node and parent."""
    wide = events.groupBy("node", "parent").agg(*[F.count_if(F.col("event") == e).alias(e) for e in EVENTS])
    return wide.withColumn("hgt_gain_expansion", F.col("gain") + F.col("expansion"))


def source_breakdown(events: DataFrame) -> DataFrame:
    """Families per node, event and donor source."""
    return events.groupBy("node", "event", "majority_source").agg(F.count(F.lit(1)).alias("orthogroup_count"))


def majority_source(rows: DataFrame, key: str) -> DataFrame:
    """Most frequent source per key; ties go by source order, then name. Missing sources do not vote."""
    votes = rows.select(key, F.trim("source").alias("source")).filter("source not in ('', 'NA')").groupBy(key, "source").agg(
        F.count(F.lit(1)).alias("_n"))
    return votes.groupBy(key).agg(
        F.min_by("source", F.struct(-F.col("_n"), source_rank(F.col("source")), F.lower("source"), F.col("source"))).alias("majority_source"))


def flag_families(members: DataFrame, transferred: DataFrame, min_ratio: float = 0.3) -> DataFrame:
    """Gene-centric method: share of transferred genes per family; flagged when above ``min_ratio``.

    ``members`` (family_id, gene_id) covers all genes, ``transferred`` (gene_id, source) has one
    row per transferred gene.
    """
    marked = members.select("family_id", "gene_id").join(transferred.select("gene_id", "source", F.lit(1).alias("_hit")), "gene_id", "left")
    sizes = marked.groupBy("family_id").agg(F.count(F.lit(1)).alias("total_genes"), F.count("_hit").alias("hgt_genes"))
    voted = sizes.join(majority_source(marked.filter("_hit = 1"), "family_id"), "family_id", "left")
    ratio = F.col("hgt_genes") / F.col("total_genes")
    return voted.select("family_id", "total_genes", "hgt_genes", ratio.alias("hgt_ratio"),
                        F.coalesce("majority_source", F.lit("NA")).alias("majority_source"), (ratio > min_ratio).alias("is_hgt_family"))


def map_families(groups: DataFrame, members: DataFrame) -> DataFrame:
    """Family-centric method: the all-gene family that shares most genes with each transferred group.

    ``groups`` (group_id, gene_id, source); ties go to the larger share of the family, then to
    the smaller id.
    """
    home = members.groupBy("gene_id").agg(F.max("family_id").alias("family_id"))
    sizes = members.groupBy("family_id").agg(F.count(F.lit(1)).alias("all_family_size"))
    shared = groups.join(home, "gene_id").groupBy("group_id", "family_id").agg(F.count(F.lit(1)).alias("overlap_gene_count"))
    rated = shared.join(sizes, "family_id").withColumn("overlap_rate", F.col("overlap_gene_count") / F.col("all_family_size"))
    best = rated.groupBy("group_id").agg(F.min_by(
        F.struct("family_id", "overlap_gene_count", "all_family_size", "overlap_rate"),
        F.struct(-F.col("overlap_gene_count"), -F.col("overlap_rate"), F.col("family_id"))).alias("_b")).select("group_id", "_b.*")
    totals = groups.groupBy("group_id").agg(F.count(F.lit(1)).alias("hgt_gene_count"))
    return totals.join(best, "group_id", "left").join(majority_source(groups, "group_id"), "group_id", "left").select(
        "group_id", "family_id", F.coalesce("overlap_gene_count", F.lit(0)).alias("overlap_gene_count"), "hgt_gene_count",
        F.coalesce("all_family_size", F.lit(0)).alias("all_family_size"), F.coalesce("overlap_rate", F.lit(0.0)).alias("overlap_rate"),
        F.coalesce("majority_source", F.lit("NA")).alias("majority_source"))


def mapped_sources(mapping: DataFrame) -> DataFrame:
    """family_id/majority_source of mapped families; of several groups the last id decides."""
    return mapping.filter("family_id is not null").groupBy("family_id").agg(F.max_by("majority_source", "group_id").alias("majority_source"))


def normalize_gain_loss(raw: DataFrame) -> DataFrame:
    """Long gain/loss table under alias names; absent events count 0."""
    return raw.select(
        first_present(raw, ["family_id", "Family ID", "family", "orthogroup"]).alias("family_id"),
        first_present(raw, ["node_id", "node", "branch"]).alias("node_id"),
        first_present(raw, ["node_label", "label", "species"]).alias("node_label"),
        *[F.coalesce(to_double(first_present(raw, names)), F.lit(0.0)).alias(names[0]) for names in (
            ("gain", "gains"), ("loss", "losses"), ("expansion", "expansions"), ("contraction", "contractions"))],
        first_present(raw, ["inferred_count", "count", "family_size"]).alias("inferred_count"))


def normalize_gain_loss_wide(raw: DataFrame) -> DataFrame:
    """The same from one column per node and metric, named ``node|metric`` or ``node_metric``."""
    first, wanted = raw.columns[0], (*METRICS, "count")
    cells = []
    for position, name in enumerate(raw.columns[1:]):
        node, _, metric = name.partition("|") if name.count("|") == 1 else name.rpartition("_")
        if node and metric in wanted:
            cells.append(F.struct(F.lit(node).alias("node_id"), F.lit(metric).alias("metric"),
                                  F.col(f"`{name}`").cast("string").alias("value"), F.lit(position).alias("position")))
    long = raw.select(F.col(f"`{first}`").alias("family_id"), F.inline(F.array(*cells))) if cells else None
    if long is None:
        raise ValueError("no column is named like node|metric or node_metric")

    def merged(metric: str) -> Column:
        used = (F.col("metric") == metric) & ~F.coalesce(F.col("value"), F.lit("NA")).isin("0", "NA")
        return F.max_by("value", F.when(used, F.col("position")))

    return long.groupBy("family_id", "node_id").agg(
        *[F.coalesce(to_double(merged(m)), F.lit(0.0)).alias(m) for m in METRICS], merged("count").alias("inferred_count")
    ).withColumn("node_label", F.col("node_id"))


def gain_loss_summary(gain_loss: DataFrame, families: DataFrame | None = None) -> DataFrame:
    """Gain/loss rows with their event status and, when given, the family's shape."""
    status = labels(*[(F.col(m) > 0, m) for m in METRICS])
    out = gain_loss.select(
        "family_id", F.coalesce("node_label", "node_id").alias("node_label"), *METRICS, "inferred_count",
        joined(status, "no_change").alias("event_status"))
    shape = ["total_copies", "species_present", "present_species"]
    if families is None:
        return out.select("*", *[F.lit(None).cast("string").alias(c) for c in shape])
    return out.join(families.select("family_id", *shape), "family_id", "left")


def node_totals(gain_loss: DataFrame) -> DataFrame:
    """Event totals and distinct families per node."""
    per = gain_loss.groupBy(F.coalesce("node_label", "node_id").alias("node_label"), "family_id").agg(*[F.sum(m).alias(m) for m in METRICS])
    return per.groupBy("node_label").agg(F.count(F.lit(1)).alias("family_count"), *[F.sum(m).alias(f"total_{m}") for m in METRICS])


def family_events(gain_loss: DataFrame) -> DataFrame:
    """One row per family: metric totals, status and the nodes of each metric (as many as the tree has)."""
    return gain_loss.groupBy("family_id").agg(
        *[F.sum(m).alias(m) for m in METRICS],
        *[F.array_sort(F.collect_set(F.when(F.col(m) > 0, F.coalesce("node_label", "node_id")))).alias(f"{m}_nodes") for m in METRICS])


def family_evolution(
    evidence: DataFrame, members: DataFrame | None = None, gain_loss: DataFrame | None = None
) -> DataFrame:
    """Target-family genes with their orthogroups and what happened to those on the tree.

    Family id and name travel as a pair. What is missing, and whether it was not given or not
    found, is written out in ``missing_data_note``.
    """
    genes = evidence.groupBy("gene_id", "family_id").agg(F.max("family_name").alias("family_name"))
    types = evidence.groupBy("gene_id").agg(F.array_join(F.array_sort(F.collect_set("evidence_type")), ";").alias("evidence_types"))
    rows = genes.join(types, "gene_id")
    if members is not None:
        rows = rows.join(members.select("gene_id", F.col("family_id").alias("orthogroup_id")).distinct(), "gene_id", "left")
    else:
        rows = rows.withColumn("orthogroup_id", F.lit(None).cast("string"))
    if gain_loss is not None:
        per = family_events(gain_loss).withColumn("_og", F.col("family_id").cast("string")).drop("family_id").withColumn("_has", F.lit(True))
        rows = rows.withColumn("_og", spread_missing(F.col("orthogroup_id"), "gene_id")).join(per, "_og", "left").drop("_og")
    else:
        rows = rows.select("*", *[F.lit(None).cast("double").alias(m) for m in METRICS],
                           *[F.lit(None).cast("array<string>").alias(f"{m}_nodes") for m in METRICS], F.lit(None).cast("boolean").alias("_has"))
    has = F.col("_has").isNotNull()
    no_group = F.col("orthogroup_id").isNull()
    notes = labels(
        (F.lit(members is None), "orthogroups"), (F.lit(members is not None) & no_group, "orthogroup_assignment"),
        (F.lit(gain_loss is None), "family_gain_loss"), (F.lit(gain_loss is not None) & ~has, "orthogroup_evolution_event"))
    status = labels(*[(F.coalesce(F.col(m), F.lit(0.0)) > 0, m) for m in METRICS])
    nodes = F.array_sort(F.array_distinct(F.flatten(F.array(*[f"{m}_nodes" for m in METRICS]))))
    plain = F.when(F.size(notes) > 0, "missing").otherwise("no_change")
    return rows.select(
        "gene_id", F.col("family_id").alias("target_family_id"), F.col("family_name").alias("target_family_name"), "orthogroup_id",
        "evidence_types", F.when(F.size(status) > 0, F.array_join(status, ";")).otherwise(plain).alias("evolution_status"),
        F.when(has, F.array_join(nodes, ";")).alias("event_nodes"), *[F.coalesce(F.col(m), F.lit(0.0)).alias(m) for m in METRICS],
        joined(notes, "none").alias("missing_data_note"))


def family_evolution_summary(detail: DataFrame) -> DataFrame:
    """Per target family: genes, orthogroups, genes with a signal, and the nodes of each metric."""
    keys = ["target_family_id", "target_family_name"]
    nodes = F.filter(F.split(F.coalesce("event_nodes", F.lit("")), ";"), lambda x: x != "")
    counts = detail.groupBy(*keys).agg(
        F.countDistinct("gene_id").alias("selected_genes"), F.countDistinct("orthogroup_id").alias("orthogroups"),
        F.countDistinct(F.when(~F.col("evolution_status").isin("no_change", "missing"), F.col("gene_id"))).alias("genes_with_evolution_signal"),
        F.array_sort(F.collect_set(F.when(F.col("missing_data_note") != "none", F.col("missing_data_note")))).alias("_notes"))
    per_node = detail.select(*keys, *METRICS, F.explode_outer(nodes).alias("_node")).groupBy(*keys).agg(
        *[F.array_sort(F.collect_set(F.when(F.col(m) > 0, F.col("_node")))).alias(f"_{m}") for m in METRICS])
    return counts.join(per_node, keys).select(
        *keys, "selected_genes", "orthogroups", "genes_with_evolution_signal",
        *[joined(F.col(f"_{m}"), "NA").alias(f"{m}_nodes") for m in METRICS], joined(F.col("_notes"), "none").alias("missing_data_note"))


def candidate_integration(
    candidates: DataFrame,
    refined: DataFrame | None = None,
    members: DataFrame | None = None,
    evidence: DataFrame | None = None,
    gain_loss: DataFrame | None = None,
) -> DataFrame:
    """Transfer candidates with orthogroup, target family and evolution context.

    Lookups go by query id first and by gene id where the query is unknown.
    """
    gene = column_of(candidates, "gene_id")
    base = candidates.select(
        F.col("query_id").cast("string").alias("query_id"), F.coalesce(gene.cast("string") if gene is not None else F.lit(None),
                                                                       F.col("query_id").cast("string")).alias("gene_id"),
        F.coalesce("best_donor_group", F.lit("NA")).alias("best_donor_group"),
        F.coalesce("best_donor_taxon", "best_donor_group", F.lit("NA")).alias("refined_donor_taxon"), "alien_index", "bitscore_delta")
    absent = [n for n, given in (("orthogroups", members), ("target_evidence", evidence), ("family_gain_loss", gain_loss),
                                 ("refined_donors", refined)) if given is None]
    if refined is not None:
        finer = refined.groupBy("query_id").agg(F.max(F.struct(F.col("best_donor_group").alias("_g"), F.col("refined_donor_taxon").alias("_t"))).alias("_f"))
        base = base.join(finer, "query_id", "left").select(
            "query_id", "gene_id", F.coalesce("_f._g", "best_donor_group").alias("best_donor_group"),
            F.coalesce("_f._t", "refined_donor_taxon").alias("refined_donor_taxon"), "alien_index", "bitscore_delta")

    def either(df: DataFrame, table: DataFrame, value: str) -> DataFrame:
        """Join ``table`` (key, value array) by query, then by gene."""
        by_query = table.select(F.col("_key").alias("query_id"), F.col(value).alias("_q"))
        by_gene = table.select(F.col("_key").alias("gene_id"), F.col(value).alias("_g"))
        return df.join(by_query, "query_id", "left").join(by_gene, "gene_id", "left").withColumn(value, F.coalesce("_q", "_g")).drop("_q", "_g")

    if members is not None:
        groups = members.groupBy(F.col("gene_id").cast("string").alias("_key")).agg(F.array_sort(F.collect_set("family_id")).alias("_ogs"))
        base = either(base, groups, "_ogs").select("*", F.explode_outer("_ogs").alias("orthogroup_id")).drop("_ogs")
    else:
        base = base.withColumn("orthogroup_id", F.lit(None).cast("string"))
    if evidence is not None:
        families = evidence.groupBy(F.col("gene_id").cast("string").alias("_key")).agg(F.array_sort(F.collect_set("family_id")).alias("_fams"))
        base = either(base, families, "_fams")
    else:
        base = base.withColumn("_fams", F.lit(None).cast("array<string>"))
    if gain_loss is not None:
        per = family_events(gain_loss)
        found = labels(*[(F.col(m) > 0, m) for m in sorted(METRICS)])
        nodes = F.array_sort(F.array_distinct(F.flatten(F.array(*[f"{m}_nodes" for m in METRICS]))))
        base = base.withColumn("_og", spread_missing(F.col("orthogroup_id"), "query_id")).join(
            per.select(F.col("family_id").cast("string").alias("_og"), joined(found, "no_change").alias("_status"), joined(nodes, "NA").alias("_nodes")), "_og", "left").drop("_og")
    else:
        base = base.select("*", F.lit(None).cast("string").alias("_status"), F.lit(None).cast("string").alias("_nodes"))
    notes = F.array_sort(F.concat(F.array(*[F.lit(a) for a in absent]).cast("array<string>"), labels(
        (F.col("orthogroup_id").isNull(), "orthogroup_assignment"),
        (F.col("_status").isNull() & F.lit(gain_loss is not None), "orthogroup_evolution_event"))))
    is_target = F.size(F.coalesce("_fams", F.array().cast("array<string>"))) > 0
    return base.select(
        "query_id", "gene_id", "best_donor_group", "refined_donor_taxon", "orthogroup_id",
        F.when(is_target, "target_family").otherwise("not_target_family").alias("target_family_status"),
        F.when(is_target, F.array_join("_fams", ";")).alias("target_family_ids"), F.coalesce("_status", F.lit("missing")).alias("evolution_status"),
        F.when(F.col("_nodes") != "NA", F.col("_nodes")).alias("event_nodes"), "alien_index", "bitscore_delta",
        joined(notes, "none").alias("missing_data_note"))


def integration_summary(integrated: DataFrame) -> DataFrame:
    """Candidates per donor group, target-family status and evolution status."""
    pairs = F.array(*[
        F.struct(F.lit(label).alias("category"), F.col(c).alias("value"))
        for label, c in (("donor_group", "best_donor_group"), ("target_family_status", "target_family_status"), ("evolution_status", "evolution_status"))])
    return integrated.select(F.inline(pairs)).groupBy("category", "value").agg(F.count(F.lit(1)).alias("candidate_count"))


def family_inputs(targets: DataFrame, annotation: DataFrame | None = None, evidence: DataFrame | None = None) -> DataFrame:
    """Tip table of the target genes: families, names and annotation."""
    out = targets.select(F.col("gene_id").cast("string")).distinct()
    if evidence is not None:
        sets = evidence.groupBy(F.col("gene_id").cast("string").alias("gene_id")).agg(
            F.array_join(F.array_sort(F.collect_set("family_id")), ";").alias("family_ids"),
            F.array_join(F.array_sort(F.collect_set(F.coalesce("family_name", "family_id"))), ";").alias("family_names"))
        out = out.join(sets, "gene_id", "left")
    else:
        out = out.select("*", F.lit(None).cast("string").alias("family_ids"), F.lit(None).cast("string").alias("family_names"))
    if annotation is None:
        nothing = F.lit(None).cast("string")
        return out.select("gene_id", "family_ids", "family_names", F.col("gene_id").alias("gene_name"),
                          *[nothing.alias(c) for c in ("description", "Pfam_ids", "KO_ids", "GO_terms")])
    kos = F.filter(F.array(first_present(annotation, ["KEGG_ko"]), first_present(annotation, ["Kofam_ko"])), lambda x: x.isNotNull() & (x != "NA"))
    notes = annotation.select(
        first_present(annotation, ["transcript_id", "gene_id"]).alias("gene_id"), F.struct(
            first_present(annotation, ["gene_id"]).alias("gene_name"),
            first_present(annotation, ["SwissProt_description", "NR_description"]).alias("description"),
            first_present(annotation, ["Pfam_ids"]).alias("Pfam_ids"), joined(kos, "NA").alias("KO_ids"),
            first_present(annotation, ["GO_terms"]).alias("GO_terms")).alias("_n")).groupBy("gene_id").agg(F.max("_n").alias("_n"))
    return out.join(notes, "gene_id", "left").select(
        "gene_id", "family_ids", "family_names", F.coalesce("_n.gene_name", "gene_id").alias("gene_name"), "_n.description",
        "_n.Pfam_ids", "_n.KO_ids", "_n.GO_terms")


def missing_targets(targets: DataFrame, sequences: DataFrame) -> DataFrame:
    """Target genes without a sequence."""
    have = sequences.select(F.col("seqid").alias("gene_id"))
    return targets.select("gene_id").distinct().join(have, "gene_id", "left_anti").withColumn("reason", F.lit("missing_from_peptide_fasta"))
