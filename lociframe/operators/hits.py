"""Similarity hits: selection, taxonomy classification, candidate scoring and the tables built on them."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import MISSING, column_of, first_present, joined, labels, present, to_double, to_long
from .summaries import last_by

CANDIDATE_COLUMNS = (
    "query_id", "best_donor_hit", "best_donor_taxon", "best_donor_group", "best_donor_evalue", "best_donor_bitscore",
    "best_ingroup_hit", "best_ingroup_taxon", "best_ingroup_evalue", "best_ingroup_bitscore", "alien_index",
    "bitscore_delta", "candidate_status", "filter_reason",
)

# Order in which donor sources are listed and in which ties between them are settled.
SOURCE_ORDER = ("virus", "bacteria", "fungi", "metazoa", "archaea", "other")


def source_rank(source: Column) -> Column:
    """Position in ``SOURCE_ORDER``; unlisted sources come after all of them."""
    order = F.array(*[F.lit(s) for s in SOURCE_ORDER])
    found = F.array_position(order, F.lower(source))
    return F.when(found > 0, found - 1).otherwise(len(SOURCE_ORDER))


def passing(
    hits: DataFrame,
    max_evalue: float | None = None,
    min_bitscore: float | None = None,
    min_pident: float | None = None,
    min_query_cover: float | None = None,
) -> Column:
    """Condition that a hit meets every given threshold (limits included)."""
    tests = [
        (max_evalue, lambda v: hits["evalue"] <= v), (min_bitscore, lambda v: hits["bitscore"] >= v),
        (min_pident, lambda v: hits["pident"] >= v), (min_query_cover, lambda v: hits["query_coverage"] >= v),
    ]
    keep = F.lit(True)
    for limit, test in tests:
        if limit is not None:
            keep = keep & test(limit)
    return keep


def select_hits(
    hits: DataFrame, top: int | None = 1, max_evalue: float | None = None, min_bitscore: float | None = None,
    tie_break: Sequence[str] = ("subject_id",),
) -> DataFrame:
    """Best ``top`` hits per query (lowest e-value, then highest bitscore); all of them when ``top`` is None.

    The rank filter lets Spark keep only ``top`` rows per query before the shuffle.
    """
    kept = hits.filter(passing(hits, max_evalue, min_bitscore))
    if top is None:
        return kept
    order = Window.partitionBy("query_id").orderBy(F.col("evalue"), F.col("bitscore").desc(), *tie_break)
    return kept.withColumn("hit_rank", F.row_number().over(order)).filter(F.col("hit_rank") <= top)


def raw_hit_table(hits: DataFrame, max_evalue: float) -> DataFrame:
    """The four columns handed to taxonomy lookup, weak hits removed."""
    return hits.filter(F.col("evalue") <= max_evalue).select("query_id", "subject_id", "evalue", "bitscore")


def normalize_hits(raw: DataFrame) -> DataFrame:
    """Hit columns under their usual alias names, numbers parsed with neutral defaults."""
    def number(names: Sequence[str], default: float) -> Column:
        return F.coalesce(to_double(first_present(raw, names)), F.lit(default))

    return raw.select(
        first_present(raw, ["query_id", "qseqid", "query"], "NA").alias("query_id"),
        first_present(raw, ["subject_id", "sseqid", "subject"], "NA").alias("subject_id"),
        number(["pident", "identity"], 0.0).alias("pident"),
        number(["query_coverage", "qcovhsp", "qcov", "qcovs"], 0.0).alias("query_coverage"),
        number(["evalue", "e_value"], 1.0).alias("evalue"),
        number(["bitscore", "bit_score"], 0.0).alias("bitscore"),
    )


def normalize_taxonomy(raw: DataFrame, row_order: str | None = None) -> DataFrame:
    """Taxonomy by subject under alias names; with ``row_order`` the last row of a subject counts."""
    values = ["taxid", "scientific_name", "lineage", "taxon_group"]
    extra = [raw[row_order].alias("_order")] if row_order else []
    table = raw.select(
        first_present(raw, ["subject_id", "sseqid", "subject", "id"]).alias("subject_id"),
        first_present(raw, ["taxid", "staxids"], "NA").alias("taxid"),
        first_present(raw, ["scientific_name", "name", "taxon_name"], "NA").alias("scientific_name"),
        first_present(raw, ["lineage", "full_lineage"], "NA").alias("lineage"),
        first_present(raw, ["taxon_group", "group", "lineage_group"], "NA").alias("taxon_group"),
        *extra,
    ).filter("subject_id is not null and subject_id <> 'NA'")
    return last_by(table, ["subject_id"], "_order", values) if row_order else table


def classify_hits(
    hits: DataFrame,
    taxonomy: DataFrame,
    ingroup: Sequence[str],
    donor: Sequence[str],
    exclude: Sequence[str] = (),
    max_evalue: float | None = 1e-5,
    min_pident: float | None = None,
    min_query_cover: float | None = None,
) -> DataFrame:
    """Hits with their taxonomy and class; excluded groups win over ingroup, ingroup over donor."""
    group = F.col("taxon_group")
    hit_class = (
        F.when(group.isin(*exclude) if exclude else F.lit(False), "exclude")
        .when(group.isin(*ingroup), "ingroup").when(group.isin(*donor), "donor").otherwise("unknown")
    )
    kept = hits.filter(passing(hits, max_evalue, None, min_pident, min_query_cover))
    return kept.join(taxonomy, "subject_id", "left").withColumn("hit_class", hit_class)


def classification_summary(
    hits: DataFrame, classified: DataFrame, max_evalue: float | None = 1e-5, min_pident: float | None = None,
    min_query_cover: float | None = None,
) -> DataFrame:
    """Hits per class plus the number filtered out; classes without hits are listed with zero."""
    classes = ("ingroup", "donor", "exclude", "unknown")
    counts = classified.agg(*[F.count_if(F.col("hit_class") == c).alias(c) for c in classes])
    filtered = hits.agg(F.count_if(~passing(hits, max_evalue, None, min_pident, min_query_cover)).alias("filtered"))
    both = counts.unionByName(filtered, allowMissingColumns=True)
    return both.unpivot([], [*classes, "filtered"], "metric", "value").groupBy("metric").agg(F.sum("value").alias("value"))


def score_candidates(
    classified: DataFrame,
    min_alien_index: float = 30.0,
    min_donor_bitscore: float = 50.0,
    min_query_cover: float = 0.0,
    max_evalue: float = 1e-5,
    tie_break: Sequence[str] = ("subject_id",),
) -> DataFrame:
    """Best donor against best ingroup hit per query, with status and the reasons of a rejection.

    Both picks are minimum-by aggregates of one pass, so hits shuffle once and are combined on
    the map side first; a query with very many hits costs no more than any other.
    """
    order = F.struct(-F.col("bitscore"), F.col("evalue"), *tie_break)
    fields = F.struct("subject_id", "scientific_name", "taxon_group", "evalue", "bitscore", "query_coverage")

    def pick(name: str) -> Column:
        of_class = F.col("hit_class") == name
        return F.min_by(fields, F.when(of_class, order)).alias(name)

    best = classified.groupBy("query_id").agg(
        pick("donor"), pick("ingroup"), F.count_if(F.col("hit_class") == "donor").alias("_nd"),
        F.count_if(F.col("hit_class") == "ingroup").alias("_ni"),
    )
    has_donor, has_ingroup = F.col("_nd") > 0, F.col("_ni") > 0

    def strength(side: str, has: Column) -> Column:
        return F.when(has, -F.log10(F.greatest(F.col(f"{side}.evalue"), F.lit(1e-300)))).otherwise(F.lit(0.0))

    def of(side: str, has: Column, field: str) -> Column:
        return F.when(has, F.col(f"{side}.{field}"))

    scored = best.withColumn("alien_index", strength("donor", has_donor) - strength("ingroup", has_ingroup)).withColumn(
        "bitscore_delta",
        F.coalesce(of("donor", has_donor, "bitscore"), F.lit(0.0)) - F.coalesce(of("ingroup", has_ingroup, "bitscore"), F.lit(0.0)),
    )
    reasons = labels(
        (~has_donor, "no_donor_hit"),
        (has_donor & (F.col("donor.bitscore") < min_donor_bitscore), "low_donor_bitscore"),
        (has_donor & (F.col("donor.evalue") > max_evalue), "weak_donor_evalue"),
        (has_donor & (F.col("donor.query_coverage") < min_query_cover), "low_query_coverage"),
        (~has_ingroup, "no_ingroup_comparison"),
        (has_donor & has_ingroup & (F.col("alien_index") < min_alien_index), "low_alien_index"),
    )
    return scored.select(
        "query_id", of("donor", has_donor, "subject_id").alias("best_donor_hit"),
        of("donor", has_donor, "scientific_name").alias("best_donor_taxon"),
        of("donor", has_donor, "taxon_group").alias("best_donor_group"),
        of("donor", has_donor, "evalue").alias("best_donor_evalue"),
        of("donor", has_donor, "bitscore").alias("best_donor_bitscore"),
        of("ingroup", has_ingroup, "subject_id").alias("best_ingroup_hit"),
        of("ingroup", has_ingroup, "scientific_name").alias("best_ingroup_taxon"),
        of("ingroup", has_ingroup, "evalue").alias("best_ingroup_evalue"),
        of("ingroup", has_ingroup, "bitscore").alias("best_ingroup_bitscore"),
        "alien_index", "bitscore_delta",
        F.when(F.size(reasons) == 0, "candidate").otherwise("rejected").alias("candidate_status"),
        joined(reasons, "pass").alias("filter_reason"),
    )


def reject_reasons(scored: DataFrame) -> DataFrame:
    """Queries per status and single reason."""
    return (
        scored.select("candidate_status", F.explode(F.split("filter_reason", ";")).alias("filter_reason"))
        .groupBy("candidate_status", "filter_reason").agg(F.count(F.lit(1)).alias("queries"))
    )


def status_counts(df: DataFrame, column: str) -> DataFrame:
    """metric/value counts of one column."""
    return df.groupBy(F.col(column).alias("metric")).agg(F.count(F.lit(1)).alias("value"))


def filter_lineage_table(
    lineage: DataFrame,
    ingroup_group: str,
    donor_groups: Sequence[str],
    min_alien_index: float = 0.0,
    min_bitscore_delta: float = 0.0,
    min_donor_bitscore: float = 50.0,
    min_donor_taxon_count: int = 1,
) -> DataFrame:
    """Candidates from the wide per-group hit table (see ``sources.reports.read_lineage_table``).

    The group is the bitscore winner unless unknown, else the alien-index winner. A value equal
    to its limit passes.
    """
    h = F.coalesce(F.col("h_taxon"), F.lit("NA"))
    group = F.when(h != "unknown", h).otherwise(F.coalesce(F.col("alien_index_taxon"), F.lit("NA")))
    missing = ("", "-", "NA")

    def number(name: str) -> Column:
        return F.coalesce(to_double(present(F.col(name), missing)), F.lit(0.0))

    count = F.coalesce(to_long(present(F.col("donor_taxon_count"), missing)), F.lit(0))
    wanted = [d.strip().lower() for d in donor_groups]
    key = F.lower(group)
    reasons = labels(
        (~key.isin(*wanted), "donor_group_not_selected"),
        (key == ingroup_group.lower(), "best_group_is_ingroup"),
        (number("alien_index") < min_alien_index, "low_alien_index"),
        (number("bitscore_delta") < min_bitscore_delta, "low_bitscore_delta"),
        (number("donor_bitscore") < min_donor_bitscore, "low_donor_bitscore"),
        (count < min_donor_taxon_count, "low_donor_taxon_count"),
    )
    matching = F.filter(F.map_entries("donor_evalues"), lambda e: F.lower(e["key"]) == key)
    nothing = F.lit(None).cast("string")
    return lineage.select(
        "query_id", nothing.alias("best_donor_hit"), group.alias("best_donor_taxon"), group.alias("best_donor_group"),
        F.get(matching, F.lit(0))["value"].alias("best_donor_evalue"), F.col("donor_bitscore").alias("best_donor_bitscore"),
        nothing.alias("best_ingroup_hit"), F.lit(ingroup_group).alias("best_ingroup_taxon"),
        F.col("self_evalue").alias("best_ingroup_evalue"), F.col("self_bitscore").alias("best_ingroup_bitscore"),
        "alien_index", "bitscore_delta",
        F.when(F.size(reasons) == 0, "candidate").otherwise("rejected").alias("candidate_status"),
        joined(reasons, "pass").alias("filter_reason"),
    )


def donor_group_table(classified: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Best e-value and bitscore per query and taxon group, one column pair per group of the given list."""
    measures = []
    for g in groups:
        mine = F.col("taxon_group") == g
        measures += [
            F.min(F.when(mine, F.col("evalue"))).alias(f"{g}_evalue"),
            F.max(F.when(mine, F.col("bitscore"))).alias(f"{g}_bitscore"),
        ]
    return classified.groupBy("query_id").agg(*measures)


def group_scores(classified: DataFrame) -> DataFrame:
    """Best e-value and bitscore and the distinct subjects of each query and taxon group, one row each."""
    return classified.filter("taxon_group is not null").groupBy("query_id", "taxon_group").agg(
        F.min("evalue").alias("evalue"), F.max("bitscore").alias("bitscore"), F.countDistinct("subject_id").alias("subjects"))


def lineage_from_scores(scores: DataFrame, ingroup_group: str, excluded: Sequence[str] = (), species: Column | None = None, digits: int = 6) -> DataFrame:
    """Per-query table of hits by taxon group, in the shape of ``sources.reports.read_lineage_table``, from ``group_scores``.

    One aggregate over the long scores: groups become the keys of two maps, and each query keeps its two best
    groups by e-value and by bitscore, so the winners and what sets them apart from the runner-up need no
    column per group. ``alien_index`` is the log10 distance of the best e-values of ingroup and donors (floor
    1e-300, a missing side counts zero), ``bitscore_delta`` that of the bitscores; ``h_taxon`` is the donor
    group of the best bitscore, ``unknown`` without one. Ties go to the first group by name. Figures are text,
    rounded to ``digits``. ``excluded`` groups (names in any case) are neither ingroup nor donor.
    """
    name = F.lower(F.col("taxon_group"))
    inner = name == ingroup_group.lower()
    donor = ~inner & ~name.isin(*[x.lower() for x in excluded]) if excluded else ~inner
    entry = lambda c: F.when(donor, F.struct("taxon_group", F.col(c).cast("string")))
    ranks = {
        "_by_e": F.when(donor, F.struct(F.col("evalue").alias("at"), "taxon_group", "evalue")),
        "_by_b": F.when(donor, F.struct((-F.col("bitscore")).alias("at"), "taxon_group", "bitscore")),
    }
    best = scores.groupBy("query_id").agg(
        F.min(F.when(inner, F.col("evalue"))).alias("_self_e"), F.max(F.when(inner, F.col("bitscore"))).alias("_self_b"),
        F.array_sort(F.collect_list(entry("evalue"))).alias("_e"), F.array_sort(F.collect_list(entry("bitscore"))).alias("_b"),
        *[F.slice(F.array_sort(F.collect_list(r)), 1, 2).alias(n) for n, r in ranks.items()], F.sum(F.when(donor, F.col("subjects"))).alias("_n"))

    def strength(evalue: Column) -> Column:
        return F.when(evalue.isNotNull(), -F.log10(F.greatest(evalue, F.lit(1e-300)))).otherwise(F.lit(0.0))

    first_e, first_b, second_b = F.get("_by_e", F.lit(0)), F.get("_by_b", F.lit(0)), F.get("_by_b", F.lit(1))
    delta = F.coalesce(first_b["bitscore"], F.lit(0.0)) - F.coalesce("_self_b", F.lit(0.0))
    text = lambda c: F.round(c, digits).cast("string")
    return best.select(
        (F.lit(None).cast("string") if species is None else species).alias("species"), "query_id", F.col("_self_e").cast("string").alias("self_evalue"),
        F.map_from_entries("_e").alias("donor_evalues"), text(strength(first_e["evalue"]) - strength(F.col("_self_e"))).alias("alien_index"),
        first_e["taxon_group"].alias("alien_index_taxon"), F.col("_self_b").cast("string").alias("self_bitscore"), F.map_from_entries("_b").alias("donor_bitscores"),
        text(delta).alias("bitscore_delta"), text(F.when(F.col("_self_b") > 0, delta / F.col("_self_b") * 100)).alias("bitscore_delta_percent"),
        text(F.when(F.col("_self_b") > 0, first_b["bitscore"] / F.col("_self_b"))).alias("bit_ratio"), F.coalesce(first_b["taxon_group"], F.lit("unknown")).alias("h_taxon"),
        first_b["bitscore"].cast("string").alias("donor_bitscore"), F.coalesce("_n", F.lit(0)).cast("string").alias("donor_taxon_count"),
        second_b["taxon_group"].alias("runner_up_taxon"), text(first_b["bitscore"] - second_b["bitscore"]).alias("runner_up_delta"))


def validation_set(
    candidates: DataFrame, classified: DataFrame, top: int = 5, tie_break: Sequence[str] = ("subject_id",)
) -> DataFrame:
    """Candidates with their ``top`` best donor subjects in one cell."""
    order = Window.partitionBy("query_id").orderBy(F.col("bitscore").desc(), F.col("evalue"), *tie_break)
    donors = (
        classified.filter("hit_class = 'donor'").select("query_id", "subject_id", "bitscore", "evalue", *[
            c for c in tie_break if c not in ("subject_id", "bitscore", "evalue")
        ])
        .withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= top)
        .groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("_rank", "subject_id"))).alias("_top"))
    )
    ids = F.array_join(F.transform("_top", lambda x: x["subject_id"].cast("string")), ",")
    return candidates.filter(F.col("validation_priority").isin("high", "review")).join(donors, "query_id", "left").select(
        "query_id", ids.alias("top_donor_subject_ids"),
        F.lit("homolog tree of the candidate").alias("recommended_validation"), "validation_priority", "missing_data_note",
    )


def refine_donors(candidates: DataFrame, taxonomy: DataFrame | None = None, rank: str = "genus") -> DataFrame:
    """Candidates with a finer donor taxon where the taxonomy table knows the query.

    ``taxonomy`` has one row per query_id: refined_donor_taxon (NULL when unknown) and lineage.
    """
    def value(name: str, default: str | None) -> Column:
        col = column_of(candidates, name)
        options = [present(col.cast("string"), ("", "NA", "unknown"))] if col is not None else []
        return F.coalesce(*options, F.lit(default)) if options else F.lit(default).cast("string")

    base = candidates.select(
        "query_id", value("best_donor_group", "unknown").alias("best_donor_group"),
        value("best_donor_taxon", "unknown").alias("best_donor_taxon"), value("alien_index", None).alias("alien_index"),
        value("best_donor_bitscore", None).alias("best_donor_bitscore"),
    )
    fallback = F.coalesce(
        F.when(F.col("best_donor_taxon") != "unknown", F.col("best_donor_taxon")), F.col("best_donor_group")
    )
    if taxonomy is None:
        known, looked_up = F.lit(False), base.select(
            "*", F.lit(None).cast("string").alias("_taxon"), F.lit(None).cast("string").alias("lineage")
        )
        rank_label = "group"
    else:
        table = taxonomy.select("query_id", F.col("refined_donor_taxon").alias("_taxon"), "lineage", F.lit(True).alias("_known"))
        looked_up, known, rank_label = base.join(table, "query_id", "left"), F.col("_known").isNotNull(), rank
    return looked_up.select(
        "query_id", "best_donor_group", "best_donor_taxon",
        F.when(known, F.coalesce("_taxon", F.lit("NA"))).otherwise(fallback).alias("refined_donor_taxon"),
        F.lit(rank_label).alias("refined_donor_rank"), "lineage",
        F.when(known, "refined").otherwise("group_only").alias("taxonomy_status"), "alien_index", "best_donor_bitscore",
        F.when(known, "taxonomy_table").otherwise("hit_table").alias("donor_taxon_source"),
    )


def refined_taxonomy(raw: DataFrame, rank: str = "genus", row_order: str | None = None) -> DataFrame:
    """Lookup for ``refine_donors`` from a free-form taxonomy table."""
    missing = ("", "NA", "unknown")
    table = raw.select(
        first_present(raw, ["query_id", "gene_id", "transcript_id", "candidate_id", "subject_id"], None, missing).alias("query_id"),
        first_present(raw, [rank, "refined_donor_taxon", "taxon", "name", "lineage"], None, missing).alias("refined_donor_taxon"),
        first_present(raw, ["lineage", "full_lineage", "taxonomy"], None, missing).alias("lineage"),
        *([raw[row_order].alias("_order")] if row_order else []),
    ).filter("query_id is not null")
    return last_by(table, ["query_id"], "_order", ["refined_donor_taxon", "lineage"]) if row_order else table


def refined_summary(refined: DataFrame) -> DataFrame:
    """Candidates per refined taxon and donor group."""
    return refined.groupBy(
        F.col("refined_donor_rank").alias("rank"), F.col("refined_donor_taxon").alias("donor_taxon"), F.col("best_donor_group").alias("donor_group"),
    ).agg(F.count(F.lit(1)).alias("candidate_count"))


def condition_candidates(
    lineage: DataFrame, donors: Sequence[str], excluded: Sequence[str], min_alien_index: float = 0.0
) -> DataFrame:
    """Rows of both conditions: alien index strictly above the limit and a selected donor group; the
    second condition also wants the bitscore winner to be the same group (case ignored)."""
    def clean(name: str) -> Column:
        return F.trim(F.coalesce(present(F.col(name)), F.lit("NA")))

    index = F.coalesce(to_double(present(F.col("alien_index").cast("string"), ("", "NA", "-"))), F.lit(0.0))
    wanted = [d.strip().lower() for d in donors]
    unwanted = [d.strip().lower() for d in excluded] or [""]
    rows = lineage.select(
        "species", "query_id", index.alias("alien_index"), clean("alien_index_taxon").alias("AI_taxon"),
        clean("h_taxon").alias("h_taxon"),
    )
    key = F.lower("AI_taxon")
    kept = rows.filter(key.isin(*wanted) & ~key.isin(*unwanted) & (F.col("alien_index") > min_alien_index))
    conditions = F.array_compact(F.array(
        F.lit("Condition1"), F.when(key == F.lower("h_taxon"), F.lit("Condition2"))
    ))
    return kept.withColumn("condition", F.explode(conditions))


def condition_matrices(
    candidates: DataFrame, species: DataFrame, donors: Sequence[str], conditions: Sequence[str] = ("Condition1", "Condition2")
) -> DataFrame:
    """Candidates per condition, species and donor group: a count and a proportion column per donor.

    Every species of the manifest is listed, with zeros when it has no candidate or no input yet.
    """
    wanted = species.select("species").distinct().select(
        "species", F.explode(F.array(*[F.lit(c) for c in conditions])).alias("condition")
    )
    counts = candidates.groupBy("condition", "species").agg(
        *[F.count_if(F.col("AI_taxon") == d).alias(d) for d in donors], F.count(F.lit(1)).alias("total")
    )
    full = wanted.join(counts, ["condition", "species"], "left").na.fill(0, [*donors, "total"])
    share = [F.when(F.col("total") > 0, F.col(d) / F.col("total")).otherwise(F.lit(0.0)).alias(f"{d}_prop") for d in donors]
    return full.select("condition", "species", *donors, "total", *share)


def donor_columns(candidates: DataFrame, defaults: Sequence[str]) -> list[str]:
    """Donor groups seen plus the defaults, in ``SOURCE_ORDER``; they name output columns, so the driver has to know them."""
    seen = {r[0] for r in candidates.select("AI_taxon").filter("AI_taxon is not null").distinct().toLocalIterator()} | set(defaults)
    rank = {s: i for i, s in enumerate(SOURCE_ORDER)}
    return sorted(seen, key=lambda d: (rank.get(d.lower(), len(rank)), d.lower()))


def orthogroup_inputs(candidates: DataFrame, row_order: str | None = None) -> DataFrame:
    """Gene, donor source and combined id of each distinct candidate, first row kept."""
    table = candidates.select(
        first_present(candidates, ["query_id", "gene_id", "transcript_id"], None, MISSING, True).alias("gene_id"),
        F.regexp_replace(F.trim(first_present(
            candidates, ["AI_taxon", "best_donor_group", "best_donor_taxon", "source"], "NA", MISSING, True
        )), " ", "_").alias("source"),
        first_present(candidates, ["species", "sample", "species_id"], "NA", MISSING, True).alias("species"),
        (candidates[row_order] if row_order else F.lit(0)).alias("_order"),
    ).filter("gene_id is not null")
    first = table.groupBy("gene_id", "source").agg(F.min_by("species", F.struct("_order", "species")).alias("species"))
    return first.withColumn("orthofinder_id", F.concat_ws("--", "gene_id", "source"))


def candidate_proteins(inputs: DataFrame, proteins: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Protein records of the candidates under their combined ids, and the genes without a protein.

    A gene reported with several sources keeps the last one by name.
    """
    wanted = inputs.groupBy("gene_id").agg(F.max("orthofinder_id").alias("orthofinder_id"))
    found = proteins.join(wanted, proteins["seqid"] == wanted["gene_id"]).select(
        F.col("orthofinder_id").alias("seqid"), "seq"
    ).dropDuplicates(["seqid"])
    absent = wanted.select("gene_id").join(proteins.select(F.col("seqid").alias("gene_id")), "gene_id", "left_anti")
    return found, absent
