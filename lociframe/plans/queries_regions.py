"""Interval, coverage and region queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import coverage, intervals, regions, sequences, summaries, synteny
from .catalogue import CHECKS, Source, query, rounded, text

PAIRS = """
    select r.region_set, r.region_id, r.seqid, r.start0 as region_start0, r.end0 as region_end, f.feature_id,
           f.ftype as feature_type, f.start0 as feature_start0, f.end0 as feature_end,
           least(r.end0, f.end0) - greatest(r.start0, f.start0) as overlap_bp
    from {regions} r join {features} f on r.seqid = f.seqid and r.start0 < f.end0 and f.start0 < r.end0
"""


def islands(source: str, keys: str) -> str:
    """SQL for united intervals of ``source`` (start0, end0) per ``keys``."""
    return f"""
    select {keys}, min(start0) as start0, max(end0) as end0 from (
        select *, sum(fresh) over (partition by {keys} order by start0, end0 rows unbounded preceding) as island from (
            select *, case when start0 <= max(end0) over (partition by {keys} order by start0, end0
                rows between unbounded preceding and 1 preceding) then 0 else 1 end as fresh
            from (select distinct {keys}, start0, end0 from ({source}) src) spans) flagged) numbered
    group by {keys}, island"""


ENRICHMENT = f"""
    with pairs as ({PAIRS}),
    cut as (select region_set, seqid, region_id, greatest(region_start0, feature_start0) as start0,
                   least(region_end, feature_end) as end0 from pairs),
    covered as (select region_set, sum(end0 - start0) as covered_bp
                from ({islands('select * from cut', 'region_set, seqid, region_id')}) i group by region_set),
    sizes as (select region_set, count(*) as region_count, sum(end0 - start0) as region_bp from {{regions}} r group by region_set),
    events as (select region_set, count(*) as overlap_events, count(distinct feature_id) as overlapping_features
               from pairs group by region_set),
    rates as (select s.region_set, s.region_count, cast(s.region_bp as bigint) as region_bp,
                     cast(coalesce(c.covered_bp, 0) as bigint) as covered_bp, coalesce(e.overlap_events, 0) as overlap_events,
                     coalesce(e.overlapping_features, 0) as overlapping_features
              from sizes s left join covered c using (region_set) left join events e using (region_set))
    select region_set, region_count, region_bp, (select count(*) from {{features}} f) as feature_count,
           overlapping_features, overlap_events, covered_bp, round(covered_bp / region_bp, 6) as coverage_fraction,
           round(overlapping_features / (region_bp / 1000000), 6) as feature_rate_per_mb,
           case when region_set = 'target' then round((covered_bp / region_bp) /
                (select b.covered_bp / b.region_bp from rates b where b.region_set = 'background'), 6) end
                as fold_enrichment_vs_background,
           'ok' as qc_note
    from rates
"""


@query(ENRICHMENT)
def region_enrichment(t: Source) -> DataFrame:
    # The region id is the order key, which is unique.
    found = regions.region_enrichment(t.regions, t.features, unique_ids=True)
    return rounded(found, "coverage_fraction", "feature_rate_per_mb", "fold_enrichment_vs_background")


@query("""
    with shared as (select region_set, seqid, start0, end0, region_id // 7 as region_id from {regions} r),
    cut as (select r.region_set, r.seqid, r.region_id, greatest(r.start0, f.start0) as start0, least(r.end0, f.end0) as end0
            from shared r join {features} f on r.seqid = f.seqid and r.start0 < f.end0 and f.start0 < r.end0)
    select region_set, cast(sum(end0 - start0) as bigint) as covered_bp from (
""" + islands("select * from cut", "region_set, seqid, region_id") + ") i group by region_set")
def region_coverage_shared_ids(t: Source) -> DataFrame:
    """Regions that share an id on one sequence count their covered bases once."""
    shared = t.regions.withColumn("region_id", F.floor(F.col("region_id") / 7))
    return regions.region_enrichment(shared, t.features).select("region_set", "covered_bp")


@query(PAIRS)
def region_enrichment_details(t: Source) -> DataFrame:
    return regions.region_enrichment_details(t.regions, t.features)


@query(islands("select seqid, start0, end0 from {features} f", "seqid"))
def interval_merge(t: Source) -> DataFrame:
    return intervals.merge_intervals(t.features)


@query(f"""
    with merged as ({islands("select seqid, ftype, start0, end0 from {features} f", "seqid, ftype")}),
    cells as (select seqid, ftype, start0, end0, unnest(range(start0 // 5000, (end0 - 1) // 5000 + 1)) as b from merged)
    select seqid, ftype, b * 5000 as start, b * 5000 + 4999 as "end",
           cast(sum(least(end0, b * 5000 + 5000) - greatest(start0, b * 5000)) as bigint) as covered_bp,
           round(sum(least(end0, b * 5000 + 5000) - greatest(start0, b * 5000)) / 5000, 6) as fraction
    from cells group by seqid, ftype, b
""")
def binned_coverage(t: Source) -> DataFrame:
    return rounded(coverage.binned_coverage(t.features, 5_000, ["seqid", "ftype"]), "fraction")


@query("""
    select seqid, ftype as class, start0 // 50000 * 50000 as start, start0 // 50000 * 50000 + 49999 as "end",
           round(sum(end0 - start0) / 50000, 6) as fraction
    from {features} f group by seqid, ftype, start0 // 50000
""")
def class_distribution(t: Source) -> DataFrame:
    return rounded(coverage.class_distribution(t.features.withColumnRenamed("ftype", "class"), 50_000), "fraction")


@query("""
    with cells as (select seqid, ftype, start0, end0, unnest(range(start0 // 50000, (end0 - 1) // 50000 + 1)) as b
                   from {features} f where end0 > start0)
    select seqid, ftype as class, b * 50000 as start, b * 50000 + 49999 as "end",
           round(sum(least(end0, b * 50000 + 50000) - greatest(start0, b * 50000)) / 50000, 6) as fraction
    from cells group by seqid, ftype, b
""")
def class_distribution_clipped(t: Source) -> DataFrame:
    return rounded(coverage.class_distribution(t.features.withColumnRenamed("ftype", "class"), 50_000, "clipped"), "fraction")


@query("""
    with tagged as (select seqid, start0, end0, ftype as category from {features} f
                    union all select seqid, start0, end0, 'all repeat' from {features} g),
    merged as (""" + islands("select * from tagged", "category, seqid") + """)
    select category, cast(sum(end0 - start0) as bigint) as coverage_bp, round(sum(end0 - start0) / 5000000 * 100, 6) as coverage_percent
    from merged group by category
""")
def class_coverage_percent(t: Source) -> DataFrame:
    return rounded(coverage.category_coverage(t.features, 5_000_000, F.array(F.lit("all repeat"), F.col("ftype"))), "coverage_percent")


DOMAINS = """
    with pairs as (select f.feature_id, f.seqid, f.start0, f.end0, f.ftype, r.region_set,
                          least(r.end0, f.end0) - greatest(r.start0, f.start0) as bp
                   from {regions} r join {features} f on r.seqid = f.seqid and r.start0 < f.end0 and f.start0 < r.end0),
    per_locus as (select feature_id, seqid, start0, end0, ftype, count(*) as copies from {features} f group by all),
    sums as (select feature_id, seqid, start0, end0, ftype, sum(case when region_set = 'target' then bp end) as t,
                    sum(case when region_set = 'background' then bp end) as b from pairs group by all),
    rated as (select p.*, coalesce(s.t, 0) as t, coalesce(s.b, 0) as b from per_locus p left join sums s
              using (feature_id, seqid, start0, end0, ftype)),
    status as (select *, case when t > 0 then 'target' when b > 0 then 'background' else 'outside_background' end as region_status,
                      case when t > 0 then t else b end as bp from rated)
"""


def _domains(t: Source) -> DataFrame:
    return t.features.select(
        F.col("feature_id").alias("domain_id"), "seqid", "start0", "end0", F.col("ftype").alias("class_level_1"),
        F.lit("NA").alias("class_level_2"), F.lit("NA").alias("class_level_3"), F.col("ftype").alias("domain_type"),
        F.col("ftype").alias("class_path"))


@query(DOMAINS + """
    select region_status, ftype as class_level_1, 'NA' as class_level_2, 'NA' as class_level_3, ftype as domain_type,
           cast(sum(copies) as bigint) as domain_count, count(distinct (seqid, start0, end0)) as unique_loci,
           cast(sum(bp) as bigint) as covered_bp
    from status group by region_status, ftype
""")
def domains_by_region(t: Source) -> DataFrame:
    found = regions.domains_by_region(_domains(t), t.regions.filter("region_set = 'target'"), t.regions.filter("region_set = 'background'"))
    return found


@query("""
    with depth as (select seqid, pos0, total from {sites} s),
    lengths as (select seqid, max(pos0) + 1 as length from {sites} s group by seqid),
    tiles as (select seqid, unnest(range(0, length, 25000)) as start0, length from lengths)
    select t.seqid, t.start0, least(t.start0 + 100000, t.length) as end0,
           cast(coalesce(sum(d.total), 0) as bigint) as total_depth,
           round(coalesce(sum(d.total), 0) / (least(t.start0 + 100000, t.length) - t.start0), 6) as mean_depth
    from tiles t left join depth d on d.seqid = t.seqid and d.pos0 >= t.start0 and d.pos0 < t.start0 + 100000
    group by t.seqid, t.start0, t.length
""")
def tile_windows_depth(t: Source) -> DataFrame:
    sites = t.sites
    lengths = sites.groupBy("seqid").agg((F.max("pos0") + 1).alias("length"))
    return rounded(coverage.tile_depth(lengths, sites.select("seqid", "pos0", F.col("total").alias("depth")), 100_000, 25_000), "mean_depth")


LAST_SITE = """
    with ranked as (select *, row_number() over (partition by seqid, pos0 order by line_no desc, total desc, methylated desc) as rn from {sites} s),
    last_site as (select * from ranked where rn = 1)
"""


@query(LAST_SITE + """
    select seqid, pos0 // 100000 * 100000 as start, pos0 // 100000 * 100000 + 99999 as "end", round(avg(methylated / total), 6) as value
    from last_site group by seqid, pos0 // 100000
""")
def windowed_methylation(t: Source) -> DataFrame:
    sites = t.sites.withColumnRenamed("pos0", "pos").withColumn("_row", F.struct("line_no", "total", "methylated"))
    return rounded(coverage.windowed_methylation(sites), "value")


@query(LAST_SITE + """
    select seqid, pos0 // 10000 * 10000 as start, pos0 // 10000 * 10000 + 9999 as "end", round(sum(total) / 10000, 6) as value
    from last_site group by seqid, pos0 // 10000
""")
def windowed_depth(t: Source) -> DataFrame:
    depth = t.sites.select("seqid", F.col("pos0").alias("pos"), F.col("total").alias("depth"), F.struct("line_no", "total", "methylated").alias("_row"))
    return rounded(coverage.windowed_depth(depth), "value")


BINS = """
    with r as (select *, greatest(0, start0 - 2000) as up_lo, start0 as up_hi, end0 as dn_lo, end0 + 2000 as dn_hi from {regions} r),
    sections as (
        select region_id, seqid, start0, end0, strand, 'upstream' as section, 2 as n,
               case strand when '-' then dn_lo else up_lo end as lo, case strand when '-' then dn_hi else up_hi end as hi from r
        union all select region_id, seqid, start0, end0, strand, 'body', 5, start0, end0 from r
        union all select region_id, seqid, start0, end0, strand, 'downstream', 2,
               case strand when '-' then up_lo else dn_lo end, case strand when '-' then up_hi else dn_hi end from r),
    numbered as (select *, unnest(range(1, n + 1)) as bin_index from sections),
    bins as (select region_id, seqid, start0 as region_start0, end0 as region_end, strand, section, bin_index,
                    lo + ((hi - lo) * (bin_index - 1)) // n as bin_start0, lo + ((hi - lo) * bin_index) // n as bin_end from numbered),
    kept as (select * from bins where bin_end > bin_start0)
"""
PROFILE = BINS + """,
    contexts as (select unnest(['CG', 'CHG', 'CHH']) as context),
    sums as (select k.region_id, k.section, k.bin_index, s.context, count(*) as covered_sites, sum(s.methylated) as methylated_counts,
                    sum(s.total) as total_counts
             from kept k join {sites} s on s.seqid = k.seqid and s.pos0 >= k.bin_start0 and s.pos0 < k.bin_end and s.total >= 1
             group by all),
    profile as (select k.*, c.context, coalesce(s.covered_sites, 0) as covered_sites,
                       cast(coalesce(s.methylated_counts, 0) as bigint) as methylated_counts,
                       cast(coalesce(s.total_counts, 0) as bigint) as total_counts
                from kept k cross join contexts c left join sums s
                     on s.region_id = k.region_id and s.section = k.section and s.bin_index = k.bin_index and s.context = c.context)
"""


@query(BINS + "select * from kept")
def scaled_bins(t: Source) -> DataFrame:
    return intervals.scaled_bins(t.regions, 2000, (2, 5, 2)).select(
        "region_id", "seqid", F.col("start0").alias("region_start0"), F.col("end0").alias("region_end"), "strand", "section",
        F.col("bin_index").cast("bigint").alias("bin_index"), "bin_start0", F.col("bin_end0").alias("bin_end"))


@query(PROFILE + """
    select *, case when total_counts > 0 then round(methylated_counts / total_counts, 6) end as methylation_level from profile
""")
def methylation_profile(t: Source) -> DataFrame:
    found = regions.methylation_profile(t.regions, t.sites, (2, 5, 2))
    return rounded(found, "methylation_level").withColumn("bin_index", F.col("bin_index").cast("bigint"))


@query(PROFILE + """
    select context, count(distinct region_id) as regions, cast(sum(covered_sites) as bigint) as covered_sites,
           cast(sum(methylated_counts) as bigint) as methylated_counts, cast(sum(total_counts) as bigint) as total_counts,
           'target' as region_set, round(sum(methylated_counts) / sum(total_counts), 6) as methylation_level, 'ok' as qc_note
    from profile group by context
""")
def methylation_summary(t: Source) -> DataFrame:
    return rounded(regions.methylation_totals(t.regions, t.sites, (2, 5, 2)), "methylation_level")


CHECKS["methylation_profile_summary"] = CHECKS["methylation_summary"]


@query()
def methylation_profile_summary(t: Source) -> DataFrame:
    """The same totals from the rows of a profile."""
    return rounded(regions.methylation_summary(regions.methylation_profile(t.regions, t.sites, (2, 5, 2))), "methylation_level")


SYNTENY = """
    with ends as (select cast(ref_gene as varchar) as gene_id from {links} l union all select cast(query_gene as varchar) from {links} k),
    per_gene as (select gene_id, count(*) as links from ends where gene_id is not null group by gene_id),
    genes as (select distinct seqid, start0, end0, split_part(feature_id, '.', 1) as gene_id from {features} f),
    pairs as (select r.region_set, r.region_id, r.seqid, r.start0, r.end0, g.gene_id, p.links as synteny_links
              from {regions} r join genes g on r.seqid = g.seqid and r.start0 < g.end0 and g.start0 < r.end0
              join per_gene p on p.gene_id = g.gene_id)
"""


def _genes(t: Source) -> DataFrame:
    return t.features.select("seqid", "start0", "end0", F.split_part("feature_id", F.lit("."), F.lit(1)).alias("gene_id")).distinct()


@query(SYNTENY + """
    select r.region_set, r.regions, r.region_bp, coalesce(p.synteny_links, 0) as synteny_links,
           coalesce(p.covered, 0) as covered_target_regions, coalesce(p.genes, 0) as syntenic_genes,
           round(coalesce(p.genes, 0) / (r.region_bp / 1000000), 6) as syntenic_gene_rate_per_mb
    from (select region_set, count(*) as regions, cast(sum(end0 - start0) as bigint) as region_bp from {regions} r group by region_set) r
    left join (select region_set, cast(sum(synteny_links) as bigint) as synteny_links, count(distinct region_id) as covered,
                      count(distinct gene_id) as genes from pairs group by region_set) p using (region_set)
""")
def region_synteny(t: Source) -> DataFrame:
    found = regions.region_synteny(t.regions, _genes(t), synteny.links_per_gene(t.links))
    return rounded(found, "syntenic_gene_rate_per_mb")


@query(SYNTENY + "select * from pairs")
def region_synteny_details(t: Source) -> DataFrame:
    return regions.region_synteny_details(t.regions, _genes(t), synteny.links_per_gene(t.links))


@query("""
    with cells as (select seqid, start0 as s, end0 as e from {features} f),
    merged as (""" + islands("select seqid, ftype, start0, end0 from {features} f where end0 > start0", "seqid, ftype") + """),
    covered as (select seqid, ftype as lineage, cast(sum(end0 - start0) as bigint) as covered_bp from merged group by seqid, ftype),
    lengths as (select seqid, max(e) as length from cells group by seqid)
    select seqid, lineage, covered_bp, length, round(covered_bp / length, 6) as hit_fraction
    from covered join lengths using (seqid) where covered_bp / length >= 0.5
""")
def contaminated_contigs(t: Source) -> DataFrame:
    lengths = t.features.groupBy("seqid").agg(F.max("end0").alias("length"))
    hits = t.features.withColumnRenamed("ftype", "lineage")
    return rounded(coverage.contaminated_contigs(hits, lengths), "hit_fraction")


@query("""
    with r as (select l_returnflag as repeat_class, l_linestatus as repeat_family, l_discount * 100 as divergence, cast(l_quantity as bigint) as length
               from lineitem)
    select repeat_class, repeat_family, count(*) as copies, cast(sum(length) as bigint) as covered_bp,
           round(avg(divergence), 6) as mean_divergence, round(median(divergence), 6) as median_divergence,
           round(avg(divergence / 100.0 / (2 * 1e-8) / 1e6), 6) as mean_insertion_time_mya
    from r group by repeat_class, repeat_family
""")
def te_divergence(t: Source) -> DataFrame:
    repeats = t.lineitem.select(
        F.col("l_returnflag").alias("repeat_class"), F.col("l_linestatus").alias("repeat_family"), (F.col("l_discount") * 100).alias("divergence"),
        F.col("l_quantity").cast("bigint").alias("length"))
    found = sequences.te_divergence_summary(sequences.te_divergence(repeats, 1e-8))
    return rounded(found, "mean_divergence", "median_divergence", "mean_insertion_time_mya")


@query("""
    with s as (select lang, length(text) as n from documents),
    c as (select lang, n // 50 * 50 as bin_start, count(*) as raw_count from s group by lang, n // 50)
    select lang, bin_start, raw_count, cast(sum(raw_count) over (partition by lang) as bigint) as total_count,
           round(raw_count / sum(raw_count) over (partition by lang) * 100, 5) as percent, 50 as bin_size
    from c
""")
def length_histogram(t: Source) -> DataFrame:
    lengths = t.documents.select("lang", F.length("text").alias("length"))
    return rounded(summaries.length_histogram(lengths, ["lang"], "length", 50), "percent", digits=5)
