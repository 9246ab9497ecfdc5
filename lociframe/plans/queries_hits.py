"""Similarity-hit and candidate queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotations, hits, matrices
from .catalogue import Source, keyed, query, rounded, text

TIES = ("subject_id", "pident", "query_coverage")
CLASSES = dict(ingroup=["ingroup_a"], donor=["donor_a", "donor_b"], exclude=["excluded_a"])
MAX_EVALUE = 3e-5

CLASSIFIED = """
    with classified as (
        select h.*, x.scientific_name, x.lineage, x.taxon_group,
               case when x.taxon_group in ('excluded_a') then 'exclude' when x.taxon_group in ('ingroup_a') then 'ingroup'
                    when x.taxon_group in ('donor_a', 'donor_b') then 'donor' else 'unknown' end as hit_class
        from {hits} h left join {taxonomy} x using (subject_id) where h.evalue <= 3e-5)
"""
SCORED = CLASSIFIED + """,
    ranked as (select *, row_number() over (partition by query_id, hit_class
                   order by bitscore desc, evalue, subject_id, pident, query_coverage) as rn from classified),
    d as (select * from ranked where hit_class = 'donor' and rn = 1),
    i as (select * from ranked where hit_class = 'ingroup' and rn = 1),
    q as (select distinct query_id from classified),
    scored0 as (
        select q.query_id, d.subject_id as best_donor_hit, d.scientific_name as best_donor_taxon, d.taxon_group as best_donor_group,
               d.bitscore as best_donor_bitscore, i.subject_id as best_ingroup_hit, i.scientific_name as best_ingroup_taxon,
               i.bitscore as best_ingroup_bitscore, d.evalue as de, i.evalue as ie, d.query_id is not null as has_d, i.query_id is not null as has_i,
               case when d.query_id is null then 0 else -log10(greatest(d.evalue, 1e-300)) end
               - case when i.query_id is null then 0 else -log10(greatest(i.evalue, 1e-300)) end as alien_index,
               coalesce(d.bitscore, 0) - coalesce(i.bitscore, 0) as bitscore_delta
        from q left join d using (query_id) left join i using (query_id)),
    reasons as (select *, concat_ws(';', case when not has_d then 'no_donor_hit' end,
               case when has_d and best_donor_bitscore < 50 then 'low_donor_bitscore' end,
               case when has_d and de > 1e-10 then 'weak_donor_evalue' end,
               case when not has_i then 'no_ingroup_comparison' end,
               case when has_d and has_i and round(alien_index, 6) < 10 then 'low_alien_index' end) as why from scored0),
    scored as (select *, case when why = '' then 'candidate' else 'rejected' end as candidate_status,
                      case when why = '' then 'pass' else why end as filter_reason from reasons)
"""


def classified(t: Source) -> DataFrame:
    return hits.classify_hits(t.hits, t.taxonomy, **CLASSES, max_evalue=MAX_EVALUE)


def scored(t: Source) -> DataFrame:
    return hits.score_candidates(classified(t), 9.9999995, 50.0, 0.0, 1e-10, TIES)


@query("""
    select query_id, subject_id, hit_rank, round(-log10(evalue), 6) as evalue_digits, bitscore from (
        select *, row_number() over (partition by query_id order by evalue, bitscore desc, subject_id, pident, query_coverage) as hit_rank
        from {hits} h where evalue <= 3e-5 and bitscore >= 50) where hit_rank <= 3
""")
def select_hits_topk(t: Source) -> DataFrame:
    best = hits.select_hits(t.hits, 3, MAX_EVALUE, 50.0, TIES)
    return best.select("query_id", "subject_id", F.col("hit_rank").cast("bigint").alias("hit_rank"), F.round(-F.log10("evalue"), 6).alias("evalue_digits"), "bitscore")


@query("select query_id, subject_id, round(-log10(evalue), 6) as evalue_digits, bitscore from {hits} h where evalue <= 3e-5")
def raw_hit_table(t: Source) -> DataFrame:
    return hits.raw_hit_table(t.hits, MAX_EVALUE).select("query_id", "subject_id", F.round(-F.log10("evalue"), 6).alias("evalue_digits"), "bitscore")


@query(CLASSIFIED + """
    select query_id, subject_id, round(pident, 6) as pident, query_coverage, round(-log10(evalue), 6) as evalue_digits, bitscore,
           scientific_name, lineage, taxon_group, hit_class from classified
""")
def classify_hits(t: Source) -> DataFrame:
    return rounded(classified(t), "pident").withColumn("evalue_digits", F.round(-F.log10("evalue"), 6)).drop("evalue")


@query(CLASSIFIED + """
    select k.metric, coalesce(c.n, 0) as value from (select unnest(['ingroup', 'donor', 'exclude', 'unknown']) as metric) k
    left join (select hit_class as metric, count(*) as n from classified group by hit_class) c using (metric)
    union all select 'filtered', count(*) from {hits} h where not (evalue <= 3e-5)
""")
def classification_summary(t: Source) -> DataFrame:
    return hits.classification_summary(t.hits, classified(t), MAX_EVALUE)


@query(SCORED + """
    select query_id, best_donor_hit, best_donor_taxon, best_donor_group, best_donor_bitscore, best_ingroup_hit, best_ingroup_taxon,
           best_ingroup_bitscore, round(alien_index, 6) as alien_index, round(bitscore_delta, 6) as bitscore_delta, candidate_status, filter_reason
    from scored
""")
def score_candidates(t: Source) -> DataFrame:
    return rounded(scored(t).drop("best_donor_evalue", "best_ingroup_evalue"), "alien_index", "bitscore_delta")


@query(SCORED + """
    select candidate_status, filter_reason, count(*) as queries from (
        select candidate_status, unnest(string_split(filter_reason, ';')) as filter_reason from scored) group by all
""")
def candidate_rejects_summary(t: Source) -> DataFrame:
    return hits.reject_reasons(scored(t))


@query(SCORED + "select candidate_status as metric, count(*) as value from scored group by candidate_status")
def candidate_status_counts(t: Source) -> DataFrame:
    return hits.status_counts(scored(t), "candidate_status")


@query(SCORED + """
    , top as (select query_id, string_agg(cast(subject_id as varchar), ',' order by rn) as ids from ranked where hit_class = 'donor' and rn <= 5 group by query_id)
    select s.query_id, top.ids as top_donor_subject_ids, 'homolog tree of the candidate' as recommended_validation,
           case when candidate_status = 'candidate' then 'high' else 'review' end as validation_priority,
           'intron_details;synteny' as missing_data_note
    from scored s left join top using (query_id)
""")
def validation_set(t: Source) -> DataFrame:
    priority = F.when(F.col("candidate_status") == "candidate", "high").otherwise("review")
    context = scored(t).select("query_id", priority.alias("validation_priority"), F.lit("intron_details;synteny").alias("missing_data_note"))
    return hits.validation_set(context, classified(t), 5, TIES)


GROUPS = ("ingroup_a", "donor_a", "donor_b")


@query(CLASSIFIED + "select query_id, " + ", ".join(
    f"round(-log10(min(case when taxon_group = '{g}' then evalue end)), 6) as {g}_digits, max(case when taxon_group = '{g}' then bitscore end) as {g}_bitscore"
    for g in GROUPS) + " from classified group by query_id")
def donor_group_table(t: Source) -> DataFrame:
    wide = hits.donor_group_table(classified(t), GROUPS)
    return wide.select("query_id", *[F.round(-F.log10(f"{g}_evalue"), 6).alias(f"{g}_digits") for g in GROUPS], *[f"{g}_bitscore" for g in GROUPS])


REFINED = SCORED + """,
    tax as (select o_orderkey as query_id, o_orderpriority as refined, o_orderstatus as lineage from orders where o_orderstatus <> 'P'),
    refined as (
        select s.query_id, coalesce(best_donor_group, 'unknown') as best_donor_group, coalesce(best_donor_taxon, 'unknown') as best_donor_taxon,
               case when tax.query_id is not null then coalesce(tax.refined, 'NA') else coalesce(best_donor_taxon, best_donor_group, 'unknown') end as refined_donor_taxon,
               'genus' as refined_donor_rank, tax.lineage,
               case when tax.query_id is not null then 'refined' else 'group_only' end as taxonomy_status,
               case when tax.query_id is not null then 'taxonomy_table' else 'hit_table' end as donor_taxon_source
        from scored s left join tax using (query_id))
"""


def refined(t: Source) -> DataFrame:
    tax = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).otherwise(-F.col("o_orderkey") - 1).alias("query_id"), F.col("o_orderpriority").alias("refined_donor_taxon"), F.col("o_orderstatus").alias("lineage"))
    return hits.refine_donors(scored(t), tax)


@query(REFINED + "select * from refined")
def refine_donors(t: Source) -> DataFrame:
    return refined(t).drop("alien_index", "best_donor_bitscore")


@query(REFINED + """
    select refined_donor_rank as rank, refined_donor_taxon as donor_taxon, best_donor_group as donor_group, count(*) as candidate_count
    from refined group by all
""")
def refine_donors_summary(t: Source) -> DataFrame:
    return hits.refined_summary(refined(t))


LINEAGE = CLASSIFIED + """,
    lin as (select query_id, case when query_id % 2 = 0 then 'F' else 'O' end as species,
                   max(case when hit_class = 'donor' then bitscore end) as db, min(case when hit_class = 'donor' then evalue end) as de,
                   min(case when hit_class = 'ingroup' then evalue end) as ie, max(case when hit_class = 'ingroup' then bitscore end) as ib,
                   count(distinct case when hit_class = 'donor' then subject_id end) as nd from classified group by query_id),
    best_e as (select query_id, taxon_group from (select query_id, taxon_group, row_number() over (partition by query_id order by evalue, taxon_group) as rn
               from classified where hit_class = 'donor') where rn = 1),
    best_b as (select query_id, taxon_group from (select query_id, taxon_group, row_number() over (partition by query_id order by bitscore desc, taxon_group) as rn
               from classified where hit_class = 'donor') where rn = 1),
    lineage as (select l.*, e.taxon_group as ai_taxon, coalesce(b.taxon_group, 'unknown') as h_taxon,
                round(coalesce(-log10(de), 0) - coalesce(-log10(ie), 0), 6) as alien_index,
                round(coalesce(db, 0) - coalesce(ib, 0), 6) as delta
                from lin l left join best_e e using (query_id) left join best_b b using (query_id))
"""


def lineage(t: Source) -> DataFrame:
    """Per-query table of hits by taxon group, from the classified hits; excluded groups are no donors."""
    species = F.when(F.col("query_id") % 2 == 0, "F").otherwise("O")
    return hits.lineage_from_scores(hits.group_scores(classified(t)), "ingroup_a", ["excluded_a"], species)


@query(CLASSIFIED + """,
    g as (select query_id, taxon_group, min(evalue) as e, max(bitscore) as b, count(distinct subject_id) as n from classified where taxon_group is not null group by all),
    d as (select *, row_number() over (partition by query_id order by e, taxon_group) as by_e, row_number() over (partition by query_id order by b desc, taxon_group) as by_b
          from g where taxon_group not in ('ingroup_a', 'excluded_a')),
    w as (select query_id, max(case when by_e = 1 then taxon_group end) as ai_taxon, min(e) as de, max(case when by_b = 1 then taxon_group end) as h, max(b) as db,
                 max(case when by_b = 2 then taxon_group end) as h2, max(case when by_b = 2 then b end) as db2, sum(n) as n, count(*) as groups from d group by query_id),
    s as (select query_id, e as ie, b as ib from g where taxon_group = 'ingroup_a')
    select q.query_id, case when q.query_id % 2 = 0 then 'F' else 'O' end as species, round(coalesce(-log10(de), 0) - coalesce(-log10(ie), 0), 6) as alien_index, ai_taxon as alien_index_taxon,
           coalesce(h, 'unknown') as h_taxon, db as donor_bitscore, ib as self_bitscore, round(coalesce(db, 0) - coalesce(ib, 0), 6) as bitscore_delta,
           round((coalesce(db, 0) - coalesce(ib, 0)) / ib * 100, 6) as bitscore_delta_percent, round(db / ib, 6) as bit_ratio, cast(coalesce(n, 0) as bigint) as donor_taxon_count,
           coalesce(groups, 0) as donor_groups, h2 as runner_up_taxon, round(db - db2, 6) as runner_up_delta
    from (select distinct query_id from g) q left join w using (query_id) left join s using (query_id)
""")
def lineage_table(t: Source) -> DataFrame:
    numbers = ("alien_index", "donor_bitscore", "self_bitscore", "bitscore_delta", "bitscore_delta_percent", "bit_ratio", "runner_up_delta")
    return lineage(t).select(
        "query_id", "species", "alien_index_taxon", "h_taxon", *[F.col(c).cast("double").alias(c) for c in numbers], F.col("donor_taxon_count").cast("bigint").alias("donor_taxon_count"),
        F.size("donor_bitscores").cast("bigint").alias("donor_groups"), "runner_up_taxon")


@query(LINEAGE + """, grouped as (select *, case when h_taxon <> 'unknown' then h_taxon else coalesce(ai_taxon, 'NA') end as grp from lineage),
    judged as (select *, concat_ws(';', case when grp not in ('donor_a') then 'donor_group_not_selected' end,
               case when alien_index < 5 then 'low_alien_index' end, case when delta < 0 then 'low_bitscore_delta' end,
               case when coalesce(db, 0) < 50 then 'low_donor_bitscore' end, case when nd < 2 then 'low_donor_taxon_count' end) as why from grouped)
    select query_id, null::varchar as best_donor_hit, grp as best_donor_taxon, grp as best_donor_group, round(-log10(ge.e), 6) as best_donor_digits, db as best_donor_bitscore,
           null::varchar as best_ingroup_hit, 'ingroup_a' as best_ingroup_taxon, round(-log10(ie), 6) as best_ingroup_digits, ib as best_ingroup_bitscore,
           alien_index, delta as bitscore_delta, case when why = '' then 'candidate' else 'rejected' end as candidate_status,
           case when why = '' then 'pass' else why end as filter_reason
    from judged left join (select query_id, taxon_group as grp, min(evalue) as e from classified group by all) ge using (query_id, grp)
""")
def filter_lineage_table(t: Source) -> DataFrame:
    """E-values are compared by their digits: power and parsing differ in the last bit between engines."""
    found = hits.filter_lineage_table(lineage(t), "ingroup_a", ["Donor_A"], 5.0, 0.0, 50.0, 2)
    digits = lambda c: F.round(-F.log10(F.col(c).cast("double")), 6)
    numbers = ("best_donor_bitscore", "best_ingroup_bitscore", "alien_index", "bitscore_delta")
    found = found.withColumns({"best_donor_digits": digits("best_donor_evalue"), "best_ingroup_digits": digits("best_ingroup_evalue")})
    return found.withColumns({c: F.col(c).cast("double") for c in numbers}).drop("best_donor_evalue", "best_ingroup_evalue")


CONDITIONS = LINEAGE + """,
    c1 as (select species, query_id, alien_index, ai_taxon, h_taxon, 'Condition1' as condition from lineage
           where ai_taxon in ('donor_a', 'donor_b') and alien_index > 0),
    both_c as (select * from c1 union all select species, query_id, alien_index, ai_taxon, h_taxon, 'Condition2' from c1 where ai_taxon = h_taxon),
    species as (select distinct o_orderstatus as species from orders),
    wanted as (select species, c.condition from species cross join (select unnest(['Condition1', 'Condition2']) as condition) c),
    matrix as (select w.condition, w.species, count(case when ai_taxon = 'donor_a' then 1 end) as donor_a,
                      count(case when ai_taxon = 'donor_b' then 1 end) as donor_b, count(b.query_id) as total
               from wanted w left join both_c b on b.species = w.species and b.condition = w.condition group by w.condition, w.species)
"""


def conditions(t: Source) -> DataFrame:
    return hits.condition_candidates(lineage(t), ["Donor_A", "donor_b"], ["unknown"])


def condition_matrix(t: Source) -> DataFrame:
    # P has orders but no hits here: a species whose input is still pending.
    species = t.orders.select(F.col("o_orderstatus").alias("species"))
    return hits.condition_matrices(conditions(t), species, ["donor_a", "donor_b"])


@query(CONDITIONS + "select species, query_id, alien_index, ai_taxon as \"AI_taxon\", h_taxon, condition from both_c")
def condition_candidates(t: Source) -> DataFrame:
    return conditions(t)


@query(CONDITIONS + """
    select *, case when total > 0 then round(donor_a / total, 6) else 0.0::double end as donor_a_prop,
           case when total > 0 then round(donor_b / total, 6) else 0.0::double end as donor_b_prop from matrix
""")
def condition_matrices(t: Source) -> DataFrame:
    return rounded(condition_matrix(t), "donor_a_prop", "donor_b_prop")


@query(CONDITIONS + """
    select condition, species, donor_group, hgt_count, total as total_hgt, round(hgt_count / total, 6) as fraction from (
        select condition, species, total, 'donor_a' as donor_group, donor_a as hgt_count from matrix
        union all select condition, species, total, 'donor_b', donor_b from matrix) where hgt_count <> 0
""")
def donor_fractions(t: Source) -> DataFrame:
    wide = condition_matrix(t).withColumn("key", F.struct("condition", "species"))
    found = matrices.donor_fractions(wide, ["donor_a", "donor_b"], "key")
    return rounded(found.select("key.condition", "key.species", "donor_group", "hgt_count", "total_hgt", "fraction"), "fraction")


@query(SCORED + """
    select cast(query_id as varchar) as gene_id, coalesce(best_donor_group, best_donor_taxon, 'NA') as source, 'NA' as species,
           cast(query_id as varchar) || '--' || coalesce(best_donor_group, best_donor_taxon, 'NA') as orthofinder_id
    from scored
""")
def orthogroup_inputs(t: Source) -> DataFrame:
    return hits.orthogroup_inputs(scored(t))


CONTEXT = SCORED + """,
    ann as (select cast(o_orderkey as varchar) as query_id, 'T' || cast(o_custkey as varchar) as transcript_id, o_orderpriority as description
            from orders where o_orderstatus = 'F'),
    coords as (select cast(o_orderkey as varchar) as id, 'chr' || cast(o_custkey % 5 as varchar) as seqid, o_orderkey as start from orders where o_orderstatus <> 'P'
               union all select 'T' || cast(c_custkey as varchar), 'cust', c_custkey from customer where c_acctbal > 0),
    introns as (select 'T' || cast(l_partkey as varchar) as transcript_id, l_quantity < 10 as is_short, l_discount as at_share, l_tax > 0.04 as rich from lineitem),
    im as (select transcript_id as id, count(*) as n, count(case when is_short then 1 end) as ns, round(avg(at_share), 6) as mean_at,
                  round(avg(case when rich then 1 else 0 end), 6) as ratio
           from introns group by transcript_id),
    keyed as (select s.*, cast(query_id as varchar) as gene_id, coalesce(a.transcript_id, cast(s.query_id as varchar)) as transcript_id, a.description
              from scored s left join (select query_id as q, transcript_id, description from ann) a on a.q = cast(s.query_id as varchar))
    select k.gene_id as query_id, k.gene_id, k.transcript_id, coalesce(c1.seqid, c2.seqid) as seqid, coalesce(c1.start, c2.start) as start, k.description,
           coalesce(m1.n, m2.n) as intron_count, coalesce(m1.ns, m2.ns) as short_intron_count, coalesce(m1.mean_at, m2.mean_at) as mean_intron_at,
           coalesce(m1.ratio, m2.ratio) as at_rich_intron_ratio, 'not_tested' as synteny_support_status, 'synteny' as missing_data_note,
           case when candidate_status = 'candidate' then 'high' else 'review' end as validation_priority
    from keyed k left join coords c1 on c1.id = k.gene_id left join coords c2 on c2.id = k.transcript_id
    left join im m1 on m1.id = k.gene_id left join im m2 on m2.id = k.transcript_id
"""


@query(CONTEXT)
def candidate_context(t: Source) -> DataFrame:
    named = lambda c: F.concat(F.lit("T"), text(c))
    notes = t.orders.select(
        keyed(F.col("o_orderstatus") == "F", text("o_orderkey")).alias("gene_id"), named("o_custkey").alias("transcript_id"), F.col("o_orderpriority").alias("description"))
    coords = t.orders.select(
        keyed(F.col("o_orderstatus") != "P", text("o_orderkey")).alias("id"), F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("seqid"), F.col("o_orderkey").alias("start"),
    ).unionByName(t.customer.select(keyed(F.col("c_acctbal") > 0, named("c_custkey")).alias("id"), F.lit("cust").alias("seqid"), F.col("c_custkey").alias("start")))
    coords = coords.select("*", F.col("start").alias("end"), F.lit("+").alias("strand"), F.lit(1).alias("priority"))
    introns = t.lineitem.select(
        F.lit(None).cast("string").alias("gene_id"), named("l_partkey").alias("transcript_id"), (F.col("l_quantity") < 10).alias("is_short_intron"),
        F.col("l_discount").alias("at_content"), (F.col("l_tax") > 0.04).alias("is_at_rich"))
    found = annotations.candidate_context(scored(t), coords, notes, introns, None)
    return rounded(found, "mean_intron_at", "at_rich_intron_ratio").select(
        "query_id", "gene_id", "transcript_id", "seqid", "start", "description", "intron_count", "short_intron_count", "mean_intron_at",
        "at_rich_intron_ratio", "synteny_support_status", "missing_data_note", "validation_priority")
