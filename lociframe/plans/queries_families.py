"""Gene-family, event, synteny, matrix and expression queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import families, matrices, synteny
from .catalogue import Source, keyed, query, rounded, text


def _species(t: Source) -> list[str]:
    return families.column_values(t.family_counts, "species")


@query("""
    with c as ({family_counts}), s as (select distinct species from c), n as (select count(*) as n from s),
    grid as (select f.family_id, s.species, coalesce(c.copies, 0) as copies from (select distinct family_id from c) f cross join s
             left join c on c.family_id = f.family_id and c.species = s.species)
    select family_id, cast(sum(copies) as bigint) as total_copies, count(case when copies > 0 then 1 end) as species_present,
           cast(count(*) as int) as species_total, round(count(case when copies > 0 then 1 end) / count(*), 6) as occupancy,
           bool_and(copies = 1) as single_copy_all_species, bool_and(copies > 0) as core_family,
           count(case when copies > 0 then 1 end) = 1 as lineage_specific,
           coalesce(string_agg(species, ';' order by species) filter (where copies > 0), 'NA') as present_species,
           string_agg(species || ':' || copies, ';' order by species) as copy_counts
    from grid group by family_id
""")
def family_summary(t: Source) -> DataFrame:
    return rounded(families.family_summary(t.family_counts, _species(t)), "occupancy")


@query("""
    select family_id, nullif(concat_ws(';', case when max(copies) > 17 then 'max_copy' end, case when count(*) < 25 then 'min_species' end), '') as reason
    from {family_counts} c group by family_id
""")
def filter_families(t: Source) -> DataFrame:
    return families.filter_families(t.family_counts, max_copy=17, min_species=25, remove_all_zero=True)


@query("""
    select family_id, coalesce(max(case when species = 'ALGERIA' then copies end), 0) as "ALGERIA", coalesce(max(case when species = 'BRAZIL' then copies end), 0) as "BRAZIL",
           coalesce(max(case when species = 'CHINA' then copies end), 0) as "CHINA", coalesce(max(case when species = 'nowhere' then copies end), 0) as "nowhere"
    from {family_counts} c group by family_id
""")
def count_matrix(t: Source) -> DataFrame:
    return families.count_matrix(t.family_counts, ["ALGERIA", "BRAZIL", "CHINA", "nowhere"])


MEMBERS = """
    with members as (select distinct p_brand || '/' || p_type as family_id, l_orderkey as gene_id from lineitem join part on l_partkey = p_partkey),
    transferred as (select o_orderkey as gene_id, case o_orderpriority when '1-URGENT' then 'bacteria' when '2-HIGH' then 'Fungi' when '3-MEDIUM' then 'virus'
                    when '5-LOW' then 'NA' else o_orderpriority end as source from orders where o_orderstatus = 'F'),
    votes as (select family_id, source, count(*) as n from members join transferred using (gene_id) where source <> 'NA' group by all),
    majority as (select family_id, source from (select *, row_number() over (partition by family_id order by n desc,
                 case lower(source) when 'virus' then 0 when 'bacteria' then 1 when 'fungi' then 2 else 6 end, lower(source)) as rn from votes) where rn = 1),
    flagged as (select family_id, count(*) as total_genes, count(t.gene_id) as hgt_genes from members left join transferred t using (gene_id) group by family_id),
    m1 as (select f.*, round(hgt_genes / total_genes, 6) as hgt_ratio, coalesce(m.source, 'NA') as majority_source, hgt_genes / total_genes > 0.33 as is_hgt_family
           from flagged f left join majority m using (family_id))
"""


def _members(t: Source) -> DataFrame:
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws("/", "p_brand", "p_type").alias("family_id"), F.col("l_orderkey").alias("gene_id")).distinct()


def _transferred(t: Source) -> DataFrame:
    p = F.col("o_orderpriority")
    source = F.when(p == "1-URGENT", "bacteria").when(p == "2-HIGH", "Fungi").when(p == "3-MEDIUM", "virus").when(p == "5-LOW", "NA").otherwise(p)
    return t.orders.filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("gene_id"), source.alias("source"))


@query(MEMBERS + "select * from m1")
def family_events_m1(t: Source) -> DataFrame:
    return rounded(families.flag_families(_members(t), _transferred(t), 0.33), "hgt_ratio")


MAPPING = MEMBERS + """,
    home as (select gene_id, max(family_id) as family_id from members group by gene_id),
    sizes as (select family_id, count(*) as all_family_size from members group by family_id),
    groups as (select 'G' || (o_custkey % 97) as group_id, t.gene_id, t.source from transferred t join orders on o_orderkey = gene_id),
    shared as (select group_id, family_id, count(*) as n from groups join home using (gene_id) group by all),
    best as (select * from (select group_id, family_id, n, all_family_size, row_number() over (partition by group_id
             order by n desc, n / all_family_size desc, family_id) as rn from shared join sizes using (family_id)) where rn = 1),
    gvotes as (select group_id, source, count(*) as n from groups where source <> 'NA' group by all),
    gmajority as (select group_id, source from (select *, row_number() over (partition by group_id order by n desc,
                 case lower(source) when 'virus' then 0 when 'bacteria' then 1 when 'fungi' then 2 else 6 end, lower(source)) as rn from gvotes) where rn = 1),
    m2 as (select g.group_id, b.family_id, coalesce(b.n, 0) as overlap_gene_count, g.hgt_gene_count, coalesce(b.all_family_size, 0) as all_family_size,
                  round(coalesce(b.n / b.all_family_size, 0), 6) as overlap_rate, coalesce(m.source, 'NA') as majority_source
           from (select group_id, count(*) as hgt_gene_count from groups group by group_id) g left join best b using (group_id) left join gmajority m using (group_id))
"""


@query(MAPPING + "select * from m2")
def family_events_m2(t: Source) -> DataFrame:
    groups = _transferred(t).join(t.orders.select(F.col("o_orderkey").alias("gene_id"), "o_custkey"), "gene_id").select(
        F.concat(F.lit("G"), (F.col("o_custkey") % 97).cast("string")).alias("group_id"), "gene_id", "source")
    return rounded(families.map_families(groups, _members(t)), "overlap_rate")


EVENTS = """
    with c as ({node_counts}), nodes as ({node_parent}), fams as (select distinct family_id from c),
    pairs as (select f.family_id, n.node, n.parent, coalesce(a.copies, 0) as node_count, coalesce(b.copies, 0) as parent_count
              from fams f cross join nodes n left join c a on a.family_id = f.family_id and a.species = n.node
              left join c b on b.family_id = f.family_id and b.species = n.parent),
    events as (select *, unnest(list_filter([case when node_count > 0 and parent_count = 0 then 'gain' end, case when node_count = 0 and parent_count > 0 then 'loss' end,
               case when node_count > 1 and parent_count = 1 then 'expansion' end, case when node_count = 1 and parent_count > 1 then 'contraction' end,
               case when node_count > 0 then 'total' end], lambda x: x is not null)) as event from pairs),
    sourced as (select e.*, case when right(family_id, 1) in ('Y', 'O', 'E') then 'bacteria' else 'virus' end as majority_source from events e)
"""


def _events(t: Source) -> DataFrame:
    counts = t.node_counts
    source = F.when(F.right("family_id", F.lit(1)).isin("Y", "O", "E"), "bacteria").otherwise("virus")
    sources = counts.select("family_id").distinct().withColumn("majority_source", source)
    return families.node_events(counts, t.node_parent, sources)


@query(EVENTS + "select * from sourced")
def node_events(t: Source) -> DataFrame:
    return _events(t)


@query(EVENTS + """
    select node, parent, count(case event when 'gain' then 1 end) as gain, count(case event when 'loss' then 1 end) as loss,
           count(case event when 'expansion' then 1 end) as expansion, count(case event when 'contraction' then 1 end) as contraction,
           count(case event when 'total' then 1 end) as total, count(case when event in ('gain', 'expansion') then 1 end) as hgt_gain_expansion
    from sourced group by node, parent
""")
def event_summary(t: Source) -> DataFrame:
    return families.event_summary(_events(t))


@query(EVENTS + "select node, event, majority_source, count(*) as orthogroup_count from sourced group by all")
def event_source_breakdown(t: Source) -> DataFrame:
    return families.source_breakdown(_events(t))


@query(EVENTS + """
    select node, event, majority_source as donor_group, count(*) as orthogroup_count from sourced where event in ('gain', 'expansion') group by all
""")
def event_handoff(t: Source) -> DataFrame:
    return matrices.source_handoff(families.source_breakdown(_events(t)))


GAIN_LOSS = EVENTS + """,
    gl as (select family_id, node as node_id, node as node_label, count(case event when 'gain' then 1 end)::double as gain,
                  count(case event when 'loss' then 1 end)::double as loss, count(case event when 'expansion' then 1 end)::double as expansion,
                  count(case event when 'contraction' then 1 end)::double as contraction, cast(max(node_count) as varchar) as inferred_count
           from sourced group by family_id, node),
    shape as (select family_id, sum(copies)::bigint as total_copies from c group by family_id)
"""


def _gain_loss(t: Source) -> DataFrame:
    """The event rows as a gain/loss table under other column names."""
    one = lambda e: F.count_if(F.col("event") == e).cast("string")
    table = _events(t).groupBy(F.col("family_id").alias("Family ID"), F.col("node").alias("branch")).agg(
        one("gain").alias("gains"), one("loss").alias("losses"), one("expansion").alias("expansion"), one("contraction").alias("contractions"),
        F.max("node_count").cast("string").alias("family_size"))
    return families.normalize_gain_loss(table)


@query(GAIN_LOSS + """
    select family_id, node_id as node_label, gain, loss, expansion, contraction, inferred_count,
           coalesce(nullif(concat_ws(';', case when gain > 0 then 'gain' end, case when loss > 0 then 'loss' end, case when expansion > 0 then 'expansion' end,
                                     case when contraction > 0 then 'contraction' end), ''), 'no_change') as event_status
    from gl
""")
def gain_loss_summary(t: Source) -> DataFrame:
    return families.gain_loss_summary(_gain_loss(t)).drop("total_copies", "species_present", "present_species")


@query(GAIN_LOSS + """
    select node_id as node_label, count(distinct family_id) as family_count, sum(gain) as total_gain, sum(loss) as total_loss,
           sum(expansion) as total_expansion, sum(contraction) as total_contraction from gl group by node_id
""")
def node_totals(t: Source) -> DataFrame:
    return families.node_totals(_gain_loss(t))


TARGETS = GAIN_LOSS + """,
    evidence as (select case when p_size <= 40 then p_partkey else -p_partkey end as gene_id, 'fam_' || p_type as family_id, 'family ' || p_type as family_name, 'pfam' as evidence_type from part
                 union all select case when p_size <= 30 then p_partkey else -p_partkey end, 'fam_big', 'big', 'keyword' from part),
    og as (select p_partkey as gene_id, p_size || '/' || p_brand || '/' || p_type as orthogroup_id from part where p_size > 15),
    per_family as (select family_id as orthogroup_id, sum(gain) as gain, sum(loss) as loss, sum(expansion) as expansion, sum(contraction) as contraction,
                   string_agg(distinct node_id, ';' order by node_id) filter (where gain + loss + expansion + contraction > 0) as event_nodes from gl group by family_id),
    typed as (select gene_id, string_agg(distinct evidence_type, ';' order by evidence_type) as evidence_types from evidence group by gene_id),
    detail as (select e.gene_id, e.family_id as target_family_id, e.family_name as target_family_name, o.orthogroup_id, ty.evidence_types,
                      coalesce(nullif(concat_ws(';', case when gain > 0 then 'gain' end, case when loss > 0 then 'loss' end, case when expansion > 0 then 'expansion' end,
                        case when contraction > 0 then 'contraction' end), ''), case when o.orthogroup_id is null or p.orthogroup_id is null then 'missing' else 'no_change' end) as evolution_status,
                      case when p.orthogroup_id is not null then coalesce(p.event_nodes, '') end as event_nodes, coalesce(gain, 0) as gain, coalesce(loss, 0) as loss, coalesce(expansion, 0) as expansion, coalesce(contraction, 0) as contraction,
                      coalesce(nullif(concat_ws(';', case when o.orthogroup_id is null then 'orthogroup_assignment' end,
                        case when p.orthogroup_id is null then 'orthogroup_evolution_event' end), ''), 'none') as missing_data_note
               from (select distinct gene_id, family_id, family_name from evidence) e join typed ty using (gene_id) left join og o using (gene_id)
               left join per_family p on p.orthogroup_id = o.orthogroup_id)
"""


def _target_evidence(t: Source) -> DataFrame:
    known = lambda most: F.when(F.col("p_size") <= most, F.col("p_partkey")).otherwise(-F.col("p_partkey")).alias("gene_id")
    small = t.part.select(
        known(40), F.concat(F.lit("fam_"), "p_type").alias("family_id"), F.concat(F.lit("family "), "p_type").alias("family_name"),
        F.lit("pfam").alias("evidence_type"))
    return small.unionByName(t.part.select(
        known(30), F.lit("fam_big").alias("family_id"), F.lit("big").alias("family_name"), F.lit("keyword").alias("evidence_type")))


def _orthogroups(t: Source) -> DataFrame:
    key = F.when(F.col("p_size") > 15, F.col("p_partkey")).otherwise(-F.col("p_partkey") - 10**12)
    return t.part.select(key.alias("gene_id"), F.concat_ws("/", F.col("p_size").cast("string"), "p_brand", "p_type").alias("family_id"))


def _evolution(t: Source) -> DataFrame:
    return families.family_evolution(_target_evidence(t), _orthogroups(t), _gain_loss(t))


@query(TARGETS + "select * from detail")
def family_evolution(t: Source) -> DataFrame:
    return _evolution(t)


@query(TARGETS + """,
    exploded as (select *, unnest(string_split(event_nodes, ';')) as node from detail where event_nodes <> '')
    select d.target_family_id, d.target_family_name, count(distinct d.gene_id) as selected_genes, count(distinct d.orthogroup_id) as orthogroups,
           count(distinct case when evolution_status not in ('no_change', 'missing') then d.gene_id end) as genes_with_evolution_signal,
           """ + ", ".join(f"""coalesce((select string_agg(distinct x.node, ';' order by x.node) from exploded x
               where x.target_family_id = d.target_family_id and x.target_family_name = d.target_family_name and x.{m} > 0), 'NA') as {m}_nodes"""
                           for m in families.METRICS) + """,
           coalesce(string_agg(distinct missing_data_note, ';' order by missing_data_note) filter (where missing_data_note <> 'none'), 'none') as missing_data_note
    from detail d group by d.target_family_id, d.target_family_name
""")
def family_evolution_summary(t: Source) -> DataFrame:
    return families.family_evolution_summary(_evolution(t))


INTEGRATED = TARGETS + """,
    cand as (select cast(l_partkey as varchar) as query_id, max(l_extendedprice) as alien_index from lineitem group by l_partkey),
    ev as (select cast(gene_id as varchar) as gene_id, string_agg(distinct family_id, ';' order by family_id) as fams from evidence group by gene_id),
    rows as (select c.query_id, 'g' as best_donor_group, 'fine' as refined_donor_taxon, o.orthogroup_id,
                    case when e.fams is null then 'not_target_family' else 'target_family' end as target_family_status, e.fams as target_family_ids,
                    case when p.orthogroup_id is null then 'missing' else coalesce(nullif(concat_ws(';', case when contraction > 0 then 'contraction' end,
                      case when expansion > 0 then 'expansion' end, case when gain > 0 then 'gain' end, case when loss > 0 then 'loss' end), ''), 'no_change') end as evolution_status,
                    p.event_nodes, round(c.alien_index, 6) as alien_index,
                    coalesce(nullif(concat_ws(';', case when o.orthogroup_id is null then 'orthogroup_assignment' end,
                      case when p.orthogroup_id is null then 'orthogroup_evolution_event' end, 'refined_donors'), ''), 'none') as missing_data_note
             from cand c left join (select cast(gene_id as varchar) as gene_id, orthogroup_id from og) o on o.gene_id = c.query_id
             left join ev e on e.gene_id = c.query_id left join per_family p on p.orthogroup_id = o.orthogroup_id)
"""


def _integrated(t: Source) -> DataFrame:
    candidates = t.lineitem.groupBy(F.col("l_partkey").alias("query_id")).agg(F.max("l_extendedprice").alias("alien_index")).select(
        "query_id", F.lit("g").alias("best_donor_group"), F.lit("fine").alias("best_donor_taxon"), "alien_index", F.lit(0.0).alias("bitscore_delta"))
    return families.candidate_integration(candidates, None, _orthogroups(t), _target_evidence(t), _gain_loss(t))


@query(INTEGRATED + "select * from rows")
def candidate_integration(t: Source) -> DataFrame:
    return rounded(_integrated(t), "alien_index").drop("gene_id", "bitscore_delta")


@query(INTEGRATED + """
    select category, value, count(*) as candidate_count from (
        select 'donor_group' as category, best_donor_group as value from rows union all select 'target_family_status', target_family_status from rows
        union all select 'evolution_status', evolution_status from rows) group by all
""")
def candidate_integration_summary(t: Source) -> DataFrame:
    return families.integration_summary(_integrated(t))


@query("""
    select distinct p_brand as family_id, case when p_size > 25 then 'sp|' || p_partkey else cast(p_partkey as varchar) end as gene_id
    from part where p_brand in (select p_brand from part where p_size = 50)
""")
def family_members(t: Source) -> DataFrame:
    members = t.part.select(F.col("p_brand").alias("family_id"), text("p_partkey").alias("gene_id"))
    targets = t.part.select(keyed(F.col("p_size") == 50, F.col("p_brand")).alias("family_id"))
    renamed = t.part.select(keyed(F.col("p_size") > 25, text("p_partkey")).alias("original_id"), F.concat(F.lit("sp|"), text("p_partkey")).alias("prefixed_id"))
    return families.family_members(members, targets, renamed)


@query("""
    select distinct p_brand as family_id, p_partkey as seqid, d.seq from part join {dna} d on d.seqid = p_partkey
""")
def family_fasta(t: Source) -> DataFrame:
    members = t.part.select(F.col("p_brand").alias("family_id"), F.col("p_partkey").alias("gene_id"))
    return families.family_fasta(members, t.dna)


EXPRESSION = """
    with fam as (select distinct c_custkey as gene_id, c_mktsegment as family_id from customer),
    rows as (select e.gene_id, e.sample, e.expression_value, f.family_id from {expression} e join fam f using (gene_id))
"""


def _expression(t: Source) -> DataFrame:
    return matrices.gene_set_expression(t.expression, t.customer.select(F.col("c_custkey").alias("gene_id"), F.col("c_mktsegment").alias("family_id")))


@query(EXPRESSION + "select * from rows")
def gene_set_expression(t: Source) -> DataFrame:
    return _expression(t)


@query(EXPRESSION + """
    select family_id, sample, count(*) as genes_observed, round(cast(sum(cast(round(expression_value * 100) as bigint)) as double) / count(*) / 100, 6) as mean_expression,
           round(cast(sum(cast(round(expression_value * 100) as bigint)) as double) / 100, 2) as sum_expression, round(median(expression_value), 6) as median_expression
    from rows group by family_id, sample
""")
def expression_summary(t: Source) -> DataFrame:
    found = rounded(matrices.expression_summary(_expression(t)), "mean_expression", "median_expression")
    return rounded(found, "sum_expression", digits=2)


@query(EXPRESSION + ", m as (select family_id, sample, round(avg(expression_value), 4) as v from rows group by all) select family_id, " + ", ".join(
    f"coalesce(max(case when sample = '{s}' then v end), 0.0::double) as \"{s}\"" for s in ("click", "error", "purchase", "view", "none")) + " from m group by family_id")
def expression_matrix(t: Source) -> DataFrame:
    means = _expression(t).groupBy("family_id", "sample").agg(F.round(F.avg("expression_value"), 4).alias("mean_expression"))
    return matrices.expression_matrix(means, ["click", "error", "purchase", "view", "none"])


SETS = {"failed": "o_orderstatus = 'F'", "urgent": "o_orderpriority = '1-URGENT'", "rich": "o_totalprice > 100000"}


@query("select o_orderkey as gene_id, " + ", ".join(f"max(case when {c} then 1 else 0 end) as {n}" for n, c in SETS.items())
       + ", max(" + " + ".join(f"case when {c} then 1 else 0 end" for c in SETS.values()) + ") as membership_count from orders where "
       + " or ".join(SETS.values()) + " group by o_orderkey")
def membership_matrix(t: Source) -> DataFrame:
    return matrices.membership_matrix({n: t.orders.filter(c).select(F.col("o_orderkey").alias("gene_id")) for n, c in SETS.items()})


@query(" union all ".join(f"select '{n}' as set_name, count(distinct o_orderkey) as gene_count from orders where {c}" for n, c in SETS.items()))
def membership_sizes(t: Source) -> DataFrame:
    return matrices.membership_sizes({n: t.orders.filter(c).select(F.col("o_orderkey").alias("gene_id")) for n, c in SETS.items()})


def _links(t: Source) -> DataFrame:
    return t.links.withColumn("ref_species", F.when(F.col("ref_gene") % 2 == 0, "O").otherwise("A"))


LINKS = "with l as (select *, case when ref_gene % 2 = 0 then 'O' else 'A' end as ref_species from {links} k)"


@query(LINKS + """
    select ref_species, query_species, count(distinct block_id) as blocks, count(*) as linked_gene_pairs, count(distinct ref_gene) as unique_ref_genes,
           count(distinct query_gene) as unique_query_genes from l group by all
""")
def synteny_summary(t: Source) -> DataFrame:
    return synteny.synteny_summary(_links(t))


@query(LINKS + """,
    s as (select ref_species as a, query_species as b, count(*)::double as v from l group by all),
    sym as (select a, b, v, 0 as swapped from s union all select b, a, v, 1 from s),
    one as (select a, b, v from (select *, row_number() over (partition by a, b order by swapped) as rn from sym) where rn = 1)
    select a as species, """ + ", ".join(f"coalesce(max(case when b = '{x}' then v end), 0.0::double) as \"{x}\"" for x in "AFOP") + " from one group by a")
def synteny_heatmap(t: Source) -> DataFrame:
    return synteny.synteny_heatmap(synteny.synteny_summary(_links(t)), "linked_gene_pairs", True)


@query(LINKS + "select g as gene_id, count(*) as links from (select cast(ref_gene as varchar) as g from l union all select cast(query_gene as varchar) from l) group by g")
def links_per_gene(t: Source) -> DataFrame:
    return synteny.links_per_gene(t.links)


@query("""
    with g as (select o_orderkey as gene_id, 'chr' || (o_custkey % 5) as seqid, o_orderkey * 10 as start0, o_orderkey * 10 + 5 as end0 from orders where o_orderpriority <> '5-LOW'),
    b as (select l_orderkey as r1, l_orderkey + 1 as r2, l_partkey as q1, l_suppkey as q2 from lineitem)
    select r1.seqid as ref_seqid, r1.start0 as ref_start0, r2.end0 as ref_end0, q1.seqid as query_seqid, q1.start0 as query_start0, q2.end0 as query_end0,
           r1.gene_id is not null and r2.gene_id is not null and q1.gene_id is not null and q2.gene_id is not null as complete
    from b left join g r1 on r1.gene_id = b.r1 left join g r2 on r2.gene_id = b.r2 left join g q1 on q1.gene_id = b.q1 left join g q2 on q2.gene_id = b.q2
""")
def link_coordinates(t: Source) -> DataFrame:
    genes = t.orders.select(
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey")).otherwise(-F.col("o_orderkey") - 1).alias("gene_id"), F.concat(F.lit("chr"), (F.col("o_custkey") % 5).cast("string")).alias("seqid"),
        (F.col("o_orderkey") * 10).alias("start0"), (F.col("o_orderkey") * 10 + 5).alias("end0"))
    blocks = t.lineitem.select(
        F.col("l_orderkey").alias("ref_first"), (F.col("l_orderkey") + 1).alias("ref_last"), F.col("l_partkey").alias("query_first"), F.col("l_suppkey").alias("query_last"))
    return synteny.link_coordinates(blocks, genes, genes)


PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("select o_custkey, " + ", ".join(f"max(case when o_orderpriority = '{p}' then 1 else 0 end) as \"{p}\"" for p in PRIORITIES) + " from orders group by o_custkey")
def status_matrix(t: Source) -> DataFrame:
    return matrices.status_matrix(t.orders, "o_custkey", "o_orderpriority", PRIORITIES)


@query("""
    select 'F' || c_custkey as family_id, 'n1' as node_id, (c_custkey % 3)::double as gain, (c_nationkey % 2)::double as loss, 0.0::double as expansion,
           0.0::double as contraction, null::varchar as inferred_count, 'n1' as node_label from customer
    union all
    select 'F' || c_custkey, 'n_2', 0.0, 0.0, (c_custkey % 5)::double, (c_nationkey % 4)::double, nullif(cast(c_custkey % 7 as varchar), '0'), 'n_2' from customer
""")
def gain_loss_wide(t: Source) -> DataFrame:
    """Both spellings of a node's metric columns."""
    number = lambda c, n: (F.col(c) % n).cast("string")
    return families.normalize_gain_loss_wide(t.customer.select(
        F.concat(F.lit("F"), text("c_custkey")).alias("Family"), number("c_custkey", 3).alias("n1|gain"), number("c_nationkey", 2).alias("n1|loss"),
        number("c_custkey", 5).alias("n_2_expansion"), number("c_nationkey", 4).alias("n_2|contraction"), number("c_custkey", 7).alias("n_2|count")))


def _wide_counts(t: Source) -> DataFrame:
    return t.orders.select(
        F.concat(F.lit("F"), text("o_custkey")).alias("Orthogroup"), (F.col("o_orderkey") % 7 - 1).cast("string").alias("A"),
        F.when(F.col("o_orderstatus") == "P", "x").when(F.col("o_orderstatus") == "F", "").otherwise("3").alias("B"), F.lit("9").alias("Total"), F.col("o_orderkey").alias("_row"))


@query("""
    with w as (select 'F' || o_custkey as fam, o_orderkey % 7 - 1 as a, case o_orderstatus when 'F' then 0 when 'O' then 3 end as b, o_orderkey,
                      min(o_orderkey) over (partition by o_custkey) as first_line from orders)
    select fam as "Family ID", greatest(a, 0) as "A", coalesce(b, 0) as "B", nullif(concat_ws(';', case when o_orderkey > first_line then 'duplicate_family_id' end,
           case when a < 0 then 'invalid_count:A' end, case when b is null then 'invalid_count:B' end), '') as reason from w
""")
def count_check(t: Source) -> DataFrame:
    return families.check_counts(_wide_counts(t), ["A", "B"])


@query("""
    select 'F' || o_custkey as "Desc", 'F' || o_custkey as "Family ID", cast(o_orderkey % 7 - 1 as varchar) as "A",
           case o_orderstatus when 'P' then 'x' when 'F' then '0' else '3' end as "B" from orders
""")
def cafe_matrix(t: Source) -> DataFrame:
    return families.cafe_matrix(_wide_counts(t), ["A", "B"])
