"""Annotation-term, annotation-merge and rule queries."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import annotations, families, rules, terms
from ..session import durable
from .catalogue import Source, keyed, query, rounded, text

MAPPED = """
    with kos as (select distinct l_orderkey as gene_id, p_type || '/' || p_name as ko_id from lineitem join part on l_partkey = p_partkey),
    map as (select distinct p_type || '/' || p_name as ko_id, p_brand as pathway_id from part where p_size % 4 = 0),
    names as (select distinct p_brand as pathway_id, 'name of ' || p_brand as pathway_name, substr(p_brand, 1, 7) as level1, 'all' as level2
              from part where p_brand not like '%3'),
    rows as (select * from kos join map using (ko_id))
"""


def _kos(t: Source) -> DataFrame:
    ko = F.concat_ws("/", "p_type", "p_name")
    return t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("gene_id"), ko.alias("ko_id")).distinct()


def _ko_map(t: Source) -> DataFrame:
    ko = F.concat_ws("/", "p_type", "p_name")
    return t.part.select(keyed(F.col("p_size") % 4 == 0, ko).alias("ko_id"), F.col("p_brand").alias("pathway_id")).distinct()


def _pathway_names(t: Source) -> DataFrame:
    return t.part.select(
        keyed(~F.col("p_brand").endswith("3"), F.col("p_brand")).alias("pathway_id"), F.concat(F.lit("name of "), "p_brand").alias("pathway_name"),
        F.substring("p_brand", 1, 7).alias("level1"), F.lit("all").alias("level2")).distinct()


@query("""
    select term_id, count(distinct gene_id) as gene_count, n.term_name from {gene_terms} g left join (select p_brand, min(p_type) as term_name from part group by p_brand) n on n.p_brand = g.term_id
    group by term_id, n.term_name
""")
def term_counts(t: Source) -> DataFrame:
    names = t.part.groupBy(F.col("p_brand").alias("term_id")).agg(F.min("p_type").alias("term_name"))
    return terms.term_counts(t.gene_terms.select(text("gene_id").alias("gene_id"), "term_id"), names)


@query("""
    select distinct cast(p_partkey as varchar) as gene_id, unnest(string_split(replace(p_name, ' ', ';') || ';' || p_type, ';')) as term_id from part
""")
def gene_term_long(t: Source) -> DataFrame:
    """Terms of a list cell with mixed separators, one row each."""
    cell = F.concat_ws("| ", F.replace("p_name", F.lit(" "), F.lit(", ")), "p_type", "p_type")
    return terms.gene_terms(t.part.select(text("p_partkey").alias("transcript_id"), cell.alias("GO_terms")), "GO_terms")


@query(MAPPED + "select r.*, pathway_name, level1, level2 from rows r left join names using (pathway_id)")
def gene_pathways(t: Source) -> DataFrame:
    return terms.gene_pathways(_kos(t), _ko_map(t), _pathway_names(t))


@query(MAPPED + """
    select pathway_id, count(distinct gene_id) as gene_count, count(distinct ko_id) as ko_count, any_value(pathway_name) as pathway_name,
           any_value(level1) as level1, any_value(level2) as level2
    from rows left join names using (pathway_id) group by pathway_id
""")
def pathway_counts(t: Source) -> DataFrame:
    kos = _kos(t).withColumn("gene_id", text("gene_id"))
    return terms.pathway_counts(kos, _ko_map(t), _pathway_names(t))


@query(MAPPED + """
    select distinct ko_id, cast(gene_id as varchar) as gene_id from kos where ko_id not in (select ko_id from map)
""")
def unmapped_terms(t: Source) -> DataFrame:
    return terms.unmapped_terms(_kos(t).withColumn("gene_id", text("gene_id")), _ko_map(t))


@query("""
    with letters as (select distinct l_orderkey as gene_id, unnest([upper(l_returnflag), upper(l_linestatus)]) as category from lineitem),
    counts as (select category, count(*) as gene_count from letters group by category),
    shares as (select *, gene_count / (select count(distinct gene_id) from letters) as share from counts)
    select category, case category when 'A' then 'RNA processing and modification' when 'F' then 'Nucleotide transport and metabolism'
           when 'N' then 'Cell motility' when 'O' then 'Posttranslational modification, protein turnover, chaperones'
           when 'R' then 'General function prediction only' end as category_name,
           gene_count, round(share, 6) as proportion, round(log2(share), 6) as log2_proportion
    from shares
""")
def category_proportions(t: Source) -> DataFrame:
    cells = t.lineitem.select(text("l_orderkey").alias("query"), F.concat(F.lower("l_returnflag"), F.col("l_linestatus")).alias("COG_category"))
    return rounded(terms.category_proportions(terms.gene_categories(cells)), "proportion", "log2_proportion")


TESTED = """
    with universe as (select distinct gene_id from {gene_terms} g),
    fg as (select distinct gene_id from {foreground} f where gene_id in (select gene_id from universe)),
    totals as (select (select count(*) from universe) as bt, (select count(*) from fg) as ft),
    counts as (select term_id, count(*) as k, count(fg.gene_id) as a from {gene_terms} g left join fg using (gene_id) group by term_id),
    xs as (select term_id, a, k, ft, bt, unnest(range(a, least(ft, k) + 1)) as x from counts, totals),
    tails as (select term_id, a, k, ft, bt, least(1.0, sum(exp(
        lgamma(k + 1) - lgamma(x + 1) - lgamma(k - x + 1) + lgamma(bt - k + 1) - lgamma(ft - x + 1) - lgamma(bt - k - ft + x + 1)
        - lgamma(bt + 1) + lgamma(ft + 1) + lgamma(bt - ft + 1)))) as p from xs where bt - k - ft + x >= 0 group by all),
    ranked as (select *, row_number() over (order by p) as rk, count(*) over () as m from tails),
    tested as (select *, least(1.0, min(p * m / rk) over (order by p desc, rk desc rows unbounded preceding)) as q from ranked)
"""


def _enrichment(t: Source) -> DataFrame:
    pairs = t.gene_terms
    return terms.term_enrichment(pairs, pairs, t.foreground)


@query(TESTED + """
    select term_id, a as foreground_with_term, ft as foreground_total, k as background_with_term, bt as background_total,
           round(p, 6) as p_value, round(q, 6) as q_value from tested
""")
def term_enrichment(t: Source) -> DataFrame:
    return rounded(_enrichment(t), "p_value", "q_value")


@query(TESTED + """
    select term_id, n.term_name, 'part' as ontology, round(p, 6) as p_value, round(q, 6) as q_value, a as foreground_count, ft as foreground_total,
           k as background_count, bt as background_total, 'target' as plot_group, term_id || ' ' || n.term_name as label
    from tested join (select p_brand, min(p_type) as term_name from part group by p_brand) n on n.p_brand = term_id
    where q <= 0.999 order by q, p, term_id limit 10
""")
def top_terms(t: Source) -> DataFrame:
    names = t.part.groupBy(F.col("p_brand").alias("term_id")).agg(F.min("p_type").alias("term_name")).withColumn("ontology", F.lit("part"))
    return rounded(terms.top_terms(_enrichment(t), names, 10, 0.999), "p_value", "q_value")


@query(MAPPED + """,
    titled as (select m.ko_id, m.pathway_id, n.pathway_name from map m join names n using (pathway_id)),
    fg as (select gene_id, ko_id from kos where gene_id in (select o_orderkey from orders where o_orderstatus = 'F')),
    sums as (select (select count(distinct gene_id) from fg) as ft, (select count(distinct gene_id) from kos) as bt),
    f as (select pathway_id, count(distinct gene_id) as a from fg join titled using (ko_id) group by pathway_id),
    b as (select pathway_id, count(distinct gene_id) as k from kos join titled using (ko_id) group by pathway_id),
    xs as (select pathway_id, a, k, ft, bt, unnest(range(a, least(ft, k) + 1)) as x from f join b using (pathway_id), sums),
    tails as (select pathway_id, a, k, least(1.0, sum(exp(
        lgamma(k + 1) - lgamma(x + 1) - lgamma(k - x + 1) + lgamma(bt - k + 1) - lgamma(ft - x + 1) - lgamma(bt - k - ft + x + 1)
        - lgamma(bt + 1) + lgamma(ft + 1) + lgamma(bt - ft + 1)))) as p from xs where bt - k - ft + x >= 0 group by all),
    ranked as (select *, row_number() over (order by p) as rk, count(*) over () as m from tails),
    tested as (select *, least(1.0, min(p * m / rk) over (order by p desc, rk desc rows unbounded preceding)) as q from ranked)
    select pathway_id, a as foreground_genes, k as background_genes, round(p, 6) as p_value, round(q, 6) as q_value, pathway_name, level1, level2
    from tested join names using (pathway_id)
""")
def pathway_enrichment(t: Source) -> DataFrame:
    kos = _kos(t)
    foreground = kos.join(t.foreground, "gene_id", "left_semi")
    found = terms.pathway_enrichment(
        foreground.withColumn("gene_id", text("gene_id")), kos.withColumn("gene_id", text("gene_id")), _ko_map(t), _pathway_names(t))
    return rounded(found, "p_value", "q_value")


@query(MAPPED + """,
    fg as (select gene_id, ko_id from kos where gene_id in (select o_orderkey from orders where o_orderstatus = 'F'))
    select pathway_id, count(distinct gene_id) as foreground_genes, count(distinct ko_id) as foreground_kos, pathway_name, level1, level2
    from fg join map using (ko_id) join names using (pathway_id) group by pathway_id, pathway_name, level1, level2
""")
def pathway_tally(t: Source) -> DataFrame:
    foreground = _kos(t).join(t.foreground, "gene_id", "left_semi").withColumn("gene_id", text("gene_id"))
    return terms.pathway_tally(foreground, _ko_map(t), _pathway_names(t))


@query("""
    select l_returnflag as list_name, l_orderkey as gene_id, o_orderpriority as ko
    from (select distinct l_returnflag, l_orderkey from lineitem) join orders on o_orderkey = l_orderkey where o_orderstatus <> 'P'
""")
def select_ko(t: Source) -> DataFrame:
    lists = t.lineitem.select(F.col("l_returnflag").alias("list_name"), F.col("l_orderkey").alias("gene_id")).distinct()
    background = t.orders.select(F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).otherwise(-F.col("o_orderkey") - 1).alias("gene_id"), F.col("o_orderpriority").alias("ko"))
    return terms.select_ko(lists, background)


ARCHITECTURE = """
    with d as (select l_orderkey as query_id, p_brand as id, l_linenumber as s, l_linenumber + cast(l_quantity as bigint) as e
               from lineitem join part on l_partkey = p_partkey),
    arch as (select query_id, string_agg(id, '|' order by s, e, id) as domain_architecture, count(*) as domain_count,
                    string_agg(id, ';' order by s, e, id) as domains_ordered,
                    string_agg(id || ':' || s || '-' || e, ';' order by s, e, id) as domain_spans from d group by query_id)
"""


def _architectures(t: Source) -> DataFrame:
    domains = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("query_id"), F.col("p_brand").alias("domain_id"), F.col("l_linenumber").cast("bigint").alias("start"),
        (F.col("l_linenumber") + F.col("l_quantity").cast("bigint")).alias("end"))
    return terms.domain_architecture(domains)


@query(ARCHITECTURE + "select * from arch")
def domain_architecture(t: Source) -> DataFrame:
    return _architectures(t).withColumn("domain_count", F.col("domain_count").cast("bigint"))


@query(ARCHITECTURE + """
    select domain_architecture, count(*) as gene_count from arch group by domain_architecture
""")
def architecture_frequency(t: Source) -> DataFrame:
    return terms.architecture_frequency(_architectures(t).withColumn("query_id", text("query_id")))


@query("""
    with cds as (select cast(o_custkey as varchar) as tx, max_by(cast(o_orderkey as varchar), o_orderkey) as cds_len, max_by(o_orderstatus, o_orderkey) as phase_ok
                 from orders group by o_custkey),
    dom as (select cast(o_custkey as varchar) as tx, string_agg(distinct p_brand, ';' order by p_brand) as pfam, string_agg(distinct p_type, ';' order by p_type) as ipr
            from lineitem join part on l_partkey = p_partkey join orders on o_orderkey = l_orderkey group by o_custkey),
    egg as (select cast(c_custkey as varchar) as tx, c_mktsegment as cog from customer where c_nationkey < 20),
    best as (select cast(o_custkey as varchar) as tx, min_by(o_orderpriority, o_orderkey) as hit from orders where o_orderstatus = 'O' group by o_custkey)
    select cast(c_custkey as varchar) as transcript_id, 'g' || c_nationkey as gene_id, cds.cds_len, cds.phase_ok, dom.pfam as "Pfam_ids",
           dom.ipr as "InterPro_ids", egg.cog as "COG_category", best.hit as "SwissProt_best_hit", null::varchar as "NR_best_hit"
    from customer left join cds on cds.tx = cast(c_custkey as varchar) left join dom on dom.tx = cast(c_custkey as varchar)
         left join egg on egg.tx = cast(c_custkey as varchar) left join best on best.tx = cast(c_custkey as varchar)
""")
def merge_annotations(t: Source) -> DataFrame:
    transcripts = t.customer.select(
        text("c_custkey").alias("transcript_id"), F.concat(F.lit("g"), text("c_nationkey")).alias("gene_id"), F.lit("chr1").alias("seqid"),
        F.lit(1).alias("start"), F.lit(2).alias("end"), F.lit("+").alias("strand"))
    orders = t.orders
    cds = orders.select(text("o_custkey").alias("transcript_id"), text("o_orderkey").alias("cds_len"), F.col("o_orderstatus").alias("phase_ok"), F.col("o_orderkey").alias("_row"))
    domains = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        text("o_custkey").alias("Query_id"), F.lit("Pfam").alias("Subject_DB"), F.col("p_brand").alias("Subject_id"), F.col("p_type").alias("InterPro_id"),
        F.lit("NA").alias("GO_terms"))
    egg = t.customer.select(keyed(F.col("c_nationkey") < 20, text("c_custkey")).alias("query"), F.col("c_mktsegment").alias("COG_category"))
    best = orders.select(keyed(F.col("o_orderstatus") == "O", text("o_custkey")).alias("query_id"), F.col("o_orderpriority").alias("subject_id"), F.col("o_orderkey").alias("_row"))
    merged = annotations.merge_annotations(transcripts, cds, domains, egg, None, best, None)
    unlisted = lambda c: F.when(F.col(c) != "NA", F.col(c))
    return merged.select(
        "transcript_id", "gene_id", "cds_len", "phase_ok", unlisted("Pfam_ids").alias("Pfam_ids"), unlisted("InterPro_ids").alias("InterPro_ids"),
        "COG_category", "SwissProt_best_hit", "NR_best_hit")


@query("""
    with judged as (select cast(p_partkey as varchar) as id, p_type as gene_id, concat_ws(';',
        case when p_brand in ('Brand#2', 'Brand#17') then 'pfam' end, case when p_type in ('ECONOMY', 'PROMO') then 'ko' end,
        case when regexp_matches(p_name, '(?i)RING|bolt') then 'keyword' end,
        case when p_partkey in (select l_partkey from lineitem where l_quantity = 1) then 'candidate' end) as reason from part)
    select * from judged where reason <> ''
""")
def select_by_function(t: Source) -> DataFrame:
    table = t.part.select(
        text("p_partkey").alias("transcript_id"), F.col("p_type").alias("gene_id"), F.concat_ws(";", F.lit("NA"), "p_brand").alias("Pfam_ids"),
        F.concat_ws(", ", "p_type", F.lit("NA")).alias("KEGG_ko"), F.col("p_name").alias("note"))
    listed = t.lineitem.select(keyed(F.col("l_quantity") == 1, text("l_partkey")).alias("gene_id"))
    return annotations.select_by_function(table, ["Brand#2", "Brand#17"], ["ECONOMY", "PROMO"], "RING|bolt", listed)


EVIDENCE = """
    with ann as (select cast(p_partkey as varchar) as gene_id, p_name, p_type, p_brand, 'NA;' || p_brand || ', ' || p_type as terms from part),
    ev as (
        select gene_id, 'fam_' || r_name as family_id, 'family ' || r_name as family_name, 'go' as evidence_type, 'terms' as source_field,
               'r1_' || r_regionkey as rule_id, 'brand#' || (r_regionkey + 1) as matched_value, '2' as evidence_score, 'matched' as annotation_status
        from ann, region where p_brand = 'Brand#' || (r_regionkey + 1)
        union all
        select gene_id, 'fam_keyword', 'fam_keyword', 'keyword', 'description', 'r2', 'ring', '1', 'matched' from ann where contains(lower(p_name), 'ring')
        union all
        select gene_id, 'fam_regex', 'fam_regex', 'annotation', 'p_name', 'r3', '^red .*t$', '1', 'matched' from ann where regexp_matches(p_name, '(?i)^red .*t$')
        union all
        select gene_id, 'fam_exact', 'fam_exact', 'keyword', 'p_type', 'r4', 'promo', '1', 'matched' from ann where lower(p_type) = 'promo'
        union all
        select cast(l_orderkey as varchar), 'fam_hit', 'fam_hit', 'blast', 'subject', 'r5', cast(l_partkey as varchar), printf('%.6f', l_extendedprice / 100), 'hit'
        from lineitem where l_partkey = 77 and l_quantity >= 5
        union all
        select cast(o_orderkey as varchar), 'fam_seed', 'fam_seed', 'seed', 'seed_ids', 'r6', cast(o_orderkey as varchar), '3', 'seed_list'
        from orders where o_orderstatus = 'P' and contains(cast(o_orderkey as varchar), '12'))
"""


def _rule_table(t: Source) -> DataFrame:
    by_region = t.region.select(
        F.concat(F.lit("r1_"), text("r_regionkey")).alias("rule_id"), F.concat(F.lit("fam_"), "r_name").alias("family_id"),
        F.concat(F.lit("family "), "r_name").alias("family_name"), F.lit("go").alias("evidence_type"), F.lit("terms").alias("field"),
        F.concat(F.lit("brand#"), (F.col("r_regionkey") + 1).cast("string")).alias("pattern"), F.lit("contains").alias("match_mode"), F.lit("2").alias("score"))
    fixed = t.spark.createDataFrame([
        ("r2", "fam_keyword", None, "keyword", "description", "ring", None, None),
        ("r3", "fam_regex", None, "annotation", "p_name", "^red .*t$", "regex", None),
        ("r4", "fam_exact", None, "keyword", "p_type", "promo", "exact", None),
        ("r5", "fam_hit", None, "blast", "subject", "77", "exact", None),
        ("r6", "fam_seed", None, "seed", None, "12", None, "3"),
    ], "rule_id string, family_id string, family_name string, evidence_type string, field string, pattern string, match_mode string, score string")
    return rules.normalize_rules(by_region.unionByName(fixed))


def _evidence(t: Source) -> DataFrame:
    table = t.part.select(text("p_partkey").alias("transcript_id"), "p_name", "p_type", F.concat(F.lit("NA;"), "p_brand", F.lit(", "), "p_type").alias("terms"))
    key = text("o_orderkey")
    seeds = t.orders.select(F.when(F.col("o_orderstatus") == "P", key).otherwise(F.translate(key, "0123456789", "abcdefghij")).alias("gene_id"))
    found = rules.family_evidence(table, _rule_table(t), t.hits, seeds, max_evalue=3e-5)
    status = F.when(F.col("annotation_status").startswith("evalue="), "hit").otherwise(F.col("annotation_status"))
    return found.withColumn("annotation_status", status)


@query(EVIDENCE + "select * from ev")
def rule_evidence(t: Source) -> DataFrame:
    return _evidence(t)


@query(EVIDENCE + """
    select family_id, family_name, count(distinct gene_id) as selected_genes, count(*) as evidence_rows,
           count(distinct evidence_type) as evidence_type_count
    from ev group by family_id, family_name
""")
def rule_evidence_summary(t: Source) -> DataFrame:
    return rules.evidence_summary(_evidence(t))


@query(EVIDENCE + """
    select gene_id, string_agg(distinct family_id, ';' order by family_id) as family_ids, string_agg(distinct family_name, ';' order by family_name) as family_names,
           coalesce(any_value(p_type), gene_id) as gene_name, any_value(p_name) as description, coalesce(any_value(p_brand), null) as "KO_ids"
    from ev left join (select cast(p_partkey as varchar) as gene_id, p_type, p_name, p_brand from part) using (gene_id) group by gene_id
""")
def family_inputs(t: Source) -> DataFrame:
    table = t.part.select(
        text("p_partkey").alias("transcript_id"), F.col("p_type").alias("gene_id"), F.col("p_name").alias("SwissProt_description"), F.col("p_brand").alias("KEGG_ko"))
    evidence = durable(_evidence(t))
    return families.family_inputs(evidence.select("gene_id"), table, evidence).drop("Pfam_ids", "GO_terms")


@query("""
    with f as (select l_orderkey, 'K' || (l_partkey % 50) as ko, min(l_orderkey * 10 + l_linenumber) as first_line
               from lineitem where power(10.0, -l_quantity) < 3e-5 group by all)
    select cast(l_orderkey as varchar) as query_id, string_agg(ko, '!' order by first_line, ko) as kos from f group by l_orderkey
""")
def kofam_gene_ko(t: Source) -> DataFrame:
    found = t.lineitem.select(
        text("l_orderkey").alias("query_id"), F.concat(F.lit("K"), (F.col("l_partkey") % 50).cast("string")).alias("ko"),
        F.pow(F.lit(10.0), -F.col("l_quantity")).alias("evalue"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("_row"))
    return terms.kofam_gene_ko(found, 3e-5)


@query("""
    with s as (select distinct cast(c_custkey as varchar) as gene_id from customer),
    r(rule_id, family_id, mode, pattern, score) as (values ('e', 'F1', 'exact', '7', '1'), ('t', 'F2', 'token', '12', '2'), ('x', 'F3', 'regex', '^1.*2$', '1'),
        ('c', 'F4', 'contains', '13', '1'), ('e0', 'F5', 'exact', '', '1'), ('t0', 'F6', 'token', '', '1'), ('c0', 'F7', 'contains', '', '1'))
    select s.gene_id, family_id, family_id as family_name, 'seed' as evidence_type, 'seed_ids' as source_field, rule_id, s.gene_id as matched_value,
           score as evidence_score, 'seed_list' as annotation_status
    from s join r on pattern = '' or mode in ('exact', 'token') and s.gene_id = pattern or mode = 'regex' and regexp_matches(s.gene_id, pattern) or mode = 'contains' and contains(s.gene_id, pattern)
""")
def seed_evidence(t: Source) -> DataFrame:
    """Seed rules in all modes, with and without a pattern."""
    table = t.spark.createDataFrame([
        ("e", "F1", "exact", "7", "1"), ("t", "F2", "token", "12", "2"), ("x", "F3", "regex", "^1.*2$", "1"), ("c", "F4", "contains", "13", "1"),
        ("e0", "F5", "exact", "", "1"), ("t0", "F6", "token", "", "1"), ("c0", "F7", None, None, "1")], "rule_id string, family_id string, match_mode string, pattern string, score string")
    seeds = t.customer.select(F.col("c_custkey").alias("gene_id"))
    return rules.seed_evidence(seeds, rules.normalize_rules(table.withColumn("evidence_type", F.lit("seed"))))
