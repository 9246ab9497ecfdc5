"""Gene-structure and tree queries over annotation-like rows made from orders and line items."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import genes, matrices, trees
from .catalogue import Source, keyed, query, rounded, text

SEGMENTS = """
    with seg as (select cast(l_orderkey as varchar) as tx, 'chr' || (l_orderkey % 5) as seqid, l_linenumber * 100 + l_suppkey % 7 as s,
                        l_linenumber * 100 + l_suppkey % 7 + cast(l_quantity as bigint) * 2 as e, l_returnflag as flag
                 from lineitem),
    ranked as (select *, row_number() over (partition by tx, seqid order by s, e) as k, lead(s) over (partition by tx, seqid order by s, e) as next_s from seg),
    introns as (select tx, seqid, e as start0, next_s - 1 as end0, next_s - 1 - e as length, k from ranked where next_s - 1 > e)
"""


def _features(t: Source) -> DataFrame:
    """Genes from customers, transcripts from orders and exons from line items."""
    attrs = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    line = F.struct(F.lit("f").alias("path"), F.lit(0).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("line"))
    common = [F.lit("sp").alias("species"), F.lit("+").alias("strand"), attrs.alias("attrs"), line.alias("_row")]
    seqid = lambda c: F.concat(F.lit("chr"), (F.col(c) % 5).cast("string")).alias("seqid")
    start = F.col("l_linenumber") * 100 + F.col("l_suppkey") % 7
    exons = t.lineitem.select(
        *common, seqid("l_orderkey"), F.lit("exon").alias("type"), start.cast("bigint").alias("start"), (start + F.col("l_quantity").cast("bigint") * 2).alias("end"),
        F.lit(None).cast("string").alias("id"), F.array(text("l_orderkey")).alias("parents"))
    transcripts = t.orders.select(
        *common, seqid("o_orderkey"), F.lit("mRNA").alias("type"), F.lit(1).cast("bigint").alias("start"), (F.col("o_orderkey") % 900 + 100).alias("end"),
        text("o_orderkey").alias("id"), F.array(F.concat(F.lit("g"), text("o_custkey"))).alias("parents"))
    whole = t.customer.select(
        *common, seqid("c_custkey"), F.lit("gene").alias("type"), F.lit(1).cast("bigint").alias("start"), (F.col("c_custkey") % 1000 + 1).alias("end"),
        F.concat(F.lit("g"), text("c_custkey")).alias("id"), F.array().cast("array<string>").alias("parents"))
    return whole.unionByName(transcripts).unionByName(exons)


INTRONS = """
    select 'sp' as species, i.seqid, start0, end0, start0 + 1 as start1, end0 as end1, length, '+' as strand, 'g' || o_custkey as gene_id, tx as transcript_id, k as intron_number, 'exon' as source_feature,
           length between 40 and 65 as is_short_intron, {at} as at_content, {rich} as is_at_rich
    from introns i left join orders on cast(o_orderkey as varchar) = tx
"""


@query(SEGMENTS + INTRONS.format(at="null::double", rich="null::boolean"))
def introns(t: Source) -> DataFrame:
    return genes.introns(_features(t))


@query(SEGMENTS.rstrip() + """,
    places as (select distinct seqid, start0, end0, length from introns),
    bases as (select p.seqid, start0, end0, substring(g.seq, start0 + 1, length) as s from places p join {dna} g on p.seqid = 'chr' || g.seqid),
    shares as (select seqid, start0, end0, length(s) - length(replace(replace(s, 'A', ''), 'T', '')) as at, length(s) as n from bases)
""" + INTRONS.format(at="round(sh.at / nullif(sh.n, 0), 6)", rich="round(sh.at / nullif(sh.n, 0), 6) >= 0.7") + " left join shares sh using (seqid, start0, end0)")
def introns_with_at_share(t: Source) -> DataFrame:
    """A+T share of every intron, cut from the recoded documents; NULL beyond the end of a sequence."""
    genome = t.dna.select(F.lit("sp").alias("species"), F.concat(F.lit("chr"), text("seqid")).alias("seqid"), "seq")
    return rounded(genes.introns(_features(t), genome=genome), "at_content")


@query(SEGMENTS + """
    select 'transcripts_with_introns' as metric, count(distinct tx)::double as value from introns
    union all select 'genes_with_introns', count(distinct o_custkey)::double from introns join orders on cast(o_orderkey as varchar) = tx
    union all select 'total_introns', count(*)::double from introns
    union all select 'unique_introns', count(distinct (seqid, start0, end0))::double from introns
    union all select 'short_introns', count(*)::double from introns where length between 40 and 65
    union all select 'at_rich_introns', 0.0::double
    union all select 'total_intron_bp', sum(length)::double from introns
    union all select 'mean_intron_length', round(avg(length), 6) from introns
    union all select 'median_intron_length', round(median(length), 6) from introns
""")
def intron_summary(t: Source) -> DataFrame:
    return rounded(genes.intron_summary(genes.introns(_features(t))).drop("species"), "value")


@query(SEGMENTS + """
    select 'sp' as species, i.seqid, start0, end0, '+' as strand, start0 + 1 as start1, end0 as end1, length, 'exon' as source_feature, length between 40 and 65 as is_short_intron,
           null::double as at_content, null::boolean as is_at_rich, min(k) as intron_number, count(distinct tx) as transcript_count, count(distinct o_custkey) as gene_count
    from introns i left join orders on cast(o_orderkey as varchar) = tx group by all
""")
def unique_introns(t: Source) -> DataFrame:
    return genes.unique_introns(genes.introns(_features(t)))


@query(SEGMENTS + """
    select distinct 'sp' as species, i.seqid, start0, end0, '+' as strand, tx as transcript_id, coalesce('g' || o_custkey, 'NA') as gene_id
    from introns i left join orders on cast(o_orderkey as varchar) = tx
""")
def intron_members(t: Source) -> DataFrame:
    return genes.intron_members(genes.introns(_features(t)))


@query(SEGMENTS + """,
    per_tx as (select o_orderkey, o_custkey, o_orderkey % 900 + 100 as n, coalesce(x.exons, 0) as exons from orders
               left join (select tx, count(*) as exons from seg group by tx) x on x.tx = cast(o_orderkey as varchar)),
    iso as (select o_custkey, count(*) as n from orders group by o_custkey)
    select * from (
        select 'feature_records' as metric, ((select count(*) from lineitem) + (select count(*) from orders) + (select count(*) from customer))::double as value
        union all select 'genes', count(*)::double from customer union all select 'transcripts', count(*)::double from orders
        union all select 'cds_features', 0.0::double union all select 'mean_cds_feature_length', null::double
        union all select 'exons', count(*)::double from seg union all select 'introns', count(*)::double from introns
        union all select 'single_exon_transcripts', count(*)::double from per_tx where exons = 1
        union all select 'multi_exon_transcripts', count(*)::double from per_tx where exons > 1
        union all select 'genes_with_isoforms', count(*)::double from iso where n > 1
        union all select 'mean_gene_length', round(avg(c_custkey % 1000 + 1), 6) from customer
        union all select 'median_gene_length', round(median(c_custkey % 1000 + 1), 6) from customer
        union all select 'mean_transcript_length', round(avg(n), 6) from per_tx
        union all select 'mean_exon_length', round(avg(e - s + 1), 6) from seg
        union all select 'mean_intron_length', round(avg(length), 6) from introns
        union all select 'median_intron_length', round(median(length), 6) from introns
        union all select 'mean_exons_per_transcript', round(avg(exons), 6) from per_tx
        union all select 'mean_isoforms_per_gene', round(avg(n), 6) from iso)
""")
def structure_metrics(t: Source) -> DataFrame:
    metrics = genes.gff_structure(_features(t), only=["metrics"])["metrics"]
    return rounded(metrics.select("metric", "value"), "value")


@query("""
    select 'chr' || (k % 5) as seqid, cast(sum(g) as bigint) as gene_count, cast(sum(x) as bigint) as transcript_count, cast(sum(bp) as bigint) as gene_bp,
           round(sum(bp) / sum(g), 6) as mean_gene_length, round(sum(g) / (max(last) / 1000000), 6) as gene_density_per_mb
    from (select c_custkey as k, 1 as g, 0 as x, c_custkey % 1000 + 1 as bp, c_custkey % 1000 + 1 as last from customer
          union all select o_orderkey, 0, 1, 0, 0 from orders) group by k % 5
""")
def structure_sequences(t: Source) -> DataFrame:
    found = genes.gff_structure(_features(t), only=["sequences"])["sequences"].drop("species")
    return rounded(found, "mean_gene_length", "gene_density_per_mb")


@query(SEGMENTS + """,
    values_t as (select 'exon_length' as category, e - s + 1 as v, 10 as w from seg union all select 'intron_length', length, 10 from introns
                 union all select 'mRNA_length', o_orderkey % 900 + 100, 50 from orders
                 union all select 'exon_number', coalesce(n, 0), 1 from orders left join (select tx, count(*) as n from seg group by tx) x on x.tx = cast(o_orderkey as varchar)),
    c as (select category, v // w * w as bin_start, count(*) as raw_count, w as bin_size from values_t group by all)
    select category, 0::bigint as bin_start, 0::bigint as raw_count, 1 as bin_size, cast(sum(raw_count) as bigint) as total_count, 0.0::double as percent from c where category = 'exon_number' group by category
    union all
    select *, cast(sum(raw_count) over (partition by category) as bigint) as total_count, round(raw_count / sum(raw_count) over (partition by category) * 100, 5) as percent from c
""")
def structure_histograms(t: Source) -> DataFrame:
    found = genes.gff_structure(_features(t), only=["histograms"])["histograms"].drop("species")
    return rounded(found, "percent", digits=5)


@query("""
    select * from (
        select 'duplicate_ids' as check, 'pass' as status, '0' as details
        union all select 'child_features_without_parent', 'pass', '0'
        union all select 'missing_parent_references', case when count(*) > 0 then 'fail' else 'pass' end, cast(count(*) as varchar)
        from (select p from (
            select distinct 'g' || o_custkey as p from orders where o_custkey not in (select c_custkey from customer)
            union select distinct cast(l_orderkey as varchar) from lineitem where l_orderkey not in (select o_orderkey from orders)))
        union all select 'seqids_in_genome', 'pass', 'not_tested')
""")
def structure_checks(t: Source) -> DataFrame:
    return genes.gff_structure(_features(t), only=["checks"])["checks"].drop("species")


@query("""
    with ids as (select distinct p_name || '_' || p_partkey as full_id from part),
    cut as (select distinct substring(p_name || '_' || p_partkey, 1, 6 + cast(p_partkey % 9 as int)) as tip from part),
    found as (select tip, count(full_id) as n, min(full_id) as one, bool_or(full_id = tip) as same from cut left join ids on starts_with(full_id, tip) group by tip)
    select tip, case when not same and n = 1 then one else tip end as resolved, case when same then 'exact' when n = 1 then 'prefix' else 'ambiguous' end as status from found
""")
def prefix_id_resolution(t: Source) -> DataFrame:
    full = F.concat_ws("_", "p_name", text("p_partkey"))
    cut = F.substring(full, F.lit(1), F.lit(6) + (F.col("p_partkey") % 9).cast("int"))
    return trees.resolve_truncated_ids(t.part.select(cut.alias("tip")), t.part.select(full.alias("seqid")))


@query("""
    select tree_id, '(' || string_agg(coalesce(c_mktsegment || '_' || c_custkey, tip) || ':' || len, ',' order by k) || ');' as newick, count(*) as tips, '' as repeated
    from (select o_custkey as tree_id, cast(o_orderkey as varchar) as tip, o_orderkey as k, o_orderkey % 10 as len from orders) o
    left join customer on c_mktsegment <> 'BUILDING' and cast(c_custkey as varchar) = o.tip group by tree_id
""")
def rename_tips(t: Source) -> DataFrame:
    part = F.array_sort(F.collect_list(F.struct(F.col("o_orderkey").alias("k"), F.concat_ws(":", text("o_orderkey"), (F.col("o_orderkey") % 10).cast("string")).alias("x"))))
    corpus = t.orders.groupBy(F.col("o_custkey").alias("tree_id")).agg(part.alias("p")).select(
        "tree_id", F.concat(F.lit("("), F.array_join(F.transform("p", lambda i: i["x"]), ","), F.lit(");")).alias("newick"))
    labels = t.customer.select(keyed(F.col("c_mktsegment") != "BUILDING", text("c_custkey")).alias("tip_id"), F.concat_ws(" ", "c_mktsegment", text("c_custkey")).alias("label"))
    return trees.rename_tips(corpus, labels).select("tree_id", "newick", "tips", F.array_join("repeated_tips", ";").alias("repeated"))


@query("""
    select cast(c_custkey as varchar) as tip_id, case when c_nationkey < 10 then c_mktsegment end as gene_id, 'target' as source_group, null::varchar as species from customer
    union all select distinct 'n' || n_nationkey, null, 'outgroup', 'outgroup' from nation
""")
def function_tip_table(t: Source) -> DataFrame:
    targets = t.customer.select(text("c_custkey").alias("gene_id"))
    notes = t.customer.select(keyed(F.col("c_nationkey") < 10, text("c_custkey")).alias("transcript_id"), F.col("c_mktsegment").alias("gene_id"))
    outgroups = t.nation.select(F.concat(F.lit("n"), text("n_nationkey")).alias("gene_id"))
    return trees.function_tip_table(targets, notes, outgroups).select("tip_id", "gene_id", "source_group", "species")


@query("""
    select metric, """ + ", ".join(f"max(case when o_orderstatus = '{s}' then v end) as \"{s}\"" for s in "FOP") + """
    from (select o_orderpriority as metric, o_orderstatus, cast(count(*) as double) as v from orders group by all) group by metric
""")
def structure_matrix(t: Source) -> DataFrame:
    metrics = t.orders.groupBy(F.col("o_orderpriority").alias("metric"), F.col("o_orderstatus").alias("species")).agg(F.count(F.lit(1)).cast("double").alias("value"))
    return matrices.structure_matrix(metrics)


@query("""
    select * from (
        select s.o_orderstatus || '/' || l_returnflag as orthogroup, 'success' as status, count(*) as sequence_count, max(cast(l_quantity as bigint)) as alignment_length, null::varchar as failed_reason
        from lineitem join orders s on l_orderkey = o_orderkey where s.o_orderstatus <> 'P' group by all
        union all select 'P/' || l_returnflag, 'failed', 0, 0, 'none' from lineitem join orders on l_orderkey = o_orderkey where o_orderstatus = 'P' group by l_returnflag)
""")
def gene_tree_status(t: Source) -> DataFrame:
    rows = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("/", "o_orderstatus", "l_returnflag").alias("orthogroup"), F.repeat(F.lit("A"), F.col("l_quantity").cast("int")).alias("seq"))
    done = rows.filter("orthogroup not like 'P%'").select(F.concat(F.translate("orthogroup", "/", "-"), F.lit(".treefile")).alias("tree_file")).distinct()
    failed = rows.select(F.translate("orthogroup", "/", "-").alias("orthogroup")).distinct().withColumn("failed_reason", F.lit("none"))
    found = trees.gene_tree_status(done, rows.withColumn("orthogroup", F.translate("orthogroup", "/", "-")), None, failed)
    return found.select(F.translate("orthogroup", "-", "/").alias("orthogroup"), "status", "sequence_count", "alignment_length", "failed_reason")


@query("""
    select 'sp|' || p_partkey as tip_id, 'sp' as species, cast(p_partkey as varchar) as transcript_id, n.gene_id, 'sp|' || p_partkey as label, n.pfam as "Pfam_ids",
           null::varchar as "KEGG_ko", n.note as description
    from part left join (select cast(p_partkey as varchar) as k, p_type as gene_id, p_brand as pfam, p_name as note from part where p_size > 10) n on n.k = cast(p_partkey as varchar)
""")
def tip_annotation(t: Source) -> DataFrame:
    notes = t.part.select(
        keyed(F.col("p_size") > 10, F.col("p_partkey")).alias("transcript_id"), F.col("p_type").alias("gene_id"), F.col("p_brand").alias("Pfam_ids"),
        F.col("p_name").alias("SwissProt_description"))
    ids = t.part.select(F.concat(F.lit("sp|"), text("p_partkey")).alias("prefixed_id"), text("p_partkey").alias("original_id"), F.lit("sp").alias("prefix"))
    return trees.tip_annotation(notes, ids)
