"""Parsers and writers: lines made from the test tables are read, tables are written as files and read back."""
from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import coverage, families, hits, matrices, qc, synteny, terms, trees
from ..session import checkpoint_dir
from ..sources import fasta, gff, lines, reports, sinks
from .catalogue import Source, query, text
from .queries_sources import written_lines


def folder(t: Source, label: str) -> str:
    """A new folder for files of one query, beside other intermediates."""
    return f"{checkpoint_dir(t.spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def tabs(*cells: Column | str) -> Column:
    return F.concat_ws("\t", *[F.lit(c) if isinstance(c, str) else c.cast("string") for c in cells])


def named(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), text(column))


# Tables, lists and sequences as files


@query("""
    select cast(p_partkey as varchar) as p_partkey, p_name, p_type, case when p_size >= 10 then p_brand end as brand, cast(p_size as varchar) as p_size, null::varchar as absent from part
""")
def table_file(t: Source) -> DataFrame:
    """Missing cells are NA in the file, and so is a column the table lacks."""
    path = folder(t, "table")
    brand = F.when(F.col("p_size") >= 10, F.col("p_brand")).otherwise("")
    sinks.write_table(t.part.withColumn("brand", brand), path, ["p_partkey", "p_name", "p_type", "brand", "p_size", "absent"])
    return lines.read_table(t.spark, path)


@query("select cast(seqid as varchar) as seqid, cast(length(seq) as bigint) as length, md5(seq) as seq_md5 from {dna} d")
def fasta_file(t: Source) -> DataFrame:
    """Wrapped records, written in order over part files and read strictly."""
    path = folder(t, "sequences")
    sinks.write_fasta(t.dna, path, order=["seqid"])
    return fasta.read_fasta(t.spark, path).select("seqid", "length", F.md5("seq").alias("seq_md5"))


@query("""
    select cast(doc_id % 150 as varchar) as seqid, 'second ' || max(doc_id) as word, max(length(d.seq)) filter (d.seqid = last) as length, max(md5(d.seq)) filter (d.seqid = last) as seq_md5
    from (select doc_id, max(doc_id) over (partition by doc_id % 150) as last from documents) x join {dna} d on d.seqid = doc_id group by doc_id % 150
""")
def fasta_last_record(t: Source) -> DataFrame:
    """Of a repeated id the last record of the file counts; sequences come out in upper case."""
    header = F.concat(F.lit(">"), (F.col("seqid") % 150).cast("string"), F.lit(" second "), text("seqid"))
    record = F.concat(header, F.lit("\n"), F.lower("seq"), F.lit("\n"))
    found = fasta.read_fasta(t.spark, written_lines(t.dna, record, F.col("seqid")), "last", upper=True)
    return found.select("seqid", F.regexp_replace("header", r"^\S+ ", "").alias("word"), "length", F.md5("seq").alias("seq_md5"))


@query("""
    select 'back' as region_set, cast(region_id as varchar) as region_id, seqid, start0, end0, '0' as score, strand from {regions} r
""")
def bed_file(t: Source) -> DataFrame:
    path = folder(t, "regions")
    sinks.write_bed(t.regions, path)
    return gff.read_bed(t.spark, path, "back")


@query("select row_number() over (order by seqid, start0, end0, region_id) as row_number, region_id, seqid, start0, end0 from {regions} r")
def genomic_order(t: Source) -> DataFrame:
    """Rows numbered in the order in which sinks write them."""
    return sinks.numbered(t.regions, ["seqid", "start0", "end0", "region_id"]).select("row_number", "region_id", "seqid", "start0", "end0")


@query("""
    select term_id, gene_count, row_number() over (order by gene_count desc, term_id) as row_number
    from (select p_type || p_size as term_id, count(distinct l_orderkey) as gene_count from lineitem join part on l_partkey = p_partkey group by 1)
""")
def count_order(t: Source) -> DataFrame:
    """Largest counts first, then names."""
    pairs = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("gene_id"), F.concat("p_type", text("p_size")).alias("term_id"))
    counts = terms.term_counts(pairs).select("term_id", "gene_count")
    return sinks.numbered(counts, sinks.count_order("gene_count", "term_id"))


@query("select distinct p_brand as gene_id from part where p_size > 3")
def id_file(t: Source) -> DataFrame:
    path = folder(t, "ids")
    sinks.write_lines(t.part.filter("p_size > 3"), "p_brand", path)
    return lines.read_ids(t.spark, path)


@query("select n_regionkey, n_name as member from nation")
def list_files(t: Source) -> DataFrame:
    """One folder per key, as orthogroup member lists are written."""
    path = folder(t, "lists")
    sinks.write_lists(t.nation, ["n_regionkey"], F.col("n_name"), path)
    return t.spark.read.text(path).select("n_regionkey", F.col("value").alias("member"))


@query("""
    select field, value from (select cast(count(*) as varchar) as rows, cast(max(p_size) as varchar) as largest, null::varchar as nothing from part)
    unpivot include nulls (value for field in (rows, largest, nothing))
""")
def field_values(t: Source) -> DataFrame:
    return sinks.field_values(t.part.agg(F.count(F.lit(1)).alias("rows"), F.max("p_size").alias("largest"), F.lit(None).cast("string").alias("nothing")))


@query("select p_brand || ' = ' || min(p_size) || '-' || max(p_size) as value from part group by p_brand")
def partition_lines(t: Source) -> DataFrame:
    return sinks.partition_lines(t.part.groupBy(F.col("p_brand").alias("gene")).agg(F.min("p_size").alias("start"), F.max("p_size").alias("end")))


@query("select c_custkey as k, case when c_nationkey < 3 then 'r' || c_custkey else 'read' || c_custkey end as region_id from customer")
def trimmed_read_names(t: Source) -> DataFrame:
    name = F.concat(F.when(F.col("c_nationkey") < 3, "r").otherwise("read"), text("c_custkey"), F.lit("/2"))
    return sinks.trim_read_names(t.customer.select(F.col("c_custkey").alias("k"), name.alias("region_id")))


# Annotation and regions


@query("""
    select 'chr' || (c_custkey % 5) as seqid, greatest(0, c_custkey - 1) as start0, c_custkey + c_nationkey as end0, case when c_nationkey < 20 then 'gene' else 'mRNA' end as ftype,
           case when c_nationkey % 3 = 0 then 'g' || c_custkey when c_nationkey % 3 = 1 then 'n' || c_custkey
                else case when c_nationkey < 20 then 'gene' else 'mRNA' end || '_' || (c_custkey - (select min(c_custkey) from customer) + 1) end as feature_id
    from customer where c_nationkey < 22
""")
def gff_intervals(t: Source) -> DataFrame:
    """Features of the listed types; ID, then Name, then type and line number name them."""
    kind = F.when(F.col("c_nationkey") < 20, "gene").when(F.col("c_nationkey") < 22, "mRNA").otherwise("exon")
    attributes = F.when(F.col("c_nationkey") % 3 == 0, named("ID=g", "c_custkey")).when(F.col("c_nationkey") % 3 == 1, named("Name=n", "c_custkey")).otherwise("note=x")
    line = tabs(F.concat(F.lit("chr"), (F.col("c_custkey") % 5).cast("string")), "s", kind, F.col("c_custkey"), F.col("c_custkey") + F.col("c_nationkey"), ".", "+", ".", attributes)
    return gff.overlap_features(gff.read_gff(t.spark, written_lines(t.customer, line, F.col("c_custkey"))), ["gene", "mRNA"])


CALLS = """
    select coalesce({id}, 'eve_' || (c_custkey - (select min(c_custkey) from customer) + {first})) as region_id, 'chr' || c_nationkey as seqid, c_custkey as start0,
           c_custkey + 100 as end0, {strand} as strand, {source} as source, {kind} as region_type, {score} as score, {attributes} as attributes from customer
"""
SOME_ID = "case when c_nationkey % 2 = 0 then 'r' || c_custkey end"


@query(CALLS.format(id=SOME_ID, first=1, strand="'-'", source="'caller'", kind="'eve'", score="'7'", attributes="null::varchar"))
def regions_from_bed(t: Source) -> DataFrame:
    line = tabs(named("chr", "c_nationkey"), F.col("c_custkey"), F.col("c_custkey") + 100, F.when(F.col("c_nationkey") % 2 == 0, named("r", "c_custkey")).otherwise(""), "7", "-")
    return gff.standardize_regions(t.spark, written_lines(t.customer, line, F.col("c_custkey")), "bed", "caller", "eve")


@query(CALLS.format(id=SOME_ID, first=1, strand="'+'", source="'virsorter'", kind="'provirus'", score="null::varchar", attributes="case when c_nationkey % 2 = 0 then 'ID=r' || c_custkey else 'x=1' end"))
def regions_from_gff(t: Source) -> DataFrame:
    attributes = F.when(F.col("c_nationkey") % 2 == 0, named("ID=r", "c_custkey")).otherwise("x=1")
    line = tabs(named("chr", "c_nationkey"), "virsorter", "provirus", F.col("c_custkey") + 1, F.col("c_custkey") + 100, ".", "+", ".", attributes)
    return gff.standardize_regions(t.spark, written_lines(t.customer, line, F.col("c_custkey")), "gff", "caller", "eve", ["provirus"])


@query(CALLS.format(id="'t' || c_custkey", first=1, strand="'+'", source="c_mktsegment", kind="'eve'", score="null::varchar", attributes="null::varchar"))
def regions_from_table(t: Source) -> DataFrame:
    """A table file with 1-based starts under other column names."""
    path = folder(t, "calls")
    rows = t.customer.select(named("t", "c_custkey").alias("ID"), named("chr", "c_nationkey").alias("chrom"), (F.col("c_custkey") + 1).alias("start"), (F.col("c_custkey") + 100).alias("end"),
                             F.lit("+").alias("strand"), F.col("c_mktsegment").alias("source"))
    sinks.write_table(rows, path)
    return gff.standardize_regions(t.spark, path, "tsv", "caller", "eve")


@query("""
    with r as (select l_orderkey, l_linenumber, l_partkey, cast(l_quantity as bigint) as q, l_suppkey % 5 as c from lineitem)
    select concat_ws(chr(9), 'chr' || c, 'RepeatMasker-4.0.1', 'similarity', l_partkey, l_partkey + q, '100', case when l_linenumber = 1 then '-' else '+' end, '.',
           'Target=rep' || l_linenumber || ' ' || case when l_linenumber % 2 = 0 then 'LINE/L1' else 'Simple_repeat' end || ' ' || case when l_linenumber = 1 then 3 else 1 end || ' 2;Div=' || q || '.5;Del=0.1;Ins=2;SWscore=100;color='
           || case when l_linenumber % 2 = 0 then '#3399ff' else '#8686ac' end) as value from r
""")
def repeat_gff(t: Source) -> DataFrame:
    """Repeat lines as coloured annotation."""
    n = F.col("l_linenumber")
    line = F.concat_ws(" ", F.lit("100"), F.concat(F.col("l_quantity").cast("bigint").cast("string"), F.lit(".5")), F.lit("0.1"), F.lit("2"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")),
                       text("l_partkey"), (F.col("l_partkey") + F.col("l_quantity").cast("bigint")).cast("string"), F.lit("(9)"), F.when(n == 1, "C").otherwise("+"),
                       F.concat(F.lit("rep"), n.cast("string")), F.when(n % 2 == 0, "LINE/L1").otherwise("Simple_repeat"), F.lit("1"), F.lit("2"), F.lit("3"))
    return sinks.repeat_gff(reports.read_repeatmasker(t.spark, written_lines(t.lineitem, line, F.col("l_orderkey"))))


@query("""
    select category, count(*) as n from (select unnest(case when l_linenumber % 3 = 0 then ['all repeat', 'LINE'] else ['all repeat'] end) as category from lineitem) group by 1
""")
def repeat_categories(t: Source) -> DataFrame:
    """Categories by text anywhere in the line."""
    line = F.when(F.col("l_linenumber") % 3 == 0, "a LINE/L1 b").otherwise("other")
    return t.lineitem.select(F.explode(coverage.repeat_labels(line)).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


# Hits, annotation tables, families


@query("""
    select 'q' || l_orderkey as query_id, 's' || l_partkey as subject_id, case when l_linenumber = 1 then l_shipmode end as description
    from (select *, case when l_returnflag = 'A' then 'late' else 'early' end as l_shipmode from lineitem)
""")
def parse_best_hits(t: Source) -> DataFrame:
    """A thirteenth column is a description."""
    twelve = [named("q", "l_orderkey"), named("s", "l_partkey"), *["1"] * 10]
    line = F.when(F.col("l_linenumber") == 1, tabs(*twelve, F.when(F.col("l_returnflag") == "A", "late").otherwise("early"))).otherwise(tabs(*twelve))
    return reports.read_best_hits(t.spark, written_lines(t.lineitem, line, F.col("l_orderkey"))).drop("_row")


@query("select 'q' || p_partkey as query, p_brand as seed, p_type as \"COG_category\" from part")
def parse_eggnog(t: Source) -> DataFrame:
    """A preamble of double marks, then the header."""
    head = t.region.select((F.col("r_regionkey") - 10).alias("n"), F.when(F.col("r_regionkey") == 4, "#query\tseed\tCOG_category").otherwise("## made by a tool").alias("line"))
    body = t.part.select(F.col("p_partkey").alias("n"), tabs(named("q", "p_partkey"), F.col("p_brand"), F.col("p_type")).alias("line"))
    return reports.read_eggnog(t.spark, written_lines(head.unionByName(body), F.col("line"), F.col("n"))).drop("_row")


@query("""
    select 'F' || l_partkey as family_id, 'sp' || l_linenumber as species, 'g' || l_orderkey || '.' || l_suppkey as gene_id from lineitem
""")
def parse_orthogroup_table(t: Source) -> DataFrame:
    """A wide file with gene lists in its cells."""
    path = folder(t, "orthogroups")
    cell = lambda k: F.array_join(F.collect_list(F.when(F.col("l_linenumber") == k, F.concat(named("g", "l_orderkey"), named(".", "l_suppkey")))), ", ").alias(f"sp{k}")
    sinks.write_table(t.lineitem.groupBy(named("F", "l_partkey").alias("Orthogroup")).agg(*map(cell, range(1, 8))), path)
    return reports.read_orthogroup_table(t.spark, path)


@query("select 'F' || p_size as family_id, species, cast(n as bigint) as copies from (select p_size, count(*) filter (p_partkey % 2 = 0) as even, count(*) filter (p_partkey % 2 = 1) as odd, 0 as bad from part group by p_size) unpivot (n for species in (even, odd, bad))")
def parse_count_matrix(t: Source) -> DataFrame:
    """Cells that are no number count as zero; the total is no species."""
    path = folder(t, "counts")
    odd = F.col("p_partkey") % 2 == 1
    wide = t.part.groupBy(named("F", "p_size").alias("Orthogroup")).agg(F.count_if(~odd).alias("even"), F.count_if(odd).alias("odd"), F.first(F.lit("x")).alias("bad"), F.count(F.lit(1)).alias("Total"))
    sinks.write_table(wide, path)
    return families.to_long_counts(lines.read_table(t.spark, path))


@query("select n_name as node, r_name as parent from nation join region on n_regionkey = r_regionkey where n_nationkey <> 3")
def parse_nodes(t: Source) -> DataFrame:
    pairs = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    line = F.concat(F.when(F.col("n_nationkey") == 3, "# ").otherwise(" "), F.translate("n_name", " ", "~"), F.lit(" \t"), F.translate("r_name", " ", "~"), F.lit("  more"))
    found = reports.read_nodes(t.spark, written_lines(pairs, line, F.col("n_nationkey")))
    return found.select(*[F.translate(c, "~", " ").alias(c) for c in ("node", "parent")])


@query("""
    select 'o' || o_orderkey as query_id, case when o_custkey % 3 = 0 then 'plants' when o_custkey % 7 = 0 then 'NA' else 'fungi' end as best_donor_group, o_custkey % 40 - 10 as alien_index,
           case when o_custkey % 3 <> 0 and o_custkey % 7 <> 0 and o_custkey % 40 - 10 >= 5 and o_custkey % 40 + 50 >= 60 then 'candidate' else 'rejected' end as candidate_status from orders
""")
def lineage_file(t: Source) -> DataFrame:
    """A wide table of hits by taxon group, written as a file, read by its header and judged."""
    path = folder(t, "lineage")
    key = F.col("o_custkey")
    h = F.when(key % 3 == 0, "plants").when(key % 7 == 0, "unknown").otherwise("fungi")
    columns = {
        "Query_id": named("o", "o_orderkey"), "self_evalue": F.lit("1e-5"), "fungi": F.lit("1e-20"), "plants": F.lit("1e-9"), "alien_index": (key % 40 - 10).cast("string"),
        "AI_taxon": F.lit(None).cast("string"), "self_bitscore": F.lit("40"), "fungi_bitscore": F.lit("60"), "plants_bitscore": F.lit("50"), "delta": F.lit("20"), "delta_percent": F.lit("50"),
        "ratio": F.lit("1.5"), "h_taxon": h, "donor_bitscore": (key % 40 + 50).cast("string"), "donor_taxon_count": F.lit("4")}
    sinks.write_table(t.orders.select(*[c.alias(n) for n, c in columns.items()]), path)
    judged = hits.filter_lineage_table(reports.read_lineage_table(t.spark, path), "metazoa", ["fungi"], 5.0, 0.0, 60.0, 1)
    return judged.select("query_id", "best_donor_group", F.col("alien_index").cast("bigint").alias("alien_index"), "candidate_status")


# Synteny


def anchors(t: Source) -> DataFrame:
    """Anchor lines with a marker before each customer's block."""
    marks = t.orders.groupBy("o_custkey").agg(F.min("o_orderkey").alias("k")).select((F.col("o_custkey") * 10_000_000).alias("n"), F.lit("###").alias("line"))
    links = t.orders.select((F.col("o_custkey") * 10_000_000 + F.col("o_orderkey") + 1).alias("n"), F.concat_ws("\t", named("r", "o_custkey"), named("q", "o_orderkey"), F.lit("9")).alias("line"))
    return written_lines(marks.unionByName(links), F.col("line"), F.col("n"))


@query("""
    select 'block_' || dense_rank() over (order by o_custkey) as block_id, 'r' || o_custkey as ref_gene, 'q' || o_orderkey as query_gene, 'ath' as ref_species, 'osa' as query_species, '9' as score,
           'anchor' as source_format from orders
""")
def synteny_anchors(t: Source) -> DataFrame:
    """Blocks are counted at marker lines; the pair label names the species."""
    return reports.read_synteny(t.spark, anchors(t), "anchor", "ath.osa")


@query("""
    select 'block_' || row_number() over (order by o_orderkey) as block_id, 'a' || o_orderkey || '..b' || o_orderkey as ref_gene, 'c' || o_custkey || '..d' || o_custkey as query_gene,
           'x' as ref_species, 'y' as query_species, '5' as score, 'simple' as source_format from orders where o_orderstatus <> 'P'
""")
def synteny_simple(t: Source) -> DataFrame:
    cells = [named("a", "o_orderkey"), named("b", "o_orderkey"), named("c", "o_custkey"), named("d", "o_custkey"), F.lit("5"), F.lit("+")]
    line = F.concat(F.when(F.col("o_orderstatus") == "P", "#").otherwise(""), tabs(*cells))
    return reports.read_synteny(t.spark, written_lines(t.orders, line, F.col("o_orderkey")), "simple", "x_vs_y")


@query("""
    select coalesce(case when o_custkey % 2 = 0 then 'B' || o_custkey end, 'block_' || (o_orderkey - (select min(o_orderkey) from orders) + 2)) as block_id, 'r' || o_custkey as ref_gene, 'q' || o_orderkey as query_gene,
           'ref' as ref_species, 'query' as query_species, cast(o_orderkey % 7 as varchar) as score, 'table' as source_format from orders
""")
def synteny_named_table(t: Source) -> DataFrame:
    """Columns by the names of the header; unnamed blocks are called after their line."""
    head = t.orders.agg((F.min("o_orderkey") - 1).alias("n")).withColumn("line", F.lit("score\tgene2\tgene1\tblock_id\tref_gene"))
    block = F.when(F.col("o_custkey") % 2 == 0, named("B", "o_custkey")).otherwise("")
    body = t.orders.select(F.col("o_orderkey").alias("n"), tabs((F.col("o_orderkey") % 7), named("q", "o_orderkey"), F.lit("-"), block, named("r", "o_custkey")).alias("line"))
    return reports.read_synteny(t.spark, written_lines(head.unionByName(body), F.col("line"), F.col("n")), "table")


@query("""
    select 'a' || o_orderkey as ref_first, 'b' || o_orderkey as ref_last, 'c' || o_custkey as query_first, 'd' || o_custkey as query_last from orders
""")
def parse_simple_blocks(t: Source) -> DataFrame:
    line = tabs(named("a", "o_orderkey"), named("b", "o_orderkey"), named("c", "o_custkey"), named("d", "o_custkey"), "5", "+")
    return reports.read_simple_blocks(t.spark, written_lines(t.orders, line, F.col("o_orderkey")))


# Trees, alignments, graphs


@query("select p_brand as tree_id, p_name || p_partkey as tip from part")
def newick_tips(t: Source) -> DataFrame:
    """Names in tree text; lengths and supports are numbers."""
    tip = F.concat(F.translate("p_name", " ", "_"), text("p_partkey"), F.lit(":1e-5"))
    corpus = t.part.groupBy(F.col("p_brand").alias("tree_id")).agg(F.concat(F.lit("("), F.array_join(F.array_sort(F.collect_list(tip)), ","), F.lit(")0.99;")).alias("newick"))
    return trees.newick_tips(corpus).select("tree_id", F.translate("tip", "_", " ").alias("tip"))


@query("select 'f' as alignment, 'sp' || p_partkey as species, p_type as seq from part")
def parse_phylip(t: Source) -> DataFrame:
    head = t.part.agg((F.min("p_partkey") - 1).alias("n")).withColumn("line", F.lit("  12  34"))
    body = t.part.select(F.col("p_partkey").alias("n"), F.concat(named("sp", "p_partkey"), F.lit("   "), F.translate("p_type", " ", "-")).alias("line"))
    return fasta.read_phylip(t.spark, written_lines(head.unionByName(body), F.col("line"), F.col("n"))).withColumn("seq", F.translate("seq", "-", " "))


@query("select 's' || p_partkey as seqid, p_brand as seq from part where p_size % 2 = 0")
def graph_segments(t: Source) -> DataFrame:
    line = F.when(F.col("p_size") % 2 == 0, tabs("S", named("s", "p_partkey"), F.col("p_brand"), "LN:i:5")).otherwise(tabs("L", named("s", "p_partkey"), "+"))
    return fasta.read_graph_segments(t.spark, written_lines(t.part, line, F.col("p_partkey")))


# Orthology files


@query("""
    select 'g' || l_orderkey as gene_id, ko_id from (select l_orderkey, max(l_partkey) as p from lineitem group by l_orderkey)
    cross join lateral (select unnest(case when p % 4 = 0 then [null::varchar] else ['K' || p, 'K' || (p + 1)] end) as ko_id)
""")
def ko_background(t: Source) -> DataFrame:
    """Background file of genes and KO text; remarks after a bar go, genes without KO stay."""
    kos = F.when(F.col("p") % 4 == 0, "").otherwise(F.concat(named("K", "p"), F.lit("|a remark!K"), (F.col("p") + 1).cast("string")))
    rows = t.lineitem.groupBy("l_orderkey").agg(F.max("l_partkey").alias("p"))
    return reports.gene_kos(reports.read_ko_lists(t.spark, written_lines(rows, tabs(named("g", "l_orderkey"), kos), F.col("l_orderkey"))))


@query("select 'K' || p_partkey as ko_id, pathway_id from part cross join lateral (select unnest(['ko' || p_size, 'ko' || (p_size + 100)]) as pathway_id)")
def ko_map(t: Source) -> DataFrame:
    line = tabs(named("K", "p_partkey"), F.concat(named("ko", "p_size"), F.lit("  ko"), (F.col("p_size") + 100).cast("string")))
    return reports.read_ko_map(t.spark, written_lines(t.part, line, F.col("p_partkey")))


@query("select 'ko' || n_nationkey as pathway_id, n_name as pathway_name, r_name as level1, cast(n_regionkey as varchar) as level2 from nation join region on n_regionkey = r_regionkey")
def pathway_titles(t: Source) -> DataFrame:
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return reports.read_pathway_titles(t.spark, written_lines(rows, tabs(named("ko", "n_nationkey"), F.col("n_name"), F.col("r_name"), F.col("n_regionkey")), F.col("n_nationkey")))


@query("""
    select 'G' || p_partkey as gene_id, case when p_size % 2 = 0 then 'K' || p_size else 'K' || p_size || '!K77' end as ko from part where p_partkey % 3 = 0
""")
def species_kos(t: Source) -> DataFrame:
    """KO numbers in the headers of one species of a reference file."""
    code = F.when(F.col("p_partkey") % 3 == 0, "ath").otherwise("osa")
    kos = F.when(F.col("p_size") % 2 == 0, named("K", "p_size")).otherwise(F.concat(named("K", "p_size"), F.lit("; K77")))
    line = F.concat(F.lit(">"), code, F.lit(":G"), text("p_partkey"), F.lit("  a protein; "), kos, F.lit(" other"))
    return reports.species_kos(t.spark, written_lines(t.part, line, F.col("p_partkey")), "ath")


# Quality reports of a cohort


@query("""
    select 's' || c_custkey as sample, case when c_custkey % 2 = 0 then 'metazoa_odb10' else 'fungi_odb10' end as lineage, '5.' || c_nationkey as busco_version, c_nationkey || '.5' as complete_percent,
           '90.0' as single_copy_percent, cast(c_custkey as varchar) as complete_count, cast(c_custkey + 7 as varchar) as total_buscos from customer
""")
def busco_reports(t: Source) -> DataFrame:
    """Text and JSON reports of many samples in one table."""
    n, k = text("c_custkey"), text("c_nationkey")
    plain = F.concat(F.lit("# BUSCO version is: 5."), k, F.lit("\n# The lineage dataset is: fungi_odb10 (Creation date: 2020)\n\tC:"), k, F.lit(".5%[S:90.0%,D:1.0%],F:2.0%,M:3.0%,n:9\n\t"), n,
                     F.lit("\tComplete BUSCOs (C)\n\t1\tMissing BUSCOs (M)\n\t"), (F.col("c_custkey") + 7).cast("string"), F.lit("\tTotal BUSCO groups searched\n"))
    as_json = F.concat(F.lit('{"lineage_dataset": "metazoa_odb10", "version": "5.'), k, F.lit('", "results": {"Complete percentage": "'), k, F.lit('.5", "Single copy percentage": "90.0", "Complete BUSCOs": "'), n,
                       F.lit('", "n": "'), (F.col("c_custkey") + 7).cast("string"), F.lit('"}}'))
    even = F.col("c_custkey") % 2 == 0
    path = F.concat(F.lit("/x/short_summary.specific.s"), n, F.when(even, ".json").otherwise(".txt"))
    found = qc.busco_summary(t.customer.select(path.alias("path"), F.when(even, as_json).otherwise(plain).alias("text")))
    return found.select("sample", "lineage", "busco_version", "complete_percent", "single_copy_percent", "complete_count", "total_buscos")


@query("""
    select 'cohort' as sample, case when c_nationkey = 0 then null else 'chr' || r end as region, case when c_nationkey = 0 then null else cast(c_custkey as varchar) end as start,
           case when c_nationkey = 0 then null else c_nationkey || '.25' end as lai_score,
           case when c_nationkey = 0 then 'missing' when c_nationkey >= 20 then 'gold' when c_nationkey >= 10 then 'reference' when c_nationkey >= 5 then 'draft' else 'low' end as quality_status,
           c_custkey || '.LAI' as lai_file
    from customer cross join lateral (select unnest(case when c_nationkey = 0 then [0] else [1, 2] end) as r)
""")
def lai_reports(t: Source) -> DataFrame:
    """Index rows of many files with their grade; a file without rows is reported."""
    row = lambda r: F.concat(F.lit(f"chr{r}\t"), text("c_custkey"), F.lit("\t99\t3.5\t"), text("c_nationkey"), F.lit(".25\n"))
    body = F.when(F.col("c_nationkey") == 0, F.lit("# nothing\n")).otherwise(F.concat(F.lit("#Chr\tFrom\tTo\traw_LAI\tLAI\n"), row(1), row(2)))
    found = qc.lai_summary(t.customer.select(F.concat(text("c_custkey"), F.lit(".LAI")).alias("path"), body.alias("text")), "cohort")
    return found.select("sample", "region", "start", "lai_score", "quality_status", "lai_file")


@query("""
    select 'cohort' as sample, metric, value, c_custkey || '.qv' as source_file from (select c_custkey, cast(c_custkey as varchar) as assembly, '0.' || c_nationkey as kmer_error_rate, c_nationkey || '.5' as kmer_qv from customer)
    unpivot (value for metric in (assembly, kmer_error_rate, kmer_qv))
""")
def merqury_reports(t: Source) -> DataFrame:
    line = F.concat(text("c_custkey"), F.lit("\t12\t34\t0."), text("c_nationkey"), F.lit("\t"), text("c_nationkey"), F.lit(".5\n"))
    return qc.merqury_summary(t.customer.select(F.concat(text("c_custkey"), F.lit(".qv")).alias("path"), line.alias("text")), "cohort")


@query("select n_name as species, cat as plot_group, n_name as x, cat as y, case when n_nationkey % 2 = 0 then cast(n_nationkey as varchar) else cast(n_regionkey as varchar) end as value, cat as source_category from nation cross join (select 'c' as cat)")
def plot_rows(t: Source) -> DataFrame:
    """The length where there is one, else the count."""
    rows = t.nation.select(F.col("n_name").alias("species"), F.lit("c").alias("category"), F.when(F.col("n_nationkey") % 2 == 0, text("n_nationkey")).alias("length"), F.col("n_regionkey").alias("count"))
    return matrices.plot_rows(rows)


@query("select 'a' as ref_species, 'b' as query_species, count(distinct 'x' || o_custkey) as blocks, count(*) as linked_gene_pairs, count(distinct o_custkey) as unique_ref_genes, count(distinct o_orderkey) as unique_query_genes from orders")
def anchor_summary(t: Source) -> DataFrame:
    return synteny.synteny_summary(reports.read_synteny(t.spark, anchors(t), "anchor", "a_vs_b"))
