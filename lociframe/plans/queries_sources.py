"""Parsers of tool outputs over lines that are written from the test tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import gff, reports
from ..sources.lines import read_ids
from .catalogue import Source, query, text


def written_lines(df: DataFrame, line: Column, number: Column) -> DataFrame:
    """Lines of one file in the shape of ``read_lines``, ordered by ``number``."""
    place = F.struct(F.lit("f").alias("path"), F.lit(0).cast("bigint").alias("block"), number.cast("bigint").alias("line"))
    return df.select(F.lit("f").alias("path"), line.alias("line"), place.alias("_row"))


def _tabs(*cells: Column | str) -> Column:
    return F.concat_ws("\t", *[F.lit(c) if isinstance(c, str) else c.cast("string") for c in cells])


def _quantity() -> Column:
    return F.col("l_quantity").cast("bigint")


@query("""
    with q as (select l_orderkey, l_partkey, cast(l_quantity as bigint) as q from lineitem where l_linenumber not in (2, 3, 4))
    select cast(l_orderkey as varchar) as query_id, cast(l_partkey as varchar) as subject_id, 98.5::double as pident, q as length, 0::bigint as mismatch, 0::bigint as gapopen,
           1::bigint as qstart, 9::bigint as qend, 1::bigint as sstart, 9::bigint as send, cast('1e-' || q as double) * 1e50 as evalue, cast(q || '.5' as double) as bitscore from q
""")
def parse_hits(t: Source) -> DataFrame:
    """Comments, short lines and bad numbers are left out."""
    n = F.col("l_linenumber")
    evalue = F.when(n == 2, "x").otherwise(F.concat(F.lit("1e-"), _quantity().cast("string")))
    whole = _tabs(F.col("l_orderkey"), F.col("l_partkey"), "98.5", _quantity(), "0", "0", "1", "9", "1", "9", evalue, F.concat(_quantity().cast("string"), F.lit(".5")))
    line = F.when(n == 3, F.concat(F.lit("#"), whole)).when(n == 4, _tabs(F.col("l_orderkey"), F.col("l_partkey"), "1")).otherwise(whole)
    found = reports.read_hits(t.spark, written_lines(t.lineitem, line, F.col("l_orderkey")))
    return found.drop("line", "_row").withColumn("evalue", F.col("evalue") * 1e50)


@query("""
    select cast(p_partkey as varchar) as "Query_id", p_brand as "Subject_id", 'Pfam' as "Subject_DB", '1' as "Query_start", cast(p_size as varchar) as "Query_end", '1e-5' as "E_value",
           p_name as "Subject_annotation", case when p_size >= 10 then 'IPR' || p_size end as "InterPro_id", null::varchar as "InterPro_annotation", null::varchar as "GO_terms" from part
""")
def parse_interproscan(t: Source) -> DataFrame:
    size = F.col("p_size").cast("string")
    line = _tabs(F.col("p_partkey"), "m", "9", "Pfam", F.col("p_brand"), F.col("p_name"), "1", size, "1e-5", "T", "d", F.when(F.col("p_size") < 10, "NA").otherwise(F.concat(F.lit("IPR"), size)))
    return reports.read_interproscan(t.spark, written_lines(t.part, line, F.col("p_partkey")))


@query("""
    select 'g' || l_orderkey as "Query_id", 'K' || l_partkey as "KO", '10' as threshold, cast(cast(l_quantity as bigint) as varchar) as score,
           '1e-' || cast(l_quantity as bigint) as "E_value", '1' as pass, case when l_linenumber < 4 then 'free text of ' || l_returnflag end as description
    from lineitem where l_linenumber % 2 = 1
""")
def parse_kofam(t: Source) -> DataFrame:
    n, q = F.col("l_linenumber"), _quantity().cast("string")
    star = F.when(n % 2 == 1, "* ").otherwise("  ")
    tail = F.when(n < 4, F.concat(F.lit(" free text of "), "l_returnflag")).otherwise("")
    line = F.concat(star, F.lit("g"), text("l_orderkey"), F.lit("  K"), text("l_partkey"), F.lit(" 10 "), q, F.lit(" 1e-"), q, tail)
    return reports.read_kofam(t.spark, written_lines(t.lineitem, line, F.col("l_orderkey"))).drop("_row")


@query("""
    select 'chr' || (l_suppkey % 5) as seqid, l_partkey as pos, greatest(0, l_partkey - 1) as pos0, case l_returnflag when 'A' then 'CG' when 'N' then 'CHG' else 'CHH' end as context,
           cast(l_quantity as bigint) as methylated, cast(l_quantity as bigint) + l_linenumber as total
    from lineitem where cast(l_quantity as bigint) + l_linenumber >= 5
""")
def parse_cx(t: Source) -> DataFrame:
    context = F.when(F.col("l_returnflag") == "A", "CG").when(F.col("l_returnflag") == "N", "cag").otherwise("CTT")
    line = _tabs(F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")), F.col("l_partkey"), "+", _quantity(), F.col("l_linenumber"), context, "x")
    return reports.read_cx(t.spark, written_lines(t.lineitem, line, F.col("l_orderkey")), 5).drop("_row")


@query("""
    select 'chr' || (l_suppkey % 5) as seqid, l_partkey as start, l_partkey + cast(l_quantity as bigint) as "end", case when l_returnflag = 'A' then '-' else '+' end as strand,
           'rep' || l_linenumber as repeat_name, case when l_linenumber % 2 = 0 then 'LINE' else 'Simple_repeat' end as repeat_class,
           case when l_linenumber % 2 = 0 then 'L1/x' else 'NA' end as repeat_family, l_linenumber + 0.5::double as divergence, 0.1::double as deletion, 2.0::double as insertion,
           cast(l_quantity as bigint) + 1 as length
    from lineitem where l_linenumber <> 3
""")
def parse_repeatmasker(t: Source) -> DataFrame:
    n = F.col("l_linenumber")
    begin = F.when(n == 3, "1e3").otherwise(text("l_partkey"))
    line = F.concat_ws(
        "  ", F.lit("  100"), F.concat(n.cast("string"), F.lit(".5")), F.lit("0.1"), F.lit("2"), F.concat(F.lit("chr"), (F.col("l_suppkey") % 5).cast("string")), begin,
        (F.col("l_partkey") + _quantity()).cast("string"), F.lit("(9)"), F.when(F.col("l_returnflag") == "A", "C").otherwise("+"), F.concat(F.lit("rep"), n.cast("string")),
        F.when(n % 2 == 0, "LINE/L1/x").otherwise("Simple_repeat"))
    return reports.read_repeatmasker(t.spark, written_lines(t.lineitem, line, F.col("l_orderkey"))).drop("line", "c", "_row")


@query("""
    select 'chr' || (c_custkey % 5) as seqid, case when c_nationkey < 5 then 'mRNA' else 'gene' end as type, c_custkey as start, c_custkey + 9 as "end",
           case when c_nationkey % 2 = 0 then 'g' || c_custkey end as id, case when c_nationkey < 5 then 'a;b' else '' end as parents, 'second' as note,
           'x y' as product, c_custkey - (select min(c_custkey) from customer) + 1 as line_number from customer
""")
def parse_gff(t: Source) -> DataFrame:
    """Both attribute spellings, a repeated key, several parents and an absent id."""
    key = text("c_custkey")
    few = F.col("c_nationkey") < 5
    attributes = F.concat_ws(
        ";", F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("ID=g"), key)), F.when(few, F.lit("Parent=a,b")), F.lit("Note=first"), F.lit('product "x y"'), F.lit("Note=second"))
    line = _tabs(F.concat(F.lit("chr"), (F.col("c_custkey") % 5).cast("string")), "s", F.when(few, "mRNA").otherwise("gene"), key, (F.col("c_custkey") + 9), ".", "+", ".", attributes)
    found = gff.read_gff(t.spark, written_lines(t.customer, line, F.col("c_custkey")))
    value = lambda k: F.try_element_at("attrs", F.lit(k))
    return found.select(
        "seqid", "type", "start", "end", "id", F.array_join("parents", ";").alias("parents"), value("Note").alias("note"), value("product").alias("product"), "line_number")


@query("""
    select 'set' as region_set, coalesce(case when c_nationkey >= 5 then 'r' || c_custkey end, 'reg_' || (c_custkey - (select min(c_custkey) from customer) + 1)) as region_id,
           'chr' || c_nationkey as seqid, c_custkey as start0, c_custkey + c_nationkey as end0, case when c_nationkey >= 5 then '7' end as score,
           case when c_nationkey >= 5 then '-' else '+' end as strand from customer where c_nationkey > 0
""")
def parse_bed(t: Source) -> DataFrame:
    """Unnamed regions are called after their line; regions without length are left out."""
    first = _tabs(F.concat(F.lit("chr"), text("c_nationkey")), F.col("c_custkey"), F.col("c_custkey") + F.col("c_nationkey"))
    line = F.when(F.col("c_nationkey") >= 5, F.concat_ws("\t", first, F.concat(F.lit("r"), text("c_custkey")), F.lit("7"), F.lit("-"))).otherwise(first)
    return gff.read_bed(t.spark, written_lines(t.customer, line, F.col("c_custkey")), "reg", "set")


@query("""
    with last_lines as (select c_custkey % 20 as g, max(c_custkey) as k from customer group by 1),
    rows as (select 'OG' || g as family_id, k, c_mktsegment as m from last_lines join customer on c_custkey = k)
    select family_id, 'g' || k as gene_id, m as source from rows union all select family_id, 'a--b' || k, 'c' from rows union all select family_id, 'plain', 'NA' from rows
""")
def parse_orthogroup_text(t: Source) -> DataFrame:
    """Colon, tab and blank forms; the last line of a repeated group counts."""
    key, group = text("c_custkey"), F.concat(F.lit("OG"), (F.col("c_custkey") % 20).cast("string"))
    one, two = F.concat(F.lit("g"), key, F.lit("--"), "c_mktsegment"), F.concat(F.lit("a--b"), key, F.lit("--c"))
    form = F.col("c_custkey") % 3
    line = F.when(form == 0, F.concat(group, F.lit(": "), one, F.lit(" "), two, F.lit(" plain"))).when(form == 1, F.concat(group, F.lit("\t"), one, F.lit(", "), two, F.lit("\tplain"))).otherwise(
        F.concat(group, F.lit("  "), one, F.lit(" "), two, F.lit(" plain ")))
    return reports.read_orthogroup_text(t.spark, written_lines(t.customer, line, F.col("c_custkey")))


@query("select distinct p_brand as gene_id from part where p_size >= 5")
def parse_ids(t: Source) -> DataFrame:
    line = F.concat(F.when(F.col("p_size") < 5, "#").otherwise(" "), "p_brand", F.lit(" \t more words"))
    return read_ids(t.spark, written_lines(t.part, line, F.col("p_partkey")))


@query("""
    select 'chr' || c_nationkey || ':' || c_custkey || '-' || (c_custkey + 10) || '|Class_I/x' as domain_id, 'chr' || c_nationkey as seqid, c_custkey as start, c_custkey + 10 as "end",
           '-' as strand, 'Class_I/LTR-Gypsy' as class_path, 'Class_I' as class_level_1, 'LTR' as class_level_2, 'Gypsy' as class_level_3,
           case c_custkey % 3 when 0 then 'RVT_1' when 1 then 'DDE_2' else 'GAG' end as domain_gene, case c_custkey % 3 when 0 then 'RT' when 1 then 'TPase' else 'GAG' end as domain_type,
           'chr' || c_nationkey || ':' || c_custkey || '-' || (c_custkey + 10) || '|Class_I/x Classification=LTR-Gypsy;gene=' || case c_custkey % 3 when 0 then 'RVT_1' when 1 then 'DDE_2' else 'GAG' end
             || ';strand=-' as source_header from customer
""")
def te_domains(t: Source) -> DataFrame:
    key = F.col("c_custkey")
    gene = F.when(key % 3 == 0, "RVT_1").when(key % 3 == 1, "DDE_2").otherwise("GAG")
    header = F.concat(F.lit("chr"), text("c_nationkey"), F.lit(":"), text("c_custkey"), F.lit("-"), (key + 10).cast("string"), F.lit("|Class_I/x Classification=LTR-Gypsy;gene="), gene, F.lit(";strand=-"))
    return reports.te_domains(t.customer.select(header.alias("header")))
