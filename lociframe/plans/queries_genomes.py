"""Genome files: sequences in pieces over file splits, and gene models spliced from them."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import pieces
from ..operators import genes, sequences
from ..sources import fasta, gff, sinks
from .catalogue import Source, query, rounded, text
from .queries_sequences import AMINO, CODONS, KMERS, WINDOWS


def genome_lines(t: Source, width: int = 60, lines_a_split: int = 7) -> DataFrame:
    """The recoded documents as lines of four FASTA files whose splits end every few lines, mostly inside a record."""
    header = F.concat(F.lit(">"), text("seqid"), F.lit(" recoded text"))
    rows = t.dna.select("seqid", F.posexplode(F.concat(F.array(header), pieces(F.col("seq"), width))).alias("_i", "line"))
    number = F.col("seqid") * 1_000_000 + F.col("_i")
    path = F.concat(F.lit("genome"), (F.col("seqid") % 4).cast("string"))
    place = F.struct(path.alias("path"), F.floor(number / lines_a_split).cast("bigint").alias("block"), number.cast("bigint").alias("line"))
    return rows.select(path.alias("path"), "line", place.alias("_row"))


def genome(t: Source) -> DataFrame:
    return fasta.read_fasta_pieces(t.spark, genome_lines(t))


@query("""
    select 'genome' || (seqid % 4) as path, cast(seqid as varchar) as seqid, seqid || ' recoded text' as header, cast(length(seq) as bigint) as length, md5(seq) as seq_md5 from {dna} d
""")
def fasta_records(t: Source) -> DataFrame:
    """Every record once, whole, although its lines lie in many splits."""
    whole = genome(t).groupBy("path", "seqid", "header").agg(F.array_sort(F.collect_list(F.struct("start0", "seq"))).alias("p"))
    joined = F.array_join(F.transform("p", lambda p: p["seq"]), "")
    return whole.select("path", "seqid", "header", F.length(joined).cast("bigint").alias("length"), F.md5(joined).alias("seq_md5"))


@query(WINDOWS + 'select cast(seqid as varchar) as seqid, start, "end", round(gc, 6) as gc from gc')
def fasta_gc_windows(t: Source) -> DataFrame:
    return rounded(sequences.gc_windows(genome(t), 100), "gc")


@query(KMERS + "select n as multiplicity, count(*) as kmers from counts group by n")
def fasta_kmer_histogram(t: Source) -> DataFrame:
    return sequences.kmer_histogram(sequences.kmer_counts(genome(t), 21)).withColumn("multiplicity", F.col("multiplicity").cast("bigint"))


MODELS = f"""
    with d as (select cast(seqid as varchar) as seqid, seq from {{dna}} dna), n as (select max(doc_id) + 1 as n from documents),
    gene_lines as (select c_custkey as num, 'g' || c_custkey as gene,
                          concat_ws(chr(9), c_custkey % n, 'src', 'gene', 1, c_custkey % 1000 + 1, '.', '+', '.', 'ID=g' || c_custkey) as line from customer, n),
    tx as (select 1000000000 + o_orderkey as num, o_orderkey, o_orderkey || case when o_orderkey % 3 = 0 then '.t1' else '.t2' end as transcript_id, case when o_custkey % 10 <> 0 then 'g' || o_custkey end as gene,
                  cast(o_orderkey % n as varchar) as seqid, case when o_custkey % 2 = 0 then '-' else '+' end as strand, o_orderkey % 900 + 100 as "end" from orders, n),
    chosen as (select * exclude rn from (select *, row_number() over (partition by gene order by transcript_id not like '%.t1', transcript_id) as rn from tx where gene is not null) where rn = 1
               union all select * from tx where gene is null and transcript_id like '%.t1'),
    parts as (select (l_orderkey * 8 + l_linenumber) * 1000000000 + l_partkey * 10000 + l_suppkey as num, l_orderkey as o_orderkey, (l_linenumber - 1) * 60 + l_suppkey % 7 + 1 as s, cast(l_quantity as bigint) as q from lineitem),
    spliced as (select c.*, string_agg(substring(d.seq, p.s, p.q), '' order by p.s, p.num) as forward from chosen c join parts p using (o_orderkey) join d using (seqid) group by all),
    cds as (select *, case when strand = '-' then reverse(translate(forward, 'ACGT', 'TGCA')) else forward end as cds from spliced where forward <> ''),
    aa as (select transcript_id, i, substring('{AMINO}', list_position({CODONS}, substring(cds, i * 3 + 1, 3)), 1) as a from (select *, unnest(range(0, length(cds) // 3)) as i from cds)),
    peps as (select transcript_id, string_agg(a, '' order by i) as pep from aa group by transcript_id),
    raw as (select c.transcript_id, c.num, c.gene, c.seqid, c.o_orderkey, c.strand, c."end", c.cds, coalesce(p.pep, '') as pep from cds c left join peps p using (transcript_id)),
    checked as (select *, cast(length(cds) as bigint) as cds_len, (length(cds) % 3 = 0)::int as phase_ok, (substring(cds, 1, 3) = 'ATG')::int as start_ok, (pep like '%*')::int as terminal_stop,
                       cast(length(pep[:-2]) - length(replace(pep[:-2], '*', '')) as bigint) as internal_stop, 0::bigint as ambiguous_nt from raw),
    final as (select * from checked where phase_ok = 1 and internal_stop = 0),
    kept as (select f.num, 0 as k, g.line from (select min(num) as num, gene from final where gene is not null group by gene) f join gene_lines g using (gene)
             union all select num, 1, concat_ws(chr(9), seqid, 'src', 'mRNA', 1, "end", '.', strand, '.', 'ID=' || transcript_id || coalesce(';Parent=' || gene, '')) from final
             union all select p.num, 1, concat_ws(chr(9), f.seqid, 'src', 'CDS', p.s, p.s + p.q - 1, '.', f.strand, '0', 'Parent=' || f.transcript_id) from final f join parts p using (o_orderkey))
"""


def annotation(t: Source) -> DataFrame:
    """Genes from customers, transcripts from orders and their coding parts from line items, as annotation lines on the recoded documents."""
    last = t.documents.agg((F.max("doc_id") + 1).alias("n")).scalar()
    on = lambda key: (F.col(key) % last).cast("string")
    name = lambda key: F.concat(text(key), F.when(F.col(key) % 3 == 0, ".t1").otherwise(".t2"))

    def lines(df: DataFrame, number: Column, *cells: Column | str) -> DataFrame:
        line = F.concat_ws("\t", *[F.lit(c) if isinstance(c, str) else c.cast("string") for c in cells])
        return df.select(number.cast("bigint").alias("number"), line.alias("line"))

    whole = lines(t.customer, F.col("c_custkey"), on("c_custkey"), "src", "gene", "1", F.col("c_custkey") % 1000 + 1, ".", "+", ".", F.concat(F.lit("ID=g"), text("c_custkey")))
    strand = F.when(F.col("o_custkey") % 2 == 0, "-").otherwise("+")
    parent = F.when(F.col("o_custkey") % 10 != 0, F.concat(F.lit(";Parent=g"), text("o_custkey"))).otherwise("")
    transcripts = lines(t.orders, F.col("o_orderkey") + 1_000_000_000, on("o_orderkey"), "src", "mRNA", "1", F.col("o_orderkey") % 900 + 100, ".", strand, ".",
                        F.concat(F.lit("ID="), name("o_orderkey"), parent))
    parts = t.lineitem.join(t.orders.select("o_orderkey", strand.alias("strand")), F.col("l_orderkey") == F.col("o_orderkey"))
    start = (F.col("l_linenumber") - 1) * 60 + F.col("l_suppkey") % 7 + 1
    number = (F.col("l_orderkey") * 8 + F.col("l_linenumber")) * 1_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")
    coding = lines(parts, number, on("l_orderkey"), "src", "CDS", start, start + F.col("l_quantity").cast("bigint") - 1, ".", F.col("strand"), "0",
                   F.concat(F.lit("Parent="), name("l_orderkey")))
    place = F.struct(F.lit("f").alias("path"), F.lit(0).cast("bigint").alias("block"), F.col("number").alias("line"))
    written = whole.unionByName(transcripts).unionByName(coding).select(F.lit("f").alias("path"), "line", place.alias("_row"))
    return gff.read_gff(t.spark, written, "sp")


def models(t: Source, keep: bool = True) -> dict[str, DataFrame]:
    return genes.gene_models(annotation(t), genome(t).withColumn("species", F.lit("sp")), keep=keep)


@query(MODELS + """
    select 'sp' as species, transcript_id, seqid, 1::bigint as start, cast("end" as bigint) as "end", cds, pep, cds_len, phase_ok, start_ok, terminal_stop, internal_stop, ambiguous_nt from checked
""")
def gene_models(t: Source) -> DataFrame:
    """Coding sequence, peptide and checks of the primary transcripts, spliced from pieces of the genome."""
    return models(t, keep=False)["raw"]


@query(MODELS + "select 'sp' as species, line, row_number() over (order by num, k, line) as row_number from kept")
def gene_model_lines(t: Source) -> DataFrame:
    """The annotation subset of the models that pass, numbered in the order in which a sink writes it."""
    return sinks.numbered(models(t)["gff"], ["_order", "line"]).drop("_order")


@query(MODELS + """
    select 'sp' as species, (select count(*) from chosen) as transcripts_selected, (select count(*) from checked) as raw_cds_written, (select count(*) from final) as cds_written,
           (select count(*) from kept) as gff_features, (select count(*) from checked) - (select count(*) from final) as filtered_bad_cds
""")
def gene_model_summary(t: Source) -> DataFrame:
    return models(t)["summary"]
