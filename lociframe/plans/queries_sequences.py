"""Sequence queries over the DNA recoded from the documents' whole texts."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sequence import cds_checks, reverse_complement, translate_codons
from ..operators import coverage, sequences
from .catalogue import Source, query, rounded

BASES = "length(seq) - length(replace(replace(seq, 'G', ''), 'C', ''))"


@query(f"""
    with s as (select seqid, length(seq) as n, {BASES} as gc, length(seq) - length(replace(seq, 'N', '')) as ns from {{dna}} d),
    acc as (select n, sum(n) over (order by n desc, seqid) as acc, row_number() over (order by n desc, seqid) as rk, sum(n) over () as total from s)
    select count(*) as seq_count, cast(sum(n) as bigint) as total_length, cast(min(n) as bigint) as min_length, cast(max(n) as bigint) as max_length,
           (select cast(max(n) as bigint) from acc where acc >= total * 0.5) as "N50", (select min(rk) from acc where acc >= total * 0.5) as "L50",
           (select cast(max(n) as bigint) from acc where acc >= total * 0.9) as "N90", (select min(rk) from acc where acc >= total * 0.9) as "L90",
           cast(sum(gc) as bigint) as "GC_count", round(sum(gc) / sum(n) * 100, 6) as "GC_percent", cast(sum(ns) as bigint) as "N_count",
           round(sum(ns) / sum(n) * 100, 6) as "N_percent"
    from s
""")
def assembly_stats(t: Source) -> DataFrame:
    return rounded(sequences.assembly_stats(t.dna), "GC_percent", "N_percent")


@query(f"""
    with s as (select lang, seqid, length(seq) as n, {BASES} as gc, length(seq) - length(replace(seq, 'N', '')) as ns from {{dna}} d join documents on doc_id = seqid),
    acc as (select lang, n, gc, ns, sum(n) over (partition by lang order by n desc, seqid) as acc, row_number() over (partition by lang order by n desc, seqid) as rk,
                   sum(n) over (partition by lang) as total from s)
    select lang, count(*) as seq_count, cast(sum(n) as bigint) as total_length, cast(min(n) as bigint) as min_length, cast(max(n) as bigint) as max_length,
           cast(max(n) filter (where acc >= total * 0.5) as bigint) as "N50", min(rk) filter (where acc >= total * 0.5) as "L50",
           cast(max(n) filter (where acc >= total * 0.9) as bigint) as "N90", min(rk) filter (where acc >= total * 0.9) as "L90",
           cast(sum(gc) as bigint) as "GC_count", round(sum(gc) / sum(n) * 100, 6) as "GC_percent", cast(sum(ns) as bigint) as "N_count", round(sum(ns) / sum(n) * 100, 6) as "N_percent" from acc group by lang
""")
def assembly_stats_by_group(t: Source) -> DataFrame:
    rows = t.dna.join(t.documents.select(F.col("doc_id").alias("seqid"), "lang"), "seqid")
    return rounded(sequences.assembly_stats(rows, ["lang"]), "GC_percent", "N_percent")


@query(f"select seqid, cast(length(seq) as bigint) as length, cast({BASES} as bigint) as gc, cast(length(seq) - length(replace(seq, 'N', '')) as bigint) as n from {{dna}} d")
def sequence_composition(t: Source) -> DataFrame:
    return sequences.sequence_composition(t.dna)


WINDOWS = f"""
    with w as (select seqid, unnest(range(0, length(seq), 100)) as start, seq as whole from {{dna}} d),
    cut as (select seqid, start, substring(whole, start + 1, 100) as seq from w),
    gc as (select seqid, start, start + length(seq) as "end", ({BASES}) / length(seq) as gc from cut)
"""


@query(WINDOWS + 'select seqid, start, "end", round(gc, 6) as gc from gc')
def gc_windows(t: Source) -> DataFrame:
    return rounded(sequences.gc_windows(t.dna, 100), "gc")


@query(WINDOWS + """,
    depth as (select doc as seqid, pos // 100 * 100 as start0, sum(q) as total from (
        select l_orderkey % (select max(doc_id) + 1 from documents) as doc, l_partkey as pos, cast(l_quantity as bigint) as q from lineitem) group by all)
    select gc.seqid, gc.start as start0, gc."end" as end0, round(coalesce(total, 0) / (gc."end" - gc.start), 6) as mean_depth, round(gc.gc, 6) as gc
    from gc left join depth on depth.seqid = gc.seqid and depth.start0 = gc.start
""")
def gc_depth(t: Source) -> DataFrame:
    dna = t.dna
    last = t.documents.agg((F.max("doc_id") + 1).alias("n"))
    depth = t.lineitem.select((F.col("l_orderkey") % last.scalar()).alias("seqid"), F.col("l_partkey").alias("pos0"), F.col("l_quantity").cast("bigint").alias("depth"))
    tiles = coverage.tile_depth(dna.select("seqid", F.length("seq").cast("bigint").alias("length")), depth, 100)
    gc = sequences.gc_windows(dna, 100).withColumnRenamed("start", "start0")
    return rounded(coverage.gc_depth(tiles, gc), "mean_depth", "gc")


KMERS = """
    with k as (select substring(seq, i, 21) as f from (select seq, unnest(range(1, length(seq) - 19)) as i from {dna} d where length(seq) >= 21)),
    c as (select least(f, reverse(translate(f, 'ACGT', 'TGCA'))) as kmer from k),
    counts as (select kmer, count(*) as n from c group by kmer)
"""


@query(KMERS + "select n as multiplicity, count(*) as kmers from counts group by n")
def kmer_histogram(t: Source) -> DataFrame:
    return sequences.kmer_histogram(sequences.kmer_counts(t.dna, 21)).withColumn("multiplicity", F.col("multiplicity").cast("bigint"))


@query(KMERS + "select kmer, n as count from counts where n between 40 and 60")
def kmers_between(t: Source) -> DataFrame:
    return sequences.kmers_between(sequences.kmer_counts(t.dna, 21), 40, 60)


@query("select seqid, upper(seq) as seq from (select doc_id as seqid, lower(regexp_replace(text, '[^A-Za-z]', '', 'g')) as seq from documents)")
def upper_sequences(t: Source) -> DataFrame:
    return sequences.upper_sequences(t.documents.select(F.col("doc_id").alias("seqid"), F.lower(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq")))


@query("""
    with spans as (select l_orderkey % (select max(doc_id) + 1 from documents) as seqid, l_partkey as start0, l_partkey + cast(l_quantity as bigint) as end0 from lineitem),
    long as (select seqid, unnest(range(0, length(seq))) as i, seq from {dna} d),
    hit as (select distinct seqid, unnest(range(start0, end0)) as i from spans),
    bases as (select l.seqid, l.i, case when h.i is null then seq[l.i + 1] else lower(seq[l.i + 1]) end as b
              from long l left join hit h on h.seqid = l.seqid and h.i = l.i)
    select d.seqid, coalesce(m.seq, '') as seq from {dna} d left join (select seqid, string_agg(b, '' order by i) as seq from bases group by seqid) m on m.seqid = d.seqid
""")
def soft_mask(t: Source) -> DataFrame:
    last = t.documents.agg((F.max("doc_id") + 1).alias("n"))
    spans = t.lineitem.select(
        (F.col("l_orderkey") % last.scalar()).alias("seqid"), F.col("l_partkey").alias("start0"), (F.col("l_partkey") + F.col("l_quantity").cast("bigint")).alias("end0"))
    return sequences.rebuild_sequences(sequences.soft_mask(t.dna, spans, 4096))


@query("select 'sp|' || seqid as prefixed_id, seqid as original_id, 'sp' as prefix, seq from {dna} d")
def prefix_ids(t: Source) -> DataFrame:
    return sequences.prefix_ids(t.dna, "sp")


CODONS = "['" + "', '".join(a + b + c for a in "ACGT" for b in "ACGT" for c in "ACGT") + "']"
AMINO = "KNKNTTTTRSRSIIMIQHQHPPPPRRRRLLLLEDEDAAAAGGGGVVVV*Y*YSSSS*CWCLFLF"
PEPTIDES = f"""
    with cod as (select seqid, seq, unnest(range(0, length(seq) // 3)) as i from {{dna}} d),
    aa as (select seqid, i, substring('{AMINO}', list_position({CODONS}, substring(seq, i * 3 + 1, 3)), 1) as a from cod),
    pep as (select seqid, string_agg(a, '' order by i) as pep from aa group by seqid),
    both_p as (select d.seqid, d.seq, coalesce(p.pep, '') as pep from {{dna}} d left join pep p using (seqid))
"""


@query(PEPTIDES + """
    select seqid, pep, cast(length(seq) as bigint) as cds_len, (length(seq) % 3 = 0)::int as phase_ok, (substring(seq, 1, 3) = 'ATG')::int as start_ok,
           (pep like '%*')::int as terminal_stop, cast(length(pep[:-2]) - length(replace(pep[:-2], '*', '')) as bigint) as internal_stop, 0::bigint as ambiguous_nt
    from both_p
""")
def translate_sequences(t: Source) -> DataFrame:
    peptides = t.dna.select("seqid", "seq", translate_codons(F.col("seq")).alias("pep"))
    return peptides.select("seqid", "pep", *[c.alias(n) for n, c in cds_checks(F.col("seq"), F.col("pep")).items()])


@query(PEPTIDES + """
    select seqid as id, length(pep) as old_len, length(case when pep like '%*' then pep[:-2] else pep end) as new_len, (pep like '%*')::int as terminal_stop_removed,
           length((case when pep like '%*' then pep[:-2] else pep end)[:-2]) - length(replace((case when pep like '%*' then pep[:-2] else pep end)[:-2], '*', '')) as internal_stop,
           case when length(case when pep like '%*' then pep[:-2] else pep end) = 0 then 'dropped_empty' else 'kept' end as status, case when pep like '%*' then pep[:-2] else pep end as seq
    from both_p
""")
def clean_peptides(t: Source) -> DataFrame:
    peptides = t.dna.select("seqid", translate_codons(F.col("seq")).alias("seq"))
    return sequences.clean_peptides(peptides)


@query("select seqid, reverse(translate(seq, 'ACGT', 'TGCA')) as seq from {dna} d")
def reverse_complements(t: Source) -> DataFrame:
    return t.dna.select("seqid", reverse_complement(F.col("seq")).alias("seq"))


ALIGNED = """
    with a as (select p_brand as gene, p_type as species, min(p_size) as v from part group by all),
    aln as (select gene, species, repeat(case when v % 4 = 0 then '-' else 'A' end, 5 + cast(substring(gene, 7) as int)) as seq from a)
"""


def _alignment(t: Source) -> DataFrame:
    v = t.part.groupBy(F.col("p_brand").alias("gene"), F.col("p_type").alias("species")).agg(F.min("p_size").alias("v"))
    seq = F.repeat(F.when(F.col("v") % 4 == 0, "-").otherwise("A"), F.lit(5) + F.substring("gene", 7, 10).cast("int"))
    return v.select("gene", "species", seq.alias("seq"))


@query(ALIGNED + """,
    lengths as (select gene, max(length(seq)) as n from aln group by gene), sp as (select distinct p_type || case when p_size > 45 then '' else '' end as species from part)
    select s.species, count(a.gene) as present_genes, (select count(*) from lengths) - count(a.gene) as missing_genes,
           (select cast(sum(n) as bigint) from lengths) as sequence_length
    from sp s left join aln a using (species) group by s.species
""")
def supermatrix_stats(t: Source) -> DataFrame:
    return sequences.supermatrix(_alignment(t), t.part.select(F.col("p_type").alias("species")))["stats"]


@query(ALIGNED + """,
    lengths as (select gene, max(length(seq)) as n from aln group by gene)
    select gene, cast(coalesce(sum(n) over (order by gene rows between unbounded preceding and 1 preceding), 0) + 1 as bigint) as start,
           cast(sum(n) over (order by gene) as bigint) as "end" from lengths
""")
def supermatrix_partitions(t: Source) -> DataFrame:
    return sequences.supermatrix(_alignment(t), t.part.select(F.col("p_type").alias("species")))["partitions"]


@query(ALIGNED + """,
    lengths as (select gene, max(length(seq)) as n from aln group by gene), sp as (select distinct p_type as species from part)
    select s.species as seqid, string_agg(coalesce(a.seq, repeat('-', l.n)), '' order by l.gene) as seq
    from sp s cross join lengths l left join aln a on a.species = s.species and a.gene = l.gene group by s.species
""")
def supermatrix(t: Source) -> DataFrame:
    return sequences.supermatrix_rows(sequences.supermatrix(_alignment(t), t.part.select(F.col("p_type").alias("species"))))


@query("""
    with b as (select source as alignment, lang || '/' || doc_id as species, doc_id, unnest(range(1, length(text) + 1)) as pos, text from documents),
    ch as (select alignment, species, pos, text[pos] as c from b),
    n as (select source as alignment, count(*) as n from documents group by source),
    g as (select alignment, pos from (select alignment, pos, count(*) as gaps from ch where c = ' ' group by all) join n using (alignment) where gaps / n * 100 >= 20),
    kept as (select alignment, species, string_agg(replace(c, ' ', '-'), '' order by pos) as seq from ch anti join g using (alignment, pos) group by alignment, species)
    select d.source as alignment, d.lang || '/' || d.doc_id as species, coalesce(k.seq, '') as seq
    from documents d left join kept k on k.alignment = d.source and k.species = d.lang || '/' || d.doc_id
""")
def trim_alignment_columns(t: Source) -> DataFrame:
    rows = t.documents.select(
        F.col("source").alias("alignment"), F.concat_ws("/", "lang", F.col("doc_id").cast("string")).alias("species"),
        F.regexp_replace(F.replace("text", F.lit("-"), F.lit("‐")), " ", "-").alias("seq"))
    trimmed = sequences.trim_alignment_columns(rows, 20.0)
    return trimmed.withColumn("seq", F.replace("seq", F.lit("‐"), F.lit("-")))


@query("""
    with r as (select o_orderkey as name, o_orderkey % 40 as a, o_orderkey % 13 as b, o_orderkey % 80 as m from orders)
    select name, repeat('A', cast(45 + m as int)) as seq, repeat(chr(cast(33 + a as int)), 45) || repeat(chr(cast(33 + b as int)), cast(m as int)) as qual
    from r where 45 + m >= 50 and (case when a < 15 then 45 else 0 end + m) * 100 / (45 + m) <= 40 and (45 * a + m * b) / (45 + m) >= 20
""")
def quality_reads(t: Source) -> DataFrame:
    key = F.col("o_orderkey")
    run = lambda code, n: F.repeat(F.char(code + 33), n)
    reads = t.orders.select(
        key.alias("name"), F.repeat(F.lit("A"), (key % 80 + 45).cast("int")).alias("seq"), F.concat(run(key % 40, F.lit(45)), run(key % 13, (key % 80).cast("int"))).alias("qual"))
    return sequences.quality_reads(reads)
