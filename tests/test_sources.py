import glob
import gzip
import random

import pytest
from conftest import rows
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from lociframe.functions.text import general_format, split_terms, to_long
from lociframe.operators import coverage, hits, regions, sequences, terms
from lociframe.sources import fasta, gff, lines, reports, sinks


def test_lenient_numbers_and_terms(spark):
    df = spark.createDataFrame([("1e3",), ("7.9",), ("x",), ("",), (None,), ("nan",)], "v string")
    assert [r[0] for r in df.select(to_long(F.col("v"))).collect()] == [1000, 7, None, None, None, None]
    cell = spark.createDataFrame([("b; a,NA|ko:K21 ; x1;x2;x3",)], "v string")
    assert cell.select(split_terms(F.col("v"), strip="ko:")).collect()[0][0] == ["K21", "a", "b", "x1", "x2", "x3"]
    assert spark.createDataFrame([(0.5,), (1e-20,), (None,)], "v double").select(general_format("v")).collect()[1][0] == "1e-20"


def test_fasta(spark, put):
    path = put("a.fa", ">s1 first gene=x\nACg\nt n\n\n>s2\nNN\n>a->b desc\nGG\n")
    df = fasta.read_fasta(spark, path, upper=True)
    assert rows(df, "seqid", "header", "seq", "length") == [("a->b", "a->b desc", "GG", 2), ("s1", "s1 first gene=x", "ACGTN", 5), ("s2", "s2", "NN", 2)]
    twice = put("b.fa", ">s\nA\n>s\nC\n")
    with pytest.raises(SparkRuntimeException, match="repeated sequence id: s"):
        fasta.read_fasta(spark, twice).count()
    assert rows(fasta.read_fasta(spark, twice, "last"), "seq") == [("C",)]
    assert fasta.read_fasta(spark, twice, "keep").count() == 2
    headless = put("c.fa", "ACGT\n>s\nA\n")
    with pytest.raises(SparkRuntimeException, match="before the first header"):
        fasta.read_fasta(spark, headless).count()
    with pytest.raises(SparkRuntimeException, match="before the first header"):
        fasta.read_fasta_pieces(spark, headless).count()
    with pytest.raises(SparkRuntimeException, match="repeated sequence id: s"):
        fasta.read_fasta_pieces(spark, twice).count()
    assert rows(fasta.read_fasta_pieces(spark, twice, "last"), "seq", "start0") == [("C", 0)]
    assert rows(fasta.read_fasta_pieces(spark, headless, "keep"), "seqid", "seq") == [("s", "A")]


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def whole(pieces):
    """Sequences by (path, record) from pieces that must cover them once."""
    held = {}
    for r in sorted(pieces.collect(), key=lambda r: r.start0):
        name, seq = held.get((r.path, r.record), (r.seqid, ""))
        assert r.start0 == len(seq) and name == r.seqid
        held[r.path, r.record] = (name, seq + r.seq)
    return sorted(held.values())


@pytest.mark.parametrize("size", [64, 1000])
def test_fasta_pieces_over_many_splits(spark, small_splits, put, size):
    r = random.Random(3)
    records = [(f"r{i}", "".join(r.choice("ACGTNacgt") for _ in range(r.choice([0, 5, 60, 600, 5000])))) for i in range(40)]
    for i in range(2):
        put(f"pieces/f{i}.fa", "".join(f">{n} file {i}\n" + "".join(s[k : k + 60] + "\n" for k in range(0, len(s), 60)) + "\n" * (len(s) % 2) for n, s in records[i::2]))
    folder = put("pieces/f0.fa.note", "").rsplit("/", 1)[0]
    paths = [f"{folder}/f0.fa", f"{folder}/f1.fa"]
    pieces = fasta.read_fasta_pieces(spark, paths, size=size)
    assert pieces.rdd.getNumPartitions() > 20 and max(len(p.seq) for p in pieces.select("seq").collect()) <= size
    assert whole(pieces) == sorted(records)
    as_lines = lines.read_lines(spark, paths).repartition(5)
    assert whole(fasta.read_fasta_pieces(spark, as_lines, size=size)) == sorted(records)
    assert whole(fasta.read_fasta_pieces(spark, paths, "keep", upper=True, size=size)) == sorted((n, s.upper()) for n, s in records)
    if size == 1000:
        compare(pieces, spark.createDataFrame([(n, s) for n, s in records if s], "seqid string, seq string"))


def compare(pieces, plain):
    """Operators give the same on pieces as on whole sequences."""
    for options in ({}, {"compat": True}):
        some = sequences.gc_windows(pieces, 100, **options).filter("start > 0 or end > 0")
        assert rows(some) == rows(sequences.gc_windows(plain, 100, **options))
    assert rows(sequences.kmer_counts(pieces, 9)) == rows(sequences.kmer_counts(plain, 9))
    assert rows(sequences.sequence_composition(pieces).filter("length > 0")) == rows(sequences.sequence_composition(plain))
    assert rows(sequences.assembly_stats(pieces).select("N50", "L50", "total_length")) == rows(sequences.assembly_stats(plain).select("N50", "L50", "total_length"))
    masks = plain.select("seqid", F.lit(3).cast("bigint").alias("start0"), F.lit(777).cast("bigint").alias("end0"))
    masked = sequences.rebuild_sequences(sequences.soft_mask(pieces, masks, 50)).filter("seq <> ''")
    assert rows(masked) == rows(sequences.rebuild_sequences(sequences.soft_mask(plain, masks, 50)))


def test_one_long_record_never_stands_in_one_row(spark, tmp_path):
    path = tmp_path / "long.fa"
    unit = "ACGTTGCAAC" * 6 + "\n"
    with open(path, "w") as f:
        f.write(">long one\n")
        for _ in range(170):
            f.write(unit * 10_000)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(8 << 20))
    try:
        pieces = fasta.read_fasta_pieces(spark, str(path))
        longest, total, n = pieces.select(F.max(F.length("seq")), F.sum(F.length("seq")), F.count("seq")).first()
        assert longest == fasta.PIECE and total == 102_000_000 and n > 1500
        windows = sequences.gc_windows(pieces).agg(F.count("gc"), F.min("gc"), F.max("gc"), F.max("end")).first()
        assert windows == (20_400, 0.5, 0.5, 102_000_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_fasta_pieces_of_an_empty_file(spark, put):
    assert fasta.read_fasta_pieces(spark, put("none.fa", "\n\n")).count() == 0


def test_fasta_over_many_splits(spark, put):
    text = "".join(f">r{i} x>y\n{'ACGT' * (i % 9 + 1)}\n{'G' * (i % 5)}\n" for i in range(400))
    path = put("many.fa", text)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        df = fasta.read_fasta(spark, path)
        assert df.rdd.getNumPartitions() > 5
        assert {(r.seqid, r.length) for r in df.collect()} == {(f"r{i}", 4 * (i % 9 + 1) + i % 5) for i in range(400)}
        numbered = lines.with_line_numbers(lines.read_lines(spark, path))
        got = {r.line_number: r.line for r in numbered.collect()}
        assert got == {i: x for i, x in enumerate(text.split("\n")[:-1], 1)}
        reads = fasta.read_fastq(spark, put("r.fq", "".join(f"@q{i} d\nACGT{'A' * (i % 7)}\n+\nIIII{'!' * (i % 7)}\n" for i in range(200))))
        assert {(r.name, r.seq, len(r.qual)) for r in reads.collect()} == {(f"q{i} d", "ACGT" + "A" * (i % 7), 4 + i % 7) for i in range(200)}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_gzip_and_crlf_ids(spark, tmp_path):
    path = tmp_path / "ids.txt.gz"
    with gzip.open(path, "wt") as f:
        f.write("# note\r\ng1 extra\r\n\r\ng2\r\ng1\r\n")
    assert rows(lines.read_ids(spark, str(path))) == [("g1",), ("g2",)]


def test_header_table_and_sink(spark, put, tmp_path):
    df = lines.read_table(spark, put("t.tsv", 'a\tb\tc\r\n1\tNA\t"x ""y"""\r\n\t2\tz\r\n'), ordered=True)
    assert rows(df, "a", "b", "c") == [(None, "2", "z"), ("1", None, 'x "y"')]
    out = str(tmp_path / "out")
    sinks.write_table(df, out, ["a", "b", "missing"])
    text = "".join(p.read_text() for p in (tmp_path / "out").glob("part-*"))
    assert set(text.splitlines()) == {"a\tb\tmissing", "1\tNA\tNA", "NA\t2\tNA"}


def test_bed(spark, put):
    path = put("r.bed", "# c\nchr1\t1e1\t20\tr1\t5\t-\nchr1\t30\t40\nchr1\t9\t9\tbad\nchr1\tx\t9\nchr1\t5\n")
    df = gff.read_bed(spark, path, "target")
    assert rows(df, "region_id", "start0", "end0", "strand") == [("r1", 10, 20, "-"), ("target_3", 30, 40, "+")]


def test_gff_attributes(spark, put):
    path = put("a.gff", '##gff\nc\ts\tgene\t1\t9\t.\t+\t.\tID=g1;Name=old;Name=new;\nc\ts\texon\t2\t5\t.\t+\t.\tgene_id "g1"; transcript_id "t1";\nc\ts\tCDS\t2\t5\t.\t+\t0\tParent=t1,t2\nshort\tline\n')
    df = gff.read_gff(spark, path)
    out = {r.type: r for r in df.collect()}
    assert out["gene"].attrs == {"ID": "g1", "Name": "new"} and out["gene"].id == "g1"
    assert out["exon"].attrs == {"gene_id": "g1", "transcript_id": "t1"} and out["exon"].id is None
    assert out["CDS"].parents == ["t1", "t2"] and out["CDS"].line_number == 4
    features = gff.overlap_features(df, ["gene", "exon"])
    assert rows(features, "feature_id", "start0", "end0") == [("exon_3", 1, 5), ("g1", 0, 9)]


@pytest.mark.parametrize("form,text", [
    ("bed", "c\t0\t10\te1\t7\t+\n"), ("gff", "c\t.\tEVE\t1\t10\t7\t+\t.\tID=e1\n"), ("tsv", "seqid\tstart\tend\tregion_id\tscore\tstrand\nc\t1\t10\te1\t7\t+\n"),
    ("tsv", "chrom\tstart0\tend\tid\tscore\tstrand\nc\t0\t10\te1\t7\t+\n")])
def test_standard_regions(spark, put, form, text):
    df = gff.standardize_regions(spark, put("x", text), form)
    assert rows(df, "region_id", "seqid", "start0", "end0", "strand", "source", "score") == [("e1", "c", 0, 10, "+", "external_caller", "7")]


REPEATS = """   SW   perc perc perc  query  position in query
score   div. del. ins.  sequence begin end (left) repeat class/family

  463   1.3  0.6  1.7  chr1   10   19 (5) + AluY  SINE/Alu  1 10 (0) 1
  100  12.0  0.0  0.0  chr1   15   30 (5) C L1    LINE/L1   (0) 10 1 2
   50   3.0  0.0  0.0  chr1   40   44 (5) + (A)n  Simple_repeat 1 5 (0) 3
  bad   x    0.0  0.0  chr1   40   44 (5) + (A)n  Simple_repeat 1 5 (0) 3
"""


def test_repeatmasker(spark, put):
    df = reports.read_repeatmasker(spark, put("g.out", REPEATS))
    assert rows(df, "seqid", "start", "end", "strand", "repeat_class", "repeat_family", "divergence", "length") == [
        ("chr1", 10, 19, "+", "SINE", "Alu", 1.3, 10), ("chr1", 15, 30, "-", "LINE", "L1", 12.0, 16), ("chr1", 40, 44, "+", "Simple_repeat", "NA", 3.0, 5)]
    intervals = reports.repeat_intervals(df)
    out = dict((r[0], (r[1], r[2])) for r in rows(coverage.category_coverage(
        intervals.select("seqid", "start0", "end0", "line"), 1000, coverage.repeat_labels(F.col("line")), ["all repeat", *coverage.REPEAT_CATEGORIES])))
    assert out["all repeat"] == (26, 2.6) and out["SINEs"][0] == 10 and out["LINE"][0] == 16 and out["LTR"] == (0, 0.0)
    lines_out = [r[0] for r in sinks.repeat_gff(df).collect()]
    assert any(x.endswith("color=#800080") and "Target=AluY SINE/Alu 1 10;Div=1.3" in x for x in lines_out)
    assert any("\t-\t.\tTarget=L1 LINE/L1 1 10;Div=12.0" in x and x.endswith("#3399ff") for x in lines_out)


def test_te_domain_headers(spark, put):
    path = put("d.faa", ">c1:11-40|Class_I/LTR/Copia gene=RVT_1;strand=+;Classification=LTR/Copia\nMK\n>odd gene=DDE_x\nMM\n")
    df = reports.te_domains(fasta.read_fasta(spark, path, "keep"))
    assert rows(df, "seqid", "start", "end", "strand", "class_path", "class_level_1", "class_level_2", "class_level_3", "domain_type") == [
        (None, None, None, None, "NA", "NA", "NA", "NA", "TPase"), ("c1", 11, 40, "+", "Class_I/LTR/Copia", "Class_I", "LTR", "Copia", "RT")]
    target = spark.createDataFrame([("c1", 0, 20)], "seqid string, start0 bigint, end0 bigint")
    detail = regions.domains_by_region(reports.located_domains(df), target, target, details=True)
    assert rows(detail, "region_status", "overlap_bp") == [("missing_coordinates", 0), ("target", 10)]


def test_similarity_hits(spark, put):
    text = "# c\nq1\ts1\t90\t10\t0\t0\t1\t10\t1\t10\t0.0\t50\nq1\ts2\t90\t10\t0\t0\t1\t10\t1\t10\t0.0\t60\nq1\ts3\t90\t10\t0\t0\t1\t10\t1\t10\t1e-5\t99\nq2\tshort\n"
    df = reports.read_hits(spark, put("h.tsv", text))
    assert rows(hits.select_hits(df, 2), "subject_id", "hit_rank") == [("s1", 2), ("s2", 1)]
    assert hits.select_hits(df, None).count() == 3
    raw = lines.read_table(spark, put("alias.tsv", "qseqid\tsseqid\tidentity\te_value\tbit_score\tqcovs\nq\ts\t90\tbad\t5\t\n"))
    assert rows(hits.normalize_hits(raw)) == [("q", "s", 90.0, 0.0, 1.0, 5.0)]


def test_interproscan_kofam_eggnog(spark, put):
    ipr = reports.read_interproscan(spark, put("i.tsv", "p1\tmd5\t9\tPfam\tPF1\tdesc\t5\t20\t1e-3\tT\tdate\tIPR1\tname\tGO:1|GO:2\nmore\tmd5\t9\tPfam\tPF2\td\t1\t4\t-\tT\tdate\n"))
    assert rows(ipr, "Query_id", "Subject_id", "InterPro_id", "GO_terms") == [("more", "PF2", None, None), ("p1", "PF1", "IPR1", "GO:1|GO:2")]
    assert rows(terms.domain_architecture(reports.pfam_domains(ipr)), "query_id", "domain_spans") == [("more", "PF2:1-4"), ("p1", "PF1:5-20")]
    kofam = put("k.txt", "# gene KO\n* g1 K2 10 20 1e-9 some text\n  g1 K1 10 5 1e-3\n* g1 K2 9 9 1e-8 again\n* g2 K3 1 2 0.5 x\n")
    assert rows(reports.read_kofam(spark, kofam), "Query_id", "KO", "description") == [("g1", "K2", "again"), ("g1", "K2", "some text"), ("g2", "K3", "x")]
    everything = reports.read_kofam(spark, kofam, keep_all=True)
    assert rows(terms.kofam_gene_ko(reports.kofam_hits(everything), 0.01)) == [("g1", "K2!K1")]
    egg = reports.read_eggnog(spark, put("e.tsv", "## v\n#query\tseed\tCOG_category\ng1\ts\tKL\ng2\ts\t-\n## end\n"))
    assert rows(terms.gene_categories(egg), "gene_id", "category", "category_name") == [
        ("g1", "K", "Transcription"), ("g1", "L", "Replication, recombination and repair"), ("g2", None, None)]


def test_methylation_contexts(spark, put):
    text = "c\t1\t+\t1\t3\tCG\tCGA\nc\t2\t+\t0\t0\tCHG\tCAG\nc\t3\t+\t2\t2\tcag\tCAG\nc\t4\t+\t1\t0\tCHH\tCAA\nc\tx\t+\t1\t0\tCHH\tCAA\n"
    df = reports.read_cx(spark, put("m.txt", text))
    assert rows(df, "pos0", "context", "methylated", "total") == [(0, "CG", 1, 4), (2, "CHG", 2, 4), (3, "CHH", 1, 1)]


def test_orthogroups(spark, put):
    table = reports.read_orthogroup_table(spark, put("o.tsv", "Orthogroup\tA\tB\nOG1\ta1, a2\t\nOG2\tNA\tb1\n"))
    assert rows(table) == [("OG1", "A", "a1"), ("OG1", "A", "a2"), ("OG2", "B", "b1")]
    text = reports.read_orthogroup_text(spark, put("o.txt", "OG1: x--bac y\nOG2\tp, q--vi--rus\nOG3 m n\n"))
    assert rows(text) == [("OG1", "x", "bac"), ("OG1", "y", "NA"), ("OG2", "p", "NA"), ("OG2", "q--vi", "rus"), ("OG3", "m", "NA"), ("OG3", "n", "NA")]
    assert rows(reports.read_nodes(spark, put("n.txt", "# c\nn1 p1\nn2\tp1 x\nlone\n"))) == [("n1", "p1"), ("n2", "p1")]


LINEAGE = "#Query_id\tself_e\tBacteria\tFungi\tai\tAI_taxon\tself_b\tBacteria\tFungi\tdelta\tdpct\tratio\th_taxon\tdonor_b\tn\n"


def test_lineage_table_threshold_is_inclusive(spark, put):
    path = put("l.tsv", LINEAGE + "q1\t1e-3\t1e-50\t1e-9\t30\tBacteria\t40\t200\t90\t160\t1\t2\tunknown\t200\t3\nq2\t-\t1\t1\t29.9\tFungi\t1\t2\t3\t-1\t1\t1\tFungi\t3\t0\n")
    table = reports.read_lineage_table(spark, path, "sp")
    out = {r.query_id: r for r in hits.filter_lineage_table(table, "Plant", ["bacteria"], 30.0).collect()}
    assert (out["q1"].candidate_status, out["q1"].best_donor_group, out["q1"].best_donor_evalue) == ("candidate", "Bacteria", "1e-50")
    assert out["q2"].filter_reason == "donor_group_not_selected;low_alien_index;low_bitscore_delta;low_donor_bitscore;low_donor_taxon_count"
    strict = hits.condition_candidates(table, ["Bacteria"], [], 30.0)
    assert strict.count() == 0
    assert rows(hits.condition_candidates(table, ["bacteria", "fungi"], ["unknown"], 1.0), "query_id", "condition") == [
        ("q1", "Condition1"), ("q2", "Condition1"), ("q2", "Condition2")]
    with pytest.raises(Exception, match="column count"):
        reports.read_lineage_table(spark, put("bad.tsv", LINEAGE + "q1\t2\n")).collect()


def test_synteny_files(spark, put):
    anchors = put("x.anchors", "a0 b0 9\n###\na1 b1 10\na2 b2\n###\na3 b3 30\n")
    assert rows(reports.read_synteny(spark, anchors, "anchor", "ath.aly"), "block_id", "ref_gene", "score", "query_species") == [
        ("block_1", "a0", "9", "aly"), ("block_1", "a1", "10", "aly"), ("block_1", "a2", None, "aly"), ("block_2", "a3", "30", "aly")]
    simple = put("x.simple", "# c\na\tb\tc\td\t5\nshort\te\n\ne\tf\tg\th\n")
    assert rows(reports.read_synteny(spark, simple, "simple", "x_vs_y"), "block_id", "ref_gene", "query_gene", "score", "ref_species") == [
        ("block_1", "a..b", "c..d", "5", "x"), ("block_2", "e..f", "g..h", None, "x")]
    headed = put("t.tsv", "block_id\tref_gene\tquery_gene\nB\tr\tq\n")
    assert rows(reports.read_synteny(spark, headed, "table"), "block_id", "ref_gene", "query_gene", "ref_species") == [("B", "r", "q", "ref")]
    bare = put("u.tsv", "r\tq\t7\n")
    assert rows(reports.read_synteny(spark, bare, "table"), "block_id", "ref_gene", "query_gene", "score") == [("block_1", "r", "q", "7")]


def test_ko_files(spark, put):
    bg = reports.read_ko_lists(spark, put("b.ko", "# c\ng1\tK1!K2|note!\ng2\ng3\tK3\n"))
    assert rows(reports.gene_kos(bg)) == [("g1", "K1"), ("g1", "K2"), ("g2", None), ("g3", "K3")]
    lists = reports.read_gene_lists(spark, [put("up.glist", "g1\tx\ng9\n"), put("down.glist", "g3\n")])
    assert rows(terms.select_ko(lists, bg)) == [("down", "g3", "K3"), ("up", "g1", "K1!K2|note!")]
    assert rows(reports.read_ko_map(spark, put("m.tab", "K1\t001 002\n"))) == [("K1", "001"), ("K1", "002")]
    kegg = put("k.fa", ">abc:g7 K00001 name; K00002 other\nMK\n>xyz:g8 K1\nMM\n>abc:g9 no ko\n")
    assert rows(reports.species_kos(spark, kegg, "ABC")) == [("g7", "K00001!K00002")]
    assert rows(fasta.read_graph_segments(spark, put("a.gfa", "H\tVN\nS\tu1\tACGT\nL\tx\ty\n"))) == [("u1", "ACGT")]


def test_text_sinks(spark, tmp_path):
    df = spark.createDataFrame([("s", "A" * 130)], "seqid string, seq string")
    sinks.write_fasta(df, str(tmp_path / "f"))
    text = "".join(p.read_text() for p in (tmp_path / "f").glob("part-*"))
    assert text == ">s\n" + "A" * 60 + "\n" + "A" * 60 + "\n" + "A" * 10 + "\n"
    members = spark.createDataFrame([("OG1", "a"), ("OG1", "b"), ("OG2", "c")], "family_id string, gene_id string")
    sinks.write_lists(members, ["family_id"], F.col("gene_id"), str(tmp_path / "lists"))
    assert sorted("".join(p.read_text() for p in (tmp_path / "lists" / "family_id=OG1").glob("part-*")).split()) == ["a", "b"]
    bed = spark.createDataFrame([("c", 5, 9, "r", None)], "seqid string, start0 bigint, end0 bigint, region_id string, strand string")
    sinks.write_bed(bed, str(tmp_path / "bed"))
    assert "".join(p.read_text() for p in (tmp_path / "bed").glob("part-*")) == "c\t5\t9\tr\t0\tNA\n"


def files(path):
    """Lines of the part files one after the other, and how many files have some."""
    parts = [open(f).read().split("\n")[:-1] for f in sorted(glob.glob(f"{path}/part-*"))]
    return [x for p in parts for x in p], sum(bool(p) for p in parts)


@pytest.fixture
def eight_files(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_concatenated_part_files_are_in_order(spark, eight_files, tmp_path):
    r = random.Random(2)
    spans = [(f"chr{r.choice([1, 2, 10, 11, 'X'])}", r.randrange(10**6), 10**6 + i, f"r{i}") for i in range(3000)]
    df = spark.createDataFrame(spans, "seqid string, start0 bigint, end0 bigint, region_id string").withColumn("strand", F.lit("+")).repartition(5)
    sinks.write_bed(df, str(tmp_path / "plain"))
    got, n = files(tmp_path / "plain")
    assert n == 8 and [x.split("\t")[3] for x in got] == [s[3] for s in sorted(spans)]
    sinks.write_bed(df, str(tmp_path / "natural"), natural=True)
    rank = {"chr1": 1, "chr2": 2, "chr10": 10, "chr11": 11}
    natural = sorted(spans, key=lambda s: (s[0] == "chrX", rank.get(s[0], 0), s[1], s[2], s[3]))
    got, n = files(tmp_path / "natural")
    assert n == 8 and [x.split("\t")[0] for x in got][:1] in (["chr1"], ["chrX"])
    numeric = [x.split("\t")[3] for x in got if not x.startswith("chrX")]
    assert numeric == [s[3] for s in natural if s[0] != "chrX"]
    numbers = {x.region_id: x.row_number for x in sinks.numbered(df, ["seqid", "start0", "end0", "region_id"]).collect()}
    assert numbers == {s[3]: i for i, s in enumerate(sorted(spans), 1)}


def test_sequences_and_counts_in_order_over_files(spark, eight_files, tmp_path):
    r = random.Random(3)
    records = [(f"s{i}", "ACGT" * r.randint(1, 40), r.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(records, "seqid string, seq string, start0 bigint").repartition(7)
    sinks.write_fasta(df, str(tmp_path / "fa"), order=sinks.genomic_order(df, natural=True))
    got, n = files(tmp_path / "fa")
    assert n == 8 and [x[1:] for x in got if x.startswith(">")] == [f"s{i}" for i in range(400)]
    back = fasta.read_fasta(spark, str(tmp_path / "fa"))
    assert rows(back, "seqid", "seq") == sorted((s[0], s[1]) for s in records)
    sinks.write_counts(df, str(tmp_path / "counts"), "start0", ["seqid"], ["start0", "seqid"])
    got, _ = files(tmp_path / "counts")
    lines_only = [tuple(x.split("\t")) for x in got if x != "start0\tseqid"]
    assert lines_only == [(str(s[2]), s[0]) for s in sorted(records, key=lambda s: (-s[2], s[0]))]


def test_read_names_without_mate(spark):
    df = spark.createDataFrame([("r1/1",), ("x",), (None,)], "region_id string")
    assert [r[0] for r in sinks.trim_read_names(df).collect()] == ["r1", "", None]


def test_one_large_split_is_numbered_by_many_tasks(spark):
    """Lines given as a frame may all stand in one split; no task holds them all."""
    def frame(some):
        return spark.createDataFrame([(t, i) for i, t in enumerate(some)], "line string, i bigint").repartition(5).selectExpr(
            "'f' as path", "line", "named_struct('path', 'f', 'block', 0L, 'line', i * 64) as _row")

    text, blocks, n = [], [], 0
    for i in range(3000):
        if i % 7 == 0:
            n += 1
            text.append("###")
        text.append(f"a{i}\tb{i}\t1")
        blocks.append((f"a{i}", f"block_{n}"))
    some = frame(text)
    anchors = reports.read_synteny(spark, some, "anchor", "x.y")
    assert rows(anchors, "ref_gene", "block_id") == sorted(blocks)
    simple = reports.read_synteny(spark, frame([f"{'#' if i % 3 == 0 else ''}a{i}\tb\tc\td\t1" for i in range(3000)]), "simple", "x.y")
    assert rows(simple, "ref_gene", "block_id") == sorted((f"a{i}..b", f"block_{k + 1}") for k, i in enumerate(i for i in range(3000) if i % 3))
    for found in (anchors, simple):
        assert "_b#" in found._jdf.queryExecution().executedPlan().toString() and "_row#" not in "".join(
            x for x in found._jdf.queryExecution().executedPlan().toString().split("\n") if "hashpartitioning" in x)
    numbered = lines.with_line_numbers(frame([f"l{i}" for i in range(500)]))
    assert rows(numbered.select("line", "line_number")) == sorted((f"l{i}", i * 64 + 1) for i in range(500))
    assert "_share" in numbered._jdf.queryExecution().executedPlan().toString()


def test_repeat_lines_are_split_once(spark):
    """However many cells are read and filtered, a line is split once; results stay, header and bad lines left out."""
    texts = ["SW perc", "   score x", "#c", "", " 9 1.5 0 2 c1 3 8 (1) C L LINE/L1 1 2 (3)  ", "9 1.5 0 2 c1 3 8 (1) + d Simple_repeat-DNA/x 1 2 3", "9 x 0 2 c1 3 8 (1) + d o 1 2 3", "9 1 0 2 c1 3.5 8 (1) + d o 1 2 3", "9 1 0 2 c2 3 8 (1) + d o"]
    frame = spark.createDataFrame([("f", t, ("f", 0, i)) for i, t in enumerate(texts)], "path string, line string, _row struct<path:string,block:bigint,line:bigint>")
    out = sinks.repeat_gff(reports.read_repeatmasker(spark, frame))
    assert out._jdf.queryExecution().optimizedPlan().toString().count("split(rtrim(") == 1
    start = "c1\tRepeatMasker-4.0.1\tsimilarity\t3\t8\t9\t"
    notes = ";Div=1.5;Del=0;Ins=2;SWscore=9;color="
    assert rows(out, "value") == sorted([
        (start + "-\t.\tTarget=L LINE/L1 (3) 2" + notes + "#3399ff",), *[(start + "+\t.\tTarget=d Simple_repeat-DNA/x 1 2" + notes + c,) for c in ("#ff6666", "#8686ac")],
        ("c2\tRepeatMasker-4.0.1\tsimilarity\t3\t8\t9\t+\t.\tTarget=d o;Div=1;Del=0;Ins=2;SWscore=9;color=#f2f2f2",)])
