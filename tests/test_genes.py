import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociframe.operators import annotations, genes, matrices, sequences
from lociframe.sources import fasta, gff, sinks

GENOME = ">c1\n" + "TTATGAAACC" + "GTAAATTTAG" + "GGTTTTAAGG" + "\n>c2\nCCCTTATTTCATGG\n"
# g1 has two isoforms; t1 is spliced, its CDS is ATGAAACC + GGTTTTAA -> 16 bases; g2 lies on the minus strand.
GFF = """##gff-version 3
c1\ts\tgene\t3\t28\t.\t+\t.\tID=g1;Name=first
c1\ts\tmRNA\t3\t28\t.\t+\t.\tID=g1.t2;Parent=g1
c1\ts\tmRNA\t3\t28\t.\t+\t.\tID=g1.t1;Parent=g1
c1\ts\texon\t3\t10\t.\t+\t.\tID=e1;Parent=g1.t1,g1.t2
c1\ts\texon\t21\t28\t.\t+\t.\tID=e2;Parent=g1.t1
c1\ts\tCDS\t21\t28\t.\t+\t0\tID=c;Parent=g1.t1
c1\ts\tCDS\t3\t10\t.\t+\t0\tID=c;Parent=g1.t1
c2\ts\tgene\t4\t12\t.\t-\t.\tID=g2
c2\ts\tmRNA\t4\t12\t.\t-\t.\tID=m2;Parent=g2
c2\ts\tCDS\t4\t12\t.\t-\t0\tParent=m2
c2\ts\tncRNA\t1\t3\t.\t+\t.\tID=n1;Parent=gone
c2\ts\tregion\t1\t99\t.\t+\t.\tNote=x
"""


@pytest.fixture
def models(spark, put):
    features = gff.read_gff(spark, put("a.gff", GFF), "sp").cache()
    genome = fasta.read_fasta(spark, put("g.fa", GENOME)).select("seqid", "seq").cache()
    return features, genome


def test_primary_transcripts(models):
    assert rows(genes.primary_transcripts(models[0]), "transcript_id") == [("g1.t1",), ("m2",)]
    assert rows(genes.primary_transcripts(models[0], r"t2$"), "transcript_id") == [("g1.t2",)]


def test_orphan_transcripts(spark, put):
    text = "".join(f"c\ts\tmRNA\t1\t9\t.\t+\t.\tID={i}\n" for i in ("a.t1", "a.t2", "plain"))
    assert rows(genes.primary_transcripts(gff.read_gff(spark, put("o.gff", text))), "transcript_id") == [("a.t1",), ("plain",)]


def test_coding_sequences(spark, models):
    features, genome = models
    out = genes.gene_models(features, genome.withColumn("species", F.lit("sp")), filter_bad=True)
    raw = {r.transcript_id: r for r in out["raw"].collect()}
    assert raw["g1.t1"].cds == "ATGAAACCGGTTTTAA" and raw["g1.t1"].phase_ok == 0 and raw["g1.t1"].start_ok == 1
    # TTATTTCAT on the minus strand reads ATGAAATAA.
    assert (raw["m2"].cds, raw["m2"].pep, raw["m2"].terminal_stop, raw["m2"].internal_stop) == ("ATGAAATAA", "MK*", 1, 0)
    assert rows(out["final"], "transcript_id") == [("m2",)]
    lines = [r.line.split("\t")[2] for r in out["gff"].orderBy("_order").collect()]
    assert lines == ["gene", "mRNA", "CDS"]
    assert rows(out["summary"], "transcripts_selected", "raw_cds_written", "cds_written", "filtered_bad_cds", "gff_features") == [(2, 2, 1, 1, 3)]
    kept = genes.gene_models(features, genome.withColumn("species", F.lit("sp")), spark.createDataFrame([("c1",)], "seqid string"), filter_bad=False)
    assert [r.line.split("\t")[2] for r in kept["gff"].orderBy("_order").collect()] == ["gene", "mRNA", "exon", "exon", "CDS", "CDS"]


def test_small_chunks_give_the_same_sequence(models):
    features, genome = models
    chosen = genes.primary_transcripts(features)
    out = genes.coding_sequences(features, chosen, genome.withColumn("species", F.lit("sp")), size=3)
    assert rows(out, "transcript_id", "cds") == [("g1.t1", "ATGAAACCGGTTTTAA"), ("m2", "ATGAAATAA")]


def test_missing_sequence_is_an_error(models):
    features, genome = models
    with pytest.raises(Exception, match="not in genome"):
        genes.coding_sequences(features, genes.primary_transcripts(features), genome.filter("seqid = 'c1'").withColumn("species", F.lit("sp"))).collect()


def test_introns(models):
    features, genome = models
    out = genes.introns(features, genome=genome.withColumn("species", F.lit("sp")), min_short=5, max_short=10)
    assert rows(out, "transcript_id", "gene_id", "start0", "end0", "length", "intron_number", "is_short_intron", "at_content", "is_at_rich") == [
        ("g1.t1", "g1", 10, 20, 10, 1, True, 0.8, True)]
    pooled = genes.introns(features, group_by="gene_pooled")
    assert rows(pooled, "transcript_id", "start0", "end0") == [("g1", 10, 20)]
    assert rows(genes.introns(features, "CDS"), "transcript_id", "start0") == [("g1.t1", 10)]
    unique = genes.unique_introns(out)
    assert rows(unique, "transcript_count", "gene_count") == [(1, 1)] and rows(genes.intron_members(out), "transcript_id", "gene_id") == [("g1.t1", "g1")]
    summary = dict(rows(genes.intron_summary(out), "metric", "value"))
    assert summary["total_introns"] == 1 and summary["median_intron_length"] == 10 and summary["at_rich_introns"] == 1 and len(summary) == 9
    assert rows(genes.intron_sequence_summary(unique), "seqid", "unique_intron_count", "at_rich_intron_ratio") == [("c1", 1, 1.0)]
    assert rows(sinks.intron_bed(out)) == [("c1\t10\t20\tg1.t1.intron1\t10\t+",)]


def test_no_introns(models):
    assert genes.intron_summary(genes.introns(models[0].filter("type <> 'exon'"))).count() == 0


def test_species_of_a_cohort_stay_apart(models):
    features, _ = models
    both = features.unionByName(features.withColumn("species", F.lit("other")))
    genome = features.sparkSession.createDataFrame([("sp", "c1", "A" * 40), ("other", "c1", "C" * 40)], "species string, seqid string, seq string")
    found = genes.introns(both, genome=genome)
    assert rows(found, "species", "at_content") == [("other", 0.0), ("sp", 1.0)]
    summary = {(r.species, r.metric): r.value for r in genes.intron_summary(found).collect()}
    assert len(summary) == 18 and all(summary[s, "transcripts_with_introns"] == 1 for s in ("sp", "other"))
    assert genes.annotated_transcripts(both).count() == 2 * genes.annotated_transcripts(features).count()


@pytest.mark.parametrize("bin_size", [10, 1 << 16])
def test_segment_gaps_match_a_loop(spark, bin_size):
    r = random.Random(3)
    segments = []
    for _ in range(200):
        s = r.randrange(1, 900)
        segments.append((r.choice(["t1", "t1", "t2"]), s, s + r.randrange(0, 12), "+"))
    out = genes.segment_gaps(spark.createDataFrame(segments, "tx string, start bigint, end bigint, strand string"), ["tx"], bin_size)
    expected = set()
    for tx in ("t1", "t2"):
        mine = sorted((s, e) for t, s, e, _ in segments if t == tx)
        for i, (a, b) in enumerate(zip(mine, mine[1:])):
            if b[0] - 1 > a[1]:
                expected.add((tx, a[1], b[0] - 1, i + 1))
    assert {(r.tx, r.start0, r.end0, r.gap_number) for r in out.collect()} == expected


def test_structure_tables(spark, models):
    features, _ = models
    lengths = spark.createDataFrame([("sp", "c1", 30), ("sp", "c2", 14), ("sp", "c3", 5)], "species string, seqid string, length bigint")
    out = genes.gff_structure(features, lengths)
    metrics = {r.metric: r.value for r in out["metrics"].collect()}
    assert len(metrics) == 18
    expected = {"feature_records": 12, "genes": 2, "transcripts": 4, "exons": 2, "cds_features": 3, "introns": 1, "genes_with_isoforms": 1,
                "mean_gene_length": 17.5, "median_gene_length": 17.5, "single_exon_transcripts": 1, "multi_exon_transcripts": 1,
                "mean_intron_length": 10, "mean_exons_per_transcript": 0.75}
    for name, value in expected.items():
        assert metrics[name] == pytest.approx(value), name
    checks = {r.check: (r.status, r.details) for r in out["checks"].collect()}
    assert checks == {"duplicate_ids": ("fail", "1"), "child_features_without_parent": ("warn", "1"), "missing_parent_references": ("fail", "1"),
                      "seqids_in_genome": ("fail", "1")}
    assert rows(genes.failed_names(features), "check", "id") == [("duplicate_ids", "c"), ("missing_parent_references", "gone")]
    assert rows(out["sequences"], "seqid", "gene_count", "transcript_count", "gene_bp") == [("c1", 1, 2, 26), ("c2", 1, 2, 9), ("c3", 0, 0, 0)]
    assert rows(out["histograms"].filter("category = 'exon_number'"), "bin_start", "raw_count", "total_count") == [(0, 0, 4), (0, 2, 4), (1, 1, 4), (2, 1, 4)]
    assert rows(out["feature_types"].filter("feature_type = 'exon'"), "count", "total_bp", "median_length") == [(2, 16, 8.0)]
    assert out["distributions"].filter("category = 'isoforms_per_gene' and feature_id = 'g1'").first()["count"] == 2
    matrix = matrices.structure_matrix(out["metrics"], ["sp"])
    assert matrix.filter("metric = 'genes'").first()["sp"] == 2
    assert matrices.plot_rows(out["distributions"]).filter("plot_group = 'exons_per_transcript'").count() == 4
    compat = {r.metric: r.value for r in genes.gff_structure(features, compat=True)["metrics"].collect()}
    assert compat["mean_exons_per_transcript"] == pytest.approx(3 / 4)
    assert {r.check: r.details for r in genes.gff_structure(features)["checks"].collect()}["seqids_in_genome"] == "not_tested"


def test_coordinates_prefer_the_own_row(models):
    out = genes.feature_coordinates(models[0])
    best = out.groupBy("id").agg(F.min(F.struct("priority", "start", "end")).alias("b")).select("id", "b.priority", "b.start")
    assert ("g1", 0, 3) in rows(best) and ("first", 0, 3) in rows(best)


def test_merge_annotations_from_features(spark, models):
    merged = annotations.merge_annotations(genes.annotated_transcripts(models[0]))
    assert rows(merged, "transcript_id", "gene_id", "Pfam_ids") == [("g1.t1", "g1", None), ("g1.t2", "g1", None), ("m2", "g2", None)]


def test_soft_mask_across_chunks(spark):
    r = random.Random(4)
    seq = "".join(r.choice("ACGTN") for _ in range(97))
    spans = [(r.randrange(0, 100), r.randrange(0, 100)) for _ in range(12)]
    spans = [(min(a, b), max(a, b)) for a, b in spans][:6]
    expected = "".join(ch.lower() if ch in "ACGT" and any(s <= i < e for s, e in spans) else ch for i, ch in enumerate(seq))
    df = spark.createDataFrame([("s", seq), ("plain", "ACGT")], "seqid string, seq string")
    masks = spark.createDataFrame([("s", s, e) for s, e in spans], "seqid string, start0 bigint, end0 bigint")
    for size in (7, 64, 1 << 16):
        assert dict(rows(sequences.rebuild_sequences(sequences.soft_mask(df, masks, size)))) == {"s": expected, "plain": "ACGT"}


def test_kmers_match_a_loop(spark):
    from collections import Counter
    r = random.Random(5)
    seqs = ["".join(r.choice("ACGT" * 5 + "Nn") for _ in range(300)) for _ in range(5)] + ["ACG"]
    complement = str.maketrans("ACGT", "TGCA")
    expected = Counter()
    for s in seqs:
        for i in range(len(s) - 4):
            k = s[i:i + 5].upper()
            if set(k) <= set("ACGT"):
                expected[min(k, k.translate(complement)[::-1])] += 1
    df = spark.createDataFrame(list(enumerate(seqs)), "seqid int, seq string")
    for chunk in (5, 16, 256):
        assert dict(rows(sequences.kmer_counts(df, 5, chunk))) == expected


@pytest.mark.parametrize("k", [1, 31, 32, 70])
def test_kmers_travel_as_numbers(spark, k):
    from collections import Counter
    r = random.Random(k)
    seqs = ["".join(r.choice("ACGT" * 60 + "nN") for _ in range(400)) for _ in range(4)] * 2 + ["", None, "é" * 80, "ACGT" * 40]
    complement = str.maketrans("ACGT", "TGCA")
    expected = Counter(min(w, w.translate(complement)[::-1]) for s in seqs if s for w in (s[i:i + k] for i in range(len(s) - k + 1)) if set(w) <= set("ACGT"))
    df = spark.createDataFrame(list(enumerate(seqs)), "seqid int, seq string")
    pieces = df.selectExpr("seqid", "0L as start0", "substring(seq, 1, 150) as seq").unionByName(df.selectExpr("seqid", "150L as start0", "substring(seq, 151) as seq")).filter("seq is not null")
    for table in (df, pieces):
        counts = sequences.kmer_counts(table, k, 97)
        assert dict(rows(counts)) == expected
        plan = counts._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(_w0" in plan and "hashpartitioning(kmer" not in plan
    assert "Join" not in sequences.kmer_counts(pieces, k)._jdf.queryExecution().executedPlan().toString()


def test_gc_windows_compat(spark):
    df = spark.createDataFrame([("s", "GGCCAATTNN")], "seqid string, seq string")
    assert rows(sequences.gc_windows(df, 5), "start", "end", "gc") == [(0, 5, 0.8), (5, 10, 0.0)]
    assert set(rows(sequences.gc_windows(df, 5, compat=True), "start", "end", "gc")) == {(0, 4, 0.8), (5, 9, 0.0), (10, 10, 0.0)}


def test_read_quality(spark):
    reads = [("good", "A" * 60, "I" * 60), ("short", "A" * 10, "I" * 10), ("low", "A" * 60, "#" * 30 + "I" * 30), ("mean", "A" * 60, "3" * 59 + "#")]
    df = spark.createDataFrame(reads, "name string, seq string, qual string")
    assert rows(sequences.quality_reads(df), "name") == [("good",)]


def test_alignment_columns(spark):
    df = spark.createDataFrame([("a", "s1", "A-C-T"), ("a", "s2", "A--GT"), ("b", "s1", "AC")], "alignment string, species string, seq string")
    assert rows(sequences.trim_alignment_columns(df, 60.0)) == [("a", "s1", "AC-T"), ("a", "s2", "A-GT"), ("b", "s1", "AC")]
    assert rows(sequences.trim_alignment_columns(df, 50.0)) == [("a", "s1", "AT"), ("a", "s2", "AT"), ("b", "s1", "AC")]
    assert rows(sequences.trim_alignment_columns(df, 0.0), "seq") == [("",)] * 3


def test_gap_columns_of_long_rows_match_a_loop(spark):
    r = random.Random(12)
    data = []
    for alignment, n in (("long", 70_000), ("short", 40), ("empty", 0)):
        for k in range(9):
            seq = "".join(("-" if r.random() < 0.5 else r.choice("ACGTé")) * r.randint(1, 9) for _ in range(n // 5))[: n - (k == 8) * 3]
            data.append((alignment, f"s{k}", seq))
    df = spark.createDataFrame(data, "alignment string, species string, seq string").repartition(3)
    for limit in (30.0, 55.0, 100.0):
        expected = []
        for name in ("long", "short", "empty"):
            mine = [d for d in data if d[0] == name]
            width = max(len(d[2]) for d in mine)
            gaps = [sum(c < len(d[2]) and d[2][c] == "-" for d in mine) for c in range(width)]
            expected += [(name, s, "".join(x for c, x in enumerate(seq) if not gaps[c] or gaps[c] / 9 * 100 < limit)) for _, s, seq in mine]
        assert rows(sequences.trim_alignment_columns(df, limit)) == sorted(expected)
    plan = sequences.trim_alignment_columns(df, 50.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "split(seq" not in plan


def test_wanted_tables_run_no_jobs_of_others(spark, models):
    from lociframe.plans import chains

    features, _ = models
    context = spark.sparkContext
    context.setJobGroup("building", "tables named by only")
    histograms = genes.gff_structure(features, only=["histograms"])
    introns = chains.intron_features(features, only=["unique", "members"])
    jobs = context.statusTracker().getJobIdsForGroup("building")
    context.setJobGroup("", "")
    assert list(histograms) == ["histograms"] and list(introns) == ["unique", "members"] and not jobs


def test_exons_come_before_cds_parts(spark, models):
    features, _ = models
    both = features.filter("type <> 'exon'").unionByName(features.filter("type = 'exon'").limit(0))
    exons = {(r.category, r.bin_start): r.raw_count for r in genes.gff_structure(features, only=["histograms"])["histograms"].collect()}
    parts = {(r.category, r.bin_start): r.raw_count for r in genes.gff_structure(both, only=["histograms"])["histograms"].collect()}
    assert exons["intron_length", 10] == 1 and sum(n for (c, _), n in parts.items() if c == "intron_length") == genes.introns(both, "CDS").count()


def test_segments_without_a_start_shift_no_numbers(spark):
    segments = spark.createDataFrame([("t", None, 5, "+"), ("t", 10, 20, "-"), ("t", 10, 20, "+"), ("t", 30, 40, None)], "tx string, start bigint, end bigint, strand string")
    out = genes.segment_gaps(segments, ["tx"])
    assert rows(out, "start0", "end0", "strand", "gap_number") == [(20, 29, "+", 2)]


def test_unique_introns_of_several_features(spark):
    columns = ("species string, seqid string, start0 bigint, end0 bigint, strand string, transcript_id string, gene_id string, intron_number bigint, "
               "source_feature string, is_short_intron boolean, at_content double, is_at_rich boolean")
    found = spark.createDataFrame([
        ("sp", "c", 5, 9, "+", "t1", "g1", 2, "exon", False, 0.5, False), ("sp", "c", 5, 9, "+", "t1", "g1", 1, "CDS", False, 0.5, False),
        ("sp", "c", 5, 9, "+", "t2", None, 3, "exon", False, 0.5, False), ("sp", "c", 5, 9, None, "t2", "g1", 3, "exon", False, None, None)], columns)
    out = genes.unique_introns(found)
    assert rows(out, "strand", "start1", "end1", "length", "source_feature", "intron_number", "at_content", "transcript_count", "gene_count") == [
        (None, 6, 9, 4, "exon", 3, None, 1, 1), ("+", 6, 9, 4, "CDS", 1, 0.5, 2, 1)]
    # Each row is copied once per id, not once more for the other columns.
    assert "Expand" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_unique_introns_count_each_transcript_once_and_keep_it_one_row_a_gene(spark):
    schema = ("species string, seqid string, start0 long, end0 long, strand string, gene_id string, transcript_id string, intron_number long, "
              "source_feature string, is_short_intron boolean, at_content double, is_at_rich boolean")
    place = ("sp", "c1", 10, 50, "+")
    rest = (True, None, None)
    found = spark.createDataFrame(
        [(*place, "g1", "t1", 2, "exon", *rest), (*place, "g1", "t1", 1, "CDS", *rest), (*place, "g2", "t1", 3, "exon", *rest), (*place, None, "t2", 4, "exon", *rest),
         (*place, "g1", "t3", 4, "exon", *rest), ("sp", "c1", 10, 50, None, None, None, 5, "exon", *rest)], schema)
    unique = genes.unique_introns(found)
    assert sorted((str(r.strand), r.transcript_count, r.gene_count, r.intron_number, r.source_feature) for r in unique.collect()) == [
        ("+", 3, 2, 1, "CDS"), ("None", 0, 0, 5, "exon")]
    members = sorted((r.transcript_id or "", r.gene_id) for r in genes.intron_members(found).collect())
    assert members == [("", "NA"), ("t1", "g1"), ("t1", "g2"), ("t2", "NA"), ("t3", "g1")]
    # An intron is one row before genes are made distinct, and members need no table of keys.
    assert "Generate" not in unique._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" not in genes.intron_members(found)._jdf.queryExecution().executedPlan().toString()


def test_annotation_is_read_once_and_unnumbered(spark):
    """Lines are split and parsed once, line numbers are only made where they are read, and primary transcripts come from one scan."""
    texts = ["#x", "c1\ts\tmRNA\t1\t9\t.\t+\t.\tID=a.t2;Parent=g", "c1\ts\tmRNA\t2\t9\t.\t+\t.\tID=a.t1;Parent=g;Parent=h", "c1\ts\tmRNA\t1\t9\t.\t+\t.\tID=b.t2", "c1\ts\tmRNA\t1\t9\t.\t+\t.\tk=1;ID=c=d;note x",
             'c1\ts\tmRNA\t1\t9\t.\t-\t.\tID "e.t1" ; Parent=h', "c1\ts\tmRNA\t1\t9\t.\t+\t.\tID=a.t2;Parent=g;tail"]
    frame = spark.createDataFrame([("f", t, ("f", 0, i)) for i, t in enumerate(texts)], "path string, line string, _row struct<path:string,block:bigint,line:bigint>")
    features = gff.read_gff(spark, frame)
    assert [(r.id, r.line_number) for r in features.orderBy("line_number").collect()] == [("a.t2", 2), ("a.t1", 3), ("b.t2", 4), ("c=d", 5), ("e.t1", 6), ("a.t2", 7)]
    plan = features.filter("type = 'mRNA' and id is not null")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(line") == 1
    chosen = genes.primary_transcripts(features)
    plan = chosen._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("LogicalRDD") == 1
    assert rows(chosen, "transcript_id", "gene", "start") == [("a.t1", "h", 2), ("a.t2", "g", 1), ("c=d", None, 1)]


def test_stored_tables_keep_no_shuffle_files(spark):
    """A stored table has its rows, its own size for planning, and leaves the session's setting as it was."""
    from lociframe.session import CLEANUP, stored

    before = spark.conf.get(CLEANUP)
    table = stored(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "test")
    assert rows(table) == [(k, 143 if k < 6 else 142) for k in range(7)] and spark.conf.get(CLEANUP) == before
    assert table.inputFiles() and int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) < 100_000
