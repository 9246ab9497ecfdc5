import random

import pytest
from conftest import rows
from pyspark.errors import SparkRuntimeException
from pyspark.sql import functions as F

from lociframe.operators import coverage, families, hits, matrices, qc, rules, trees
from lociframe.sources import fasta, lines, reports


def test_rename_tips(spark):
    corpus = spark.createDataFrame([("t1", "((a:0.1,b x:0.2)0.99:1,(c,d));"), ("t2", "(a,(z:1,b x:2):3);")], "tree_id string, newick string")
    labels = spark.createDataFrame([("a", "new (a)"), ("b x", ""), ("d", "D")], "tip_id string, label string")
    assert rows(trees.rename_tips(corpus, labels), "tree_id", "newick", "tips") == [
        ("t1", "((new_a_:0.1,b_x:0.2)0.99:1,(c,D));", 4), ("t2", "(new_a_,(z:1,b_x:2):3);", 3)]
    assert rows(trees.newick_tips(spark.createDataFrame([("t", "((sp1:0.1,sp2:1e-5)0.9,sp3);")], "tree_id string, newick string")), "tip") == [("sp1",), ("sp2",), ("sp3",)]


def test_a_tree_that_loses_a_tip_fails(spark):
    corpus = spark.createDataFrame([("good", "(a:1,b:2);"), ("bad", "(c:1,77:2);")], "tree_id string, newick string")
    one = spark.createDataFrame([("a", "b"), ("77", "88")], "tip_id string, label string")
    assert rows(trees.rename_tips(corpus, one), "tree_id", "newick", "repeated_tips") == [("bad", "(c:1,88:2);", []), ("good", "(b:1,b:2);", ["b"])]
    number = spark.createDataFrame([("c", "1e-5")], "tip_id string, label string")
    with pytest.raises(SparkRuntimeException, match="relabelling changed the tips of tree bad"):
        trees.rename_tips(corpus, number).count()


def test_truncated_ids(spark):
    full = spark.createDataFrame([(x,) for x in ("gene_alpha_1", "gene_alpha_2", "gene_beta", "exact", "exact_not", "longshared_X1")], "seqid string")
    tips = spark.createDataFrame([(x,) for x in ("exact", "gene_be", "gene_alpha", "longshared_Y", "gene_gamma", "zzz")], "tip string")
    assert rows(trees.resolve_truncated_ids(tips, full)) == [
        ("exact", "exact", "exact"), ("gene_alpha", "gene_alpha", "ambiguous"), ("gene_be", "gene_beta", "prefix"),
        ("gene_gamma", "gene_gamma", "unresolved"), ("longshared_Y", "longshared_X1", "shared_beginning"), ("zzz", "zzz", "unresolved")]


def test_tip_tables(spark):
    ann = spark.createDataFrame([("t1", "g1", "PF1", "K1", "desc")], "transcript_id string, gene_id string, Pfam_ids string, KEGG_ko string, SwissProt_description string")
    ids = spark.createDataFrame([("sp|t1", "t1", "sp"), ("sp|t9", "t9", "sp")], "prefixed_id string, original_id string, prefix string")
    assert rows(trees.tip_annotation(ann, ids), "tip_id", "species", "gene_id", "description") == [("sp|t1", "sp", "g1", "desc"), ("sp|t9", "sp", None, None)]
    assert rows(trees.tip_annotation(ann), "tip_id", "label") == [("t1", "t1")]
    genes = spark.createDataFrame([("t1",), ("t2",)], "gene_id string")
    out = trees.function_tip_table(genes, ann, spark.createDataFrame([("o",)], "gene_id string"), spark.createDataFrame([("m",)], "seqid string"))
    assert rows(out, "tip_id", "source_group", "KO_ids", "note") == [("m", "marker", None, "marker"), ("o", "outgroup", None, None), ("t1", "target", "K1", None), ("t2", "target", None, None)]


def test_gene_tree_status(spark):
    tree_list = spark.createDataFrame([("x/OG1.treefile",), ("OG2.rooted.tree",), ("",)], "tree_file string")
    aln = spark.createDataFrame([("OG1", "AC-"), ("OG1", "ACG")], "orthogroup string, seq string")
    failed = spark.createDataFrame([("OG2", "late"), ("OG3", "bad")], "orthogroup string, failed_reason string")
    models = spark.createDataFrame([("OG1", "LG")], "orthogroup string, best_model string")
    assert rows(trees.gene_tree_status(tree_list, aln, models, failed), "orthogroup", "status", "sequence_count", "alignment_length", "best_model", "failed_reason") == [
        ("OG1", "success", 2, 3, "LG", None), ("OG2", "success", 0, 0, None, None), ("OG3", "failed", 0, 0, None, "bad")]


BUSCO = """# BUSCO version is: 5.4.3
# The lineage dataset is: eudicots_odb10 (Creation date: x)
	C:95.1%[S:90.0%,D:5.1%],F:2.0%,M:2.9%,n:2326
	2212	Complete BUSCOs (C)
	2093	Complete and single-copy BUSCOs (S)
	119	Complete and duplicated BUSCOs (D)
	47	Fragmented BUSCOs (F)
	67	Missing BUSCOs (M)
	2326	Total BUSCO groups searched
"""
BUSCO_JSON = '{"results": {"Complete percentage": 99.5, "n": 100, "Complete BUSCOs": 99}, "lineage_dataset": "fungi", "version": "5"}'


def test_busco_cohort(spark, put):
    paths = [put("short_summary.specific.s1.txt", BUSCO), put("short_summary.s2.json", BUSCO_JSON)]
    out = {r.sample: r for r in qc.busco_summary(reports.read_reports(spark, paths), "genome", "given").collect()}
    a, b = out["s1"], out["s2"]
    assert (a.lineage, a.busco_version, a.complete_percent, a.missing_percent, a.complete_count, a.single_copy_count, a.total_buscos) == (
        "eudicots_odb10", "5.4.3", "95.1", "2.9", "2212", "2093", "2326")
    assert (b.lineage, b.complete_percent, b.complete_count, b.total_buscos, b.missing_count) == ("fungi", "99.5", "99", "100", None)


def test_lai_cohort(spark, put):
    headed = put("a.LAI", "#Chr Start End raw_LAI LAI\nwhole 1 100 9.5 12.25\nchr1 1 50 3 4.9\n")
    bare = put("b.LAI", "whole 1 100 0.5 21\n")
    empty = put("c.LAI", "# nothing\n")
    out = rows(qc.lai_summary(reports.read_reports(spark, [headed, bare, empty])), "region", "start", "end", "raw_lai", "lai_score", "quality_status")
    assert out == [(None, None, None, None, None, "missing"), ("chr1", "1", "50", "3", "4.9", "low"), ("whole", "1", "100", None, "21", "gold"), ("whole", "1", "100", "9.5", "12.25", "reference")]


def test_merqury_cohort(spark, put):
    paths = [put("x.qv", "asm 10 1000 40.5 0.0001\n"), put("x.completeness.stats", "asm all 90 100 90.5\n"), put("x.spectra-cn.stats", "Copies: 5\n"), put("final_kmer.txt", "21\n")]
    assert rows(qc.merqury_summary(reports.read_reports(spark, paths)), "metric", "value") == [
        ("Copies", "5"), ("asm_completeness", "90.5"), ("assembly", "asm"), ("final_kmer", "21"), ("kmer_error_rate", "40.5"), ("kmer_qv", "0.0001")]


def test_count_tables(spark, put):
    wide = lines.read_table(spark, put("c.tsv", "Orthogroup\tA\tB\tTotal\nOG1\t1\t0\t1\nOG1\t2\t2\t4\nOG2\tx\t3\t3\nOG3\t-1\t\t0\n"), ordered=True)
    out = families.check_counts(wide, ["B", "A"])
    assert rows(out, "Family ID", "B", "A", "reason") == [
        ("OG1", 0, 1, None), ("OG1", 2, 2, "duplicate_family_id"), ("OG2", 3, 0, "invalid_count:A"), ("OG3", 0, 0, "invalid_count:A")]
    assert families.cafe_matrix(wide, ["A"]).columns == ["Desc", "Family ID", "A", "B"]
    long = families.to_long_counts(wide.drop("_row"))
    assert ("OG2", "A", 0) in rows(long)
    shape = {r["family_id"]: r for r in families.family_summary(long.filter("family_id in ('OG2', 'OG3')"), ["A", "B"]).collect()}
    assert shape["OG2"].copy_counts == "A:0;B:3" and shape["OG2"].lineage_specific and shape["OG3"].present_species == "NA"
    assert rows(families.filter_families(long.filter("family_id <> 'OG1'").withColumn("copies", F.greatest("copies", F.lit(0))), None, 1, True)) == [
        ("OG2", None), ("OG3", "all_zero;min_species")]


def test_wide_gain_loss(spark):
    raw = spark.createDataFrame([("F1", "2", "0", "1", "5")], "fam string, `n1|gain` string, `n1|loss` string, n_2_loss string, `n1|count` string")
    assert rows(families.normalize_gain_loss_wide(raw), "node_id", "gain", "loss", "inferred_count") == [("n1", 2.0, 0.0, "5"), ("n_2", 0.0, 1.0, None)]


def test_rules_from_file(spark, put):
    table = lines.read_table(spark, put("r.tsv", "family\tpattern\ttype\tfield\tmatch_mode\nF1\tpf1\tpfam\tPfam_ids\t\nF2\tkinase\t\t\t\nF3\t^AT\tseed\t\tregex\nF4\t\tseed\t\t\nF5\t\tseed\t\texact\n"), ordered=True)
    parsed = rules.normalize_rules(table)
    ann = spark.createDataFrame([("t1", "PF1;PF10", "a Kinase"), ("t2", "PF10", "none")], "transcript_id string, Pfam_ids string, note string")
    seeds = spark.createDataFrame([("AT1",), ("x",)], "gene_id string")
    assert rows(rules.family_evidence(ann, parsed, None, seeds), "gene_id", "family_id", "matched_value") == [
        ("AT1", "F3", "AT1"), ("AT1", "F4", "AT1"), ("AT1", "F5", "AT1"), ("t1", "F1", "pf1"), ("t1", "F2", "kinase"), ("x", "F4", "x"), ("x", "F5", "x")]


PATTERNS = [
    "ab+c", "ab*c", "a[bx]c?de", "colou?r", r"\bkinase\d", "^heat.shock$", "x{2,3}yz", "(foo|bar)baz", "foo|bar", "a.c", "", "zz", r"p\.q", r"\Qa.b\E", "[a[b]c]xyz", "Straße", "heat(?: shock)?",
    "kin.se", r"a\|b", "[^a]bcd", "abc$|^xyz", "end+ing", "(?x) a b c",
]


def test_every_pattern_form_matches_as_a_scan_does(spark):
    r = random.Random(6)
    words = ["abbc", "ac", "abc", "axcde", "abde", "color", "colour", "kinase7", "heat shock", "heat", "xxyz", "xyz", "foobaz", "bar", "zz", "p.q", "pxq", "a.b", "STRASSE", "strasse", "STRAßE", "a|b", "xbcd", "enddding", "KINASE9", "AB\nC"]
    values = [" ".join(r.sample(words, r.randint(0, 4))).title() if i % 3 else r.choice(words) for i in range(150)] + [None, ""]
    table = [(f"r{i}", "F", m, p) for m in ("regex", "contains", "exact") for i, p in enumerate(PATTERNS) if p or m == "contains"]
    rule_table = rules.normalize_rules(spark.createDataFrame(table, "rule_id string, family_id string, match_mode string, pattern string")).withColumn(
        "evidence_type", F.lit("seed"))
    seeds = spark.createDataFrame([(v,) for v in values if v], "gene_id string")
    got = rows(rules.seed_evidence(seeds, rule_table), "gene_id", "rule_id")
    plain = seeds.distinct().crossJoin(rule_table).filter(F.when(F.col("match_mode") == "regex", F.rlike("gene_id", F.concat(F.lit("(?i)"), "pattern"))).when(
        F.col("match_mode") == "exact", F.lower("gene_id") == F.lower("pattern")).otherwise(F.contains(F.lower("gene_id"), F.lower("pattern"))))
    assert got == rows(plain, "gene_id", "rule_id") and len(got) > 300


def test_thousands_of_pattern_rules_in_one_pass(spark):
    n = 5000
    table = spark.createDataFrame([(f"F{i}", f"word{i:05d}x" if i % 2 else f"^.*wo.d{i:05d}x", "contains" if i % 2 else "regex", "note") for i in range(n)],
                                  "family_id string, pattern string, match_mode string, field string")
    ann = spark.createDataFrame([(f"t{k}", f"a Word{k * 3:05d}X, and word{k:05d}x") for k in range(400)] + [("none", None)], "transcript_id string, note string")
    found = rules.annotation_evidence(ann, rules.normalize_rules(table))
    scans = [x for x in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "note#" in x and "LogicalRDD" in x]
    assert len(scans) == 1
    assert rows(found, "gene_id", "family_id") == sorted({(f"t{k}", f"F{x}") for k in range(400) for x in (k, 3 * k)})


def test_rules_of_no_rows(spark):
    none = rules.normalize_rules(spark.createDataFrame([], "family_id string, pattern string"))
    ann = spark.createDataFrame([("t", "x")], "transcript_id string, note string")
    assert rules.annotation_evidence(ann, none).count() == 0
    assert rules.evidence_summary(rules.annotation_evidence(ann.limit(0), none)).count() == 0


def test_missing_inputs_are_named(spark):
    evidence = spark.createDataFrame([("g", "F", "fam", "pfam")], "gene_id string, family_id string, family_name string, evidence_type string")
    out = families.family_evolution(evidence).first()
    assert (out.evolution_status, out.missing_data_note) == ("missing", "orthogroups;family_gain_loss")
    cands = spark.createDataFrame([("q", "bac", "tax", 1.0, 2.0)], "query_id string, best_donor_group string, best_donor_taxon string, alien_index double, bitscore_delta double")
    whole = families.candidate_integration(cands).first()
    assert whole.missing_data_note == "family_gain_loss;orthogroup_assignment;orthogroups;refined_donors;target_evidence"
    assert hits.refine_donors(cands).first().refined_donor_rank == "group"


def test_candidate_proteins(spark, put):
    inputs = hits.orthogroup_inputs(spark.createDataFrame([("g1", "Bac teria"), ("g2", "NA"), ("g1", "Bac teria")], "query_id string, AI_taxon string"))
    assert rows(inputs, "orthofinder_id") == [("g1--Bac_teria",), ("g2--NA",)]
    proteins = fasta.read_fasta(spark, put("p.fa", ">g1 x\nMK\n>zz\nMM\n"))
    found, absent = hits.candidate_proteins(inputs, proteins)
    assert rows(found) == [("g1--Bac_teria", "MK")] and rows(absent) == [("g2",)]


def test_families_without_evidence_are_target(spark):
    evidence = spark.createDataFrame([("g1", "F")], "gene_id string, family_id string")
    listed = spark.createDataFrame([("g1",), ("g2",)], "gene_id string")
    assert rows(matrices.family_map(evidence, listed)) == [("g1", "F"), ("g2", "target")]
    wide = spark.createDataFrame([("g1", "1.5", "x"), ("g2", "2", "3")], "gene_id string, s1 string, s2 string")
    details = matrices.gene_set_expression(matrices.long_expression(wide), matrices.family_map(evidence, listed))
    assert rows(details, "gene_id", "family_id", "sample", "expression_value") == [("g1", "F", "s1", 1.5), ("g2", "target", "s1", 2.0), ("g2", "target", "s2", 3.0)]
    matrix = matrices.expression_matrix(matrices.expression_summary(details))
    assert rows(matrix, "family_id", "s1", "s2") == [("F", 1.5, 0.0), ("target", 2.0, 3.0)]
    assert rows(matrices.status_matrix(spark.createDataFrame([("F", "gain"), ("G", "loss")], "f string, s string"), "f", "s")) == [("F", 1, 0), ("G", 0, 1)]


def test_contig_screen(spark):
    found = spark.createDataFrame([("c1", 0, 40, "bac"), ("c1", 30, 60, "bac"), ("c2", 0, 10, "bac")], "seqid string, start0 bigint, end0 bigint, lineage string")
    lengths = spark.createDataFrame([("c1", 100), ("c2", 100)], "seqid string, length bigint")
    bad = coverage.contaminated_contigs(found, lengths)
    assert rows(bad, "seqid", "covered_bp") == [("c1", 60)]
    assert rows(coverage.without_contigs(lengths, bad), "seqid") == [("c2",)]


def test_values_of_one_key_are_dealt(spark):
    """A rule that every value meets does not bring all values into one task, and keys that no rule waits under do not travel."""
    table = rules.normalize_rules(spark.createDataFrame([("F1", "seed", "1"), ("F2", "blast", "77"), ("F3", "blast", "abc")], "family_id string, evidence_type string, pattern string").withColumn(
        "match_mode", F.expr("if(family_id = 'F2', 'exact', 'contains')")).withColumn("field", F.lit("subject")))
    seeds = spark.range(3000).select(F.col("id").cast("string").alias("gene_id"))
    found = rules.seed_evidence(seeds, table)
    assert sorted(x.gene_id for x in found.collect()) == sorted(str(i) for i in range(3000) if "1" in str(i))
    hits = spark.range(500).select(F.col("id").alias("query_id"), F.when(F.col("id") % 5 == 0, "77").when(F.col("id") % 5 == 1, "xABCx").otherwise("7").alias("subject_id"),
                                   F.lit(0.0).alias("evalue"), F.lit(1.0).alias("bitscore"))
    by_family = {f: {int(x.gene_id) for x in rules.hit_evidence(hits, table).filter(F.col("family_id") == f).collect()} for f in ("F2", "F3")}
    assert by_family == {"F2": set(range(0, 500, 5)), "F3": set(range(1, 500, 5))}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "_share" in plan and "LeftSemi" not in plan


@pytest.mark.parametrize("few", [0, 64])
def test_few_rules_go_to_the_values(spark, monkeypatch, few):
    """Values are not shuffled for a few rules, whole lines are not made where none waits for them, and both ways to find keys agree."""
    monkeypatch.setattr(rules, "FEW", few, raising=False)
    table = rules.normalize_rules(spark.createDataFrame([("F1", "blast", "77", "exact"), ("F2", "keyword", "𝔸bc", "contains"), ("F3", "keyword", "é.xyz", "regex"), ("F4", "go", "GO:1", "token"), ("F5", "blast", "b7", "contains")],
        "family_id string, evidence_type string, pattern string, match_mode string").withColumn("field", F.expr("case family_id when 'F4' then 'terms' when 'F1' then 'subject' when 'F5' then 'subject' else 'note' end")))
    found = spark.range(200).select(F.col("id").alias("query_id"), F.expr("case id % 3 when 0 then '77' when 1 then 'aB77' end").alias("subject_id"), F.lit(0.0).alias("evalue"), F.lit(1.0).alias("bitscore"))
    out = rules.hit_evidence(found, table)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "concat_ws" not in plan
    assert rows(out, "gene_id", "family_id") == sorted([(str(i), "F1" if i % 3 == 0 else "F5") for i in range(200) if i % 3 < 2])
    ann = spark.createDataFrame([("t1", "x𝔸BCé", "GO:1, NA"), ("t2", "É𝔸xyz", "GO:12"), ("t3", "bc", None), ("t4", "é𝔸𝔸xyz", "go:1"), ("t5", None, ""), ("NA", "𝔸bc", "GO:1")], "transcript_id string, note string, terms string")
    assert rows(rules.annotation_evidence(ann, table), "gene_id", "family_id") == [("t1", "F2"), ("t1", "F4"), ("t4", "F4")]
