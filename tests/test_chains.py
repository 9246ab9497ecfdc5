from conftest import rows
from pyspark.sql import functions as F

from lociframe.plans import chains
from lociframe.session import checkpoint_dir, durable
from lociframe.sources import gff, lines, reports

GFF = "c1\ts\tgene\t1\t100\t.\t+\t.\tID=g1\nc1\ts\tmRNA\t1\t100\t.\t+\t.\tID=t1;Parent=g1\nc1\ts\texon\t1\t20\t.\t+\t.\tParent=t1\nc1\ts\texon\t71\t100\t.\t+\t.\tParent=t1\n"


def test_functional_annotation(spark, put):
    features = gff.read_gff(spark, put("a.gff", GFF))
    domains = reports.read_interproscan(spark, put("i.tsv", "t1\tm\t9\tPfam\tPF1\td\t1\t9\t1\tT\td\tIPR1\tn\tGO:1|GO:2\n"))
    egg = reports.read_eggnog(spark, put("e.tsv", "## x\n#query\tseed_ortholog\tCOG_category\tKEGG_ko\nt1\to\tK\tko:K1,ko:K2\n"))
    ko_map = spark.createDataFrame([("K1", "p1")], "ko_id string, pathway_id string")
    fg = spark.createDataFrame([("t1",)], "gene_id string")
    out = chains.functional_annotation(features, domains=domains, orthologs=egg, ko_map=ko_map, foreground=fg, keep=True)
    row = out["annotation"].first()
    assert (row.transcript_id, row.gene_id, row.Pfam_ids, row.GO_terms, row.KEGG_ko, row.Kofam_ko) == ("t1", "g1", "PF1", "GO:1;GO:2", "ko:K1,ko:K2", None)
    assert rows(out["go_counts"], "term_id", "gene_count") == [("GO:1", 1), ("GO:2", 1)]
    assert rows(out["pathway_counts"], "pathway_id", "ko_count") == [("p1", 1)] and rows(out["gene_pathways"], "ko_id") == [("K1",)] and rows(out["unmapped"], "ko_id") == [("K2",)]
    assert rows(out["category_counts"], "category", "proportion") == [("K", 1.0)]
    assert rows(out["architectures"], "domain_architecture") == [("PF1",)]
    tested = out["go_enrichment"].select("term_id", F.round("p_value", 9), F.round("q_value", 9))
    assert rows(tested) == [("GO:1", 1.0, 1.0), ("GO:2", 1.0, 1.0)] and rows(out["go_foreground"]) == [("GO:1", "t1"), ("GO:2", "t1")]
    assert chains.go_handoff(out["go_enrichment"]).count() == 0


def test_candidate_screen(spark, put):
    head = "#Query_id\tself_e\tBac\tai\tAI_taxon\tself_b\tBac\tdelta\tdpct\tratio\th_taxon\tdonor_b\tn\n"
    table = reports.read_lineage_table(spark, put("l.tsv", head + "t1\t1\t1e-9\t40\tBac\t1\t90\t50\t1\t1\tBac\t90\t2\nt9\t1\t1\t1\tBac\t1\t9\t5\t1\t1\tBac\t9\t2\n"))
    out = chains.candidate_screen(table, gff.read_gff(spark, put("a.gff", GFF)), "Plant", ["bac"])
    assert rows(out["candidates"], "query_id") == [("t1",)] and rows(out["counts"]) == [("candidate", 1), ("rejected", 1)]
    assert rows(out["context"], "seqid", "start", "synteny_support_status", "validation_priority", "missing_data_note") == [
        ("c1", 1, "not_tested", "high", "functional_annotation;intron_details;synteny")]


def test_transfer_events(spark):
    lineage = spark.createDataFrame([("sp1", "a", "5", "bacteria", "bacteria"), ("sp1", "b", "5", "Fungi", "x")],
                                    "species string, query_id string, alien_index string, alien_index_taxon string, h_taxon string")
    members = spark.createDataFrame([("OG1", "a"), ("OG1", "b"), ("OG2", "c")], "family_id string, gene_id string")
    counts = spark.createDataFrame([("OG1", "n1", 2), ("OG1", "root", 1), ("OG2", "n1", 1)], "family_id string, species string, copies bigint")
    nodes = spark.createDataFrame([("n1", "root")], "node string, parent string")
    species = spark.createDataFrame([("sp1",), ("later",)], "species string")
    groups = spark.createDataFrame([("H1", "c", "virus")], "group_id string, gene_id string, source string")
    out = chains.transfer_events(lineage, species, members, counts, nodes, ["bacteria", "Fungi"], groups=groups)
    assert rows(out["matrix"], "condition", "species", "total") == [("Condition1", "later", 0), ("Condition1", "sp1", 2), ("Condition2", "later", 0), ("Condition2", "sp1", 1)]
    assert rows(out["event_summary"], "node", "expansion", "total", "hgt_gain_expansion") == [("n1", 1, 1, 1)]
    assert rows(out["mapped_event_summary"], "gain") == [(1,)] and rows(out["source_handoff"], "donor_group") == [("bacteria",)]


def test_region_chains(spark, put):
    target = put("t.bed", "c1\t0\t50\tr1\nc1\t40\t60\tr2\n")
    out = chains.enrichment_from_files(spark, target, put("a.gff", GFF), "gff", None, ["exon"])
    row = out["enrichment"].first()
    assert (row.region_bp, row.covered_bp, row.overlap_events, row.fold_enrichment_vs_background) == (70, 20, 1, None)
    assert rows(out["details"], "region_id", "feature_id", "overlap_bp") == [("r1", "exon_3", 20)]
    regions = gff.read_bed(spark, target, "target")
    sites = reports.read_cx(spark, put("m", "c1\t5\t+\t1\t1\tCG\tCGA\n"))
    both = chains.region_context(regions, gff.overlap_features(gff.read_gff(spark, put("a.gff", GFF))), sites, (1, 1, 1), 10)
    assert rows(both["profile_summary"], "context", "covered_sites", "qc_note") == [("CG", 1, "ok"), ("CHG", 0, "no_covered_sites"), ("CHH", 0, "no_covered_sites")]


def test_structure_and_introns(spark, put):
    features = gff.read_gff(spark, put("a.gff", GFF), "sp")
    out = chains.gene_structure(features)
    assert out["matrix"].filter("metric = 'introns'").first()["sp"] == 1
    assert rows(chains.intron_features(features)["short"], "length") == [(50,)]
    tracks = chains.coverage_tracks(features)
    assert rows(tracks["mRNA"], "start", "end", "covered_bp") == [(0, 4999, 100)]


def test_family_chains(spark, put):
    wide = lines.read_table(spark, put("c.tsv", "Orthogroup\tA\tB\nOG1\t1\t2\nOG2\t0\tx\n"), ordered=True)
    loss = spark.createDataFrame([("OG1", "n1", "1", "0")], "family_id string, node string, gain string, loss string")
    out = chains.family_changes(wide, ["A", "B"], loss)
    assert rows(out["accepted"], "Family ID") == [("OG1",)] and rows(out["rejected"], "reason") == [("invalid_count:B",)]
    assert rows(out["gain_loss"], "event_status", "total_copies") == [("gain", None)] and rows(out["nodes"], "node_label", "family_count", "total_gain") == [("n1", 1, 1.0)]
    peptides = {"sp": spark.createDataFrame([("g1", "MK")], "seqid string, seq string")}
    members = spark.createDataFrame([("OG1", "g1")], "family_id string, gene_id string")
    counts = spark.createDataFrame([("OG1", "A", 1), ("OG1", "B", 1)], "family_id string, species string, copies bigint")
    families = chains.gene_families(peptides, counts, ["A", "B"], members, members)
    assert rows(families["members"]) == [("OG1", "sp|g1")] and families["families"].first().single_copy_all_species


def test_target_family_and_integration(spark):
    ann = spark.createDataFrame([("t1", "PF1")], "transcript_id string, Pfam_ids string")
    from lociframe.operators.rules import normalize_rules
    table = normalize_rules(spark.createDataFrame([("F1", "PF1", "pfam", "Pfam_ids")], "family_id string, pattern string, evidence_type string, field string"))
    peptides = spark.createDataFrame([("zz", "MK")], "seqid string, seq string")
    out = chains.target_family(ann, table, peptides)
    assert rows(out["missing"]) == [("t1", "missing_from_peptide_fasta")] and out["peptides"].count() == 0
    cands = spark.createDataFrame([("t1", "bac", "tax", 1.0, 2.0)], "query_id string, best_donor_group string, best_donor_taxon string, alien_index double, bitscore_delta double")
    whole = chains.family_integration(cands, evidence=out["evidence"])
    assert rows(whole["integrated"], "target_family_status", "target_family_ids", "refined_donor_taxon") == [("target_family", "F1", "tax")]
    assert rows(whole["integrated_summary"], "category", "candidate_count")[0] == ("donor_group", 1)
    plots = chains.plot_matrices(candidates=whole["integrated"])
    assert rows(plots["candidates"]) == [("t1", 1)]


def test_repeat_and_synteny_chains(spark, put):
    repeats = reports.read_repeatmasker(spark, put("r.out", "1 10.0 0 0 c1 1 10 (0) + R L/x 1 2 3 1\n1 20.0 0 0 c1 11 15 (0) + R L/x 1 2 3 1\n"))
    out = chains.repeat_context(repeats=repeats, substitution_rate=1e-8)
    assert rows(out["divergence_summary"], "copies", "covered_bp", "median_divergence", "mean_insertion_time_mya") == [(2, 15, 15.0, 7.5)]
    links = reports.read_synteny(spark, put("a.anchors", "###\na b 1\nc d 2\n"), "anchor", "x.y")
    genes = spark.createDataFrame([("c1", 0, 10, "a")], "seqid string, start0 bigint, end0 bigint, gene_id string")
    regions = gff.read_bed(spark, put("t.bed", "c1\t5\t20\tr\n"), "target")
    syn = chains.synteny_context(links, regions, genes)
    assert rows(syn["heatmap"]) == [("x", 0.0, 1.0), ("y", 1.0, 0.0)]
    assert rows(syn["regions"], "syntenic_genes", "synteny_links", "covered_target_regions") == [(1, 1, 1)]


def test_durable_uses_the_named_folder(spark):
    folder = checkpoint_dir(spark)
    kept = durable(spark.range(5).withColumn("x", F.col("id") * 2))
    assert spark.sparkContext.getCheckpointDir() == folder and kept.agg(F.sum("x")).first()[0] == 20
