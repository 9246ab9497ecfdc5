import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociframe.operators import coverage, intervals, regions


def make(spark, spans, names="seqid string, start0 bigint, end0 bigint"):
    return spark.createDataFrame(spans, names)


def random_spans(seed, n=300, size=3000, longest=400):
    r = random.Random(seed)
    out = []
    for _ in range(n):
        s = r.randrange(size)
        # A third of all rows sits on one spot.
        if r.random() < 0.33:
            s = 777
        out.append((r.choice(["a", "b"]), s, s + r.randrange(0, longest)))
    return out


def covered(spans):
    return {(q, p) for q, s, e in spans for p in range(s, e)}


@pytest.mark.parametrize("bin_size", [7, 64, 1 << 16])
def test_merge_equals_base_set(spark, bin_size):
    spans = random_spans(1)
    merged = [tuple(r) for r in intervals.merge_intervals(make(spark, spans), bin_size=bin_size).collect()]
    assert covered(merged) == covered(spans)
    assert sum(e - s for _, s, e in merged) == len(covered(spans))
    by_seq = sorted(merged)
    assert all(a[0] != b[0] or a[2] < b[1] for a, b in zip(by_seq, by_seq[1:]))


def test_touching_intervals_join(spark):
    out = intervals.merge_intervals(make(spark, [("a", 0, 5), ("a", 5, 9), ("a", 10, 11), ("a", 3, 3)]))
    assert rows(out) == [("a", 0, 9), ("a", 10, 11)]


def test_covered_length_by_key(spark):
    spans = random_spans(2)
    out = dict(rows(intervals.covered_length(make(spark, spans), bin_size=50)))
    for q in "ab":
        assert out[q] == len({x for x in covered(spans) if x[0] == q})


def brute_pairs(left, right):
    return [(a, b) for a in left for b in right if a[0] == b[0] and a[1] < b[2] and b[1] < a[2] and a[2] > a[1] and b[2] > b[1]]


def mixed_spans(seed, n, size):
    """Lengths from 1 to 10 ** 7 in one table, a third of them on one spot."""
    r = random.Random(seed)
    out = []
    for _ in range(n):
        start = size // 2 if r.random() < 0.33 else r.randrange(-1000, size)
        out.append((r.choice(["a", "b"]), start, start + int(10 ** r.uniform(0, 7)) - r.choice([0, 0, 1])))
    return out + [("a", 5, 5), ("a", 9, 3), (None, 1, 50), ("b", 511, 512), ("b", 512, 1024), ("b", 0, 512), ("b", 0, 4096), ("b", 4095, 4097)]


@pytest.mark.parametrize("spans", [(random_spans(3, 120), random_spans(4, 150)), (mixed_spans(1, 300, 20_000_000), mixed_spans(2, 300, 20_000_000)),
                                   (mixed_spans(3, 200, 5000), random_spans(5, 200)), (random_spans(6, 200), mixed_spans(4, 200, 5000))])
def test_overlap_join_equals_inequality_join(spark, spans):
    left, right = spans
    found = intervals.overlap_join(make(spark, left), make(spark, right, "seqid string, other_start0 bigint, other_end0 bigint"))
    expected = [(a[0], a[1], a[2], b[1], b[2], min(a[2], b[2]) - max(a[1], b[1])) for a, b in brute_pairs([x for x in left if x[0]], right)]
    got = [(r.seqid, r.start0, r.end0, r.other_start0, r.other_end0, r.overlap_bp) for r in found.collect()]
    assert sorted(got) == sorted(expected)


def test_long_intervals_touch_few_cells(spark):
    """A chromosome-long interval beside many short ones: two cells for itself, and short ones wait only where it is."""
    whole = [("a", 0, 10_000_000)]
    short = [("a", k * 1000, k * 1000 + 10) for k in range(2000)]
    found = intervals.overlap_join(make(spark, whole + short), make(spark, short, "seqid string, other_start0 bigint, other_end0 bigint"))
    joined = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Cartesian" not in joined
    assert found.count() == 2000 + 2000


def test_copies_for_cells_build_no_arrays_of_structures(spark):
    """An interval's cells are rows of a generator; long ones on either side still meet short ones once."""
    left = [("a", 0, 5000), ("a", 700, 710), ("b", 0, 10), (None, 0, 10)]
    right = [("a", 400, 1200), ("a", 705, 706), ("a", 4999, 70_000), ("b", 10, 20), (None, 0, 10)]
    found = intervals.overlap_join(make(spark, left), make(spark, right, "seqid string, other_start0 bigint, other_end0 bigint"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "flatten" not in plan and "struct" not in plan
    assert rows(found, "start0", "other_start0", "overlap_bp") == [(0, 400, 800), (0, 4999, 1), (0, 705, 1), (700, 400, 10), (700, 705, 1)]


def test_synteny_details_shuffle_distinct_genes_once(spark):
    """The levels of cells are read from the shuffle of distinct genes that the pairs come from."""
    genes = make(spark, [("a", 5, 15, "g"), ("a", 5, 15, "g"), (None, 5, 15, "g"), ("a", 8, 8, "g"), ("a", 90, 95, "h")], "seqid string, start0 bigint, end0 bigint, gene_id string")
    links = spark.createDataFrame([("g", 2), ("h", 0)], "gene_id string, links bigint")
    table = make(spark, [("a", 0, 10, "target", 1), ("a", 14, 20, "background", 2), ("a", 80, 99, "target", 3)], "seqid string, start0 bigint, end0 bigint, region_set string, region_id int")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = regions.region_synteny_details(table, genes.distinct(), links)
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = rows(found, "region_id", "gene_id", "synteny_links")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == [(1, "g", 2), (2, "g", 2)]
    assert "ReusedExchange" in plan


@pytest.mark.parametrize("bin_size", [32, 1 << 16])
def test_overlap_totals_equal_pair_sums(spark, bin_size):
    left = [(q, s, e + 1) for q, s, e in random_spans(5, 100)]
    right = random_spans(6, 150)
    table = make(spark, [(*x, i) for i, x in enumerate(left)], "seqid string, start0 bigint, end0 bigint, i int")
    found = intervals.overlap_totals(table, make(spark, right), {"n": F.lit(1), "w": F.col("start0") + 1}, bin_size=bin_size)
    got = {r.i: (r.n, r.w) for r in found.collect()}
    for i, a in enumerate(left):
        mine = [b for x, b in brute_pairs([a], right)]
        assert got[i] == (len(mine), sum(b[1] + 1 for b in mine))


def test_shared_bases_equal_pair_sums(spark):
    left, right = random_spans(7, 80), random_spans(8, 100)
    table = make(spark, [(*x, i) for i, x in enumerate(left)], "seqid string, start0 bigint, end0 bigint, i int")
    found = {r.i: r.t for r in regions.shared_bases(table, make(spark, right), {"t": F.lit(True)}).collect()}
    for i, a in enumerate(left):
        assert found[i] == sum(min(a[2], b[2]) - max(a[1], b[1]) for _, b in brute_pairs([a], right))


def test_enrichment_counts_repeated_region_ids_once(spark):
    region = spark.createDataFrame(
        [("target", "r", "a", 0, 10), ("target", "r", "a", 5, 15), ("background", "b", "a", 100, 110)],
        "region_set string, region_id string, seqid string, start0 bigint, end0 bigint")
    feature = spark.createDataFrame([("a", 3, 12, "t", "f1"), ("a", 8, 20, "t", "f2")], "seqid string, start0 bigint, end0 bigint, ftype string, feature_id string")
    out = {r.region_set: r for r in regions.region_enrichment(region, feature).collect()}
    target = out["target"]
    assert (target.region_bp, target.covered_bp, target.overlap_events, target.overlapping_features) == (20, 12, 4, 2)
    assert target.fold_enrichment_vs_background is None and target.qc_note == "background_has_zero_feature_coverage"
    assert out["background"].qc_note == "ok" and out["background"].overlap_events == 0
    alone = regions.region_enrichment(region, feature, with_background=False).collect()
    assert len(alone) == 1 and alone[0].qc_note == "ok"


def test_enrichment_of_no_regions(spark):
    region = spark.createDataFrame([], "region_set string, region_id string, seqid string, start0 bigint, end0 bigint")
    feature = spark.createDataFrame([("a", 3, 12, "t", "f1")], "seqid string, start0 bigint, end0 bigint, ftype string, feature_id string")
    out = regions.region_enrichment(region, feature, with_background=False).collect()[0]
    assert (out.region_count, out.coverage_fraction, out.qc_note) == (0, 0.0, "empty_region_set")


def test_scaled_bins_follow_the_strand(spark):
    region = spark.createDataFrame([("r", "a", 5, 15, "-")], "region_id string, seqid string, start0 bigint, end0 bigint, strand string")
    out = rows(intervals.scaled_bins(region, 10, (2, 2, 2)), "section", "bin_index", "bin_start0", "bin_end0")
    assert out == [("body", 1, 5, 10), ("body", 2, 10, 15), ("downstream", 1, 0, 2), ("downstream", 2, 2, 5), ("upstream", 1, 15, 20), ("upstream", 2, 20, 25)]


def test_binned_coverage_cuts_at_borders(spark):
    out = rows(coverage.binned_coverage(make(spark, [("a", 3, 12), ("a", 11, 14), ("a", 18, 21)]), 10), "start", "end", "covered_bp")
    assert out == [(0, 9, 7), (10, 19, 6), (20, 29, 1)]


def test_domain_without_coordinates(spark):
    domains = spark.createDataFrame([("d", None, None, None, "C")], "domain_id string, seqid string, start0 bigint, end0 bigint, domain_type string").select(
        "*", *[F.lit("NA").alias(c) for c in ("class_path", "class_level_1", "class_level_2", "class_level_3")])
    target = make(spark, [("a", 0, 10)])
    out = regions.domains_by_region(domains, target, details=True).collect()[0]
    assert (out.region_status, out.overlap_bp) == ("missing_coordinates", 0)


def test_windows(spark):
    lengths = spark.createDataFrame([("a", 25)], "seqid string, length bigint")
    assert rows(intervals.tile_windows(lengths, 20, 10), "start0", "end0") == [(0, 20), (10, 25), (20, 25)]
    points = spark.createDataFrame([("a", 0, 1), ("a", 12, 2), ("a", 24, 4)], "seqid string, pos0 bigint, v bigint")
    assert rows(intervals.windowed_sum(points, ["v"], 20, 10), "start0", "v") == [(0, 3), (10, 6), (20, 4)]
    assert rows(intervals.windowed_sum(points, ["v"], 15, 10), "start0", "v") == [(0, 3), (10, 6), (20, 4)]


def test_plans_have_no_nested_loops(spark):
    left = make(spark, [("a", 0, 10)])
    right = make(spark, [("a", 5, 15)], "seqid string, other_start0 bigint, other_end0 bigint")
    for df in (intervals.overlap_join(left, right), intervals.merge_intervals(left), intervals.overlap_totals(left, left, {"n": F.lit(1)})):
        plan = df._jdf.queryExecution().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "ArrowEvalPython" not in plan


@pytest.mark.parametrize("scheme", [(2, 5, 2), (0, 1, 3), (4, 2, 0), (0, 1, 0)])
def test_methylation_totals_equal_the_profile(spark, scheme):
    r = random.Random(8)
    spans = [(q, s, e, i // 2, r.choice("+-.")) for i, (q, s, e) in enumerate(random_spans(9, 120))]
    table = spark.createDataFrame(spans, "seqid string, start0 bigint, end0 bigint, region_id int, strand string")
    sites = [(r.choice("abc"), r.randrange(5000), r.choice(["CG", "CHG", "CHH", "x"]), m := r.randrange(9), m + r.randrange(5)) for _ in range(2000)]
    points = spark.createDataFrame(sites, "seqid string, pos0 bigint, context string, methylated bigint, total bigint")
    columns = ("context", "regions", "covered_sites", "methylated_counts", "total_counts", "methylation_level", "qc_note", "region_set")
    for contexts in (("CG", "CHG", "CHH"), ("CG", "none")):
        profile = regions.methylation_profile(table, points, scheme, 300, 2, contexts)
        assert rows(regions.methylation_totals(table, points, scheme, 300, 2, contexts), *columns) == rows(regions.methylation_summary(profile), *columns)
    assert regions.methylation_totals(table.limit(0), points, scheme).count() == 0


def test_region_synteny_counts_all_pairs(spark):
    from lociframe.operators import regions

    r = random.Random(5)
    sets = ["target", "background", "target", "other"]
    places = [(sets[i % 4], i // 2, r.choice(["c1", "c2", "c3"]), s, s + r.randrange(1, 40)) for i in range(60) for s in [r.randrange(0, 200_000, 17)]]
    places.append(("target", 999, None, 5, 9))
    genes = [(r.choice(["c1", "c2"]), s, s + r.randrange(1, 5000), f"g{i % 50}") for i in range(150) for s in [r.randrange(0, 200_000, 13)]]
    links = {f"g{i}": i % 4 for i in range(45)}
    found = regions.region_synteny(
        spark.createDataFrame(places, "region_set string, region_id int, seqid string, start0 bigint, end0 bigint"),
        spark.createDataFrame(genes, "seqid string, start0 bigint, end0 bigint, gene_id string"), spark.createDataFrame(list(links.items()), "gene_id string, links bigint"))
    pairs = [(p, g) for p in places for g in genes if links.get(g[3]) and p[2] == g[0] and p[3] < g[2] and g[1] < p[4]]
    got = {x.region_set: (x.regions, x.synteny_links, x.covered_target_regions, x.syntenic_genes) for x in found.collect()}
    for name in set(sets):
        mine = [(p, g) for p, g in pairs if p[0] == name]
        expected = (sum(p[0] == name for p in places), sum(links[g[3]] for _, g in mine), len({p[1] for p, _ in mine}), len({g[3] for _, g in mine}))
        assert got[name][:3] == expected[:3] and (name == "other" or got[name][3] == expected[3])
