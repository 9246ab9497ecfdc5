import random
import statistics
from math import comb

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lociframe.operators import terms
from lociframe.functions.stats import hypergeometric_tail
from lociframe.operators.scans import range_parts, running
from lociframe.operators.summaries import benjamini_hochberg, grouped_median, length_histogram, median_candidates, nx_statistics


def exact_tail(a, b, c, d):
    n, draws, marked = a + b + c + d, a + b, a + c
    return min(1.0, sum(comb(marked, x) * comb(n - marked, draws - x) for x in range(a, min(draws, marked) + 1)) / comb(n, draws))


def test_tail_matches_exact_integers(spark):
    r = random.Random(1)
    tables = [(0, 5, 5, 90), (5, 0, 0, 95), (3, 2, 4, 91), (0, 0, 3, 4), (50, 450, 60, 4000), (900, 100, 100, 900), (10, 990, 500, 98500)]
    tables += [tuple(r.randrange(0, 40) for _ in range(3)) + (r.randrange(1, 400),) for _ in range(40)]
    df = spark.createDataFrame(tables, "a bigint, b bigint, c bigint, d bigint")
    for row in df.select("*", hypergeometric_tail(*[F.col(x) for x in "abcd"]).alias("p")).collect():
        assert row.p == pytest.approx(exact_tail(row.a, row.b, row.c, row.d), rel=1e-8, abs=1e-290)


def test_false_discovery_rates(spark):
    p = [0.01, 0.02, 0.02, 0.5, 0.04, 1.0]
    out = benjamini_hochberg(spark.createDataFrame([(i, x) for i, x in enumerate(p)], "i int, p double"), "p", "q").collect()
    ranked = sorted(range(len(p)), key=lambda i: p[i])
    expected, last = {}, 1.0
    for rank in range(len(p), 0, -1):
        i = ranked[rank - 1]
        last = min(last, p[i] * len(p) / rank)
        expected[i] = last
    assert {r.i: pytest.approx(r.q) for r in out} == expected


def test_median_of_dominant_group(spark):
    r = random.Random(2)
    data = [("big", r.choice([1.0, 2.5, 7.25, r.random() * 100])) for _ in range(1001)] + [("one", 4.0), ("two", 1.0), ("two", 2.0)]
    got = dict(rows(grouped_median(spark.createDataFrame(data, "k string, v double"), ["k"], "v", "m")))
    for k in ("big", "one", "two"):
        assert got[k] == statistics.median(v for key, v in data if key == k)


def test_nx(spark):
    lengths = [10, 10, 10, 5, 5, 40, 3]
    out = nx_statistics(spark.createDataFrame([(x,) for x in lengths], "length bigint"), [], "length").collect()[0]
    for share, n, l in ((0.5, out.N50, out.L50), (0.9, out.N90, out.L90)):
        acc = 0
        for i, x in enumerate(sorted(lengths, reverse=True), 1):
            acc += x
            if acc >= sum(lengths) * share:
                assert (n, l) == (x, i)
                break


def test_histogram_zero_row(spark):
    out = rows(length_histogram(spark.createDataFrame([("a", 0), ("a", 9), ("a", 10)], "k string, v bigint"), ["k"], "v", 10, True), "bin_start", "raw_count", "total_count")
    assert out == [(0, 0, 3), (0, 2, 3), (10, 1, 3)]


def test_counts_of_a_group_of_many_members(spark):
    pairs = spark.range(200_000).selectExpr("'big' as term_id", "cast(id as string) as gene_id").unionByName(spark.createDataFrame([("small", "a"), ("small", "a")], "term_id string, gene_id string"))
    assert rows(terms.term_counts(pairs)) == [("big", 200_000), ("small", 1)]
    assert rows(terms.architecture_frequency(pairs.select(pairs.term_id.alias("domain_architecture"), pairs.gene_id.alias("query_id"))), "domain_architecture", "gene_count") == [("big", 200_000), ("small", 2)]
    assert terms.unmapped_terms(pairs.withColumnRenamed("term_id", "ko_id"), spark.createDataFrame([("small",)], "ko_id string")).count() == 200_000


@pytest.fixture
def many_ranges(spark):
    """Adaptive execution would put these few rows into one range."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("how", ["sum", "min", "max"])
@pytest.mark.parametrize("keys", [[], ["k"]])
def test_running_over_ranges(spark, many_ranges, how, keys):
    r = random.Random(4)
    data = [(r.choice("aaab"), x, r.randrange(-50, 50)) for x in r.sample(range(10**6), 900)]
    parts = range_parts(spark.createDataFrame(data, "k string, x bigint, v bigint").repartition(3), ["x"], keys)
    assert parts.select("_part").distinct().count() > 1
    fold = {"sum": sum, "min": min, "max": max}[how]
    for backwards in (False, True):
        for exclusive in (False, True):
            order = [F.col("x").desc() if backwards else F.col("x")]
            out = running(parts, order, {"a": F.col("v"), "b": F.col("v") * 2}, keys, how, backwards, exclusive).collect()
            got = {(d.k, d.x): (d.a, d.b) for d in out}
            assert len(got) == 900
            seen = {}
            for k, x, v in sorted(data, key=lambda d: d[1], reverse=backwards):
                past = seen.setdefault(k if keys else None, [])
                if not exclusive:
                    past.append(v)
                want = fold(past) if past else 0 if how == "sum" else None
                assert got[k, x] == (want, want if want is None else 2 * want)
                if exclusive:
                    past.append(v)


def test_rates_of_many_levels_and_sets(spark, many_ranges):
    r = random.Random(5)
    data = [(i, r.choice("xxy"), r.choice([r.random(), 0.25, 1e-300])) for i in range(3000)]
    out = benjamini_hochberg(spark.createDataFrame(data, "i int, s string, p double"), "p", "q", ["s"]).collect()
    assert len(out) == 3000
    for s in "xy":
        mine = sorted((d for d in data if d[1] == s), key=lambda d: -d[2])
        low, expected = 1.0, {}
        for rank, d in zip(range(len(mine), 0, -1), mine):
            low = min(low, d[2] * len(mine) / rank)
            expected[d[0]] = low
        assert {d.i: pytest.approx(d.q) for d in out if d.s == s} == expected


def test_scans_of_no_rows(spark):
    none = spark.createDataFrame([], "p double")
    assert benjamini_hochberg(none, "p", "q").count() == 0
    assert nx_statistics(none, [], "p").collect()[0].N50 is None


def test_no_ordered_window_over_a_whole_table(spark):
    df = spark.createDataFrame([(x / 100,) for x in range(100)], "p double")
    for plan in (benjamini_hochberg(df, "p", "q"), nx_statistics(df, [], "p")):
        windows = [line for line in plan._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Window [" in line]
        assert windows and all("_part" in line for line in windows)


@pytest.mark.parametrize("outlier", [1e12, -1e300, 0.5])
def test_median_orders_few_values_of_a_skewed_group(spark, outlier):
    df = spark.range(300_000).select(F.lit("big").alias("k"), F.rand(3).alias("v")).union(spark.createDataFrame([("big", outlier), ("small", 2.0)], "k string, v double"))
    df = df.repartition(4, "v")
    few = median_candidates(df, ["k"], "v").filter("k = 'big'")
    assert 0 < few.count() <= 300_000 / 16
    got = dict(rows(grouped_median(df, ["k"], "v", "m")))
    assert got == {"big": statistics.median(r.v for r in df.filter("k = 'big'").collect()), "small": 2.0}


def test_median_of_few_and_equal_values(spark):
    data = [("a", 1.0)] * 4 + [("b", 1.0), ("b", 3.0), ("c", None), ("d", 1.0), ("d", 1.0), ("d", 9.0), ("d", 10.0)] + [("e", float(x)) for x in range(7)]
    got = dict(rows(grouped_median(spark.createDataFrame(data, "k string, v double"), ["k"], "v", "m")))
    assert got == {"a": 1.0, "b": 2.0, "d": 5.0, "e": 3.0}


def test_pathways_of_a_gene_meet_where_the_gene_is(spark):
    r = random.Random(8)
    kos = [(f"g{r.randrange(40)}", f"K{r.randrange(12)}") for _ in range(300)]
    mapping = [(f"K{r.randrange(14)}", f"P{r.randrange(6)}") for _ in range(40)]
    genes = spark.createDataFrame([*kos, ("g0", None)], "gene_id string, ko_id string")
    ko_map = spark.createDataFrame(mapping, "ko_id string, pathway_id string")
    counts = terms.pathway_counts(genes, ko_map)
    expected = {}
    for g, k in kos:
        for k2, p in mapping:
            if k == k2:
                expected.setdefault(p, (set(), set()))
                expected[p][0].add(g)
                expected[p][1].add(k)
    assert rows(counts, "pathway_id", "gene_count", "ko_count") == sorted((p, len(g), len(k)) for p, (g, k) in expected.items())
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and "hashpartitioning(gene_id" in plan
