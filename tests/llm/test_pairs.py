"""Shingle join, components, repeated passages."""
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import components, jaccard_join, paragraph_dedup
from lociframe.llm.jaccard_join import joined

from .helpers import SCHEMA, awkward, frame, groups, links, prose, shingles


def expected_links(rows):
    texts = [r[1] for r in rows]
    edges = links(texts)
    head = groups(len(rows), edges)
    count = [0] * len(rows)
    for a, b in edges:
        count[a] += 1
        count[b] += 1
    best = {}
    for i, h in enumerate(head):
        ids = [x for x in (best.get(h), rows[i][0]) if x is not None]
        best[h] = min(ids) if ids else None
    return sorted([(repr(r[0]), len(shingles(r[1])), repr(best[head[i]] if shingles(r[1]) else r[0]), count[i]) for i, r in enumerate(rows)])


@pytest.mark.parametrize("block", [4_000_000, 150])
def test_join_matches_brute_force(spark, block):
    rows = [r for r in awkward(2) if len(r[1] or "") < 20_000]
    got = jaccard_join.link(frame(spark, rows), block_hashes=block).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.n_links) for r in got) == expected_links(rows)


@pytest.mark.parametrize("block", [4_000_000, 2_000])
def test_group_of_near_copies(spark, block):
    rng = random.Random(7)
    base = prose(rng, 120).split(" ")
    rows = []
    for i in range(120):
        words = list(base)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
        rows.append((i, " ".join(words), *[None] * 8))
    got = jaccard_join.link(frame(spark, rows), block_hashes=block).collect()
    assert sorted((repr(r.doc_id), r.n_shingles, repr(r.component_id), r.n_links) for r in got) == expected_links(rows)


def test_join_of_no_rows(spark):
    assert jaccard_join.link(spark.createDataFrame([], SCHEMA)).count() == 0


def test_skipping_finds_all_pairs():
    rng = np.random.default_rng(5)
    base = rng.choice(10**9, 60, replace=False)
    sets = [np.unique(np.concatenate([rng.choice(base, rng.integers(30, 60), replace=False), rng.choice(10**9, rng.integers(0, 8))])) for _ in range(150)]
    sets.sort(key=len)
    n = np.array([len(s) for s in sets])
    got = {(q, int(z)) for q, hits in joined(sets, n, sets, n) for z in hits}
    plain = {(a, b) for a in range(150) for b in range(150) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b]))}
    assert got == plain


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200), (None, 3)]
    rng.shuffle(edges)
    got = {r.id: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bands_reach_the_recall():
    for similarity in (0.5, 0.75, 0.9):
        n, r = paragraph_dedup.bands(similarity, 0.9)
        assert 1 - (1 - similarity**r) ** n >= 0.9


def test_passages_are_found_and_clean_documents_left(spark):
    rng = random.Random(11)
    texts = [prose(rng, 150) for _ in range(60)]
    passages = [prose(rng, 60), prose(rng, 80)]
    planted = {}
    for i in range(0, 24):
        at = rng.randrange(len(texts[i]))
        p = passages[i % 2]
        if i % 4 == 3:  # one word changed
            words = p.split(" ")
            words[5] = "edited"
            p = " ".join(words)
        texts[i] = texts[i][:at] + " " + p + " " + texts[i][at:]
        planted[i] = p
    rows = [(i, t, *[None] * 8) for i, t in enumerate(texts)] + [(None, None, *[None] * 8), (70, "", *[None] * 8), (71, texts[30], *[None] * 8)]
    got = paragraph_dedup.repeated_passages(frame(spark, rows)).collect()
    touched = {r.doc_id for r in got} | {r.other_doc_id for r in got}
    assert touched == {*planted, 30, 71}
    assert {r.doc_id for r in got}.isdisjoint({0, 1, 30})
    for r in got:
        if r.doc_id in planted:
            removed = texts[r.doc_id][r.start : r.end]
            assert removed.split(" ", 1)[1][:-1] in planted[r.doc_id] or len(set(removed.split()) & set(planted[r.doc_id].split())) > 0.75 * len(set(removed.split()))
    assert len({(r.doc_id, r.start) for r in got}) == len(got)


def test_passages_of_awkward_rows(spark):
    rows = awkward(3)
    got = paragraph_dedup.repeated_passages(frame(spark, rows)).collect()
    ids = {r.doc_id for r in got} | {r.other_doc_id for r in got}
    assert {10, 11, 12, 13, 14} <= ids
    assert all(r.start < r.end for r in got)
    assert paragraph_dedup.repeated_passages(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("marked", [False, True])
def test_whole_passages_are_found_from_any_word(spark, marked):
    rng = random.Random(23)
    words = lambda n: prose(rng, n).split() if marked else [f"w{rng.randrange(10**9)}" for _ in range(n)]
    rows, planted = [], {}
    for i in range(80):
        passage = words(32 + 10 * (i % 3))
        for k in (2 * i, 2 * i + 1):
            before, after = ([f"x{k}", *words(60), f"y{k}"] for _ in range(2))
            rows.append((k, " ".join([*before, *passage, *after]), *[None] * 8))
            planted[k] = (len(" ".join(before)) + 1, len(" ".join([*before, *passage])))
    got = paragraph_dedup.repeated_passages(frame(spark, rows)).collect()
    assert sorted((r.doc_id, r.other_doc_id) for r in got) == [(k, k - 1) for k in range(1, 160, 2)]
    # Similar sentences at the edges may add some words where there are sentences.
    for r in got:
        start, end = planted[r.doc_id]
        assert 0 <= start - r.start <= 100 * marked and 0 <= r.end - end <= 100 * marked


def test_equal_paragraphs_share_a_key_whatever_their_kind():
    rng = random.Random(5)
    fresh = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    alone, kinds = 0, set()
    for _ in range(60):
        sentence = fresh(16) + "."
        sides = []
        for text in (f"{fresh(40)}. {sentence} {fresh(40)}.", f"{fresh(40)} {sentence} {fresh(40)}."):
            data = np.frombuffer(text.encode(), np.uint8)
            p = paragraph_dedup.Paragraphs(data, np.array([0, len(data)]), 16, 5)
            keys, of = p.keys(3, 1)
            held = {}
            for key, k in zip(keys.tolist(), of.tolist(), strict=True):
                held.setdefault(int(p.digest[k]), set()).add(key)
            sides.append(held)
        for digest in sides[0].keys() & sides[1].keys():
            kinds.add((len(sides[0][digest]) > 1, len(sides[1][digest]) > 1))
            alone += not sides[0][digest] & sides[1][digest]
    assert (True, False) in kinds and alone == 0


@pytest.mark.parametrize("most", [3, 4096])
def test_links_span_what_all_pairs_link(spark, most):
    rng = random.Random(8)
    sets, shared = {}, []
    for key in range(40):
        base = [rng.randrange(10**6) for _ in range(20)]
        ids = []
        for _ in range(rng.randrange(2, 12)):
            base = [*base[rng.randrange(5):], *[rng.randrange(10**6) for _ in range(rng.randrange(3))]]
            sets[len(sets)] = sorted(set(base))
            ids.append(len(sets) - 1)
        shared += [(key, i, len(ids)) for i in ids]
    near = lambda a, b: 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    table = spark.createDataFrame(list(sets.items()), "id long, hashes array<long>")
    sets = {i: set(s) for i, s in sets.items()}
    links = {(a, b) for k, a, _ in shared for j, b, _ in shared if j == k and a < b and near(a, b)}
    found = {(min(e), max(e)) for e in map(tuple, paragraph_dedup._links(spark.createDataFrame(shared, "key long, digest long, m long"), table, 75, most).collect())}

    def labels(edges):
        of = {i: i for i in sets}
        for _ in sets:
            for a, b in edges:
                of[a] = of[b] = min(of[a], of[b])
        return of

    assert len(links) > 40 and labels(found) == labels(links)


def test_tables_on_the_way_are_given_up(spark):
    from lociframe.llm.store import emptied, written

    table = written(spark.range(1000).repartition(3).withColumn("list", F.array("id")), "given-up")
    assert table.count() == 1000
    emptied(table)
    assert spark.read.schema(table.schema).parquet(table.inputFiles()[0].rsplit("/", 1)[0]).count() == 0
