"""Quality rules, pairwise quality, language-model scores."""
import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.llm import lm_scoring, pairwise_quality, queries, weak_rules

from .helpers import SCHEMA, WORD, awkward, base_metrics, frame, lower, prose

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows():
    return awkward()


def test_metrics_match_plain_python(spark, rows):
    got = {}
    for r in weak_rules.measure(frame(spark, rows)).select("doc_id", "text", "kept", "_quality.*").collect():
        got.setdefault((r.doc_id, r.text), []).append((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))
    assert sum(map(len, got.values())) == len(rows)
    for r in rows:
        assert set(got[r[0], r[1]]) == {base_metrics(r[1])}


def test_votes_overrule_and_base_rules_stand(spark, rows):
    measured = weak_rules.measure(frame(spark, rows))
    judged = weak_rules.judge(measured, weak_rules.fit(measured))
    assert set(judged.columns) == {*measured.columns, "_verdict"}
    for r in judged.collect():
        n, _, _, _, repeated = base_metrics(r.text)
        assert r._verdict.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r._verdict.base_failed and r._verdict.kept)
        if n >= 50 and r.text.startswith(("of***", "OF!!", "again")):
            assert not r._verdict.kept
        elif not r._verdict.base_failed and len(r.text) < 40_000:
            assert r._verdict.kept


def test_rules_on_no_rows(spark):
    measured = weak_rules.measure(spark.createDataFrame([], SCHEMA))
    assert weak_rules.judge(measured, weak_rules.fit(measured)).count() == 0


def test_em_recovers_accuracies():
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.8
    accuracy = [0.95, 0.8, 0.7, 0.9]
    answers = np.array([np.where(rng.random(len(good)) < 0.3, "-", np.where((rng.random(len(good)) < a) == good, "g", "b")) for a in accuracy]).T
    model = weak_rules.estimate(sorted(Counter(map("".join, answers)).items()), 4)
    assert math.isclose(1 / (1 + math.exp(-model.prior)), 0.8, abs_tol=0.03)
    odds = np.array([model.prior + sum(w[v] for w, v in zip(model.weights, a, strict=True)) for a in answers])
    assert ((odds > 0) == good).mean() > 0.93


def test_quality_query_matches_labels(spark):
    scored = queries.QUERIES["op3_pairwise_quality"](spark, FOLDER)
    assert scored.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = {r.doc_id: r.quality for r in queries.table(spark, FOLDER, "labels").collect()}
    got = scored.collect()
    assert len(got) == queries.table(spark, FOLDER, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.predicted, labels[r.doc_id]) for r in got if r.held_out and r.doc_id in labels]
    assert held and sum(p == q for p, q in held) / len(held) > 0.9


def test_pairwise_scores_of_awkward_rows(spark, rows):
    features = pairwise_quality.featurize(frame(spark, rows))
    labels = [(r[0], 0 if "***" in (r[1] or "") or "!!" in (r[1] or "") else 1) for r in rows[:75]] + [(None, 1), (3, None), (4, 1)]
    ranking = pairwise_quality.fit(features, spark.createDataFrame(labels, "doc_id long, quality int"))
    got = features.select("doc_id", pairwise_quality.score(ranking).alias("s")).collect()
    assert len(got) == len(rows) and all(0 <= r.s <= 1 for r in got)
    bad = {r[0] for r in rows if r[1] and ("***" in r[1] or "!!" in r[1])}
    assert all((r.s < 0.3) == (r.doc_id in bad) for r in got if r.doc_id is not None and r.doc_id < 72)
    none = pairwise_quality.fit(features, spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.s for r in features.select(pairwise_quality.score(none).alias("s")).collect()} == {0.5}
    assert pairwise_quality.featurize(spark.createDataFrame([], SCHEMA)).count() == 0


def test_features_do_not_depend_on_slices(spark):
    rows = [(i, prose(__import__("random").Random(i), 50), *[None] * 8) for i in range(20)]
    together = {r.doc_id: r.features for r in pairwise_quality.featurize(frame(spark, rows).coalesce(1)).collect()}
    apart = {r.doc_id: r.features for r in pairwise_quality.featurize(frame(spark, rows).repartition(20, "doc_id")).collect()}
    assert together == apart


def plain_difference(rows, targets, word_share, class_share):
    tokens = [(i, r[0] in targets, WORD.findall(lower(r[1]))) for i, r in enumerate(rows)]
    b, t = Counter(), Counter()
    for _, flag, words in tokens:
        b.update(words)
        t.update(words if flag else [])
    total = sum(b.values())
    known = {w for w, n in b.items() if n >= 2 and n >= word_share * total}
    own = {w for w in known if b[w] >= class_share * total}
    uni = []
    for c in (b, t):
        n = Counter({w: c[w] for w in known})
        n[None] = sum(c.values()) - sum(n.values())
        uni.append({w: (n[w] + 1) / (sum(c.values()) + len(known) + 1) for w in [*known, None]})
    pairs = [Counter(), Counter()]
    for _, flag, words in tokens:
        classes = ["<start>", *[w if w in own else "<other>" for w in words]]
        steps = list(zip(classes, classes[1:], strict=False))
        pairs[0].update(steps)
        pairs[1].update(steps if flag else [])
    out = {}
    for i, _, words in tokens:
        if not words:
            continue
        loss = [0.0, 0.0]
        classes = ["<start>", *[w if w in own else "<other>" for w in words]]
        for m in (0, 1):
            rest = sum(p for w, p in uni[m].items() if w not in own)
            for prev, now, w in zip(classes, classes[1:], words, strict=False):
                w = w if w in known else None
                given = sum(n for (a, _), n in pairs[m].items() if a == prev)
                p = (pairs[m][prev, now] + 1) / (given + len(own) + 1) * (1 if w in own else uni[m][w] / rest)
                loss[m] -= math.log(0.5 * p + 0.5 * uni[m][w])
        out[i] = (len(words), loss[1] / len(words), loss[0] / len(words))
    return out


def test_lm_scores_match_plain_python(spark):
    rows = [r for r in awkward(5, 12) if len(r[1] or "") < 3000]
    rows = [(None if r[0] is None else i, *r[1:]) for i, r in enumerate(rows)]
    targets = {0, 3, 5}
    got = lm_scoring.cross_entropy_difference(frame(spark, rows), spark.createDataFrame([(0,), (3,), (3,), (5,), (None,)], "doc_id long"), 1e-3, 1e-2).collect()
    expected = plain_difference(rows, targets, 1e-3, 1e-2)
    assert len(got) == len(rows)
    for r in got:
        if r.n_tokens == 0:
            assert r.difference is None
        elif r.doc_id is not None:
            n, target, background = expected[r.doc_id]
            assert n == r.n_tokens and math.isclose(target, r.target_loss, rel_tol=1e-9) and math.isclose(background, r.background_loss, rel_tol=1e-9)
            assert math.isclose(r.difference, target - background, abs_tol=1e-9)


def test_lm_scores_without_targets_or_rows(spark, rows):
    none = spark.createDataFrame([], "doc_id long")
    assert lm_scoring.cross_entropy_difference(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert lm_scoring.cross_entropy_difference(frame(spark, rows), none).filter(F.col("difference").isNotNull()).count() > 0


def test_every_labelled_document_teaches(spark):
    """More labelled documents than a group holds: all of them move the weights, and the threshold is that of all scores."""
    import numpy as np
    r = np.random.default_rng(4)
    k = len(pairwise_quality.FEATURES)
    for n_good, n_bad in ((700, 300), (1500, 40)):
        table = np.round(r.random((n_good + n_bad, k)), 3)
        table[:n_good, 0] *= 0.7
        features = spark.createDataFrame([(i, [float(x) for x in f]) for i, f in enumerate(table)], "doc_id long, features array<double>")
        labels = spark.createDataFrame([(i, int(i < n_good)) for i in range(len(table))], "doc_id long, quality int")
        for group, bracket in ((50, 20), (10_000, 10_000)):
            ranking = pairwise_quality.fit(features, labels, group, bracket=bracket)
            scores = table @ np.array(ranking.weights) + ranking.offset
            below = scores < np.log(0.3 / 0.7)
            assert abs(int(below.sum()) - n_bad) <= 1
            assert below[n_good:].mean() > below[:n_good].mean()
    used = pairwise_quality._groups(features.join(labels, "doc_id").withColumn("place", F.col("doc_id")), n_good, n_bad, 10)
    assert used.select("place").distinct().count() == n_good + n_bad
    sides = used.groupBy("group").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")).collect()
    assert len(sides) > 4 and all(x.good and x.bad for x in sides)
