"""Quality scores from pairwise preferences (Bradley-Terry).

Every text becomes a vector of shape features, in one pass with no shuffle. Labelled documents form
preference pairs, a good one over a bad one, and the logistic loss on feature differences gives the
weights. The threshold is the quantile of the training scores at the share of bad documents; the score
is a logistic function of the distance to it, so that a fixed cut stands for that quantile.

The fit uses every labelled document. They are dealt into groups with documents of both labels, pairs are formed
inside a group, and each Newton step adds up the gradients and curvatures of all groups; only such sums, and
the few scores around the threshold, reach the driver.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words as W
from .store import written

#: About how many documents of the rarer label a group has, and at most twice as many of the other.
GROUP = 10_000
#: Scores that are put in order on the driver, once counts have told which ones surround the threshold.
BRACKET = 10_000
PARTNERS = 8
CUT = 0.3

_CLASSES = {
    "symbols": b"#*$%&|<>", "exclamations": b"!", "capitals": bytes(range(0x41, 0x5B)), "digits": b"0123456789",
    "stops": b".,;:?", "lines": b"\n", "brackets": b"{}[]()=_\\/", "beyond_ascii": bytes(range(0xC0, 0x100)),
}
FEATURES = (*_CLASSES, "word_length", "long_words", "distinct_words", "repeated_words", "same_as_last", "log_words")


def _features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each text of a slice; shares are squashed to 0..1 so that no text dominates."""
    starts, ends, rows = W.spans(data, offsets, W.SPACES)
    counts = np.diff(rows)
    n = np.maximum(counts, 1).astype(float)
    owner = np.repeat(np.arange(len(counts)), counts)
    out = []
    for chars in _CLASSES.values():
        member = np.zeros(256, bool)
        member[list(chars)] = True
        held = np.concatenate([[0], np.cumsum(member[data])])
        share = np.diff(held[offsets]) / n
        out.append(share / (share + 0.2))
    lengths = ends - starts
    out.append(np.bincount(owner, lengths, len(counts)) / n / 10)
    out.append(np.bincount(owner, lengths > 12, len(counts)) / n)
    hashes = W.word_hashes(data, starts, ends)

    order = np.lexsort((hashes, owner))
    first = np.ones(len(order), bool)
    first[1:] = (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out.append(np.bincount(owner[order], first, len(counts)) / n)
    windows, firsts = W.window_hashes(hashes, rows, 3)
    of = np.repeat(np.arange(len(counts)), np.diff(firsts))
    order = np.lexsort((windows, of))
    first = np.ones(len(order), bool)
    first[1:] = (windows[order][1:] != windows[order][:-1]) | (of[order][1:] != of[order][:-1])
    out.append(1 - np.bincount(of[order], first, len(counts)) / np.maximum(np.diff(firsts), 1))
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    out.append(np.bincount(owner, same, len(counts)) / n)
    out.append(np.log1p(counts) / 10)
    return np.column_stack(out)


def featurize(docs: DataFrame) -> DataFrame:
    """doc_id and the features of (doc_id, text); null and empty texts have zeros but for fixed terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_features(data, offsets) for _, _, data, offsets in W.slices(batch)]
            table = np.concatenate(rows) if rows else np.zeros((0, len(FEATURES)))
            flat = pa.ListArray.from_arrays(pa.array(np.arange(len(table) + 1) * len(FEATURES), pa.int32()), pa.array(table.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), flat], names=["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, features array<double>")


@dataclass(frozen=True)
class Ranking:
    """Weights of the features, and the offset that puts the threshold at the cut."""
    weights: tuple[float, ...]
    offset: float


def _pair_sums(good: np.ndarray, bad: np.ndarray, w: np.ndarray, scale: np.ndarray, partners: int) -> np.ndarray:
    """Number, gradient and curvature of the pairs of a group at weights ``w``, each document in ``partners`` pairs, as one vector."""
    k = len(w)
    n = max(len(good), len(bad)) if len(good) and len(bad) else 0
    step = np.arange(n)
    out = np.zeros(1 + k + k * k)
    for j in range(partners if n else 0):
        pairs = (good[step % len(good)] - bad[(step * 7919 + j * 104_729 + j) % len(bad)]) / scale
        p = 1 / (1 + np.exp(-np.clip(pairs @ w, -500, 500)))
        out += np.concatenate([[n], pairs.T @ (p - 1), ((pairs * (p * (1 - p))[:, None]).T @ pairs).ravel()])
    return out


def _groups(labelled: DataFrame, n_good: int, n_bad: int, group: int) -> DataFrame:
    """(group, quality, place, features): every document, in as many groups as the rarer label fills; where the other label is much
    more frequent its documents are dealt further, and the rarer ones come to each of these parts."""
    rare, frequent = sorted((n_good, n_bad))
    groups = max(1, rare // group)
    parts = max(1, -(-frequent // (groups * 2 * group)))
    of = F.pmod(F.xxhash64("place"), F.lit(groups))
    # The rarer label's rows are copied, the other's are dealt.
    is_rare = F.col("quality") == int(n_good <= n_bad)
    part = F.when(is_rare, F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))).otherwise(F.array(F.pmod(F.xxhash64("place", F.lit(1)), F.lit(parts))))
    return labelled.select(of.alias("g"), F.explode(part).alias("p"), "quality", "place", "features").select((F.col("g") * parts + F.col("p")).alias("group"), "quality", "place", "features")


def _sums(groups: DataFrame, w: np.ndarray, scale: np.ndarray, partners: int) -> np.ndarray:
    """``_pair_sums`` of all groups together."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending")])
        features = np.array(table["features"].combine_chunks().flatten()).reshape(-1, len(w))
        quality = np.array(table["quality"])
        return pa.table({"at": np.arange(1 + len(w) + len(w) ** 2), "v": _pair_sums(features[quality == 1], features[quality == 0], w, scale, partners)})

    found = groups.groupBy("group").applyInArrow(run, "at long, v double").groupBy("at").agg(F.sum("v").alias("v")).orderBy("at").collect()
    return np.array([r.v for r in found])


def _threshold(scores: DataFrame, n_good: int, n_bad: int, share_bad: float, bracket: int) -> float:
    """Middle between the score at which the weight of all scores from below reaches ``share_bad`` and the one before it.

    Weights restore the share of bad documents among all labels. Counts of ever finer ranges lead to the few distinct scores that are read.
    """
    mass = np.array([(1 - share_bad) / n_good, share_bad / n_bad])
    counted = written(scores.groupBy("s").agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad")), "quality-scores")
    ends = counted.agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count(F.lit(1)).alias("n")).first()
    low, high, n, before = ends.low, ends.high, ends.n, np.zeros(2)
    inside = counted
    while n > bracket and low < high:
        width = (high - low) / 1024
        if low + width <= low:
            break
        at = F.least(F.lit(1023), F.floor((F.col("s") - low) / width)).alias("b")
        bins = inside.groupBy(at).agg(F.min("s").alias("low"), F.max("s").alias("high"), F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad")).orderBy("b").collect()
        reached = np.cumsum([[r.good, r.bad] for r in bins], axis=0) + before
        hit = min(int(np.searchsorted(reached @ mass, share_bad + 1e-12)), len(bins) - 1)
        before = reached[hit - 1] if hit else before
        if bins[hit].n == n:
            break
        low, high, n = bins[hit].low, bins[hit].high, bins[hit].n
        inside = counted.filter((F.col("s") >= low) & (F.col("s") <= high))
    rows = inside.orderBy("s").collect()
    reached = np.cumsum([[r.good, r.bad] for r in rows], axis=0) + before
    at = min(int(np.searchsorted(reached @ mass, share_bad + 1e-12)), len(rows) - 1)
    # Equal scores follow each other: the one before is the same unless the first of its kind crosses the share.
    earlier = reached[at - 1] if at else before
    one = mass[0] if rows[at].good else mass[1]
    if earlier @ mass + one < share_bad + 1e-12:
        return rows[at].s
    previous = rows[at - 1].s if at else counted.filter(F.col("s") < rows[at].s).agg(F.max("s")).first()[0]
    return rows[at].s if previous is None else (rows[at].s + previous) / 2


def fit(features: DataFrame, labels: DataFrame, group: int = GROUP, partners: int = PARTNERS, penalty: float = 1e-3, cut: float = CUT, bracket: int = BRACKET) -> Ranking:
    """The ranking learned from (doc_id, quality) labels of featurized documents: Newton steps on the logistic loss of good minus bad features.

    Repeated labels of a document count once, at their lowest; labels other than 0 and 1 are left out,
    as are null ids. Without both labels nothing can be ranked: the weights are zero and every score is 0.5.
    """
    k = len(FEATURES)
    known = labels.filter("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
    shares = {r.quality: r["count"] for r in known.groupBy("quality").count().collect()}
    labelled = written(features.join(known, "doc_id").select("quality", F.xxhash64("doc_id", "features").alias("place"), "features"), "quality-labelled")
    found = {r.quality: r["count"] for r in labelled.groupBy("quality").count().collect()}
    n_good, n_bad = found.get(1, 0), found.get(0, 0)
    if not n_good or not n_bad:
        return Ranking((0.0,) * k, 0.0)
    value = [F.get("features", F.lit(i)) for i in range(k)]
    spread = labelled.agg(*[F.stddev_pop(v).alias(f"s{i}") for i, v in enumerate(value)]).first()
    scale = np.maximum(np.array(spread, float), 1e-6)
    groups = _groups(labelled, n_good, n_bad, group)
    w = np.zeros(k)
    for _ in range(50):
        sums = _sums(groups, w, scale, partners)
        gradient = sums[1 : 1 + k] / sums[0] + penalty * w
        curvature = sums[1 + k :].reshape(k, k) / sums[0] + penalty * np.eye(k)
        move = np.linalg.solve(curvature, gradient)
        w -= move
        if np.abs(move).max() < 1e-8:
            break
    w = w / scale
    total = F.lit(0.0)
    for v, x in zip(value, w, strict=True):
        total = total + v * float(x)
    threshold = _threshold(labelled.select("quality", total.alias("s")), n_good, n_bad, shares[0] / (shares[0] + shares[1]), bracket)
    return Ranking(tuple(map(float, w)), float(np.log(cut / (1 - cut)) - threshold))


def score(ranking: Ranking) -> Column:
    """Score of 0 to 1 of a featurized document; at least the cut from the threshold up."""
    if not any(ranking.weights):
        return F.lit(0.5)
    total = F.lit(ranking.offset)
    for k, w in enumerate(ranking.weights):
        total = total + F.get("features", F.lit(k)) * F.lit(w)
    return 1 / (1 + F.exp(-total))
