"""Quality rules as weak supervision, in built-in functions only.

Rules vote ``good`` or ``bad`` on a document or abstain. Expectation-maximisation estimates the share
of good documents and, for each rule, how often it gives each answer on good and on bad documents; the
posterior probability of good then decides instead of an all-must-pass filter.

The model needs only the number of documents for each combination of answers. There are at most
3^rules combinations whatever the corpus, so the counts of all documents are summed by Spark and the
iterations run over that bounded table. Metrics are per row; nothing is shuffled but the counts.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLANKS = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"
METRIC = "_quality"  # struct column of the metrics
GOOD, BAD, ABSTAIN = "g", "b", "-"


@dataclass(frozen=True)
class Rule:
    """A vote on one ratio of the metrics: bad outside (bad_low, bad_high), good inside [good_low, good_high], else abstain.

    A bound of None is open; a rule without good bounds never votes good.
    """
    name: str
    ratio: tuple[str, str]
    bad_low: float | None = None
    bad_high: float | None = None
    good_low: float | None = None
    good_high: float | None = None


#: Shares are per word unless the ratio names another base.
RULES = (
    Rule("symbols", ("n_symbols", "n_words"), bad_high=0.1),
    Rule("exclamations", ("n_exclamations", "n_words"), bad_high=0.3),
    Rule("capitals", ("n_capitals", "word_chars"), bad_high=0.3),
    Rule("plain_words", ("n_plain_words", "n_words"), bad_low=0.7, good_low=0.9),
    Rule("word_length", ("word_chars", "n_words"), bad_low=3.5, bad_high=6.6, good_low=4.2, good_high=6.0),
    Rule("repeats", ("n_repeat_words", "n_words"), bad_high=0.3, good_high=0.05),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), bad_high=0.4),
)


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _repeated_words(words: Column) -> Column:
    """Number of words inside 3-word windows that occur twice or more in the array."""
    windows = F.when(F.size(words) >= 4, F.transform(F.sequence(F.lit(0), F.size(words) - 3), lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))).otherwise(F.array().cast("array<bigint>"))

    def covered(hashes: Column) -> Column:
        pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def again(p: Column) -> Column:
            same = F.filter(p, lambda e, k: (F.get(p, k - 1)["h"] == e["h"]) & (k > 0) | F.coalesce(F.get(p, k + 1)["h"] == e["h"], F.lit(False)))
            return F.array_sort(F.transform(same, lambda e: e["i"]))

        start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("total"))
        return F.aggregate(
            _bound(pairs, again), start,
            lambda a, i: F.struct(i.alias("last"), (a["total"] + F.least(F.lit(3), i - a["last"])).alias("total")), lambda a: a["total"])

    return _bound(windows, lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(F.lit(0).cast("bigint")))


def measure(docs: DataFrame) -> DataFrame:
    """``docs`` with a struct of metrics of ``text`` (null: empty) under ``METRIC``; a column of that name is replaced.

    n_words, word_chars (code points in words), n_symbols, n_lines (with a word), n_dup_lines (equal to
    an earlier one), n_repeat_words, n_exclamations, n_capitals, n_plain_words (letters or digits, at most
    a closing mark after them).
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    docs = docs.drop(METRIC)
    return (
        docs.withColumns({"_rule_words": F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), "_rule_lines": lines})
        .withColumn(METRIC, F.struct(
            F.size("_rule_words").cast("long").alias("n_words"),
            F.length(F.array_join("_rule_words", "")).cast("long").alias("word_chars"),
            F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
            F.size("_rule_lines").cast("long").alias("n_lines"),
            (F.size("_rule_lines") - F.size(F.array_distinct("_rule_lines"))).cast("long").alias("n_dup_lines"),
            _repeated_words(F.col("_rule_words")).alias("n_repeat_words"),
            F.regexp_count(text, F.lit("!")).cast("long").alias("n_exclamations"),
            F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            F.regexp_count(text, F.lit(r"[\p{L}\p{N}][.,;:?]?(?=[\x20\x09-\x0D]|\z)")).cast("long").alias("n_plain_words"),
        )).drop("_rule_words", "_rule_lines")
    )


def vote(rule: Rule) -> Column:
    """The rule's answer; it abstains where its ratio is undefined."""
    value = F.try_divide(F.col(METRIC)[rule.ratio[0]].cast("double"), F.col(METRIC)[rule.ratio[1]].cast("double"))
    bad = F.lit(False)
    if rule.bad_low is not None:
        bad = bad | (value < rule.bad_low)
    if rule.bad_high is not None:
        bad = bad | (value > rule.bad_high)
    good = F.lit(rule.good_low is not None or rule.good_high is not None)
    if rule.good_low is not None:
        good = good & (value >= rule.good_low)
    if rule.good_high is not None:
        good = good & (value <= rule.good_high)
    return F.when(value.isNull(), ABSTAIN).when(bad, BAD).when(good, GOOD).otherwise(ABSTAIN)


@dataclass(frozen=True)
class Model:
    """Log odds of good: ``prior`` plus one weight for each rule's answer."""
    prior: float
    weights: tuple[dict[str, float], ...]


def estimate(patterns: list[tuple[str, int]], n_rules: int, rounds: int = 100, tolerance: float = 1e-9) -> Model:
    """Expectation-maximisation over (answers of all rules, documents).

    It starts from the majority of votes (a tie counts as good) and smooths every rate by one document;
    without documents every weight is zero.
    """
    total = sum(n for _, n in patterns)
    if not total:
        return Model(0.0, tuple({} for _ in range(n_rules)))
    good = [0.9 if p.count(GOOD) >= p.count(BAD) else 0.1 for p, _ in patterns]
    for _ in range(rounds):
        n_good = sum(g * n for g, (_, n) in zip(good, patterns, strict=True))
        n_bad = total - n_good
        prior = math.log((n_good + 1) / (n_bad + 1))
        weights = []
        for k in range(n_rules):
            held = {v: [1.0, 1.0] for v in (GOOD, BAD, ABSTAIN)}
            for g, (p, n) in zip(good, patterns, strict=True):
                held[p[k]][0] += g * n
                held[p[k]][1] += (1 - g) * n
            weights.append({v: math.log(a / (n_good + 3)) - math.log(b / (n_bad + 3)) for v, (a, b) in held.items()})
        odds = [prior + sum(w[v] for w, v in zip(weights, p, strict=True)) for p, _ in patterns]
        new = [1 / (1 + math.exp(-max(-700.0, min(700.0, x)))) for x in odds]
        moved = max(abs(a - b) for a, b in zip(good, new, strict=True))
        good = new
        if moved < tolerance:
            break
    return Model(prior, tuple(weights))


def fit(measured: DataFrame, rules: tuple[Rule, ...] = RULES) -> Model:
    """The model of all measured documents; only the counts of answer combinations reach the driver."""
    counts = measured.select(F.concat(*[vote(r) for r in rules]).alias("answers")).groupBy("answers").count().orderBy("answers").collect()
    return estimate([(r["answers"], r["count"]) for r in counts], len(rules))


def quality_probability(model: Model, rules: tuple[Rule, ...] = RULES) -> Column:
    """Posterior probability that a measured document is good."""
    odds = F.lit(model.prior)
    for rule, weight in zip(rules, model.weights, strict=True):
        answer = vote(rule)
        odds = odds + F.when(answer == GOOD, weight.get(GOOD, 0.0)).when(answer == BAD, weight.get(BAD, 0.0)).otherwise(weight.get(ABSTAIN, 0.0))
    return 1 / (1 + F.exp(-odds))


def base_failed() -> Column:
    """Fewer than 50 words, or more than half of them in repeated windows."""
    m = F.col(METRIC)
    return (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])


def judge(measured: DataFrame, model: Model, rules: tuple[Rule, ...] = RULES, least: float = 0.5) -> DataFrame:
    """Measured documents with ``base_failed``, ``quality_probability`` and ``kept`` in a struct ``_verdict``.

    kept: not failed by the base rules and a posterior of at least ``least``. One row per input row, in
    whatever order; null and empty texts have no words and fail. Columns named like the two structs are
    replaced, all others pass.
    """
    p = quality_probability(model, rules)
    return measured.drop("_verdict").withColumn("_verdict", F.struct(
        base_failed().alias("base_failed"), p.alias("quality_probability"), (~base_failed() & (p >= least)).alias("kept")))
