"""Personal data by aggregated weak labels, in built-in functions only.

Regular expressions find the base spans (email, ip, card, phone), which always count, and further
candidates (secret, number). Regex, gazetteer and context labelers vote on every candidate;
expectation-maximisation estimates how reliable they are, and its posteriors train the final span
classifier, a logistic regression on span features.

Spans stay in their document's row, so nothing is shuffled by document. Votes and features are short
codes: only the counts of their combinations, at most 3^labelers and 2^features, reach the driver.
"""
from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .weak_rules import ABSTAIN, BAD, GOOD, estimate

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "secret", "number")

#: Fixed patterns of the base kinds. Email runs once over each run of name characters (a match may begin
#: where the last one ended); a card needs 16 digits to count, so shorter runs need not be matched.
#: Repeated groups are possessive, which Java runs without recursion.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++"
IP = r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
SECRET = r"(?<![A-Za-z0-9_/+-])[A-Za-z0-9_/+-]{20,}+"
NUMBER = r"(?<![A-Za-z0-9+.])[0-9](?:[\x20./()-]{0,2}[0-9]){6,}+(?![A-Za-z0-9])"

#: Gazetteers: words shortly before a span that speak for personal data, and for public matter.
PERSONAL = "mail|e-mail|contact|tel|phone|call|mobile|fax|card|visa|account|iban|ssn|passport|key|token|secret|password|passwd|pwd|bearer|api"
PUBLIC = "version|license|licence|copyright|isbn|issn|page|figure|section|volume|chapter"
BEFORE = 24  # code points of context

_SPANS = "array<struct<start: bigint, end: bigint, match: string, before: string>>"


def located(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches: start and end in code points (end exclusive), match, and what comes shortly before."""
    found = F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"), F.split(text, pattern, -1).alias("g"))

    def place(z: Column) -> Column:
        start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast(_SPANS).alias("out"))

        def step(a: Column, i: Column) -> Column:
            gap, match = F.get(z["g"], i), F.get(z["m"], i)
            begin = a["at"] + F.length(gap)
            end = begin + F.length(match)
            span = F.struct(begin.cast("bigint").alias("start"), end.cast("bigint").alias("end"), match.alias("match"), F.right(gap, F.lit(BEFORE)).alias("before"))
            return F.struct(end.cast("bigint").alias("at"), F.concat(a["out"], F.array(span)).alias("out"))

        return F.when(F.size(z["m"]) > 0, F.aggregate(F.sequence(F.lit(0), F.size(z["m"]) - 1), start, step, lambda a: a["out"])).otherwise(F.array().cast(_SPANS))

    return F.get(F.transform(F.array(found), place), F.lit(0))


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Luhn checksum of a string of digits."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def _is_card(match: Column) -> Column:
    return F.length(digits(match)).between(16, 19) & passes_luhn(digits(match))


def _is_ip(match: Column) -> Column:
    return F.forall(F.split(match, r"\."), lambda p: F.length(F.ltrim(p, F.lit("0"))).between(0, 3) & (F.coalesce(F.try_to_number(F.right(p, F.lit(9)), F.lit("999999999")), F.lit(0)) <= 255))


_CHECKS: dict[str, Callable[[Column], Column]] = {
    "email": lambda m: F.lit(True), "ip": _is_ip, "card": _is_card, "phone": lambda m: F.length(digits(m)).between(8, 15),
    "secret": lambda m: m.rlike("[0-9].*[0-9].*[0-9]") & m.rlike("[A-Za-z].*[A-Za-z].*[A-Za-z]"), "number": lambda m: F.length(digits(m)) >= 7,
}


def _yes(test: Column, answer: str = GOOD) -> Column:
    return F.when(test, answer).otherwise(ABSTAIN)


def _votes(kind: str, s: Column) -> Column:
    """Answers of the labelers: shape, checksum, personal words, public words, assignment, quotes, prose."""
    before, base = F.lower(s["before"]), kind in BASE_KINDS
    shape = F.lit(GOOD) if base else F.when(s["match"].rlike(r"^(?:[0-9a-f]{32,}|(?=.*[0-9].*[0-9].*[0-9])(?=.*[a-z])(?=.*[A-Z]).{24,})$"), GOOD).otherwise(BAD) if kind == "secret" else F.lit(ABSTAIN)
    checksum = F.lit(GOOD) if kind in ("card", "ip") else F.when(F.length(digits(s["match"])) >= 16, BAD).otherwise(ABSTAIN) if kind == "number" else F.lit(ABSTAIN)
    return F.concat(
        shape, checksum, _yes(before.rlike(rf"\b(?:{PERSONAL})\b")), _yes(before.rlike(rf"\b(?:{PUBLIC})\b"), BAD), _yes(before.rlike(r"[=:]\s*[\"']?$")),
        _yes(before.rlike(r"[\"']$")), F.lit(ABSTAIN) if base else _yes(before.rlike(r"[\p{L}.,]\s$|^$"), BAD))


def _features(kind: str, s: Column) -> Column:
    """Bits of the final classifier: one for each kind, then context and shape."""
    before = F.lower(s["before"])
    bits = [F.lit("1" if kind == k else "0") for k in KINDS]
    tests = (before.rlike(rf"\b(?:{PERSONAL})\b"), before.rlike(rf"\b(?:{PUBLIC})\b"), before.rlike(r"[=:]\s*[\"']?$"), before.rlike(r"[\"']$"), s["match"].rlike("^[0-9a-f]{32,}$"), F.length(digits(s["match"])) >= 16)
    return F.concat(*bits, *[F.when(t, "1").otherwise("0") for t in tests])


def candidates(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_spans``: kind, start, end, base, votes and features of every candidate, by kind and start; null texts have none.

    Matches that fail a kind's check are dropped without a second try. Secrets and numbers that overlap a
    base span are no candidates of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    digit = text.rlike("[0-9]")
    guards = {"email": text.contains("@"), "ip": digit, "card": digit, "phone": text.contains("+"), "secret": digit, "number": digit}
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, SECRET, NUMBER), strict=True))

    def of(kind: str) -> Column:
        held = F.filter(F.when(guards[kind], located(text, patterns[kind])).otherwise(F.array().cast(_SPANS)), lambda s: _CHECKS[kind](s["match"]))
        return F.transform(held, lambda s: F.struct(
            F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind in BASE_KINDS).alias("base"), _votes(kind, s).alias("votes"), _features(kind, s).alias("features")))

    found = docs.drop("_spans", "_base", "_more").withColumns({"_base": F.concat(*map(of, BASE_KINDS)), "_more": F.concat(of("secret"), of("number"))})

    def free(s: Column) -> Column:
        return ~F.exists("_base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    return found.withColumn("_spans", F.concat("_base", F.filter("_more", free))).drop("_base", "_more")


@dataclass(frozen=True)
class SpanModel:
    """Intercept and one weight for each feature bit."""
    intercept: float
    weights: tuple[float, ...]


def train(counts: list[tuple[str, str, int]], penalty: float = 1e-3) -> SpanModel | None:
    """The span classifier from (votes, features, spans): EM over the votes, then logistic regression on the posteriors; None without spans."""
    if not counts:
        return None
    patterns: dict[str, int] = {}
    for votes, _, n in counts:
        patterns[votes] = patterns.get(votes, 0) + n
    model = estimate(sorted(patterns.items()), len(counts[0][0]))

    def posterior(votes: str) -> float:
        odds = model.prior + sum(w[v] for w, v in zip(model.weights, votes, strict=True))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, odds))))

    x = np.array([[1.0, *map(float, f)] for _, f, _ in counts])
    y, n = np.array([posterior(v) for v, _, _ in counts]), np.array([float(c) for _, _, c in counts])
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        move = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + penalty * np.eye(len(w)), x.T @ (n * (p - y)) + penalty * w)
        w -= move
        if np.abs(move).max() < 1e-9:
            break
    return SpanModel(float(w[0]), tuple(map(float, w[1:])))


def fit(found: DataFrame) -> SpanModel | None:
    """The model of all candidates of ``found`` (written beforehand, as it is read again)."""
    counts = found.select(F.explode("_spans").alias("s")).groupBy("s.votes", "s.features").count().orderBy("votes", "features").collect()
    return train([(r.votes, r.features, r["count"]) for r in counts])


def personal_spans(model: SpanModel | None, least: float = 0.5) -> Column:
    """The spans of ``_spans`` that count: base ones, and those the classifier gives at least ``least``."""
    if model is None:
        return F.filter("_spans", lambda s: s["base"])

    def counts(s: Column) -> Column:
        odds = F.lit(model.intercept)
        for k, w in enumerate(model.weights):
            odds = odds + F.when(F.substring(s["features"], k + 1, 1) == "1", w).otherwise(0.0)
        return s["base"] | (1 / (1 + F.exp(-odds)) >= least)

    return F.filter("_spans", counts)
