"""Over-representation statistics as column expressions."""
from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of Stirling's series for ln(gamma).
STIRLING = (1 / 12, -1 / 360, 1 / 1260, -1 / 1680, 1 / 1188)
SHIFT = 8


def _ln_factorial(n: Column) -> Column:
    """ln(n!) for n >= 0, by Stirling's series after moving the argument up by ``SHIFT``."""
    z = n.cast("double") + 1.0
    product = z
    for i in range(1, SHIFT):
        product = product * (z + float(i))
    y = z + float(SHIFT)
    inverse = 1.0 / (y * y)
    series = F.lit(STIRLING[-1])
    for coefficient in reversed(STIRLING[:-1]):
        series = series * inverse + coefficient
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series / y - F.log(product)


def ln_factorials(*numbers: Column, signs: str) -> Column:
    """Signed sum of ln(n!) over several numbers, for example ``ln_factorials(n, k, signs="+-")``."""
    items = F.array(*[F.struct(n.cast("double").alias("n"), F.lit(1.0 if s == "+" else -1.0).alias("s")) for n, s in zip(numbers, signs)])
    return F.aggregate(items, F.lit(0.0), lambda acc, i: acc + i["s"] * _ln_factorial(i["n"]))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def hypergeometric_tail(a: Column, b: Column, c: Column, d: Column) -> Column:
    """P(X >= a) for the 2x2 table (a, b; c, d), at most 1.

    Terms further than five square roots of the draw count from both ``a`` and the mean weigh
    less than 2e-22 of the sum (Hoeffding's bound, and the tail ratio of a log-concave law only
    falls further out), which is below double precision; leaving them out keeps the sum short
    however many genes there are.
    """
    table = F.struct(
        a.cast("bigint").alias("a"), (a + b).cast("bigint").alias("draws"), (a + c).cast("bigint").alias("marked"),
        (a + b + c + d).cast("bigint").alias("n"),
    )

    def tail(t: Column) -> Column:
        draws, marked, n = t["draws"], t["marked"], t["n"]
        mean = draws.cast("double") * marked / F.greatest(n, F.lit(1))
        reach = F.ceil(5 * F.sqrt(draws.cast("double"))) + 1
        bounds = F.struct(
            F.greatest(t["a"], F.ceil(mean) - reach, draws + marked - n).alias("first"),
            F.least(draws, marked, F.greatest(t["a"], F.floor(mean)) + reach).alias("last"),
            ln_factorials(marked, n - marked, draws, n - draws, n, signs="++++-").alias("fixed"),
        )

        def total(r: Column) -> Column:
            def add(acc: Column, x: Column) -> Column:
                return acc + F.exp(r["fixed"] + ln_factorials(x, marked - x, draws - x, n - marked - draws + x, signs="----"))

            summed = F.aggregate(F.sequence(r["first"], r["last"]), F.lit(0.0), add)
            return F.when(r["first"] > r["last"], F.lit(0.0)).otherwise(F.least(summed, F.lit(1.0)))

        return _let(bounds, total)

    return _let(table, tail)
