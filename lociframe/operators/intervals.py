"""Interval operators over half-open intervals ``[start0, end0)`` of named sequences.

A genome has few sequences, so nothing here is ever grouped by sequence alone. Positions are
cut into bins of ``POSITION_BIN`` and collapsed to one row per distinct position before any
ordered window runs: a window therefore holds at most ``POSITION_BIN`` rows, however many
intervals pile up on one spot, and the totals carried from bin to bin are one row per bin.
"""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

POSITION_BIN = 1 << 16

#: Levels of cells for joins of intervals: the shortest cells have 2**9 bases, each level's are 2**3 times as long.
CELL_BITS, LEVEL_BITS, LEVELS = 9, 3, 12


def overlap_length(start_a: Column, end_a: Column, start_b: Column, end_b: Column) -> Column:
    """Shared bases of two half-open intervals, zero when they are apart."""
    return F.greatest(F.lit(0), F.least(end_a, end_b) - F.greatest(start_a, start_b))


def _bin(pos: Column, size: int) -> Column:
    return F.floor(pos / size).cast("bigint")


def running_totals(
    deltas: DataFrame, keys: Sequence[str], pos: str, values: Sequence[str], bin_size: int = POSITION_BIN, carry: Sequence[str] = (), peaks: Sequence[str] = (),
) -> DataFrame:
    """Add ``before_<v>``: the total of each value, or the maximum of each of ``peaks``, over smaller positions of the same keys.

    ``deltas`` holds one row per keys and position; its ``carry`` columns are kept as they are. Two levels: a window inside each bin, plus
    the bin's starting total, which comes from a window over one row per bin. Both levels read
    the same columns and filters, so Spark shuffles the deltas once and reuses the exchange.
    """
    keys = list(keys)
    known = [F.col(k).isNotNull() for k in (*keys, pos)]
    for condition in known:
        deltas = deltas.filter(condition)
    binned = deltas.withColumn("_bin", _bin(F.col(pos), bin_size))
    earlier_bins = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    starts = binned.groupBy(*keys, "_bin").agg(*[F.sum(v).alias(v) for v in values], *[F.max(v).alias(v) for v in peaks]).select(
        *keys, "_bin", *[F.coalesce(F.sum(v).over(earlier_bins), F.lit(0)).alias(f"_from_{v}") for v in values],
        *[F.max(v).over(earlier_bins).alias(f"_from_{v}") for v in peaks]
    )
    earlier = Window.partitionBy(*keys, "_bin").orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    inside = binned.select(
        "*", *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"_in_{v}") for v in values], *[F.max(v).over(earlier).alias(f"_in_{v}") for v in peaks])
    return inside.join(starts, [*keys, "_bin"], "left").select(
        *keys, pos, "_bin", *values, *peaks, *carry, *[(F.col(f"_from_{v}") + F.col(f"_in_{v}")).alias(f"before_{v}") for v in values],
        *[F.greatest(f"_from_{v}", f"_in_{v}").alias(f"before_{v}") for v in peaks]
    )


def totals_at(
    steps: DataFrame, probes: DataFrame, values: Sequence[str], bin_size: int = POSITION_BIN
) -> DataFrame:
    """Running totals of ``values`` at every position of ``steps`` and of ``probes`` (seqid, pos)."""
    empty = [F.lit(0).cast(steps.schema[v].dataType).alias(v) for v in values]
    deltas = steps.select("seqid", "pos", *values).unionByName(probes.select("seqid", "pos", *empty))
    return running_totals(
        deltas.groupBy("seqid", "pos").agg(*[F.sum(v).alias(v) for v in values]), ["seqid"], "pos", values, bin_size
    )


def _depth_changes(df: DataFrame, keys: Sequence[str], start: str, end: str) -> DataFrame:
    """Net change of depth per position; touching intervals cancel, which is what joins them."""
    valid = df.filter(F.col(end) > F.col(start))
    begins = valid.select(*keys, F.col(start).alias("pos"), F.lit(1).alias("change"))
    stops = valid.select(*keys, F.col(end).alias("pos"), F.lit(-1).alias("change"))
    return begins.unionByName(stops).groupBy(*keys, "pos").agg(F.sum("change").alias("change")).filter("change <> 0")


def _edges(df: DataFrame, keys: Sequence[str], start: str, end: str, bin_size: int) -> DataFrame:
    """Positions where coverage begins (``opens``) or stops, alternating along each sequence."""
    depth = running_totals(_depth_changes(df, keys, start, end), keys, "pos", ["change"], bin_size)
    return depth.withColumn("opens", F.col("before_change") == 0).filter(
        F.col("opens") | (F.col("before_change") + F.col("change") == 0)
    ).select(*keys, "_bin", "pos", "opens")


def merge_intervals(
    df: DataFrame,
    keys: Sequence[str] = ("seqid",),
    start: str = "start0",
    end: str = "end0",
    bin_size: int = POSITION_BIN,
) -> DataFrame:
    """Union of overlapping or touching intervals: one row per stretch of covered bases."""
    keys = list(keys)
    edges = _edges(df, keys, start, end, bin_size)
    in_bin = Window.partitionBy(*keys, "_bin").orderBy("pos")
    paired = edges.withColumn("_next", F.lead("pos").over(in_bin)).filter("opens")
    later_bins = Window.partitionBy(*keys).orderBy("_bin")
    following = edges.groupBy(*keys, "_bin").agg(F.min("pos").alias("_first")).select(
        *keys, "_bin", F.lead("_first").over(later_bins).alias("_next_bin_pos")
    )
    # A left join adds no filter of its own, so both inputs keep the same plan and share one shuffle.
    return paired.join(following, [*keys, "_bin"], "left").select(
        *keys, F.col("pos").alias(start), F.coalesce("_next", "_next_bin_pos").alias(end)
    )


def covered_length(
    df: DataFrame,
    keys: Sequence[str] = ("seqid",),
    start: str = "start0",
    end: str = "end0",
    by: Sequence[str] | None = None,
    bin_size: int = POSITION_BIN,
) -> DataFrame:
    """Distinct covered bases. Merging runs within ``keys``; the total is reported per ``by``."""
    edges = _edges(df, keys, start, end, bin_size)
    signed = F.when(F.col("opens"), -F.col("pos")).otherwise(F.col("pos"))
    return edges.groupBy(*(keys if by is None else by)).agg(F.sum(signed).alias("covered_bp"))


def _level(start: str, end: str) -> Column:
    """The finest level whose cells are at least as long as the interval."""
    length = F.col(end) - F.col(start)
    return sum(((length > (1 << (CELL_BITS + LEVEL_BITS * k))).cast("int") for k in range(LEVELS)), F.lit(0))


def _copies(df: DataFrame, start: str, end: str, places: Column, first: str) -> DataFrame:
    """A copy for each cell touched at each of ``places`` (twice the level plus the role), and whether it is the interval's first there.

    Places and cells become rows by a generator each, so no array of structures is built for an interval.
    """
    level = F.shiftright("_place", 1)
    cell = lambda pos: F.call_function("shiftright", pos.cast("bigint"), CELL_BITS + LEVEL_BITS * level)
    placed = df.select("*", F.explode(places).alias("_place"))
    return placed.select("*", F.posexplode(F.sequence(cell(F.col(start)), cell(F.col(end) - 1))).alias("_nth", "_at")).withColumns(
        {"_cell": F.col("_at") * 32 + F.col("_place"), first: F.col("_nth") == 0}).drop("_place", "_nth", "_at", "_present", "_own")


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    left_range: tuple[str, str] = ("start0", "end0"),
    right_range: tuple[str, str] = ("other_start0", "other_end0"),
    on: Sequence[str] = ("seqid",),
) -> DataFrame:
    """Every pair of overlapping intervals, with ``overlap_bp``.

    Cells come in levels, each eight times as long as the one below, and every interval has the level of its
    length. A pair meets at the level of its longer interval, where both touch at most two cells: the
    longer one is there with its own copies, the shorter one with copies for those levels that the
    other side has at all. Copies that wait for the left side and for the right side have keys of their own, so
    short intervals never meet each other in a long cell; whatever meets there lies within a few lengths
    of the longer interval. Of two common cells, the pair is kept in the first.
    """
    on = list(on)
    (ls, le), (rs, re_) = left_range, right_range
    # Filters that the join would add are here already, so that the levels read the same rows and can reuse a side's shuffles.
    for key in on:
        left, right = left.filter(F.col(key).isNotNull()), right.filter(F.col(key).isNotNull())
    left = left.filter(F.col(le) > F.col(ls)).withColumn("_own", _level(ls, le))
    right = right.filter(F.col(re_) > F.col(rs)).withColumn("_own", _level(rs, re_))
    levels_left, levels_right = left.agg(F.collect_set("_own")).scalar(), right.agg(F.collect_set("_own")).scalar()
    own, present = F.col("_own"), F.col("_present")
    # Role 0: the left interval is the longer one or of the same level; role 1: the right one is.
    itself = lambda met, role: F.when(F.exists(present, met), F.array(own * 2 + role)).otherwise(F.array().cast("array<int>"))
    waiting = lambda met, role: F.transform(F.filter(present, met), lambda v: v * 2 + role)
    left_places = F.concat(itself(lambda v: v <= own, 0), waiting(lambda v: v > own, 1))
    right_places = F.concat(waiting(lambda v: v >= own, 0), itself(lambda v: v < own, 1))
    copies = _copies(left.withColumn("_present", levels_right), ls, le, left_places, "_first")
    others = _copies(right.withColumn("_present", levels_left), rs, re_, right_places, "_other_first")
    pairs = copies.join(others, [*on, "_cell"])
    return (
        pairs.filter((F.col(ls) < F.col(re_)) & (F.col(rs) < F.col(le)) & (F.col("_first") | F.col("_other_first")))
        .withColumn("overlap_bp", F.least(le, re_) - F.greatest(ls, rs))
        .drop("_cell", "_first", "_other_first")
    )


def overlap_totals(
    left: DataFrame,
    right: DataFrame,
    values: Mapping[str, Column],
    left_range: tuple[str, str] = ("start0", "end0"),
    right_range: tuple[str, str] = ("start0", "end0"),
    bin_size: int = POSITION_BIN,
) -> DataFrame:
    """For each left interval, the sum of each value over the right intervals it overlaps.

    No pairs are formed. An overlapping interval starts before my end and does not end at or
    before my start, so each sum is a difference of two running totals, looked up at my two
    boundaries. Work grows with the rows, not with the overlaps.
    """
    names = list(values)
    (ls, le), (rs, re_) = left_range, right_range
    right = right.filter(F.col(re_) > F.col(rs)).select("seqid", rs, re_, *[c.alias(n) for n, c in values.items()])

    def boundary(side: str) -> DataFrame:
        return right.select("seqid", F.col(side).alias("pos"), *names)

    started = totals_at(boundary(rs), left.select("seqid", F.col(le).alias("pos")), names, bin_size).select(
        "seqid", F.col("pos").alias(le), *[F.col(f"before_{n}").alias(f"_started_{n}") for n in names]
    )
    finished = totals_at(boundary(re_), left.select("seqid", F.col(ls).alias("pos")), names, bin_size).select(
        "seqid", F.col("pos").alias(ls), *[(F.col(f"before_{n}") + F.col(n)).alias(f"_finished_{n}") for n in names]
    )
    looked_up = left.join(started, ["seqid", le]).join(finished, ["seqid", ls])
    return looked_up.select(
        *[F.col(c) for c in left.columns], *[(F.col(f"_started_{n}") - F.col(f"_finished_{n}")).alias(n) for n in names]
    )


def range_totals(
    left: DataFrame,
    points: DataFrame,
    values: Sequence[str],
    left_range: tuple[str, str] = ("start0", "end0"),
    pos: str = "pos0",
    bin_size: int = POSITION_BIN,
) -> DataFrame:
    """For each left interval, the sums of ``values`` over the points inside it; again without pairs."""
    ls, le = left_range
    probes = left.select("seqid", F.explode(F.array(ls, le)).alias("pos"))
    totals = totals_at(points.withColumnRenamed(pos, "pos"), probes, values, bin_size)
    upper = totals.select("seqid", F.col("pos").alias(le), *[F.col(f"before_{v}").alias(f"_hi_{v}") for v in values])
    lower = totals.select("seqid", F.col("pos").alias(ls), *[F.col(f"before_{v}").alias(f"_lo_{v}") for v in values])
    looked_up = left.join(upper, ["seqid", le]).join(lower, ["seqid", ls])
    return looked_up.select(
        *[F.col(c) for c in left.columns], *[(F.col(f"_hi_{v}") - F.col(f"_lo_{v}")).alias(v) for v in values]
    )


def tile_windows(lengths: DataFrame, width: int, step: int | None = None, length: str = "length") -> DataFrame:
    """Windows of ``width`` bases every ``step`` bases along each sequence; the last ones are clipped."""
    step = step or width
    starts = lengths.filter(F.col(length) > 0).select(
        "seqid", F.col(length).alias("_len"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(length).cast("bigint") - 1, F.lit(step).cast("bigint")))
        .alias("start0"),
    )
    return starts.select("seqid", "start0", F.least(F.col("start0") + width, F.col("_len")).alias("end0"))


def windowed_sum(
    points: DataFrame, values: Sequence[str], width: int, step: int | None = None, pos: str = "pos0"
) -> DataFrame:
    """Sum of ``values`` per tile window holding the point; windows without a point are absent."""
    step = step or width
    unit = step if width % step == 0 else 1
    cells = points.groupBy("seqid", (_bin(F.col(pos), unit) * unit).alias("_cell")).agg(
        *[F.sum(v).alias(v) for v in values]
    )
    newest = _bin(F.col("_cell"), step)
    oldest = F.greatest(F.lit(0).cast("bigint"), _bin(F.col("_cell") - width, step) + 1)
    return (
        cells.select("seqid", F.explode(F.sequence(oldest, newest)).alias("_w"), *values)
        .select("seqid", (F.col("_w") * step).alias("start0"), *values)
        .groupBy("seqid", "start0").agg(*[F.sum(v).alias(v) for v in values])
    )


def scaled_bins(regions: DataFrame, flank: int, scheme: Sequence[int]) -> DataFrame:
    """Upstream, body and downstream bins of each region, read in the direction of its strand.

    ``scheme`` gives the three bin counts. The upstream flank stops at the start of the
    sequence, fractional bin borders are cut to integers and empty bins are left out.
    """
    up, body, down = scheme
    if min(scheme) < 0 or body <= 0:
        raise ValueError("scheme needs non-negative bin counts and at least one body bin")
    start, end, minus = F.col("start0"), F.col("end0"), F.col("strand") == "-"
    left = (F.greatest(F.lit(0), start - flank), start)
    right = (end, end + flank)

    def section(name: str, count: int, low: Column, high: Column) -> Column:
        return F.struct(
            F.lit(name).alias("section"), F.lit(count).alias("n"), low.cast("bigint").alias("low"),
            high.cast("bigint").alias("high"),
        )

    sections = F.array(
        section("upstream", up, F.when(minus, right[0]).otherwise(left[0]), F.when(minus, right[1]).otherwise(left[1])),
        section("body", body, start, end),
        section("downstream", down, F.when(minus, left[0]).otherwise(right[0]),
                F.when(minus, left[1]).otherwise(right[1])),
    )
    rows = regions.filter(end > start).select("*", F.inline(sections)).filter("n > 0")
    rows = rows.select("*", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("bin_index"))
    span = F.col("high") - F.col("low")
    cut = lambda i: F.col("low") + F.floor(span * i / F.col("n"))
    return (
        rows.withColumn("bin_start0", cut(F.col("bin_index") - 1)).withColumn("bin_end0", cut(F.col("bin_index")))
        .filter("bin_end0 > bin_start0").drop("n", "low", "high")
    )
