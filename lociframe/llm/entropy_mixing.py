"""Mixing sources to target weights by entropy balancing, in built-in functions only.

Every source gets a token target. Document rates minimise the relative entropy to one copy each under
two constraints, a source's words meet its target and no rate exceeds ``cap``, so they are
exponentially tilted: rate = min(cap, exp(lambda * size / mean size)). The multiplier of each source
maximises the convex dual and is found by Newton steps with bisection as a guard, all sources at once.

Documents of one source and size have one rate, so the iterations run over the table of
(source, size, salt) counts, which Spark sums map-side and which is written once. Salts split cells
with many documents; nothing else is ordered but a cell. Rates become copies by rounding the running sum of rates
over the cells of a source, and documents that fit then mend what rounding left, however many it takes.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
#: Documents of one (source, size, salt) cell that a task orders at once, on average.
CELL_ROWS = 10_000


def n_words(text: Column) -> Column:
    """Words between white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, source_size): by code point order, null last, sources weigh ``weights`` in turn.

    The targets share ``share`` of all sizes by weight; none exceeds ``cap`` times its source's size, and
    the excess goes to the others by weight until none is above. An empty table gives no rows.
    """
    # Rank within ranges of sources plus the number of sources in the ranges before: no single ordered task.
    ranged = written(
        sizes.withColumn("is_null", F.col("source").isNull()).repartitionByRange("is_null", "source")
        .withColumn("part", F.spark_partition_id()), "mix-sources")
    before = ranged.groupBy("part").count()
    before = before.select("part", (F.sum("count").over(Window.orderBy("part")) - F.col("count")).alias("before"))
    rank = F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy("is_null", "source")) - 1
    weight = F.get(F.array(*map(F.lit, weights)), F.pmod(rank, F.lit(len(weights))).cast("int"))
    ranked = written(ranged.join(before, "part").select("source", "source_size", weight.alias("weight")), "mix-weights")
    # Water level: capped sources give up their excess until the level stands. Each round caps at least one more.
    total = share * (ranked.agg(F.sum("source_size").alias("n")).first().n or 0)
    level = 0.0
    while True:
        above = F.col("weight") * level >= cap * F.col("source_size")
        row = ranked.agg(F.sum(F.when(above, cap * F.col("source_size"))).alias("capped"), F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        new = (total - (row.capped or 0.0)) / row.weight if row.weight else level
        if new <= level * (1 + 1e-15):
            break
        level = new
    return ranked.select("source", "source_size", F.least(F.col("weight") * F.lit(level), F.lit(cap) * F.col("source_size")).alias("target"))


def tilted_rate(factor: Column, size: Column, mean: Column, cap: float) -> Column:
    """exp(factor * size / mean), at most ``cap``."""
    return F.least(F.lit(cap), F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), factor * size / mean))))


def balance(cells: DataFrame, targets: DataFrame, cap: float, tolerance: float = 1e-6, rounds: int = 60) -> DataFrame:
    """(source_key, factor, mean): the multiplier of every source, from (source_key, size, n) cells of sizes above 0.

    Newton on the dual; a step that leaves the bracket of the root is replaced by its middle. A source
    whose target is the whole cap ends at the bracket's upper edge, where every rate is the cap.
    """
    shape = cells.groupBy("source_key").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"), F.min("size").alias("least"))
    wide = F.col("mean") / F.col("least")
    state = written(
        targets.join(shape, "source_key").select(
            "source_key", "target", "mean", F.lit(0.0).alias("factor"), (-700.0 * wide).alias("low"), (F.log(F.lit(cap)) * wide + 1).alias("high"), F.lit(False).alias("done")), "mix-state")
    for _ in range(rounds):
        rate = tilted_rate(F.col("factor"), F.col("size"), F.col("mean"), cap)
        tilted = F.col("factor") * F.col("size") / F.col("mean") < F.log(F.lit(cap))
        sums = cells.join(state.filter("not done"), "source_key").groupBy("source_key").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("words"),
            F.sum(F.when(tilted, F.col("n") * F.col("size") * rate * F.col("size") / F.col("mean")).otherwise(0.0)).alias("slope"))
        gap = F.col("words") - F.col("target")
        near = F.abs(gap) <= tolerance * F.greatest(F.col("target"), F.lit(1.0))
        step = F.col("factor") - F.try_divide(gap, F.col("slope"))
        low = F.when(gap < 0, F.col("factor")).otherwise(F.col("low"))
        high = F.when(gap > 0, F.col("factor")).otherwise(F.col("high"))
        inside = step.isNotNull() & (step > low) & (step < high)
        state = written(
            state.join(sums, "source_key", "left").withColumns({"new_low": low, "new_high": high, "near": F.coalesce(near, F.lit(True)), "inside": F.coalesce(inside, F.lit(False)), "step": step})
            .select("source_key", "target", "mean",
                    F.when(F.col("near"), F.col("factor")).when(F.col("inside"), F.col("step")).otherwise((F.col("new_low") + F.col("new_high")) / 2).alias("factor"),
                    F.coalesce("new_low", "low").alias("low"), F.coalesce("new_high", "high").alias("high"),
                    (F.col("done") | F.col("near")).alias("done")), "mix-state")
        if state.filter("not done").isEmpty():
            break
    return state.select("source_key", "factor", "mean")


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, cap: int = 2, cell_rows: int = CELL_ROWS) -> DataFrame:
    """``docs`` with a struct column ``_mix``: size, source_size, target and copies (0 to ``cap``) of each document.

    docs: doc_id, text, source. Size is the number of words; a document without words gets one copy,
    which costs nothing. The words taken of a source (copies x size) come near its target: rounding
    leaves less than its longest document, and as many documents as the rest needs mend it until no
    document more or less brings the source closer. Which documents of a size get a copy more is settled by a hash of id and text, so reruns
    agree; rows equal in id and text get the same copies. Null sources form one source; null ids count
    like any others. A column ``_mix`` is replaced, other columns pass. An empty table stays empty.
    """
    docs = docs.drop("_mix")
    key = F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), F.col("source").cast("string")))
    cell = ["source_key", "size", "salt"]
    sized = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"), n_words(docs["text"]).alias("size"), key.alias("source_key"), F.xxhash64("doc_id", "text").alias("tie"))
    light = written(sized.select("source_key", "size", "tie"), "mix-sizes")
    largest = light.groupBy("source_key", "size").count().agg(F.max("count").alias("n")).first().n or 0
    salt = F.pmod("tie", F.lit(max(1, -(-largest // cell_rows)))).cast("int")
    light = light.withColumn("salt", salt)
    cells = written(light.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")), "mix-cells")
    sizes = cells.groupBy("source_key").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    name = F.when(F.col("source_key") != "n", F.substring("source_key", 2, 2**31 - 1)).alias("source")
    targets = written(
        source_targets(sizes.select(name, "source_size"), weights, share, float(cap))
        .select(key.alias("source_key"), "source_size", "target"), "mix-targets")
    worded = cells.filter("size > 0")
    factors = balance(worded, targets, float(cap))
    # Copies of a cell: how far the running sum of its source's rates moves, rounded. Cells run by size,
    # largest first, so the error stays below the longest document.
    order = Window.partitionBy("source_key").orderBy(F.desc("size"), "salt")
    rate = tilted_rate(F.col("factor"), F.col("size"), F.col("mean"), float(cap))
    running = (
        worded.join(factors, "source_key").withColumn("end", F.sum(F.col("n") * rate).over(order))
        .withColumn("start", F.coalesce(F.lag("end").over(order), F.lit(0.0))))
    taken = written(running.select(*cell, "n", F.least(F.col("n") * cap, F.round("end") - F.round("start")).cast("long").alias("copies")), "mix-copies")
    while True:
        # Documents that fit into what a source lacks or has too much, largest first; where none fits, the one
        # that comes closest. A filling round at least halves the gap and every round narrows it.
        words = taken.groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("words"))
        gaps = targets.join(words, "source_key").select("source_key", (F.col("target") - F.col("words")).alias("gap"))
        room = F.when(F.col("gap") > 0, F.col("n") * cap - F.col("copies")).otherwise(F.col("copies"))
        open_cells = (
            taken.join(gaps, "source_key").withColumns({"room": room, "by": F.signum("gap").cast("long"), "gap": F.abs("gap")})
            .filter((F.col("room") > 0) & (F.abs(F.col("gap") - F.col("size")) < F.col("gap"))))
        fitting = open_cells.filter(F.col("size") <= F.col("gap"))
        before = F.coalesce(F.sum(F.col("size") * F.col("room")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        filled = (
            fitting.withColumn("left", F.col("gap") - before).filter(F.col("left") >= F.col("size"))
            .select(*cell, (F.col("by") * F.least("room", F.floor(F.col("left") / F.col("size")))).alias("by")))
        closest = (
            open_cells.groupBy("source_key").agg(F.min(F.struct((F.col("size") - F.col("gap")).alias("over"), "size", "salt", "by")).alias("best"), F.min("size").alias("least"), F.max("gap").alias("gap"))
            .filter("least > gap").select("source_key", "best.size", "best.salt", "best.by"))
        change = written(filled.unionByName(closest), "mix-mend")
        if change.isEmpty():
            break
        taken = written(taken.join(change, cell, "left").select(*cell, "n", (F.col("copies") + F.coalesce("by", F.lit(0))).alias("copies")), "mix-copies")
    # Within a cell every document gets the whole part; the lowest hashes get one more.
    more = F.pmod("copies", "n")
    ranked = light.join(taken.filter(more > 0), cell).withColumn("rank", F.row_number().over(Window.partitionBy(*cell).orderBy("tie")))
    last = ranked.filter(F.col("rank") == more).select(*cell, F.col("tie").alias("last_tie"))
    decided = (
        taken.join(last, cell, "left").select(*cell, F.floor(F.col("copies") / F.col("n")).alias("each"), "last_tie")
        .unionByName(cells.filter("size = 0").select(*cell, F.lit(1).cast("long").alias("each"), F.lit(None).cast("long").alias("last_tie")))
        .join(targets, "source_key"))
    copies = F.col("each") + F.when(F.col("tie") <= F.col("last_tie"), 1).otherwise(0)
    return sized.withColumn("salt", salt).join(written(decided, "mix-decided"), cell).select(
        "doc.*", F.struct("size", "source_size", "target", copies.alias("copies")).alias("_mix"))
