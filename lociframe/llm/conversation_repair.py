"""Repair of the turn structure of conversations by an auction algorithm for shortest paths.

The rows of a conversation and the states of the role pattern ``(s?(ua)+)?`` span a lattice; its arcs are
the edits (keep, rerole, delete, insert) with integer costs. A path grows from the origin: its end node
either extends along the arc that its price makes tight, or raises its price to the best arc and
contracts. When the path reaches the sink, the prices are dual optimal: every cheapest path runs on
tight arcs only, and the first of them by letters is traced among these.

Rows are sorted by ranges over all tasks and cut into chunks of at most ``CHUNK`` rows. A conversation
that lies within one chunk is solved on the spot. Longer ones, and those at the ends of a task's range,
are solved chunk by chunk: a table of costs between the four states at both ends of each chunk, least
costs to the conversation's end from these, then each chunk's own path towards them. So no task holds the
texts of a long conversation, and the auction's work stays in proportion to the rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

CHUNK = 64
SPACES = " \t\n\x0b\x0c\r"

#: States of the role pattern: nothing yet, after s, after u, after a. What an inserted or reroled turn leads to, and its role.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLES = ("user", "user", "assistant", "user")
KEEPS = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("a", USER): ASSISTANT, ("u", ASSISTANT): USER}
LEGAL = ("su", "ua", "au")

#: Costs of edits, and what completes the pattern at the end of a conversation from each state by inserts.
RELABEL, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
COMPLETE = (0, 2 * INSERT, INSERT, 0)
ENDING = ("", "II", "I", "")


def lattice(symbols: str, exits: tuple[int, ...]) -> list[list[tuple[str, int, int]]]:
    """Arcs (letter, cost, head) of every node by letter; node 4 i + q is state q after i rows, the last node the sink.

    A symbol is s, u, a or o (other) for a row's role initial, a capital for a truncated row, x for a row
    that must go. Inserts stand before a row; those after the last belong to what follows.
    """
    arcs = []
    for i, symbol in enumerate(symbols):
        below, letter = 4 * i + 4, symbol.lower()
        extra = TRUNCATED if symbol != letter else 0
        for q in range(4):
            out = [("D", DELETE, below + q), ("I", INSERT, 4 * i + NEXT[q])]
            if letter != "x":
                if (letter, q) in KEEPS:
                    out.append(("K", extra, below + KEEPS[letter, q]))
                out.append(("R", RELABEL + extra, below + NEXT[q]))
            arcs.append(out)
    sink = 4 * len(symbols) + 4
    return [*arcs, *[[("", cost, sink)] for cost in exits], []]


def auction(arcs: list[list[tuple[str, int, int]]], origin: int, prices: list[int]) -> None:
    """Raise ``prices`` until a path of tight arcs joins the origin to the sink, the last node.

    Throughout, no node's price exceeds an arc's cost plus the price of its head; this must hold at the
    start (zeros do, and so do prices of an earlier origin). The cycles of the lattice have positive cost.
    """
    sink, path = len(arcs) - 1, [origin]
    while path[-1] != sink:
        node = path[-1]
        best, head = min((cost + prices[j], j) for _, cost, j in arcs[node])
        if prices[node] < best:
            prices[node] = best
            if len(path) > 1:
                path.pop()
        else:
            path.append(head)


def traced(arcs: list[list[tuple[str, int, int]]], origin: int, prices: list[int]) -> tuple[str, int]:
    """Letters of the first tight path from origin to sink, and the state in which it leaves the last row."""
    sink, dead, trail = len(arcs) - 1, set(), [(origin, "", iter(arcs[origin]))]
    while True:
        node, _, rest = trail[-1]
        if node == sink:
            return "".join(letter for _, letter, _ in trail), trail[-2][0] % 4
        for letter, cost, head in rest:
            if head not in dead and prices[node] == cost + prices[head]:
                trail.append((head, letter, iter(arcs[head])))
                break
        else:
            dead.add(node)
            trail.pop()


def solve(symbols: str, exits: tuple[int, ...] = COMPLETE, entry: int = START) -> tuple[str, int]:
    """Letters of the cheapest edits of a chunk from state ``entry``, ties to the least text, and the state after its last row."""
    arcs = lattice(symbols, exits)
    prices = [0] * len(arcs)
    auction(arcs, entry, prices)
    return traced(arcs, entry, prices)


def passage_costs(symbols: str) -> list[int | None]:
    """Least cost from each state before a chunk to each state after it, by rows; None where no edits lead."""
    far = DELETE * len(symbols) + 2 * INSERT * 2
    out: list[int | None] = [None] * 16
    for after in range(4):
        arcs = lattice(symbols, tuple(0 if q == after else far for q in range(4)))
        prices = [0] * len(arcs)
        for before in range(4):
            auction(arcs, before, prices)
            if prices[before] < far:
                out[4 * before + after] = prices[before]
    return out


def exits_of(tables: list[list[int | None]]) -> list[tuple[int, ...]]:
    """For each chunk of a conversation, what each state after it costs more than the cheapest, up to the end."""
    ahead, out = list(COMPLETE), []
    for table in reversed(tables):
        least = min(ahead)
        out.append(tuple(a - least for a in ahead))
        ahead = [min(table[4 * q + x] + ahead[x] for x in range(4) if table[4 * q + x] is not None) for q in range(4)]
    return out[::-1]


def replayed(symbols: str, roles: list[str], texts: list[str], audit: str, state: int) -> tuple[int, list[str], list[str]]:
    """Cost, roles and texts that the edits of a chunk leave."""
    i = cost = 0
    new_roles, new_texts = [], []
    for edit in audit:
        if edit == "D":
            cost += DELETE
        elif edit == "I":
            cost += INSERT
            new_roles.append(ROLES[state])
            new_texts.append("")
            state = NEXT[state]
        else:
            new_roles.append(roles[i] if edit == "K" else ROLES[state])
            new_texts.append(texts[i])
            cost += (RELABEL if edit == "R" else 0) + (TRUNCATED if symbols[i].isupper() else 0)
            state = KEEPS[symbols[i].lower(), state] if edit == "K" else NEXT[state]
        i += edit != "I"
    return cost, new_roles, new_texts


def symbol_of(role: str, text: str, repeated: bool) -> tuple[str, str]:
    """A row's symbol and its first fault: blank, duplicate, truncated or none."""
    words = text.rstrip(SPACES)
    if not words:
        return "x", "blank"
    if repeated:
        return "x", "duplicate"
    initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return (initial, "") if words[-1] in ".!?" else (initial.upper(), "truncated")


CHUNKS = (
    "part int, chunk long, whole boolean, symbols string, audit string, roles array<string>, texts array<string>, first_turn long, last_turn long, "
    "n_turns long, min_turn long, max_turn long, blank long, duplicate long, truncated long, illegal long, first_role string, last_role string"
)


def chunk_row(part: int, chunk: int, rows: list[tuple]) -> dict:
    """What is kept of a chunk: rows are (turn, role, text, repeated), in order."""
    found = [symbol_of(*row[1:]) for row in rows]
    turns = [row[0] for row in rows]
    known = [t for t in turns if t is not None]
    initials = [row[1][:1] for row in rows]
    faults = [f for _, f in found]
    return {
        "part": part, "chunk": chunk, "whole": False, "symbols": "".join(s for s, _ in found), "audit": None, "roles": [row[1] for row in rows], "texts": [row[2] for row in rows],
        "first_turn": turns[0], "last_turn": turns[-1], "n_turns": len(set(known)), "min_turn": min(known, default=None), "max_turn": max(known, default=None),
        "blank": faults.count("blank"), "duplicate": faults.count("duplicate"), "truncated": faults.count("truncated"),
        "illegal": sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False)), "first_role": initials[0], "last_role": initials[-1],
    }


def chunks(turns: DataFrame, most: int = CHUNK) -> DataFrame:
    """Chunks of consecutive rows of one conversation, with audits where a chunk is surely a whole conversation."""
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    rows = rows.withColumn("digest", F.md5("text"))
    firsts = rows.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(F.struct("turn")).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    marked = rows.join(firsts, same).select("conv_id", "turn", "role", "text", (~F.col("turn").eqNullSafe(F.col("first.turn"))).alias("repeated"))
    order = ("conv_id", "turn", "role", "text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        solved, out, n = {}, {"conv_id": []}, 0
        held, conv, before, whole = [], None, None, False

        def put(last: bool) -> None:
            nonlocal n
            row = chunk_row(part, n, held)
            n += 1
            if whole and last:  # begins and ends within the task
                if len(solved) > 50_000:
                    solved.clear()
                if row["symbols"] not in solved:
                    letters, state = solve(row["symbols"])
                    solved[row["symbols"]] = letters + ENDING[state]
                row |= {"whole": True, "audit": solved[row["symbols"]]}
            out["conv_id"].append(conv)
            for name, value in row.items():
                out.setdefault(name, []).append(value)

        def flushed(schema: pa.Schema) -> pa.RecordBatch:
            fields = [schema.field("conv_id"), *CHUNK_FIELDS]
            batch = pa.RecordBatch.from_arrays([pa.array(out.pop(f.name), f.type) for f in fields], names=[f.name for f in fields])
            out.clear()
            out["conv_id"] = []
            return batch

        schema = None
        for batch in batches:
            schema = batch.schema
            for key, turn, role, text, repeated in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if before is not None and key != conv:
                    put(True)
                    held, whole = [], True
                elif len(held) == most:
                    put(False)
                    held, whole = [], False
                conv, row = key, (key, turn, role, text)
                held.append((turn, role, text, repeated or row == before))
                before = row
            if len(out["conv_id"]) >= 256:
                yield flushed(schema)
        if held:
            whole = False  # may go on in the next task
            put(True)
        if out["conv_id"]:
            yield flushed(schema)

    return marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(cut, f"conv_id {kind}, {CHUNKS}")


CHUNK_FIELDS = [pa.field(*x) for x in [
    ("part", pa.int32()), ("chunk", pa.int64()), ("whole", pa.bool_()), ("symbols", pa.string()), ("audit", pa.string()), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string())),
    *[(c, pa.int64()) for c in ("first_turn", "last_turn", "n_turns", "min_turn", "max_turn", "blank", "duplicate", "truncated", "illegal")], ("first_role", pa.string()), ("last_role", pa.string()),
]]


def in_order(rows: DataFrame, *columns: str) -> DataFrame:
    """One row per conversation: its chunks' short columns as a list in order."""
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", "chunk", *columns))).alias("chunks"))


def solved_in_parts(some: DataFrame) -> DataFrame:
    """(part, chunk, entry, audit) of chunks whose conversation takes more than one, or may do so."""
    def tables(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [passage_costs(s) for s in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(costs, pa.list_(pa.int64()))], names=[*batch.schema.names, "costs"])

    def ahead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [{"part": c["part"], "chunk": c["chunk"], "symbols": c["symbols"], "exits": e, "head": not i}
                    for one in batch.column(0).to_pylist() for i, (c, e) in enumerate(zip(one, exits_of([c["costs"] for c in one]), strict=True))]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("symbols", pa.string()), ("exits", pa.list_(pa.int64())), ("head", pa.bool_())]))

    def options(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[solve(r["symbols"], tuple(r["exits"]), q) for q in range(1 if r["head"] else 4)] for r in batch.to_pylist()]
            ways = pa.array([[{"audit": a, "after": x} for a, x in f] for f in found], pa.list_(pa.struct([("audit", pa.string()), ("after", pa.int32())])))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), ways], names=["part", "chunk", "ways"])

    def chained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for one in batch.column(0).to_pylist():
                state = START
                for c in one:
                    way = c["ways"][state]
                    rows.append({"part": c["part"], "chunk": c["chunk"], "entry": state, "audit": way["audit"]})
                    state = way["after"]
                rows[-1]["audit"] += ENDING[state]
            yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("chunk", pa.int64()), ("entry", pa.int32()), ("audit", pa.string())]))

    kind = some.schema["conv_id"].dataType.simpleString()
    keyed = some.select("conv_id", "part", "chunk", "symbols")
    passages = in_order(keyed.mapInArrow(tables, f"conv_id {kind}, part int, chunk long, symbols string, costs array<long>"), "symbols", "costs").select("chunks")
    targets = passages.mapInArrow(ahead, "part int, chunk long, symbols string, exits array<long>, head boolean").repartition("part", "chunk")
    ways = targets.mapInArrow(options, "part int, chunk long, ways array<struct<audit: string, after: int>>")
    named = in_order(keyed.drop("symbols").join(ways, ["part", "chunk"]), "ways").select("chunks")
    return named.mapInArrow(chained, "part int, chunk long, entry int, audit string")


def repair(turns: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Chunks of the conversations in ``turns`` (conv_id, turn, role, text) with their cheapest edits and what these leave.

    Result: conv_id, part and chunk (their order within a conversation), audit (letters D, I, K, R), cost,
    roles and texts after the edits, and counts of what the rows showed before; ``summary`` adds them up,
    ``repaired_turns`` lists the turns. Rows go by turn, nulls first, equal turns by role and text; equal
    rows stay rows, all but the first are duplicates. Null roles and texts are one space, a null conv_id is
    a conversation; texts may be of any length; other columns are ignored. An empty table gives no chunks.
    """
    cut = written(chunks(turns, chunk), "turn-chunks")
    parted = cut.filter("not whole")
    whole = cut.filter("whole").withColumn("entry", F.lit(0))
    rest = parted.drop("audit").join(solved_in_parts(parted), ["part", "chunk"]).select(*whole.columns)
    both = whole.unionByName(rest)
    names = both.columns
    kind = both.schema["conv_id"].dataType.simpleString()
    at = {c: names.index(c) for c in ("symbols", "roles", "texts", "audit", "entry")}

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            done = [replayed(*row) for row in zip(*(batch.column(at[c]).to_pylist() for c in ("symbols", "roles", "texts", "audit", "entry")), strict=True)]
            new = [pa.array([d[i] for d in done], t) for i, t in enumerate((pa.int64(), pa.list_(pa.string()), pa.list_(pa.string())))]
            kept = [c for c in names if c not in ("roles", "texts", "entry")]
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in kept], *new], names=[*kept, "cost", "roles", "texts"])

    kept = CHUNKS.replace("roles array<string>, texts array<string>, ", "")
    return written(both.mapInArrow(replay, f"conv_id {kind}, {kept}, cost long, roles array<string>, texts array<string>"), "repaired")


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """(conv_id, part, chunk, at, role, text): the turns after repair; order by part, chunk, at."""
    return repaired.select("conv_id", "part", "chunk", F.posexplode(F.arrays_zip("roles", "texts")).alias("at", "t")).select(
        "conv_id", "part", "chunk", "at", F.col("t.roles").alias("role"), F.col("t.texts").alias("text"))


def summary(repaired: DataFrame) -> DataFrame:
    """One row per conversation with rows: gaps, blank, duplicate, truncated, illegal, cost, audit."""
    counts = ("blank", "duplicate", "truncated", "illegal", "cost", "n_turns")
    lists = repaired.groupBy("conv_id").agg(
        *[F.sum(c).alias(c) for c in counts], F.min("min_turn").alias("low"), F.max("max_turn").alias("high"),
        F.array_sort(F.collect_list(F.struct("part", "chunk", "audit", "first_turn", "last_turn", "first_role", "last_role"))).alias("c"))
    borders = F.zip_with(F.slice("c", 1, F.size("c") - 1), F.slice("c", 2, F.size("c")), lambda a, b: F.struct(
        (a["last_turn"] == b["first_turn"]).alias("same_turn"), (~F.concat(a["last_role"], b["first_role"]).isin(*LEGAL)).alias("illegal")))
    borders = F.when(F.size("c") > 1, borders)

    def number(field: str):
        return F.coalesce(F.size(F.filter(borders, lambda b: b[field])), F.lit(0)).cast("long")

    # a turn that goes on in the next chunk was counted in both
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("n_turns") + number("same_turn"), F.lit(0))
    return lists.select(
        "conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", (F.col("illegal") + number("illegal")).alias("illegal"), "cost",
        F.array_join(F.transform("c", lambda x: x["audit"]), "").alias("audit"))
