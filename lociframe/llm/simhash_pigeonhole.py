"""Near-duplicate documents by SimHash fingerprints under the generalised pigeonhole principle.

Bits that go together over all distinct fingerprints are put into one of m partitions. Two fingerprints
within ``most`` bits of each other agree, for any thresholds t(1..m) of at least -1 with sum of
``t + 1`` equal to ``most + 1``, in some partition up to that partition's threshold. Each fingerprint
picks its own thresholds: dynamic programming spends the ``most + 1`` units on the partitions so that the
estimated number of candidates, plus the price of the probes, is smallest. A partition in which its
value is frequent gets -1 (not probed) or 0 (the same value), a selective one more. The estimates are
products of exact distance counts of parts of at most eight bits, so what the driver sees is a fixed
number of counts. Every fingerprint is indexed under its value in each partition; probes go to all values
within the threshold; whoever meets in a bucket is compared on all 64 bits.

Buckets emit no pairs: every bucket is walked breadth first and gives each member reached one edge to
where the walk began. A bucket of more than ``block`` members is dealt to tasks by pairs of blocks.
"""
from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .store import written

SHINGLE, SEED, MOST, BITS = 4, 42, 4, 64

#: Numbers of partitions to choose from by estimated cost, and the cost of a probe in comparisons.
PARTITIONS, PROBE = (2, 3, 4, 5), 100

#: Members of a bucket that one task compares at once, and rows it gathers before comparing.
BLOCK, CHUNK_ROWS = 50_000, 200_000

#: Buckets of up to so many members are compared together, position by position.
SMALL = 64

LOWER = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))
_HASHES = 1 << 15


def fingerprint(text: bytes, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """SimHash of one text: a bit is 1 if it is set in over half the XXH64 of its word shingles, repeats included; 0 without words."""
    from xxhash import xxh64_intdigest

    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    counts = np.zeros(BITS, np.int64)
    for first in range(0, n, _HASHES):
        last = min(n, first + _HASHES)
        stops = ends[first + shingle - 1 : last + shingle - 1] if len(words) >= shingle else ends[-1:]
        hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts[first:last].tolist(), stops.tolist(), strict=True)], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """(key, fingerprint) of every row of ``docs``, the fingerprint as a long; null texts have no words, whole texts of any length count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            found = np.fromiter((fingerprint((t.as_py() or "").encode(), shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=[key, "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(docs[key], docs["text"].cast("string").alias("text")).mapInArrow(run, f"`{key}` {kind}, fingerprint long")


def bit_matrix(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def values_of(bits: np.ndarray, at: list[int]) -> np.ndarray:
    """The number that the bits at ``at`` of each fingerprint spell."""
    return bits[:, at].astype(np.int64) @ (np.int64(1) << np.arange(len(at)))


def prints_of(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def summed(prints: DataFrame, count, size: int) -> np.ndarray:
    """Sum over all fingerprints of the vector that ``count`` makes of an array of them; a row per cell and task is shuffled."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += count(prints_of(batch))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["cell", "n"])

    cells = prints.select("fingerprint").mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(size)
    for row in cells.collect():
        out[row.cell] = row.n
    return out


def together(prints: np.ndarray) -> np.ndarray:
    """How many fingerprints have both of two bits set."""
    bits = bit_matrix(prints).astype(np.float32)
    return (bits.T @ bits).astype(np.float64).ravel()


def partitions(both: np.ndarray, n: float, m: int) -> list[list[int]]:
    """The 64 bits in m groups of nearly equal size, correlated bits together.

    A group starts with the free bit of the largest correlations and takes on the free bit with the largest
    mean correlation to its members.
    """
    share = both.reshape(BITS, BITS) / max(n, 1)
    p = share.diagonal()
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    near = np.abs(np.divide(share - np.outer(p, p), spread, out=np.zeros_like(share), where=spread > 0))
    np.fill_diagonal(near, 0)
    free, groups = list(range(BITS)), []
    for i in range(m):
        group = [max(free, key=lambda b: (near[b, free].sum(), -b))]
        free.remove(group[0])
        while len(group) < BITS // m + (i < BITS % m):
            group.append(max(free, key=lambda b: (near[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(sorted(group))
    return groups


def parts_of(groups: list[list[int]]) -> list[list[list[int]]]:
    """Each group of bits cut into parts of at most eight."""
    return [[g[i::-(-len(g) // 8)] for i in range(-(-len(g) // 8))] for g in groups]


def part_counts(groups: list[list[int]], prints: np.ndarray) -> np.ndarray:
    """Fingerprints by value of each part, 256 cells a part."""
    bits = bit_matrix(prints)
    return np.concatenate([np.bincount(values_of(bits, part), minlength=256) for parts in parts_of(groups) for part in parts]).astype(np.float64)


class Allocation:
    """Thresholds of fingerprints for one partitioning, from the counts of its parts."""

    def __init__(self, groups: list[list[int]], counts: np.ndarray, n: float, most: int):
        self.groups, self.parts, self.n, self.most = groups, parts_of(groups), n, most
        apart = np.bitwise_count(np.arange(256)[:, None] ^ np.arange(256)[None, :])
        shares = counts.reshape(-1, 256) / max(n, 1)
        near = np.stack([shares @ (apart == d) for d in range(most + 1)], axis=2)  # part, value, distance: share of fingerprints
        self.near = iter_parts(near, self.parts)
        self.probes = [[sum(comb(len(g), d) for d in range(1, t + 1)) for t in range(most + 1)] for g in groups]

    def thresholds(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(thresholds, cost) of each fingerprint: row, partition; -1 is no probe."""
        rows, units = len(bits), self.most + 1
        best = np.full((rows, units + 1), np.inf)
        best[:, 0] = 0
        picks = []
        for parts, near, probes in zip(self.parts, self.near, self.probes, strict=True):
            shares = None
            for part, table in zip(parts, near, strict=True):
                one = table[values_of(bits, part)]
                shares = one if shares is None else np.stack([sum(shares[:, k] * one[:, d - k] for k in range(d + 1)) for d in range(units)], axis=1)
            cost = np.cumsum(shares, axis=1) * self.n + PROBE * np.array(probes)
            cost = np.concatenate([np.zeros((rows, 1)), cost], axis=1)
            options = np.full((units + 1, rows, units + 1), np.inf)
            for u in range(units + 1):
                options[u, :, u:] = best[:, : units + 1 - u] + cost[:, u : u + 1]
            picks.append(options.argmin(axis=0))
            best = options.min(axis=0)
        left, out = np.full(rows, units), np.zeros((rows, len(self.groups)), np.int64)
        for i in reversed(range(len(self.groups))):
            out[:, i] = picks[i][np.arange(rows), left]
            left = left - out[:, i]
        return out - 1, best[:, units]


def iter_parts(near: np.ndarray, parts: list[list[list[int]]]) -> list[list[np.ndarray]]:
    tables = iter(near)
    return [[next(tables) for _ in group] for group in parts]


def dealt(allocation: Allocation, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, fingerprint, probe) rows: each fingerprint in its own bucket of each partition, and in those it probes."""
    bits = bit_matrix(prints)
    thresholds, _ = allocation.thresholds(bits)
    keys, who, probe = [], [], []
    for i, group in enumerate(allocation.groups):
        own = values_of(bits, group) + (np.int64(i) << 33)
        keys.append(own)
        who.append(prints)
        probe.append(thresholds[:, i] >= 0)
        for t in range(1, int(thresholds[:, i].max(initial=0)) + 1):
            wide = np.flatnonzero(thresholds[:, i] >= t)
            flips = np.array([sum(1 << b for b in c) for c in combinations(range(len(group)), t)], np.int64)
            keys.append((own[wide, None] ^ flips[None, :]).ravel())
            who.append(np.repeat(prints[wide], len(flips)))
            probe.append(np.ones(len(wide) * len(flips), bool))
    return np.concatenate(keys), np.concatenate(who), np.concatenate(probe)


def walked(prints: np.ndarray, probe: np.ndarray, most: int) -> np.ndarray:
    """For each member of one bucket the member where the walk that reached it began, else itself.

    Walks begin at probes; every member reached is compared with all not yet reached, so each probe ends up
    with everyone in the bucket within ``most`` bits of it.
    """
    root, free = np.arange(len(prints)), np.arange(len(prints))
    reached = np.zeros(len(prints), bool)
    for start in np.flatnonzero(probe):
        if reached[start]:
            continue
        reached[start] = True
        free = free[~reached[free]]
        queue = [np.array([start])]
        while queue and len(free):
            front = queue.pop()
            step = max(1, (1 << 20) // len(free))
            if len(front) > step:
                queue.append(front[step:])
                front = front[:step]
            hit = (np.bitwise_count(prints[front][:, None] ^ prints[free][None, :]) <= most).any(axis=0)
            if hit.any():
                new = free[hit]
                root[new], reached[new] = start, True
                free = free[~hit]
                queue.append(new)
    return root


def bucket_edges(bucket: np.ndarray, prints: np.ndarray, probe: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges (a, b) that connect, in each of the whole buckets given in order, whatever its probes connect."""
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    firsts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(bucket)]])
    sizes = ends - firsts
    useful = (sizes > 1) & (np.add.reduceat(probe.astype(np.int64), firsts) > 0)
    head = np.arange(len(bucket))
    at = np.flatnonzero(np.repeat(useful & (sizes <= SMALL), sizes))
    end = np.repeat(ends, sizes)
    pairs_a, pairs_b, d = [], [], 0
    while len(at):
        d += 1
        at = at[at + d < end[at]]
        hit = at[(np.bitwise_count(prints[at] ^ prints[at + d]) <= most) & (probe[at] | probe[at + d])]
        pairs_a.append(hit)
        pairs_b.append(hit + d)
    if pairs_a:
        a, b = np.concatenate(pairs_a), np.concatenate(pairs_b)
        while len(a):
            before = head.copy()
            np.minimum.at(head, a, head[b])
            np.minimum.at(head, b, head[a])
            head = head[head]
            if (before == head).all():
                break
    for i in np.flatnonzero(useful & (sizes > SMALL)):
        some = slice(firsts[i], ends[i])
        head[some] = firsts[i] + walked(prints[some], probe[some], most)
    linked = np.flatnonzero(head != np.arange(len(head)))
    return prints[linked], prints[head[linked]]


def edges(prints: DataFrame, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """Edges (a, b) between fingerprints of the distinct ``prints`` that connect all within ``most`` bits of each other."""
    both = summed(prints, lambda p: np.concatenate([together(p), [len(p)]]), BITS * BITS + 1)
    n = both[-1]
    groupings = [partitions(both[:-1], n, m) for m in PARTITIONS]
    cells = [256 * sum(map(len, parts_of(g))) for g in groupings]
    counts = np.split(summed(prints, lambda p: np.concatenate([part_counts(g, p) for g in groupings]), sum(cells)), np.cumsum(cells)[:-1])
    choices = [Allocation(g, c, n, most) for g, c in zip(groupings, counts, strict=True)]
    costs = summed(prints, lambda p: np.array([c.thresholds(bit_matrix(p))[1].sum() + PROBE * len(c.groups) * len(p) for c in choices]), len(choices))
    chosen = choices[int(costs.argmin())]

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = bit_matrix(prints_of(batch))
            keys, number = np.unique(np.concatenate([values_of(bits, g) + (np.int64(i) << 33) for i, g in enumerate(chosen.groups)]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(number)], names=["bucket", "n"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                keys, who, probe = dealt(chosen, prints_of(batch))
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(who.view(np.int64)), pa.array(probe)], names=["bucket", "fingerprint", "probe"])

    ids = prints.select("fingerprint")
    hot = written(ids.mapInArrow(frequent, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).filter(F.col("n") > block), "hot-buckets")
    blocks = F.ceil(F.coalesce("n", F.lit(0)) / block).cast("int")
    mine = F.pmod(F.xxhash64("fingerprint"), F.greatest(blocks, F.lit(1))).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.greatest(blocks, F.lit(1)) - 1))
    rows = ids.mapInArrow(deal, "bucket long, fingerprint long, probe boolean").join(hot, "bucket", "left").select("bucket", "fingerprint", "probe", mine.alias("mine"), other.alias("other"))
    rows = rows.select("bucket", (F.least("mine", "other") * F.lit(1 << 20).cast("long") + F.greatest("mine", "other")).alias("pair"), "fingerprint", "probe")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_held = [], 0

        def compared(columns: list[np.ndarray], upto: int) -> pa.RecordBatch:
            bucket, pair, prints, probe = (c[:upto] for c in columns)
            number = np.concatenate([[0], np.cumsum((np.diff(bucket) != 0) | (np.diff(pair) != 0))])
            a, b = bucket_edges(number, prints.view(np.uint64), probe, most)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            n_held += batch.num_rows
            if n_held < CHUNK_ROWS:
                continue
            columns = [np.concatenate(c) for c in zip(*held, strict=True)]
            last = np.flatnonzero((columns[0] != columns[0][-1]) | (columns[1] != columns[1][-1]))
            if len(last):  # the last bucket may go on in the next batch
                yield compared(columns, last[-1] + 1)
                columns = [c[last[-1] + 1 :] for c in columns]
            held, n_held = [columns], 0 if len(last) else n_held // 2
        columns = [np.concatenate(c) for c in zip(*held, strict=True)] if held else []
        if columns and len(columns[0]):
            yield compared(columns, len(columns[0]))

    return rows.repartition("bucket", "pair").sortWithinPartitions("bucket", "pair").mapInArrow(compare, "a long, b long")


def near_duplicates(prints: DataFrame, key: str = "doc_id", most: int = MOST, block: int = BLOCK) -> DataFrame:
    """(key, fingerprint, component_id) of every row of ``prints`` (key, fingerprint).

    Fingerprints link at ``most`` or fewer differing bits, equal ones always; component_id is the smallest
    key that links reach, null where all of these keys are null. Fingerprint zero (no words) links like
    any other. Repeated rows and null keys keep their rows; an empty table gives no rows. Distinct
    fingerprints are linked, so copies cost nothing; rows of one fingerprint are never grouped in a task.
    """
    prints = prints.select(F.col(key).alias("key"), "fingerprint")
    distinct = written(prints.groupBy("fingerprint").agg(F.min("key").alias("first")), "fingerprints")
    labels = components(written(edges(distinct, most, block).distinct(), "near-prints"))
    linked = labels.select(F.col("id").alias("fingerprint"), "label").join(distinct, "fingerprint")
    least = linked.groupBy("label").agg(F.min("first").alias("least"))
    heads = distinct.join(linked.join(least, "label").select("fingerprint", "least"), "fingerprint", "left")
    heads = heads.select("fingerprint", F.coalesce("least", "first").alias("component_id"))
    return prints.join(heads, "fingerprint").select(F.col("key").alias(key), "fingerprint", "component_id")
