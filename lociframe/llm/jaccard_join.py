"""Exact self-join of documents on the Jaccard similarity of their word shingles, by set-relation skipping.

Sets are 64-bit hashes of shingles. Documents with equal sets form one class and are never paired.

1. Every document lists its lowest hashes, enough that two linked documents share at least a tenth of
   their sets among them. Hashes that no other class lists are dropped, and classes that keep too few can
   link with nothing. Only the survivors' texts are looked at again.
2. Survivors order their hashes by document frequency among survivors, rarest first. Linked classes
   share one in their prefixes; stars over the prefixes' hashes give clusters that no link leaves.
3. Clusters are joined in tasks. Index-level skipping: index lists run by set size, so whole blocks of a
   list outside the sizes that can link are skipped by position. Answer-level skipping: the overlaps of a
   set are derived from those of a similar set already computed, by adding and subtracting the lists of
   the hashes in which the two differ. Large clusters are cut into blocks, each pair of blocks one task,
   so no task holds an unbounded cluster and no pair becomes a row; tasks return counts and labels.

Everything is exact up to collisions of 64-bit shingle hashes.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .store import written

SHINGLE = 5
#: Link: 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Hashes of a block of a cluster.
BLOCK_HASHES = 4_000_000
#: Bits of the mask that names surviving classes to the second look at the texts (1 MB, whatever the input).
MASK_BITS = 1 << 23


def least_overlap(n, percent: int = PERCENT):
    """Smallest overlap of a set of n with any set it links with (whole-number ceiling)."""
    return -(-(n * percent) // 100)


def shingle_sets(batch: pa.RecordBatch, size: int = SHINGLE) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row of ``text``, and two 64-bit digests of each set (0 if empty)."""
    sets, first, second = [], [], []
    for _, _, data, offsets in W.slices(batch):
        data = W.LOWER[data]
        starts, ends, rows = W.spans(data, offsets, W.SPACES)
        hashes, firsts = W.window_hashes(W.word_hashes(data, starts, ends), rows, size)
        for i in range(len(firsts) - 1):
            x = np.sort(hashes[firsts[i] : firsts[i + 1]])
            x = x[np.concatenate([[True], x[1:] != x[:-1]])] if len(x) else x
            sets.append(x)
            n = np.uint64(len(x))
            first.append(W.mix(x + np.uint64(1)).sum(dtype=np.uint64) + n)
            second.append(W.mix(x ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) ^ n)
    return sets, np.array(first, np.uint64).view(np.int64), np.array(second, np.uint64).view(np.int64)


def signatures(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """doc_id, tie (hash of the text), n, d1, d2 of every row of (doc_id, text)."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets, d1, d2 = shingle_sets(batch, size)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tie"), pa.array([len(x) for x in sets], pa.int64()), pa.array(d1), pa.array(d2)], names=["doc_id", "tie", "n", "d1", "d2"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tie"))
    return rows.mapInArrow(sign, "doc_id long, tie long, n long, d1 long, d2 long")


def _survivors(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """Classes (id, d1, d2, n, copies) whose lowest hashes are shared with other classes often enough to link."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows: (hash, d1) of a hash that one class of this batch lists; (hash, null) of one that several do;
        # (null, d1, k) for each class, k counting its hashes of the second kind.
        for batch in batches:
            sets, d1, _ = shingle_sets(batch, size)
            own = {int(d): x for d, x in zip(d1, sets, strict=True) if len(x)}
            keys = np.fromiter(own, np.int64, len(own))
            heads = [x[: len(x) - least_overlap(len(x), percent) + max(1, len(x) // 10)] for x in own.values()]
            owner = np.repeat(np.arange(len(heads)), [len(x) for x in heads])
            flat = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
            values, back, counts = np.unique(flat, return_inverse=True, return_counts=True)
            several = counts[back] > 1
            k = np.bincount(owner[several], minlength=len(keys))
            single, many = flat[~several].view(np.int64), values[counts > 1].view(np.int64)
            yield pa.RecordBatch.from_arrays([
                pa.concat_arrays([pa.array(single), pa.array(many), pa.nulls(len(keys), pa.int64())]),
                pa.concat_arrays([pa.array(keys[owner[~several]], pa.int64()), pa.nulls(len(many), pa.int64()), pa.array(keys)]),
                pa.concat_arrays([pa.nulls(len(single) + len(many), pa.int32()), pa.array(k.astype(np.int32))]),
            ], names=["hash", "d1", "k"])

    rows = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(listed, "hash long, d1 long, k int")
    # A hash has at most one row for each batch that lists it, however many documents hold it.
    window = Window.partitionBy("hash")
    shared = rows.filter("hash is not null").withColumns({
        "low": F.min("d1").over(window), "high": F.max("d1").over(window), "marks": F.count(F.when(F.col("d1").isNull(), 1)).over(window),
    }).filter("d1 is not null and (low <> high or marks > 0)").groupBy("d1").agg(F.count(F.lit(1)).alias("shared"))
    looked = rows.filter("hash is null").groupBy("d1").agg(F.sum("k").alias("shared"), F.count(F.lit(1)).alias("times"))
    # Copies in several batches list the same hashes each time.
    total = looked.join(shared.withColumnRenamed("shared", "more"), "d1", "left").select("d1", ((F.col("shared") + F.coalesce("more", F.lit(0))) / F.col("times")).alias("shared"))
    kept = classes.join(total, "d1").filter(F.col("shared") >= F.greatest(F.lit(1), F.floor(F.col("n") / 10)))
    return written(kept.select("d1", "d2", "n", "copies", F.monotonically_increasing_id().alias("id")), "join-survivors")


def _survivor_sets(docs: DataFrame, survivors: DataFrame, size: int) -> DataFrame:
    """(id, n, copies, hashes) of the surviving classes, from a second look at the texts."""
    position = F.pmod("d1", F.lit(MASK_BITS))
    cells = survivors.select(position.alias("p")).groupBy((F.col("p") / 64).cast("long").alias("cell")).agg(F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).collect()
    mask = np.zeros(MASK_BITS // 64, np.int64)
    for r in cells:  # at most MASK_BITS / 64 rows
        mask[r.cell] = r.bits
    held = docs.sparkSession.sparkContext.broadcast(mask.tobytes())

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, seen = np.frombuffer(held.value, np.int64), set()
        for batch in batches:
            sets, d1, d2 = shingle_sets(batch, size)
            at = d1 % MASK_BITS
            named = np.flatnonzero((bits[at // 64] >> (at % 64)) & 1)
            named = [i for i in named if len(sets[i]) and (key := (int(d1[i]), int(d2[i]))) not in seen and not seen.add(key)]
            yield pa.RecordBatch.from_arrays([pa.array(d1[named]), pa.array(d2[named]), pa.array([sets[i].view(np.int64) for i in named], pa.list_(pa.int64()))], names=["d1", "d2", "hashes"])

    found = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(again, "d1 long, d2 long, hashes array<long>")
    return found.join(survivors, ["d1", "d2"]).groupBy("id").agg(F.first("n").alias("n"), F.first("copies").alias("copies"), F.first("hashes").alias("hashes"))


def _lists(tokens: np.ndarray, owners: np.ndarray, n_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Index lists of tokens 0..n_tokens-1: owners in one array, ascending within a list, and list starts."""
    order = np.argsort(tokens, kind="stable")
    return owners[order], np.searchsorted(tokens[order], np.arange(n_tokens + 1))


def joined(query_sets: list[np.ndarray], query_n: np.ndarray, index_sets: list[np.ndarray], index_n: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[int, np.ndarray]]:
    """(query, index members linked with it) for all queries, by set-relation skipping.

    index_n must ascend. Sets hold only hashes that occur in several sets; n is the size with all.
    """
    values, flat = np.unique(np.concatenate([*index_sets, np.zeros(0, np.int64)]), return_inverse=True)
    owners, starts = _lists(flat, np.repeat(np.arange(len(index_sets)), [len(s) for s in index_sets]), len(values))
    lengths = np.diff(starts)
    answered: list[tuple[np.ndarray, np.ndarray]] = []  # tokens and overlaps of sets answered from the lists
    for q, (hashes, n) in enumerate(zip(query_sets, query_n.tolist(), strict=True)):
        at = np.searchsorted(values, hashes)
        tokens = np.sort(at[(at < len(values)) & (values[np.minimum(at, len(values) - 1)] == hashes)]) if len(values) else at[:0]
        low = int(np.searchsorted(index_n, least_overlap(n, percent), "left"))
        high = int(np.searchsorted(index_n, 100 * n // percent, "right"))
        best, cost = None, int(lengths[tokens].sum())
        for known, overlaps in answered:
            gone, new = np.setdiff1d(known, tokens, True), np.setdiff1d(tokens, known, True)
            c = int(lengths[gone].sum() + lengths[new].sum())
            if 2 * c < cost:
                best, cost = (overlaps, gone, new), 2 * c
        if best:
            overlaps = best[0].copy()
            for part, by in ((best[1], -1), (best[2], 1)):
                for t in part:
                    overlaps[owners[starts[t] : starts[t + 1]]] += by
        else:
            overlaps = np.zeros(len(index_sets), np.int32)
            whole = len(query_sets) > 8  # later sets may build on the answer, so it has to cover all sizes
            for t in tokens:
                a, b = starts[t], starts[t + 1]
                if not whole:  # block skip: only the positions of sizes that can link
                    a, b = a + np.searchsorted(owners[a:b], low), a + np.searchsorted(owners[a:b], high)
                overlaps[owners[a:b]] += 1
            if whole:
                answered = [*answered[-3:], (tokens, overlaps)]
        near = overlaps[low:high].astype(np.int64)
        yield q, low + np.flatnonzero((near > 0) & (100 * near >= percent * (n + index_n[low:high] - near)))


def _cluster_task(percent: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in frame.groupby("cluster", sort=False):
            part = part.sort_values(["n", "id"])
            left, right = part[part["left"]], part[part["right"]]
            same = len(left) == len(part) and len(right) == len(part)
            ids = part["id"].to_numpy()
            place = {i: k for k, i in enumerate(ids.tolist())}
            labels, links = np.arange(len(ids)), np.zeros(len(ids), np.int64)
            left_at, right_at = (np.array([place[i] for i in side["id"]], np.int64) for side in (left, right))
            copies = part["copies"].to_numpy()
            for q, hits in joined(list(left["hashes"]), left["n"].to_numpy(), list(right["hashes"]), right["n"].to_numpy(), percent):
                x, z = left_at[q], right_at[hits]
                z = z[z != x]
                links[x] += copies[z].sum()
                if not same:
                    links[z] += copies[x]
                met = np.unique(labels[np.append(z, x)])
                if len(met) > 1:
                    labels[np.isin(labels, met)] = met[0]
            out.append(pd.DataFrame({"id": ids, "label": ids[labels], "links": links}))
        return pd.concat(out) if out else pd.DataFrame({"id": [], "label": [], "links": []}).astype("int64")

    return run


def join_clusters(members: DataFrame, percent: int = PERCENT, block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """(id, label, links) from members (cluster, id, n, copies, hashes) of clusters that no link leaves; written.

    A member may have several rows: (id, label) are edges whose components are the linked groups, and
    links sum to the copies of the members linked with it. n is the set's size, hashes those of its
    members that may be shared.
    """
    members = written(members.select("cluster", "id", "n", "copies", "hashes"), "join-members")
    sizes = members.groupBy("cluster").agg(F.greatest(F.lit(1), F.ceil(F.sum(F.size("hashes")) / block_hashes)).cast("int").alias("blocks"))
    # Small clusters share a task by a hash of the cluster; each pair of blocks of a large one is a task.
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    n_tasks = max(1, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 8)
    placed = (
        members.join(sizes, "cluster").withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("cluster", "id", "n", "copies", "hashes",
                F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cluster"), F.lit(n_tasks))).otherwise(F.xxhash64("cluster")).alias("task"),
                F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                (F.col("block") <= F.col("other")).alias("left"), (F.col("block") >= F.col("other")).alias("right")))
    return written(placed.groupBy("task", "x", "y").applyInPandas(_cluster_task(percent), "id long, label long, links long"), "join-answers")


def link(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block_hashes: int = BLOCK_HASHES) -> DataFrame:
    """doc_id, tie, n_shingles, component (key of the group), component_id, n_links of each row of (doc_id, text).

    A set is the distinct ``size``-word shingles of the text with A-Z lower-cased; fewer words make one
    shingle, a null, empty or wordless text makes an empty set that links with nothing. Two documents
    link when 100 * intersection >= ``percent`` * union. component_id: smallest doc_id reachable by links
    (null ids do not count unless all are null); n_links: documents linked with it, copies included.
    Repeated rows count as documents of their own. An empty table gives an empty result; other columns
    are ignored. tie is a hash of the text, component a number that rows of one group share (null for empty sets).
    """
    signed = written(signatures(docs, size), "join-signatures")
    classes = written(
        signed.filter("n > 0").groupBy("d1", "d2").agg(F.first("n").alias("n"), F.count(F.lit(1)).alias("copies"), F.min("doc_id").alias("first_id")), "join-classes")
    survivors = _survivors(docs, classes, size, percent)
    sets = written(_survivor_sets(docs, survivors, size), "join-sets")
    # Frequencies among survivors; hashes of one class alone cannot be shared and only count in n.
    pairs = sets.select("id", F.explode("hashes").alias("hash"))
    frequent = pairs.groupBy("hash").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    shared = (
        pairs.join(frequent, "hash").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "hash"))).alias("ranked"))
        .join(sets.select("id", "n", "copies"), "id"))
    least = F.ceil(F.col("n") * percent / 100).cast("int")
    prepared = written(
        shared.filter(F.size("ranked") >= least)
        .select("id", "n", "copies", F.array_sort(F.col("ranked.hash")).alias("hashes"), F.slice(F.col("ranked.hash"), F.lit(1), F.size("ranked") - least + 1).alias("prefix")), "join-prepared")
    posted = prepared.select("id", F.explode("prefix").alias("hash"))
    stars = posted.groupBy("hash").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    clusters = components(posted.join(stars, "hash").select("a", F.col("id").alias("b")))
    members = prepared.drop("prefix").join(clusters.withColumnRenamed("label", "cluster"), "id")
    answered = join_clusters(members, percent, block_hashes)
    linked = components(answered.select(F.col("id").alias("a"), F.col("label").alias("b")))
    counted = answered.groupBy("id").agg(F.sum("links").alias("links"))
    joined_classes = (
        classes.join(survivors.select("d1", "d2", "id"), ["d1", "d2"], "left")
        .join(linked, "id", "left").join(counted, "id", "left")
        # Classes that link with nothing are groups of their own, named apart from survivors by a negative hash.
        .select("d1", "d2", "first_id", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.struct(F.coalesce("label", F.lit(-1)).alias("label"), F.when(F.col("label").isNull(), F.col("d1")).alias("d1"), F.when(F.col("label").isNull(), F.col("d2")).alias("d2")).alias("group")))
    joined_classes = written(joined_classes, "join-groups")
    heads = joined_classes.groupBy("group").agg(F.min("first_id").alias("component_id"), F.min(F.xxhash64("d1", "d2")).alias("component"))
    answer = joined_classes.join(heads, "group").select("d1", "d2", "component", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links"))
    return signed.join(answer, ["d1", "d2"], "left").select(
        "doc_id", "tie", F.col("n").alias("n_shingles"), "component",
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
