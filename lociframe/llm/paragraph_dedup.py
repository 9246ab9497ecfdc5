"""Substring deduplication by MinHash banding of paragraphs.

Paragraphs are of two kinds, both decided by content alone, so the same passage yields the same ones:
every sentence start runs to the first sentence end that gives it ``MIN_WORDS`` words; and every word
whose shingle has the lowest hash of some window of ``PASSAGE - MIN_WORDS + 1`` words starts an anchor of
``MIN_WORDS`` words. Each common passage of ``PASSAGE`` words holds a whole window, hence a common anchor,
wherever it starts and whatever its marks.

1. Sentences get band keys from MinHash values, anchors their digest; keys that two documents hold mark candidates.
2. A second pass places the candidates, and looks up the shingle sets of those whose key several different
   paragraphs hold. Equal paragraphs are one from here on.
3. Different paragraphs of one key are verified exactly on Jaccard similarity, breadth first: each is compared with
   those of its key that no link has reached yet, so pairs never become rows. Keys of very many go through a set join
   in blocks. Keys with the same paragraphs are compared once. Links give components.
4. A component that reaches several documents stays in one; its spans in the others are merged within each
   document. Only at the two ends of a merged run the texts are read again: the run grows word by word as
   long as the words there are those at the place that stays. ``PASSAGE - MIN_WORDS`` words to each side
   suffice: further on lies the next anchor.

Bands and rows per band follow from the similarity and the recall asked for.
"""
from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import words as W
from .components import components
from .jaccard_join import PERCENT, SHINGLE, join_clusters
from .store import emptied, written

MIN_WORDS = 16
#: Common passages of so many words are always found.
PASSAGE = 32
RECALL = 0.98
MAX_BANDS = 4
#: Paragraphs of a key up to which one task compares them.
MOST = 4096
#: Bits of the masks of paragraphs that the second pass keeps.
WANTED_BITS = 1 << 26

_ENDS = np.zeros(256, bool)
_ENDS[list(b".!?")] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LOWER = bytes(W.LOWER)
_AROUND = np.dtype([("word", "<u4"), ("way", "<u4")])
_SEEDS = W.mix(np.arange(1, 65, dtype=np.uint64))


def bands(similarity: float, recall: float = RECALL, most: int = MAX_BANDS) -> tuple[int, int]:
    """(bands, rows per band): the most rows for which at most ``most`` bands reach the recall at the similarity."""
    for rows in range(8, 0, -1):
        for n in range(1, most + 1):
            if 1 - (1 - similarity**rows) ** n >= recall:
                return n, rows
    raise ValueError("the recall needs more bands")


def sliding(values: np.ndarray, width: int, lower) -> np.ndarray:
    """``lower`` (a ufunc as np.minimum) of every ``width`` values in a row."""
    span = 1
    while 2 * span <= width:
        values, span = lower(values[:-span], values[span:]), 2 * span
    return lower(values[: len(values) - (width - span)], values[width - span :]) if span < width else values


class Paragraphs:
    """Paragraphs of a slice: owner row, first and end word, digest, shingle ranges; sentences first, then ``n_anchors`` anchors."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, min_words: int, size: int, passage: int = PASSAGE):
        self.lowered, self.min_words = W.LOWER[data], min_words
        starts, ends, rows = W.spans(self.lowered, offsets, W.SPACES)
        n = len(starts)
        self.starts, self.ends, self.rows = starts, ends, rows
        owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
        # A word ends a sentence with a mark, at a line break, or as the last of its text.
        lines = np.concatenate([[0], np.cumsum(data == 0x0A)])
        last = np.zeros(n, bool)
        if n:
            last = _ENDS[data[ends - 1]]
            last[:-1] |= lines[starts[1:]] > lines[ends[:-1]]
            last[rows[1:][np.diff(rows) > 0] - 1] = True
        stops = np.flatnonzero(last) + 1
        begins = np.concatenate([[0], stops[:-1]])[: len(stops)]
        of = owner[begins] if len(begins) else np.zeros(0, np.int64)
        end_at = np.searchsorted(stops, begins + min_words)
        fits = end_at < len(stops)
        begins, of, end_at = begins[fits], of[fits], end_at[fits]
        stop = stops[end_at]
        fits = stop <= rows[of + 1]
        begins, stop = begins[fits], stop[fits]
        self.words = W.word_hashes(self.lowered, starts, ends)
        shingles = self.words[: max(0, n - size + 1)].copy() * W._STEP[0]
        for j in range(1, size):
            shingles += self.words[j : n - size + 1 + j] * W._STEP[j]
        self.shingles = W.mix(shingles)
        anchors = self._anchors(owner, passage, passage - min_words + 1)
        known = np.zeros(n + 1, np.int64)
        known[begins] = stop
        anchors = anchors[known[anchors] != anchors + min_words]
        self.n_anchors = len(anchors)
        self.first, self.stop = np.concatenate([begins, anchors]), np.concatenate([stop, anchors + min_words])
        self.owner = owner[self.first]
        self.low, self.high = self.first, self.stop - size + 1
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(self.shingles * W._STEP[60]))])
        self.digest = W.mix(total[self.high] - total[self.low] + (self.stop - self.first).astype(np.uint64)).view(np.int64)

    def _anchors(self, owner: np.ndarray, passage: int, width: int) -> np.ndarray:
        """Words whose shingle is the lowest of a window of ``width`` shingles that starts ``passage`` words of one text."""
        n = len(self.shingles) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64)
        lowest = sliding(self.shingles, width, np.minimum)
        lowest = np.where(np.arange(n) + passage <= self.rows[owner[:n] + 1], lowest, np.uint64(0))
        edge = np.zeros(width - 1, np.uint64)
        return np.flatnonzero((sliding(np.concatenate([edge, lowest, edge]), width, np.maximum) == self.shingles) & (self.shingles > 0))

    def keys(self, n_bands: int, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Keys and the paragraph of each: bands of sentences, one key of an anchor and of a sentence as long as one, which may be an anchor elsewhere."""
        n = len(self.first) - self.n_anchors
        at = np.column_stack([self.low[:n], self.high[:n]]).ravel()
        out = []
        for b in range(n_bands):
            key = np.full(n, _SEEDS[b], np.uint64)
            for r in range(n_rows):
                values = W.mix(self.shingles ^ _SEEDS[8 + b * n_rows + r])
                lowest = np.minimum.reduceat(np.append(values, np.uint64(2**64 - 1)), at)[::2] if len(at) else np.zeros(0, np.uint64)
                key = W.mix(key * np.uint64(0x9E3779B97F4A7C15) + lowest)
            out.append(key)
        whole = np.concatenate([np.flatnonzero(self.stop[:n] - self.first[:n] == self.min_words), np.arange(n, len(self.first))])
        out.append(W.mix(self.digest[whole].view(np.uint64) ^ _SEEDS[63]))
        return np.concatenate(out).view(np.int64), np.concatenate([np.tile(np.arange(n), n_bands), whole])

    def hashes(self, k: int) -> np.ndarray:
        """Distinct shingle hashes of a paragraph."""
        return np.unique(self.shingles[self.low[k] : self.high[k]]).view(np.int64)


def _candidates(docs: DataFrame, n_bands: int, n_rows: int, min_words: int, size: int) -> DataFrame:
    """Distinct (key, digest) of paragraphs whose band key two documents hold."""
    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # (key, digest, doc) where one row of the batch holds the key, (key, digest, null) where several do.
        for number, batch in enumerate(batches):
            keys, digests, rows = [], [], []
            for row, _, data, offsets in W.slices(batch):
                p = Paragraphs(data, offsets, min_words, size)
                k, of = p.keys(n_bands, n_rows)
                keys.append(k)
                digests.append(p.digest[of])
                rows.append(p.owner[of] + row)
            flat = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, digests, rows)]
            order = np.argsort(flat[0], kind="stable")
            key, digest, row = (x[order] for x in flat)
            cut = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            sizes = np.diff(np.append(cut, len(key)))
            several = np.repeat((np.maximum.reduceat(row, cut) != np.minimum.reduceat(row, cut)), sizes) if len(key) else np.zeros(0, bool)
            pair = W.mix(key.view(np.uint64) * W._STEP[61] + digest.view(np.uint64))
            keep = np.sort(np.unique(pair, return_index=True)[1])
            ids = batch.column("row_id").to_numpy()[row[keep]] if len(keep) else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(key[keep], pa.int64()), pa.array(digest[keep], pa.int64()), pa.array(ids, pa.int64(), mask=several[keep])], names=["key", "digest", "row_id"])

    rows = docs.select("row_id", "text").mapInArrow(keyed, "key long, digest long, row_id long")
    # A key has at most one row for each batch and digest, whatever the number of documents that hold it.
    window = Window.partitionBy("key")
    held = rows.withColumns({"low": F.min("row_id").over(window), "high": F.max("row_id").over(window), "marks": F.count(F.when(F.col("row_id").isNull(), 1)).over(window)})
    return written(held.filter("low <> high or marks > 0").select("key", "digest").distinct(), "dedup-candidates")


def _mask(digests: DataFrame) -> bytes:
    """Bits at the digests' places of a mask; what else falls on a set bit is left out later or does no harm."""
    position = F.pmod("digest", F.lit(WANTED_BITS))
    cells = digests.select(position.alias("p")).groupBy((F.col("p") / 64).cast("long").alias("cell")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p % 64 as int)))").alias("bits")).toArrow()  # at most WANTED_BITS / 64 rows
    mask = np.zeros(WANTED_BITS // 64, np.int64)
    mask[cells["cell"].to_numpy()] = cells["bits"].to_numpy()
    return mask.tobytes()


def _occurrences(docs: DataFrame, candidates: DataFrame, shared: DataFrame, min_words: int, size: int) -> DataFrame:
    """(row_id, text_id, doc_id, start, end, digest, hashes) of candidates' paragraphs, and some others that occur once.

    hashes are there for sentences that share a key with different ones, once per batch and digest.
    """
    context = docs.sparkSession.sparkContext
    wanted, compared = context.broadcast(_mask(candidates)), context.broadcast(_mask(shared))

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        any_bits, set_bits = np.frombuffer(wanted.value, np.int64), np.frombuffer(compared.value, np.int64)
        kinds = [pa.int64(), pa.list_(pa.int64())]
        for batch in batches:
            seen: set[int] = set()
            columns: list[list[np.ndarray]] = [[], [], [], []]
            sets: list[np.ndarray | None] = []
            for row, _, data, offsets in W.slices(batch):
                p = Paragraphs(data, offsets, min_words, size)
                at = p.digest % WANTED_BITS
                point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                at_all = np.flatnonzero((any_bits[at // 64] >> (at % 64)) & 1)
                needed = ((set_bits[at[at_all] // 64] >> (at[at_all] % 64)) & 1) & (at_all < len(p.first) - p.n_anchors)
                base = point[offsets[p.owner[at_all]]]
                for out, values in zip(columns, (p.owner[at_all] + row, point[p.starts[p.first[at_all]]] - base, point[p.ends[p.stop[at_all] - 1]] - base, p.digest[at_all]), strict=True):
                    out.append(values)
                for k, need in zip(at_all.tolist(), needed.tolist(), strict=True):
                    digest = int(p.digest[k])
                    new = need and digest not in seen
                    if new:
                        seen.add(digest)
                    sets.append(p.hashes(k) if new else None)
            rows, start, end, digest = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns)
            at_rows = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(at_rows) for c in ("row_id", "text_id", "doc_id")], *[pa.array(x, kinds[0]) for x in (start, end, digest)], pa.array(sets, kinds[1])],
                names=["row_id", "text_id", "doc_id", "start", "end", "digest", "hashes"])

    found = docs.select("row_id", "text_id", "doc_id", "text").mapInArrow(again, "row_id long, text_id long, doc_id long, start long, end long, digest long, hashes array<long>")
    return written(found, "dedup-occurrences")


def _reached(tokens: np.ndarray, starts: np.ndarray, mark: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """(member, head) of the sets, tokens[starts[k]:starts[k + 1]] each, that links join to an earlier head, breadth first."""
    sizes, out = np.diff(starts), []
    waiting, flat, at = np.arange(len(sizes)), tokens, starts[:-1]
    queue: list[int] = []
    while len(waiting):
        if queue:
            now = queue.pop()
        else:
            head = now = int(waiting[0])
            waiting, flat, at = waiting[1:], flat[sizes[now]:], at[1:] - sizes[now]
            if not len(waiting):
                break
        own = tokens[starts[now] : starts[now + 1]]
        mark[own] = True
        both = np.add.reduceat(mark[flat], at, dtype=np.int64)
        mark[own] = False
        near = 100 * both >= percent * (sizes[now] + sizes[waiting] - both)
        if near.any():
            found = waiting[near].tolist()
            queue += found
            out += [(k, head) for k in found]
            flat, waiting = flat[np.repeat(~near, sizes[waiting])], waiting[~near]
            at = np.cumsum(sizes[waiting]) - sizes[waiting]
    return out


def _spanning(percent: int):
    """Edges (a, b) that span the links inside each key, from (key, digest, hashes) in the order of keys; equal rows are one."""
    def edges(keys: np.ndarray, digests: np.ndarray, hashes: pa.Array) -> pa.RecordBatch:
        tokens = np.unique(hashes.flatten().to_numpy(), return_inverse=True)[1]
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(hashes).to_numpy())])
        mark = np.zeros(int(tokens.max()) + 1 if len(tokens) else 0, bool)
        cut = np.append(np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), len(keys)).tolist()
        out = []
        for low, high in zip(cut[:-1], cut[1:], strict=True):
            out += [(low + k, low + head) for k, head in _reached(tokens[starts[low] : starts[high]], starts[low : high + 1] - starts[low], mark, percent)]
        at = np.array(out, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(digests[at[:, 0]], pa.int64()), pa.array(digests[at[:, 1]], pa.int64())], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(0).to_numpy()
            last = int(np.searchsorted(keys, keys[-1]))
            # The last key may go on in the next batch.
            if last or (rest and rest[0].column(0)[-1].as_py() != keys[0]):
                whole = pa.Table.from_batches([*rest, batch.slice(0, last)]).combine_chunks()
                yield edges(whole["key"].to_numpy(), whole["digest"].to_numpy(), whole["hashes"].combine_chunks())
                rest = []
            rest.append(batch.slice(last))
        if rest:
            whole = pa.Table.from_batches(rest).combine_chunks()
            yield edges(whole["key"].to_numpy(), whole["digest"].to_numpy(), whole["hashes"].combine_chunks())

    return run


def _links(shared: DataFrame, sets: DataFrame, percent: int, most: int = MOST) -> DataFrame:
    """(a, b) of different paragraphs that share a key (key, digest, m: how many do) and reach the similarity, at least a spanning set of them; written."""
    members = shared.join(sets, F.col("digest") == F.col("id"))
    close = written(
        members.filter(F.col("m") <= most).select("key", "digest", "hashes").repartition("key").sortWithinPartitions("key").mapInArrow(_spanning(percent), "a long, b long"), "dedup-links")
    if shared.filter(F.col("m") > most).isEmpty():
        return close
    many = members.filter(F.col("m") > most).select(
        F.col("key").alias("cluster"), "id", F.size("hashes").cast("long").alias("n"), F.lit(1).cast("long").alias("copies"), F.array_sort("hashes").alias("hashes"))
    return close.unionByName(join_clusters(many, percent).select(F.col("id").alias("a"), F.col("label").alias("b")).filter("a <> b"))


def _shared(candidates: DataFrame) -> DataFrame:
    """(key, digest, m) of keys that m > 1 different paragraphs hold; of keys with the same paragraphs only one; written."""
    held = candidates.groupBy("key").agg(
        F.count(F.lit(1)).alias("m"), F.bit_xor("digest").alias("x"), F.bit_xor(F.xxhash64("digest")).alias("y")).filter("m > 1")
    return written(candidates.join(held.groupBy("m", "x", "y").agg(F.min("key").alias("key")).select("key", "m"), "key"), "dedup-shared")


def _common(a: bytes, b: bytes) -> int:
    """Code points to the end of the words that two surroundings share from the paragraph on; those of the first."""
    x, y = np.frombuffer(a, _AROUND), np.frombuffer(b, _AROUND)
    n = min(len(x), len(y))
    differ = np.flatnonzero(x["word"][:n] != y["word"][:n])
    n = int(differ[0]) if len(differ) else n
    return int(x["way"][n - 1]) if n else 0


def _around(text: str, point: int, forward: bool, most: int) -> bytes:
    """Up to ``most`` words of a text after or before a code point, nearest first: 32 bits of each word's hash and the code points from the point to its far end."""
    reach = 256
    while True:
        low, high = (point, min(len(text), point + reach)) if forward else (max(0, point - reach), point)
        whole = high == len(text) if forward else low == 0
        found = [m.span() for m in _WORD.finditer(text[low:high])]
        if not whole and len(found) <= most:
            reach *= 4  # the outermost word may be cut
            continue
        near = found[:most] if forward else found[: -most - 1 : -1]
        out = np.empty(len(near), _AROUND)
        for i, (a, b) in enumerate(near):
            out[i] = (zlib.crc32(text[low + a : low + b].encode().translate(_LOWER)), (b if forward else high - low - a))
        return out.tobytes()


def _surroundings(docs: DataFrame, places: DataFrame, most: int) -> DataFrame:
    """``places`` (row_id, text_id, point, forward, ...) with the words around each, read from the texts of their documents."""
    rest = [c for c in places.columns if c not in ("row_id", "text_id", "point", "forward")]
    listed = places.groupBy("row_id", "text_id").agg(F.collect_list(F.struct("point", "forward", *rest)).alias("places"))
    texts = docs.select("row_id", "text_id", "text").filter("text is not null").dropDuplicates(["row_id", "text_id"])
    kinds = ", ".join(f"{c} {places.schema[c].dataType.simpleString()}" for c in rest)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            flat, rows = lists.flatten(), pc.list_parent_indices(lists)
            texts, now = batch.column(1), -1
            around = []
            for row, point, forward in zip(rows.to_pylist(), flat.field("point").to_pylist(), flat.field("forward").to_pylist(), strict=True):
                if row != now:
                    now, text = row, texts[row].as_py()
                around.append(_around(text, point, forward, most))
            columns = [batch.column(0).take(rows), *[flat.field(c) for c in ("point", "forward", *rest)], pa.array(around, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["row_id", "point", "forward", *rest, "around"])

    joined = texts.join(listed, ["row_id", "text_id"]).select("row_id", "text", "places")
    return joined.mapInArrow(look, f"row_id long, point long, forward boolean, {kinds}, around binary")


def _runs(spans: DataFrame) -> DataFrame:
    """``spans`` (row_id, start, end, ...) with ``run``, the number of the stretch that they and their neighbours make, and ``other``: 0 if equal to the span before, else 1."""
    order = Window.partitionBy("row_id").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    same = (F.lag("start").over(order) == F.col("start")) & (F.lag("end").over(order) == F.col("end"))
    return spans.withColumns({"new": F.when(reach.isNull() | (F.col("start") > reach + 1), 1).otherwise(0), "other": F.when(same, 0).otherwise(1)}).withColumn(
        "run", F.sum("new").over(order)).drop("new")


def _grown(docs: DataFrame, runs: DataFrame, stays: DataFrame, most: int) -> DataFrame:
    """Runs with ``start`` and ``end`` moved over the words that are equal where the paragraph at that end stays."""
    ends = runs.select("row_id", "run", F.inline(F.array(
        F.struct(F.col("first.text_id").alias("text_id"), F.col("first.component").alias("component"), F.col("start").alias("point"), F.lit(False).alias("forward")),
        F.struct(F.col("last.text_id").alias("text_id"), F.col("last.component").alias("component"), F.col("end").alias("point"), F.lit(True).alias("forward")))))
    named = ends.select("component", "forward").distinct()
    kept = stays.select("row_id", "text_id", "component", F.inline(F.array(
        F.struct(F.col("start").alias("point"), F.lit(False).alias("forward")), F.struct(F.col("end").alias("point"), F.lit(True).alias("forward"))))).join(named, ["component", "forward"])
    places = ends.select("row_id", "text_id", "point", "forward", "component", "run").unionByName(
        kept.select("row_id", "text_id", "point", "forward", "component", F.lit(None).cast("long").alias("run")))
    seen = written(_surroundings(docs, places, most), "dedup-ends")
    standing = seen.filter("run is null").select("component", "forward", F.col("around").alias("stay")).distinct()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            way = np.fromiter(map(_common, batch.column(3).to_pylist(), batch.column(4).to_pylist()), np.int64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*map(batch.column, range(3)), pa.array(way)], names=["row_id", "run", "forward", "way"])

    met = seen.filter("run is not null").join(standing, ["component", "forward"]).select("row_id", "run", "forward", "around", "stay")
    ways = met.mapInArrow(compare, "row_id long, run long, forward boolean, way long").groupBy("row_id", "run").agg(
        F.coalesce(F.max(F.when(~F.col("forward"), F.col("way"))), F.lit(0)).alias("left"), F.coalesce(F.max(F.when(F.col("forward"), F.col("way"))), F.lit(0)).alias("right"))
    grown = runs.join(ways, ["row_id", "run"], "left")
    return grown.withColumns({"start": F.col("start") - F.coalesce("left", F.lit(0)), "end": F.col("end") + F.coalesce("right", F.lit(0))}).drop("left", "right", "first", "last", "run")


def repeated_passages(docs: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, size: int = SHINGLE, recall: float = RECALL) -> DataFrame:
    """Removals: doc_id, start, end, n_paragraphs, component_ids, other_doc_id of every repeated passage of (doc_id, text) outside the document where it stays.

    Two paragraphs link when 100 * intersection >= ``percent`` * union of their ``size``-word shingles
    (A-Z lower-cased). A component in two or more documents stays in that of the lowest id. The others'
    spans (code points, end exclusive) are grown over equal words and merged where they meet or overlap; component_ids lists their
    groups, named by a paragraph's digest, and other_doc_id is the lowest document in which one of them
    stays. Repeats within one document are left.
    Null, empty and short texts, and texts without a full paragraph, have none; rows that repeat a
    doc_id are one document, null ids are documents by their text. An empty table gives no rows.
    """
    n_bands, n_rows = bands(percent / 100, recall)
    text = F.col("text").cast("string")
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_id")).withColumn("row_id", F.coalesce("doc_id", "text_id"))
    candidates = _candidates(named, n_bands, n_rows, min_words, size)
    shared = _shared(candidates)
    found = _occurrences(named, candidates, shared, min_words, size)
    emptied(candidates)
    sets = found.filter("hashes is not null").groupBy(F.col("digest").alias("id")).agg(F.first("hashes").alias("hashes"))
    groups = components(_links(shared, sets, percent)).select(F.col("id").alias("digest"), F.col("label").alias("component"))
    emptied(shared)
    placed = found.drop("hashes").join(groups, "digest", "left").withColumn("component", F.coalesce("component", "digest"))
    kept = placed.groupBy("component").agg(F.min("row_id").alias("stay"), F.max("row_id").alias("highest"), F.min("doc_id").alias("other_doc_id")).filter("stay <> highest")
    marked = written(placed.join(kept, "component").select("row_id", "text_id", "doc_id", "start", "end", "component", "stay", "other_doc_id"), "dedup-marked")
    emptied(found)
    spans = _runs(marked.filter("row_id <> stay"))
    at = lambda point: F.struct(point, "component", "text_id")
    runs = written(spans.groupBy("row_id", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.min(at("start")).alias("first"), F.max(at("end")).alias("last"),
        F.sum("other").alias("n_paragraphs"), F.collect_set("component").alias("component_ids"), F.min("other_doc_id").alias("other_doc_id")), "dedup-runs")
    grown = _grown(named, runs, marked.filter("row_id = stay"), PASSAGE - min_words)
    return _runs(grown).groupBy("row_id", "run").agg(
        F.first("doc_id").alias("doc_id"), F.min("start").alias("start"), F.max("end").alias("end"), F.sum("n_paragraphs").alias("n_paragraphs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("component_ids")))).alias("component_ids"), F.min("other_doc_id").alias("other_doc_id")).drop("row_id", "run")
