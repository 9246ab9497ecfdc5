"""Benchmark decontamination with one Aho-Corasick automaton.

The benchmark's normalised words are cut into windows, which are the patterns of one automaton. Each
text is normalised the same way and scanned once; matches are mapped back to word numbers and to byte
offsets of the original text. The text never leaves its row and nothing is shuffled.

The patterns are broadcast. Their size is measured first; a benchmark whose patterns take more than
``part_bytes`` is cut into parts of at most that size by whole windows, and a task holds the automaton
of one part at a time, so memory stays bounded for any benchmark.
"""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .store import worker_cache

WINDOW = 10
PART_BYTES = 32 << 20

#: Byte classes of the normal form: digits, letters and every byte of 0x80 or more are word bytes.
NORMAL = bytes(b + 0x20 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_WORD_BYTE = np.array([b != 0x20 for b in NORMAL])

RESULT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("spans", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
])


def windows_of(words: list[bytes], size: int) -> set[bytes]:
    """All runs of ``size`` words, or the whole sequence if it is shorter; none without words."""
    if not words:
        return set()
    return {b" " + b" ".join(words[i : i + size]) + b" " for i in range(max(1, len(words) - size + 1))}


def patterns(benchmark: DataFrame, window: int = WINDOW, key: str = "item_id") -> DataFrame:
    """(pattern, items) of a benchmark: each distinct window with the sorted ids of the items that have it."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, ids = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for w in windows_of((text or "").encode().translate(NORMAL).split(), window):
                    found.append(w)
                    ids.append(item)
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary()), pa.array(ids, pa.string())], names=["pattern", "item"])

    cut_windows = benchmark.select(F.col(key).cast("string"), F.col("text").cast("string")).mapInArrow(cut, "pattern binary, item string")
    return cut_windows.filter("item is not null").groupBy("pattern").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _built(key: tuple[str, int], part: list[tuple[bytes, list[str]]]) -> object:
    """The automaton of a part; a worker keeps the last one it built."""
    import ahocorasick

    cache = worker_cache()
    if cache.get("automaton", (None,))[0] != key:
        cache.pop("automaton", None)
        automaton = ahocorasick.Automaton()
        for pattern, items in part:
            automaton.add_word(bytes(pattern).decode("latin-1"), (pattern.count(b" ") - 1, items))
        automaton.make_automaton()
        cache["automaton"] = (key, automaton)
    return cache["automaton"][1]


def _scan(text: bytes, automaton: object) -> tuple[int, dict[int, int], set[str]]:
    """Number of words, the longest hit by its last word, and the items found in one text."""
    words = text.translate(NORMAL).split()
    if not words:
        return 0, {}, set()
    normal = " " + b" ".join(words).decode("latin-1") + " "
    hits, items, gaps = {}, set(), None
    for end, (n, found) in automaton.iter(normal):
        if gaps is None:
            gaps = np.flatnonzero(np.frombuffer(normal.encode("latin-1"), np.uint8) == 0x20)
        last = int(np.searchsorted(gaps, end)) - 1
        hits[last] = max(n, hits.get(last, 0))
        items.update(found)
    return len(words), hits, items


def _marked(text: bytes, n_words: int, hits: dict[int, int]) -> tuple[int, list[dict[str, int]]]:
    """Number of hit words and the hit stretches as code points of the original text."""
    step = np.zeros(n_words + 1, np.int64)
    for last, n in hits.items():
        step[last - n + 1] += 1
        step[last + 1] -= 1
    hit = np.concatenate([[0], np.cumsum(step)[:-1] > 0, [0]]).astype(np.int8)
    edges = np.diff(hit)
    data = np.frombuffer(text, np.uint8)
    word = np.concatenate([[0], _WORD_BYTE[data], [0]]).astype(np.int8)
    starts, ends = np.flatnonzero(np.diff(word) == 1), np.flatnonzero(np.diff(word) == -1)
    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    stretches = zip(point[starts[np.flatnonzero(edges == 1)]], point[ends[np.flatnonzero(edges == -1) - 1]], strict=True)
    return int(hit.sum()), [{"start": int(a), "end": int(b)} for a, b in stretches]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, key: str = "item_id", part_bytes: int = PART_BYTES) -> DataFrame:
    """``docs`` with a struct column ``decontamination``: n_words, n_hit, items, spans.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one
    window. A document word inside any occurrence of a window is hit. items: sorted ids (as text) of the
    items with occurring windows; spans: hit stretches of the original text in code points, end
    exclusive. Null and wordless texts have no words and no hits; items without words or id match
    nothing; an empty benchmark hits nothing. Every row and every other column of ``docs`` passes
    unchanged, repeated rows and null ids included; a column already named ``decontamination`` is replaced.
    """
    docs = docs.drop("decontamination")
    wanted = patterns(benchmark, window, key)
    size = wanted.agg(F.sum(F.length("pattern") + F.length(F.array_join("items", ","))).alias("n")).first().n or 0
    n_parts = -(-size // part_bytes)
    context, token = docs.sparkSession.sparkContext, uuid.uuid4().hex
    cut = [wanted.filter(F.pmod(F.xxhash64("pattern"), F.lit(n_parts)) == i) for i in range(n_parts)] if n_parts > 1 else [wanted]
    parts = [context.broadcast([(bytes(r.pattern), list(r["items"])) for r in part.toLocalIterator()]) for part in cut]
    schema = T.StructType([*docs.schema.fields, T.StructField("decontamination", RESULT)])
    text_at = docs.columns.index("text")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(text_at).cast(pa.large_binary())
            totals = [[0, {}, set()] for _ in range(len(texts))]
            for i, part in enumerate(parts):
                automaton = _built((token, i), part.value) if part.value else None
                for row, text in enumerate(texts):
                    if automaton is None:
                        totals[row][0] = len((text.as_py() or b"").translate(NORMAL).split())
                        continue
                    n, hits, items = _scan(text.as_py() or b"", automaton)
                    totals[row][0] = n
                    totals[row][2] |= items
                    for last, length in hits.items():
                        totals[row][1][last] = max(length, totals[row][1].get(last, 0))
            out = []
            for row, (n, hits, items) in enumerate(totals):
                n_hit, stretches = _marked(texts[row].as_py(), n, hits) if hits else (0, [])
                out.append({"n_words": n, "n_hit": n_hit, "items": sorted(items), "spans": stretches})
            kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, kind)], names=[*batch.schema.names, "decontamination"])

    return docs.mapInArrow(scan, schema)
