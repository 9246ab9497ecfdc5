"""Words of whole texts as numpy arrays, one Arrow batch slice at a time.

All word classes used here are decided by single UTF-8 bytes: bytes of 0x80 and above always belong to
words. A slice is a run of rows whose texts take at most ``SLICE_BYTES`` (or one longer text), so the
arrays of a task stay bounded whatever the batch size.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

#: Words between ASCII white space, case kept or A-Z lower-cased.
SPACES = np.ones(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_STEP = np.random.default_rng(21).integers(1, 1 << 62, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: tuple[np.ndarray, np.ndarray] | None = None


def slices(batch: pa.RecordBatch, column: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row offsets into them) of each slice; null texts are empty."""
    texts = batch.column(column).cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def spans(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's first word index (one more entry than rows)."""
    word = inside[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    last = word.copy()
    last[:-1] &= ~word[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] |= word[cuts]
    last[cuts - 1] |= word[cuts - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every word, from one running sum over the bytes."""
    global _powers
    if _powers is None or len(_powers[0]) < len(data):
        n = max(len(data), SLICE_BYTES)
        _powers = tuple(np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, _BASE_INVERSE))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * _powers[0][: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * _powers[1][starts] + (ends - starts).astype(np.uint64))


def window_hashes(words: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``size``-word windows and each row's first window index.

    A row with fewer words, but not none, has its whole sequence as one window.
    """
    counts = np.diff(rows)
    n_windows = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    firsts = np.concatenate([[0], np.cumsum(n_windows)])
    at = np.repeat(rows[:-1] - firsts[:-1], n_windows) + np.arange(firsts[-1])
    lengths = np.repeat(np.minimum(counts, size), n_windows)
    out = lengths.astype(np.uint64) * _STEP[63]
    for k in range(size):
        have = lengths > k
        if have.all():
            out += words[at + k] * _STEP[k]
        else:
            out[have] += words[at[have] + k] * _STEP[k]
    return mix(out), firsts
