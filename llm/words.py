"""Vectorised word hashing over Arrow batches, shared by the word-based operators.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D, that is the
pattern ``[^\\x20\\x09-\\x0D]+`` over UTF-8 (multi-byte characters never contain
those bytes).  A whole batch of texts is hashed at once with numpy: a random
64-bit value per byte, weighted by powers of an odd base (mod 2**64), summed
per word, then mixed.  ``seed`` selects independent hash functions; two of them
make a 128-bit key.

Words of more than ``LONG_WORD`` bytes are hashed with BLAKE2 instead, because
powers of an odd base have known collisions only between very long strings.
"""

from __future__ import annotations

import ctypes
import hashlib
from functools import wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)

LONG_WORD = 512
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLDEN = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of SplitMix64: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def derive(seed: int, n: int) -> np.ndarray:
    """``n`` reproducible 64-bit constants for ``seed``."""
    start = (seed * 0xD1342543DE82EF95 + _GOLDEN) & _MASK
    i = np.arange(1, n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        return mix64(np.uint64(start) + i * np.uint64(_GOLDEN))


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array without copying the data; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    _, off, data = texts.buffers()
    offsets = np.frombuffer(off, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    raw = raw[offsets[0]:offsets[-1]]
    return raw, offsets - offsets[0]


class Words:
    """Words of a batch: ``start``/``end`` byte positions, ``first[i]:first[i+1]`` the words of text i."""

    def __init__(self, texts: pa.Array):
        raw, self.offsets = text_buffer(texts)
        self.raw = raw
        gap = np.ones(len(raw) + 2, dtype=bool)
        gap[1:-1] = (raw == 0x20) | ((raw >= 0x09) & (raw <= 0x0D))
        # A text border ends a word too; mark borders through the edge list.
        inside = ~gap[1:-1]
        starts = inside & gap[:-2]
        ends = inside & gap[2:]
        cuts = self.offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(raw))]
        starts[cuts] |= inside[cuts]
        ends[cuts - 1] |= inside[cuts - 1]
        self.start = np.flatnonzero(starts)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, self.offsets, side="left")
        self.counts = np.diff(self.first)

    def hashes(self, seed: int, lower: bool = False) -> np.ndarray:
        """One 64-bit hash per word; ``lower`` folds A-Z first."""
        raw, table = self.raw, derive(seed, 257)
        base = int(table[256]) | 1
        values = table[:256].copy()
        if lower:
            values[65:91] = values[97:123]
        with np.errstate(over="ignore"):
            out = np.zeros(len(self.start), dtype=np.uint64)
            length = self.end - self.start
            if len(length):
                # Power by position inside the word, so that equal words hash alike.
                powers = np.ones(min(int(length.max()), LONG_WORD) + 1, dtype=np.uint64)
                powers[1:] = np.uint64(base)
                powers = np.multiply.accumulate(powers)
                place = np.arange(len(raw), dtype=np.int64)
                place -= np.repeat(np.r_[0, self.start], np.diff(np.r_[0, self.start, len(raw)]))
                np.clip(place, 0, len(powers) - 1, out=place)
                weighted = values[raw] * powers[place]
                total = np.zeros(len(raw) + 1, dtype=np.uint64)
                np.cumsum(weighted, out=total[1:])
                out = total[self.end] - total[self.start]
                out = mix64(out + length.astype(np.uint64) * np.uint64(_GOLDEN))
                for i in np.flatnonzero(length > LONG_WORD):
                    word = raw[self.start[i]:self.end[i]].tobytes()
                    word = word.lower() if lower else word
                    out[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8, key=seed.to_bytes(8, "little")).digest(), "little")
        return out

    def windows(self, seed: int, width: int, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """(hash, keep): hash of the ``width`` words that start at each word, and
        whether that window lies in one text.  The hash depends on word order."""
        h = self.hashes(seed, lower)
        n = len(h)
        keep = np.zeros(n, dtype=bool)
        out = np.zeros(n, dtype=np.uint64)
        if n >= width:
            last = np.repeat(self.first[1:], self.counts)
            keep = np.arange(n) + width <= last
            m = n - width + 1
            factors = derive(seed + 7919, width) | np.uint64(1)
            with np.errstate(over="ignore"):
                acc = np.zeros(m, dtype=np.uint64)
                for k in range(width):
                    acc += h[k:k + m] * factors[k]
                out[:m] = mix64(acc)
        return out, keep


def slices(texts: pa.Array, max_bytes: int = 1 << 20, max_rows: int = 1 << 30):
    """Consecutive slices of a string array of about ``max_bytes`` (one row at least),
    so that working arrays stay small whatever the size of an Arrow batch."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    sizes = np.nan_to_num(np.asarray(pa.compute.binary_length(texts), dtype=np.float64)).astype(np.int64)
    upto = np.cumsum(sizes)
    start, n = 0, len(sizes)
    while start < n:
        done = upto[start - 1] if start else 0
        stop = int(np.searchsorted(upto, done + max_bytes, side="right"))
        stop = max(start + 1, min(stop, start + max_rows, n))
        yield texts.slice(start, stop - start)
        start = stop


def release() -> None:
    """Give freed memory back to the system.  Python workers stay alive between tasks,
    and what their allocators keep counts against the executor."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not a GNU system
        pass


def tidy(task):
    """A mapInArrow task that releases its memory when it ends."""
    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            release()
    return run


def tidy_group(function):
    """A grouped Arrow function (one table in and out) that releases its memory after each group."""
    def run(table):
        try:
            return function(table)
        finally:
            release()
    return run
