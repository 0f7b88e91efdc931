"""Words and shingles of whole Arrow batches, hashed with numpy and without a Python loop per word.

A word is a maximal run of bytes other than space and \\t \\n \\v \\f \\r. The hash is a fixed function
of the word's bytes, so tasks on any machine agree on it: a sum of random numbers drawn for each place
and byte, and BLAKE2 for words that are longer than the table. No polynomial is used: modulo 2^64 those
are equal for some regular words of every base.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE = 5
SLICE_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_RNG = np.random.default_rng(20240229)
#: Bytes of a word that the table covers.
PLACES = 64
_TABLE = _RNG.integers(0, 2**64, PLACES * 256, dtype=np.uint64)
#: For a second hash of the same words, independent of the first.
_OTHER = _RNG.integers(0, 2**64, PLACES * 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_ORDER = _RNG.integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)


def give_back() -> None:
    """Return what this process has freed to the system, which allocators keep for themselves."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def tidy(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``work`` for ``mapInArrow``, after which its worker keeps no freed memory.

    A Python worker lives on for later tasks, beside those of other steps: together they hold what the
    largest task of each has ever needed.
    """

    @functools.wraps(work)
    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return each


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = column.buffers()
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in consecutive pieces of about ``most`` bytes of text, a row at least."""
    size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    piece = np.cumsum(size) // most
    cuts = np.flatnonzero(np.diff(piece)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


@dataclass
class Words:
    """Words of the rows of one slice. ``at[i]:at[i + 1]`` are the words of row ``i``."""

    raw: np.ndarray
    start: np.ndarray
    end: np.ndarray
    at: np.ndarray
    hash: np.ndarray

    def text(self, i: int) -> bytes:
        return self.raw[self.start[i] : self.end[i]].tobytes()


def words_of(column: pa.Array, hashed: bool = True) -> Words:
    raw, offsets = utf8(column)
    n = len(raw)
    word = ~_SPACE[raw]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    first = word.copy()
    last = word.copy()
    if n:
        first[1:] &= ~word[:-1] | cut[1:n]
        last[:-1] &= ~word[1:] | cut[1:n]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return Words(raw, start, end, np.searchsorted(start, offsets), _hashes(raw, start, end) if hashed else start)


def second_hashes(words: Words) -> np.ndarray:
    """Another hash of every word: with the first one, 128 bits tell words apart."""
    return _hashes(words.raw, words.start, words.end, _OTHER, b"second")


def _hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray = _TABLE, key: bytes = b"") -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(start, start[a] + (1 << 20))))
        low, high = int(start[a]), int(end[b - 1])
        begin = start[a:b] - low
        gap = np.diff(np.append(begin, high - low))
        place = np.arange(high - low, dtype=np.int64) - np.repeat(begin, gap)
        value = table[np.minimum(place, PLACES - 1) * 256 + raw[low:high]]
        value[_SPACE[raw[low:high]]] = 0
        out[a:b] = np.add.reduceat(value, begin)
        a = b
    out = mix(out + (end - start).astype(np.uint64) * _STEP)
    for i in np.flatnonzero(end - start > PLACES).tolist():
        out[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]], digest_size=8, key=key).digest(), "little")
    return out


def sequences(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` consecutive words, for every place that has so many.

    Halves are joined to wholes and every joint is mixed, so that no sum of words can cancel out.
    """
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, at, level, span = np.full(n, size, np.uint64), 0, hashes, 1
    while span <= size:
        if size & span:
            total = mix(total * _ORDER[0] + level[at : at + n] * _ORDER[1])
            at += span
        level = mix(level[:-span] * _ORDER[2] + level[span:] * _ORDER[3])
        span *= 2
    return total


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each ``size`` consecutive words, for every place that has so many."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(size):
        total += hashes[j : j + n] * _ORDER[j]
    return mix(total)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all rows, and the offsets of the rows in them.

    A row of fewer words than ``size``, but at least one, has one shingle: all its words.
    """
    count = np.diff(words.at)
    every = grams(words.hash, size)
    place = np.arange(len(every))
    row = np.repeat(np.arange(len(count)), count)[: len(every)]
    keep = every[place + size <= words.at[1:][row]] if len(every) else every
    n = np.maximum(count - size + 1, 0)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short):
        own = np.array([grams(words.hash[words.at[i] : words.at[i + 1]], int(count[i]))[0] for i in short], np.uint64)
        before = np.concatenate([[0], np.cumsum(n)])
        keep = np.insert(keep, before[short], own)
        n[short] = 1
    return keep, np.concatenate([[0], np.cumsum(n)])


def groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 0) -> Iterator[pa.Table]:
    """Runs of equal ``key`` in batches sorted by it, each whole.

    With ``rows``, runs are returned together until there are so many rows.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key)
        change = np.flatnonzero(pc.not_equal(values.slice(1), values.slice(0, len(values) - 1)).to_numpy(zero_copy_only=False)) + 1
        start = 0
        if held and held[-1].column(key)[-1].as_py() != values[0].as_py():
            if not rows or sum(x.num_rows for x in held) >= rows:
                yield pa.Table.from_batches(held)
                held = []
        if rows:
            if len(change) and (len(batch) + sum(x.num_rows for x in held)) >= rows:
                held.append(batch.slice(0, change[-1]))
                yield pa.Table.from_batches(held)
                held, start = [], change[-1]
        else:
            for c in change:
                held.append(batch.slice(start, c - start))
                yield pa.Table.from_batches(held)
                held, start = [], c
        held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)
