"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact verification.

An item gets the fingerprints of some of its windows, of 2^k or 3 * 2^k words, so that items of like
size share a window size; they are so many, and so far from its ends, that edits which keep it similar
leave one of them whole. Every window of each such size in every document is fingerprinted. A fingerprint is cut into RADIUS + 1 blocks: two
that differ in at most RADIUS bits agree in a block, so block tables find all of them. Each hit is
then compared with its item by weighted shingle similarity at the places where the item can lie.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm.words import SHINGLE, grams, slices, tidy, words_of

RADIUS = 5
SIMILARITY = 0.8
#: Items of one index, and indexes that one pass over the documents looks into: so many items are sent to
#: the tasks at most, and more are looked for in further passes.
BLOCK_ITEMS, PASS_BLOCKS = 2_000, 16
#: With x shingles of an item missing and y others added, SIMILARITY means 5 x + 4 y <= its shingles. A
#: word cut off at an end costs 5; a break inside costs 16 at least (four words said twice: x = 0, y = 4)
#: and with j of the item's words lost 5 j, or 20 (four of eight repeated words gone: x = 4, y = 0).
CUT, BREAK, LOSS = 5, 16, 20
_CHUNK = 1 << 12
#: Stretches that are compared at once.
_STRETCHES = 1 << 20


def window_size(n_words: int) -> int:
    """The largest 2^k or 3 * 2^(k - 1) words up to ``n_words``: two sizes for each doubling."""
    two = 1 << (n_words.bit_length() - 1)
    return two * 3 // 2 if two >= 2 and n_words >= two * 3 // 2 else two


def _cost(starts: list[int], size: int, n_words: int) -> int:
    """The least that edits cost which leave none of the windows whole."""
    least = [0, *(CUT * (a + 1) for a in starts)]
    for i in range(1, len(least)):
        for j in range(i - 1, -1, -1):
            lost = starts[i - 1] - starts[j] - size + 2
            one = BREAK if lost <= 0 else max(LOSS, CUT * lost)
            if one > BREAK * (i - j) + LOSS:
                break
            least[i] = min(least[i], least[j] + one)
    ends = [CUT * (n_words - a - size + 1) for a in starts]
    return min(a + b for a, b in zip(least, [*ends, 0], strict=True))


@lru_cache(1 << 16)
def parts_of(n_words: int) -> list[tuple[int, int]]:
    """First word and size of the windows of an item of ``n_words``.

    The largest windows of which any edit that keeps SIMILARITY leaves one whole: each break spoils the
    windows it lies in and words cut off at the ends those that hold them, so windows stand apart.
    """
    shingles_, size = max(1, n_words - SHINGLE + 1), window_size(n_words)
    while size > 1:
        for count in (shingles_ // BREAK + 1, shingles_ // BREAK + 2):
            for off in range(min(10, (n_words - size) // 2 + 1)):
                room = n_words - size - 2 * off
                starts = [off + room * i // (count - 1) for i in range(count)] if count > 1 else [off + room // 2]
                if _cost(starts, size, n_words) > shingles_:
                    return [(a, size) for a in starts]
        size = window_size(size - 1)
    return [(a, 1) for a in range(n_words)]


def _sums(hashes: np.ndarray, longest: int) -> np.ndarray:
    """Per bit, how many of the first i words have it; differences hold for windows up to ``longest``."""
    kind = np.int16 if longest < 1 << 15 else np.int32
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    total = np.zeros((len(hashes) + 1, 64), kind)
    np.cumsum(bits, axis=0, dtype=kind, out=total[1:])
    return total


def _marks(total: np.ndarray, size: int) -> np.ndarray:
    if len(total) <= size:
        return np.zeros(0, np.uint64)
    more = (total[size:] - total[:-size]) > size // 2
    return np.packbits(more, axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(hashes: np.ndarray, size: int) -> np.ndarray:
    """64-bit SimHash of each ``size`` consecutive words; the words are its features."""
    return _marks(_sums(hashes, size), size)


class BlockIndex:
    """Fingerprints with all pairs within RADIUS bits, by equal blocks."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks
        edges = np.linspace(0, 64, RADIUS + 2).astype(int)
        self.blocks = [(np.uint64(a), np.uint64((1 << (b - a)) - 1)) for a, b in zip(edges[:-1], edges[1:], strict=True)]
        self.tables = []
        for shift, mask in self.blocks:
            values = (marks >> shift & mask).astype(np.int64)
            order = np.argsort(values, kind="stable")
            at = np.searchsorted(values[order], np.arange(int(mask) + 2))
            self.tables.append((order, at, np.diff(at) > 0))

    def near(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``found`` and in the marks of all pairs within RADIUS bits, each once."""
        out = [np.zeros((0, 2), np.int64)]
        for (shift, mask), (order, at, has) in zip(self.blocks, self.tables, strict=True):
            value = (found >> shift & mask).astype(np.uint16)
            hit = np.flatnonzero(has[value])
            value = value[hit].astype(np.int64)
            n = at[value + 1] - at[value]
            left = np.repeat(hit, n)
            start = np.repeat(at[value] - (np.cumsum(n) - n), n)
            right = order[start + np.arange(len(left))]
            close = np.bitwise_count(found[left] ^ self.marks[right]) <= RADIUS
            if close.any():
                out.append(np.stack([left[close], right[close]], axis=1))
        if len(out) == 1:
            return out[0][:, 0], out[0][:, 1]
        pairs = np.unique(np.concatenate(out), axis=0)
        return pairs[:, 0], pairs[:, 1]


def best_stretch(found: np.ndarray, keys: np.ndarray, counts: np.ndarray) -> float:
    """The largest similarity of an item with any run of the shingles ``found``; 0 below SIMILARITY.

    The item has the sorted shingles ``keys``, ``counts`` times each. Shingles are weighted by how often
    they occur: sum of minima over sum of maxima. The best run begins and ends with a shingle of the item.
    """
    own = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    place = np.flatnonzero(keys[own] == found)
    own, total = own[place], int(counts.sum())
    least = math.ceil(SIMILARITY * total - 1e-9)
    if len(place) < least:
        return 0.0
    # A shingle counts in runs that begin after its occurrence ``counts`` places back in its own list.
    order = np.argsort(own, kind="stable")
    back = np.arange(len(order)) - counts[own[order]]
    same = (back >= 0) & (own[order[np.maximum(back, 0)]] == own[order])
    limit = np.empty(len(order), np.int64)
    limit[order] = np.where(same, order[np.maximum(back, 0)], -1)
    top, starts = 0.0, len(place) - least + 1
    step = max(1, _STRETCHES // len(place))
    for a in range(0, starts, step):
        first = np.arange(a, min(starts, a + step))[:, None]
        both = np.cumsum((limit[a:] < first) & (np.arange(a, len(place)) >= first), axis=1)
        length = place[a:] - place[first] + 1
        top = max(top, float((both / np.maximum(total, total + length - both)).max()))
    return top if top >= SIMILARITY else 0.0


class ItemIndex:
    """A bounded block of items, by window size."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.items = [(i, words_of(pa.array([t.decode()])).hash) for i, t in items]
        self.items = [(i, h) for i, h in self.items if len(h)]
        self.weights = [np.unique(grams(h, min(SHINGLE, len(h))), return_counts=True) for _, h in self.items]
        by_size: dict[int, list[tuple[int, int, np.uint64]]] = defaultdict(list)
        for k, (_, h) in enumerate(self.items):
            for skip, size in parts_of(len(h)):
                by_size[size].append((k, skip, fingerprints(h[skip : skip + size], size)[0]))
        self.sizes = {s: (x, BlockIndex(np.array([m for *_, m in x], np.uint64))) for s, x in by_size.items()}

    def matches(self, hashes: np.ndarray, at: np.ndarray) -> dict[int, dict[int, float]]:
        """Best similarity by row and item, for rows whose words are ``hashes[at[i]:at[i + 1]]``."""
        best: dict[int, dict[int, float]] = defaultdict(dict)
        tried: set[tuple[int, int, int]] = set()
        longest = max(self.sizes, default=0)
        for a in range(0, len(hashes), _CHUNK):
            total = _sums(hashes[a : a + _CHUNK + longest - 1], longest)
            for size, (own, index) in self.sizes.items():
                marks = _marks(total[: _CHUNK + size], size)
                found, mark = index.near(marks)
                closest = np.argsort(np.bitwise_count(marks[found] ^ index.marks[mark]), kind="stable")
                for w, m in zip(found[closest], mark[closest], strict=True):
                    place = a + int(w)
                    row = int(np.searchsorted(at, place, "right")) - 1
                    if place + size > at[row + 1]:
                        continue
                    k, skip, _ = own[m]
                    item, item_words = self.items[k]
                    if best[row].get(item) == 1 or (row, k, place - skip) in tried:
                        continue
                    tried.add((row, k, place - skip))
                    s = self._similarity(hashes[at[row] : at[row + 1]], place - skip - int(at[row]), len(item_words), self.weights[k])
                    if s > best[row].get(item, 0):
                        best[row][item] = s
        return best

    @staticmethod
    def _similarity(words: np.ndarray, start: int, n: int, weights: tuple[np.ndarray, np.ndarray]) -> float:
        """The largest similarity of the item with a stretch around its place at ``start``.

        A stretch of SIMILARITY has at most a quarter of the item's shingles added, all of them before or
        all behind the window that was found.
        """
        reach = n // 4 + SHINGLE
        return best_stretch(grams(words[max(0, start - reach) : max(0, start + n + reach)], min(SHINGLE, n)), *weights)


def _indexes(benchmark: DataFrame) -> list[list]:
    """The indexes of each pass: BLOCK_ITEMS items each, sent to the tasks, PASS_BLOCKS a pass."""
    spark = benchmark.sparkSession
    items = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("binary").alias("text"))
    blocks = -(-items.count() // BLOCK_ITEMS)
    passes: list[list] = []
    for k in range(blocks):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).collect()
        if k % PASS_BLOCKS == 0:
            passes.append([])
        passes[-1].append(spark.sparkContext.broadcast(ItemIndex([(r["item_id"], bytes(r["text"])) for r in own])))
    return passes


def _found(column: pa.Array, indexes: list) -> dict[int, dict[int, float]]:
    """Similarity by row and item, from all indexes of a pass; words are hashed once."""
    words = words_of(column)
    best: dict[int, dict[int, float]] = {}
    for index in indexes:
        for row, items in index.value.matches(words.hash, words.at).items():
            own = best.setdefault(row, {})
            for item, similarity in items.items():
                own[item] = max(similarity, own.get(item, 0.0))
    return best


def _passes(docs: DataFrame, benchmark: DataFrame) -> list[DataFrame]:
    """One scan of the documents for each pass."""
    out = []
    for indexes in _indexes(benchmark):

        def search(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    found = _found(part.column("text"), indexes)
                    rows = range(part.num_rows)
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id"), pa.array([[{"item_id": i, "similarity": s} for i, s in found[r].items()] if r in found else [] for r in rows], pa.list_(pa.struct([("item_id", pa.int64()), ("similarity", pa.float64())]))), part.column("row_key")],
                        names=["doc_id", "items", "row_key"],
                    )

        keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("doc_id", "text").alias("row_key"))
        out.append(keyed.mapInArrow(tidy(search), "doc_id long, items array<struct<item_id:long,similarity:double>>, row_key long"))
    return out


def benchmark_hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, items (item_id, similarity), contaminated; one row per row of ``docs``.

    Words are compared unchanged. Null and empty texts and null items match nothing. Equal items are
    reported each. With no items every document is clean. Extra columns are ignored.
    """
    passes = _passes(docs, benchmark)
    if not passes:
        out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.expr("cast(array() as array<struct<item_id:long,similarity:double>>)").alias("items"))
    elif len(passes) == 1:
        out = passes[0].drop("row_key")
    else:
        # Rows that repeat id and text have equal hits: their number goes along, one is looked at.
        every = reduce(DataFrame.unionAll, [p.withColumn("pass", F.lit(k)) for k, p in enumerate(passes)])
        one = every.groupBy("doc_id", "row_key").agg(F.flatten(F.collect_set("items")).alias("items"), F.sum(F.when(F.col("pass") == 0, 1).otherwise(0)).alias("n"))
        block = F.explode(F.expr("sequence(0, (n - 1) div 65536)")).alias("block")
        inside = F.explode(F.expr("sequence(1, least(65536, n - block * 65536))"))
        out = one.select("doc_id", "items", "n", block).select("doc_id", "items", inside).select("doc_id", "items")
    return out.select("doc_id", F.array_sort("items").alias("items")).withColumn("contaminated", F.size("items") > 0)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` with no benchmark passage, with all their columns.

    Each row is judged by its own text, whatever other rows of its id hold. One scan, no shuffle.
    """
    schema = docs.schema
    for indexes in _indexes(benchmark):

        def clean(batches: Iterator[pa.RecordBatch], indexes=indexes) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, "text"):
                    found = _found(part.column("text"), indexes)
                    yield part.filter(pa.array([not found.get(r) for r in range(part.num_rows)], pa.bool_()))

        docs = docs.mapInArrow(tidy(clean), schema)
    return docs
