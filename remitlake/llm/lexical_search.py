"""Ranked lexical search over all documents, scoring each distinct bag of words once.

A document matters to a set of items only through its counts of the items' terms and its length norm
``m``. Documents are restricted to the items' vocabulary, and those with the same vector of counts and
the same ``m`` are one class: classes are found by a hash and settled by the vectors themselves. Each
class is scored once, and its members then follow it in the order of their ids.

Only the first ``k`` members of a class can be among the first ``k`` documents of an item, and only
the first ``k`` classes by (score, smallest id) can hold them: each class ahead has a document ahead.
So both are cut at ``k`` before anything is shuffled or joined, and the result is still exact.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.bags import terms, translate_table
from remitlake.scratch import scratch_path

TOP = 10
TABLE = translate_table(digits=True)
_NO_ID = np.iinfo(np.int64).max


@dataclass(frozen=True)
class Limits:
    """What is held at once; results are the same for all values."""

    #: (item, term) pairs that are searched for, and broadcast, at once; more items take further passes.
    block_pairs: int = 200_000
    #: Scores that a task computes at once, and candidates it holds before each item's best are picked.
    cells: int = 1 << 21
    held: int = 1 << 15


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for item, text in zip(batch.column("item_id"), batch.column("text").cast(pa.large_binary()), strict=True):
            for words in terms(text.as_py(), TABLE):
                bag = Counter(words)
                columns = [pa.array([item.as_py()] * len(bag), pa.int64()), pa.array(list(bag), pa.binary()), pa.array(list(bag.values()), pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["item_id", "term", "times"])


def item_terms(items: DataFrame) -> DataFrame:
    """item_id, term, times of every item. Rows of one item_id are one item, null too."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = rows.mapInArrow(_pairs, "item_id long, term binary, times long")
    return found.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def bags(docs: DataFrame, number: dict[bytes, int]) -> DataFrame:
    """doc_id, n, vec of every row: number of terms, and counts of the terms that ``number`` knows.

    ``vec`` is pairs of 32-bit numbers (term, count) in the order of the terms; empty without any.
    """
    known = docs.sparkSession.sparkContext.broadcast(number)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = known.value.get
        for batch in batches:
            sizes, cells = [], []
            for text in batch.column("text").cast(pa.large_binary()):
                bag, n = Counter(), 0
                for words in terms(text.as_py(), TABLE):
                    n += len(words)
                    bag.update(map(find, words))
                bag.pop(None, None)
                sizes.append(n)
                cells.append(np.array(sorted(bag.items()), "<u4").tobytes())
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(cells, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "vec"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(describe, "doc_id long, n long, vec binary")


def _holders(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """How many of the vectors hold each term, one row per term and task."""
    total = np.zeros(size, np.int64)
    for batch in batches:
        every = np.frombuffer(b"".join(batch.column("vec").to_pylist()), "<u4")
        total += np.bincount(every[::2], minlength=size)
    own = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(total[own], pa.int64())], names=["term", "df"])


class Postings:
    """The items of a block by term: a class is scored against all of them at once."""

    def __init__(self, pairs: list[tuple]):
        self.items = sorted({p[0] for p in pairs}, key=lambda i: (i is None, i))
        self.vocabulary = sorted({p[1] for p in pairs})
        self.number = {t: i for i, t in enumerate(self.vocabulary)}
        place = {item: i for i, item in enumerate(self.items)}
        rows = np.array([(self.number[t], place[i], n) for i, t, n in pairs], np.int64).reshape(-1, 3)
        rows = rows[np.argsort(rows[:, 0], kind="stable")]
        self.at = np.searchsorted(rows[:, 0], np.arange(len(self.vocabulary) + 1))
        self.item, self.times = rows[:, 1], rows[:, 2]
        self.weight = np.zeros(len(self.vocabulary), np.int64)

    def weigh(self, n_docs: int, holders: dict[int, int]) -> None:
        for term, df in holders.items():
            self.weight[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))

    def scores(self, cells: list[bytes], m: np.ndarray) -> np.ndarray:
        """Scores of every vector (with its ``m``) for every item, in 64-bit integers."""
        out = np.zeros(len(cells) * len(self.items), np.int64)
        rows = np.frombuffer(b"".join(cells), "<u4").astype(np.int64).reshape(-1, 2)
        owner = np.repeat(np.arange(len(cells)), [len(c) // 8 for c in cells])
        part = self.weight[rows[:, 0]] * (1_000_000_000 * rows[:, 1] // (1000 * rows[:, 1] + 8 * m[owner]))
        low, many = self.at[rows[:, 0]], self.at[rows[:, 0] + 1] - self.at[rows[:, 0]]
        first = np.cumsum(many) - many
        post = np.repeat(low - first, many) + np.arange(int(many.sum()))
        np.add.at(out, np.repeat(owner, many) * len(self.items) + self.item[post], np.repeat(part, many) * self.times[post])
        return out.reshape(len(cells), len(self.items))


def _best(batches: Iterator[pa.RecordBatch], postings: Postings, k: int, limits: Limits) -> Iterator[pa.RecordBatch]:
    """For each item the ``k`` classes of this task with the highest score, then the smallest first id."""
    n_items = len(postings.items)
    least = np.ones(n_items, np.int64)
    item, score, first, h, m = (np.zeros(0, np.int64) for _ in range(5))
    vec = np.zeros(0, object)
    for batch in batches:
        step = max(1, limits.cells // n_items)
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            cells = np.array([*part.column("vec").to_pylist(), None], object)[:-1]
            own_m, own_h = part.column("m").to_numpy(), part.column("h").to_numpy()
            own_first = part.column("doc_id").fill_null(_NO_ID).to_numpy()
            found = postings.scores(cells.tolist(), own_m)
            row, col = np.nonzero(found >= least[None, :])
            item, score = np.append(item, col), np.append(score, found[row, col])
            first, h, m, vec = (np.append(x, y[row]) for x, y in ((first, own_first), (h, own_h), (m, own_m), (vec, cells)))
            if len(item) > limits.held:
                item, score, first, h, m, vec = (x[_top(item, score, first, k)] for x in (item, score, first, h, m, vec))
                full = np.flatnonzero(np.bincount(item, minlength=n_items) >= k)
                low = np.full(n_items, _NO_ID)
                np.minimum.at(low, item, score)
                least[full] = low[full]
    own = _top(item, score, first, k)
    columns = {
        "item_id": pa.array([postings.items[i] for i in item[own]], pa.int64()),
        "score": pa.array(score[own], pa.int64()),
        "first_id": pa.array(first[own], pa.int64(), mask=first[own] == _NO_ID),
        "h": pa.array(h[own], pa.int64()),
        "m": pa.array(m[own], pa.int64()),
        "vec": pa.array(vec[own].tolist(), pa.binary()),
    }
    yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _top(item: np.ndarray, score: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    order = np.lexsort((first, -score, item))
    sorted_item = item[order]
    start = np.searchsorted(sorted_item, sorted_item)
    return order[np.arange(len(order)) - start < k]


def _ranked(rows: DataFrame, id_column: str, k: int) -> DataFrame:
    """The first ``k`` rows of each item; the window passes on ``k`` an item and task at most."""
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last(id_column))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, pairs: list[tuple], k: int, limits: Limits) -> DataFrame:
    spark, postings = docs.sparkSession, Postings(pairs)
    at = scratch_path(spark, "bags")
    bags(docs, postings.number).write.parquet(at)
    described = spark.read.parquet(at)
    total = described.agg(F.count_if(F.col("n") > 0).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).head()
    size = len(postings.vocabulary)
    holders = described.where("length(vec) > 0").select("vec").mapInArrow(lambda it: _holders(it, size), "term long, df long")
    postings.weigh(total.docs, {r.term: r.df for r in holders.groupBy("term").agg(F.sum("df").alias("df")).collect()})

    norm = F.expr(f"25 + (75L * n * {total.docs}L) div {max(1, total.terms)}L")
    members = described.where("length(vec) > 0").select("doc_id", norm.alias("m"), "vec").withColumn("h", F.xxhash64("vec", "m"))
    place = Window.partitionBy("h", "m", "vec").orderBy(F.asc_nulls_last("doc_id"))
    at = scratch_path(spark, "classes")
    members.withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= k).write.parquet(at)
    members = spark.read.parquet(at)

    known = spark.sparkContext.broadcast(postings)
    classes = members.where("nth = 1").select("doc_id", "h", "m", "vec")
    schema = "item_id long, score long, first_id long, h long, m long, vec binary"
    at = scratch_path(spark, "best-classes")
    _ranked(classes.mapInArrow(lambda it: _best(it, known.value, k, limits), schema), "first_id", k).write.parquet(at)
    best = spark.read.parquet(at).select("item_id", "score", "h", "m", "vec")
    # At most k hashes of 8 bytes for each item of the block.
    near = members.join(F.broadcast(best.select("h").distinct()), "h", "left_semi").select("doc_id", "h", "m", "vec")
    return _ranked(best.join(near, ["h", "m", "vec"]), "doc_id", k).select("item_id", "rank", "doc_id", "score")


def search(docs: DataFrame, items: DataFrame, k: int = TOP, limits: Limits = Limits()) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest score above 0 of each item.

    Equal scores go by ascending doc_id, null ids last. Every row is a document of its own, rows that
    repeat an id or a text too. Null and empty texts have no terms: they are no documents of the
    statistics, match nothing and ask for nothing. Rows that share an item_id are one item that asks for
    the terms of all of them, null included. Texts are read whole, in pieces. Empty tables give no rows;
    other columns are not looked at.

    Items are searched in blocks of about ``limits.block_pairs`` (item, term) pairs, by a hash of the item; a block's
    pairs, term weights and, at the end, ``k`` hashes an item are what is broadcast.
    """
    spark = docs.sparkSession
    at = scratch_path(spark, "item-terms")
    item_terms(items).write.parquet(at)
    pairs = spark.read.parquet(at)
    blocks = -(-pairs.count() // limits.block_pairs)
    block = F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks)))
    found = []
    for b in range(blocks):
        own = [tuple(r) for r in pairs.where(block == b).select("item_id", F.col("term"), "times").collect()]
        if own:
            found.append(_search_block(docs, [(i, bytes(t), n) for i, t, n in own], k, limits))
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.unionByName, found)
