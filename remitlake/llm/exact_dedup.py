"""Exact duplicates through a cuckoo-filter index of content digests.

Digests are dealt to shards by their first bytes. A shard's index is a cuckoo filter in front of
buckets of stored keys: a miss inserts, a hit is verified against the content kept in the bucket,
and a filter that overflows is built anew at twice the size from the stored keys.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.words import groups, tidy
from remitlake.scratch import scratch_path

SHARD_KEYS = 200_000
SLOTS = 4
KICKS = 200


class CuckooIndex:
    """Live digests with insertion, deletion and a value each.

    The filter holds a 16-bit fingerprint per digest in one of two buckets of four slots. Keys are
    stored by home bucket with their content (the whole digest and byte length), so a fingerprint hit
    is decided by content and never by the filter alone.
    """

    def __init__(self, capacity: int = 1024):
        self.size = 0
        self.resizes = 0
        self._kept: dict[int, list[tuple[bytes, int, list]]] = {}
        self._alloc(max(2, 1 << (max(1, capacity // SLOTS) - 1).bit_length()))

    def _alloc(self, buckets: int) -> None:
        self.buckets = buckets
        self.table = np.zeros((buckets, SLOTS), np.uint16)

    def _place(self, digest: bytes) -> tuple[int, int, int]:
        mark = int.from_bytes(digest[8:10], "little") or 1
        home = int.from_bytes(digest[10:18], "little") % self.buckets
        return mark, home, self._other(home, mark)

    def _other(self, bucket: int, mark: int) -> int:
        return bucket ^ (mark * 0x5BD1E995 % self.buckets)

    def maybe(self, digest: bytes) -> bool:
        mark, one, two = self._place(digest)
        return bool((self.table[one] == mark).any() or (self.table[two] == mark).any())

    def find(self, digest: bytes, size: int) -> list | None:
        """The value stored with this content; None on a filter miss or a false hit."""
        if not self.maybe(digest):
            return None
        _, home, _ = self._place(digest)
        return next((v for k, n, v in self._kept.get(home, ()) if k == digest and n == size), None)

    def insert(self, digest: bytes, size: int, value: list) -> None:
        _, home, _ = self._place(digest)
        self._kept.setdefault(home, []).append((digest, size, value))
        self.size += 1
        if not self._mark(digest):
            self._grow()

    def delete(self, digest: bytes, size: int) -> bool:
        """Remove a live digest and one of its fingerprints; False if it is not stored."""
        mark, home, other = self._place(digest)
        bucket = self._kept.get(home, [])
        for i, (key, n, _) in enumerate(bucket):
            if key == digest and n == size:
                del bucket[i]
                self.size -= 1
                for b in (home, other):
                    if len(slot := np.flatnonzero(self.table[b] == mark)):
                        self.table[b, slot[0]] = 0
                        return True
        return False

    def _mark(self, digest: bytes) -> bool:
        mark, one, two = self._place(digest)
        for b in (one, two):
            if len(free := np.flatnonzero(self.table[b] == 0)):
                self.table[b, free[0]] = mark
                return True
        b = two
        for kick in range(KICKS):
            slot = (kick + mark) % SLOTS
            mark, self.table[b, slot] = int(self.table[b, slot]), mark
            b = self._other(b, mark)
            if len(free := np.flatnonzero(self.table[b] == 0)):
                self.table[b, free[0]] = mark
                return True
        return False

    def _grow(self) -> None:
        keys = [x for bucket in self._kept.values() for x in bucket]
        while True:
            self.resizes += 1
            self._alloc(self.buckets * 2)
            self._kept = {}
            for x in keys:
                self._kept.setdefault(self._place(x[0])[1], []).append(x)
            if all(self._mark(k) for k, _, _ in keys):
                return

    def items(self) -> Iterator[tuple[bytes, int, list]]:
        for bucket in self._kept.values():
            yield from bucket


def with_digest(docs: DataFrame) -> DataFrame:
    """doc_id, the SHA-256 of the text with each run of white space as one space, and its bytes."""
    text = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    return docs.select("doc_id", F.unhex(F.sha2(text, 256)).alias("digest"), F.octet_length(text).alias("n_bytes"))


def _index(batches: Iterator[pa.RecordBatch], merge: bool) -> Iterator[pa.RecordBatch]:
    """Index the rows; one row per live content: smallest doc_id and number of rows.

    Without ``merge`` a task folds the rows it reads and starts anew every SHARD_KEYS keys; with it,
    the rows come sorted by shard and each shard gets an index of its own.
    """
    schema = pa.schema([("shard", pa.int64()), ("digest", pa.binary()), ("n_bytes", pa.int32()), ("first_id", pa.int64()), ("n", pa.int64())])

    def live(index: CuckooIndex, shard) -> pa.RecordBatch:
        rows = list(index.items())
        number = [int.from_bytes(d[:4], "big") for d, _, _ in rows] if shard is None else [shard] * len(rows)
        return pa.RecordBatch.from_arrays([pa.array(number, pa.int64()), pa.array([d for d, _, _ in rows], pa.binary()), pa.array([n for _, n, _ in rows], pa.int32()), pa.array([v[0] for _, _, v in rows], pa.int64()), pa.array([v[1] for _, _, v in rows], pa.int64())], schema=schema)

    def put(index: CuckooIndex, table) -> None:
        cols = [table.column(c).to_pylist() for c in ("digest", "n_bytes", "first_id", "n")]
        for digest, size, first, n in zip(*cols, strict=True):
            value = index.find(digest, size)
            if value is None:
                index.insert(digest, size, [first, n])
            else:
                value[0] = first if value[0] is None else value[0] if first is None else min(first, value[0])
                value[1] += n

    if merge:
        for table in groups(batches, "shard"):
            index = CuckooIndex(table.num_rows)
            put(index, table)
            yield live(index, table.column("shard")[0].as_py())
        return
    index = CuckooIndex()
    for batch in batches:
        put(index, batch)
        if index.size >= SHARD_KEYS:
            yield live(index, None)
            index = CuckooIndex()
    if index.size:
        yield live(index, None)


def live_contents(rows: DataFrame, n_rows: int) -> DataFrame:
    """digest, n_bytes, keep_id, group_size of each distinct content of ``rows`` (with_digest).

    Each task folds what it reads first, so a content with a third of all rows reaches its shard as
    one row per task. Shards hold about SHARD_KEYS keys at any input size.
    """
    schema = "shard long, digest binary, n_bytes int, first_id long, n long"
    shards = max(16, -(-n_rows // SHARD_KEYS))
    folded = rows.select("digest", "n_bytes", F.col("doc_id").cast("long").alias("first_id"), F.lit(1).cast("long").alias("n"))
    folded = folded.mapInArrow(tidy(lambda it: _index(it, False)), schema)
    dealt = folded.withColumn("shard", F.pmod("shard", F.lit(shards))).repartition("shard").sortWithinPartitions("shard")
    merged = dealt.mapInArrow(tidy(lambda it: _index(it, True)), schema)
    return merged.select("digest", "n_bytes", F.col("first_id").alias("keep_id"), F.col("n").alias("group_size"))


def exact_dedup(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Null text counts as empty; empty texts are equal. The smallest doc_id of equal texts stays; null
    ids stay only if no other id has the text. Rows that repeat id and text count each, and one of
    them is kept. Other columns of ``docs`` are not looked at. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "digests")
    with_digest(docs).write.parquet(path)
    rows = spark.read.parquet(path)
    live = live_contents(rows, rows.count())
    counted = rows.groupBy("doc_id", "digest", "n_bytes").agg(F.count("*").alias("times"))
    joined = counted.join(live, ["digest", "n_bytes"])
    same = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    # In blocks, so that no array grows with the copies of a row.
    block = F.explode(F.expr("sequence(0L, (times - 1) div 65536)")).alias("block")
    blocks = joined.select("doc_id", "keep_id", "group_size", "times", "digest", block)
    inside = F.explode(F.expr("sequence(block * 65536 + 1, least(block * 65536 + 65536, times))")).alias("copy")
    return blocks.select("doc_id", "keep_id", "group_size", inside, F.lower(F.hex("digest")).alias("text_sha256")).select("doc_id", "keep_id", "group_size", (same & (F.col("copy") == 1)).alias("kept"), "text_sha256")


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that exact_dedup keeps, with all their columns.

    Of rows with the id and the normalised text that stay, the one stays whose raw text is smallest and
    then whose other columns, as JSON, are; rows equal in all of that are the same row. Null text counts as
    empty, null ids stay as in exact_dedup, an empty table gives an empty one. Columns may have any name:
    they travel in a struct of their own. Very long texts are shuffled whole, once.
    """
    kept = exact_dedup(docs).where("kept").select(F.col("doc_id").alias("id"), F.col("text_sha256").alias("sha"))
    text = F.regexp_replace(F.coalesce(docs["text"], F.lit("")), r"[\x20\x09-\x0D]+", " ")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(text, 256).alias("own"), F.struct(*docs.columns).alias("row"))
    found = rows.join(kept, rows["doc_id"].eqNullSafe(kept["id"]) & (rows["own"] == kept["sha"]), "left_semi")
    # Rows that repeat id and text: one stays. The window is limited to one row a key before its shuffle.
    one = Window.partitionBy("doc_id", "own").orderBy("row.text", *other_columns(docs))
    return found.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("row.*")


def other_columns(docs: DataFrame) -> list[Column]:
    """What settles ties among rows of one id and text, for rows held in a struct ``row``."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    return [F.to_json(F.struct(*(F.col("row").getField(c) for c in others)))] if others else []
