"""A value for every word of every document, found once for each distinct word of the corpus.

Documents are cut into chunks of consecutive rows. A chunk's distinct words go to buckets by hash; a
bucket holds the same words of all chunks, finds each value once, and answers every chunk. The
positions of the words go to the chunk on a second way, as numbers of its dictionary, and meet the
values there. So what is shuffled is one entry per distinct word and chunk and a byte or two per
word, and a word with a third of all places is one entry per chunk.

With ``words_by_bucket`` and ``places`` both ways read the documents, and a chunk is known by a hash of
its texts: if a source gives other rows the second time, the job fails and nothing wrong is returned.
Give it a table, not a random sample. ``both_ways`` reads them once and stores both, which takes less
time and more disk. Chunks of the very same texts share their dictionary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm.words import Words, groups, slices, tidy, utf8, words_of

CHUNK_BYTES = 16 << 20
PART_BYTES = 4 << 20
#: Bytes of text for each bucket; a bucket's words are held in one task.
BUCKET_BYTES = 16 << 20

WORDS_SCHEMA = "bucket long, chunk long, check long, words binary, weights binary"
PLACES_SCHEMA = "chunk long, check long, kind int, seq long, ids array<long>, flags array<int>, blob binary"
VALUES, ORDER, PLACES, WORDS = 0, 1, 2, 3
STORED_SCHEMA = f"{PLACES_SCHEMA}, bucket long, words binary, weights binary"


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed cell; integers are stored byte plane by byte plane."""
    parts = [len(arrays).to_bytes(4, "little")]
    for a in arrays:
        a = np.ascontiguousarray(a)
        planes = a.view(np.uint8).reshape(-1, a.dtype.itemsize).T.tobytes()
        parts += [a.dtype.str.encode().ljust(4), len(a).to_bytes(8, "little"), planes]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(cell: bytes) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(cell)
    out, at = [], 4
    for _ in range(int.from_bytes(data[:4], "little")):
        kind, n = np.dtype(data[at : at + 4].decode().strip()), int.from_bytes(data[at + 4 : at + 12], "little")
        size = n * kind.itemsize
        planes = np.frombuffer(data, np.uint8, size, at + 12).reshape(kind.itemsize, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind) if n else np.zeros(0, kind))
        at += 12 + size
    return out


class Odd(Exception):
    """A text that ``split`` may not cut."""


class Tokenizer:
    """How a text is cut into words. A word is bytes, or a str that stands for a space and itself."""

    def split(self, text: str) -> list:
        raise NotImplementedError

    def exact(self, text: str) -> list[bytes]:
        """The words of a text in which ``split`` met an odd one."""
        raise NotImplementedError

    def odd(self, word) -> bool:
        return False


class PlainWords(Tokenizer):
    """Words between ASCII white space, as bytes: cut and numbered without a Python step per word."""

    def column(self, texts: pa.Array) -> pa.Array:
        """The texts as they are cut."""
        return texts

    def split(self, text: str) -> list[bytes]:
        return self.column(pa.array([text])).to_pylist()[0].encode().split()


class _Codes(dict):
    def __init__(self, odd: Callable):
        super().__init__()
        self.odd = odd

    def __missing__(self, word):
        if self.odd(word):
            raise Odd
        self[word] = code = len(self)
        return code

    def all_of(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint32, len(words))


@dataclass
class Chunk:
    number: int
    check: int
    words: list[bytes]
    bucket_order: np.ndarray
    buckets: np.ndarray
    codes: np.ndarray
    counts: np.ndarray
    ids: list
    flags: list
    sizes: list
    weights: np.ndarray


def _chunks(batches: Iterator[pa.RecordBatch], tokenizer: Tokenizer, buckets: int) -> Iterator[Chunk]:
    if isinstance(tokenizer, PlainWords):
        yield from _plain_chunks(batches, tokenizer, buckets)
        return

    def close() -> Chunk:
        words = [w if isinstance(w, bytes) else b" " + w.encode() for w in book]
        bucket = np.fromiter((crc32(w) % buckets for w in words), np.int64, len(words))
        codes = np.concatenate(places) if places else np.zeros(0, np.uint32)
        trained = np.repeat(np.array(flags, np.int64) == 0, counts)
        digest = seen.intdigest()
        return Chunk(digest >> 65, digest & (1 << 63) - 1, words, np.argsort(bucket, kind="stable"), bucket, codes, np.array(counts, np.int64), ids, flags, sizes, np.bincount(codes[trained], minlength=len(words)))

    def fresh():
        return _Codes(tokenizer.odd), [], [], [], [], [], xxhash.xxh3_128(), 0

    book, places, counts, ids, flags, sizes, seen, held = fresh()
    for batch in batches:
        flag = batch.column("flag").to_pylist()
        for i, text in enumerate(batch.column("text")):
            value = text.as_py() or ""
            try:
                found = book.all_of(tokenizer.split(value))
            except Odd:
                found = book.all_of(tokenizer.exact(value))
            places.append(found)
            counts.append(len(found))
            ids.append(batch.column("doc_id")[i].as_py())
            flags.append(flag[i])
            sizes.append(len(value))
            seen.update(f"{len(value)}:{value}")
            held += len(value)
            if held >= CHUNK_BYTES:
                # What the chunk was made of goes before the chunk is worked on, and that before the next.
                done = close()
                book, places, counts, ids, flags, sizes, seen, held = fresh()
                yield done
                del done
    if ids:
        yield close()


def _plain_chunks(batches: Iterator[pa.RecordBatch], tokenizer: PlainWords, buckets: int) -> Iterator[Chunk]:
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for part in slices(batch, "text", CHUNK_BYTES):
            held.append(part)
            size += pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
            if size >= CHUNK_BYTES:
                done = _plain_chunk(pa.Table.from_batches(held), tokenizer, buckets)
                held, size = [], 0
                yield done
                del done
    if held:
        yield _plain_chunk(pa.Table.from_batches(held), tokenizer, buckets)


def _plain_chunk(table: pa.Table, tokenizer: PlainWords, buckets: int) -> Chunk:
    texts = pa.concat_arrays(table.column("text").cast(pa.large_string()).chunks)
    raw, at = utf8(texts)
    seen = xxhash.xxh3_128(at.tobytes())
    seen.update(raw)
    words = words_of(tokenizer.column(pc.fill_null(texts, "")))
    own, codes, bucket = number(words)
    counts = np.diff(words.at)
    flags = table.column("flag").to_pylist()
    trained = np.repeat(np.array(flags, np.int64) == 0, counts)
    digest = seen.intdigest()
    where = (bucket % np.uint64(buckets)).astype(np.int64)
    weights = np.bincount(codes[trained], minlength=len(own))
    return Chunk(digest >> 65, digest & (1 << 63) - 1, own, np.argsort(where, kind="stable"), where, codes, counts, table.column("doc_id").to_pylist(), flags, np.diff(at).tolist(), weights)


def number(words: Words) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words, the number of each word among them, and a hash of each distinct word.

    Words are told apart by their bytes: those of equal hash are compared with the first of them.
    """
    hashes, first, codes = np.unique(words.hash, return_index=True, return_inverse=True)
    start, end = words.start[first], words.end[first]
    # Eight bytes from each place; what lies behind the end of a word is masked.
    data = np.concatenate([words.raw, np.zeros(16 - len(words.raw) % 8, np.uint8)])
    eight = np.lib.stride_tricks.as_strided(data.view(np.uint64), (len(words.raw),), (1,))
    left = words.end - words.start
    same = left == (end - start)[codes]
    rows, skip = np.flatnonzero(same), 0
    while len(rows):
        n = np.minimum(left[rows] - skip, 8)
        mask = np.where(n == 8, np.uint64(2**64 - 1), (np.uint64(1) << (8 * (n % 8)).astype(np.uint64)) - np.uint64(1))
        a, b = eight[words.start[rows] + skip], eight[start[codes[rows]] + skip]
        same[rows[((a ^ b) & mask) != 0]] = False
        skip += 8
        rows = rows[left[rows] > skip]
    if same.all():
        text = words.raw.tobytes()
        return [text[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)], codes, hashes
    book: dict[bytes, int] = {}
    codes = np.array([book.setdefault(words.text(i), len(book)) for i in range(len(codes))], np.int64)
    kept = np.unique(codes, return_index=True)[1]
    return list(book), codes, words.hash[kept]


def _word_rows(c: Chunk) -> Iterator[dict]:
    own = c.buckets[c.bucket_order]
    cuts = np.flatnonzero(np.diff(own)) + 1
    for part in np.split(c.bucket_order, cuts) if len(own) else []:
        words = [c.words[i] for i in part]
        sizes = np.array([len(w) for w in words], np.uint32)
        cell = pack(sizes, np.frombuffer(b"".join(words), np.uint8))
        yield {"bucket": int(c.buckets[part[0]]), "chunk": c.number, "check": c.check, "words": cell, "weights": pack(c.weights[part].astype(np.uint32))}


def words_by_bucket(docs: DataFrame, tokenizer: Tokenizer, buckets: int) -> DataFrame:
    """One row for each chunk and bucket with words: the words, and how often each is in rows of flag 0."""
    return _rows_of_chunks(docs, tokenizer, buckets, _word_rows, WORDS_SCHEMA)


def _rows_of_chunks(docs: DataFrame, tokenizer: Tokenizer, buckets: int, rows_of: Callable[[Chunk], Iterator[dict]], schema: str) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = _schema(schema)
        for c in _chunks(batches, tokenizer, buckets):
            for row in rows_of(c):
                yield pa.RecordBatch.from_pylist([row], schema=kind)
            del c

    return docs.mapInArrow(tidy(work), schema)


def both_ways(docs: DataFrame, tokenizer: Tokenizer, buckets: int, path: str) -> tuple[DataFrame, DataFrame]:
    """``words_by_bucket`` and ``places`` of one read of ``docs``, stored at ``path``."""

    def rows_of(c: Chunk) -> Iterator[dict]:
        for row in _word_rows(c):
            yield row | {"kind": WORDS}
        yield from _place_rows(c)

    _rows_of_chunks(docs, tokenizer, buckets, rows_of, STORED_SCHEMA).write.parquet(path)
    stored = docs.sparkSession.read.parquet(path)
    words = stored.where(F.col("kind") == WORDS).select("bucket", "chunk", "check", "words", "weights")
    return words, stored.where(F.col("kind") != WORDS).select("chunk", "check", "kind", "seq", "ids", "flags", "blob")


def unpack_words(cell: bytes) -> list[bytes]:
    sizes, data = unpack(cell)
    ends = np.cumsum(sizes).tolist()
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip([0, *ends][: len(ends)], ends, strict=True)]


def by_bucket(words: DataFrame, work: Callable[[pa.Table], Iterator[dict]], schema: str, buckets: int) -> DataFrame:
    """``work`` on the rows of each bucket, whole; it yields rows of ``schema`` as dictionaries.

    There are as many tasks as buckets, so that a task's share stays the same as the input grows.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for table in groups(batches, "bucket"):
            for row in work(table):
                kind = kind or _schema(schema)
                yield pa.RecordBatch.from_pylist([row], schema=kind)

    return words.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(tidy(each), schema)


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32()), "array<double>": pa.list_(pa.float64()), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def _place_rows(c: Chunk) -> Iterator[dict]:
    n = len(c.words)
    at_bucket = np.empty(n, np.uint32)
    at_bucket[c.bucket_order] = np.arange(n, dtype=np.uint32)
    frequent = np.argsort(-np.bincount(c.codes, minlength=n), kind="stable")
    rank = np.empty(n, np.uint32)
    rank[frequent] = np.arange(n, dtype=np.uint32)
    head = {"chunk": c.number, "check": c.check}
    yield head | {"kind": ORDER, "seq": 0, "ids": [], "flags": [], "blob": pack(at_bucket[frequent])}
    piece = np.cumsum(c.sizes) // PART_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(c.ids)]
    at = np.concatenate([[0], np.cumsum(c.counts)])
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        blob = pack(c.counts[a:b].astype(np.uint32), rank[c.codes[at[a] : at[b]]])
        yield head | {"kind": PLACES, "seq": k, "ids": c.ids[a:b], "flags": c.flags[a:b], "blob": blob}


def places(docs: DataFrame, tokenizer: Tokenizer, buckets: int) -> DataFrame:
    """PLACES_SCHEMA: a row with the order of a chunk's dictionary, and rows with its words' places.

    Words are numbered by frequency, so that most numbers are small.
    """
    return _rows_of_chunks(docs, tokenizer, buckets, _place_rows, PLACES_SCHEMA)


@dataclass
class Part:
    """Some documents of a chunk: word ``codes`` (numbers of ``values``) and words of each document."""

    ids: list
    flags: list
    counts: np.ndarray
    codes: np.ndarray


def by_chunk(values: DataFrame, coded: DataFrame, work: Callable[[list[np.ndarray], Iterator[Part]], Iterator[pa.RecordBatch]], schema: str, tasks: int) -> DataFrame:
    """``work`` on every chunk, with the arrays of its dictionary's values in the order of its codes.

    ``values`` has chunk, check, seq (the bucket) and blob (arrays packed; the first has a number for
    each word, the others follow by it or are taken as they are). A chunk is met as a stream of parts.
    """
    own = values.select("chunk", "check", F.lit(VALUES).alias("kind"), "seq", F.lit(None).cast("array<long>").alias("ids"), F.lit(None).cast("array<int>").alias("flags"), "blob")
    both = own.unionByName(coded).repartition(tasks, "chunk").sortWithinPartitions("chunk", "kind", "seq")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ({n: b.column(i)[r].as_py() for i, n in enumerate(b.schema.names)} for b in batches for r in range(b.num_rows))
        row = next(rows, None)
        while row is not None:
            chunk, check, cells, last = row["chunk"], row["check"], [], -1

            def here():
                if row is None or row["chunk"] != chunk:
                    return False
                if row["check"] != check:
                    raise RuntimeError("the documents were not the same when read a second time")
                return True

            while here() and row["kind"] == VALUES:
                if row["seq"] != last:
                    cells.append(unpack(row["blob"]))
                last = row["seq"]
                row = next(rows, None)
            if not here() or row["kind"] != ORDER:
                raise RuntimeError("a chunk's dictionary has no order: the documents changed between two reads")
            order = unpack(row["blob"])[0]
            arrays = [np.concatenate(x) for x in zip(*cells, strict=True)]
            if cells and len(arrays[0]) != len(order) or not cells and len(order):
                raise RuntimeError("a chunk's dictionary is not complete: the documents changed between two reads")
            while here() and row["kind"] == ORDER:
                row = next(rows, None)

            def parts(order=order):
                nonlocal row
                while here() and row["kind"] == PLACES:
                    counts, ranks = unpack(row["blob"])
                    yield Part(row["ids"], row["flags"], counts.astype(np.int64), order[ranks] if len(ranks) else ranks)
                    row = next(rows, None)

            yield from work(arrays, parts())

    return both.mapInArrow(tidy(each), schema)


def bucket_count(docs: DataFrame) -> int:
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return max(12, -(-total // BUCKET_BYTES))
