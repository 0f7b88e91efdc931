"""Byte-level BPE: encode each distinct word of the corpus once, and decode by the token table."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm import dictionary
from remitlake.llm.token_counts import read_ranks
from remitlake.llm.words import tidy

SHORT = 48
#: A longer piece is cut by the pattern, so that texts without spaces are dealt by pre-token as well.
LONG = 64


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of the lowest rank is joined, the leftmost first."""
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    if len(word) > SHORT:
        return _merge_long(word, ranks)
    parts = [word[i : i + 1] for i in range(len(word))]
    get, none = ranks.get, 1 << 60
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs:
        low = min(pairs)
        if low == none:
            break
        i = pairs.index(low)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same with a heap, for words whose pairs would be scanned too often."""
    n = len(word)
    end = list(range(1, n + 1))
    before, alive = list(range(-1, n - 1)), [True] * n

    def rank(i: int):
        return ranks.get(word[i : end[end[i]]]) if end[i] < n else None

    heap = [(r, i, end[end[i]]) for i in range(n - 1) if (r := rank(i)) is not None]
    heapify(heap)
    while heap:
        r, i, stop = heappop(heap)
        if not alive[i] or end[i] >= n or end[end[i]] != stop:
            continue
        gone = end[i]
        alive[gone] = False
        end[i] = end[gone]
        if end[i] < n:
            before[end[i]] = i
        for j in (before[i], i):
            if j >= 0 and (r := rank(j)) is not None:
                heappush(heap, (r, j, end[end[j]]))
    return [ranks[word[i : end[i]]] for i in range(n) if alive[i]]


class Pieces(dictionary.Tokenizer):
    """Texts cut before single spaces; a piece is one pre-token or a few, such as a word and its stop.

    The public patterns let a pre-token begin at every space between visible characters, so cutting
    there changes none. A text in which white space follows a space, or with a piece of more than LONG
    characters, is cut by the pattern itself.
    """

    def __init__(self, pattern: str):
        self.pattern = pattern

    def split(self, text: str) -> list:
        first, *rest = text.split(" ")
        if len(first) > LONG:
            raise dictionary.Odd
        return [first.encode(), *rest]

    def exact(self, text: str) -> list[bytes]:
        return [x.encode() for x in regex.findall(self.pattern, text)]

    def odd(self, word) -> bool:
        return isinstance(word, str) and (not word or len(word) > LONG or word[0].isspace())


def gather(start: np.ndarray, size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The stretches ``data[start:start + size]`` one after the other."""
    total = int(size.sum())
    if not total:
        return data[:0]
    shift = np.repeat(start - (np.cumsum(size) - size), size)
    return data[shift + np.arange(total)]


def binary_column(data: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Consecutive stretches of bytes as a binary column."""
    at = np.concatenate([[0], np.cumsum(sizes)])
    kind, offset = (pa.binary(), np.int32) if at[-1] < 1 << 31 else (pa.large_binary(), np.int64)
    return pa.Array.from_buffers(kind, len(sizes), [None, pa.py_buffer(at.astype(offset).tobytes()), pa.py_buffer(data.tobytes())])


def resolver(ranks: dict[bytes, int], pattern: str) -> Callable[[pa.Table], Iterator[dict]]:
    """The ids of the pieces of one bucket, for each chunk that asks; pre-tokens are merged once."""

    def resolve(table: pa.Table) -> Iterator[dict]:
        known: dict[bytes, bytes] = {}
        merged: dict[str, bytes] = {}
        kind = np.uint16 if len(ranks) <= 1 << 16 else np.uint32

        def ids_of(token: str) -> bytes:
            own = merged.get(token)
            if own is None:
                own = merged[token] = np.array(merge(token.encode(), ranks), kind).tobytes()
            return own

        for chunk, check, bucket, cell in zip(*(table.column(c).to_pylist() for c in ("chunk", "check", "bucket", "words")), strict=True):
            ids = []
            for word in dictionary.unpack_words(cell):
                own = known.get(word)
                if own is None:
                    own = known[word] = b"".join(map(ids_of, regex.findall(pattern, word.decode())))
                ids.append(own)
            sizes = np.array([len(x) for x in ids], np.uint32) // np.dtype(kind).itemsize
            yield {"chunk": chunk, "check": check, "seq": bucket, "blob": dictionary.pack(sizes, np.frombuffer(b"".join(ids), kind))}

    return resolve


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids_le: the token ids of every whole text, little-endian unsigned 32-bit.

    Null and empty texts have no tokens. Rows with equal ids each have a row; other columns are
    ignored. The rank file is read on the driver; its size does not depend on the corpus. A text of
    any length is one row; its pieces are encoded elsewhere, each distinct one once, and a bucket merges
    each distinct pre-token of its pieces once. An empty table gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks_path))

    tokenizer = Pieces(pattern)

    def resolve(table: pa.Table) -> Iterator[dict]:
        return resolver(sent.value, pattern)(table)

    def assemble(arrays: list[np.ndarray], parts: Iterator[dictionary.Part]) -> Iterator[pa.RecordBatch]:
        size, data = (arrays[0].astype(np.int64), arrays[1].astype("<u4")) if arrays else (np.zeros(0, np.int64), np.zeros(0, "<u4"))
        start = np.cumsum(size) - size
        for p in parts:
            own = size[p.codes]
            ids = gather(start[p.codes], own, data)
            total = np.concatenate([[0], np.cumsum(own)])
            at = total[np.concatenate([[0], np.cumsum(p.counts)])]
            yield pa.RecordBatch.from_arrays([pa.array(p.ids, pa.int64()), binary_column(ids.view(np.uint8), np.diff(at) * 4)], names=["doc_id", "ids_le"])

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.lit(0).alias("flag"))
    buckets = dictionary.bucket_count(own)
    values = dictionary.by_bucket(dictionary.words_by_bucket(own, tokenizer, buckets), resolve, "chunk long, check long, seq long, blob binary", buckets)
    return dictionary.by_chunk(values, dictionary.places(own, tokenizer, buckets), assemble, "doc_id long, ids_le binary", buckets)


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``encoded`` with ``decoded``: the bytes of its ids, joined from the token-byte table.

    The table has a row per token of the vocabulary, a fixed size, and is sent to every task. Null ids
    decode to no bytes; an id that is not in the table fails the job.
    """
    ranks = read_ranks(ranks_path)
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, i in ranks.items():
        tokens[i] = token
    sent = encoded.sparkSession.sparkContext.broadcast(tokens)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = np.array([len(t) for t in sent.value], np.int64)
        data = np.frombuffer(b"".join(sent.value), np.uint8)
        start = np.cumsum(size) - size
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                cells = [x or b"" for x in part.column("ids_le").to_pylist()]
                ids = np.frombuffer(b"".join(cells), "<u4").astype(np.int64)
                own = size[ids]
                if (own == 0).any():
                    raise ValueError("an id is not in the token table")
                total = np.concatenate([[0], np.cumsum(own)])
                at = total[np.concatenate([[0], np.cumsum([len(c) // 4 for c in cells])]).astype(np.int64)]
                yield pa.RecordBatch.from_arrays([*part.columns, binary_column(gather(start[ids], own, data), np.diff(at))], names=[*part.schema.names, "decoded"])

    schema = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)
    return encoded.mapInArrow(tidy(work), f"{schema}, decoded binary")


def digests(decoded: DataFrame, *also: str) -> DataFrame:
    return decoded.select(
        "doc_id", F.floor(F.octet_length("ids_le") / 4).cast("long").alias("n_tokens"), F.sha2("ids_le", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), *also
    )


def brute_force(text: str | None, ranks: dict[bytes, int], pattern: str) -> tuple[int, str, str]:
    """n_tokens and both digests of one text, without Spark or shared words. For tests."""
    words = [w.encode() for w in regex.findall(pattern, text or "")]
    ids = [i for w in words for i in merge(w, ranks)]
    return len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(b"".join(words)).hexdigest()
