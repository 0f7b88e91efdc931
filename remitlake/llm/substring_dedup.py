"""Passages that repeat across documents, by recompression.

A text is a row of word symbols. In each round two equal neighbours that stand alone, and pairs whose
first symbol falls left and second right by a coin of the symbol, become one symbol. A symbol's name
is a hash of what it stands for, so every task gives equal stretches equal names. Only symbols near
the ends of a stretch depend on what is around it: after ROUNDS rounds, at most MARGIN words from
either end. Every window therefore has the same symbols inside wherever it occurs, and the NEIGHBOURS
consecutive ones of the smallest hash stand for the window. Spark rounds then find the symbols that
stand for windows of two documents or more. The windows behind those symbols are equal if two hashes of
their whole word sequence are, 96 bits made from independent hashes of the words; the words themselves
are not sent. Runs of three or more equal words get no name.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm import dictionary
from remitlake.llm.byte_bpe import gather
from remitlake.llm.words import Words, grams, mix, second_hashes, sequences, slices, words_of

WINDOW = 50
ROUNDS = 2
#: A symbol of round r has 2^r words at most, and at most three symbols at an end depend on the outside.
MARGIN = 3 * (2**ROUNDS - 1)
#: Neighbouring symbols that stand for a window together. The WINDOW - 2 * MARGIN words inside hold six
#: symbols at least, and so some such row.
NEIGHBOURS = 4
CHUNK_BYTES = 8 << 20
#: Copies of a row that one array stands for.
COPIES = 1 << 16

_R = np.random.default_rng(50)
_SALT = _R.integers(1, 2**63, (ROUNDS + 1, 3), dtype=np.uint64) | np.uint64(1)


def recompress(hashes: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols after ROUNDS rounds, and the first word and the word after the last of each."""
    symbol, start = hashes.copy(), np.arange(len(hashes))
    end = start + 1
    for first, second, salt in _SALT[:ROUNDS]:
        if len(symbol) < 2:
            break
        joined = row[start[1:]] == row[start[:-1]]
        same = joined & (symbol[1:] == symbol[:-1])
        run = np.concatenate([[0], np.cumsum(~same)])
        twice = np.bincount(run)[run] == 2
        left = (mix(symbol + salt) & np.uint64(1)).astype(bool)
        pair = joined & ~same & left[:-1] & ~left[1:] & ~twice[:-1] & ~twice[1:]
        merge = pair | (same & twice[:-1])
        name = mix(symbol[:-1] * first + symbol[1:] * second + salt)
        symbol[:-1][merge] = name[merge]
        end[:-1][merge] = end[1:][merge]
        keep = np.ones(len(symbol), bool)
        keep[1:] = ~merge
        symbol, start, end = symbol[keep], start[keep], end[keep]
    return mix(symbol + _SALT[ROUNDS, 0]), start, end


def _least_between(value: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of ``value[low:high]`` for each pair; every range has an entry."""
    tables, k = [value], 1
    while k * 2 <= int((high - low).max()):
        last = tables[-1]
        tables.append(np.minimum(last[:-k], last[k:]))
        k *= 2
    level = np.log2(high - low).astype(np.int64)
    out = np.empty(len(low), np.uint64)
    for i, table in enumerate(tables):
        own = np.flatnonzero(level == i)
        out[own] = np.minimum(table[low[own]], table[high[own] - (1 << i)])
    return out


def windows(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, row and standing symbol of every window of every row."""
    n = len(words.hash)
    row = np.repeat(np.arange(len(words.at) - 1), np.diff(words.at))
    first = np.arange(max(0, n - WINDOW + 1))
    first = first[row[first] == row[first + WINDOW - 1]] if len(first) else first
    if not len(first):
        return first, first, np.zeros(0, np.uint64)
    symbol, start, end = recompress(words.hash, row)
    symbol, start, end = grams(symbol, NEIGHBOURS), start[: 1 - NEIGHBOURS], end[NEIGHBOURS - 1 :]
    low = np.searchsorted(start, first + MARGIN)
    high = np.searchsorted(end, first + WINDOW - MARGIN, "right")
    stands = _least_between(symbol, low, high)
    return first, row[first], stands


def contents_of(words: Words, first: np.ndarray) -> np.ndarray:
    """Two hashes, of 64 and 32 bits, of the words of each window that begins at ``first``, a row each."""
    if not len(first):
        return np.zeros((2, 0), np.uint64)
    return np.stack([sequences(words.hash, WINDOW)[first], sequences(second_hashes(words), WINDOW)[first] >> np.uint64(32)])


def _by_bucket_rows(chunk: int, key: np.ndarray, bucket_key: np.ndarray, low: np.ndarray, high: np.ndarray, buckets: int) -> pa.Table:
    """Distinct keys with their smallest and largest document, packed for each bucket.

    ``key`` has a row for each part of a key; all parts tell keys apart.
    """
    bucket = (bucket_key % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((*key[::-1], bucket))
    key, bucket, low, high = key[:, order], bucket[order], low[order], high[order]
    new = np.flatnonzero(_begins(np.concatenate([key, bucket[None].astype(np.uint64)])))
    rows = {"bucket": [], "chunk": [], "blob": []}
    if len(new):
        key, bucket, low, high = key[:, new], bucket[new], np.minimum.reduceat(low, new), np.maximum.reduceat(high, new)
        cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), bucket.shape[0]]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            rows["bucket"].append(int(bucket[a]))
            rows["chunk"].append(chunk)
            rows["blob"].append(dictionary.pack(low[a:b], high[a:b] - low[a:b], *_closer(key[:, a:b])))
    return pa.table(rows, schema=_ROWS)


def _begins(key: np.ndarray) -> np.ndarray:
    """Where a key differs from the one before; the first always does."""
    out = np.ones(key.shape[1], bool)
    out[1:] = (key[:, 1:] != key[:, :-1]).any(axis=0)
    return out


def _closer(key: np.ndarray) -> list[np.ndarray]:
    """Sorted keys, the first part as differences, the others in 32 bits."""
    return [np.diff(key[0], prepend=np.uint64(0)), *key[1:].astype(np.uint32)]


def _unpacked(cells: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, smallest documents and what follows of each cell."""
    out = []
    for low, more, first, *rest in map(dictionary.unpack, cells):
        out.append((np.stack([np.cumsum(first, dtype=np.uint64), *(x.astype(np.uint64) for x in rest)]), low, more))
    return out


_ROWS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("blob", pa.binary())])
ROWS_SCHEMA = "bucket long, chunk long, blob binary"


def _answer(table: pa.Table) -> Iterator[dict]:
    """For a bucket: to each chunk, its keys that two documents have, with the smallest document."""
    cells = _unpacked(table.column("blob").to_pylist())
    every = np.concatenate([key for key, *_ in cells], axis=1)
    order = np.lexsort(every[::-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(_begins(every[:, order])) - 1
    low = np.full(int(number.max()) + 1, np.iinfo(np.int64).max)
    high = np.full(len(low), np.iinfo(np.int64).min)
    np.minimum.at(low, number, np.concatenate([c[1] for c in cells]))
    np.maximum.at(high, number, np.concatenate([c[1] + c[2] for c in cells]))
    at = 0
    for chunk, bucket, (key, *_) in zip(table.column("chunk").to_pylist(), table.column("bucket").to_pylist(), cells, strict=True):
        mine = number[at : at + key.shape[1]]
        at += key.shape[1]
        met = low[mine] < high[mine]
        if met.any():
            own = low[mine][met]
            yield {"bucket": bucket, "chunk": chunk, "blob": dictionary.pack(own, np.zeros(len(own), np.int8), *_closer(key[:, met]))}


def _answers(table: pa.Table, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the answers to a chunk, sorted, and their smallest documents."""
    cells = _unpacked(table.column("blob").to_pylist())
    if not cells:
        return np.zeros((parts, 0), np.uint64), np.zeros(0, np.int64)
    key = np.concatenate([c[0] for c in cells], axis=1)
    order = np.lexsort(key[::-1])
    return key[:, order], np.concatenate([c[1] for c in cells])[order]


def _among(values: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which values are known in all parts, and the place of each in ``known`` (sorted)."""
    n = known.shape[1]
    place = np.searchsorted(known[0], values[0])
    found = np.zeros(values.shape[1], bool)
    open_ = np.flatnonzero(place < n)
    while len(open_):
        here = known[:, place[open_]]
        open_, here = (x[..., here[0] == values[0, open_]] for x in (open_, here))
        found[open_] = (here == values[:, open_]).all(axis=0)
        # Keys of one first part stand side by side: look at the next.
        open_ = open_[~found[open_]]
        place[open_] += 1
        open_ = open_[place[open_] < n]
    return found, np.minimum(place, max(0, n - 1))


def _read(table: pa.Table) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, Words]]:
    for batch in table.to_batches():
        for part in slices(batch, "text"):
            ids = part.column("doc_id")
            yield part, ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), words_of(part.column("text"))


def _chunk_of(table: pa.Table) -> int:
    return table.column("chunk")[0].as_py()


def folded(rows: DataFrame) -> DataFrame:
    """Rows that repeat id and text as one, with their number in ``copies``. Null equals null."""
    return rows.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("copies"))


def expanded(rows: DataFrame) -> DataFrame:
    """Each row ``copies`` times, without that column; in blocks, so that no array is large."""
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(copies - 1) div %d" % COPIES)))
    inside = F.explode(F.sequence(F.lit(1).cast("long"), F.expr("least(%d, copies - block * %d)" % (COPIES, COPIES))))
    return rows.withColumn("block", block).withColumn("copy", inside).drop("copies", "block", "copy")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept (the words that stay, joined by one space, as bytes).

    A word goes if one of the windows that cover it has the word sequence of a window that starts in a
    document with a smaller id. Windows are those of the input. Null and empty texts have no words.
    Documents of null id neither lose words nor take any; documents of equal id take none from each
    other. Other columns are ignored. Rows that repeat id and text are one row with a count until the
    end, so copies fill no chunk. Texts go once to chunks of about CHUNK_BYTES; a chunk sends each
    distinct symbol and window once, so a passage in a third of the documents is an entry per chunk. Very
    long texts are read whole in their chunk; an empty table gives an empty result.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    chunks, buckets = max(12, -(-total // CHUNK_BYTES)), max(12, -(-total // dictionary.BUCKET_BYTES))
    own = folded(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    texts = own.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).repartition(chunks, "chunk")
    by_chunk = texts.groupBy("chunk")

    def symbols(table: pa.Table) -> pa.Table:
        key, doc = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, ids, null, words in _read(table):
            _, row, stands = windows(words)
            change = np.ones(len(row), bool)
            change[1:] = (row[1:] != row[:-1]) | (stands[1:] != stands[:-1])
            change &= ~null[row]
            key.append(stands[change])
            doc.append(ids[row[change]])
        key, doc = np.concatenate(key), np.concatenate(doc)
        return _by_bucket_rows(_chunk_of(table), key[None], key, doc, doc, buckets)

    def contents(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({n: [] for n in _ROWS.names}, schema=_ROWS)
        shared, _ = _answers(answers, 1)
        key, stand, doc = [np.zeros((2, 0), np.uint64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        for _, ids, null, words in _read(table):
            first, row, stands = windows(words)
            found = _among(stands[None], shared)[0] & ~null[row]
            if found.any():
                key.append(contents_of(words, first[found]))
                stand.append(stands[found])
                doc.append(ids[row[found]])
        key, stand, doc = np.concatenate(key, axis=1), np.concatenate(stand), np.concatenate(doc)
        return _by_bucket_rows(_chunk_of(table), key, stand, doc, doc, buckets)

    def removed(table: pa.Table, answers: pa.Table) -> pa.Table:
        known, low = _answers(answers, 2)
        out = []
        for part, ids, null, words in _read(table):
            first, row, _ = windows(words)
            met, place = _among(contents_of(words, first) if known.size else np.zeros((2, len(first)), np.uint64), known)
            met &= ~null[row]
            met[met] = ids[row[met]] > low[place[met]]
            edge = np.zeros(len(words.hash) + 1, np.int64)
            np.add.at(edge, first[met], 1)
            np.add.at(edge, first[met] + WINDOW, -1)
            keep = np.cumsum(edge[:-1]) == 0
            kept = np.concatenate([[0], np.cumsum(keep)])[words.at]
            start, size = words.start[keep], (words.end - words.start)[keep] + 1
            raw = np.append(words.raw, np.uint8(32))
            text = gather(start, size, raw).copy()
            stop = np.concatenate([[0], np.cumsum(size)])
            text[stop[1:] - 1] = 32
            n, stays = np.diff(words.at), np.diff(kept)
            cells = [text[a : b - 1 if b > a else b].tobytes() for a, b in zip(stop[kept[:-1]].tolist(), stop[kept[1:]].tolist(), strict=True)]
            out.append(pa.table({"doc_id": part.column("doc_id"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(n - stays, pa.int64()), "kept": pa.array(cells, pa.binary()), "copies": part.column("copies")}))
        return pa.concat_tables(out) if out else pa.table({"doc_id": pa.array([], pa.int64()), "n_words": pa.array([], pa.int64()), "n_removed": pa.array([], pa.int64()), "kept": pa.array([], pa.binary()), "copies": pa.array([], pa.int64())})

    met = dictionary.by_bucket(by_chunk.applyInArrow(symbols, ROWS_SCHEMA), _answer, ROWS_SCHEMA, buckets)
    same = dictionary.by_bucket(by_chunk.cogroup(met.groupBy("chunk")).applyInArrow(contents, ROWS_SCHEMA), _answer, ROWS_SCHEMA, buckets)
    return expanded(by_chunk.cogroup(same.groupBy("chunk")).applyInArrow(removed, "doc_id long, n_words long, n_removed long, kept binary, copies long"))


def digests(result: DataFrame) -> DataFrame:
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    """doc_id, n_words, n_removed, kept_sha256 by comparing all windows. For tests."""
    seen: dict[tuple, int] = {}
    split = [(i, (t or "").encode().split()) for i, t in rows]
    for i, w in split:
        for p in range(len(w) - WINDOW + 1) if i is not None else ():
            key = tuple(w[p : p + WINDOW])
            seen[key] = min(seen.get(key, i), i)
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - WINDOW + 1) if i is not None else ():
            if seen[tuple(w[p : p + WINDOW])] < i:
                gone[p : p + WINDOW] = [True] * WINDOW
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out
