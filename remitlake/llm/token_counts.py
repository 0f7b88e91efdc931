"""Greedy longest-match word-piece lengths by a linear automaton.

A word is read as one space and its bytes. Pieces that begin with the space can only stand first,
all others only inside, so the vocabulary is one trie with two kinds of roots: the empty prefix at a
word's start and the empty prefix after a piece. When no trie edge fits, the failure link of a node
gives the node that remains after the longest matches of the text so far are taken off, and the
number of pieces taken off is precomputed. A word's length in pieces is the sum of those numbers:
no piece is built and no byte is read twice.
"""

from __future__ import annotations

import base64
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from remitlake.llm.words import slices, words_of

#: Words remembered by a task; beyond it the memory is emptied, which costs time and changes nothing.
REMEMBERED = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ids of a rank file. The file has a fixed size, whatever the corpus."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PieceAutomaton:
    def __init__(self, pieces: list[bytes]):
        self.edges: dict[int, int] = {}
        self.final = [False, False]
        self.depth = [0, 0]
        order: list[tuple[int, int, int]] = []
        for piece in pieces:
            node = 0 if piece[:1] == b" " else 1
            for byte in piece:
                key = node << 8 | byte
                child = self.edges.get(key)
                if child is None:
                    child = self.edges[key] = len(self.final)
                    self.final.append(False)
                    self.depth.append(self.depth[node] + 1)
                    order.append((node, byte, child))
                node = child
            self.final[node] = True
        # Failure links, by depth. Node 1 is where a piece inside a word begins.
        self.link: list[int] = [-1] * len(self.final)
        self.popped: list[int] = [0] * len(self.final)
        for parent, byte, child in sorted(order, key=lambda x: self.depth[x[0]]):
            if self.final[child]:
                self.link[child], self.popped[child] = 1, 1
                continue
            node, taken = self.link[parent], self.popped[parent]
            while node >= 0 and (node << 8 | byte) not in self.edges:
                taken += self.popped[node]
                node = self.link[node]
            if node >= 0:
                self.link[child], self.popped[child] = self.edges[node << 8 | byte], taken

    def length(self, word: bytes) -> int | None:
        """Pieces of a word; None if some byte fits no piece."""
        node, taken, edges, link, popped = 0, 0, self.edges, self.link, self.popped
        for byte in b" " + word:
            while (child := edges.get(node << 8 | byte)) is None:
                taken += popped[node]
                node = link[node]
                if node < 0:
                    return None
            node = child
        while node != 1:
            taken += popped[node]
            node = link[node]
            if node < 0:
                return None
        return taken


class _Lengths(dict):
    def __init__(self, automaton: PieceAutomaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: bytes) -> int:
        n = self.automaton.length(word)
        # A word that cannot be cut into pieces is one unknown piece.
        n = 1 if n is None else n
        if len(word) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[word] = n
        return n


def token_counts(docs: DataFrame, vocabulary_path: str) -> DataFrame:
    """doc_id, n_words, n_tokens of every row of ``docs``.

    Words are runs of bytes without white space. ``vocabulary_path`` is a rank file on the driver; its
    bounded content is sent to the tasks once. Null and empty texts have no words and no tokens. Rows
    with equal ids each have a row; other columns are ignored. No shuffle.
    """
    spark: SparkSession = docs.sparkSession
    pieces = spark.sparkContext.broadcast(sorted(read_ranks(vocabulary_path)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            known = known or _Lengths(PieceAutomaton(pieces.value))
            for part in slices(batch, "text"):
                words = words_of(part.column("text"), hashed=False)
                raw, at = words.raw.tobytes(), words.at
                ends = [*zip(words.start.tolist(), words.end.tolist(), strict=True)]
                n = np.fromiter((known[raw[a:b]] for a, b in ends), np.int64, len(ends))
                total = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(at), pa.int64()), pa.array(total[at[1:]] - total[at[:-1]], pa.int64())], names=["doc_id", "n_words", "n_tokens"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(count, "doc_id long, n_words long, n_tokens long")
