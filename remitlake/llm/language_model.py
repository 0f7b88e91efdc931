"""Log-likelihood of whole documents by a gated recurrent language model.

Counts of every word are formed over the whole corpus by the dictionary exchange. The most frequent
words are output words in classes of CLASS_WORDS; the others fall in classes by the size of their
count, within which a word has its share of the counts; a last class is one symbol for all words never met. The
network gives the class from its state and, for frequent words, the word from state and class.

Training is truncated backpropagation in numpy: each task follows its documents in lanes, carries the
state from window to window, and the tasks' parameters are averaged by Spark between rounds.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from heapq import heapify, heapreplace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from remitlake.llm import dictionary
from remitlake.scratch import scratch_path

CLASS_WORDS = 20
HEAD_CLASSES = 20
HEAD = CLASS_WORDS * HEAD_CLASSES
#: Classes of the other words, by their count's power of 2^BIN_BITS.
BIN_BITS, BINS = 4, 11
CLASSES = HEAD_CLASSES + BINS + 1
UNSEEN = HEAD + BINS
START = UNSEEN + 1
#: A word met once that stands for words never met while the network trains.
ONCE = START + 1
HIDDEN = 16
#: Steps that gradients run back, and steps scored at once.
WINDOW, SCORED = 32, 16
#: Each round trains on its share of the training documents, by a hash of the id: together on all.
ROUNDS = 2
LANES_TRAIN, LANES_SCORE = (16, 256), 256
#: Updates that a task makes of its documents at least, as long as there are lanes to give up for it.
UPDATES = 400
#: Steps until the full rate.
WARM = 60
HOLD_TOKENS = 8 << 20
REDUCERS = 32

CODED = "doc_ids array<long>, flags array<int>, n_known array<long>, log_base array<double>, log_tail array<double>, blob binary"


class LowerWords(dictionary.PlainWords):
    """Runs without white space; A-Z become a-z, other letters stay."""

    def column(self, texts: pa.Array) -> pa.Array:
        return pc.ascii_lower(texts)


def _totals(table: pa.Table) -> dict[bytes, int]:
    total: dict[bytes, int] = {}
    for cell, weights in zip(table.column("words").to_pylist(), table.column("weights").to_pylist(), strict=True):
        for word, n in zip(dictionary.unpack_words(cell), dictionary.unpack(weights)[0].tolist(), strict=True):
            total[word] = total.get(word, 0) + n
    return total


def _summary(table: pa.Table) -> Iterator[dict]:
    total = _totals(table)
    counts = np.array([n for n in total.values() if n], np.int64)
    bins = np.bincount(bin_of(counts), counts, BINS).astype(np.int64) if len(counts) else np.zeros(BINS, np.int64)
    top = sorted(((n, w) for w, n in total.items() if n), key=lambda x: (-x[0], x[1]))[:HEAD]
    yield {"v": len(counts), "once": int((counts == 1).sum()), "bins": bins.tolist(), "words": dictionary.pack(*_cells([w for _, w in top])), "counts": [n for n, _ in top]}


def bin_of(counts: np.ndarray) -> np.ndarray:
    return np.log2(np.maximum(1, counts)).astype(np.int64) // BIN_BITS


def _cells(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([len(w) for w in words], np.uint32), np.frombuffer(b"".join(words), np.uint8)


class Vocabulary:
    """The bounded part of the counts: frequent words, sums of the count classes, N and V."""

    def __init__(self, head: list[tuple[bytes, int]], bins: np.ndarray, distinct: int, once: int, ends: int):
        # Number 0 is the end of a text.
        self.head = {w: i + 1 for i, (w, _) in enumerate(head[: HEAD - 1])}
        self.ends, self.tokens = ends, int(bins.sum()) + ends
        self.distinct, self.once = distinct + (ends > 0), once
        self.tail = bins.astype(np.float64).copy()
        for _, n in head[: HEAD - 1]:
            self.tail[bin_of(np.array([n]))[0]] -= n
        self.counts = np.array([ends, *(n for _, n in head[: HEAD - 1])], np.float64)
        self.counts = np.pad(self.counts, (0, HEAD - len(self.counts)))


def vocabulary(words: DataFrame, ends: int, buckets: int) -> Vocabulary:
    """At most HEAD words and BINS sums reach the driver."""
    path = scratch_path(words.sparkSession, "counts")
    dictionary.by_bucket(words, _summary, "v long, once long, bins array<long>, words binary, counts array<long>", buckets).write.parquet(path)
    stored = words.sparkSession.read.parquet(path)
    distinct, once = (n or 0 for n in stored.agg(F.sum("v"), F.sum("once")).head())
    bins = np.zeros(BINS, np.int64)
    for r in stored.select(F.posexplode("bins").alias("k", "n")).groupBy("k").agg(F.sum("n").alias("n")).collect():
        bins[r["k"]] = r["n"]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cell, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(dictionary.unpack_words(cell), pa.binary()), pa.array(counts, pa.int64())], names=["word", "n"])

    top = stored.select("words", "counts").mapInArrow(spread, "word binary, n long").orderBy(F.desc("n"), "word").limit(HEAD - 1).collect()
    return Vocabulary([(bytes(r["word"]), r["n"]) for r in top], bins, distinct, once, ends)


class GatedModel:
    """h' = (1 - z) n + z h; P(word) = P(class | h) P(word | class, h)."""

    def __init__(self, vocab: Vocabulary | None = None, seed: int = 11):
        r, h = np.random.default_rng(seed), HIDDEN
        f = lambda *s: (r.standard_normal(s) * 0.1).astype(np.float32)
        self.p = {"X": f(START + 1, 3 * h), "U": f(h, 2 * h), "V": f(h, h), "C": f(h, CLASSES), "c": np.zeros(CLASSES, np.float32), "W": f(HEAD_CLASSES, h, CLASS_WORDS), "w": np.zeros((HEAD_CLASSES, CLASS_WORDS), np.float32)}
        if vocab is not None:
            # Starts from the frequencies, so that training begins with a model of single words.
            head = vocab.counts.reshape(HEAD_CLASSES, CLASS_WORDS) + 0.1
            tail = np.maximum(0, vocab.tail) + 0.1
            tail[0] = max(0.1, tail[0] - vocab.once / 2)
            mass = np.concatenate([head.sum(axis=1), tail, [vocab.once / 2 + 0.5]])
            self.p["c"] = np.log(mass / mass.sum()).astype(np.float32)
            self.p["w"] = np.log(head / head.sum(axis=1, keepdims=True)).astype(np.float32)

    def run(self, token: np.ndarray, alive: np.ndarray, h: np.ndarray):
        """Some steps of all lanes; rows are those of step after step, of the first ``alive`` lanes.

        Returns the states before, the gates, the proposals, the states after, where each step's rows
        begin, and the rows that begin a document, whose state before is zero.
        """
        p, at = self.p, np.concatenate([[0], np.cumsum(alive)])
        g, first = p["X"][token], np.flatnonzero(token == START)
        cut = np.searchsorted(first, at).tolist()
        old, new, out = (np.empty((len(token), HIDDEN), np.float32) for _ in range(3))
        zr = np.empty((len(token), 2 * HIDDEN), np.float32)
        for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            o, q, n = old[a:b], zr[a:b], new[a:b]
            o[:] = h[: b - a]
            if cut[i] < cut[i + 1]:
                old[first[cut[i] : cut[i + 1]]] = 0
            np.matmul(o, p["U"], out=q)
            q += g[a:b, : 2 * HIDDEN]
            np.exp(np.negative(q, out=q), out=q)
            q += 1
            np.reciprocal(q, out=q)
            np.matmul(q[:, HIDDEN:] * o, p["V"], out=n)
            n += g[a:b, 2 * HIDDEN :]
            np.tanh(n, out=n)
            h = np.subtract(o, n, out=out[a:b])
            h *= q[:, :HIDDEN]
            h += n
        return old, zr, new, out, at, first

    def losses(self, h: np.ndarray, target: np.ndarray, gradients: bool = False):
        """Natural log-probability of each target token from its state.

        States lie within -1 and 1 and weights are small, so no power can overflow: nothing is shifted.
        """
        p, kind = self.p, np.where(target < HEAD, target // CLASS_WORDS, target - HEAD + HEAD_CLASSES)
        at = np.arange(len(target))
        e = h @ p["C"]
        e += p["c"]
        out = e[at, kind]
        total = np.exp(e, out=e) @ np.ones(CLASSES, np.float32)
        out -= np.log(total)
        g = {}
        if gradients:
            e /= total[:, None]
            e[at, kind] -= 1
            g = {"C": h.T @ e, "c": e.sum(axis=0), "h": e @ p["C"].T, "W": np.zeros_like(p["W"]), "w": np.zeros_like(p["w"])}
        # Frequent words, by class: all of a class are one product.
        own = np.flatnonzero(kind < HEAD_CLASSES)
        own = own[np.argsort(kind[own], kind="stable")]
        cuts = np.searchsorted(kind[own], np.arange(HEAD_CLASSES + 1)).tolist()
        spans = [(k, a, b) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)) if b > a]
        state, e, at, word = h[own], p["w"][kind[own]], np.arange(len(own)), target[own] % CLASS_WORDS
        for k, a, b in spans:
            e[a:b] += state[a:b] @ p["W"][k]
        part = e[at, word]
        total = np.exp(e, out=e) @ np.ones(CLASS_WORDS, np.float32)
        out[own] += part - np.log(total)
        if gradients:
            e /= total[:, None]
            e[at, word] -= 1
            back = np.empty_like(state)
            for k, a, b in spans:
                g["W"][k], g["w"][k] = state[a:b].T @ e[a:b], e[a:b].sum(axis=0)
                back[a:b] = e[a:b] @ p["W"][k].T
            g["h"][own] += back
        return (out, g) if gradients else out


def lanes_of(counts: np.ndarray, most: int) -> list[list[int]]:
    """Documents dealt to lanes of about equal length, the longest lane first."""
    lanes = [(0, k, []) for k in range(max(1, min(most, len(counts))))]
    heapify(lanes)
    for i in np.argsort(-counts, kind="stable").tolist():
        n, k, own = lanes[0]
        own.append(i)
        heapreplace(lanes, (n + int(counts[i]), k, own))
    return [own for *_, own in sorted(lanes, key=lambda x: -x[0]) if own]


class Lanes:
    """Documents one after the other in lanes side by side; memory grows with their tokens alone."""

    def __init__(self, counts: np.ndarray, tokens: np.ndarray, most: int):
        lanes = lanes_of(counts, most) if len(counts) else []
        order = np.array([i for own in lanes for i in own], np.int64)
        n = counts[order]
        begin = np.cumsum(n) - n
        self.doc = np.repeat(order, n)
        self.target = tokens[np.repeat((np.cumsum(counts) - counts)[order] - begin, n) + np.arange(int(n.sum()))]
        self.enter = np.empty_like(self.target)
        self.enter[1:] = self.target[:-1]
        self.enter[begin] = START
        size = np.array([len(own) for own in lanes], np.int64)
        self.length = np.add.reduceat(n, np.cumsum(size) - size) if len(n) else n
        self.at = np.cumsum(self.length) - self.length

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Lanes alive at each of the next ``steps`` steps, and the places of their rows."""
        last = int(self.length.max()) if len(self.length) else 0
        for a in range(0, last, steps):
            step = np.arange(a, min(last, a + steps))
            alive = np.searchsorted(-self.length, -step, "left")
            yield alive, np.concatenate([self.at[:k] + t for t, k in zip(step.tolist(), alive.tolist(), strict=True)])


def score_documents(model: GatedModel, counts: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    """Natural log-probability of each document; the state runs through it from start to end."""
    lanes = Lanes(counts, tokens, LANES_SCORE)
    out, h = np.zeros(len(counts)), np.zeros((len(lanes.length), HIDDEN), np.float32)
    for alive, rows in lanes.windows(SCORED):
        *_, after, at, _ = model.run(lanes.enter[rows], alive, h)
        out += np.bincount(lanes.doc[rows], model.losses(after, lanes.target[rows]), len(counts))
        h = after[at[-2] :]
    return out


def train(model: GatedModel, counts: np.ndarray, tokens: np.ndarray, moments: dict, rate: float = 4e-3) -> None:
    """One pass by Adam; gradients run back WINDOW steps, the state runs on.

    Few documents go in few lanes, so that they are worth enough updates.
    """
    fewest, most = LANES_TRAIN
    lanes = Lanes(counts, tokens, int(np.clip(len(tokens) // (WINDOW * UPDATES), fewest, most)))
    p, h = model.p, np.zeros((len(lanes.length), HIDDEN), np.float32)
    for alive, rows in lanes.windows(WINDOW):
        token = lanes.enter[rows]
        old, zr, new, after, at, first = model.run(token, alive, h)
        h = after[at[-2] :].copy()
        _, g = model.losses(after, lanes.target[rows], True)
        z, r, to_state = np.ascontiguousarray(zr[:, :HIDDEN]), np.ascontiguousarray(zr[:, HIDDEN:]), g.pop("h")
        to_z, to_n, to_r = (old - new) * z * (1 - z), (1 - z) * (1 - new * new), old * r * (1 - r)
        gates, proposal = np.empty((len(token), 2 * HIDDEN), np.float32), np.empty((len(token), HIDDEN), np.float32)
        from_gates, from_proposal = np.ascontiguousarray(p["U"].T), np.ascontiguousarray(p["V"].T)
        cut, back = np.searchsorted(first, at).tolist(), np.zeros((0, HIDDEN), np.float32)
        for i in range(len(alive) - 1, -1, -1):
            a, b = int(at[i]), int(at[i + 1])
            own, e = to_state[a:b], gates[a:b]
            own[: len(back)] += back
            np.multiply(own, to_z[a:b], out=e[:, :HIDDEN])
            through = np.multiply(own, to_n[a:b], out=proposal[a:b]) @ from_proposal
            np.multiply(through, to_r[a:b], out=e[:, HIDDEN:])
            back = e @ from_gates
            through *= r[a:b]
            back += through
            back += own * z[a:b]
            if cut[i] < cut[i + 1]:
                back[first[cut[i] : cut[i + 1]] - a] = 0
        g["U"], g["V"] = old.T @ gates, (r * old).T @ proposal
        d = np.concatenate([gates, proposal], axis=1)
        order = np.argsort(token, kind="stable")
        met = np.flatnonzero(np.diff(token[order], prepend=-1))
        g["X"] = np.zeros_like(p["X"])
        g["X"][token[order[met]]] = np.add.reduceat(d[order], met, axis=0)
        moments["t"] = moments.get("t", 0) + 1
        step = min(1.0, moments["t"] / WARM) * rate / (1 - 0.9 ** moments["t"])
        for name, x in g.items():
            x = x / len(token)
            one, two = moments.setdefault(name, (np.zeros_like(x), np.zeros_like(x)))
            one += 0.1 * (x - one)
            two += 0.01 * (x * x - two)
            p[name] -= (step * one / (np.sqrt(two / (1 - 0.99 ** moments["t"])) + 1e-6)).astype(np.float32)


def _flat(p: dict) -> np.ndarray:
    return np.concatenate([p[k].ravel() for k in sorted(p)])


def _shaped(flat: np.ndarray, like: dict) -> dict:
    out, at = {}, 0
    for k in sorted(like):
        out[k] = flat[at : at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Rows of the coded table, together up to HOLD_TOKENS."""
    rows, n = [], 0
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
            row["counts"], row["tokens"] = dictionary.unpack(row.pop("blob"))
            rows.append(row)
            n += len(row["tokens"])
            if n >= HOLD_TOKENS:
                yield rows
                rows, n = [], 0
    if rows:
        yield rows


def _train_round(coded: DataFrame, model: GatedModel, round_: int) -> GatedModel:
    """The average of the tasks' models, weighted by their tokens."""
    sent = coded.sparkSession.sparkContext.broadcast(model.p)
    size = len(_flat(model.p))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, moments, seen = GatedModel(), {}, 0
        own.p = {k: v.copy() for k, v in sent.value.items()}
        for rows in _held(batches):
            picked = [(r, np.array([f == 0 and ((0 if d is None else d) * 2654435761 >> 8) % ROUNDS == round_ for d, f in zip(r["doc_ids"], r["flags"], strict=True)], bool)) for r in rows]
            counts = np.concatenate([r["counts"][x] for r, x in picked]).astype(np.int64)
            tokens = np.concatenate([r["tokens"][np.repeat(x, r["counts"])] for r, x in picked]).astype(np.int64)
            if len(counts):
                tokens[tokens == ONCE] = UNSEEN
                train(own, counts, tokens, moments)
                seen += len(tokens)
        if seen:
            yield pa.RecordBatch.from_pydict({"r": [seen % REDUCERS], "n": [seen], "p": [_flat(own.p).tobytes()]})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(size), 0
        for batch in batches:
            for n, cell in zip(batch.column("n").to_pylist(), batch.column("p"), strict=True):
                total += np.frombuffer(cell.as_py(), np.float32) * float(n)
                seen += n
        if seen:
            yield pa.RecordBatch.from_pydict({"n": [seen], "p": [(total / seen).astype(np.float32).tobytes()]})

    sums = coded.mapInArrow(work, "r long, n long, p binary").repartition(REDUCERS, "r").select("n", "p").mapInArrow(add, "n long, p binary").collect()
    seen = sum(r["n"] for r in sums)
    if seen:
        model.p = _shaped(sum(np.frombuffer(r["p"], np.float32) * (r["n"] / seen) for r in sums), model.p)
    return model


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 7 == 2


def coded_texts(docs: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """CODED: documents as tokens of the network, with what the counts alone say; and the vocabulary."""
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out().cast("int").alias("flag"))
    buckets, tokenizer = dictionary.bucket_count(own), LowerWords()
    words, places = dictionary.both_ways(own, tokenizer, buckets, scratch_path(spark, "words"))
    vocab = vocabulary(words, own.where("flag = 0").count(), buckets)
    sent = spark.sparkContext.broadcast(vocab)

    def values(table: pa.Table) -> Iterator[dict]:
        total, head = _totals(table), sent.value.head
        for chunk, check, bucket, cell in zip(*(table.column(c).to_pylist() for c in ("chunk", "check", "bucket", "words")), strict=True):
            own = dictionary.unpack_words(cell)
            n = np.array([total[w] for w in own], np.int64)
            token = np.array([head.get(w, 0) for w in own], np.uint16)
            # Of the words met once, every second by a hash of the word stands for words never met.
            once = np.flatnonzero((n == 1) & (token == 0))
            token[once] = [ONCE * (zlib.crc32(own[i]) & 1) for i in once.tolist()]
            yield {"chunk": chunk, "check": check, "seq": bucket, "blob": dictionary.pack(n, token)}

    def code(arrays: list[np.ndarray], parts: Iterator[dictionary.Part]) -> Iterator[pa.RecordBatch]:
        v = sent.value
        c, known = arrays if arrays else (np.zeros(0, np.int64), np.zeros(0, np.uint16))
        size, head = bin_of(c), (known > 0) & (known < HEAD)
        token = np.where(known > 0, known, np.where(c > 0, HEAD + size, UNSEEN)).astype(np.uint16)
        tail = np.where(head | (c == 0), 0.0, np.log(np.maximum(1, c) / np.maximum(1, v.tail[size])))
        base = np.log(c + 1.0)
        for p in parts:
            at = np.concatenate([[0], np.cumsum(p.counts)])

            def by_doc(x: np.ndarray, codes=p.codes, at=at) -> np.ndarray:
                total = np.concatenate([[0], np.cumsum(x[codes])])
                return total[at[1:]] - total[at[:-1]]

            # The end of each text follows its words.
            tokens = np.insert(token[p.codes], at[1:], 0)
            yield pa.RecordBatch.from_pydict(
                {"doc_ids": [p.ids], "flags": [p.flags], "n_known": [(by_doc((c > 0).astype(np.int64)) + (v.ends > 0)).tolist()], "log_base": [(by_doc(base) + np.log(v.ends + 1)).tolist()], "log_tail": [by_doc(tail).tolist()], "blob": [dictionary.pack((p.counts + 1).astype(np.uint32), tokens)]},
                schema=pa.schema([("doc_ids", pa.list_(pa.int64())), ("flags", pa.list_(pa.int32())), ("n_known", pa.list_(pa.int64())), ("log_base", pa.list_(pa.float64())), ("log_tail", pa.list_(pa.float64())), ("blob", pa.binary())]),
            )

    path = scratch_path(spark, "coded")
    dictionary.by_chunk(dictionary.by_bucket(words, values, "chunk long, check long, seq long, blob binary", buckets), places, code, CODED, buckets).write.parquet(path)
    return spark.read.parquet(path), vocab


def fit(coded: DataFrame, vocab: Vocabulary) -> GatedModel:
    """A network trained on every training document once, in ROUNDS rounds.

    A round's models are averaged, so its parameters depend on how the rows are dealt among tasks; which
    documents and words count for what does not.
    """
    model = GatedModel(vocab)
    for round_ in range(ROUNDS):
        model = _train_round(coded, model, round_)
    return model


def judged(coded: DataFrame, vocab: Vocabulary, model: GatedModel) -> DataFrame:
    """The counts and both scores of every document, log10."""
    context = coded.sparkSession.sparkContext
    best, sent = context.broadcast(model.p), context.broadcast(vocab)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, own = sent.value, GatedModel()
        own.p = best.value
        log10 = np.log(10)
        for rows in _held(batches):
            counts = np.concatenate([r["counts"] for r in rows]).astype(np.int64)
            tokens = np.concatenate([r["tokens"] for r in rows]).astype(np.int64)
            tokens[tokens == ONCE] = HEAD
            found = score_documents(own, counts, tokens)
            every = {k: [x for r in rows for x in r[k]] for k in ("doc_ids", "flags", "n_known", "log_base", "log_tail")}
            base = (np.array(every["log_base"]) - counts * np.log(v.tokens + v.distinct + 1)) / log10
            yield pa.RecordBatch.from_arrays(
                [pa.array(every["doc_ids"], pa.int64()), pa.array([f == 1 for f in every["flags"]]), pa.array(counts), pa.array(every["n_known"], pa.int64()), pa.array(np.full(len(counts), v.tokens, np.int64)), pa.array(base), pa.array((found + np.array(every["log_tail"])) / log10)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return coded.mapInArrow(judge, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of ``docs``.

    Whole texts are counted and scored, however long; null is an empty text, which is its end alone. A
    null id is a training row. Rows of equal id are rows of their own; other columns are ignored. Scores
    are log10 of a distribution over the V words met in training and one symbol for all others, as the
    base's is. An empty table gives no rows.
    """
    coded, vocab = coded_texts(docs)
    return judged(coded, vocab, fit(coded, vocab))
