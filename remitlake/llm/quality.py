"""Quality by attention over passages (multiple-instance learning).

A text is a bag of passages. Each passage is encoded by how often its bytes' classes follow each
other, a learned layer turns that into a vector, gated attention weighs the passages of a text, and
the weighted vector is scored. Only labels of whole texts are needed to learn the attention.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.words import slices, tidy, utf8, words_of

#: Bytes of a passage.
PASSAGE = 384
#: Labelled texts that are fitted, and passages of them; texts that no longer fit are left out of the fit.
FIT_TEXTS = 6_000
FIT_PASSAGES = 120_000
THRESHOLD = 0.7

_CLASS = np.full(256, 13, np.uint8)  # other punctuation
_CLASS[0x30:0x3A] = 1
_CLASS[0x41:0x5B] = 2
_CLASS[0x61:0x7B] = 3
for _b in b"aeiou":
    _CLASS[_b] = 4
_CLASS[0x80:0xC0] = 5
_CLASS[0xC0:] = 6
_CLASS[0x20] = 0
_CLASS[[9, 10, 13]] = 7
for _c, _bytes in ((8, b".,;:"), (9, b"!?"), (10, b"*#$%&@^~"), (11, b"|<>{}[]/\\=+_"), (12, b"'\"()-")):
    for _b in _bytes:
        _CLASS[_b] = _c
CLASSES = 14
FEATURES = CLASSES * CLASSES + 4


def encode(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of every row, and the offsets of the rows in them.

    An empty text is one passage without bytes. The last passage of a text is as long as is left.
    """
    raw, at = utf8(column)
    size = np.diff(at)
    n = np.maximum(1, -(-size // PASSAGE))
    first = np.concatenate([[0], np.cumsum(n)])
    total = int(first[-1])
    out = np.zeros((total, FEATURES), np.float32)
    if len(raw):
        row = np.repeat(np.arange(len(size)), size)
        passage = first[row] + (np.arange(len(raw)) - at[row]) // PASSAGE
        kind = _CLASS[raw].astype(np.int64)
        pair = (kind[:-1] * CLASSES + kind[1:])[passage[:-1] == passage[1:]]
        pairs = np.bincount(passage[:-1][passage[:-1] == passage[1:]] * (CLASSES * CLASSES) + pair, minlength=total * CLASSES * CLASSES)
        length = np.bincount(passage, minlength=total)
        out[:, : CLASSES * CLASSES] = pairs.reshape(total, -1)
        # How many of the pairs occur, the passage's size, and words that repeat the one before.
        out[:, -3] = (out[:, : CLASSES * CLASSES] > 0).sum(axis=1) / 64
        out[:, : CLASSES * CLASSES] /= np.maximum(1, length)[:, None]
        out[:, : CLASSES * CLASSES] = np.sqrt(out[:, : CLASSES * CLASSES])
        out[:, -2] = length / PASSAGE
        words = words_of(column)
        again = np.flatnonzero(words.hash[1:] == words.hash[:-1]) + 1
        out[:, -4] = np.bincount(passage[words.start[again]], minlength=total) / np.maximum(1, np.bincount(passage[words.start], minlength=total))
    out[:, -1] = np.repeat(np.log1p(size) / 12, n)
    return out, first


class AttentionPool:
    """h = tanh(x E); a = softmax over the text of w(tanh(h V) * sigmoid(h U)); score = sigmoid(c sum a h)."""

    def __init__(self, hidden: int = 24, gate: int = 16, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda a, b: (r.standard_normal((a, b)) / np.sqrt(a)).astype(np.float32)
        self.p = {"E": init(FEATURES, hidden), "e": np.zeros(hidden, np.float32), "V": init(hidden, gate), "U": init(hidden, gate), "w": init(gate, 1)[:, 0], "c": init(hidden, 1)[:, 0], "b": np.zeros(1, np.float32)}

    def _forward(self, x: np.ndarray, at: np.ndarray):
        p, bag = self.p, np.repeat(np.arange(len(at) - 1), np.diff(at))
        h = np.tanh(x @ p["E"] + p["e"])
        v, u = np.tanh(h @ p["V"]), 1 / (1 + np.exp(-(h @ p["U"])))
        s = (v * u) @ p["w"]
        a = np.exp(s - np.maximum.reduceat(s, at[:-1])[bag])
        a /= np.add.reduceat(a, at[:-1])[bag]
        z = np.add.reduceat(a[:, None] * h, at[:-1], axis=0)
        y = 1 / (1 + np.exp(-np.clip(z @ p["c"] + p["b"], -30, 30)))
        return y, (h, v, u, a, z, bag)

    def score(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._forward(x, at)[0]

    def attention(self, x: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self._forward(x, at)[1][3]

    def gradients(self, x: np.ndarray, at: np.ndarray, label: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        y, (h, v, u, a, z, bag) = self._forward(x, at)
        d = ((y - label) / len(label)).astype(np.float32)
        dz = d[:, None] * p["c"]
        da = (dz[bag] * h).sum(axis=1)
        ds = a * (da - np.add.reduceat(a * da, at[:-1])[bag])
        dv = ds[:, None] * p["w"] * u * (1 - v * v)
        du = ds[:, None] * p["w"] * v * u * (1 - u)
        dh = (a[:, None] * dz[bag] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
        return {"E": x.T @ dh, "e": dh.sum(axis=0), "V": h.T @ dv, "U": h.T @ du, "w": (v * u).T @ ds, "c": z.T @ d, "b": d.sum(keepdims=True)}

    def fit(self, x: np.ndarray, at: np.ndarray, label: np.ndarray, epochs: int = 20, batch: int = 64, rate: float = 4e-3, seed: int = 3) -> None:
        """Adam over shuffled texts; the step falls to a tenth over the epochs, of which few texts get more."""
        r, m, t = np.random.default_rng(seed), {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}, 0
        epochs = min(200, max(epochs, 1_500 * batch // max(1, len(label))))
        steps = max(1, epochs * -(-len(label) // batch))
        for _ in range(epochs):
            order = r.permutation(len(label))
            for k in range(0, len(order), batch):
                own = order[k : k + batch]
                rows = np.concatenate([np.arange(at[i], at[i + 1]) for i in own])
                cut = np.concatenate([[0], np.cumsum(at[own + 1] - at[own])])
                t += 1
                step = rate * (1 - 0.9 * t / steps)
                for name, g in self.gradients(x[rows], cut, label[own]).items():
                    one, two = m[name]
                    one += 0.1 * (g - one)
                    two += 0.01 * (g * g - two)
                    self.p[name] -= (step * (one / (1 - 0.9**t)) / (np.sqrt(two / (1 - 0.99**t)) + 1e-7) + step * 1e-3 * self.p[name]).astype(np.float32)


def held_out(doc_id: str = "doc_id"):
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 4 == 2


def fit_quality(docs: DataFrame, labels: DataFrame) -> AttentionPool | None:
    """A model from a bounded sample of the labelled texts that are not held out; None without labels.

    The sample is the FIT_TEXTS labels with the smallest hash of their id, fewer if their passages are
    more than FIT_PASSAGES; an id with more than a tenth of those is left out. An id labelled twice
    counts once, with the smaller label. The choice is made from sizes alone, a row per id of the
    sample. Passages are encoded in the tasks; the driver gets numbers of a bounded size and no text.
    """
    usable = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").where(~held_out())
    sample = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    sample = sample.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_TEXTS)
    text = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # At most FIT_TEXTS narrow rows are broadcast, twice, and as many are sized up in one task.
    size = F.ceil(F.octet_length(F.coalesce("text", F.lit(""))) / F.lit(PASSAGE)) + 1
    sizes = text.join(F.broadcast(sample), "doc_id").groupBy("doc_id", "quality").agg(F.sum(size).alias("size"))
    order = Window.orderBy(F.xxhash64("doc_id"), "doc_id")
    fit = sizes.where(F.col("size") <= FIT_PASSAGES // 10).withColumn("_sum", F.sum("size").over(order))
    rows = text.join(F.broadcast(fit.where(F.col("_sum") <= FIT_PASSAGES).select("doc_id", "quality")), "doc_id")

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                x, at = encode(part.column("text"))
                cells = [np.ascontiguousarray(x[a:b], np.float16).tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("quality"), pa.array(cells, pa.binary())], names=["doc_id", "quality", "x"])

    encoded = rows.select("doc_id", F.col("quality").cast("int").alias("quality"), "text").mapInArrow(tidy(features), "doc_id long, quality int, x binary")
    got = sorted(encoded.collect(), key=lambda r: (r["doc_id"], r["x"]))
    if not got:
        return None
    bags = [np.frombuffer(r["x"], np.float16).reshape(-1, FEATURES).astype(np.float32) for r in got]
    model = AttentionPool()
    model.fit(np.concatenate(bags), np.concatenate([[0], np.cumsum([len(b) for b in bags])]), np.array([r["quality"] for r in got], np.float32))
    return model


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``; label 1 is likelier at 1.

    Whole texts are scored, null as empty. Without usable labels every score is 0.5. A null id is not
    held out. Nothing but the text enters a score. One scan, no shuffle of texts.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    model = fit_quality(docs, labels)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                y = np.full(part.num_rows, 0.5)
                if sent.value is not None:
                    y = sent.value.score(*encode(part.column("text"))).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("held_out"), pa.array(y), pa.array((y >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    return own.mapInArrow(tidy(score), "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns. Texts are scored in place."""
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                if model.value is None:
                    yield part
                else:
                    yield part.filter(pa.array(model.value.score(*encode(part.column("text"))).astype(np.float64) >= THRESHOLD))

    return docs.mapInArrow(tidy(keep), docs.schema)
