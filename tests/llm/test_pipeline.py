"""The corpus pipeline stage by stage against brute force."""

import random
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import regex
from test_llm import brute_links

import corpus_pipeline
from remitlake.llm import byte_bpe, dictionary, words
from remitlake.llm.queries import BYTE_PATTERN

RANKS = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
DDL = "doc_id long, text string, lang string, source string, n_chars long, row string, _own string, sid string"


def corpus():
    """300 rows: good and bad texts, copies, near copies, leaks, nulls, repeated ids and rows."""
    r = random.Random(77)
    good = [f"the {w} river slowly" for w in ("blue", "wide", "old", "long", "cold")]
    fine = lambda n: " ".join(f"{r.choice(good)} g{r.randint(0, 4000)}" for _ in range(n))
    junk = lambda n: " ".join(r.choice(["BUY!!", "NOW!!", "***", "|", "$$$"]) for _ in range(n))
    items = [(i, " ".join(f"k{r.randint(0, 900)}" for _ in range(30))) for i in range(5)]
    rows, labels = [], []
    for i in range(200):
        bad = i % 3 == 2
        rows.append((i, junk(60) if bad else fine(15)))
        labels.append((i, int(not bad), 0))
    keep = [x for x in rows if x[0] % 3 != 2]
    rows += [(300 + k, keep[k][1].replace(" ", "\n")) for k in range(20)]
    rows += [(400 + k, keep[30 + k][1] + f" more{k}") for k in range(20)]
    rows += [(500 + k, f"{fine(12)} {items[k % 5][1]} {fine(12)}") for k in range(20)]
    rows += [(1, keep[1][1]), (1, keep[2][1]), (None, keep[3][1]), (None, fine(15)), (None, None), (700, None), (701, ""), (702, "  ")]
    rows += [(800 + k, fine(10)) for k in range(300 - len(rows))]
    return rows, labels, items


def write(spark, folder, rows, labels, items):
    tables = {
        "documents": spark.createDataFrame([(i, t, "en", "s", 1, f"r{n % 3}", "o", "s") for n, (i, t) in enumerate(rows)], DDL),
        "labels": spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
        "benchmark": spark.createDataFrame(items, "item_id long, text string"),
    }
    for name, df in tables.items():
        df.repartition(3).write.parquet(f"{folder}/{name}.parquet")
    return tables


def normal(text):
    return regex.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def order(doc_id):
    return (doc_id is None, doc_id or 0)


def test_pipeline(spark, tmp_path):
    rows, labels, items = corpus()
    tables = write(spark, str(tmp_path), rows, labels, items)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality classifier", "exact dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]

    docs = tables["documents"]
    kept = stages["quality classifier"](spark, docs, str(tmp_path))
    assert kept.columns == docs.columns
    first = sorted(((x.doc_id, x.text) for x in kept.collect()), key=str)
    good = {i for i, q, _ in labels if q}
    held = [i for i, *_ in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    assert {i for i, t in first if i in set(held)} >= {i for i in held if i in good} and not any("BUY!!" in (t or "") for _, t in first)

    want = {}
    for i, t in first:
        key = normal(t)
        want[key] = min(want.get(key, (i, t)), (i, t), key=lambda x: (order(x[0]), x[1] or ""))
    second = sorted(want.values(), key=str)
    got = stages["exact dedup"](spark, kept, str(tmp_path))
    assert got.columns == docs.columns
    assert sorted(((x.doc_id, normal(x.text)) for x in got.collect()), key=str) == sorted(((i, normal(t)) for i, t in second), key=str)

    links = brute_links(second)
    label = list(range(len(second)))
    for _ in second:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(second))]
    classes = {}
    for n, x in enumerate(second):
        if not normal(x[1]).strip():
            classes[f"alone {n}"] = x
            continue
        classes[label[n]] = min(classes.get(label[n], x), x, key=lambda y: order(y[0]))
    third = list(classes.values())
    fourth = [x for x in third if not any(t in (x[1] or "") for _, t in items)]
    assert len(first) > len(second) > len(third) > len(fourth) > 50

    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    want = sorted((str(i), *byte_bpe.brute_force(t, RANKS, public_tokenizers.PATTERN)) for i, t in fourth)
    assert sorted((str(x.doc_id), x.n_tokens, x.ids_sha256, x.decoded_sha256) for x in out) == want


@pytest.mark.parametrize("rows", [[], [(None, None)], [(1, ""), (1, "")]])
def test_pipeline_of_next_to_nothing(spark, tmp_path, rows):
    write(spark, str(tmp_path), rows, [(9, 1, 0)], [(1, "a b c d e f")])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() <= min(1, len(rows))


def test_workers_keep_no_freed_memory(monkeypatch):
    calls = []
    monkeypatch.setattr(words, "give_back", lambda: calls.append(1))
    assert list(words.tidy(lambda it: (x + 1 for x in it))(iter([1, 2]))) == [2, 3] and calls == [1]
    # What a chunk is made of is gone when the chunk is handed over.
    monkeypatch.setattr(dictionary, "CHUNK_BYTES", 10)
    texts = ["some words here", "and more words here", "ends"]
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t, "flag": 0} for i, t in enumerate(texts)])
    for tokenizer, held in ((byte_bpe.Pieces(BYTE_PATTERN), "places"), (dictionary.PlainWords(), "held")):
        chunks = dictionary._chunks(iter([batch.slice(i, 1) for i in range(3)]), tokenizer, 2)
        first = next(chunks)
        owner = chunks.gi_yieldfrom or chunks
        assert first.ids == [0] and owner.gi_frame.f_locals[held] == []
        assert [c.ids for c in chunks] == [[1], [2]]
