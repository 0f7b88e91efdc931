"""Lexical search, source divergence and chat formatting against brute force and SQL."""

import hashlib
import json
import math
import random
import re
from collections import Counter

import compare
import pytest
from pyspark.sql import functions as F

from remitlake.llm import chat_format, divergence, lexical_search, queries
from remitlake.llm.bags import terms, translate_table

SEARCH = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LETTERS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Other columns have the names that the operators use inside.
EXTRA = ["n", "vec", "m", "h", "nth", "term", "docs", "own", "p", "q", "zero", "low", "rank", "score", "layout", "turns", "record", "formatted"]


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def documents(spark, rows):
    ddl = ", ".join(["doc_id long", "text string", "lang string", "source string", *(f"{c} string" for c in EXTRA)])
    return spark.createDataFrame([(*r, *("x" for _ in EXTRA)) for r in rows], ddl)


def odd_texts():
    r = random.Random(5)
    words = ["the", "River", "straße", "ÄB", "x1", "12", "a-b", "ÉT", "don't", "\x00q", "日本", "z" * 30]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows = [(i, text(r.randint(0, 40)), r.choice(["en", "de"]), r.choice(["s1", "s2", "s3"])) for i in range(60)]
    rows += [(100 + i, rows[3][1], "en", "s1") for i in range(15)]
    rows += [(200, None, None, None), (201, "", "en", "s9"), (202, "1 2 --", "", "s1"), (None, rows[3][1], "en", "s1"), (None, None, None, "s1")]
    rows += [(203, text(40_000), "en", "s2"), (100, rows[5][1], "de", "s4"), (100, rows[5][1], "de", "s4")]
    return rows


@pytest.mark.parametrize("digits, pattern", [(True, SEARCH), (False, LETTERS)])
def test_terms_in_pieces(digits, pattern):
    table = translate_table(digits)
    for _, text, *_ in [*odd_texts(), (0, "".join(map(chr, range(1, 700))), "", "")]:
        want = [w.translate(UPPER).encode() for w in pattern.findall(text or "")]
        for most in (1, 7, 1 << 20):
            assert [w for some in terms(text and text.encode(), table, most) for w in some] == want


def brute_search(rows, items, k):
    bags = [(i, Counter(w.translate(UPPER) for w in SEARCH.findall(t or ""))) for i, t, *_ in rows]
    n_docs, n_terms = sum(bool(b) for _, b in bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(w.translate(UPPER) for w in SEARCH.findall(text or ""))
    out = []
    for item, want in asked.items():
        found = []
        for doc, bag in bags:
            m = 25 + (75 * sum(bag.values()) * n_docs) // max(1, n_terms)
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * bag[t] // (1000 * bag[t] + 8 * m)) for t, c in want.items() if bag[t])
            found += [(-score, doc is None, doc or 0, doc)] if score > 0 else []
        out += [(item, rank + 1, f[3], -f[0]) for rank, f in enumerate(sorted(found, key=lambda f: f[:3])[:k])]
    return out


def test_search(spark):
    rows = odd_texts()
    items = [(1, "the river x1 x1"), (2, rows[3][1]), (2, "ÄB 日本"), (3, None), (4, "-- \x00"), (5, "unknown words"), (None, "straße"), (6, rows[7][1] * 30)]
    frame = spark.createDataFrame([(*i, "y") for i in items], "item_id long, text string, rank string")
    docs = documents(spark, rows).repartition(3)
    for k in (1, 10, 1000):
        got = [(x.item_id, x["rank"], x.doc_id, x.score) for x in lexical_search.search(docs, frame, k).collect()]
        same(got, brute_search(rows, items, k))
    small = lexical_search.Limits(block_pairs=5, cells=4, held=3)
    got = [(x.item_id, x["rank"], x.doc_id, x.score) for x in lexical_search.search(docs, frame, 10, small).collect()]
    same(got, brute_search(rows, items, 10))
    assert lexical_search.search(docs, frame.limit(0)).count() == 0
    assert lexical_search.search(docs.limit(0), frame).count() == 0


def test_classes_are_scored_once(spark, tmp_path):
    """Equal bags are one class, whatever else the texts hold."""
    rows = [(i, f"alpha beta noise{i % 3}", "en", "s") for i in range(50)] + [(99, "beta alpha noise0", "en", "s")]
    number = {b"alpha": 0, b"beta": 1}
    assert lexical_search.bags(documents(spark, rows), number).select("vec", "n").distinct().count() == 1


def brute_divergence(rows, least, most):
    clean = [(x[2] or "", x[3] or "", Counter(w.translate(UPPER) for w in LETTERS.findall(x[1] or ""))) for x in rows]
    groups, out = sorted({c[:2] for c in clean}), []
    apart = lambda p, q: (p - q) * (p - q) // (p + q)
    for lang in {g[0] for g in groups}:
        held = Counter(t for x, _, b in clean if x == lang for t in b)
        kept = [t for t, n in held.items() if n >= least]
        sources = [s for x, s in groups if x == lang]
        count = {s: Counter() for s in [*sources, None]}
        for x, s, b in clean:
            for t in kept if x == lang else ():
                count[s][t] += b[t]
                count[None][t] += b[t]
        share = lambda s, t: 1 + 1_000_000_000 * (count[s][t] + 2) // (sum(count[s].values()) + 2 * len(kept))  # noqa: E731, B023
        for s in sources:
            pairs = [(-sum(apart(share(s, t), share(o, t)) for t in kept), o.encode(), o) for o in sources if o != s]
            words = [(-apart(share(s, t), share(None, t)), t.encode(), t) for t in kept if count[s][t] and share(s, t) > share(None, t)]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(words)[:most])):
                out += [(lang, s, part, f[2], -f[0], r + 1) for r, f in enumerate(found)]
    return out


@pytest.mark.parametrize("limits", [divergence.Limits(), divergence.Limits(held_terms=4, sources=2, bucket_rows=3, cells=2)])
def test_divergence(spark, limits):
    rows = odd_texts() + [(300 + i, "only here", "xx", f"t{i % 5}") for i in range(9)]
    docs = documents(spark, rows).repartition(3)
    got = [(x.lang, x.source, x.part, x.item, x.value, x["rank"]) for x in divergence.audit(docs, limits=limits).collect()]
    same(got, brute_divergence(rows, 10, 10))
    got = [(x.lang, x.source, x.part, x.item, x.value, x["rank"]) for x in divergence.audit(docs, 1, 3, limits).collect()]
    same(got, brute_divergence(rows, 1, 3))
    assert divergence.audit(docs.limit(0)).count() == 0


def test_shares_beyond_64_bits(spark):
    big = 10**12
    row = spark.createDataFrame([(big, 3 * big, 5)], "n long, total long, terms long")
    assert row.select(divergence._share("n", "total").alias("p")).head().p == 1 + 1_000_000_000 * (big + 2) // (3 * big + 10)


RECORDS = [
    ({"prompt": "a", "completion": "b"}, "prompt", [("user", "a"), ("assistant", "b")]),
    ({"system": "s", "prompt": "[1, 2]", "response": "b", "id": 4}, "response", [("system", "s"), ("user", "[1, 2]"), ("assistant", "b")]),
    ({"instruction": "i", "input": "", "output": "o"}, "instruction", [("user", "i"), ("assistant", "o")]),
    ({"instruction": "i", "input": "more", "output": "o"}, "instruction", [("user", "i\n\nmore"), ("assistant", "o")]),
    ({"question": 12, "answer": None}, "question", [("user", "12"), ("assistant", "")]),
    ({"messages": [{"role": "tool", "content": "x"}, {"role": None, "content": None}]}, "messages", [("tool", "x"), ("", "")]),
    ({"messages": [{"role": "user"}, {"content": "c"}]}, "messages", [("user", ""), ("", "c")]),
    ({"messages": [], "system": "s"}, "messages", [("system", "s")]),
    ({"conversations": [{"from": "human", "value": "h"}, {"from": "gpt", "value": "g"}]}, "conversations", [("user", "h"), ("assistant", "g")]),
    ({"dialog": {"turns": [{"speaker": {"role": "user"}, "text": "t"}]}}, "dialog", [("user", "t")]),
    ({"unknown": "x"}, None, None),
    ({"prompt": {"text": "x"}, "completion": "b"}, None, None),
    ({}, None, None),
]


def test_layouts(spark):
    rows = [(i, json.dumps(r), "was") for i, (r, *_) in enumerate(RECORDS)] + [(90, "no json", "was"), (91, None, "was"), (92, "[1]", "was")]
    found = chat_format.chat_turns(spark.createDataFrame(rows, "id long, record string, layout string"))
    got = {x.id: (x.layout, x.turns and [tuple(t) for t in x.turns]) for x in found.collect()}
    want = {i: tuple(r[1:]) for i, r in enumerate(RECORDS)} | {i: (None, None) for i in (90, 91, 92)}
    assert {i: (a, b if b is None else list(b)) for i, (a, b) in got.items()} == want
    formatted = chat_format.format_turns(found).select("id", chat_format.read_turns(F.col("formatted")).alias("back"))
    assert {x.id: x.back and [tuple(t) for t in x.back] for x in formatted.collect()} == {i: t or t for i, (_, t) in want.items()}


def test_layouts_do_not_share_a_tree():
    every = [t for layout in chat_format.LAYOUTS for t in chat_format.trees(layout)]
    assert len(every) == len(set(every))


def hostile(r):
    parts = [*chat_format.CONTROL, "\\", "<", "[", ">", "]", "/", "s>", "INST]", "a", "\n", "é", "😀", "$1", '"', "\x00", "<\\/s>", "[\\\\INST]"]
    return "".join(r.choice(parts) for _ in range(r.randint(0, 12)))


def test_round_trip(spark):
    r = random.Random(6)
    chats = [[(r.choice(["user", "assistant", "system", "tool", hostile(r)]), hostile(r)) for _ in range(r.randint(0, 6))] for _ in range(400)]
    chats += [[("user", "x" * 300_000 + "</s>"), ("assistant", "[" + "\\" * 50_000 + "INST]")], [("assistant", "t")] * 2000]
    frame = spark.createDataFrame([(i, c) for i, c in enumerate(chats)], f"id long, turns {chat_format.TURNS}")
    out = chat_format.format_turns(frame)
    read = out.select("id", "formatted", "loss_runs", chat_format.read_turns(F.col("formatted")).alias("back"), chat_format.masked_texts(F.col("formatted"), F.col("loss_runs")).alias("said"))
    for x in read.collect():
        turns = chats[x.id]
        assert [tuple(t) for t in x.back] == turns
        assert x.said == [t for role, t in turns if role == "assistant" and t]
        assert sum(sum(run) for run in x.loss_runs) == len(x.formatted)
        marks = re.findall("|".join(map(re.escape, chat_format.CONTROL)), x.formatted)
        assert len(marks) == sum(2 if role in chat_format.MARKS else 3 for role, _ in turns)


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 1, "assistant", None), (2, 0, "tool", "</s>"), (3, None, None, None)]
    rows += [(4, 0, "system", "s"), (4, 1, "user", "u"), (4, 2, "assistant", "a"), (5, 0, "user", "b"), (5, 0, "user", "a"), (5, 0, "user", "a")]
    rows += [(None, 0, "user", ""), (6, 0, "assistant", "x" * 100_000), (7, 0, "human", "role of another layout")]
    frame = spark.createDataFrame([(*x, "z", "w") for x in rows], "conv_id long, turn long, role string, text string, record string, layout string")
    out = {x.conv_id: x for x in chat_format.digests(chat_format.format_conversations(chat_format.with_added(frame))).collect()}
    rows += [(-1, 0, "user", chat_format.ADDED_TEXT), (-1, 1, "assistant", chat_format.ADDED_TEXT)]
    assert set(out) == {x[0] for x in rows}
    for conv, x in out.items():
        own = sorted(((t is not None, t or 0, role or "", text or "") for c, t, role, text in rows if c == conv))
        said = "".join(f"{role}\n{text}\n" for *_, role, text in own)
        learned = "".join(text for *_, role, text in own if role == "assistant")
        assert (x.n_turns, x.turns_sha256) == (len(own), hashlib.sha256(said.encode()).hexdigest())
        assert (x.loss_chars, x.loss_sha256) == (len(learned), hashlib.sha256(learned.encode()).hexdigest())
    assert [out[i].layout for i in (1, 2, 4, 5, 7)] == ["prompt", "messages", "instruction", "conversations", "messages"]
    assert chat_format.digests(chat_format.format_conversations(chat_format.with_added(frame.limit(0)))).count() == 1


def test_no_python_worker(spark, sf_dir):
    plan = queries.op13_chat_format(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", ["op11_lexical_search", "op12_source_divergence", "op13_chat_format"])
def test_sql(spark, sf_dir, name):
    columns, rows = compare.spark_side(queries.QUERIES[name](spark, sf_dir))
    want_columns, want = compare.duck_side(compare.connect(sf_dir), queries.SQL[name])
    assert columns == want_columns and rows == want
