"""The operators against brute force, and the rows that ask for a defined result."""

import datetime as dt
import hashlib
import json
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from remitlake.llm import byte_bpe, decontaminate, dictionary, exact_dedup, language_model, pii, quality
from remitlake.llm import similarity_join, substring_dedup, token_counts, warc
from remitlake.llm.graph import components
from remitlake.llm.words import sequences, shingles, words_of

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n long, size int, path string, label string"


def make(spark, rows):
    """Documents with columns that operators use as names of their own."""
    return spark.createDataFrame([(i, t, "en", "s", 1, 2, 3, "p", "x") for i, t in rows], DOCS)


def odd_rows():
    r = random.Random(4)
    words = ["the", "of", "and", "straße", "a.b", "12", "x", "q" * 30]
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    base = text(80)
    rows = [(i, text(r.randint(0, 60))) for i in range(1, 40)]
    rows += [(50, base), (51, base.replace(" ", "\n")), (51, base), (51, base), (52, base + " more words"), (53, text(30_000))]
    rows += [(60, None), (61, ""), (62, "   "), (None, base), (None, None), (63, "z" * 20_000)]
    return rows


@pytest.fixture(scope="module")
def odd(spark):
    return make(spark, odd_rows()).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return make(spark, [])


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def test_shingles_of_short_and_long_rows():
    column = pa.array(["a b c d e f", "", None, "x y", "a b c d e"])
    found, at = shingles(words_of(column))
    assert np.diff(at).tolist() == [2, 0, 0, 1, 1]
    assert found[0] == found[at[4]]


def test_quality_learns_and_scores_everything(spark, odd, empty):
    r = random.Random(1)
    good = lambda: " ".join(r.choice(["the", "river", "runs", "down", "slowly"]) for _ in range(60))
    bad = lambda: " ".join(r.choice(["BUY!!", "NOW!!", "***", "|"]) for _ in range(60))
    rows = [(i, good() if i % 2 else bad()) for i in range(200)]
    docs = make(spark, rows)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(200)] + [(None, 1, 0), (1, None, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    out = quality.score_quality(docs, labels).collect()
    assert all(x.predicted == x.doc_id % 2 for x in out if x.held_out) and any(x.held_out for x in out)
    assert all(x.held_out == (zlib.crc32(str(x.doc_id).encode()) % 4 == 2) for x in out)
    assert quality.score_quality(odd, labels).count() == odd.count()
    assert {x.score for x in quality.score_quality(odd, labels.limit(0)).collect()} == {0.5}
    assert quality.score_quality(empty, labels).count() == 0
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {x.doc_id % 2 for x in kept.collect()} == {1}


def test_attention_gradients():
    r = np.random.default_rng(0)
    model, x, at = quality.AttentionPool(), r.random((9, quality.FEATURES)).astype(np.float32), np.array([0, 4, 9])
    label = np.array([1.0, 0.0], np.float32)

    def loss():
        y = model.score(x, at)
        return -np.mean(label * np.log(y) + (1 - label) * np.log(1 - y))

    for name, g in model.gradients(x, at, label).items():
        i = np.unravel_index(np.abs(g).argmax(), g.shape)
        model.p[name][i] += 1e-2
        up = loss()
        model.p[name][i] -= 2e-2
        assert (up - loss()) / 2e-2 == pytest.approx(g[i], rel=0.05, abs=1e-4)
        model.p[name][i] += 1e-2


def test_exact_dedup(odd, empty):
    rows = odd_rows()
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    ids, size, seen, want = {}, Counter(norm(t) for _, t in rows), set(), []
    for i, t in rows:
        if i is not None:
            ids[norm(t)] = min(i, ids.get(norm(t), i))
    for i, t in rows:
        keep = ids.get(norm(t))
        first = i == keep and (i, norm(t)) not in seen
        seen.add((i, norm(t)))
        want.append((i, keep, size[norm(t)], first, hashlib.sha256(norm(t).encode()).hexdigest()))
    same([tuple(x) for x in exact_dedup.exact_dedup(odd).collect()], want)
    kept = exact_dedup.keep_first(odd)
    assert kept.columns == odd.columns and kept.count() == sum(w[3] for w in want)
    assert exact_dedup.exact_dedup(empty).count() == 0


def test_cuckoo_index_inserts_deletes_and_grows():
    index = exact_dedup.CuckooIndex(8)
    keys = [hashlib.sha256(str(i).encode()).digest() for i in range(5_000)]
    for i, k in enumerate(keys):
        assert index.find(k, 1) is None
        index.insert(k, 1, [i, 1])
    assert index.resizes > 0 and all(index.find(k, 1)[0] == i for i, k in enumerate(keys))
    assert all(index.delete(k, 1) for k in keys[::2]) and not index.delete(keys[0], 1)
    assert all((index.find(k, 1) is None) == (i % 2 == 0) for i, k in enumerate(keys))
    forged = keys[1][:18] + bytes(14)
    assert index.maybe(forged) and index.find(forged, 1) is None


def brute_links(rows):
    sets = []
    for _, t in rows:
        w = (t or "").encode().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return [[j for j, b in enumerate(sets) if j != i and a and 5 * len(a & b) >= 4 * len(a | b)] for i, a in enumerate(sets)]


def regular_word(n, one="a", two="b"):
    """A Thue-Morse word: sums of powers of any odd base agree on it and on its mirror, modulo 2^64."""
    word = one
    while len(word) < n:
        word += word.translate(str.maketrans(one + two, two + one))
    return word


@pytest.mark.parametrize("n", [16, 64, 128, 1024, 4096])
def test_regular_words_differ(spark, n):
    word = regular_word(n)
    mirror = word.translate(str.maketrans("ab", "ba"))
    assert len(set(words_of(pa.array([word + " " + mirror])).hash.tolist())) == 2
    if n != 1024:
        return
    head = " ".join(f"h{i}" for i in range(49))
    texts = [(1, f"{head} {word}"), (2, f"{head} {mirror}"), (3, word), (4, mirror)]
    docs = make(spark, texts)
    got = [(x.doc_id, x.n_removed) for x in substring_dedup.drop_repeats(docs).collect()]
    same(got, [(1, 0), (2, 0), (3, 0), (4, 0)])
    links = {x.doc_id: x.n_links for x in similarity_join.near_duplicates(docs).collect()}
    assert links[3] == links[4] == 0
    items = spark.createDataFrame([(7, " ".join([word] * 8))], "item_id long, text string")
    assert decontaminate.drop_contaminated(make(spark, [(1, " ".join([mirror] * 8))]), items).count() == 1


def test_regular_windows_differ():
    r = np.random.default_rng(3)
    pair = r.integers(0, 2**63, 2, dtype=np.uint64)
    one = np.array([int(c == "b") for c in regular_word(64)])
    found = [sequences(pair[x[:50]], 50)[0] for x in (one, 1 - one)]
    assert found[0] != found[1]


def clashing(spark, rows):
    """Documents whose other columns have the names that operators use inside."""
    names = ["_own", "_n", "_id", "_th", "_key", "_sha", "row", "own", "nth", "sid", "label", "known", "th", "key"]
    ddl = ", ".join(["doc_id long", "text string", *(f"{n} string" for n in names)])
    return spark.createDataFrame([(i, t, *(f"{n}-{tag}" for n in names)) for i, t, tag in rows], ddl)


@pytest.mark.parametrize("keep", [exact_dedup.keep_first, similarity_join.keep_one_of_each_class])
def test_stages_keep_columns_of_any_name(spark, keep):
    a, b = (" ".join(f"{c}{i}" for i in range(40)) for c in "ab")
    rows = [(1, a, "z"), (1, a, "y"), (2, a, "x"), (3, b, "x"), (None, b, "x"), (None, None, "q")]
    docs = clashing(spark, rows)
    kept = keep(docs)
    assert kept.columns == docs.columns
    want = [(1, a, "y"), (3, b, "x"), (None, None, "q")]
    same([tuple(x) for x in kept.collect()], [tuple(x) for x in clashing(spark, want).collect()])
    assert keep(docs.limit(0)).count() == 0


def test_similarity_join(spark, odd, empty):
    r = random.Random(9)
    rows = odd_rows()
    for k in range(12):
        text = [f"w{r.randint(0, 500)}" for _ in range(120)]
        for c in range(r.randint(1, 5)):
            edit = list(text)
            for _ in range(c):
                edit[r.randint(0, 119)] = f"e{r.randint(0, 500)}"
            rows.append((1000 + 10 * k + c, " ".join(edit)))
    links = brute_links(rows)
    label = list(range(len(rows)))
    for _ in rows:
        label = [min([label[i], *(label[j] for j in links[i])]) for i in range(len(rows))]
    named = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            named[label[i]] = min(d, named.get(label[i], d))
    want = [(d, named.get(label[i]), len(links[i])) for i, (d, _) in enumerate(rows)]
    docs = make(spark, rows)
    same([tuple(x) for x in similarity_join.near_duplicates(docs).collect()], want)
    kept = similarity_join.keep_one_of_each_class(docs.where("doc_id >= 1000"))
    assert kept.columns == docs.columns and kept.count() == len({w[1] for w in want if w[0] and w[0] >= 1000})
    assert similarity_join.near_duplicates(empty).count() == 0


def test_one_row_of_each_class_stays(spark):
    texts = [" ".join(f"t{k}x{i}" for i in range(60)) for k in range(6)]
    near = texts[1] + " more"
    rows = [(1, texts[0]), (1, texts[1]), (1, texts[2]), (1, texts[2]), (2, near), (3, texts[3]), (None, texts[3] + " more")]
    rows += [(None, texts[4]), (None, texts[4] + " more"), (None, texts[5]), (None, None), (None, ""), (4, ""), (4, "  ")]
    kept = [(x.doc_id, x.text) for x in similarity_join.keep_one_of_each_class(make(spark, rows)).collect()]
    four = [k for k in kept if k[1] and k[1].startswith("t4")]
    assert len(four) == 1 and four[0] in rows
    same([k for k in kept if k not in four], [(1, texts[0]), (1, texts[1]), (1, texts[2]), (3, texts[3]), (None, texts[5]), (None, None), (None, ""), (4, ""), (4, "  ")])


def test_contracted_links_keep_components(spark):
    r = random.Random(4)
    links = [(a, b) for a in range(2, 120) for b in r.sample(range(a), min(a, r.choice([0, 1, 1, 2]))) if a % 9 == b % 9 or a == b]
    links += [(a, a) for a in range(0, 120, 7)] + [(200 + i, b) for i in range(40) for b in (130, 131, 132)]
    frame = spark.createDataFrame(links, "a long, b long")
    few = similarity_join.contracted(frame)
    assert few.count() < len(set(links)) and few.where("b > a").isEmpty()
    named = lambda x: sorted((y.node, y.label) for y in components(x).collect())
    assert named(few) == named(frame)


def test_large_nodes_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(similarity_join, "LEAF", 8)
    monkeypatch.setattr(similarity_join, "BLOCK", 16)
    r = random.Random(2)
    text = [f"w{i}" for i in range(200)]
    rows = [(i, " ".join([*text[:100], f"own{i}", *text[101 + r.randint(0, 3) :]])) for i in range(60)]
    rows += [(100 + i, f"alone {i} " + " ".join(f"z{i}{k}" for k in range(30))) for i in range(20)]
    want = [(d, 0 if d < 60 else d, len(x)) for (d, _), x in zip(rows, brute_links(rows), strict=True)]
    same([tuple(x) for x in similarity_join.near_duplicates(make(spark, rows)).collect()], want)


def greedy(word, pieces):
    text, n, first = b" " + word, 0, True
    while text:
        k = next((k for k in range(len(text), 0, -1) if text[:k] in pieces and (first or text[:1] != b" ")), None)
        if k is None:
            return None
        text, n, first = text[k:], n + 1, False
    return n


def test_token_counts(odd, empty):
    r = random.Random(3)
    pieces = [b" a", b" ab", b" abc", b"b", b"bc", b"c", b"ca", b"cab", b"bb", b" "]
    automaton = token_counts.PieceAutomaton(pieces)
    for _ in range(3000):
        word = bytes(r.choice(b"abcd") for _ in range(r.randint(1, 12)))
        assert automaton.length(word) == greedy(word, set(pieces)), word
    ranks = set(token_counts.read_ranks(RANKS))
    want = [(i, len(w := (t or "").encode().split()), sum(greedy(x, ranks) for x in w)) for i, t in odd_rows() if len(t or "") < 15_000]
    got = [tuple(x) for x in token_counts.token_counts(odd.where("coalesce(length(text), 0) < 15000"), RANKS).collect()]
    same(got, want)
    assert token_counts.token_counts(empty, RANKS).count() == 0


def test_substring_dedup(spark, odd, empty):
    r = random.Random(6)
    base = [" ".join(r.choice("a a b c d e f".split()) for _ in range(r.choice([60, 150]))) for _ in range(12)]
    rows = odd_rows() + [(100 + i, " ".join(r.choice([r.choice(base), "a " * r.randint(1, 90), "x y " * 30, r.choice(base)[: r.randint(9, 300)]]) for _ in range(r.randint(1, 4)))) for i in range(80)]
    same([tuple(x) for x in substring_dedup.digests(substring_dedup.drop_repeats(make(spark, rows))).collect()], substring_dedup.brute_force(rows))
    assert substring_dedup.drop_repeats(empty).count() == 0


def test_repeated_rows_are_folded_before_chunks_and_come_back(spark, monkeypatch):
    monkeypatch.setattr(substring_dedup, "COPIES", 4)
    base = " ".join(f"w{i}" for i in range(70))
    rows = [(1, base)] + [(2, base)] * 9 + [(None, base)] * 8 + [(None, None)] * 3 + [(2, "other")] * 2 + [(3, "")]
    same([tuple(x) for x in substring_dedup.folded(make(spark, rows).select("doc_id", "text")).collect()], [(*k, n) for k, n in Counter(rows).items()])
    same([tuple(x) for x in substring_dedup.digests(substring_dedup.drop_repeats(make(spark, rows))).collect()], substring_dedup.brute_force(rows))


def test_language_model(odd, empty):
    rows = odd_rows()
    low = lambda t: (t or "").encode().lower().split() + [None]
    trained = Counter(w for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for w in low(t))
    total, distinct = sum(trained.values()), len(trained)
    got = sorted(language_model.score(odd).collect(), key=str)
    want = sorted([(i, len(low(t)), sum(trained[w] > 0 for w in low(t)), total, round(float(sum(np.log10((trained[w] + 1) / (total + distinct + 1)) for w in low(t))), 4)) for i, t in rows], key=str)
    same([(x.doc_id, x.n_tokens, x.n_known, x.train_tokens, round(x.base_score, 4)) for x in got], want)
    assert all(x.score < 0 for x in got)
    assert language_model.score(empty).count() == 0


def coded(spark, docs):
    """(id, held out, tokens) as the rows that training reads, one chunk."""
    rows = [([i for i, *_ in docs], [f for _, f, _ in docs], [0] * len(docs), [0.0] * len(docs), [0.0] * len(docs), bytearray(dictionary.pack(np.array([len(t) for *_, t in docs], np.uint32), np.concatenate([t for *_, t in docs]).astype(np.uint16))))]
    return spark.createDataFrame(rows, language_model.CODED)


def test_every_training_document_is_learned_from(spark):
    docs = [(i, int(i % 7 == 2), np.array([2 * i + 1, 2 * i + 2, 0])) for i in range(200)]
    model, start = language_model.GatedModel(), language_model.GatedModel().p["X"]
    for round_ in range(language_model.ROUNDS):
        model = language_model._train_round(coded(spark, docs), model, round_)
    moved = (np.abs(model.p["X"] - start) > 1e-6).any(axis=1)
    assert [i for i, held, t in docs if moved[t[:2]].all() == held] == []


def test_long_documents_are_followed_from_start_to_end(spark):
    tokens = np.random.default_rng(2).integers(1, 50, 2500)
    model, direct = language_model._train_round(coded(spark, [(0, 0, tokens)]), language_model.GatedModel(), 0), language_model.GatedModel()
    language_model.train(direct, np.array([len(tokens)]), tokens, {})
    assert all(np.allclose(model.p[k], direct.p[k], atol=1e-5) for k in direct.p)


def test_words_are_numbered_by_their_bytes():
    r = random.Random(12)
    texts = [" ".join("".join(r.choice("ab") for _ in range(r.choice([1, 2, 7, 8, 9, 16, 17, 70]))) for _ in range(300)) for _ in range(3)] + ["", None, "z" * 100_000, " a "]
    words = words_of(pa.array(texts))
    every = [words.text(i) for i in range(len(words.hash))]
    for hashes in (words.hash, words.hash % np.uint64(7)):  # and where hashes collide
        words.hash = hashes
        own, codes, _ = dictionary.number(words)
        assert [own[c] for c in codes] == every and len(own) == len(set(every))
    assert [len(x) for x in dictionary.number(words_of(pa.array(["", None])))] == [0, 0, 0]


def plain_score(p, tokens):
    """Natural log-probability of one document, word by word."""
    lm, h, enter, out = language_model, np.zeros(language_model.HIDDEN), language_model.START, 0.0
    for t in tokens:
        x, n = p["X"][enter].astype(float), lm.HIDDEN
        z, r = np.split(1 / (1 + np.exp(-(x[: 2 * n] + h @ p["U"]))), 2)
        new = np.tanh(x[2 * n :] + (r * h) @ p["V"])
        h = (1 - z) * new + z * h
        kind = t // lm.CLASS_WORDS if t < lm.HEAD else t - lm.HEAD + lm.HEAD_CLASSES
        a = h @ p["C"] + p["c"]
        out += a[kind] - np.log(np.exp(a).sum())
        if t < lm.HEAD:
            a = h @ p["W"][kind] + p["w"][kind]
            out += a[t % lm.CLASS_WORDS] - np.log(np.exp(a).sum())
        enter = t
    return out


def test_gradients_of_the_network():
    model, r = language_model.GatedModel(), np.random.default_rng(5)
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    tokens, moments = r.integers(0, language_model.START, 40), {}
    slopes = {}

    class Keep(dict):
        def setdefault(self, name, default):
            slopes[name] = default[0] * 0
            return super().setdefault(name, default)

    start = {k: v.copy() for k, v in model.p.items()}
    moments = Keep()
    language_model.train(model, np.array([32]), tokens[:32], moments, rate=0.0)
    for name in ("X", "U", "V", "C", "c", "W", "w"):
        got = moments[name][0] / 0.1  # the first moment after one step
        flat = np.argsort(-np.abs(got).ravel())[:3]
        for i in flat:
            step = np.zeros(got.size)
            step[i] = 1e-3
            step = step.reshape(got.shape)
            high, low = (plain_score(start | {name: start[name] + sign * step}, tokens[:32]) for sign in (1, -1))
            assert got.ravel()[i] == pytest.approx(-(high - low) / 2e-3 / 32, rel=2e-2, abs=1e-4), name


def test_scores_of_the_whole_query(spark, odd):
    """Every score from the network's parameters and the counts, word by word."""
    rows = odd_rows()
    low = lambda t: (t or "").encode().lower().split()
    trained = Counter(w for i, t in rows if zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for w in low(t))
    ends = sum(zlib.crc32(b"" if i is None else str(i).encode()) % 7 != 2 for i, _ in rows)
    coded_rows, vocab = language_model.coded_texts(odd)
    model = language_model.fit(coded_rows, vocab)
    lm, head = language_model, sorted(trained, key=lambda w: (-trained[w], w))[: language_model.HEAD - 1]
    number = {w: i + 1 for i, w in enumerate(head)}
    tail = Counter()
    for w, n in trained.items():
        tail[int(np.log2(n)) // lm.BIN_BITS] += n * (w not in number)
    want = []
    for i, t in rows:
        tokens, share = [], 0.0
        for w in low(t):
            if w in number:
                tokens.append(number[w])
            elif trained[w]:
                k = int(np.log2(trained[w])) // lm.BIN_BITS
                tokens.append(lm.HEAD + k)
                share += np.log(trained[w] / tail[k])
            else:
                tokens.append(lm.UNSEEN)
        want.append((i, len(tokens) + 1, (plain_score(model.p, [*tokens, 0]) + share) / np.log(10)))
    assert vocab.ends == ends
    got = sorted(((x.doc_id, x.n_tokens, x.score) for x in language_model.judged(coded_rows, vocab, model).collect()), key=str)
    for g, w in zip(got, sorted(want, key=str), strict=True):
        assert g[:2] == w[:2] and g[2] == pytest.approx(w[2], rel=1e-3, abs=1e-2)


def test_words_met_once_stand_for_unseen_ones_by_their_hash(spark):
    words = [f"once{i}" for i in range(400)] + ["often"] * 900
    docs = make(spark, [(2, " ".join(words[:700])), (1, " ".join(words[700:]))])
    # one of the two is held out: buckets without a training word
    assert language_model.score(docs).count() == 2
    many = make(spark, [(2, " ".join(f"often{i % 700} " * 2 for i in range(700)) + " ".join(words[:400]))])
    tokens = np.concatenate([dictionary.unpack(r.blob)[1] for r in language_model.coded_texts(many)[0].collect()])
    flagged = sum(zlib.crc32(w.encode()) & 1 for w in words[:400])
    assert (tokens == language_model.ONCE).sum() == flagged


def test_recurrent_gradients_and_carried_state():
    model = language_model.GatedModel()
    r = np.random.default_rng(1)
    counts, tokens = np.array([90, 3, 40]), r.integers(0, language_model.START, 133)
    whole = language_model.score_documents(model, counts, tokens)
    assert whole[0] == pytest.approx(plain_score(model.p, tokens[:90]), rel=1e-4)
    before = whole.sum()
    moments = {}
    for _ in range(80):
        language_model.train(model, counts, tokens, moments)
    assert language_model.score_documents(model, counts, tokens).sum() > before + 20


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 200
    rows = [(3, "u", big), (1, "u\r\nX: y", big), (2, None, big), (2, "u", big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (None, "u", big), (7, "é", "ü" * 5000)]
    pages = spark.createDataFrame([(*x, "p") for x in rows], "page_id long, url string, html string, payload string")
    got = [tuple(x) for x in warc.archive_pages(pages).collect()]
    want = []
    for i, _, t in rows:
        data = (t or "").encode()
        again = t == big and i != 1
        want.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if again else "response", 1 if again else None))
    same(got, want)
    assert warc.archive_pages(pages.limit(0)).count() == 0
    path = str(tmp_path / "b")
    warc.write_bundles(pages, path, dt.datetime(2024, 1, 2, 3, 4, 5))
    index = {x.page_id: x.record_id for x in warc.entries(spark.read.parquet(f"{path}/bundles")).collect()}
    assert warc.find_payload(spark, path, index[7]).decode() == "ü" * 5000
    assert warc.find_record(spark, path, "urn:page:0:x") is None
    # a revisit names a record that is there and has the payload
    fields, body = warc.find_record(spark, path, index[3])
    assert fields["WARC-Type"] == "revisit" and body == b"" and warc.find_payload(spark, path, index[3]).decode() == big
    target = fields["WARC-Refers-To"][1:-1]
    assert target == index[1] and warc.find_record(spark, path, target)[0]["WARC-Type"] == "response"
    assert fields["WARC-Profile"] == warc.SAME_PAYLOAD and fields["WARC-Date"] == "2024-01-02T03:04:05Z"
    # and every record has what WARC/1.1 demands
    for name in index.values():
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"} <= set(warc.find_record(spark, path, name)[0])


def test_one_record_reads_one_bundle(spark, tmp_path, monkeypatch):
    r, path = random.Random(3), str(tmp_path / "b")
    html = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(40_000))
    pages = spark.createDataFrame([(i, "u", html()) for i in range(1200)], "page_id long, url string, html string").repartition(1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        warc.write_bundles(pages, path)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    bundles = spark.read.parquet(f"{path}/bundles")
    assert bundles.count() >= 3 and len(bundles.inputFiles()) <= 2
    name = warc.entries(bundles).where("page_id = 777").first().record_id
    place = warc.record_place(spark, path, name)
    assert len(place.collect()) == 1
    plan = place._jdf.queryExecution().executedPlan()
    assert plan.collectLeaves().apply(0).metrics().apply("numOutputRows").value() == 1
    whole = bundles.where("bundle_id = '%s'" % place.first().bundle_id).first()
    reader, unpacked = warc.BundleReader(bytes(whole.bundle)), []
    assert len(reader) > 5
    plain = warc.BundleReader.frame
    monkeypatch.setattr(warc.BundleReader, "frame", lambda self, i: unpacked.append(i) or plain(self, i))
    assert len(warc.find_payload(spark, path, name)) == 40_000 and len(unpacked) == 1


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute_spans(text):
    out = []
    for k, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            odd = [int(c) for c in reversed(d)]
            luhn = sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(odd)) % 10 == 0
            fits = {"email": True, "ip": all(int(x) <= 255 for x in m.group().split(".")) if kind == "ip" else True, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]
            if fits:
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_personal_data(spark, odd, empty):
    r = random.Random(8)
    parts = ["a", "b.", "@", "@c", "d.e", "1", "23", "4", "-", " ", ".", "+", "(", ")", "🙂", "192.168.0.1", "4111 1111 1111 1111", "999", "+1 (988) 555-2485"]
    rows = odd_rows() + [(100 + i, "".join(r.choice(parts) for _ in range(r.randint(0, 40)))) for i in range(1500)] + [(9000, "1 " * 9000), (9001, "a" * 90_000 + "@b.c")]
    want = []
    for i, t in rows:
        s = brute_spans(t)
        line = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in s)
        want.append((i, *(sum(x[1] == k for x in s) for k in range(4)), hashlib.sha256(line.encode()).hexdigest()))
    found = pii.find_personal_data(make(spark, rows)).cache()
    same([tuple(x)[:6] for x in pii.summary(found).collect()], want)
    assert all(sorted(x.spans) == list(x.spans) for x in found.collect())
    assert pii.summary(pii.find_personal_data(empty)).count() == 0


def planted_noise(n):
    """Rows with noisy personal data, rows with look-alikes, and the spans to be added."""
    r, rows, want = random.Random(9), [], set()
    word = lambda: "".join(r.choice("abcdefgh") for _ in range(5))
    digits = lambda k: "".join(r.choice("0123456789") for _ in range(k))

    def luhn(d):
        v = [int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))]
        return sum(v) % 10 == 0

    def number(first, good):
        while True:
            d = first + digits(15)
            if luhn(d) == good:
                return d

    def row(before, own, after, kind=None):
        i, head = len(rows), f"{word()} {word()} {before}"
        rows.append((i, f"{head}{own}{after} {word()}"))
        if kind is not None:
            want.add((i, kind, len(head), len(head) + len(own)))

    for _ in range(n):
        d = number("4", True)
        row("please charge my card ", d, ".")
        row("he has ", number("4", True), "")
        wrong = number("4", False)
        row("please charge my card ", " ".join(wrong[k : k + 4] for k in range(0, 16, 4)), " today", 2)
        row("serial no ", number(r.choice("01789"), False), "")
        row("", number(r.choice("01789"), False), "")
        row("call +1 (212) 555-", digits(4), "")
        row("", f"+1 (212) 555-{digits(4)}", " 10.20.30.40", 3)
        row("write to ", f"{word()}@{word()}.com", "")
        row("write to ", f"{word()} (at) {word()} (dot) com", "", 0)
        row("we met ", f"{word()}(at){word()}.5", "")
    return rows, want


def test_the_method_adds_noisy_spans(spark):
    rows, want = planted_noise(60)
    found = pii.find_personal_data(make(spark, rows).repartition(4)).collect()
    added = {(x.doc_id, s.kind, s.start, s.end) for x in found for s in x.spans if not s.base}
    kept = {x.doc_id: [(s.start, s.kind, s.end) for s in x.spans if s.base] for x in found}
    assert all(kept[i] == brute_spans(t) for i, t in rows)
    right = len(added & want)
    assert right / len(added) >= 0.99 and right / len(want) >= 0.95


def test_reliabilities_follow_the_labelers():
    counts = [((1, 1, 1, 1), 60), ((-1, -1, 0, -1), 40), ((1, -1, 1, 1), 10), ((-1, 1, 0, -1), 8)]
    share, _, post = pii.reliabilities(counts)
    assert 0.4 < share < 0.8 and post[(1, -1, 1, 1)] > 0.9 > 0.1 > post[(-1, 1, 0, -1)]


def test_decontamination(spark, odd, empty):
    r = random.Random(5)
    items = [(i, " ".join(f"k{r.randint(0, 900)}" for _ in range(n))) for i, n in enumerate([3, 9, 15, 30, 60, 61, 200])]
    benchmark = spark.createDataFrame([*items, (90, None), (91, ""), (3, items[3][1])], "item_id long, text string")
    fill = lambda n: " ".join(f"f{r.randint(0, 900)}" for _ in range(n))
    rows = [(100 + i, f"{fill(40)} {t}\n{fill(7)}") for i, t in items] + odd_rows() + [(300, fill(500))]
    edited = items[6][1].split()
    edited[70] = "changed"
    rows.append((301, fill(20) + " " + " ".join(edited) + " " + fill(9)))
    out = {x.doc_id: [i.item_id for i in x["items"]] for x in decontaminate.benchmark_hits(make(spark, rows), benchmark).collect()}
    assert all(out[100 + i] == [i] for i, _ in items) and out[301] == [6]
    assert not any(v for k, v in out.items() if k is None or not 100 <= k <= 106 and k != 301)
    clean = decontaminate.drop_contaminated(make(spark, rows), benchmark)
    assert clean.count() == len(rows) - 8
    shared = make(spark, [(None, items[4][1]), (None, fill(30)), (7, items[5][1]), (7, fill(30))])
    assert [x.doc_id for x in decontaminate.drop_contaminated(shared, benchmark).orderBy("doc_id").collect()] == [None, 7]
    assert decontaminate.drop_contaminated(empty, benchmark).count() == 0
    assert decontaminate.benchmark_hits(empty, benchmark).count() == 0
    assert not any(x.contaminated for x in decontaminate.benchmark_hits(odd, benchmark.limit(0)).collect())


@pytest.mark.parametrize("blocks", [16, 2])
def test_many_items_take_one_pass(spark, blocks, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_BLOCKS", blocks)
    r = random.Random(15)
    items = [(i, " ".join(f"k{r.randint(0, 9000)}" for _ in range(16))) for i in range(10_000)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    fill = lambda n: " ".join(f"f{r.randint(0, 900)}" for _ in range(n))
    rows = [(i, f"{fill(30)} {items[j][1]} {fill(5)} {items[j + 1][1]}" if j % 2 else fill(40)) for i, j in enumerate(r.sample(range(9_999), 60))]
    want = {i: [k for k, t in items if f" {t} " in f" {text} "] for i, text in rows}
    hits = decontaminate.benchmark_hits(make(spark, rows), benchmark)
    assert {x.doc_id: [y.item_id for y in x["items"]] for x in hits.collect()} == want
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert len(set(re.findall(r"MapInArrow search[^\n]*", plan))) == (1 if blocks == 16 else 3)
    clean = decontaminate.drop_contaminated(make(spark, rows), benchmark)
    assert sorted(x.doc_id for x in clean.collect()) == sorted(i for i, w in want.items() if not w)


def test_an_edit_anywhere_in_an_item_is_forgiven():
    r = random.Random(8)
    words = {n: [f"k{r.randint(0, 900)}" for _ in range(n)] for n in (49, 60, 84, 97, 200)}
    index = decontaminate.ItemIndex([(n, " ".join(w).encode()) for n, w in words.items()])
    texts, want = [], []
    for n, w in words.items():
        assert all(a >= 0 and a + size <= n for a, size in decontaminate.parts_of(n))
        for at in range(5, n - 5):
            texts += [" ".join(["before", *w[:at], *put, *w[at + gone :], "after"]) for put, gone in ((["new"], 1), (["new"], 0), ([], 1))]
            want += [n] * 3
    found = words_of(pa.array(texts))
    hits = index.matches(found.hash, found.at)
    assert [[*hits[i]] for i in range(len(texts))] == [[n] for n in want]


def best_of_all_stretches(item, text):
    """By every pair of begin and end, shingles as word tuples."""
    size = min(5, len(item))
    grams = lambda w: [tuple(w[i : i + size]) for i in range(len(w) - size + 1)]
    want, found, top = Counter(grams(item)), grams(text), 0
    total = sum(want.values())
    for a in range(len(found)):
        met, both = Counter(), 0
        for b in range(a, min(len(found), a + total * 5 // 4 + 1)):
            met[found[b]] += 1
            both += met[found[b]] <= want[found[b]]
            top = max(top, both / (total + b - a + 1 - both))
    return top


def found_similarity(item, texts):
    index = decontaminate.ItemIndex([(1, " ".join(item).encode())])
    found = words_of(pa.array([" ".join(t) for t in texts]))
    hits = index.matches(found.hash, found.at)
    return [hits[i].get(1, 0) if i in hits else 0 for i in range(len(texts))]


def test_passages_cut_short_or_with_blocks_put_in():
    r = random.Random(3)
    fill = [f"f{i}" for i in range(60)]
    for n in (49, 60, 120, 200):
        item = [f"k{r.randint(0, 900)}" for _ in range(n)]
        texts = [fill[:30] + t + fill[30:] for k in range(0, n // 4 + 2, 3) for t in (item[k:], item[: n - k], item[k // 2 : n - k + k // 2], item[: n // 2] + fill[:k] + item[n // 2 :])]
        texts.append(fill[:9] + item[: n // 2] + item[n // 2 - 4 :] + item[:20])
        for got, text in zip(found_similarity(item, texts), texts, strict=True):
            want = best_of_all_stretches(item, text)
            assert got == pytest.approx(want if want >= 0.8 else 0), (n, text)


def test_edits_at_every_place_leave_a_window():
    r = random.Random(12)
    for n in range(15, 61):
        assert all(a >= 0 and a + size <= n for a, size in decontaminate.parts_of(n))
        item = [f"k{r.randint(0, 9000)}" for _ in range(n)]
        texts = [["before", *item[:at], *put, *item[at + gone :], "after"] for at in range(n + 1) for put, gone in ((["new"], 1), (["new"], 0), ([], 1), (item[max(0, at - 4) : at], 0))]
        texts += [["before", "new", *item[1:at], "new", *item[at + 1 : n - 1], "new", "after"] for at in range(1, n - 1)]
        for got, text in zip(found_similarity(item, texts), texts, strict=True):
            want = best_of_all_stretches(item, text)
            assert got == pytest.approx(want if want >= 0.8 else 0), (n, text)


def test_items_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 2)
    items = [(i, " ".join(f"b{i}x{k}" for k in range(20))) for i in range(5)]
    docs = make(spark, [(i, t) for i, t in items] + [(9, "nothing here"), (9, "nothing here")])
    out = [(x.doc_id, [i.item_id for i in x["items"]]) for x in decontaminate.benchmark_hits(docs, spark.createDataFrame(items, "item_id long, text string")).collect()]
    same(out, [(i, [i]) for i in range(5)] + [(9, []), (9, [])])
    kept = decontaminate.drop_contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert [x.doc_id for x in kept.collect()] == [9, 9]


def test_near_fingerprints_are_all_found():
    r = np.random.default_rng(0)
    marks = r.integers(0, 2**63, 50, dtype=np.uint64)
    found = np.concatenate([marks ^ np.uint64(sum(1 << int(b) for b in r.choice(64, k, replace=False))) for k in range(9)])
    a, b = decontaminate.BlockIndex(marks).near(found)
    want = [(i, j) for i, x in enumerate(found) for j, y in enumerate(marks) if int(x ^ y).bit_count() <= decontaminate.RADIUS]
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == want


def test_texts_without_spaces_are_dealt_by_pre_token(spark):
    """One entry for each distinct pre-token, however often a text without spaces repeats it."""
    text = "".join(f"中文{i % 7}好.," for i in range(500))
    plain, exact = byte_bpe.Pieces(PATTERN), set(regex.findall(PATTERN, text))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": [text, "a " + text], "flag": [0, 0]})
    chunk = next(dictionary._chunks(iter([batch]), plain, 3))
    assert {w.decode() for w in chunk.words} == exact | {"a"} | {x for x in regex.findall(PATTERN, "a " + text)}
    ranks = byte_bpe.read_ranks(RANKS)
    got = byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(make(spark, [(1, text)]), RANKS, PATTERN), RANKS)).first()
    assert tuple(got)[1:] == byte_bpe.brute_force(text, ranks, PATTERN)


def test_each_pre_token_is_merged_once(spark, monkeypatch):
    """A bucket's pieces share their pre-tokens: word, word. and word, merge the word once."""
    calls = Counter()
    plain = byte_bpe.merge
    texts = ["word word. word, word! (word", " word. other, word;"]
    monkeypatch.setattr(byte_bpe, "merge", lambda w, ranks: calls.update([w]) or plain(w, ranks))
    table = pa.table({"chunk": [1], "check": [1], "bucket": [0], "words": [dictionary.pack(*language_model._cells(sorted({w.encode() for t in texts for w in regex.findall(r" ?[^ ]+", t)})))]})
    resolve = byte_bpe.resolver(byte_bpe.read_ranks(RANKS), PATTERN)
    assert len(list(resolve(table))) == 1
    assert calls and max(calls.values()) == 1 and calls[b"word"] == calls[b" word"] == 1


def test_byte_bpe(odd, empty):
    ranks = byte_bpe.read_ranks(RANKS)
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for i, t in odd_rows():
        ids = encoding.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    same([tuple(x) for x in byte_bpe.digests(byte_bpe.decode(byte_bpe.encode(odd, RANKS, PATTERN), RANKS)).collect()], want)
    assert byte_bpe.encode(empty, RANKS, PATTERN).count() == 0


def test_cutting_before_spaces_changes_no_token():
    ranks, r = byte_bpe.read_ranks(RANKS), random.Random(1)
    encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    tokenizer = byte_bpe.Pieces(PATTERN)
    parts = [" ", " ", "  ", "\n", "\t", " ", "\x85", "a", "don't", "é", "12", "!?", "　", "'s", "x" * 60, "日本", "🙂"]
    for _ in range(4000):
        text = "".join(r.choice(parts) for _ in range(r.randint(0, 12)))
        try:
            words = tokenizer.split(text)
            dictionary._Codes(tokenizer.odd).all_of(words)
        except dictionary.Odd:
            words = tokenizer.exact(text)
        words = [w if isinstance(w, bytes) else b" " + w.encode() for w in words]
        ids = [i for w in words for i in encoding.encode_ordinary(w.decode())]
        assert ids == encoding.encode_ordinary(text)


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns, name
        assert 0 < out.count() <= docs.count()
    assert json.dumps([n for n, _ in corpus_pipeline.STAGES]).count(",") == 4
    result = corpus_pipeline.run(spark, sf_dir)
    assert result.count() == result.select("doc_id").distinct().count()
