"""Jaccard join over word shingles by chosen paths.

Sets are split recursively on sampled tokens: at a node of the search tree a few sampling functions
pick a token of each set (the smallest by that function), and sets that picked the same one go down
together. Two sets of similarity s pick alike with chance s, unlike ones part. Nodes that became small
are compared by brute force; in a large one, sets close to one of its leaders are settled there. Runs are repeated with other functions until the chance to miss a pair
at the threshold is below MISS, and every pair that meets is decided by its whole shingle sets.

Equal sets are one node of everything that follows and count through their size.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.exact_dedup import other_columns
from remitlake.llm.graph import components
from remitlake.llm.words import groups, mix, shingles, slices, tidy, words_of
from remitlake.scratch import scratch_path

#: Similarity from which two sets are linked, as a fraction.
NEAR = (4, 5)
MISS = 1e-5
FUNCTIONS = 32
#: Functions tried at each node, sets up to which a node is compared directly, levels of the tree.
BRANCH = 2
LEAF = 200
DEPTH = 3
#: Sets with fewer equal picks of all FUNCTIONS are not looked at again: five deviations below NEAR.
LEAST_EQUAL = 14
#: Sets of a large node that all others are compared with; a set with SETTLED equal picks with one of
#: them goes no further down: whatever is near it has at least LINKED with the same one.
LEADERS = 8
LINKED = 12
SETTLED = 26
#: Sets of a candidate group that are verified at once; larger groups are verified block by block.
BLOCK = 256
#: Sets with candidates for each task that verifies.
VERIFIED = 1_000

_R = np.random.default_rng(5_8_2021)
_MULT = _R.integers(1, 2**63, FUNCTIONS, dtype=np.uint64) | np.uint64(1)
_ADD = _R.integers(0, 2**63, FUNCTIONS, dtype=np.uint64)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def runs_for(miss: float = MISS) -> int:
    """Runs after which a pair at the threshold has met at the first level but for ``miss``."""
    once = (1 - NEAR[0] / NEAR[1]) ** BRANCH
    runs = 1
    while once**runs > miss:
        runs += 1
    return runs


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row, sorted, and the offsets of the rows."""
    every, at = shingles(words_of(column))
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((every, row))
    every, row = every[order], row[order]
    keep = np.ones(len(every), bool)
    keep[1:] = (every[1:] != every[:-1]) | (row[1:] != row[:-1])
    return every[keep], np.searchsorted(row[keep], np.arange(len(at)))


def set_ids(sets: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """128 bits for each set, the same for equal sets; None for an empty set."""
    full = np.flatnonzero(np.diff(at))
    out: list[bytes | None] = [None] * (len(at) - 1)
    if len(full):
        both = np.stack([np.add.reduceat(mix(sets + add), at[full]) for add in (_GOLD, np.uint64(77))], axis=1)
        for i, pair in zip(full, both, strict=True):
            out[i] = pair.tobytes()
    return out


def picks(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The token that each function picks of each set; zeros for an empty set."""
    full = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, FUNCTIONS), np.uint32)
    if len(full):
        for j in range(FUNCTIONS):
            out[full, j] = np.minimum.reduceat((sets * _MULT[j] + _ADD[j]) >> np.uint64(32), at[full])
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            sets, at = shingle_sets(part.column("text"))
            sketch = picks(sets, at)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("th"), pa.array(set_ids(sets, at), pa.binary()), pa.array([x.tobytes() for x in sketch], pa.binary())], names=["doc_id", "th", "sid", "sketch"])


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, FUNCTIONS)


def _split(batches: Iterator[pa.RecordBatch], runs: int) -> Iterator[pa.RecordBatch]:
    """Rows of the children: at the root (path null) BRANCH functions per run, below BRANCH per node."""
    for batch in batches:
        sketch, n = _matrix(batch.column("sketch")), batch.num_rows
        if "path" not in batch.schema.names:
            own = [(np.full(n, (r + 1) * 1_000_003, np.uint64), np.full(n, (r * BRANCH + b) % FUNCTIONS)) for r in range(runs) for b in range(BRANCH)]
        else:
            path = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            first = mix(path) % np.uint64(FUNCTIONS)
            own = [(path, ((first + np.uint64(b * 7 + b)) % np.uint64(FUNCTIONS)).astype(np.int64)) for b in range(BRANCH)]
        for path, function in own:
            token = sketch[np.arange(n), function].astype(np.uint64)
            child = mix(path * _GOLD + mix(token + (function.astype(np.uint64) << np.uint64(40))))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), batch.column("sid")], names=["path", "sid"])


def _least(links: np.ndarray) -> np.ndarray:
    """The smallest member of each member's component, for a symmetric matrix of links."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(label)).min(axis=1)
        new = np.minimum(label, near)
        new = np.minimum(new, new[new])
        if (new == label).all():
            return label
        label = new


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links to the smallest likely partner's component in every node, a row per set at most."""
    for table in groups(batches, "path", rows=20_000):
        table = table.combine_chunks()
        path = table.column("path").to_numpy()
        sketch, sids = _matrix(table.column("sketch")), table.column("sid").to_pylist()
        cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
        a, b = [], []
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            n = hi - lo
            equal = np.zeros((n, n), np.int16)
            for j in range(FUNCTIONS):
                own = sketch[lo:hi, j]
                equal += own[:, None] == own[None, :]
            label = _least(equal >= LEAST_EQUAL)
            for i in np.flatnonzero(label != np.arange(n)):
                a.append(sids[lo + i])
                b.append(sids[lo + label[i]])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each set of a large node with the leaders it is linked to; ``stays`` if it must go further down."""
    for batch in batches:
        n, sketch = batch.num_rows, _matrix(batch.column("sketch"))
        path = batch.column("path").to_numpy()
        linked: list[list[bytes]] = [[]] * n
        stays = np.ones(n, bool)
        for node in np.unique(path):
            own = np.flatnonzero(path == node)
            leaders = batch.column("leaders")[int(own[0])].as_py()
            ids = [x["sid"] for x in leaders]
            marks = np.frombuffer(b"".join(x["sketch"] for x in leaders), np.uint32).reshape(-1, FUNCTIONS)
            label = _least(np.array([(marks == m).sum(axis=1) >= LINKED for m in marks]))
            equal = np.stack([(sketch[own] == m).sum(axis=1) for m in marks], axis=1)
            stays[own] = equal.max(axis=1) < SETTLED
            for i, row in zip(own, equal >= LINKED, strict=True):
                linked[i] = [ids[k] for k in np.unique(label[row])]
        yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("sid"), batch.column("sketch"), pa.array(stays), pa.array(linked, pa.list_(pa.binary()))], names=["path", "sid", "sketch", "stays", "linked"])


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once in shared storage and read again, so that a join with it can be split."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def _blocks(df: DataFrame, key: str, count: str, id_: str, size: int) -> DataFrame:
    """``df`` with ``block`` keys such that any two rows of a ``key`` share one, of about 2 x size rows."""
    n = F.ceil(F.col(count) / F.lit(size)).cast("int")
    own = F.pmod(F.xxhash64(id_), n).cast("int")
    pair = F.transform(F.sequence(F.lit(0), n - 1), lambda o: F.struct(F.least(o, own).alias("i"), F.greatest(o, own).alias("j")))
    out = df.withColumn("_own", own).withColumn("_pair", F.explode(pair))
    return out.withColumn("block", F.xxhash64(key, "_pair")).withColumn("side", F.when(F.col("_pair.i") == F.col("_pair.j"), 0).when(F.col("_own") == F.col("_pair.i"), 1).otherwise(2)).drop("_pair", "_own")


def contracted(links: DataFrame) -> DataFrame:
    """``links`` (a, b; b < a) with the same components and, where sets share partners, far fewer rows.

    Each set keeps the link to its smallest partner; its other partners are linked to that one instead,
    and sets of one group have the same few. A set has as many links as nodes or blocks that hold it.
    """
    links = links.withColumn("_least", F.min("b").over(Window.partitionBy("a")))
    return links.select(F.when(F.col("b") == F.col("_least"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("_least").alias("b")).distinct()


def candidate_links(sets: DataFrame, runs: int) -> DataFrame:
    """a, b: links whose components hold every pair that met in a node. ``sets``: sid, sketch."""
    leaves, links = [], []
    rows = sets.mapInArrow(tidy(lambda it: _split(it, runs)), "path long, sid binary")
    for level in range(DEPTH):
        counts = _stored(rows.groupBy("path").agg(F.count("*").alias("n")).where("n > 1"), "nodes")
        sized = _stored(rows.join(counts, "path"), "paths")
        leaves.append(sized.where(F.col("n") <= LEAF).select("path", "sid"))
        large = sized.where(F.col("n") > LEAF).join(sets, "sid")
        if large.isEmpty():
            break
        # The window passes on LEADERS rows a node before its shuffle. Sets have one order in all nodes
        # and leaves, so that alike sets are linked to the same one everywhere; ids are hashes.
        first = Window.partitionBy("path").orderBy("sid")
        leaders = large.withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= LEADERS)
        leaders = _stored(leaders.groupBy("path").agg(F.sort_array(F.collect_list(F.struct("sid", "sketch"))).alias("leaders")), "leaders")
        settled = _stored(large.join(leaders, "path").mapInArrow(tidy(_settle), "path long, sid binary, sketch binary, stays boolean, linked array<binary>"), "settled")
        links.append(settled.select(F.col("sid").alias("a"), F.explode("linked").alias("b")).where("a != b"))
        rest = settled.where("stays")
        if level < DEPTH - 1:
            rows = rest.mapInArrow(tidy(lambda it: _split(it, runs)), "path long, sid binary")
        else:
            # Nodes that no function splits hold sets that are alike: compared block by block.
            left = _stored(rest.groupBy("path").agg(F.count("*").alias("n")), "left")
            leaves.append(_blocks(rest.select("path", "sid").join(left, "path"), "path", "n", "sid", LEAF).select(F.col("block").alias("path"), "sid"))
    every = reduce(DataFrame.unionByName, leaves)
    dealt = every.join(sets, "sid").repartition("path").sortWithinPartitions("path", "sid")
    return reduce(DataFrame.unionByName, links, dealt.mapInArrow(tidy(_meet), "a binary, b binary"))


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of common elements of all pairs."""
    n = len(sets)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    new = np.ones(len(element), bool)
    new[1:] = element[1:] != element[:-1]
    column = np.cumsum(new) - 1
    shared = np.bincount(column)[column] > 1
    column, owner = column[shared], owner[shared]
    out = np.zeros((n, n), np.int64)
    width = max(1, (1 << 22) // n)
    a = 0
    while a < len(column):
        b = int(np.searchsorted(column, column[a] + width))
        place = np.zeros((n, width), np.float32)
        place[owner[a:b], column[a:b] - column[a]] = 1
        out += (place @ place.T).astype(np.int64)
        a = b
    return out


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block: every set's links (rows of the linked sets) and its component's smallest set."""
    for table in groups(batches, "block"):
        table = table.combine_chunks()
        found: dict[bytes, tuple[np.ndarray, int, int]] = {}
        for batch in table.to_batches():
            for part in slices(batch, "text"):
                sets, at = shingle_sets(part.column("text"))
                meta = zip(part.column("sid").to_pylist(), part.column("size").to_pylist(), part.column("side").to_pylist(), strict=True)
                for i, (sid, (want, size, side)) in enumerate(zip(set_ids(sets, at), meta, strict=True)):
                    if sid == want:
                        found[sid] = (sets[at[i] : at[i + 1]], size, side)
        if len(found) < 2:
            continue
        sids = sorted(found)
        sets, size, side = ([found[s][k] for s in sids] for k in range(3))
        length, side = np.array([len(s) for s in sets]), np.array(side)
        both = _common(sets)
        links = both * (NEAR[0] + NEAR[1]) >= NEAR[0] * (length[:, None] + length[None, :])
        links &= (side[:, None] != side[None, :]) | (side[:, None] == 0)
        np.fill_diagonal(links, False)
        label = _least(links)
        count = links @ np.array(size, np.int64)
        own = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array([sids[i] for i in own], pa.binary()), pa.array(count[own], pa.int64()), pa.array([sids[label[i]] for i in own], pa.binary())], names=["sid", "links", "other"])


def _classes(docs: DataFrame, miss: float) -> tuple[DataFrame, DataFrame]:
    """The rows (doc_id, th, sid) and the distinct sets with their first row, links and class ``label``."""
    spark = docs.sparkSession
    at = scratch_path(spark, "sets")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text")
    keyed.mapInArrow(tidy(_describe), "doc_id long, th long, sid binary, sketch binary").write.parquet(at)
    described = spark.read.parquet(at)
    at = scratch_path(spark, "distinct-sets")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th"))
    described.where("sid IS NOT NULL").groupBy("sid").agg(first.alias("first"), F.count("*").alias("size"), F.min("sketch").alias("sketch")).select(
        "sid", "size", "sketch", "first.doc_id", "first.th"
    ).write.parquet(at)
    sets = spark.read.parquet(at)

    group = components(contracted(candidate_links(sets.select("sid", "sketch"), runs_for(miss)))).withColumnRenamed("node", "sid")
    tasks = max(12, -(-group.count() // VERIFIED))
    members = group.join(sets.select("sid", "size", "doc_id", "th"), "sid")
    members = members.join(_stored(group.groupBy("label").agg(F.count("*").alias("n")), "groups"), "label")
    # Rows that repeat id and text are one text here; the window passes on one of them a task, and the
    # join finds its rows laid out by the same key.
    key = {"known": F.col("doc_id").isNotNull(), "doc_id": F.coalesce("doc_id", F.lit(0))}
    place = ["known", "doc_id", "th"]
    once = F.row_number().over(Window.partitionBy(*place).orderBy("th"))
    texts = keyed.withColumns(key).withColumn("nth", once).where("nth = 1").select(*place, "text")
    whole = members.withColumns(key).join(texts, place)
    whole = _blocks(whole.select("label", "n", "sid", "size", "text"), "label", "n", "sid", BLOCK).select("block", "side", "sid", "size", "text")
    at = scratch_path(spark, "links")
    whole.repartition(tasks, "block").sortWithinPartitions("block", "sid").mapInArrow(tidy(_verify), "sid binary, links long, other binary").write.parquet(at)
    links = spark.read.parquet(at)

    label = components(contracted(links.select(F.col("sid").alias("a"), F.col("other").alias("b")))).withColumnRenamed("node", "sid")
    known = sets.select("sid", "size", "doc_id", "th").join(links.groupBy("sid").agg(F.sum("links").alias("links")), "sid", "left").join(label, "sid", "left")
    return described, known.withColumn("label", F.coalesce("label", "sid"))


def near_duplicates(docs: DataFrame, miss: float = MISS) -> DataFrame:
    """doc_id, class_id, n_links of every row of ``docs``.

    Rows are linked if the Jaccard similarity of their sets of five-word shingles is at least 0.8; a
    text of one to four words is one shingle. n_links counts the rows that a row is linked to, copies
    included. class_id is the smallest doc_id that links lead to, the own one without links. Null and
    empty texts have no shingles and no links. Rows of equal id are rows of their own. Null ids never
    name a class that has another id. Extra columns are ignored. Texts are read whole, however long; an
    empty table gives an empty result.
    """
    described, known = _classes(docs, miss)
    named = known.join(_stored(known.groupBy("label").agg(F.min("doc_id").alias("class_id")), "classes"), "label")
    named = named.select("sid", "class_id", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"))
    out = described.select("doc_id", "sid").join(named, "sid", "left")
    return out.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def keep_one_of_each_class(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns.

    It is the row that names the class, known by its id and a hash of its text: other texts of its id
    have classes of their own, null ids too. Of rows that repeat id and text, the one stays whose other
    columns, as JSON, are smallest. Rows without shingles (null, empty) are in no class and stay. Columns
    may have any name: they travel in a struct of their own.
    """
    _, known = _classes(docs, MISS)
    first = known.groupBy("label").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "th")).alias("first"))
    named = first.select(F.col("first.doc_id").alias("id"), F.col("first.th").alias("key"))
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike("[^\\x20\\x09-\\x0D]")
    rows = docs.where(has_words).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.struct(*docs.columns).alias("row"))
    kept = rows.join(named, rows["doc_id"].eqNullSafe(named["id"]) & (rows["th"] == named["key"]), "left_semi")
    # Rows that repeat id and text have one row left; the window passes on one row a key before its shuffle.
    one = Window.partitionBy("doc_id", "th").orderBy("row.text", *other_columns(docs))
    return kept.withColumn("nth", F.row_number().over(one)).where("nth = 1").select("row.*").unionByName(docs.where(~has_words))
