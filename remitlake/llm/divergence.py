"""How far the sources of a language are apart in their words, in exact integers.

Each task turns texts into terms with one ``bytes.translate`` and one split, counts them in a Counter
per document and adds those up per (lang, source), so that a row per term, group and task is shuffled
and a source with a third of all rows is no hot key. The counts of the terms that stay are a sparse
table; sources are compared on it block by block, terms spread over buckets.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from remitlake.llm.bags import terms, translate_table
from remitlake.scratch import scratch_path

#: Documents of a language that must hold a term for it to stay.
LEAST_DOCS = 10
TOP_TERMS = 10
SCALE = 1_000_000_000
TABLE = translate_table(digits=False)
_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])


@dataclass(frozen=True)
class Limits:
    """What a task holds at once; results are the same for all values."""

    #: Terms that a task counts before it passes them on.
    held_terms: int = 400_000
    #: Sources of a block, and rows of the sparse table for one comparison of two blocks.
    sources: int = 64
    bucket_rows: int = 100_000
    #: Cells of one source against others that are computed at once.
    cells: int = 1 << 18


def _count(batches: Iterator[pa.RecordBatch], limits: Limits) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of every term by group; a group's own row has no term."""
    times, docs, rows = defaultdict(Counter), defaultdict(Counter), Counter()

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), n in rows.items():
            yield pa.RecordBatch.from_pylist([{"lang": lang, "source": source, "term": None, "n": 0, "docs": n}], schema=_COUNTS)
        for (lang, source), counted in times.items():
            held = docs[lang, source]
            n = len(counted)
            columns = [pa.array([lang] * n), pa.array([source] * n), pa.array(list(counted), pa.binary()).cast(pa.string()), pa.array(list(counted.values()), pa.int64()), pa.array([held[t] for t in counted], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=_COUNTS)
        times.clear()
        docs.clear()
        rows.clear()

    held = 0
    for batch in batches:
        groups = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), strict=True)
        for group, text in zip(groups, batch.column("text").cast(pa.large_binary()), strict=True):
            bag = Counter()
            for words in terms(text.as_py(), TABLE):
                bag.update(words)
            rows[group] += 1
            before = len(times[group])
            times[group].update(bag)
            docs[group].update(bag.keys())
            held += len(times[group]) - before
            if held > limits.held_terms:
                yield from flush()
                held = 0
    yield from flush()


def group_counts(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term in every group.

    A row with a null term stands for the group itself. Null lang, source and text count as ''.
    """
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counted = rows.mapInArrow(lambda it: _count(it, limits), "lang string, source string, term string, n long, docs long")
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _share(n: str, total: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)); decimals, as the product may pass 64 bits."""
    wide = f"(CAST({n} + 2 AS DECIMAL(20, 0)) * CAST({SCALE} AS DECIMAL(10, 0)))"
    return F.expr(f"1 + {wide} div CAST({total} + 2 * terms AS DECIMAL(20, 0))")


def _kept(counts: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The sparse table (lang, source, term, n, all_n) of the terms that stay, and every group's totals.

    Totals: lang, source, terms (of the language), total and all_total (occurrences), own (the number
    of the source in its language) and zero (the share of a term that the source lacks).
    """
    spark = counts.sparkSession
    held = counts.where("term IS NOT NULL")
    stays = held.groupBy("lang", "term").agg(F.sum("docs").alias("df"), F.sum("n").alias("all_n")).where(F.col("df") >= least).drop("df")
    at = scratch_path(spark, "kept-terms")
    held.join(stays, ["lang", "term"]).select("lang", "source", "term", "n", "all_n").write.parquet(at)
    sparse = spark.read.parquet(at)
    by_lang = sparse.groupBy("lang").agg(F.count_distinct("term").alias("terms"), F.sum("n").alias("all_total"))
    by_group = sparse.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = counts.where("term IS NULL").select("lang", "source")
    totals = groups.join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0, ["total", "terms", "all_total"])
    totals = totals.withColumn("own", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
    at = scratch_path(spark, "group-totals")
    totals.withColumn("zero", F.when(F.col("terms") > 0, _share("0", "total"))).write.parquet(at)
    return sparse, spark.read.parquet(at)


def _term_rows(sparse: DataFrame, totals: DataFrame, most: int) -> DataFrame:
    rows = sparse.where("n > 0").join(totals.select("lang", "source", "terms", "total", "all_total"), ["lang", "source"])
    rows = rows.withColumns({"p": _share("n", "total"), "q": _share("all_n", "all_total")}).where("p > q")
    rows = rows.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    return _ranked(rows).where(F.col("rank") <= most)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.withColumn("rank", F.row_number().over(order))


def _compare(table: pa.Table, limits: Limits) -> pa.Table:
    """Sums over the terms of one bucket for all pairs of sources of two blocks.

    ``covered`` counts the terms; those that none of the sources here has are added afterwards.
    """
    term = table.column("term").combine_chunks()
    mark = term.is_null().to_numpy(zero_copy_only=False)
    own, p, low = (table.column(c).to_numpy() for c in ("own", "p", "low"))
    order = np.argsort(own[mark])
    sources, zero, side = own[mark][order], p[mark][order], (own[mark][order] // limits.sources) == low[mark][order]
    number = term.filter(pa.array(~mark)).dictionary_encode()
    share = np.repeat(zero[:, None], len(number.dictionary), axis=1)
    share[np.searchsorted(sources, own[~mark]), number.indices.to_numpy()] = p[~mark]
    one, two, sums = [], [], []
    alone = bool((table.column("low")[0].as_py()) == table.column("high")[0].as_py())
    for i in range(len(sources)):
        with_ = np.flatnonzero(np.arange(len(sources)) > i if alone else side[i] & ~side)
        total = np.zeros(len(with_), np.int64)
        width = max(1, limits.cells // max(1, len(with_)))
        for at in range(0, share.shape[1], width):
            a, b = share[i, at : at + width], share[with_, at : at + width]
            total += ((a - b) * (a - b) // (a + b)).sum(axis=1)
        one.append(np.repeat(sources[i], len(with_)))
        two.append(sources[with_])
        sums.append(total)
    one, two, sums = np.concatenate(one), np.concatenate(two), np.concatenate(sums)
    lang = [table.column("lang")[0].as_py()] * len(one)
    return pa.table({"lang": pa.array(lang, pa.string()), "one": pa.array(one, pa.int64()), "two": pa.array(two, pa.int64()), "part": pa.array(sums, pa.int64()), "covered": pa.array(np.full(len(one), share.shape[1]), pa.int64())})


def _pair_rows(sparse: DataFrame, totals: DataFrame, limits: Limits) -> DataFrame:
    """Every ordered pair of sources of a language, with the sum over all terms that stay.

    Sources are met in blocks, so that a task holds the shares of two blocks for the terms of
    one bucket, whatever the number of sources and terms and however many rows one language has.
    """
    buckets = max(1, -(-sparse.count() // limits.bucket_rows))
    blocks = totals.groupBy("lang").agg((F.max("own").cast("long") / F.lit(limits.sources)).cast("long").alias("last"))
    sides = totals.join(blocks, "lang").where("terms > 0").withColumn("own", F.col("own").cast("long"))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    sides = sides.withColumn("mine", F.expr(f"own div {limits.sources}")).withColumn("other", other)
    sides = sides.withColumns({"low": F.least("mine", "other"), "high": F.greatest("mine", "other")})
    marks = sides.withColumn("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(buckets - 1).cast("long"))))
    marks = marks.select("lang", "low", "high", "bucket", "own", F.lit(None).cast("string").alias("term"), F.col("zero").alias("p"))
    rows = sparse.join(sides, ["lang", "source"]).withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)))
    rows = rows.select("lang", "low", "high", "bucket", "own", "term", _share("n", "total").alias("p"))
    cells = marks.unionByName(rows).groupBy("lang", "low", "high", "bucket")
    summed = cells.applyInArrow(lambda t: _compare(t, limits), "lang string, one long, two long, part long, covered long").groupBy("lang", "one", "two")
    summed = summed.agg(F.sum("part").alias("part"), F.sum("covered").alias("covered"))
    name = lambda tag: totals.select("lang", F.col("own").cast("long").alias(tag), F.col("source").alias(f"{tag}_source"), F.col("zero").alias(f"{tag}_zero"), "terms")
    rest = "((one_zero - two_zero) * (one_zero - two_zero)) div (one_zero + two_zero)"
    both = summed.join(name("one"), ["lang", "one"]).join(name("two").drop("terms"), ["lang", "two"])
    both = both.withColumn("value", F.expr(f"part + (terms - covered) * ({rest})"))
    # A language without terms that stay has its pairs too, all of them 0.
    bare = totals.where("terms = 0")
    zeros = bare.alias("a").join(bare.alias("b"), F.expr("a.lang = b.lang AND a.own < b.own"))
    zeros = zeros.select("a.lang", F.col("a.source").alias("one_source"), F.col("b.source").alias("two_source"), F.lit(0).cast("long").alias("value"))
    both = both.select(*zeros.columns).unionByName(zeros)
    ends = F.array(F.struct(F.col("one_source").alias("source"), F.col("two_source").alias("item")), F.struct(F.col("two_source").alias("source"), F.col("one_source").alias("item")))
    rows = both.select("lang", "value", F.explode(ends).alias("end"))
    return _ranked(rows.select("lang", "end.source", F.lit("pair").alias("part"), "end.item", "value"))


def audit(docs: DataFrame, least: int = LEAST_DOCS, most: int = TOP_TERMS, limits: Limits = Limits()) -> DataFrame:
    """lang, source, part, item, value, rank: the divergence of every source of a language.

    Part ``pair``: every other source of the language with the divergence summed over the terms that stay
    (those in ``least`` documents of the language), all ranks. Part ``term``: the ``most`` terms that the
    source has more often than its language. Rank goes by value, descending, and item. Null lang, source
    and text count as ''; a group without terms takes part with the shares of no occurrence. Rows that
    repeat count each. Texts of any length are read whole, in pieces. An empty table gives no rows; other
    columns and doc_id are not looked at.
    """
    spark = docs.sparkSession
    at = scratch_path(spark, "group-counts")
    group_counts(docs, limits).write.parquet(at)
    sparse, totals = _kept(spark.read.parquet(at), least)
    return _pair_rows(sparse, totals, limits).unionByName(_term_rows(sparse, totals, most))
