"""Message topics, as a stream or as a bounded read."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

# Topic -> partition -> offset.
Offsets = Mapping[str, Mapping[int, int]]


@dataclass(frozen=True)
class TopicConf:
    """A reader format with its options. ``schema`` is needed by file formats only."""

    format: str = "kafka"
    options: Mapping[str, str] = field(default_factory=dict)
    schema: StructType | str | None = None
    path: str | None = None


def kafka_conf(
    bootstrap: str,
    topics: Sequence[str],
    security: Mapping[str, str] | None = None,
    starting: str = "latest",
    max_per_trigger: int | None = None,
    min_partitions: int | None = None,
) -> TopicConf:
    """Options for the Kafka source.

    ``security`` holds ``kafka.``-prefixed settings (protocol, SASL mechanism, JAAS text). Set
    ``max_per_trigger`` to bound a micro-batch, ``min_partitions`` to read with more tasks than the
    topic has partitions.
    """
    options = {
        **(security or {}),
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topics),
        "startingOffsets": starting,
    }
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    return TopicConf("kafka", options)


def _load(reader, conf: TopicConf) -> DataFrame:
    reader = reader.format(conf.format).options(**conf.options)
    if conf.schema is not None:
        reader = reader.schema(conf.schema)
    return reader.load(conf.path) if conf.path else reader.load()


def read_messages_stream(spark: SparkSession, conf: TopicConf) -> DataFrame:
    """Unbounded read; rows have a ``value`` column."""
    return _load(spark.readStream, conf)


def read_messages(
    spark: SparkSession,
    conf: TopicConf,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    span: tuple[Offsets, Offsets] | None = None,
) -> DataFrame:
    """Bounded read from the earliest message to the current end, of a span of broker time, or of the
    offsets of ``span``, from the first up to but without the second.

    Of a topic, ``since`` and ``until`` become offsets before anything is read, so a look at a few
    minutes of a large topic reads those minutes. Files have no such index and ignore all of these.
    """
    options = dict(conf.options)
    if conf.format == "kafka":
        options |= {"startingOffsets": "earliest", "endingOffsets": "latest"}
        options.pop("maxOffsetsPerTrigger", None)
        if since is not None:
            options["startingTimestamp"] = _millis(since)
            options["startingOffsetsByTimestampStrategy"] = "latest"
        if until is not None:
            options["endingTimestamp"] = _millis(until)
        if span is not None:
            if since is not None or until is not None:
                raise ValueError("give a span of time or of offsets, not both")
            options["startingOffsets"], options["endingOffsets"] = map(_offset_json, span)
            options["subscribe"] = ",".join(sorted(span[0]))
    return _load(spark.read, TopicConf(conf.format, options, conf.schema, conf.path))


def _offset_json(offsets: Offsets) -> str:
    return json.dumps({t: {str(p): n for p, n in parts.items()} for t, parts in offsets.items()})


def from_offsets(starts: Offsets, n: int) -> tuple[Offsets, Offsets]:
    """The span of the ``n`` messages of each partition that begin at ``starts``.

    They have to be there: take ``starts`` from messages or progress seen before.
    """
    ends = {t: {p: at + n for p, at in parts.items()} for t, parts in starts.items()}
    return starts, ends


def up_to_offsets(ends: Offsets, n: int) -> tuple[Offsets, Offsets]:
    """The span of the last ``n`` messages of each partition before ``ends``."""
    starts = {t: {p: max(0, at - n) for p, at in parts.items()} for t, parts in ends.items()}
    return starts, ends


def offsets_reached(query: StreamingQuery) -> Offsets:
    """Where a running stream of topics stands, from its last progress."""
    found: dict[str, dict[int, int]] = {}
    for source in (query.lastProgress or {}).get("sources", []):
        reached = source["endOffset"]
        reached = json.loads(reached) if isinstance(reached, str) else reached or {}
        for topic, parts in reached.items():
            found.setdefault(topic, {}).update({int(p): n for p, n in parts.items()})
    return found


def _millis(moment: dt.datetime) -> str:
    """Milliseconds since 1970; a time without zone is UTC."""
    zoned = moment if moment.tzinfo else moment.replace(tzinfo=dt.UTC)
    return str(int(zoned.timestamp() * 1000))


def first_messages(messages: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages by position."""
    return messages.orderBy("offset", "topic", "partition").limit(n)


def first_messages_per_topic(messages: DataFrame, n: int) -> DataFrame:
    """The first ``n`` messages of each topic; map tasks pass on at most ``n`` per topic."""
    window = Window.partitionBy("topic").orderBy("partition", "offset")
    numbered = messages.withColumn("__n", F.row_number().over(window))
    return numbered.filter(F.col("__n") <= n).drop("__n")


def peek(
    spark: SparkSession,
    conf: TopicConf,
    n: int,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    span: tuple[Offsets, Offsets] | None = None,
) -> DataFrame:
    """A sample of a topic, to look at its messages.

    Where the topic is large, bound it in time or by offsets (``from_offsets``, ``up_to_offsets``): then
    no more than that is read.
    """
    return first_messages(read_messages(spark, conf, since, until, span), n)


def peek_topics(
    spark: SparkSession,
    conf: TopicConf,
    n: int,
    since: dt.datetime | None = None,
    until: dt.datetime | None = None,
    span: tuple[Offsets, Offsets] | None = None,
) -> DataFrame:
    """A sample of every subscribed topic, bounded as in ``peek`` where the topics are large."""
    return first_messages_per_topic(read_messages(spark, conf, since, until, span), n)
