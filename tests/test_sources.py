"""Topics, files, databases, table layouts."""

import datetime as dt
from unittest import mock

import pytest
from pyspark.sql import functions as F
from remitlake import scratch
from remitlake.schemas import CURRENCIES, TRANSACTIONS
from remitlake.sources import csv_files, event_feed, jdbc, tables, topics
from remitlake.streaming.landing import jdbc_writer
from samples import tx_df, uid


def test_kafka_options():
    conf = topics.kafka_conf(
        "broker:9091",
        ["payments", "rates"],
        {"kafka.security.protocol": "SASL_SSL"},
        starting="earliest",
        max_per_trigger=1000,
        min_partitions=64,
    )
    assert conf.format == "kafka"
    assert conf.options == {
        "kafka.security.protocol": "SASL_SSL",
        "kafka.bootstrap.servers": "broker:9091",
        "subscribe": "payments,rates",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
        "minPartitions": "64",
    }


def test_bounded_kafka_read_covers_the_topic():
    spark = mock.MagicMock()
    reader = spark.read.format.return_value
    topics.read_messages(spark, topics.kafka_conf("b:1", ["t"], max_per_trigger=5))
    options = reader.options.call_args.kwargs
    assert options["startingOffsets"] == "earliest" and options["endingOffsets"] == "latest"
    assert "maxOffsetsPerTrigger" not in options


def test_bounded_kafka_read_of_a_span():
    spark = mock.MagicMock()
    reader = spark.read.format.return_value
    since, until = dt.datetime(2022, 10, 1), dt.datetime(2022, 10, 1, 0, 5, tzinfo=dt.UTC)
    topics.read_messages(spark, topics.kafka_conf("b:1", ["t"]), since, until)
    options = reader.options.call_args.kwargs
    assert options["startingTimestamp"] == "1664582400000"
    assert options["endingTimestamp"] == "1664582700000"


def test_peek_of_offsets_reads_no_more():
    spark = mock.MagicMock()
    reader = spark.read.format.return_value
    conf = topics.kafka_conf("b:1", ["t", "other"])
    topics.peek(spark, conf, 8, span=topics.from_offsets({"t": {0: 100, 1: 0}}, 8))
    options = reader.options.call_args.kwargs
    assert options["startingOffsets"] == '{"t": {"0": 100, "1": 0}}'
    assert options["endingOffsets"] == '{"t": {"0": 108, "1": 8}}'
    assert options["subscribe"] == "t"
    topics.peek_topics(spark, conf, 8, span=topics.up_to_offsets({"t": {0: 100}, "other": {0: 3}}, 8))
    options = reader.options.call_args.kwargs
    assert options["startingOffsets"] == '{"t": {"0": 92}, "other": {"0": 0}}'
    assert options["endingOffsets"] == '{"t": {"0": 100}, "other": {"0": 3}}'
    assert options["subscribe"] == "other,t"
    with pytest.raises(ValueError):
        topics.peek(spark, conf, 8, since=dt.datetime(2022, 1, 1), span=topics.from_offsets({"t": {0: 1}}, 1))


def test_offsets_reached():
    query = mock.MagicMock()
    query.lastProgress = {"sources": [{"endOffset": '{"t": {"0": 5, "1": 7}}'}, {"endOffset": {"u": {"0": 1}}}]}
    assert topics.offsets_reached(query) == {"t": {0: 5, 1: 7}, "u": {0: 1}}
    query.lastProgress = None
    assert topics.offsets_reached(query) == {}


def test_peek(spark, tmp_path):
    rows = spark.range(40).selectExpr(
        "if(id % 2 = 0, 'a', 'b') as topic", "cast(0 as int) as partition", "id as offset"
    )
    rows.write.parquet(str(tmp_path / "log"))
    conf = topics.TopicConf("parquet", path=str(tmp_path / "log"))
    assert [r.offset for r in topics.peek(spark, conf, 3).collect()] == [0, 1, 2]
    per_topic = topics.peek_topics(spark, conf, 2).collect()
    assert sorted((r.topic, r.offset) for r in per_topic) == [
        ("a", 0),
        ("a", 2),
        ("b", 1),
        ("b", 3),
    ]


AWKWARD = ["plain", 'quote " and, comma', "line\nbreak", "", None, " blank ", "back\\slash"]
AWKWARD += ["\\n", "\\\\n", "\\\n", "\\N", "\r\n", "a\rb\\", "\\\\\\", '"\n"', "\u2028x"]


def test_csv_round_trip(spark, tmp_path):
    rows = [(str(i), text) for i, text in enumerate(AWKWARD)]
    df = spark.createDataFrame(rows, "id string, text string")
    path = csv_files.export_csv(df, str(tmp_path), "notes", "2022-10-01")
    assert path.endswith("/dump_notes.2022-10-01.csv")
    loaded = csv_files.load_csv(spark, path, "id string, text string")
    good, bad = csv_files.split_corrupt(loaded)
    assert bad.count() == 0
    assert sorted((r.id, r.text) for r in good.collect()) == sorted(rows)


def test_csv_files_are_cut_among_tasks(spark, tmp_path):
    rows = [(i, f"two\nlines {i} " + "x" * 50) for i in range(2000)]
    path = csv_files.export_csv(spark.createDataFrame(rows, "id int, text string").coalesce(1), str(tmp_path), "long", "2022-10-01")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "16k")
    try:
        loaded = csv_files.split_corrupt(csv_files.load_csv(spark, path, "id int, text string"))[0]
        assert len(loaded.inputFiles()) == 1 and loaded.rdd.getNumPartitions() > 4
        assert sorted(map(tuple, loaded.collect())) == rows
    finally:
        spark.conf.set(key, before)


def test_csv_of_other_origin(spark, tmp_path):
    (tmp_path / "x.csv").write_text('1,"two\nlines"\n2,back\\nslash\n')
    loaded = csv_files.load_csv(spark, str(tmp_path / "x.csv"), "id int, v string", foreign=True)
    good, bad = csv_files.split_corrupt(loaded)
    assert sorted(map(tuple, good.collect())) == [(1, "two\nlines"), (2, "back\\nslash")] and bad.count() == 0


def test_csv_export_replaces_the_previous(spark, tmp_path):
    for n in (5, 2):
        path = csv_files.export_csv(spark.range(n), str(tmp_path), "ids", dt.date(2022, 10, 1))
    assert csv_files.load_csv(spark, path, "id bigint").count() == 2


def test_csv_bad_lines_are_kept_aside(spark, tmp_path):
    (tmp_path / "x.csv").write_text("1,a\nnope\n2,b,extra\n3,c\n")
    loaded = csv_files.load_csv(spark, str(tmp_path / "x.csv"), "id bigint, v string")
    good, bad = csv_files.split_corrupt(loaded)
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert good.select("id").distinct().count() == 2
    assert sorted(r[0] for r in bad.collect()) == ["2,b,extra", "nope"]


def test_jdbc_append_arguments():
    df = mock.MagicMock()
    jdbc.write_jdbc(df, "jdbc:db://host/de", "stg.currencies", {"user": "u"}, connections=4)
    df.write.option.assert_called_once_with("numPartitions", 4)
    df.write.option.return_value.jdbc.assert_called_once_with(
        url="jdbc:db://host/de", table="stg.currencies", mode="append", properties={"user": "u"}
    )


def test_jdbc_batches_hold_the_message_columns():
    df = mock.MagicMock()
    jdbc_writer("jdbc:db://host/de", "stg.transactions", {"user": "u"})(df, 3, "run")
    df.select.assert_called_once_with("object_id", "object_type", "sent_dttm", "payload")
    call = df.select.return_value.write.option.return_value.jdbc.call_args
    assert (call.kwargs["table"], call.kwargs["mode"]) == ("stg.transactions", "append")


def test_jdbc_read_is_partitioned():
    spark = mock.MagicMock()
    jdbc.read_jdbc(spark, "jdbc:db://h/d", "t", {}, "id", 0, 1000, 8)
    kwargs = spark.read.jdbc.call_args.kwargs
    assert (kwargs["column"], kwargs["numPartitions"]) == ("id", 8)


def many(spark, n=200):
    rows = [
        (i, f"2022-{1 + i % 12:02d}-03 10:00:00", 410, i, 1 + i % 7, 2, "done") for i in range(n)
    ]
    return tables.with_day(tx_df(spark, rows), "transaction_dt")


def test_layout_copies_hold_every_row(spark, lake):
    df = many(spark)
    name = f"{lake.database}.copy"
    tables.write_clustered(df, name, ["transaction_dt", "object_id"], ["transaction_dt"], 4)
    assert sorted(spark.table(name).collect()) == sorted(df.collect())
    tables.write_by_date(df, name, "transaction_dt", 4)
    assert sorted(spark.table(name).collect()) == sorted(df.collect())
    # time ranges of the files do not overlap, save for the moment they meet in
    spans = (
        spark.table(name)
        .groupBy(F.input_file_name().alias("f"))
        .agg(F.min("transaction_dt").alias("lo"), F.max("transaction_dt").alias("hi"))
        .orderBy("lo", "hi")
        .collect()
    )
    assert len(spans) > 1
    assert all(a.hi <= b.lo for a, b in zip(spans, spans[1:]))


def test_one_moment_spreads_over_files(spark, lake):
    rows = [(i, "2022-10-01 00:00:00", 410, i, 1, 2, "done") for i in range(400)]
    name = f"{lake.database}.midnight"
    tables.write_by_date(tx_df(spark, rows), name, "transaction_dt", 4)
    assert spark.table(name).select(F.input_file_name()).distinct().count() == 4


def test_compaction_groups_old_days(spark, lake):
    df = many(spark)
    name = f"{lake.database}.compact"
    tables.compact_days(df, name, "transaction_dt", "2024-02-01", 4, months=16, years=3)
    groups = {str(r[0]) for r in spark.table(name).select("part_group").distinct().collect()}
    # 16 calendar months before 2024-02 is 2022-10
    assert groups == {f"2022-{m:02d}-01" for m in range(1, 11)} | {"2022-11-03", "2022-12-03"}
    copy = spark.table(name).select(df.columns)
    assert sorted(copy.collect()) == sorted(df.collect())


def test_drop_days(spark, lake):
    table = lake.table(TRANSACTIONS)
    tables.overwrite_days(many(spark), table)
    dropped = tables.drop_days(spark, table, "2022-02-01", "2022-11-30")
    assert len(dropped) == 10
    assert tables.stored_days(spark, table) == ["2022-01-03", "2022-12-03"]
    assert tables.drop_days(spark, table, "2022-02-01", "2022-11-30") == []


def test_overwriting_days_leaves_the_others(spark, lake):
    table = lake.table(TRANSACTIONS)
    df = many(spark)
    tables.overwrite_days(df, table)
    tables.overwrite_days(df.filter("event_day = '2022-05-03'").limit(1), table)
    counts = {str(r[0]): r[1] for r in spark.table(table).groupBy("event_day").count().collect()}
    assert len(counts) == 12 and counts["2022-05-03"] == 1
    tables.overwrite_days(df.limit(0), table)
    assert len(tables.stored_days(spark, table)) == 12


def test_overwriting_days_needs_a_table_that_keeps_them(spark, lake):
    name = f"{lake.database}.plain"
    spark.sql(f"CREATE TABLE {name} (n int, event_day date) USING parquet PARTITIONED BY (event_day)")
    with pytest.raises(ValueError):
        tables.overwrite_days(spark.table(name), name)


def test_run_sql_binds_the_day(spark):
    df = tables.run_sql(spark, "SELECT :day AS d, count(*) AS n FROM {t}", "2022-10-01", t=spark.range(3))
    assert tuple(df.first()) == (dt.date(2022, 10, 1), 3)


def test_scratch_root_comes_from_the_session(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        assert scratch.scratch_root(spark) == named.rstrip("/")
    assert scratch.scratch_path(spark, "x") != scratch.scratch_path(spark, "x")


def test_scratch_root_is_required_on_a_cluster():
    session = mock.MagicMock()
    session.conf.get.return_value = None
    session.sparkContext.getConf.return_value.get.return_value = None
    session.sparkContext.getCheckpointDir.return_value = None
    session.sparkContext.master = "yarn"
    with pytest.raises(ValueError):
        scratch.scratch_root(session)


@pytest.mark.parametrize("kind", [None, TRANSACTIONS, CURRENCIES])
def test_messages_of_one_file_are_parsed_by_many_tasks(spark, tmp_path, kind):
    rows = spark.range(100).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:10:00' AS ts",
        "id AS user_id",
        "if(id % 2 = 0, 'signup', 'done') AS event_type",
        "1D AS value",
        "'{\"k\": 1}' AS props",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        landed = event_feed.landed(event_feed.events(spark, str(tmp_path)), kind=kind)
        tasks = [r[0] for r in landed.select(F.spark_partition_id()).collect()]
    finally:
        spark.conf.set(key, before)
    assert len(tasks) == (50 if kind else 100) and len(set(tasks)) > 1


def test_events_are_dealt_out_without_a_sort(spark):
    rows = spark.range(10).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:10:00' AS ts",
        "id AS user_id",
        "'done' AS event_type",
        "1D AS value",
        "'{\"k\": 1}' AS props",
    )
    landed = event_feed.landed(rows)
    plan = landed._jdf.queryExecution().executedPlan().toString()
    assert "REBALANCE_PARTITIONS_BY_COL" in plan and "RoundRobinPartitioning" not in plan
    assert landed.count() == 10
