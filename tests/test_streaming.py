"""The landing stream over files, one file per micro-batch."""

import json

import pytest
import query_catalog
from pyspark.sql import functions as F
from remitlake.operators.parse import parse_envelope
from remitlake.sources import event_feed, landing, topics
from remitlake.streaming import landing as stream
from samples import payment, rate, uid, values, write_lines


def lines(spark, folder):
    conf = topics.TopicConf("text", {"maxFilesPerTrigger": "1"}, path=str(folder))
    return topics.read_messages_stream(spark, conf)


def land(spark, tmp_path, **options):
    query = stream.run_landing(
        lines(spark, tmp_path / "in"),
        str(tmp_path / "out"),
        str(tmp_path / "checkpoint"),
        available_now=True,
        **options,
    )
    query.awaitTermination()
    return query


def landed_ids(spark, tmp_path):
    rows = landing.read_all(spark, str(tmp_path / "out")).collect()
    return sorted((r.object_type, int(r.object_id[-12:])) for r in rows)


def minute(m, h=0):
    return f"2022-10-01 {h:02d}:{m:02d}:00"


def test_first_arrival_wins_across_batches(spark, tmp_path):
    write_lines(tmp_path / "in", "a", [payment(1, minute(1), status="queued"), rate(1, minute(1), 410, 1)])
    land(spark, tmp_path)
    write_lines(tmp_path / "in", "b", [payment(1, minute(2), status="done"), payment(2, minute(2))])
    land(spark, tmp_path)  # a restart from the checkpoint
    assert landed_ids(spark, tmp_path) == [("CURRENCY", 1), ("TRANSACTION", 1), ("TRANSACTION", 2)]
    first = landing.read_landing(spark, str(tmp_path / "out"), "TRANSACTION").filter(
        F.col("object_id") == uid(1)
    )
    assert json.loads(first.first().payload)["status"] == "queued"


def test_exact_mode_keeps_late_rows(spark, tmp_path):
    write_lines(tmp_path / "in", "a", [payment(1, minute(0, 9))])
    land(spark, tmp_path)
    write_lines(tmp_path / "in", "b", [payment(2, minute(0, 6))])
    land(spark, tmp_path)
    assert [i for _, i in landed_ids(spark, tmp_path)] == [1, 2]


def test_bounded_mode_forgets_keys_and_drops_late_rows(spark, tmp_path):
    for name, row in [
        ("a", payment(1, minute(0, 1))),
        ("b", payment(2, minute(0, 5))),
        ("c", payment(3, minute(0, 6))),
        ("d", payment(4, minute(0, 2))),  # hours late
        ("e", payment(1, minute(0, 7))),  # forgotten by now
        ("f", payment(1, minute(1, 7))),  # repeated within the delay
    ]:
        write_lines(tmp_path / "in", name, [row])
        land(spark, tmp_path, mode="bounded")
    assert [i for _, i in landed_ids(spark, tmp_path)] == [1, 1, 2, 3]


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        stream.dedup_stream(spark.range(1), "most", collapse=False)


def test_quarantine(spark, tmp_path):
    ping = payment(2, minute(1)) | {"object_type": "PING"}
    write_lines(tmp_path / "in", "a", ["not json", ping, payment(1, minute(1))])
    query = land(spark, tmp_path)
    counted = query.recentProgress[0]["observedMetrics"]["landing"]
    assert (counted["messages"], counted["quarantined"]) == (3, 2)
    stream.run_quarantine(
        lines(spark, tmp_path / "in"),
        str(tmp_path / "bad"),
        str(tmp_path / "bad_checkpoint"),
        available_now=True,
    ).awaitTermination()
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert sorted((r.reason, r.value[:8]) for r in bad) == [
        ("unknown type", '{"object'),
        ("unparseable", "not json"),
    ]


def test_fan_out_to_two_targets(spark, tmp_path):
    write_lines(tmp_path / "in", "a", [payment(1, minute(1)), rate(1, minute(1), 410, 1)])
    write_lines(tmp_path / "in", "b", [payment(1, minute(1)), payment(2, minute(1))])
    writers = {
        kind: stream.folder_writer(str(tmp_path / kind)) for kind in ("CURRENCY", "TRANSACTION")
    }
    stream.run_fan_out(
        lines(spark, tmp_path / "in"), writers, str(tmp_path / "checkpoint"), available_now=True
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "CURRENCY")).count() == 1
    assert spark.read.parquet(str(tmp_path / "TRANSACTION")).count() == 2


def test_repeating_a_batch_replaces_it(spark, tmp_path):
    rows = landing.with_event_date(parse_envelope(values(spark, [payment(1, minute(1))])))
    writers = {"TRANSACTION": stream.folder_writer(str(tmp_path / "t"))}
    for _ in range(2):
        stream.land_batch(rows, 7, writers)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


@pytest.mark.parametrize("partitions", [1, 3])
def test_collapse_keeps_first_of_every_key(spark, partitions):
    rows = [payment(i % 5, minute(1), amount=i) for i in range(100)]
    parsed = parse_envelope(values(spark, rows).coalesce(partitions))
    out = stream.collapse_repeats(parsed.coalesce(1))
    kept = sorted((r.object_id, json.loads(r.payload)["amount"]) for r in out.collect())
    assert kept == [(uid(i), i) for i in range(5)]
    assert out.schema == parsed.schema


def test_state_store_setting_is_put_back(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        write_lines(tmp_path / "in", "a", [payment(1, minute(1))])
        query = land(spark, tmp_path)
        assert "rocksdb" in json.dumps(query.recentProgress[0]["stateOperators"]).lower()
        assert spark.conf.get(key, None) is None
    finally:
        spark.conf.set(key, before)


def test_files_per_batch(spark, tmp_path):
    rows = [payment(i, minute(1)) for i in range(50)]
    write_lines(tmp_path / "in", "a", rows)
    land(spark, tmp_path, files_per_batch=1)
    assert len(list((tmp_path / "out").glob("*/*/*/*.parquet"))) == 1
    assert len(landed_ids(spark, tmp_path)) == 50


@pytest.mark.parametrize("collapse", [False, True])
@pytest.mark.parametrize("batch_rows", ["1", "2", "10000"])
def test_on_time_repeat_of_a_late_row_lands(spark, tmp_path, collapse, batch_rows):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, batch_rows)
    try:
        for name, rows in [
            ("a", [payment(1, minute(0, 5))]),
            ("b", [payment(2, minute(0, 6))]),
            ("c", [payment(9, minute(0, 1)), payment(9, minute(6, 10))]),
        ]:
            write_lines(tmp_path / "in", name, rows)
            land(spark, tmp_path, mode="bounded", collapse=collapse)
    finally:
        spark.conf.set(key, before)
    assert [i for _, i in landed_ids(spark, tmp_path)] == [1, 2, 9]


def test_fan_out_with_a_new_checkpoint_keeps_earlier_rows(spark, tmp_path):
    writers = {"TRANSACTION": stream.folder_writer(str(tmp_path / "t"))}
    for n in (1, 2):
        write_lines(tmp_path / f"in{n}", "a", [payment(n, minute(1))])
        stream.run_fan_out(
            lines(spark, tmp_path / f"in{n}"), writers, str(tmp_path / f"c{n}"), available_now=True
        ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def test_stream_and_batch_land_in_one_folder(spark, tmp_path):
    write_lines(tmp_path / "in", "a", [payment(1, minute(1))])
    land(spark, tmp_path)
    landing.land(parse_envelope(values(spark, [payment(2, minute(2))])), str(tmp_path / "out"))
    write_lines(tmp_path / "in", "b", [payment(3, minute(3))])
    land(spark, tmp_path)
    assert [i for _, i in landed_ids(spark, tmp_path)] == [1, 2, 3]


def test_a_batch_writes_few_files(spark, tmp_path):
    """Not one for each state partition: the micro-batch is joined by size, per type and day."""
    write_lines(tmp_path / "in", "a", [payment(i, minute(1)) for i in range(60)] + [rate(99, minute(1), 410, 1)])
    land(spark, tmp_path)
    assert len(list((tmp_path / "out").glob("*/*/*/*.parquet"))) == 2
    assert len(landed_ids(spark, tmp_path)) == 61


def test_a_repeated_batch_leaves_nothing_of_the_first_attempt(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = [landing.as_landed(parse_envelope(values(spark, [payment(i, when)]))) for i, when in [(1, minute(1)), (2, "2022-10-02 00:00:00")]]
    landing.land_as(rows[0], out, "run", 7)
    landing.land_as(rows[1], out, "run", 8)
    attempts = stream._Attempts()
    attempts.clear(spark, landing.owner_of("run", 7), out)  # what a restart does
    landing.land_as(rows[1], out, "run", 7)
    assert sorted(r.object_id for r in landing.read_all(spark, out).collect()) == [uid(2), uid(2)]
    attempts.clear(spark, landing.owner_of("run", 9), out)  # later batches do not look
    assert landing.drop_owner(spark, out, landing.owner_of("run", 9)) == 0


def stored(query):
    return sum(o["numRowsTotal"] for o in query.recentProgress[-1]["stateOperators"])


def test_landed_mode_equals_exact_and_keeps_no_state(spark, tmp_path):
    """Repeats in a batch, in the next, hours late, and a first arrival that is late."""
    batches = [
        [payment(i, minute(0, 1)) for i in range(200)] + [payment(3, minute(0, 1), status="queued")],
        [payment(500 + i, minute(0, 9)) for i in range(200)] + [rate(3, minute(0, 9), 410, 1)],
        [payment(5, minute(0, 1)), payment(900, minute(0, 2)), payment(505, minute(0, 9)), payment(900, minute(0, 2))],
        [payment(7, "someday", sent="2022-10-01T12:00:00"), payment(7, "someday", sent="2022-10-01T12:00:00")],
        [payment(7, "someday", sent="2022-10-01T12:00:00")],
    ]
    found = {}
    for mode in ("exact", "landed"):
        (tmp_path / mode).mkdir()
        for i, rows in enumerate(batches):
            write_lines(tmp_path / mode / "in", f"b{i}", rows)
            query = land(spark, tmp_path / mode, mode=mode)
        found[mode] = landed_ids(spark, tmp_path / mode)
        # 7 has a day and no day: once for each event day
        assert len(found[mode]) == len(set(found[mode])) + (mode == "landed")
        assert stored(query) == (0 if mode == "landed" else 402)
    assert set(found["landed"]) == set(found["exact"])
    first = landing.read_landing(spark, str(tmp_path / "landed" / "out"), "TRANSACTION", "2022-10-01")
    assert first.filter(F.col("object_id") == uid(3)).count() == 1


def test_landed_keys_open_only_days_of_the_batch(spark, tmp_path):
    out = str(tmp_path / "out")
    for i, day in enumerate(["2022-10-01", "2022-10-02", "2022-10-03"]):
        landing.land(parse_envelope(values(spark, [payment(i, f"{day} 10:00:00")])), out)
    rows = landing.as_landed(parse_envelope(values(spark, [payment(1, "2022-10-02 10:00:00"), payment(8, "2022-10-02 10:00:00")])))
    fresh = landing.not_landed(rows, out)
    assert [r.object_id for r in fresh.collect()] == [uid(8)]
    keys = landing.landed_keys(spark, out, ["TRANSACTION"], ["2022-10-02"])
    assert all("event_date=2022-10-02" in f for f in keys.inputFiles()) and keys.count() == 1
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "payload" not in plan.split("ReadSchema")[1]


def test_late_rows_are_kept_aside(spark, tmp_path):
    late = str(tmp_path / "late")
    for name, rows in [
        ("a", [payment(1, minute(0, 5))]),
        ("b", [payment(2, minute(0, 6)), payment(3, minute(0, 1))]),  # hours late
        ("c", [payment(3, minute(0, 1)), payment(4, minute(56, 5)), payment(5, minute(55, 5)), payment(1, minute(0, 6))]),
    ]:
        write_lines(tmp_path / "in", name, rows)
        land(spark, tmp_path, mode="landed", late_path=late)
    assert [i for _, i in landed_ids(spark, tmp_path)] == [1, 2, 4]
    aside = [(r.object_id, str(r.watermark)) for r in spark.read.parquet(late).collect()]
    assert sorted(aside) == [
        (uid(3), "2022-10-01 04:55:00"),
        (uid(3), "2022-10-01 05:55:00"),
        (uid(5), "2022-10-01 05:55:00"),
    ]
    assert len(list((tmp_path / "checkpoint" / "event_time").iterdir())) == 2
    with pytest.raises(ValueError):
        land(spark, tmp_path, mode="exact", late_path=late)


def test_dropped_rows_are_counted(spark, tmp_path):
    counted = []
    for name, row in [("a", payment(1, minute(0, 5))), ("b", payment(2, minute(0, 6))), ("c", payment(3, minute(0, 1))), ("d", payment(4, minute(0, 1)))]:
        write_lines(tmp_path / "in", name, [row])
        counted.append(stream.dropped_late(land(spark, tmp_path, mode="bounded")))
    assert counted == [0, 0, 1, 1]


@pytest.fixture
def sliced(spark, tmp_path, monkeypatch):
    """Twenty events a day for 30 days in one file; files of a slice hold 20 rows at most."""
    rows = spark.range(600).selectExpr(
        "id AS event_id",
        "timestamp_ntz'2024-01-01 00:10:00' + make_dt_interval(0, 0, 72 * int(id), 0) AS ts",
        "id % 40 AS user_id",
        "element_at(array('view', 'signup', 'click', 'done'), int(id % 4) + 1) AS event_type",
        "id / 2D AS value",
        "concat('{\"k\": ', id % 100, '}') AS props",
    )
    rows.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(query_catalog, "scratch_path", lambda spark, label: str(tmp_path / label))
    monkeypatch.setattr(query_catalog, "SLICE_FILE_ROWS", 20, raising=False)
    return rows


def check_slices(spark, tmp_path):
    """Three batches, each of as many files as its rows need; nothing lost."""
    files = spark.read.parquet(str(tmp_path / "slices")).groupBy(F.input_file_name()).count().collect()
    assert sum(r[1] for r in files) == 600 and max(r[1] for r in files) <= 20
    commits = (tmp_path / "checkpoint" / "commits").iterdir()
    assert sorted(c.name for c in commits if c.name.isdigit()) == ["0", "1", "2"]


def test_late_rows_of_slices_in_many_files(spark, tmp_path, sliced):
    found = {(r.object_id, r.sent_dttm) for r in query_catalog.stream_late_rows(spark, str(tmp_path)).collect()}
    check_slices(spark, tmp_path)
    behind = sliced.filter("event_id % 50 = 0 AND ts < '2024-01-11'")
    sent = event_feed.landed(behind, dirty=True).select("object_id", "sent_dttm").collect()
    assert found == {tuple(r) for r in sent} and len(found) > 1


def test_landed_in_slices_of_many_files(spark, tmp_path, sliced):
    rows = query_catalog.stream_dedup_landed(spark, str(tmp_path)).collect()
    check_slices(spark, tmp_path)
    key = ["object_type", "object_id", "event_date"]
    one_each = landing.as_landed(event_feed.landed(sliced, dirty=True)).select(*key).distinct()
    assert sorted(map(str, rows)) == sorted(map(str, one_each.collect())) and rows
