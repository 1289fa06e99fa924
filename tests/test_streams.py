"""Streaming forms must equal the batch operators."""

import os
import time

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from millrace.operators import dedup, match, tables
from millrace.plans import control, flows, spec
from millrace.sources import ingest
from millrace.streaming import sinks, stateful


@pytest.fixture(scope="module")
def events(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def slices(df, path, parts, shuffled=False):
    """Write ``df`` as files, in time order, with rising modification times."""
    order = F.xxhash64("event_id") if shuffled else F.col("ts")
    ranked = df.withColumn("__n", F.ntile(parts).over(Window.orderBy(order)))
    now = time.time() - 1000
    for n in range(1, parts + 1):
        target = f"{path}/part-{n}"
        ranked.filter(F.col("__n") == n).drop("__n").coalesce(1).write.parquet(target)
        for name in os.listdir(target):
            os.utime(f"{target}/{name}", (now + n, now + n))
    return f"{path}/*"


def run(df, path):
    query = sinks.drain(df, f"{path}/out", f"{path}/ck")
    assert query.exception() is None
    late = sum(int(s.numRowsDroppedByWatermark) for p in query.recentProgress for s in p.stateOperators)
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/out"), late, query


@pytest.mark.parametrize("parts", [1, 6])
def test_dedup_equals_batch(spark, events, tmp_path, parts):
    source = slices(events, f"{tmp_path}/in", parts)
    stream = ingest.file_stream(spark, source, events.schema, files_per_trigger=1)
    out, late, _ = run(
        stateful.dedup_stream(stream, "user_id", "ts", "24h", "event_id", annotate=True), str(tmp_path)
    )
    expected = dedup.dedup_annotate(events, "user_id", "ts", "24h", ["event_id"])
    columns = ["event_id", "is_duplicate", "first_seen", "key_value"]
    assert late == 0
    assert sorted(out.select(columns).collect()) == sorted(expected.select(columns).collect())


def test_held_dedup_equals_batch_on_shuffled_input(spark, events, tmp_path):
    """A far-future event moves the watermark past everything else."""
    end = events.agg(F.max("ts")).first()[0]
    last = events.limit(1).withColumn("ts", F.lit(end) + F.expr("INTERVAL 100 DAY"))
    last = last.withColumns({"event_id": F.lit(-1).cast("bigint"), "user_id": F.lit(-1).cast("bigint")})
    source = slices(events, f"{tmp_path}/in", 4, shuffled=True)
    slices(last, f"{tmp_path}/in/z", 1)
    target = f"{tmp_path}/in/z/part-1"
    for name in os.listdir(target):
        os.utime(f"{target}/{name}")
    spread = ingest.file_stream(spark, f"{tmp_path}/in/{{part-*,z/part-1}}", events.schema, 1)
    held = stateful.dedup_stream(
        spread, "user_id", "ts", "24h", "event_id", delay="40 days", emit="on_watermark"
    )
    out, late, query = run(held, str(tmp_path))
    expected = dedup.dedup_anchor(events, "user_id", "ts", "24h", ["event_id"])
    assert source and late == 0
    ids = {r["event_id"] for r in out.collect()}
    assert ids == {r["event_id"] for r in expected.collect()}
    # All earlier anchors have lapsed; only the last event's rows may remain.
    assert query.recentProgress[-1].stateOperators[0].numRowsTotal <= 4


@pytest.mark.parametrize("parts, small", [(1, 256), (5, 256), (5, 1)])
def test_match_equals_batch(spark, events, tmp_path, monkeypatch, parts, small):
    # A room of one event at most spills to the maps.
    monkeypatch.setattr(stateful.MatchProcessor.__init__, "__defaults__", (False, small))
    source = slices(events, f"{tmp_path}/in", parts)
    stream = ingest.file_stream(spark, source, events.schema, files_per_trigger=1)
    sides = [(df.filter("event_type = 'purchase'"), df.filter("event_type = 'click'"))
             for df in (stream, events)]
    out, late, _ = run(
        stateful.match_stream(*sides[0], "user_id", "ts", "event_id", "6h", delay="40 days"),
        str(tmp_path),
    )
    expected = match.temporal_match(*sides[1], "user_id", "ts", "event_id", "6h")
    got = {(r["left_data"]["event_id"], r["right_data"]["event_id"]) for r in out.collect()}
    assert late == 0
    assert got == {(r["left_id"], r["right_id"]) for r in expected.collect()}


@pytest.mark.parametrize("parts", [1, 4])
def test_interval_join_equals_batch(spark, events, tmp_path, parts):
    source = slices(events, f"{tmp_path}/in", parts)
    stream = ingest.file_stream(spark, source, events.schema, files_per_trigger=1)
    left, right = stream.filter("event_type = 'purchase'"), stream.filter("event_type = 'click'")
    out, late, _ = run(
        match.interval_join_stream(left, right, "user_id", "ts", "6h", delay="40 days"), str(tmp_path)
    )
    expected = match.interval_join_all(
        events.filter("event_type = 'purchase'"), events.filter("event_type = 'click'"),
        "user_id", "ts", "6h",
    )
    pick = ["left_event_id", "right_event_id"]
    assert late == 0
    assert sorted(out.select(pick).collect()) == sorted(expected.select(pick).collect())


def test_unknown_emit_mode(events):
    with pytest.raises(ValueError, match="emit"):
        stateful._check_emit("sometimes")


def test_retries_then_raises(spark):
    waits, calls = [], []

    def broken(df, batch_id):
        calls.append(batch_id)
        raise OSError("down")

    with pytest.raises(OSError):
        sinks.retry_write(broken, 3, waits.append)(spark.range(1), 7)
    assert waits == [1, 4, 9] and calls == [7] * 4


def test_replayed_batch_writes_once(spark, tmp_path):
    write = sinks.folder_writer(f"{tmp_path}/t")
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(3), 1)
    assert sinks.read_folder(spark, f"{tmp_path}/t", spark.range(1).schema).count() == 8


def test_good_and_dead_letters_in_one_batch(spark, tmp_path):
    rows = spark.createDataFrame([(1, None), (2, "bad")], "n int, error_reason string")
    write = sinks.split_writer(
        sinks.folder_writer(f"{tmp_path}/good"), sinks.folder_writer(f"{tmp_path}/bad")
    )
    write(rows, 0)
    assert [r["n"] for r in spark.read.parquet(f"{tmp_path}/good/batch_id=0").collect()] == [1]
    assert [r["n"] for r in spark.read.parquet(f"{tmp_path}/bad/batch_id=0").collect()] == [2]


def test_flow_manager(spark, tmp_path):
    path = f"{tmp_path}/topic"
    rows = [("k", '{"id":"a","user":1}', "t", 0, 0), ("k", '{"id":"b","user":1}', "t", 0, 1)]
    topic = spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset bigint"
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp"))
    topic.write.parquet(path)
    stream = ingest.topic_files(spark, path)
    one = spec.parse(
        {
            "name": "one",
            "source": {"type": "kafka", "topic": "t"},
            "processing": {"deduplication": {"key": "user", "time_window": "1h"}},
            "sink": {"type": "kafka", "topic": "out"},
        }
    )
    manager = control.FlowManager(spark, f"{tmp_path}/ck")
    manager.create(one, {"t": stream}, sinks.folder_writer(f"{tmp_path}/out"), interval="1 second")
    with pytest.raises(ValueError, match="already exists"):
        manager.create(one, {"t": stream}, sinks.folder_writer(f"{tmp_path}/out"))
    assert manager.status("one") == control.RUNNING
    with pytest.raises(ValueError, match="already running"):
        manager.start("one")
    manager.drain("one")
    assert manager.list().first()["events"] == 2
    manager.stop("one")
    assert manager.status("one") == control.STOPPED
    topic.withColumn("offset", F.col("offset") + 2).write.mode("append").parquet(path)
    manager.start("one", interval="1 second")
    manager.drain("one")
    manager.delete("one")
    with pytest.raises(KeyError):
        manager.stop("one")
    out = spark.read.schema("key string, value string").parquet(f"{tmp_path}/out").collect()
    assert [r["key"] for r in out] == ["a"]


def test_flow_writes_table_rows_and_dead_letters(spark, tmp_path):
    values = ['{"id":"a","user":1,"n":5}', "not json", '{"id":"b"}', '{"id":"c","user":2,"n":"many"}',
              '{"user":3,"n":1}', "[1]"]
    rows = [("k", v, "t", 0, i) for i, v in enumerate(values)]
    spark.createDataFrame(
        rows, "key string, value string, topic string, partition int, offset bigint"
    ).withColumn("timestamp", F.lit("2024-01-01").cast("timestamp")).write.parquet(f"{tmp_path}/topic")
    flow = spec.parse(
        {
            "name": "rows",
            "source": {"type": "kafka", "topic": "t"},
            "processing": {"deduplication": {"key": "user", "time_window": "1h"}},
            "sink": {"type": "clickhouse", "table": "rows"},
        }
    )
    table = tables.TableSpec(
        "rows", (tables.ColumnSpec("id", "string", nullable=False), tables.ColumnSpec("n", "bigint")), ("id",)
    )
    manager = control.FlowManager(spark, f"{tmp_path}/ck")
    topics = {"t": ingest.topic_files(spark, f"{tmp_path}/topic")}
    manager.create(flow, topics, sinks.folder_writer(f"{tmp_path}/out"), "1 second", table=table)
    manager.drain("rows")
    manager.stop("rows")
    letters = manager.dead_letters("rows")
    good = spark.read.schema("id string, n bigint").parquet(f"{tmp_path}/out").collect()
    assert [(r["id"], r["n"]) for r in good] == [("a", 5)]
    assert sorted(r["value"] for r in letters["record"].collect()) == sorted([values[1], values[2], values[5]])
    assert letters["table"].count() == 2 and letters["table"].filter("error_reason IS NULL").count() == 0
    assert manager.status("rows") == control.STOPPED


def test_failed_flow_says_so(spark, tmp_path):
    spark.createDataFrame([], ingest.TOPIC_SCHEMA).write.parquet(f"{tmp_path}/topic")
    row = [("k", "{}", "t", 0, 0)]
    spark.createDataFrame(row, "key string, value string, topic string, partition int, offset bigint") \
        .withColumn("timestamp", F.current_timestamp()).write.mode("append").parquet(f"{tmp_path}/topic")
    flow = spec.parse(
        {"name": "bad", "source": {"type": "kafka", "topic": "t"}, "sink": {"type": "clickhouse"}}
    )
    manager = control.FlowManager(spark, f"{tmp_path}/ck")

    def broken(df, batch_id):
        raise OSError("down")

    manager._flows["bad"] = entry = control._Entry(
        flows.compile_flow(flow, {"t": ingest.topic_files(spark, f"{tmp_path}/topic")}),
        broken, f"{tmp_path}/ck/bad",
    )
    entry.query = sinks.start_sink(
        flows.sink_rows(entry.flow), broken, entry.checkpoint, "bad", None, max_retries=0
    )
    with pytest.raises(Exception, match="down"):
        entry.query.awaitTermination()
    assert manager.status("bad") == control.FAILED


def test_late_partners_still_match(spark, tmp_path):
    """A pair whose halves come in the wrong order, in two micro-batches; an
    event further away than the window is left alone."""
    rows = [[("a", 1, "l", "10:05"), ("a", 2, "l", "10:30")], [("a", 3, "r", "10:01"), ("a", 4, "r", "10:20")]]
    now = time.time() - 1000
    for n, batch in enumerate(rows):
        frame = spark.createDataFrame(batch, "k string, id long, side string, at string")
        frame = frame.withColumn("ts", F.to_timestamp(F.concat(F.lit("2024-01-01 "), "at"), "yyyy-MM-dd HH:mm"))
        frame.coalesce(1).write.parquet(f"{tmp_path}/in/part-{n}")
        for name in os.listdir(f"{tmp_path}/in/part-{n}"):
            os.utime(f"{tmp_path}/in/part-{n}/{name}", (now + n, now + n))
    stream = ingest.file_stream(spark, f"{tmp_path}/in/*", frame.schema, files_per_trigger=1)
    sides = [stream.filter(F.col("side") == s) for s in "lr"]
    joined = stateful.match_stream(*sides, "k", "ts", "id", "5m", delay="1 hour")
    out, late, _ = run(joined, str(tmp_path))
    assert late == 0
    assert [(r["joined_id"], r["join_delay"]) for r in out.collect()] == [("joined_1_3", 240_000_000_000)]


def arriving(spark, batches, path):
    """A stream with one micro-batch for each list of (key, id, side, "day hh:mm")."""
    now = time.time() - 1000
    for n, batch in enumerate(batches):
        frame = spark.createDataFrame(batch, "k string, id long, side string, at string")
        frame = frame.withColumn("ts", F.to_timestamp(F.concat(F.lit("2024-01-"), "at"), "yyyy-MM-dd HH:mm"))
        frame.coalesce(1).write.parquet(f"{path}/in/part-{n}")
        for name in os.listdir(f"{path}/in/part-{n}"):
            os.utime(f"{path}/in/part-{n}/{name}", (now + n, now + n))
    return ingest.file_stream(spark, f"{path}/in/*", frame.schema, files_per_trigger=1)


@pytest.mark.parametrize("emit", ["eager", "on_watermark"])
def test_no_row_is_too_late_to_be_judged(spark, tmp_path, emit):
    """Rows hours behind the watermark: kept if nothing is known of their key or
    their own, also late, anchor blocks them; none is lost."""
    batches = [[("a", 1, "", "01 10:00")], [("b", 2, "", "01 15:00")], [("late", 3, "", "01 08:00")],
               [("late", 4, "", "01 08:10"), ("a", 5, "", "01 11:30")], [("z", 6, "", "03 00:00")],
               [("b", 7, "", "01 15:30")]]  # its anchor goes after this batch's rows
    stream = arriving(spark, batches, tmp_path)
    out, late, _ = run(stateful.dedup_stream(stream, "k", "ts", "1h", "id", emit=emit, annotate=True), str(tmp_path))
    got = {r["id"]: r["is_duplicate"] for r in out.collect()}
    assert late == 0
    expected = {1: False, 2: False, 3: False, 4: True, 5: False, 6: False, 7: True}
    # The newest row stays held: no watermark passes it.
    assert got == {i: d for i, d in expected.items() if emit == "eager" or i != 6}


def test_default_delay_loses_no_partner(spark, tmp_path):
    """The slower side is nearly two windows behind and still finds its partner;
    one that no waiting event can match is counted as late."""
    batches = [[("a", 1, "l", "01 10:00"), ("a", 2, "l", "01 20:00"), ("a", 3, "r", "01 20:00")],
               [("b", 4, "l", "01 19:00"), ("b", 5, "r", "01 20:10")],
               [("b", 6, "r", "01 18:10"), ("a", 7, "r", "01 09:30")]]
    stream = arriving(spark, batches, tmp_path)
    joined = stateful.match_stream(
        *[stream.filter(F.col("side") == s) for s in "lr"], "k", "ts", "id", "1h"
    )
    out, late, _ = run(joined, str(tmp_path))
    assert {r["joined_id"] for r in out.collect()} == {"joined_2_3", "joined_4_6"}
    assert late == 1
