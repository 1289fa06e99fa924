"""The topic log: gapless offsets, restarts, replays, ranges and retention."""

import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from millrace.sources import topic_log
from millrace.streaming import sinks

DAY = "CAST(TIMESTAMP'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS timestamp)"


def rows(spark, low, high, partitions=3):
    """Records ``low`` to ``high - 1``: key is the id, value a text, one each second."""
    return spark.range(low, high).selectExpr(
        "CAST(id AS string) AS key", "concat('v', id) AS value", f"{DAY} AS timestamp",
        f"CAST(id % {partitions} AS int) AS p", "id",
    )


def put(df, root, topic="t", **more):
    topic_log.append(df, str(root), topic, 3, F.col("p"), **more)


def offsets(spark, root, topic="t", **options):
    out = topic_log.read_log(spark, str(root), topic, **options)
    return sorted((r["partition"], r["offset"], r["key"]) for r in out.collect())


def test_offsets_have_no_gaps_and_follow_the_order(spark, tmp_path):
    put(rows(spark, 0, 1000).orderBy(F.rand(3)), tmp_path, order=["id"], tasks=7)
    put(rows(spark, 1000, 1100).orderBy(F.rand(4)), tmp_path, order=["id"], tasks=2)
    expected = sorted((i % 3, i // 3, str(i)) for i in range(1100))
    assert offsets(spark, tmp_path) == expected


def test_unordered_append_keeps_every_row_once(spark, tmp_path):
    frame = rows(spark, 0, 5000).repartition(9)
    put(frame, tmp_path)
    found = offsets(spark, tmp_path)
    assert sorted(int(k) for _, _, k in found) == list(range(5000))
    for p in range(3):
        own = [o for q, o, _ in found if q == p]
        assert own == list(range(len(own)))


def test_hot_partition_is_written_by_many_tasks(spark, tmp_path):
    frame = rows(spark, 0, 3000, partitions=1)
    put(frame, tmp_path, order=["id"], tasks=6)
    log = topic_log.TopicFolder(str(tmp_path), "t")
    assert len(log.segments(log.starts(), log.ends())) >= 5
    assert offsets(spark, tmp_path) == [(0, i, str(i)) for i in range(3000)]


def test_nulls_and_empty_input(spark, tmp_path):
    assert offsets(spark, tmp_path) == []
    put(rows(spark, 0, 0), tmp_path)
    assert offsets(spark, tmp_path) == []
    blank = spark.createDataFrame(
        [(None, None, None), (None, "", None), ("k", None, None)], "key string, value string, timestamp timestamp"
    )
    topic_log.append(blank, str(tmp_path), "t", 4)
    out = topic_log.read_log(spark, str(tmp_path), "t")
    assert sorted(map(str, ((r.key, r.value, r.timestamp) for r in out.collect()))) == sorted(
        map(str, [(None, None, None), (None, "", None), ("k", None, None)])
    )
    assert all(0 <= r.partition < 4 for r in out.collect())
    assert out.filter("timestamp > TIMESTAMP'2000-01-01'").count() == 0


def test_ranges_cut_segments_and_row_groups(spark, tmp_path, monkeypatch):
    put(rows(spark, 0, 300), tmp_path, order=["id"], tasks=3)
    put(rows(spark, 300, 600), tmp_path, order=["id"], tasks=3)
    found = offsets(spark, tmp_path, startingOffsets='{"0": 150, "1": 7}', endingOffsets='{"0": 160, "2": 0}')
    assert found == [(0, o, str(3 * o)) for o in range(150, 160)] + [
        (1, o, str(3 * o + 1)) for o in range(7, 200)
    ]
    when = datetime(2024, 1, 1, 0, 5, tzinfo=timezone.utc).isoformat()
    assert offsets(spark, tmp_path, startingTimestamp=when) == sorted(
        (i % 3, i // 3, str(i)) for i in range(300, 600)
    )


def test_filters_leave_out_segments(spark, tmp_path):
    put(rows(spark, 0, 300), tmp_path, order=["id"], tasks=3)
    put(rows(spark, 300, 600), tmp_path, order=["id"], tasks=3)
    everything = topic_log.read_log(spark, str(tmp_path), "t")
    for test, few in (
        ("partition = 1", True),
        ("partition IN (0, 2) AND offset >= 190", True),
        ("offset = 3", True),
        ("timestamp >= TIMESTAMP'2024-01-01 00:09:00'", True),
        ("timestamp < TIMESTAMP'2024-01-01 00:00:10' AND partition = 2", True),
        ("value LIKE '%7'", False),
    ):
        part = everything.filter(test)
        plain = spark.createDataFrame(everything.collect(), everything.schema).filter(test)
        assert sorted(part.collect()) == sorted(plain.collect()) and part.count()
        assert (part.rdd.getNumPartitions() < everything.rdd.getNumPartitions()) == few


def test_row_groups_of_a_segment(spark, tmp_path, monkeypatch):
    """Pieces that begin and end inside row groups."""
    log = topic_log.TopicFolder(str(tmp_path), "t")
    batches = rows(spark, 0, 1000, 1).withColumn("partition", F.lit(5)).drop("p", "id").toArrow().to_batches(90)
    monkeypatch.setattr(topic_log, "GROUP_ROWS", 64)
    monkeypatch.setattr(topic_log, "SEGMENT_ROWS", 400)
    monkeypatch.setattr(topic_log, "TASK_ROWS", 130)
    log.commit(topic_log._write(log, batches).segments)
    parts = log.segments({}, log.ends())
    assert [p.base for p in parts] == sorted(p.base for p in parts) and len(parts) > 1
    for low, high in ((0, 1000), (63, 65), (399, 801), (999, 1000), (10, 10)):
        start, end = {"5": low}, {"5": high}
        pieces = topic_log._pieces(log.segments(start, end), start, end)
        got = [o for piece in pieces for b in topic_log._read(log, piece) for o in b["offset"].to_pylist()]
        assert got == list(range(low, high))
        assert all(piece.value[4] - piece.value[3] <= 130 for piece in pieces)


def stream_into(spark, root, cap=None, start="earliest", **options):
    stream = topic_log.log_stream(spark, str(root), "t", start, cap, **options)
    query = sinks.start_sink(
        stream, sinks.folder_writer(f"{root}/out"), f"{root}/ck", interval="0 seconds"
    )
    return query, stream.schema


def test_restart_neither_loses_nor_repeats(spark, tmp_path):
    """Bounded micro-batches over three appends, stopped and started in between."""
    sizes = []
    for n in range(3):
        put(rows(spark, 300 * n, 300 * n + 300), tmp_path, order=["id"], tasks=2)
        query, schema = stream_into(spark, tmp_path, cap=120)
        query.processAllAvailable()
        sizes += [p.numInputRows for p in query.recentProgress if p.numInputRows]
        query.stop()
    assert max(sizes) <= 120 and sum(sizes) == 900
    out = sinks.read_folder(spark, f"{tmp_path}/out", schema)
    assert sorted((r.partition, r.offset, r.key) for r in out.collect()) == sorted(
        (i % 3, i // 3, str(i)) for i in range(900)
    )


def test_uncommitted_batch_is_read_again(spark, tmp_path):
    put(rows(spark, 0, 90), tmp_path, order=["id"], tasks=2)
    failing = {"left": 1}
    write = sinks.folder_writer(f"{tmp_path}/out")

    def broken(df, batch_id):
        if batch_id == 1 and failing["left"]:
            failing["left"] -= 1
            raise RuntimeError("lost")
        write(df, batch_id)

    for attempt in range(2):
        stream = topic_log.log_stream(spark, str(tmp_path), "t", "earliest", 30)
        query = sinks.start_sink(stream, broken, f"{tmp_path}/ck", interval="0 seconds", max_retries=0)
        if attempt == 0:
            with pytest.raises(Exception, match="lost"):
                query.processAllAvailable()
            put(rows(spark, 90, 120), tmp_path, order=["id"], tasks=1)
        else:
            query.processAllAvailable()
        query.stop()
    out = sinks.read_folder(spark, f"{tmp_path}/out", stream.schema)
    assert sorted(int(r.key) for r in out.collect()) == list(range(120))


def test_latest_starts_behind_what_is_there(spark, tmp_path):
    put(rows(spark, 0, 30), tmp_path)
    query, schema = stream_into(spark, tmp_path, start="latest")
    query.processAllAvailable()
    put(rows(spark, 30, 60), tmp_path)
    query.processAllAvailable()
    query.stop()
    out = sinks.read_folder(spark, f"{tmp_path}/out", schema)
    assert sorted(int(r.key) for r in out.collect()) == list(range(30, 60))


def test_replayed_batch_is_committed_once(spark, tmp_path):
    log = topic_log.TopicFolder(str(tmp_path), "t")
    batch = rows(spark, 0, 9).withColumnRenamed("p", "partition").toArrow().to_batches()
    sink = topic_log.LogStreamWriter(log, "w")
    for _ in range(3):
        sink.commit([sink.write(iter(batch)), None], 4)
    assert log.ends() == {"0": 3, "1": 3, "2": 3}
    assert len(os.listdir(log.data)) == 3
    sink.commit([sink.write(iter(batch))], 5)
    topic_log.LogStreamWriter(log, "other").commit([sink.write(iter(batch))], 0)
    assert log.ends() == {"0": 9, "1": 9, "2": 9}


def test_two_writers_take_turns(spark, tmp_path, monkeypatch):
    log = topic_log.TopicFolder(str(tmp_path), "t")
    log.commit([("a", 0, 5, 0, 1, False)])
    plain, raced = topic_log.TopicFolder.newest, []

    def stale(self):
        """The other writer commits between the look at the log and the commit."""
        number = plain(self)
        if not raced:
            raced.append(1)
            log.commit([("b", 0, 7, 0, 1, False)])
        return number

    monkeypatch.setattr(topic_log.TopicFolder, "newest", stale)
    log.commit([("c", 0, 2, 0, 1, False)])
    assert [(s.file, s.base) for s in log.segments({}, log.ends())] == [("a", 0), ("b", 5), ("c", 12)]


def test_expired_segments(spark, tmp_path):
    put(rows(spark, 0, 300), tmp_path, order=["id"], tasks=3)
    put(rows(spark, 300, 600), tmp_path, order=["id"], tasks=3)
    log = topic_log.TopicFolder(str(tmp_path), "t")
    files = len(os.listdir(log.data))
    first = log.expire(datetime(2024, 1, 1, 0, 5, tzinfo=timezone.utc))
    assert first == {"0": 100, "1": 100, "2": 100} and len(os.listdir(log.data)) < files
    assert offsets(spark, tmp_path) == sorted((i % 3, i // 3, str(i)) for i in range(300, 600))
    with pytest.raises(Exception, match="have expired"):
        offsets(spark, tmp_path, startingOffsets='{"0": 99, "1": 100, "2": 100}')
    loose = offsets(spark, tmp_path, startingOffsets='{"0": 99}', failOnDataLoss="false")
    assert loose == sorted((i % 3, i // 3, str(i)) for i in range(300, 600))
    put(rows(spark, 600, 603), tmp_path)
    assert log.ends() == {"0": 201, "1": 201, "2": 201}


def test_refused(spark, tmp_path):
    for name in ("", "a/b", ".x"):
        with pytest.raises(ValueError, match="no name"):
            topic_log.TopicFolder(str(tmp_path), name)
    with pytest.raises(ValueError, match="mounted"):
        topic_log.TopicFolder("hdfs://host/x", "t")
    assert topic_log.TopicFolder(f"file://{tmp_path}", "t").root == f"{tmp_path}/t"
