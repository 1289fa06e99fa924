"""The anchor scan against a plain loop, and its invariants."""

import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators import dedup, hotkeys

START = datetime(2024, 1, 1)


def loop(rows, window):
    """(key, micros, id) -> kept ids, by taking events one at a time."""
    anchors, kept = {}, set()
    for key, at, event in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if key not in anchors or at - anchors[key] > window:
            anchors[key] = at
            kept.add(event)
    return kept


def frame(spark, rows):
    data = [(k, START + timedelta(microseconds=t), i) for k, t, i in rows]
    return spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint")


def random_rows(n, keys, span, seed):
    rng = random.Random(seed)
    return [(rng.choice(keys), rng.randrange(span), i) for i in range(n)]


@given(
    st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 60)), min_size=1, max_size=80),
    st.integers(0, 20),
    st.integers(1, 7),
)
@settings(max_examples=200, deadline=None)
def test_scan_matches_loop_for_any_batching(rows, window, size):
    rows = sorted((k, t, i) for i, (k, t) in enumerate(rows))
    scan, kept = dedup.AnchorScan(window), set()
    for s in range(0, len(rows), size):
        part = rows[s : s + size]
        keep, seen = scan.mark(
            pa.array([r[0] for r in part]),
            np.zeros(len(part), dtype=np.int32),
            np.array([r[1] for r in part], dtype=np.int64),
        )
        kept |= {part[i][2] for i in np.flatnonzero(keep)}
        assert all(0 <= r[1] - a <= window for r, a in zip(part, seen))
    assert kept == loop(rows, window)


def test_wide_time_spans_do_not_overflow():
    far = 1 << 60
    keys = pa.array([str(i) for i in range(64)])
    at = np.array([far * (i % 2) for i in range(64)], dtype=np.int64)
    keep, _ = dedup.AnchorScan(10).mark(keys, np.zeros(64, dtype=np.int32), at)
    assert keep.all()


@pytest.mark.parametrize("window", [0, 5, 40, 400, 5000])
@pytest.mark.parametrize("budget", [dedup.STEP_BUDGET, 0])
def test_cut_keys_give_the_same_rows(spark, monkeypatch, window, budget):
    """``budget`` 0 leaves room for four steps a slice, so that slices have to
    be asked one by one."""
    monkeypatch.setattr(dedup, "STEP_BUDGET", budget)
    rows = random_rows(3000, ["hot"] * 8 + ["b", "c"], 9000, window)
    df = frame(spark, rows)
    got = dedup.dedup_anchor(df, "k", "ts", window * 1000, ["id"], hot_rows=300)
    assert {r["id"] for r in got.collect()} == loop(rows, window)


def test_cut_keys_carry_over_small_batches(spark):
    rows = random_rows(700, ["hot"] * 6 + list("bc"), 5000, 11)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        got = dedup.dedup_anchor(frame(spark, rows), "k", "ts", 60_000, ["id"], hot_rows=80)
        assert {r["id"] for r in got.collect()} == loop(rows, 60)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_partitioning_does_not_matter(spark, partitions):
    rows = random_rows(800, list("abcdefgh"), 3000, 1)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = dedup.dedup_anchor(frame(spark, rows), "k", "ts", 50_000, ["id"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert {r["id"] for r in got} == loop(rows, 50)


def test_edges(spark):
    """Exactly a window apart is a duplicate, one microsecond more is not; the
    anchor does not slide; nulls equal each other; '1' equals 1."""
    hour = 3_600_000_000
    rows = [("a", 0, 1), ("a", hour, 2), ("a", 2 * hour, 3), ("b", 0, 4), ("b", hour + 1, 5)]
    rows += [(None, 0, 6), (None, 5, 7), ("c", 9, 9), ("c", 9, 8)]
    out = dedup.dedup_annotate(frame(spark, rows), "k", "ts", "1h", ["id"]).collect()
    dropped = {r["id"] for r in out if r["is_duplicate"]}
    assert dropped == {2, 7, 9}
    assert {r["key_value"] for r in out if r["id"] in (6, 7)} == {"null"}
    first = {r["id"]: r["first_seen"] for r in out}
    assert first[2] == START and first[3] == START + timedelta(hours=2)


def test_twice_is_once_and_empty_is_empty(spark):
    rows = random_rows(500, list("abc"), 3000, 2)
    once = dedup.dedup_anchor(frame(spark, rows), "k", "ts", 100_000, ["id"])
    twice = dedup.dedup_anchor(once, "k", "ts", 100_000, ["id"])
    assert {r["id"] for r in once.collect()} == {r["id"] for r in twice.collect()}
    empty = frame(spark, rows).filter("id < 0")
    assert dedup.dedup_anchor(empty, "k", "ts", "1h", ["id"]).count() == 0


def test_known_counts(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    assert dedup.dedup_anchor(events, "user_id", "ts", "24h", ["event_id"]).count() == 3128
    assert dedup.dedup_anchor(events, "event_type", "ts", "24h", ["event_id"]).count() == 150


def test_sketch_finds_hot_keys_only(spark):
    df = spark.range(4000).selectExpr(
        "case when id % 3 = 0 then 'hot' else cast(id as string) end k", "id * 10 as at"
    )
    grid = hotkeys.find_hot_keys(df, "k", "at", hot_rows=500)
    assert set(grid.grid) == {"hot"}
    cut = grid.slice_column(df, "k", df["at"], "s")
    sizes = {r["s"]: r["count"] for r in cut.groupBy("s").count().collect()}
    assert len(sizes) > 5 and max(n for s, n in sizes.items() if s) < 500


def test_bunched_times_are_cut_evenly(spark):
    """Nine tenths of a key's rows lie in a thousandth of its time."""
    df = spark.range(40_000).selectExpr(
        "'hot' as k", "case when id % 10 = 0 then id * 1000 else 20000000 + id end as at"
    )
    grid = hotkeys.find_hot_keys(df, "k", "at", hot_rows=4000)
    sizes = [r["count"] for r in grid.slice_column(df, "k", df["at"], "s").groupBy("s").count().collect()]
    assert len(sizes) > 35 and max(sizes) < 2000


def test_slices_do_not_cost_a_job_each(spark):
    rows = [("hot", 7 * i, i) for i in range(20_000)]
    df = frame(spark, rows)
    tracker, group = spark.sparkContext.statusTracker(), "hot-jobs"
    spark.sparkContext.setJobGroup(group, "")
    try:
        got = dedup.dedup_anchor(df, "k", "ts", 400_000, ["id"], hot_rows=2000)
        assert {r["id"] for r in got.collect()} == loop(rows, 400)
        assert len(tracker.getJobIdsForGroup(group)) < 30
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_slices_span_some_windows_and_no_more_rows_than_a_task_takes(monkeypatch):
    """Slices far below a window would be asked one after another, a job for each."""
    cuts = tuple(range(0, 100_000, 10))
    grid = hotkeys.HotKeys({"a": cuts, "b": (5,)}, hot_rows=1000)
    wide = grid.coarser(8_000)
    assert wide.grid == {"a": tuple(range(0, 100_000, 8_000)), "b": (5,)}
    monkeypatch.setattr(hotkeys, "HOT_ROWS", 50_000)
    assert grid.coarser(8_000).grid["a"] == cuts[::50]
    assert hotkeys.HotKeys({"a": cuts}, hot_rows=50_000).coarser(8_000).grid["a"] == cuts
