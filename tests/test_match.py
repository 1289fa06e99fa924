"""One-to-one matching against a plain loop, and its invariants."""

import random
from datetime import datetime, timedelta

import numpy as np
import pyarrow as pa
import pytest

from millrace.operators import match

START = datetime(2024, 1, 1)


def loop(rows, window, replace=False):
    """(key, at, id, side) -> pairs, by taking events one at a time."""
    waiting, pairs = {}, set()
    for key, at, event, side in sorted(rows, key=lambda r: (r[0], r[1], r[2], r[3])):
        own = waiting.setdefault((key, side), [])
        other = waiting.setdefault((key, 1 - side), [])
        for buffer in (own, other):
            buffer[:] = [w for w in buffer if at - w[0] <= window]
        if other:
            taken = other.pop(0)
            pair = ((event, at), (taken[1], taken[0]))
            pairs.add(pair if side == 0 else pair[::-1])
            continue
        if replace:
            own[:] = [w for w in own if w[1] != event]
        own.append((at, event))
    return pairs


def frames(spark, rows):
    def side(n):
        data = [(k, START + timedelta(microseconds=t), i) for k, t, i, s in rows if s == n]
        return spark.createDataFrame(data, "k string, ts timestamp_ntz, id bigint")

    return side(0), side(1)


def found(ledger):
    def at(value):
        return int((value - START) / timedelta(microseconds=1))

    return {
        ((r["left_id"], at(r["left_time"])), (r["right_id"], at(r["right_time"])))
        for r in match.pairs(ledger).collect()
    }


def random_rows(n, keys, span, seed, ids=None, lean=0.5):
    rng = random.Random(seed)
    return [
        (rng.choice(keys), rng.randrange(span), rng.randrange(ids) if ids else i,
         int(rng.random() < lean))
        for i in range(n)
    ]


@pytest.mark.parametrize("window", [0, 3, 30, 500])
@pytest.mark.parametrize("lean", [0.5, 0.2])
def test_matches_loop(spark, window, lean):
    rows = random_rows(1500, list("abcdef"), 4000, window, lean=lean)
    left, right = frames(spark, rows)
    ledger = match.match_ledger(left, right, "k", "ts", "id", window * 1000, unique_ids=True)
    assert found(ledger) == loop(rows, window)


@pytest.mark.parametrize("window", [0, 25, 700])
@pytest.mark.parametrize("hot_rows", [None, 60])
def test_state_carries_over_small_batches(spark, window, hot_rows):
    rows = random_rows(600, ["hot"] * 6 + list("bcd"), 3000, window, lean=0.4)
    left, right = frames(spark, rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        ledger = match.match_ledger(
            left, right, "k", "ts", "id", window * 1000, unique_ids=True, hot_rows=hot_rows
        )
        assert found(ledger) == loop(rows, window)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)


def one_by_one(q, step, low, high):
    states = []
    for d, lo, hi in zip(step, low, high):
        q = min(max(q, lo), hi)
        states.append(q)
        q += d
    return states, q


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
@pytest.mark.parametrize("room", [0, 1, 5, 400])
def test_prefix_scan_equals_the_loop(n, room):
    rng = np.random.default_rng(n * 1000 + room)
    for lean in (0.1, 0.5, 0.9):
        step = np.where(rng.random(n) < lean, 1, -1)
        low, high = -rng.integers(0, room + 1, n), rng.integers(0, room + 1, n)
        q = int(rng.integers(-room, room + 1))
        states, last = match._walk(q, step, low, high)
        assert (states.tolist(), last) == one_by_one(q, step.tolist(), low.tolist(), high.tolist())
        moved = np.cumsum(step) - step
        a, b = match._composed(low - moved, high - moved)
        assert min(max(q, a), b) + int(step.sum()) == last


def test_far_apart_times_split_the_batch():
    far = 1 << 58
    at = np.array([far * (i % 2) for i in range(64)], dtype=np.int64)
    keys = pa.array([str(i // 2) for i in range(64)])
    rank, partner = match.WindowScan(far).feed(keys, at, np.array([0, 1] * 32, dtype=np.int32))
    assert list(rank) == [1] * 64 and list(partner) == [0, 1] * 32


@pytest.mark.parametrize("window", [0, 10, 200, 3000])
def test_cut_keys_give_the_same_pairs(spark, window):
    rows = random_rows(2500, ["hot"] * 7 + ["b"], 6000, window, lean=0.4)
    left, right = frames(spark, rows)
    ledger = match.match_ledger(
        left, right, "k", "ts", "id", window * 1000, unique_ids=True, hot_rows=200
    )
    assert found(ledger) == loop(rows, window)


@pytest.mark.parametrize("partitions", [1, 4, 17])
def test_partitioning_does_not_matter(spark, partitions):
    rows = random_rows(600, list("abcd"), 2000, 5)
    left, right = frames(spark, rows)
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = found(match.match_ledger(left, right, "k", "ts", "id", 40_000, unique_ids=True))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 8)
    assert got == loop(rows, 40)


@pytest.mark.parametrize("ids", [3, 40])
def test_repeated_ids_replace(spark, ids):
    rows = random_rows(800, list("abc"), 5000, ids, ids=ids)
    left, right = frames(spark, rows)
    ledger = match.match_ledger(left, right, "k", "ts", "id", 60_000)
    assert found(ledger) == loop(rows, 60, replace=True)
    assert ledger.count() == len(rows)


def test_ledger_invariants(spark):
    rows = random_rows(1000, list("abc"), 3000, 9)
    left, right = frames(spark, rows)
    ledger = match.match_ledger(left, right, "k", "ts", "id", 25_000).collect()
    assert len(ledger) == len(rows)
    used = [(r["side"], r["event_id"]) for r in ledger]
    assert len(set(used)) == len(used)
    for r in ledger:
        if r["is_joined"]:
            assert abs(r["event_time"] - r["matched_time"]) <= timedelta(microseconds=25)
            assert r["orphan_on_arrival"] == (
                (r["event_time"], r["event_id"]) < (r["matched_time"], r["matched_id"])
            )
    left_over = [r for r in ledger if not r["is_joined"]]
    for a in left_over:
        for b in left_over:
            if a["join_key"] == b["join_key"] and a["side"] != b["side"]:
                assert abs(a["event_time"] - b["event_time"]) > timedelta(microseconds=25)


def test_two_lefts_one_right(spark):
    rows = [("a", 0, 1, 0), ("a", 1, 2, 0), ("a", 2, 3, 1), (None, 0, 4, 0), (None, 1, 5, 1)]
    left, right = frames(spark, rows)
    ledger = match.match_ledger(left, right, "k", "ts", "id", 10_000)
    assert found(ledger) == {((1, 0), (3, 2)), ((4, 0), (5, 1))}
    assert [r["event_id"] for r in match.orphans_final(ledger).collect()] == [2]
    metrics = match.join_metrics(ledger).first()
    assert metrics["successful_joins"] == 2 and metrics["state_store_size"] == 1
    stats = match.join_stats(match.join_metrics(ledger), "10s").first()
    assert stats["join_rate_percent"] == 40.0 and stats["match_rate_percent"] == 80.0


def test_interval_join_with_salt(spark):
    rows = random_rows(600, list("ab"), 2000, 4)
    left, right = frames(spark, rows)
    expected = {
        (a[2], b[2]) for a in rows for b in rows
        if a[3] == 0 and b[3] == 1 and a[0] == b[0] and abs(a[1] - b[1]) <= 30
    }
    for salt in (1, 5):
        got = match.interval_join_all(left, right, "k", "ts", 30_000, salt=salt)
        pairs = [(r["left_id"], r["right_id"]) for r in got.collect()]
        assert len(pairs) == len(set(pairs)) and set(pairs) == expected


def test_known_counts(spark):
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    left = events.filter("event_type = 'purchase'")
    right = events.filter("event_type = 'click'")
    assert match.temporal_match(left, right, "user_id", "ts", "event_id", "6h").count() == 379
    assert match.interval_join_all(left, right, "user_id", "ts", "1h").count() == 62


def test_arrivals_out_of_order():
    """Partners lie within the window on either side, oldest first."""
    room = match.WaitingRoom(60, ordered=False)
    assert room.arrive(0, "l1", 0) is None and room.arrive(0, "l2", 600) is None
    assert room.arrive(1, "r1", 30)[:2] == ("l1", 0)
    assert room.arrive(1, "r2", 300) is None
    assert room.arrive(1, "r3", 541)[:2] == ("l2", 600)
    assert room.arrive(0, "l3", 250)[:2] == ("r2", 300)
    assert room.arrive(0, "l4", 900) is None and room.arrive(0, "l4", 100) is None
    assert room.arrive(1, "r4", 900) is None and room.arrive(1, "r5", 160)[:2] == ("l4", 100)


def test_payloads_come_from_their_own_key(spark):
    rows = [(k, t, i, side) for k in "ab" for i, t, side in [(1, 0, 0), (1, 0, 1), (1, 0, 0)]]
    left, right = frames(spark, rows)
    pairs = match.temporal_match(left, right, "k", "ts", "id", 10_000)
    out = match.joined_projection(pairs, left, right, "ts", "id", "k").collect()
    assert len(out) == 2
    assert all(r["left_data"]["k"] == r["join_key"] == r["right_data"]["k"] for r in out)


def test_repeated_ids_stay_with_their_key_when_a_join_changes_while_it_runs(spark):
    """The split of keys with repeats begins as a merge join and is broadcast once
    its size is known, which leaves rows where they were written."""
    rows = random_rows(4000, [f"k{i}" for i in range(40)], 400_000, 11, ids=3)
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
        "spark.sql.files.maxPartitionBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name, None) for name in changed}
    left, right = frames(spark, rows)
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        got = found(match.match_ledger(left, right, "k", "ts", "id", 10_000_000))
        plain = [(k, at, i, side) for i, (k, at, _, side) in enumerate(rows)]
        # One key repeats an id, so the others go through the same split.
        mixed = [*plain, *[("twice", at, 7, at % 2) for at in range(0, 100_000, 500)]]
        left, right = frames(spark, mixed)
        got_mixed = found(match.match_ledger(left, right, "k", "ts", "id", 10_000_000))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value) if value is not None else spark.conf.unset(name)
    assert got == loop(rows, 10_000, replace=True)
    assert got_mixed == loop(mixed, 10_000, replace=True)


def test_a_projection_broadcasts_no_side(spark, tmp_path):
    """Whatever the files seem to hold."""
    rows = [("a", at, at, at % 2) for at in range(100)]
    for name, frame in zip(("left", "right"), frames(spark, rows)):
        frame.write.parquet(f"{tmp_path}/{name}")
    left, right = (spark.read.parquet(f"{tmp_path}/{name}") for name in ("left", "right"))
    pairs = match.temporal_match(left, right, "k", "ts", "id", 10_000, unique_ids=True)
    for unique in (False, True):
        out = match.joined_projection(pairs, left, right, "ts", "id", "k", unique_ids=unique)
        assert out.count() == len(loop(rows, 10))
        assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
