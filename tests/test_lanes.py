"""Lanes of keys: what waits comes out whole and in order, and calls of the state
do not grow with the keys of a lane."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.streaming import lanes, stateful, task_state
from workload import QUERIES


class Calls:
    """Value and map states and timers of one lane in memory; counts the calls."""

    def __init__(self):
        self.states, self.timers, self.count = {}, set(), 0

    def getValueState(self, name, schema):
        return Value(self, self.states.setdefault(name, {}))

    def getMapState(self, name, key, value):
        return Map(self, self.states.setdefault(name, {}))

    def registerTimer(self, ms):
        self.timers.add(ms)

    def deleteTimer(self, ms):
        self.timers.remove(ms)


class Map:
    def __init__(self, calls, held):
        self.calls, self.held = calls, held

    def getValue(self, key):
        self.calls.count += 1
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls.count += 1
        self.held[key] = value

    def removeKey(self, key):
        self.calls.count += 1
        del self.held[key]


class Value(Map):
    def get(self):
        return self.getValue(())

    def exists(self):
        return self.get() is not None

    def update(self, value):
        self.updateValue((), value)

    def clear(self):
        self.removeKey(())


class Times:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


@pytest.mark.parametrize("most", [3, 700, 2500])
def test_waiting_rows_come_out_once_in_order(most):
    rng, calls, waiting, n, limit = random.Random(most), Calls(), [], 0, 0
    store = lanes.LaneStore(calls)
    for _ in range(40):
        lane = store.open()
        new = [[limit + rng.randrange(5000), f"r{(n := n + 1)}"] for _ in range(rng.randrange(most))]
        waiting += new
        lane.hold([*new])
        limit += rng.randrange(1500)
        out = list(lane.release(limit))
        assert sorted(out) == sorted(r for r in waiting if r[0] < limit)
        assert [r[0] for r in out] == sorted(r[0] for r in out)
        waiting = [r for r in waiting if r[0] >= limit]
        lane.close(lambda at: at)
        assert calls.timers == ({min(r[0] for r in waiting)} if waiting else set())
    lane = store.open()
    assert sorted(lane.release(10**9)) == sorted(waiting)
    lane.close(lambda at: at)
    assert not calls.timers and not any(calls.states.values())


def arrivals(keys, at):
    rows = [(at + n, str(n), 0, "{}", n % lanes.PARTS, f"k{n}") for n in range(keys)]
    return iter([pd.DataFrame(rows, columns=["at", "event", "side", "body", "part", "key_value"])])


@pytest.mark.parametrize("hold", [False, True])
def test_state_calls_do_not_grow_with_keys(hold):
    counts = []
    for keys in (100, 400):
        calls, processor = Calls(), stateful.AnchorProcessor(10_000_000, hold)
        processor.init(calls)
        out = list(processor.handleInputRows((0,), arrivals(keys, 1_000_000), Times(0)))
        wake = min(calls.timers)
        assert len(calls.timers) == 1
        out += processor.handleExpiredTimer((0,), Times(60_000), Times(wake))
        assert sum(len(pdf) for pdf in out) == keys
        while calls.timers:
            wake = calls.timers.pop()
            calls.timers.add(wake)
            list(processor.handleExpiredTimer((0,), Times(max(wake, 60_000)), Times(wake)))
            calls.timers.discard(wake)
        assert not any(calls.states.values())
        counts.append(calls.count)
    assert counts[1] <= counts[0] + 2


def test_state_calls_do_not_grow_with_stretches_of_due_time():
    """Four hundred minutes with a task each, in one lane."""
    counts = []
    for minutes in (100, 400):
        calls, processor = Calls(), task_state.DelayProcessor(60_000)
        processor.init(calls)
        rows = [(n * 60_000_000, f"{n:04}", f"task{n}") for n in reversed(range(minutes))]
        arrived = iter([pd.DataFrame(rows, columns=["due_at", "rank", "body"])])
        assert not list(processor.handleInputRows((0,), arrived, Times(-1)))
        (wake,) = calls.timers
        end = 50 * 60_000
        (out,) = processor.handleExpiredTimer((0,), Times(end), Times(wake))
        assert out["body"].tolist() == [f"task{n}" for n in range(50)]
        assert out["seq"].tolist() == list(range(50)) and calls.timers - {wake} == {end + 60_000}
        counts.append(calls.count)
    assert counts[0] == counts[1] < 12


def test_four_batches_however_many_files(spark, tmp_path):
    """An input of several files is judged in four micro-batches still."""
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(6).write.parquet(f"{tmp_path}/events.parquet")
    out = QUERIES["dedup_stream_batches"](spark, str(tmp_path))
    batch = F.regexp_extract(F.input_file_name(), r"batch_id=(\d+)", 1)
    assert out.count() == events.count()
    assert out.select(batch.alias("batch")).distinct().count() == 4
