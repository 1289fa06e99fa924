"""Sagas that advance, against a loop over their results."""

import json
import random
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.operators import sagas
from millrace.streaming import saga_state, sinks

ZERO = datetime(2024, 1, 1)
SAGA = (
    "id string, type string, status string, current_step int, steps array<struct<name string, "
    "command string, compensate_with string, status string>>, start_time timestamp, last_updated timestamp"
)
RESULT = "saga_id string, step_no int, kind string, ok boolean, at timestamp, event_id string"


def minute(n):
    return ZERO + timedelta(minutes=n)


def saga(name, steps, start=0):
    plan = [(f"s{n}", f"do{n}", f"undo{n}", "pending") for n in range(steps)]
    return name, "t", "running", 0, plan, minute(start), minute(start)


def brute(rows, results):
    """Status, current step, step statuses, commands and last time of each saga, by
    asking for one result after the other."""
    answers = {}
    for s, n, kind, ok, at, event in results:
        if None in (s, n, at) or kind not in ("step", "undo"):
            continue
        key, value = (s, kind, n), (at, event or "", bool(ok))
        answers[key] = min(value, answers.get(key, value))
    out = {}
    for name, _, _, _, plan, start, _ in rows:
        at, own, given, current = start, ["pending"] * len(plan), [], 0
        status = None
        while status is None:
            if current == len(plan):
                status = "completed"
                break
            own[current] = "running"
            given.append((current, "step", f"do{current}", at))
            answer = answers.get((name, "step", current))
            if answer is None:
                status = "running"
            else:
                at = max(at, answer[0])
                own[current] = "completed" if answer[2] else "failed"
                if answer[2]:
                    current += 1
                else:
                    status = "failed"
        if status == "failed":
            for back in reversed(range(current)):
                own[back] = "compensating"
                given.append((back, "undo", f"undo{back}", at))
                answer = answers.get((name, "undo", back))
                if answer is None:
                    status = "compensating"
                    break
                at = max(at, answer[0])
                own[back] = "compensated" if answer[2] else "undo_failed"
                if not answer[2]:
                    break
        out[name] = (status, current, own, [(i, *g) for i, g in enumerate(given)], at)
    return out


def random_case(seed, repeats=True):
    rng = random.Random(seed)
    rows, results = [], []
    for k in range(150):
        steps = rng.choice([0, 1, 2, 3, 5])
        rows.append(saga(f"g{k}", steps, rng.randint(0, 30)))
        for kind in ("step", "undo"):
            for n in range(-1, steps + 2):
                if rng.random() < 0.15:
                    continue
                for _ in range(rng.choice([1, 1, 3]) if repeats else 1):
                    ok = rng.choice([True] * 8 + [False, None])
                    at = minute(rng.randint(0, 60))
                    results.append((f"g{k}", n, kind, ok, at, f"e{len(results)}"))
    results += [
        (None, 0, "step", True, minute(1), "x"), ("g1", None, "step", True, minute(1), "x"),
        ("g2", 0, "step", True, None, "x"), ("g3", 0, None, True, minute(1), "x"),
        ("g4", 0, "other", True, minute(1), None), ("no saga", 0, "step", True, minute(1), "x"),
    ]
    rng.shuffle(results)
    return rows, results


@pytest.mark.parametrize("seed", [1, 2])
def test_progress_against_a_loop(spark, seed):
    rows, results = random_case(seed)
    done = sagas.saga_progress(
        spark.createDataFrame(rows, SAGA), spark.createDataFrame(results + results[:50], RESULT)
    )
    expected = brute(rows, results)
    found = {}
    for r in done.collect():
        given = [(c.seq, c.step_no, c.kind, c.command, c.at) for c in r.commands]
        found[r.id] = (r.status, r.current_step, [s.status for s in r.steps], given, r.last_updated)
    assert found == expected
    assert {s for s, *_ in expected.values()} == {"running", "compensating", "completed", "failed"}
    listed = sorted(map(tuple, sagas.saga_commands(done).collect()))
    assert listed == sorted((k, *c) for k, v in expected.items() for c in v[3])


def test_empty_tables_and_other_columns(spark):
    none = spark.createDataFrame([], RESULT)
    rows = spark.createDataFrame([saga("a", 2), saga("b", 0), saga(None, 1)], SAGA)
    more = rows.withColumn("commands", F.lit("mine")).withColumn("kind", F.lit("k"))
    out = sagas.saga_progress(more, none)
    assert sorted((r.id or "", r.status, r.kind) for r in out.collect()) == [
        ("", "running", "k"), ("a", "running", "k"), ("b", "completed", "k")
    ]
    assert sagas.saga_commands(out).count() == 2
    assert sagas.saga_progress(rows.limit(0), none).count() == 0


def test_repeated_saga_rows_advance_alike(spark):
    rows = spark.createDataFrame([saga("a", 2), saga("a", 2)], SAGA)
    results = spark.createDataFrame([("a", 0, "step", True, minute(3), "e")], RESULT)
    out = sagas.saga_progress(rows, results).collect()
    assert [(r.status, r.current_step) for r in out] == [("running", 1)] * 2


def test_one_saga_with_most_results(spark):
    """Repeats are reduced before they are gathered."""
    rows = spark.createDataFrame([saga("a", 3), saga("b", 3)], SAGA)
    many = spark.range(200_000).selectExpr(
        "'a' AS saga_id", "CAST(id % 1000 AS int) AS step_no", "'step' AS kind", "true AS ok",
        "timestamp_millis(1704067200000 + id) AS at", "CAST(id AS string) AS event_id",
    )
    out = {r.id: (r.status, len(r.commands)) for r in sagas.saga_progress(rows, many).collect()}
    assert out == {"a": ("completed", 3), "b": ("running", 1)}


@pytest.mark.parametrize("starts_last", [False, True])
def test_stream_equals_batch(spark, tmp_path, starts_last):
    """Results in any batch, some of them twice, starts before or after them."""
    rows, results = random_case(3, repeats=False)
    rng = random.Random(4)
    copies = results + rng.sample(results, 200)
    source = str(tmp_path / "results")
    for n in range(3):
        part = spark.createDataFrame(copies[n::3], RESULT)
        part.coalesce(1).write.mode("append").parquet(source)
    begun = str(tmp_path / "sagas")
    half = len(rows) // 2
    batches = (rows[:half], rows[half:])
    read = lambda path, schema: (
        spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    )
    spark.createDataFrame(rows[:0] if starts_last else batches[0], SAGA).coalesce(1).write.parquet(begun)
    out = saga_state.saga_stream(read(begun, SAGA), read(source, RESULT))
    for part in (batches if starts_last else batches[1:]):
        sinks.drain(out, f"{tmp_path}/out", f"{tmp_path}/ck")
        spark.createDataFrame(part, SAGA).coalesce(1).write.mode("append").parquet(begun)
    sinks.drain(out, f"{tmp_path}/out", f"{tmp_path}/ck")
    found = sorted(
        tuple(r) for r in sinks.read_folder(spark, f"{tmp_path}/out", out.schema).drop("status").collect()
    )
    expected = brute(rows, results)
    assert found == sorted((k, *c) for k, v in expected.items() for c in v[3])
    last = {}
    for r in sinks.read_folder(spark, f"{tmp_path}/out", out.schema).collect():
        if r.seq >= last.get(r.saga_id, (-1,))[0]:
            last[r.saga_id] = (r.seq, r.status)
    running = {k for k, v in expected.items() if v[0] in ("running", "compensating")}
    assert {k for k, (_, s) in last.items() if k in running and s == expected[k][0]} == running


def test_the_walk_alone():
    plan, start = [["a", "b"], ["c", "d"]], 5
    assert saga_state.walk([], start, {"step": {}, "undo": {}}) == ([], "completed")
    done = {"step": {"0": [True, 9], "1": [False, 7]}, "undo": {}}
    assert saga_state.walk(plan, start, done) == (
        [(0, 0, "step", "a", 5), (1, 1, "step", "c", 9), (2, 0, "undo", "b", 9)], "compensating"
    )
    done["undo"]["0"] = [True, 2]
    assert saga_state.walk(plan, start, done)[1] == "failed"


def test_ended_sagas_are_forgotten(spark, tmp_path):
    """The watermark passes an ended saga by more than ``keep``; a late repeat of its
    start begins it anew, one within ``keep`` does not."""
    far = 3 * 24 * 60
    begun, source = str(tmp_path / "sagas"), str(tmp_path / "results")
    (tmp_path / "sagas").mkdir()
    (tmp_path / "results").mkdir()
    out = saga_state.saga_stream(
        spark.readStream.schema(SAGA).parquet(begun), spark.readStream.schema(RESULT).parquet(source)
    )
    steps = [
        ([saga("a", 1), saga("far", 1, 1)], [("a", 0, "step", True, minute(2), "e")]),
        ([saga("a", 1)], []),
        ([saga("late", 1, far)], [("late", 0, "undo", True, minute(far), "e")]),
        ([saga("b", 1, far)], [("b", 0, "undo", True, minute(far), "e")]),
        ([saga("a", 1), saga("far", 1, 1)], []),
    ]
    for rows, results in steps:
        spark.createDataFrame(rows, SAGA).coalesce(1).write.mode("append").parquet(begun)
        spark.createDataFrame(results, RESULT).coalesce(1).write.mode("append").parquet(source)
        sinks.drain(out, f"{tmp_path}/out", f"{tmp_path}/ck")
    found = sinks.read_folder(spark, f"{tmp_path}/out", out.schema).collect()
    given = sorted(r.saga_id for r in found)
    assert given == ["a", "a", "b", "far", "late"]


class State(dict):
    """State of a lane, as a map and as a value, that counts the calls."""

    calls = 0

    def exists(self):
        self.calls += 1
        return bool(self)

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value

    def removeKey(self, key):
        self.calls += 1
        del self[key]


class Wake:
    held, timers = None, ()

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def registerTimer(self, ms):
        self.timers = (*self.timers, ms)


class Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms

    getExpiryTimeInMs = getCurrentWatermarkInMs


def test_state_is_called_by_part_and_not_by_saga():
    lane = saga_state.SagaProcessor(keep=1_000_000)
    lane.parts, lane.wake = State(), Wake()
    lane.handle = lane.wake
    plan = '[["a", "b"]]'
    begun = [(n % 4, f"s{n}", 10, None, "start", None, None, plan) for n in range(2000)]
    done = [(n % 4, f"s{n}", 20, "e", "step", 0, True, None) for n in range(1000)]
    names = ["part", "saga_id", "at", "event_id", "kind", "step_no", "ok", "plan"]

    def feed(rows):
        frames = [pd.DataFrame(rows[k::3], columns=names) for k in range(3)]
        return [tuple(r) for f in lane.handleInputRows((0,), iter(frames), Clock(0)) for r in f.values]

    assert len(feed(begun)) == 2000 and feed(done) == []
    assert lane.parts.calls <= 2 * (1 + 2 * 4) and lane.wake.timers == (1001,)
    # The ended ones are forgotten by the one timer; those under way stay.
    lane.parts.keys = lambda: list(dict.keys(lane.parts))
    list(lane.handleExpiredTimer((0,), None, Clock(999)))
    assert sum(len(json.loads(v)) for v, in lane.parts.values()) == 2000
    list(lane.handleExpiredTimer((0,), Clock(5000), Clock(1001)))
    assert sum(len(json.loads(v)) for v, in lane.parts.values()) == 1000
    assert lane.wake.held is None


def test_commands_are_made_where_they_are_read_and_once(spark):
    rows = spark.createDataFrame([saga("a", 3)], SAGA)
    done = sagas.saga_progress(rows, spark.createDataFrame([], RESULT))

    def plan(frame):
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "concat(transform(" not in plan(done.select("id", "status", "last_updated"))
    assert plan(sagas.saga_commands(done)).count("concat(transform(") == 1
