"""The delay queue, against a loop over tasks."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from millrace.operators import task_queue
from millrace.streaming import sinks
from millrace.streaming.task_state import released_tasks

ZERO = datetime(2024, 1, 1)
TASK = (
    "id string, type string, payload struct<fails int>, priority int, timestamp timestamp, "
    "retries int, max_retries int, scheduled_at timestamp"
)


def handlers():
    return {
        "job": {"error": F.when(F.col("retries") < F.col("payload.fails"), F.concat(F.lit("try "), "retries"))},
        "note": {"said": F.lit("yes")},
    }


def make(seed, n=400):
    rng, out = random.Random(seed), []
    for k in range(n):
        at = ZERO + timedelta(seconds=rng.randint(0, 7200))
        plan = at + timedelta(seconds=rng.randint(-600, 3600)) if rng.random() < 0.5 else None
        out.append((
            f"t{k}", rng.choice(["job", "job", "note", "other", None]), (rng.choice([0, 1, 2, 5, None]),),
            rng.choice([0, 1, 1, 9, None]), at, 0, rng.choice([0, 1, 3, None]), plan,
        ))
    return out


def brute(tasks):
    out = []
    for name, kind, (fails,), priority, at, _, most, plan in tasks:
        if kind not in ("job", "note"):
            continue
        due, n = max(at, plan or at), 0
        while True:
            failed = kind == "job" and fails is not None and n < fails
            outcome = "done" if not failed else "retry" if n < (most or 0) else "dead"
            out.append((name, n, due, outcome, f"try {n}" if failed else None, None if kind == "job" else "yes"))
            if outcome != "retry":
                break
            due, n = due + timedelta(seconds=30 * 2**n), n + 1
    return out


def order(tasks, row):
    task = next(t for t in tasks if t[0] == row[0])
    return -(1 if task[3] is None else task[3]), task[4], row[0]


SHOWN = ["id", "retries", "due", "outcome", "error", "said"]


def shown(df):
    return sorted((tuple(r) for r in df.select(*SHOWN).collect()), key=str)


def test_attempts_against_a_loop(spark):
    tasks = make(1)
    frame = spark.createDataFrame(tasks, TASK).withColumn("due_date", F.lit("mine"))
    out = task_queue.task_attempts(frame, handlers())
    assert shown(out) == sorted(brute(tasks), key=str)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.filter("due_date = 'mine'").count() == out.count()


def test_tasks_without_time_empty_and_refused(spark):
    none = spark.createDataFrame([("a", "note", (1,), 1, None, 0, 3, None)], TASK)
    assert [tuple(r) for r in task_queue.task_attempts(none, handlers()).select("due", "outcome").collect()] == [
        (None, "done")
    ]
    assert task_queue.task_attempts(none.limit(0), handlers()).count() == 0
    assert task_queue.task_attempts(none.drop("scheduled_at"), handlers()).count() == 1
    many = spark.createDataFrame([("a", "note", (1,), 1, ZERO, 0, 4, None)], TASK)
    with pytest.raises(Exception, match="more than 3 retries"):
        task_queue.task_attempts(many, handlers()).collect()
    assert task_queue.task_attempts(many, handlers(), most=4).count() == 1
    with pytest.raises(ValueError, match="may not replace"):
        task_queue.task_attempts(many, {"note": {"priority": F.lit(2)}})


def released(spark, tmp_path, batches, lanes):
    source = tmp_path / "in"
    source.mkdir()
    out = released_tasks(spark.readStream.schema(TASK).parquet(str(source)), handlers(), lanes=lanes)
    for batch in batches:
        spark.createDataFrame(batch, TASK).coalesce(1).write.mode("append").parquet(str(source))
        sinks.drain(out, f"{tmp_path}/out", f"{tmp_path}/ck")
    return sinks.read_folder(spark, f"{tmp_path}/out", out.schema)


@pytest.mark.parametrize("lanes", [1, 5])
def test_release_order(spark, tmp_path, lanes):
    """All are released once time has gone on, in order of stretch, due time,
    priority, time and id; without late tasks that is the order of due times."""
    tasks = make(2)
    end = ("end", "note", (0,), 1, ZERO + timedelta(days=2), 0, 0, None)
    out = released(spark, tmp_path, [tasks, [end]], lanes)
    assert shown(out) == sorted(brute(tasks), key=str)
    for lane in range(lanes):
        rows = [tuple(r) for r in out.filter(F.col("lane") == lane).orderBy("seq").select(*SHOWN, "seq").collect()]
        assert [r[-1] for r in rows] == list(range(len(rows)))
        assert rows == sorted(rows, key=lambda r: (r[2], *order(tasks, r)))


def test_nothing_leaves_before_it_is_due(spark, tmp_path):
    tasks = make(3)
    ahead = ("end", "note", (0,), 1, ZERO + timedelta(seconds=5000), 0, 0, None)
    early = [t for t in tasks if t[4] <= ZERO + timedelta(seconds=3000)]
    out = released(spark, tmp_path, [early, [ahead]], 3)
    mark = ZERO + timedelta(seconds=5000) - timedelta(minutes=10)
    minute = lambda t: t.replace(second=0, microsecond=0) + timedelta(minutes=1)
    assert shown(out) == sorted((r for r in brute(early) if minute(r[2]) <= mark), key=str)
    assert 0 < out.count() < len(brute(early))


def test_late_tasks_leave_at_once(spark, tmp_path):
    ahead = ("end", "note", (0,), 1, ZERO + timedelta(days=1), 0, 0, None)
    late = [(f"l{k}", "note", (0,), p, ZERO, 0, 0, None) for k, p in enumerate((1, 5, None))]
    out = released(spark, tmp_path, [[("a", "note", (0,), 1, ZERO, 0, 0, None)], [ahead], late], 1)
    assert [r.id for r in out.orderBy("seq").collect()] == ["a", "l1", "l0", "l2"]
