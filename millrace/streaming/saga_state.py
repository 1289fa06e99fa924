"""Sagas that advance while their step results stream in (rules in
``operators/sagas.py``).

The state of a saga is its plan, the results that count so far, and how many
commands it has given. It is bounded by the saga's steps. Sagas are dealt by their
id to lanes and parts of a lane; a part is one value of state. So the engine is
called once a lane and a batch, not once a saga, and a batch reads and writes the
parts that its rows fall into. Each micro-batch gives the commands that its results make due, so starts, results and
repeats may come in any order and in any batch; a repeat is known by its step.
Within a batch the earliest ``(at, event_id)`` of a step counts, across batches
the first that came.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import micros
from millrace.operators.sagas import RESULT_KINDS
from millrace.session import ROCKSDB

# A part holds about 40 of 10 million sagas.
LANES, PARTS = 8192, 32
UNDER_WAY = ("running", "compensating")
COLUMNS = ["saga_id", "seq", "step_no", "kind", "command", "at", "status"]
SCHEMA = "saga_id string, seq int, step_no int, kind string, command string, at bigint, status string"


def walk(plan: list[list[str]], start: int, done: dict[str, dict]) -> tuple[list[tuple], str]:
    """All commands due ``(seq, step, kind, command, at)`` and the saga's status."""
    given, at, n = [], start, len(plan)
    for k in range(n):
        given.append((k, k, "step", plan[k][0], at))
        result = done["step"].get(str(k))
        if result is None:
            return given, "running"
        at = max(at, result[1])
        if not result[0]:
            break
    else:
        return given, "completed"
    for j in range(k - 1, -1, -1):
        given.append((2 * k - j, j, "undo", plan[j][1], at))
        result = done["undo"].get(str(j))
        if result is None:
            return given, "compensating"
        at = max(at, result[1])
        if not result[0]:
            return given, "failed"
    return given, "failed"


class SagaProcessor(StatefulProcessor):
    """Ended sagas, and results whose saga never came, are kept until the
    watermark is ``keep`` microseconds past the last that came for them, and for
    up to a quarter longer: a lane has one timer and looks through its parts
    that seldom at most."""

    def __init__(self, keep: int):
        self.keep = keep

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parts = handle.getMapState("parts", "part int", "body string")
        self.wake = handle.getValueState("wake", "ms bigint")

    def _take(self, saga: dict, rows: list[tuple]) -> list[tuple]:
        """The commands that a saga's new rows, in order, make due."""
        for at, _, kind, step_no, ok, plan in rows:
            saga["last"] = max(saga["last"], at)
            if kind == "start":
                if saga["plan"] is None:
                    saga["plan"], saga["start"] = json.loads(plan), at
            else:
                saga[kind].setdefault(str(int(step_no)), [bool(ok), at])
        if saga["plan"] is None:
            return []
        for kind in RESULT_KINDS:  # numbers that are no step of the saga
            saga[kind] = {n: r for n, r in saga[kind].items() if int(n) < len(saga["plan"])}
        given, saga["status"] = walk(saga["plan"], saga["start"], saga)
        new, saga["given"] = given[saga["given"]:], len(given)
        return new

    def _wake_at(self, ms: int) -> None:
        """Let the lane's one timer fire no later than this."""
        held = self.wake.get()
        if held is None or ms < held[0]:
            self.wake.update((ms,))
            self.handle.registerTimer(ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        arrived: dict[int, dict[str, list[tuple]]] = {}
        names = ["part", "saga_id", "at", "event_id", "kind", "step_no", "ok", "plan"]
        for pdf in rows:
            for part, saga_id, at, event, *rest in zip(*(pdf[n].tolist() for n in names)):
                mine = arrived.setdefault(part, {}).setdefault(saga_id, [])
                mine.append((at, event or "", *rest))
        out, known, soonest = [], self.parts.exists(), None
        for part, sagas in arrived.items():
            held = self.parts.getValue((part,)) if known else None
            kept = json.loads(held[0]) if held is not None else {}
            for saga_id, mine in sagas.items():
                saga = kept.setdefault(
                    saga_id,
                    {"plan": None, "start": None, "given": 0, "last": 0, "status": "unknown",
                     "step": {}, "undo": {}},
                )
                mine.sort(key=lambda r: r[:2])
                out += [(saga_id, *c, saga["status"]) for c in self._take(saga, mine)]
                if saga["status"] not in UNDER_WAY:
                    soonest = min(saga["last"], saga["last"] if soonest is None else soonest)
            self.parts.updateValue((part,), (json.dumps(kept),))
        if soonest is not None:
            due = max(soonest + self.keep, timerValues.getCurrentWatermarkInMs() * 1000)
            self._wake_at(due // 1000 + 1)
        if out:
            yield pd.DataFrame(out, columns=COLUMNS)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        held = self.wake.get()
        if held is None or held[0] != expiredTimerInfo.getExpiryTimeInMs():
            return iter(())
        self.wake.clear()
        watermark, soonest = timerValues.getCurrentWatermarkInMs() * 1000, None
        for part in [tuple(k) for k in self.parts.keys()]:
            sagas = json.loads(self.parts.getValue(part)[0])
            ended = {k: s["last"] for k, s in sagas.items() if s["status"] not in UNDER_WAY}
            old = [k for k, last in ended.items() if last + self.keep < watermark]
            for saga_id in old:
                del sagas[saga_id], ended[saga_id]
            if not sagas:
                self.parts.removeKey(part)
            elif old:
                self.parts.updateValue(part, (json.dumps(sagas),))
            for last in ended.values():
                soonest = last if soonest is None else min(soonest, last)
        if soonest is not None:
            self._wake_at(max(soonest + self.keep, watermark + self.keep // 4) // 1000 + 1)
        return iter(())

    def close(self) -> None:
        pass


def saga_stream(
    sagas: DataFrame, results: DataFrame, keep: str = "1d", delay: str = "10 minutes"
) -> DataFrame:
    """The commands of streaming sagas as they become due, each once, with the
    saga's status after the micro-batch that gave it.

    ``sagas`` and ``results`` are as in ``operators.sagas``; either may be a stream.
    A saga's first start counts; starts without a time or an id do nothing. Rows
    are never too late: ``delay`` only sets the watermark by which ended sagas
    are forgotten.
    """
    sagas.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    plan = F.transform("steps", lambda s: F.array(s["command"], s["compensate_with"]))
    nothing = F.lit(None)
    starts = sagas.select(
        F.col("id").alias("saga_id"), F.lit("start").alias("kind"),
        nothing.cast("int").alias("step_no"), nothing.cast("boolean").alias("ok"),
        F.col("start_time").cast("timestamp").alias("__time"),
        nothing.cast("string").alias("event_id"), F.to_json(plan).alias("plan"),
    )
    answers = results.filter(F.col("kind").isin(*RESULT_KINDS) & (F.col("step_no") >= 0)).select(
        "saga_id", "kind", F.col("step_no").cast("int").alias("step_no"),
        F.coalesce("ok", F.lit(False)).alias("ok"), F.col("at").cast("timestamp").alias("__time"),
        F.col("event_id").cast("string").alias("event_id"), nothing.cast("string").alias("plan"),
    )
    both = starts.filter("__time IS NOT NULL AND saga_id IS NOT NULL").withWatermark("__time", delay)
    both = both.unionByName(
        answers.filter("__time IS NOT NULL AND saga_id IS NOT NULL").withWatermark("__time", delay)
    )
    # The engine drops late rows by the watermarked column, so it stays behind.
    spread = F.pmod(F.xxhash64("saga_id"), F.lit(LANES * PARTS))
    dealt = both.withColumns({
        "at": F.unix_micros("__time"),
        "lane": (spread % LANES).cast("int"),
        "part": F.floor(spread / LANES).cast("int"),
    })
    keyed = dealt.drop("__time").groupBy("lane")
    out = keyed.transformWithStateInPandas(SagaProcessor(micros(keep)), SCHEMA, "append", "EventTime")
    return out.withColumn("at", F.timestamp_micros("at"))
