"""A delay queue: attempts at tasks wait on a stream until they are due.

Tasks are dealt to lanes by their id. A lane keeps its waiting attempts in sorted
segments with one timer, for the earliest (see ``lanes.py``), so a micro-batch
writes its arrivals and reads the segments that the watermark has entered, and the
calls of the state do not grow with the stretches of due time. A stretch is released when the watermark has passed its end, in the
order of ``operators/task_queue.py``, so an attempt leaves at most one stretch (and
the watermark's delay) after it is due. Attempts that arrive when their stretch is
over leave at once, in order among themselves. ``seq`` counts a lane's releases.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from itertools import groupby

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import micros
from millrace.operators.routing import TASK_MAX_RETRIES, Handler
from millrace.operators.task_queue import BACKOFF, rank_text, task_attempts
from millrace.session import ROCKSDB
from millrace.streaming.lanes import FRAME, LaneStore
from millrace.streaming.stateful import _JSON

SCHEMA = "lane int, seq bigint, body string"


# Fixed value: arrivals of a lane that are in memory at a time.
ARRIVALS = 100_000


class DelayProcessor(StatefulProcessor):
    def __init__(self, stretch: int):
        self.stretch = stretch  # milliseconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.store = LaneStore(handle)
        self.count = handle.getValueState("count", "n bigint")

    def _out(self, key, rows: Iterable[list]) -> Iterator[pd.DataFrame]:
        """Frames of rows ``[end of the stretch, due, rank, body]`` that come by their ends."""
        n = first = self.count.get()[0] if self.count.exists() else 0
        ready: list[list] = []
        for _, stretch in groupby(rows, key=lambda r: r[0]):
            ready += sorted(stretch)
            if len(ready) >= FRAME:
                yield self._frame(key, n, ready)
                n, ready = n + len(ready), []
        if ready:
            yield self._frame(key, n, ready)
            n += len(ready)
        if n > first:
            self.count.update((n,))

    def _frame(self, key, n: int, rows: list[list]) -> pd.DataFrame:
        return pd.DataFrame(
            {"lane": key[0], "seq": range(n, n + len(rows)), "body": [r[3] for r in rows]}
        )

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        lane, watermark = self.store.open(), timerValues.getCurrentWatermarkInMs()
        late, held = [], []
        for pdf in rows:
            for due, rank, body in zip(pdf["due_at"].tolist(), pdf["rank"], pdf["body"]):
                ends = (due // 1000 // self.stretch + 1) * self.stretch
                (late if ends <= watermark else held).append([ends, due, rank, body])
            if len(held) >= ARRIVALS:
                lane.hold(held)
                held = []
        if held:
            lane.hold(held)
        yield from self._out(key, sorted(late))
        lane.close(lambda ends: ends)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        lane = self.store.open()
        if not lane.woken(expiredTimerInfo.getExpiryTimeInMs()):
            return
        yield from self._out(key, lane.release(timerValues.getCurrentWatermarkInMs() + 1))
        lane.close(lambda ends: ends)

    def close(self) -> None:
        pass


def released_tasks(
    tasks: DataFrame,
    handlers: Mapping[str, Handler],
    lanes: int = 32,
    stretch: str = "1m",
    delay: str = "10 minutes",
    backoff: str = BACKOFF,
    most: int = TASK_MAX_RETRIES,
) -> DataFrame:
    """The attempts of ``task_attempts`` with ``lane`` and ``seq``, as they become
    due. The watermark is ``delay`` behind the ``timestamp`` of the tasks that have a
    handler (others may be filtered before it is taken); tasks are never too late. Tasks without a time are left out."""
    tasks.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = tasks.withColumn("__time", F.col("timestamp").cast("timestamp"))
    timed = timed.filter("__time IS NOT NULL").withWatermark("__time", delay)
    # The engine drops late rows by the watermarked column, so it stays behind.
    attempts = task_attempts(timed.drop("__time"), handlers, backoff, most)
    body = F.to_json(F.struct(*attempts.columns), _JSON)
    keyed = attempts.select(
        F.pmod(F.xxhash64("id"), F.lit(lanes)).cast("int").alias("lane"),
        F.unix_micros("due").alias("due_at"), rank_text().alias("rank"), body.alias("body"),
    )
    out = keyed.groupBy("lane").transformWithStateInPandas(
        DelayProcessor(max(1, micros(stretch) // 1000)), SCHEMA, "append", "EventTime"
    )
    row = out.withColumn("__row", F.from_json("body", attempts.schema, _JSON))
    return row.select("lane", "seq", "__row.*")
