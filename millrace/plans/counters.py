"""Counters of a flow, taken while it runs.

An ``Observer`` puts observation points into a flow's plan; the numbers come with
the job that writes the output, or with the progress of each micro-batch, so no
topic is read and no match made a second time. The plan shows them as
``CollectMetrics``. A task that runs twice, after a lost executor, may be counted
twice, as with any observed metric.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

NAMES = ("events_in", "events_joined", "events_sunk", "error_count")


def counts(**tests: Column) -> list[Column]:
    return [F.count_if(test).alias(name) for name, test in tests.items()]


class _Follower(StreamingQueryListener):
    """Hands the progress of one query to its observer."""

    def __init__(self, observer: Observer, name: str):
        self.observer, self.name = observer, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.name == self.name:
            self.observer.follow([event.progress])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


class Observer:
    """Observation points of one flow, by part of its plan."""

    def __init__(self, streaming: bool = False):
        self.streaming = streaming
        self._points: dict[str, Observation] = {}
        self._parts: list[str] = []
        self._batches: dict[tuple, dict[str, dict]] = {}
        self._listener: _Follower | None = None

    def watch(self, df: DataFrame, part: str, **tests: Column) -> DataFrame:
        """``df`` with counts of the rows that pass each test."""
        if part in self._parts:
            raise ValueError(f"{part} is already observed")
        self._parts.append(part)
        if self.streaming:
            return df.observe(part, *counts(**tests))
        self._points[part] = Observation(f"{part}-{uuid.uuid4().hex}")
        return df.observe(self._points[part], *counts(**tests))

    def listener(self, query: str) -> StreamingQueryListener:
        """A listener that follows the named query, the same one each time."""
        self._listener = self._listener or _Follower(self, query)
        return self._listener

    def follow(self, progress: Iterable) -> None:
        """Take over what micro-batches report; each counts once, however often
        it is handed over."""
        for p in progress:
            found = {part: row.asDict() for part, row in p.observedMetrics.items()}
            if found:
                self._batches[str(p.id), int(p.batchId)] = found

    def by_part(self) -> dict[str, dict[str, int]]:
        """The counts of each observation point. Of a batch flow they are there
        once a job has run it; a point that no job has passed has none."""
        if not self.streaming:
            return {part: dict(point.get) for part, point in self._points.items()}
        out: dict[str, dict[str, int]] = {}
        for found in list(self._batches.values()):
            for part, row in found.items():
                held = out.setdefault(part, {})
                for name, n in row.items():
                    held[name] = held.get(name, 0) + int(n or 0)
        return out

    def totals(self) -> dict[str, int]:
        """Sums of the counters over all points, and what they imply."""
        total = dict.fromkeys(NAMES, 0)
        parts = self.by_part()
        for row in parts.values():
            for name, n in row.items():
                total[name] += int(n)
        # What reached deduplication and did not leave it was blocked.
        joined = "joined" in self._parts
        lost = parts.get("keyed", {}).get("error_count", 0)
        reached = total["events_joined"] - lost if joined else total["events_in"]
        return {
            "events_processed": total["events_in"],
            "events_deduped": reached - total["events_sunk"],
            "events_joined": total["events_joined"],
            "events_sunk": total["events_sunk"],
            "error_count": total["error_count"],
        }


def counter_row(spark: SparkSession, totals: dict[str, int], seconds: float | None = None) -> DataFrame:
    out = spark.createDataFrame([tuple(totals.values())], ", ".join(f"{n} bigint" for n in totals))
    if seconds:
        out = out.withColumn("throughput_per_sec", F.col("events_processed") / F.lit(seconds))
    return out


def observed(df: DataFrame, run: Callable[[DataFrame], object], counters: list[Column]) -> DataFrame:
    """One row of counters over ``df``, taken while ``run`` writes or reads it."""
    point = Observation(f"rows-{uuid.uuid4().hex}")
    run(df.observe(point, *counters))
    row = point.get
    fields = ", ".join(f"{n} bigint" for n in row)
    return df.sparkSession.createDataFrame([tuple(row.values())], fields)
