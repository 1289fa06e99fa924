"""Start, stop and inspect flows in this application. No server.

A flow runs as two streaming queries over its topics: one writes the output, the
other the dead letters, so that no faulty record goes unseen.
"""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.tables import TableSpec, convert_values, load_rows
from millrace.plans.counters import Observer, counter_row
from millrace.plans.flows import Flow, columns_of, compile_flow, sink_rows
from millrace.plans.spec import FlowSpec
from millrace.session import checkpoint_root
from millrace.streaming.sinks import (
    FLUSH_INTERVAL, BatchWriter, folder_writer, progress_frame, start_sink,
)

CREATED, RUNNING, STOPPED, FAILED = "created", "running", "stopped", "failed"


@dataclass
class _Entry:
    flow: Flow
    write: BatchWriter
    checkpoint: str
    write_errors: BatchWriter | None = None
    table: TableSpec | None = None
    created_at: float = field(default_factory=time.time)
    query: StreamingQuery | None = None
    error_query: StreamingQuery | None = None

    def queries(self) -> list[StreamingQuery]:
        return [q for q in (self.query, self.error_query) if q is not None]

    def status(self) -> str:
        if self.query is None:
            return CREATED
        if any(not q.isActive and q.exception() for q in self.queries()):
            return FAILED
        return RUNNING if any(q.isActive for q in self.queries()) else STOPPED


def table_writer(table: TableSpec, good: BatchWriter, bad: BatchWriter) -> BatchWriter:
    """Flow output as rows of a table, and the rows that do not fit it as dead
    letters, in one micro-batch."""

    def write(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            texts = columns_of(df, {c.name: "string" for c in table.columns})
            rows, misfits = load_rows(texts, table)
            good(rows, batch_id)
            bad(misfits, batch_id)
        finally:
            df.unpersist()

    return write


class FlowManager:
    """Flows by unique name. A stopped flow keeps its
    checkpoint, so starting it again resumes where it left off."""

    def __init__(self, spark: SparkSession, checkpoints: str | None = None):
        self.spark = spark
        self.root = checkpoints or f"{checkpoint_root(spark)}/flows"
        self._flows: dict[str, _Entry] = {}

    def create(
        self,
        spec: FlowSpec,
        topics: Mapping[str, DataFrame],
        write: BatchWriter,
        interval: str | None = FLUSH_INTERVAL,
        table: TableSpec | None = None,
    ) -> None:
        """Compile and start a flow; the name must be new. With ``table`` the
        output is aligned to it. Dead letters go to folders of the shared folder
        (see ``dead_letters``)."""
        if spec.name in self._flows:
            raise ValueError(f"flow {spec.name} already exists")
        letters = self._letters(spec.name)
        if table is not None:
            write = table_writer(table, write, folder_writer(f"{letters}/table", convert_values))
        entry = _Entry(
            compile_flow(spec, topics, Observer(streaming=True)), write, f"{self.root}/{spec.name}",
            folder_writer(f"{letters}/record", convert_values), table,
        )
        self._flows[spec.name] = entry
        self.start(spec.name, interval)

    def _letters(self, name: str) -> str:
        return f"{self.root}/{name}-dead-letters"

    def dead_letters(self, name: str) -> dict[str, DataFrame]:
        """What a flow could not use: by ``record`` those that do not decode or have
        no key, by ``table`` the rows that do not fit it; each with ``error_reason``."""
        entry, out = self._get(name), {}
        for kind in ("record", "table") if entry.table is not None else ("record",):
            try:
                out[kind] = self.spark.read.parquet(f"{self._letters(name)}/{kind}").drop("batch_id")
            except AnalysisException:
                # No micro-batch has come yet.
                out[kind] = self.spark.createDataFrame([], "error_reason string")
        return out

    def _get(self, name: str) -> _Entry:
        if name not in self._flows:
            raise KeyError(f"flow {name} not found")
        return self._flows[name]

    def start(self, name: str, interval: str | None = FLUSH_INTERVAL) -> None:
        entry = self._get(name)
        if entry.status() == RUNNING:
            raise ValueError(f"flow {name} is already running")
        # After a failure one of the two may still run.
        self.stop(name)
        self.spark.streams.addListener(entry.flow.observer.listener(name))
        rows = entry.flow.output if entry.table is not None else sink_rows(entry.flow)
        entry.query = start_sink(rows, entry.write, entry.checkpoint, name, interval)
        if entry.write_errors is not None:
            entry.error_query = start_sink(
                entry.flow.errors, entry.write_errors, f"{entry.checkpoint}-errors",
                f"{name}-errors", interval,
            )

    def stop(self, name: str) -> None:
        for query in self._get(name).queries():
            if query.isActive:
                query.stop()

    def drain(self, name: str) -> None:
        """Process everything the source has now."""
        for query in self._get(name).queries():
            if query.isActive:
                query.processAllAvailable()

    def wait(self, name: str) -> None:
        """Wait for a flow that was started with ``interval=None``."""
        for query in self._get(name).queries():
            query.awaitTermination()

    def delete(self, name: str) -> None:
        self.stop(name)
        del self._flows[name]

    def shutdown(self) -> None:
        for name in self._flows:
            self.stop(name)

    def status(self, name: str) -> str:
        return self._get(name).status()

    def list(self) -> DataFrame:
        """Name, status and events read so far of every flow."""
        rows = []
        for name, entry in self._flows.items():
            seen = sum(p.numInputRows for p in entry.query.recentProgress) if entry.query else 0
            rows.append((name, entry.flow.spec.description, entry.status(), int(seen)))
        return self.spark.createDataFrame(
            rows, "name string, description string, status string, events bigint"
        )

    def metrics(self, name: str) -> DataFrame:
        """The counters of the running flow so far (see ``flow_metrics``), from its
        own micro-batches: nothing is read again."""
        entry = self._get(name)
        entry.flow.observer.follow(entry.query.recentProgress if entry.query else [])
        return counter_row(self.spark, entry.flow.observer.totals())

    def progress(self, name: str) -> DataFrame:
        query = self._get(name).query
        return progress_frame(self.spark, query.recentProgress if query else [])
