"""Task and event envelopes, routing by type, and saga starts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Envelope defaults and names.
TASK_PRIORITY = 1
TASK_MAX_RETRIES = 3
EVENT_VERSION = "1.0"
SAGA_EVENT = "saga.started"
SAGA_SOURCE = "saga-orchestrator"
SAGA_STATUS = "running"

Handler = Mapping[str, Column]


def _headers(pairs: Mapping[str, Column]) -> Column:
    return F.array(
        *[
            F.struct(F.lit(name).alias("key"), value.cast("string").alias("value"))
            for name, value in pairs.items()
        ]
    )


def task_envelope(
    df: DataFrame,
    task_type: Column,
    payload: Sequence[str],
    task_id: Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Rows as queued tasks: the task columns plus ``key, value, headers``."""
    tasks = df.select(
        (task_id if task_id is not None else F.uuid()).cast("string").alias("id"),
        task_type.alias("type"),
        F.struct(*payload).alias("payload"),
        F.lit(TASK_PRIORITY).alias("priority"),
        (at if at is not None else F.current_timestamp()).alias("timestamp"),
        F.lit(0).alias("retries"),
        F.lit(TASK_MAX_RETRIES).alias("max_retries"),
    )
    return tasks.select(
        "*",
        F.col("id").alias("key"),
        F.to_json(F.struct(*tasks.columns)).alias("value"),
        _headers({"task-type": F.col("type"), "priority": F.col("priority")}).alias("headers"),
    )


def event_envelope(
    df: DataFrame,
    event_type: Column,
    source: Column,
    subject: Column,
    data: Sequence[str],
    event_id: Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """Rows as published events, keyed by subject."""
    events = df.select(
        (event_id if event_id is not None else F.uuid()).cast("string").alias("id"),
        event_type.alias("type"),
        source.alias("source"),
        subject.cast("string").alias("subject"),
        (at if at is not None else F.current_timestamp()).alias("timestamp"),
        F.struct(*data).alias("data"),
        F.lit(EVENT_VERSION).alias("version"),
    )
    return events.select(
        "*",
        F.col("subject").alias("key"),
        F.to_json(F.struct(*events.columns)).alias("value"),
        _headers(
            {"event-type": F.col("type"), "source": F.col("source"), "version": F.col("version")}
        ).alias("headers"),
    )


def routed(df: DataFrame, types: Sequence[str], column: str = "type") -> Column:
    """Whether a row's type has a handler."""
    return F.coalesce(F.col(column).isin(list(types)), F.lit(False))


def route(
    df: DataFrame, handlers: Mapping[str, Handler], column: str = "type", keep_rest: bool = False
) -> DataFrame:
    """Rows of each type with their handler's columns and ``handled_by``, in one
    pass however many handlers there are.

    A handler is columns by name. A new column is null for types whose handler
    does not name it; a column the rows have already keeps its value there.
    Types without a handler are left out (see ``unrouted``) unless ``keep_rest``.
    """
    if not handlers:
        raise ValueError("no handlers registered")
    made = {}
    for name in dict.fromkeys(n for handler in handlers.values() for n in handler):
        value = F
        for kind, handler in handlers.items():
            if name in handler:
                value = value.when(F.col(column) == kind, handler[name])
        made[name] = value.otherwise(F.col(name)) if name in df.columns else value
    known = routed(df, list(handlers), column)
    rows = df if keep_rest else df.filter(known)
    return rows.withColumns({**made, "handled_by": F.when(known, F.col(column))})


def unrouted(df: DataFrame, types: Sequence[str], column: str = "type") -> DataFrame:
    return df.filter(~routed(df, types, column))


def task_outcomes(tasks: DataFrame, handlers: Mapping[str, Handler]) -> DataFrame:
    """Handled tasks with ``error``, in one pass: a handler marks a failed task by
    a non-null ``error`` column, and the task comes back with one more retry."""
    done = route(tasks, handlers)
    if "error" not in done.columns:
        done = done.withColumn("error", F.lit(None).cast("string"))
    failed = F.col("error").isNotNull()
    return done.withColumn("retries", F.col("retries") + failed.cast("int"))


def task_route(
    tasks: DataFrame, handlers: Mapping[str, Handler]
) -> tuple[DataFrame, DataFrame]:
    """``task_outcomes`` as (completed, failed)."""
    done = task_outcomes(tasks, handlers)
    return done.filter("error IS NULL").drop("error"), done.filter("error IS NOT NULL")


def route_counts(df: DataFrame, types: Sequence[str], column: str = "type") -> DataFrame:
    """Events per type, and whether the type has a handler."""
    return df.groupBy(F.col(column).alias("event_type")).agg(
        F.bool_or(routed(df, types, column)).alias("handled"), F.count("*").alias("events")
    )


def saga_start(
    df: DataFrame,
    saga_type: Column,
    context: Sequence[str],
    steps: Sequence[tuple[str, str, str]],
    saga_id: Column | None = None,
    at: Column | None = None,
) -> DataFrame:
    """One running saga instance per row, at its first step."""
    planned = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.lit(command).alias("command"),
                F.lit(undo).alias("compensate_with"),
                F.lit("pending").alias("status"),
            )
            for name, command, undo in steps
        ]
    )
    now = at if at is not None else F.current_timestamp()
    return df.select(
        (saga_id if saga_id is not None else F.uuid()).cast("string").alias("id"),
        saga_type.alias("type"),
        F.lit(SAGA_STATUS).alias("status"),
        F.lit(0).alias("current_step"),
        planned.alias("steps"),
        F.struct(*context).alias("context"),
        now.alias("start_time"),
        now.alias("last_updated"),
    )


def saga_events(sagas: DataFrame) -> DataFrame:
    """The event each saga start publishes."""
    facts = sagas.select(
        "start_time",
        F.col("id").alias("saga_id"),
        F.col("type").alias("saga_type"),
        F.size("steps").alias("steps"),
    )
    return event_envelope(
        facts,
        F.lit(SAGA_EVENT),
        F.lit(SAGA_SOURCE),
        F.col("saga_id"),
        ["saga_id", "saga_type", "steps"],
        event_id=F.concat(F.lit("start-"), F.col("saga_id")),
        at=F.col("start_time"),
    )


def saga_steps(sagas: DataFrame) -> DataFrame:
    """One row per step with its position."""
    exploded = sagas.select(F.col("id").alias("saga_id"), "type", F.posexplode("steps"))
    return exploded.select(
        "saga_id", F.col("type").alias("saga_type"), F.col("pos").alias("step_no"), "col.*"
    )
