"""Attempts of queued tasks: when each is due, in what order, and how it ends.

Tasks are those of ``routing.task_envelope``, with an optional ``scheduled_at``.
A task is first due at ``scheduled_at``, or at its ``timestamp`` if that is later
or there is no schedule. An attempt that fails (a non-null ``error``, see
``routing.task_outcomes``) is tried again after ``backoff``, then after twice as
long, and so on, until ``max_retries`` retries have failed. Handlers may look at
``retries``, the number of the attempt from 0.

Attempts are released by ``due``, then higher priority, then ``timestamp`` and id.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.durations import micros
from millrace.operators.routing import TASK_MAX_RETRIES, TASK_PRIORITY, Handler, task_outcomes

BACKOFF = "30s"


def first_due(tasks: DataFrame) -> Column:
    at = F.col("timestamp").cast("timestamp")
    if "scheduled_at" not in tasks.columns:
        return at
    return F.greatest(at, F.col("scheduled_at").cast("timestamp"))


def task_attempts(
    tasks: DataFrame,
    handlers: Mapping[str, Handler],
    backoff: str = BACKOFF,
    most: int = TASK_MAX_RETRIES,
) -> DataFrame:
    """One row for each attempt at a task that has a handler: the task's columns
    with ``retries`` as of the attempt, the handler's columns, ``error``, ``due``
    and ``outcome`` (``done``, ``retry``, or ``dead`` after the last failure).

    ``most`` bounds the retries of the plan; a task that allows more is an error,
    one whose ``max_retries`` is null is never retried. Each row is unrolled where
    it is, so nothing is shuffled, and a streaming frame may be passed. Tasks without a
    time have no due time and come with a null ``due``.
    """
    allowed = F.coalesce("max_retries", F.lit(0))
    allowed = F.when(
        allowed > most, F.raise_error(F.concat(F.lit(f"more than {most} retries: "), F.col("id")))
    ).otherwise(allowed)
    made = {name for handler in handlers.values() for name in handler}
    taken = made & set(tasks.columns)
    if taken:
        raise ValueError(f"a queue's handler may not replace task columns: {sorted(taken)}")
    rows = tasks.withColumns({"__due": first_due(tasks), "__allowed": allowed.cast("int")})
    tried = []
    for n in range(most + 1):
        known = rows.columns
        done = task_outcomes(rows.withColumn("retries", F.lit(n)), handlers)
        new = [c for c in done.columns if c not in {*known, "retries"}]
        attempt = F.struct(F.lit(n).alias("retries"), *new).alias(f"__try{n}")
        rows = done.select(*known, attempt)
        tried.append(f"__try{n}")
    # Attempts up to the first that does not fail.
    tries = F.array(*tried)
    wins = F.array_position(F.transform(tries, lambda t: t["error"].isNull()), True)
    last = F.when(wins > 0, F.least(wins, F.col("__allowed") + 1)).otherwise(F.col("__allowed") + 1)
    rows = rows.select(
        *[F.col(c) for c in tasks.columns if c != "retries"], "__due", "__allowed",
        F.explode(F.slice(tries, F.lit(1), last.cast("int"))).alias("__try"),
    )
    n, wait = F.col("__try.retries"), micros(backoff)
    due = F.timestamp_micros(
        F.unix_micros("__due") + F.lit(wait) * (F.pow(F.lit(2), n).cast("bigint") - 1)
    )
    failed = F.col("__try.error").isNotNull()
    outcome = F.when(~failed, "done").when(n < F.col("__allowed"), "retry").otherwise("dead")
    return rows.withColumns({"due": due, "outcome": outcome}).select(
        *[F.col(c) if c != "retries" else n.alias(c) for c in tasks.columns],
        *[F.col(f"__try.{c}").alias(c) for c in new], "due", "outcome",
    )


def rank_text(priority: str = "priority") -> Column:
    """Text that sorts attempts due at the same time: higher priority first, then
    the task's time and id. A null priority is the usual one."""
    level = F.coalesce(F.col(priority).cast("bigint"), F.lit(TASK_PRIORITY))
    digits = lambda column: F.lpad(column.cast("string"), 20, "0")
    return F.concat_ws(
        "/", digits(F.lit(1 << 40) - level),
        digits(F.lit(1 << 60) + F.unix_micros(F.col("timestamp").cast("timestamp"))),
        F.coalesce("id", F.lit("")),
    )
