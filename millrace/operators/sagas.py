"""Progress of sagas: step results move a saga on, a failure undoes it.

Sagas are those of ``routing.saga_start``. Results are rows of ``saga_id``,
``step_no`` (from 0), ``kind`` (``step`` or ``undo``), ``ok``, ``at`` and
``event_id``. The rules, the same in batch and on a stream:

* Step 0 is commanded at the saga's start, each other step when the one before it
  is done. A result that comes before its step's turn waits for it, so a step is
  done at its result's time or the step before's, whichever is later.
* When a step's turn brings a failure, the steps done before are undone in
  reverse, one at a time: each undo is commanded when the one before it is done.
  A failed undo stops the saga where it is.
* A null ``ok`` is a failure. Of several results of one step the earliest
  ``(at, event_id)`` counts. Results without a time, of another kind, or of no
  step of their saga do nothing. Sagas without steps are completed at their start.
* Status: ``running``, ``compensating`` (an undo is under way), ``completed``, or
  ``failed`` (undone, nothing to undo, or an undo failed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.fields import once

RESULT_KINDS = ("step", "undo")
COMMANDS = "array<struct<seq:int,step_no:int,kind:string,command:string,at:timestamp>>"


def first_results(results: DataFrame, sagas: DataFrame) -> DataFrame:
    """For each saga, the result that counts of every step and undo, as maps from
    the step's number. Repeats are reduced before the shuffle, so a saga with many
    of them is small; what is gathered of a saga is two entries a step at most."""
    valid = results.filter(
        F.col("kind").isin(*RESULT_KINDS) & F.col("saga_id").isNotNull()
        & F.col("at").isNotNull() & (F.col("step_no") >= 0)
    )
    one = valid.groupBy("saga_id", "kind", F.col("step_no").cast("int").alias("step_no")).agg(
        F.min(F.struct("at", "event_id", F.coalesce("ok", F.lit(False)).alias("ok"))).alias("first")
    )
    sizes = sagas.groupBy(F.col("id").alias("saga_id")).agg(F.max(F.size("steps")).alias("__n"))
    own = one.join(sizes, "saga_id").filter("step_no < __n")
    entry = F.struct("step_no", F.struct("first.ok", "first.at"))
    return own.groupBy("saga_id").agg(
        *[
            F.map_from_entries(F.collect_list(F.when(F.col("kind") == kind, entry))).alias(f"__{kind}")
            for kind in RESULT_KINDS
        ]
    )


def _walk(numbers: Column, found: Column, start: Column) -> Column:
    """Take results in the order of ``numbers`` until one is missing or failed.

    ``times`` has the start and the time of every number taken, a failed one
    included; ``state`` is ``open`` when all went well, ``waiting`` or ``failed``.
    """
    first = F.struct(F.array(start).alias("times"), F.lit("open").alias("state"))

    def take(acc: Column, result: Column) -> Column:
        last = F.element_at(acc["times"], -1)
        longer = F.concat(acc["times"], F.array(F.greatest(last, result["at"])))
        moved = F.when(
            result.isNull(), F.struct(acc["times"].alias("times"), F.lit("waiting").alias("state"))
        ).otherwise(
            F.struct(
                longer.alias("times"),
                F.when(result["ok"], F.lit("open")).otherwise(F.lit("failed")).alias("state"),
            )
        )
        return F.when(acc["state"] == "open", moved).otherwise(acc)

    # The results are looked up before the walk, which reads each in several places.
    return F.aggregate(F.transform(numbers, lambda n: F.try_element_at(found, n)), first, take)


def saga_progress(sagas: DataFrame, results: DataFrame) -> DataFrame:
    """Each saga as its results leave it: ``status``, ``current_step`` (the step
    that is under way, failed or past the last), the steps' own statuses,
    ``last_updated``, and all ``commands`` given so far in order.

    A step is ``pending``, ``running``, ``completed`` or ``failed``, then
    ``compensating``, ``compensated`` or ``undo_failed``.
    """
    rows = sagas.join(first_results(results, sagas).withColumnRenamed("saga_id", "id"), "id", "left")
    steps, none = F.size("steps"), F.expr("CAST(array() AS array<int>)")
    forward = F.when(steps > 0, F.sequence(F.lit(0), steps - 1)).otherwise(none)
    # Each walk is read in many places below and made once.
    rows = once(rows, __ahead=_walk(forward, F.col("__step"), F.col("start_time").cast("timestamp")))
    taken = F.size("__ahead.times") - 1
    broke = F.col("__ahead.state") == "failed"
    rows = rows.withColumn("__at", taken - broke.cast("int"))
    back = F.when(broke & (F.col("__at") > 0), F.sequence(F.col("__at") - 1, F.lit(0), F.lit(-1)))
    rows = once(
        rows, __back=_walk(F.coalesce(back, none), F.col("__undo"), F.element_at("__ahead.times", -1))
    )
    stuck = F.col("__back.state") == "failed"
    undone = F.size("__back.times") - 1 - stuck.cast("int")
    rows = rows.withColumns({"__broke": broke, "__stuck": stuck, "__undone": undone})
    at, low = F.col("__at"), F.col("__at") - F.col("__undone")
    status = (
        F.when(~F.col("__broke") & (at == steps), "completed")
        .when(~F.col("__broke"), "running")
        .when(F.col("__stuck") | (low == 0), "failed")
        .otherwise("compensating")
    )

    def own_status(step: Column, n: Column) -> Column:
        turn = F.when(F.col("__stuck"), "undo_failed").otherwise("compensating")
        now = (
            F.when(n > at, "pending")
            .when(n == at, F.when(F.col("__broke"), "failed").otherwise("running"))
            .when(~F.col("__broke"), "completed")
            .when(n >= low, "compensated")
            .when(n == low - 1, turn)
            .otherwise("completed")
        )
        return step.withField("status", now)

    def command(n: Column, kind: str) -> Column:
        """The n-th command ahead, or the n-th undo."""
        step_no = n if kind == "step" else at - 1 - n
        step = F.get("steps", step_no)
        seq = n if kind == "step" else at + 1 + n
        when = F.get("__ahead.times" if kind == "step" else "__back.times", n)
        name = step["command"] if kind == "step" else step["compensate_with"]
        return F.struct(
            seq.cast("int").alias("seq"), step_no.cast("int").alias("step_no"),
            F.lit(kind).alias("kind"), name.alias("command"), when.alias("at"),
        )

    # Of n steps the first ``at + 1`` were commanded; an undo for all that were
    # done, and the one under way.
    ahead = F.when(steps > 0, F.sequence(F.lit(0), F.least(at, steps - 1)))
    undos = F.when(
        F.col("__broke") & (at > 0), F.sequence(F.lit(0), F.least(F.col("__undone"), at - 1))
    )
    commands = F.concat(
        F.transform(F.coalesce(ahead, none), lambda n: command(n, "step")),
        F.transform(F.coalesce(undos, none), lambda n: command(n, "undo")),
    )
    changed = {
        "status": status,
        "current_step": at,
        "steps": F.transform("steps", own_status),
        "last_updated": F.element_at("__back.times", -1),
    }
    kept = [c for c in sagas.columns if c != "commands"]
    return rows.select(
        *[changed.get(c, F.col(c)).alias(c) for c in kept], commands.cast(COMMANDS).alias("commands")
    )


def saga_commands(progress: DataFrame) -> DataFrame:
    """One row per command given, in the order of ``seq`` within a saga."""
    # A generator's filter would make the lists a second time.
    rows = once(progress.select(F.col("id").alias("saga_id"), "commands"), __commands=F.col("commands"))
    rows = rows.select("saga_id", F.inline("__commands"))
    return rows.select("saga_id", "seq", "step_no", "kind", "command", "at")
