"""Flow and system metrics."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.plans.counters import counter_row
from millrace.plans.flows import Flow, sink_rows


def _tally(df: DataFrame, **tests) -> DataFrame:
    """Named counts of one frame in one pass, as (metric, n) rows."""
    counted = df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    rows = [F.struct(F.lit(n).alias("metric"), F.col(n).alias("n")) for n in tests]
    return counted.select(F.inline(F.array(*rows)))


def flow_metrics(flow: Flow, seconds: float | None = None) -> DataFrame:
    """One row of counters for a batch run. ``events_sunk`` counts rows that
    reach the sink; blocked duplicates and errors do not."""
    every = F.lit(True)
    parts = [_tally(flow.errors, error_count=every)]
    if flow.judged is not None:
        again = F.col("is_duplicate")
        parts.append(_tally(flow.judged, events_deduped=again, events_sunk=~again))
    else:
        parts.append(_tally(flow.output, events_sunk=every))
    if flow.ledger is not None:
        pair = (F.col("side") == "left") & F.col("is_joined")
        parts.append(_tally(flow.ledger, events_in=every, events_joined=pair))
    counters = reduce(lambda a, b: a.unionAll(b), parts)

    def total(*names):
        picked = F.when(F.col("metric").isin(*names), F.col("n"))
        return F.coalesce(F.sum(picked), F.lit(0)).cast("bigint")

    seen = ("events_in",) if flow.ledger is not None else ("events_deduped", "events_sunk")
    out = counters.agg(
        total(*seen).alias("events_processed"),
        total("events_deduped").alias("events_deduped"),
        total("events_joined").alias("events_joined"),
        total("events_sunk").alias("events_sunk"),
        total("error_count").alias("error_count"),
    )
    if seconds:
        out = out.withColumn("throughput_per_sec", F.col("events_processed") / F.lit(seconds))
    return out


def run_observed(flow: Flow, write: Callable[[DataFrame], object], timed: bool = False) -> DataFrame:
    """Run a batch flow compiled with an observer into ``write``, and return the
    row of ``flow_metrics`` as counted by that one run. ``timed`` adds the events
    per second of the run."""
    if flow.observer is None:
        raise ValueError("compile the flow with an observer")
    began = time.monotonic()
    write(sink_rows(flow))
    seconds = time.monotonic() - began if timed else None
    return counter_row(flow.output.sparkSession, flow.observer.totals(), seconds)


def stage_metrics(rows: DataFrame, at: str, by: str) -> DataFrame:
    """Events, failures and per-second rate of each group over its own span."""
    span = F.unix_micros(F.max(at).cast("timestamp")) - F.unix_micros(F.min(at).cast("timestamp"))
    out = rows.groupBy(by).agg(F.count("*").alias("events"), span.alias("span_micros"))
    rate = F.when(F.col("span_micros") > 0, F.col("events") * 1e6 / F.col("span_micros"))
    return out.withColumn("throughput_per_sec", rate)


def system_metrics(flows: DataFrame) -> DataFrame:
    """Flow counts by status and the total of their events."""
    status = F.col("status")
    return flows.agg(
        F.count("*").alias("total_flows"),
        F.count_if(status == "running").alias("running_flows"),
        F.count_if(status == "failed").alias("failed_flows"),
        F.coalesce(F.sum("events"), F.lit(0)).alias("total_events"),
    )


def windowed_analytics(df: DataFrame, ts: str, by: str, value: str, width: str) -> DataFrame:
    """Count, sum and distinct users per tumbling window and group."""
    return (
        df.groupBy(F.window(ts, width).alias("w"), by)
        .agg(
            F.count("*").alias("events"),
            F.sum(F.col(value).cast("decimal(18,4)")).cast("double").alias("total_value"),
            F.max(value).alias("max_value"),
        )
        .select(F.col("w.start").alias("window_start"), by, "events", "total_value", "max_value")
    )


def session_analytics(df: DataFrame, ts: str, by: str, gap: str) -> DataFrame:
    """Sessions per group: events no more than ``gap`` apart."""
    return (
        df.groupBy(F.session_window(ts, gap).alias("w"), by)
        .agg(F.count("*").alias("events"))
        .select(by, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events")
    )
