"""Counters taken while a flow runs: equal to those by recomputing, one run only."""

import pytest
from pyspark.sql import functions as F

from millrace.plans import counters, flows, metrics, spec
from millrace.session import shared_dir
from workload import flow_queries
from workload.common import event_topic


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


@pytest.mark.parametrize("changed", [{}, {"processing": {}}])
def test_observed_equals_recomputed(spark, sf_dir, changed):
    made = spec.parse({**flow_queries.TOPIC_FLOW, **changed})
    topics = {"events": event_topic(spark, sf_dir)}
    watched = flows.compile_flow(made, topics, counters.Observer())
    got = one(metrics.run_observed(watched, lambda out: out.write.parquet(shared_dir(spark, "t"))))
    plain = one(metrics.flow_metrics(flows.compile_flow(made, topics)))
    assert got == plain


def test_the_plan_collects_metrics_and_the_topic_is_read_once(spark, sf_dir):
    made = spec.parse({**flow_queries.TOPIC_FLOW, "processing": {}})
    watched = flows.compile_flow(made, {"events": event_topic(spark, sf_dir)}, counters.Observer())
    plan = watched.output._jdf.queryExecution().executedPlan().toString()
    assert "CollectMetrics" in plan and plan.count("FileScan") == 1
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("observed", "one run")
    row = one(metrics.run_observed(watched, lambda out: out.write.parquet(shared_dir(spark, "t")), timed=True))
    assert row["throughput_per_sec"] > 0 and row["events_sunk"] > 0
    written = [j for j in tracker.getJobIdsForGroup("observed")]
    spark.sparkContext.setJobGroup("", "")
    # One job writes and counts; the other reads the row of counters.
    assert len(written) <= 2


def test_flow_without_observer_is_refused(spark, sf_dir):
    flow = flows.compile_flow(spec.parse(flow_queries.TOPIC_FLOW), {"events": event_topic(spark, sf_dir)})
    with pytest.raises(ValueError, match="observer"):
        metrics.run_observed(flow, lambda out: out)


def test_batches_count_once_and_parts_are_named_once(spark):
    class Progress:
        def __init__(self, batch, n):
            self.id, self.batchId = "q", batch
            self.observedMetrics = {"accepted": spark.createDataFrame([(n,)], "events_in bigint").first()}

    seen = counters.Observer(streaming=True)
    frame = spark.range(3)
    seen.watch(frame, "accepted", events_in=F.lit(True))
    seen.follow([Progress(0, 5), Progress(1, 7)])
    seen.follow([Progress(1, 7)])
    assert seen.totals()["events_processed"] == 12
    with pytest.raises(ValueError, match="already"):
        seen.watch(frame, "accepted", events_in=F.lit(True))


def test_empty_input_counts_zero(spark):
    row = one(counters.observed(spark.range(0), lambda df: df.write.parquet(shared_dir(spark, "none")), counters.counts(n=F.col("id") > 0)))
    assert row == {"n": 0}
