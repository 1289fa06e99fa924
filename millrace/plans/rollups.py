"""Windowed roll-ups that merge: longer windows come from shorter ones.

A stored window keeps exact counts and sums, and two sketches: distinct values
(HyperLogLog) and quantiles (KLL). Both merge without loss of their bounds, so a
day is made of its hours and no event is read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Twelve bits of registers keep the distinct count within about 1.6 % (one sigma).
LOG_K = 12
# Quantile ranks within about 1 %.
KLL_K = 400
COUNTERS = ["events", "total_value", "users", "values"]


def rolled_up(df: DataFrame, ts: str, by: str, user: str, value: str, width: str) -> DataFrame:
    """(window_start, group, events, total_value, users, values) a tumbling window.
    Null users and values are left out of the sketches."""
    return (
        df.groupBy(F.window(ts, width)["start"].alias("window_start"), F.col(by).alias("group"))
        .agg(
            F.count("*").alias("events"),
            F.sum(F.col(value).cast("decimal(18,4)")).alias("total_value"),
            F.hll_sketch_agg(F.col(user).cast("string"), F.lit(LOG_K)).alias("users"),
            F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(KLL_K)).alias("values"),
        )
    )


def merged(windows: DataFrame, width: str) -> DataFrame:
    """Stored windows put together into longer ones, of the same shape."""
    return (
        windows.groupBy(F.window("window_start", width)["start"].alias("window_start"), "group")
        .agg(
            F.sum("events").alias("events"),
            F.sum("total_value").cast("decimal(18,4)").alias("total_value"),
            F.hll_union_agg("users", F.lit(False)).alias("users"),
            F.kll_merge_agg_double("values").alias("values"),
        )
    )


def readings(windows: DataFrame, quantiles: list[float]) -> DataFrame:
    """What windows say: counts, sums, estimated distinct users and quantiles."""
    ranks = F.array(*map(F.lit, quantiles))
    return windows.select(
        "window_start", "group", "events", F.col("total_value").cast("double").alias("total_value"),
        F.hll_sketch_estimate("users").alias("distinct_users"),
        F.kll_sketch_get_quantile_double("values", ranks).alias("quantiles"),
    )
