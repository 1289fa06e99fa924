"""Sinks and target tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import match, tables
from millrace.session import shared_dir
from millrace.sources import ingest
from millrace.sources.collections import ensure_database
from millrace.streaming import sinks
from workload.common import (
    PURCHASE_CLICK, drained, event_stream, events, match_cte, ntz, query, sides, table,
)

_SESSION_SQL = """SELECT CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
    CAST(user_id AS VARCHAR) AS user_id, date_trunc('second', ts) AS timestamp,
    CASE WHEN value > 10 THEN event_type END AS page_url,
    CAST(NULL AS VARCHAR) AS user_agent, CAST(NULL AS VARCHAR) AS ip_address,
    CAST(event_id % 3600 AS BIGINT) AS session_duration,
    CASE WHEN value > 30 THEN CAST(event_id % 20 AS INT) END AS page_views
  FROM events"""


def session_source(spark, sf):
    """Events under the raw session names, with a column the table lacks."""
    rows = events(spark, sf)
    user = F.col("user_id").cast("string")
    return tables.session_rows(
        rows.select(
            F.concat_ws("-", user, F.col("ts").cast("date").cast("string")).alias("session_id"),
            user.alias("user_id"),
            F.col("ts").alias("timestamp"),
            F.when(F.col("value") > 10, F.col("event_type")).alias("page"),
            (F.col("event_id") % 3600).cast("int").alias("duration_ms"),
            F.when(F.col("value") > 30, (F.col("event_id") % 20).cast("int")).alias("page_views"),
            F.col("props").alias("not_in_table"),
        )
    )


@query("table_sink", "SELECT event_id, user_id, event_type, value FROM events")
def table_sink(spark, sf):
    """A stream into a stored table, read back."""
    rows = event_stream(spark, sf).select("event_id", "user_id", "event_type", "value")
    root = shared_dir(spark, "table-sink")
    writer = sinks.folder_writer(f"{root}/out")
    sinks.start_sink(rows, writer, f"{root}/checkpoint", interval=None).awaitTermination()
    return sinks.read_folder(spark, f"{root}/out", rows.schema)


@query("align_columns", _SESSION_SQL)
def align_columns(spark, sf):
    out = tables.align_columns(session_source(spark, sf), tables.USER_SESSIONS_CLEAN)
    return ntz(out, "timestamp")


@query(
    "convert_values",
    """SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
              '{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}' AS detail,
              o_totalprice
       FROM orders""",
)
def convert_values(spark, sf):
    rows = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate",
        F.struct(
            F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority")
        ).alias("detail"),
        "o_totalprice",
    )
    return tables.convert_values(rows)


@query("retry_write", "SELECT event_id, value FROM events")
def retry_write(spark, sf):
    """The first attempt at each batch fails; the rows still land once."""
    root = shared_dir(spark, "retry")
    inner = sinks.folder_writer(f"{root}/out")
    tried = set()

    def flaky(df, batch_id):
        if batch_id not in tried:
            tried.add(batch_id)
            raise OSError("store not reachable")
        inner(df, batch_id)

    rows = event_stream(spark, sf).select("event_id", "value")
    write = sinks.retry_write(flaky, sleep=lambda _: None)
    sinks.start_sink(rows, write, f"{root}/checkpoint", interval=None).awaitTermination()
    return sinks.read_folder(spark, f"{root}/out", rows.schema)


@query("drain", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def drain(spark, sf):
    out = drained(event_stream(spark, sf).select("event_type"), "drain")
    return out.groupBy("event_type").agg(F.count("*").alias("events"))


@query("create_table", f"WITH rows AS ({_SESSION_SQL}) SELECT * REPLACE (coalesce(page_views, 1) AS page_views) FROM rows")
def create_table(spark, sf):
    """A catalog table, loaded and read by name."""
    ensure_database(spark, "millrace_tables")
    spec = tables.USER_SESSIONS_CLEAN
    full = f"`millrace_tables`.`{spec.name}`"
    spark.sql(f"DROP TABLE IF EXISTS {full}")
    tables.create_table(spark, spec, "millrace_tables", shared_dir(spark, "sessions"))
    good, _ = tables.load_rows(session_source(spark, sf), spec)
    tables.sort_key(good, spec).write.insertInto(full)
    return ntz(spark.table(full), "timestamp")


@query(
    "apply_defaults_not_null",
    """SELECT event_id AS transaction_id, CAST(user_id AS VARCHAR) AS user_id,
              CASE WHEN value > 20 THEN 'EUR' ELSE 'USD' END AS currency,
              CASE WHEN event_type = 'error' THEN 'null_amount' END AS error_reason
       FROM events""",
)
def apply_defaults_not_null(spark, sf):
    rows = events(spark, sf).select(
        F.col("event_id").cast("string").alias("transaction_id"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("value")).alias("amount"),
        F.when(F.col("value") > 20, "EUR").alias("currency"),
    )
    good, bad = tables.load_rows(rows, tables.ENRICHED_TRANSACTIONS)
    both = good.withColumn("error_reason", F.lit(None).cast("string")).unionByName(bad)
    return both.select(
        F.col("transaction_id").cast("bigint").alias("transaction_id"), "user_id", "currency",
        "error_reason",
    )


@query(
    "sort_key",
    f"""WITH rows AS ({_SESSION_SQL}) SELECT session_id, timestamp, true AS in_order FROM rows""",
)
def sort_key(spark, sf):
    """Rows ordered inside each range; ``in_order`` compares with the row before."""
    spec = tables.USER_SESSIONS_CLEAN
    out = tables.align_columns(session_source(spark, sf), spec)
    ordered = tables.sort_key(out.select("session_id", "timestamp"), spec, partitions=8)

    def check(batches):
        import pyarrow as pa

        last = None
        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(0).to_pylist()))
            flags = []
            for k in keys:
                flags.append(last is None or last <= k)
                last = k
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(flags, pa.bool_())],
                names=["session_id", "timestamp", "in_order"],
            )

    checked = ordered.mapInArrow(check, "session_id string, timestamp timestamp, in_order boolean")
    return ntz(checked, "timestamp")


def _newest(rows, ts):
    return rows.agg(F.max(ts)).first()[0]


@query(
    "retention_ttl",
    """SELECT o_orderkey, o_orderdate FROM orders
       WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 7 YEAR""",
)
def retention_ttl(spark, sf):
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return tables.retention(rows, "o_orderdate", tables.ENRICHED_TRANSACTIONS.ttl, _newest(rows, "o_orderdate"))


@query(
    "retention_sessions",
    """SELECT event_id, ts FROM events WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 10 DAY""",
)
def retention_sessions(spark, sf):
    rows = events(spark, sf).select("event_id", "ts")
    return tables.retention(rows, "ts", "10 DAY", _newest(rows, "ts"))


@query(
    "topic_sink",
    """SELECT CAST(event_id AS VARCHAR) AS key,
              '{"id":' || event_id || ',"user_id":' || user_id || ',"event_type":"' || event_type || '"}'
                AS value
       FROM events""",
)
def topic_sink(spark, sf):
    rows = events(spark, sf).select(
        F.col("event_id").alias("id"), "user_id", "event_type"
    )
    return ingest.to_topic(rows, "id", "clean-events").drop("topic")


@query(
    "sink_stats",
    """SELECT count(*) AS events_received, count(*) AS events_inserted,
              CAST(100 AS DOUBLE) AS success_rate_percent, 0 AS pending_events FROM events""",
)
def sink_stats(spark, sf):
    root = shared_dir(spark, "stats")
    rows = event_stream(spark, sf).select("event_id", "value")
    done = sinks.drain(rows, f"{root}/out", f"{root}/checkpoint")
    stored = sinks.read_folder(spark, f"{root}/out", rows.schema)
    stats = sinks.sink_stats(sinks.progress_frame(spark, done.recentProgress), stored)
    return stats.select(
        "events_received", "events_inserted", "success_rate_percent", "pending_events"
    )


@query(
    "session_table",
    f"""WITH rows AS ({_SESSION_SQL})
        SELECT * REPLACE (coalesce(page_views, 1) AS page_views) FROM rows
        WHERE timestamp > (SELECT date_trunc('second', max(ts)) FROM events) - INTERVAL 90 DAY""",
)
def session_table(spark, sf):
    spec = tables.USER_SESSIONS_CLEAN
    good, _ = tables.load_rows(session_source(spark, sf), spec)
    kept = tables.retention(good, spec.ttl_column, spec.ttl, _newest(good, spec.ttl_column))
    return ntz(tables.sort_key(kept, spec), "timestamp")


@query(
    "transactions_table",
    f"""WITH RECURSIVE {PURCHASE_CLICK}, {match_cte("sides", "INTERVAL 6 HOURS")}
        SELECT CAST(l AS VARCHAR) AS transaction_id, k AS user_id, date_trunc('second', lt) AS timestamp,
               CAST(p.value AS DECIMAL(10,2)) AS amount, 'USD' AS currency,
               CAST(NULL AS VARCHAR) AS merchant_name, p.event_type AS category,
               c.c_name AS user_name, CAST(NULL AS VARCHAR) AS user_email,
               c.c_mktsegment AS user_tier, CAST(c.c_nationkey AS VARCHAR) AS user_country
        FROM found JOIN events p ON p.event_id = l LEFT JOIN customer c ON CAST(c.c_custkey AS VARCHAR) = k""",
)
def transactions_table(spark, sf):
    """Purchases matched one-to-one with profile sightings and flattened; users
    that are no customers stay, without a profile."""
    left, right = sides(spark, sf)
    people = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("tier"),
        F.col("c_nationkey").cast("string").alias("country"),
    )
    profiles = right.select("event_id", "user_id", "ts").join(people, "user_id", "left")
    pairs = match.temporal_match(left, right, "user_id", "ts", "event_id", "6h", unique_ids=True)
    joined = match.joined_projection(pairs, left, profiles, "ts", "event_id", "user_id", unique_ids=True)
    flat = tables.transaction_rows(joined).withColumnsRenamed(
        {"event_id": "transaction_id", "ts": "timestamp", "value": "amount", "event_type": "category"}
    )
    spec = tables.ENRICHED_TRANSACTIONS
    good, _ = tables.load_rows(flat, spec)
    return ntz(tables.sort_key(good, spec), "timestamp")


@query(
    "analytics_table",
    """SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, date_trunc('second', ts) AS timestamp,
              CAST(user_id AS VARCHAR) AS user_id, CAST(NULL AS VARCHAR) AS session_id,
              '{"k":' || regexp_extract(props, '([0-9]+)', 1) || '}' AS properties,
              CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS platform,
              CAST(NULL AS VARCHAR) AS country, value
       FROM events""",
)
def analytics_table(spark, sf):
    rows = events(spark, sf).select(
        "event_id", "event_type", F.col("ts").alias("timestamp"), "user_id",
        F.try_parse_json("props").alias("properties"), "value",
    )
    spec = tables.REAL_TIME_ANALYTICS
    good, _ = tables.load_rows(rows, spec)
    return ntz(tables.sort_key(good, spec), "timestamp")
