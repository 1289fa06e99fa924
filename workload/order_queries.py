"""Deduplication and joins: the operators that depend on event order."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.keys import canonical_key
from millrace.operators import dedup, match
from millrace.plans import counters
from millrace.session import shared_dir
from millrace.sources import ingest
from millrace.streaming import stateful
from workload.common import (
    MESSAGES, PURCHASE_CLICK, anchor_cte, drained, event_stream, event_topic, events,
    match_cte, ntz, query, sides,
)

DAY, SIX_HOURS = "INTERVAL 24 HOURS", "INTERVAL 6 HOURS"
_USER_WALK = anchor_cte("events", "user_id", "ts", "event_id", DAY, "event_id, event_type, value")


# -------------------------------------------------------------- deduplication

@query(
    "dedup_anchor",
    f"""WITH RECURSIVE {_USER_WALK}
        SELECT event_id, k AS user_id, t AS ts, event_type, value FROM verdicts WHERE keep""",
)
def dedup_anchor(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    return dedup.dedup_anchor(rows, "user_id", "ts", "24h", ["event_id"])


@query(
    "dedup_resent",
    f"""WITH RECURSIVE both_sends AS (
          SELECT event_id, ts FROM events
          UNION ALL SELECT event_id, ts + INTERVAL 30 SECONDS FROM events),
        {anchor_cte("both_sends", "event_id", "ts", "ts", "INTERVAL 1 HOUR")}
        SELECT k AS event_id, t AS ts FROM verdicts WHERE keep""",
)
def dedup_resent(spark, sf):
    """Every message is sent again half a minute later, and dropped."""
    rows = events(spark, sf).select("event_id", "ts")
    again = rows.withColumn("ts", F.expr("ts + INTERVAL 30 SECONDS"))
    return dedup.dedup_anchor(rows.unionAll(again), "event_id", "ts", "1h")


@query(
    "dedup_large_keys",
    f"""WITH RECURSIVE {anchor_cte("events", "event_type", "ts", "event_id", "INTERVAL 1 HOUR", "event_id")}
        SELECT event_id, k AS event_type, t AS ts FROM verdicts WHERE keep""",
)
def dedup_large_keys(spark, sf):
    """Five keys hold everything; each is cut into time slices."""
    rows = events(spark, sf).select("event_id", "event_type", "ts")
    return dedup.dedup_anchor(rows, "event_type", "ts", "1h", ["event_id"], hot_rows=1_000)


@query(
    "dedup_minute_bucket",
    """SELECT event_id, event_type, ts FROM events
       QUALIFY row_number() OVER (PARTITION BY event_type, date_trunc('minute', ts)
                                  ORDER BY ts, event_id) = 1""",
)
def dedup_minute_bucket(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "ts")
    return dedup.dedup_minute_bucket(rows, "event_type", "ts", "24h", ["event_id"])


@query(
    "dedup_minute_bucket_short",
    f"""WITH RECURSIVE cut AS (
          SELECT event_id, ts, event_type, event_type || ' ' || date_trunc('minute', ts) AS m FROM events),
        {anchor_cte("cut", "m", "ts", "event_id", "INTERVAL 10 SECONDS", "event_id, event_type")}
        SELECT event_id, event_type, t AS ts FROM verdicts WHERE keep""",
)
def dedup_minute_bucket_short(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "ts")
    return dedup.dedup_minute_bucket(rows, "event_type", "ts", "10s", ["event_id"])


@query(
    "dedup_annotate",
    f"""WITH RECURSIVE {_USER_WALK}
        SELECT event_id, t AS ts, NOT keep AS is_duplicate, anchor AS first_seen,
               CAST(k AS VARCHAR) AS key_value
        FROM verdicts""",
)
def dedup_annotate(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    return dedup.dedup_annotate(rows, "user_id", "ts", "24h", ["event_id"]).drop("user_id")


@query(
    "dedup_batch",
    f"""WITH RECURSIVE {anchor_cte("events", "event_type", "ts", "event_id", "INTERVAL 10 MINUTES", "event_id")}
        SELECT event_id, NOT keep AS is_duplicate, anchor AS first_seen, k AS key_value FROM verdicts""",
)
def dedup_batch(spark, sf):
    rows = events(spark, sf).select("event_id", "event_type", "ts")
    out = dedup.dedup_batch(rows, "event_type", "ts", "10m", ["event_id"])
    return out.select("event_id", "is_duplicate", "first_seen", "key_value")


@query(
    "dedup_stream",
    f"""WITH RECURSIVE {_USER_WALK}
        SELECT event_id, k AS user_id, t AS ts FROM verdicts WHERE keep""",
)
def dedup_stream(spark, sf):
    rows = event_stream(spark, sf).select("event_id", "user_id", "ts")
    out = stateful.dedup_stream(rows, "user_id", "ts", "24h", "event_id")
    return ntz(drained(out, "dedup-stream"), "ts")


@query(
    "dedup_stream_batches",
    "SELECT event_id, CAST(user_id AS VARCHAR) AS key_value FROM events",
)
def dedup_stream_batches(spark, sf):
    """Four micro-batches in no order of time: every event is judged, none is too
    late."""
    rows = events(spark, sf).select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    path = shared_dir(spark, "batches")
    part = F.pmod(F.xxhash64("event_id"), F.lit(4)).alias("part")
    rows.select("*", part).write.partitionBy("part").parquet(path)
    # However many tasks wrote it, a quarter of the files at a time.
    written = spark.read.parquet(path)
    each = max(1, -(-len(written.inputFiles()) // 4))
    late = ingest.file_stream(spark, path, written.schema, files_per_trigger=each)
    out = stateful.dedup_stream(late, "user_id", "ts", "24h", "event_id", annotate=True)
    return drained(out.select("event_id", "key_value"), "dedup-batches")


@query(
    "dedup_expire",
    f"""WITH RECURSIVE {anchor_cte("events", "user_id", "ts", "event_id", "INTERVAL 1 HOUR", "event_id")},
        passed AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 10 MINUTES AS w FROM events)
        SELECT event_id, k AS user_id, t AS ts FROM verdicts, passed WHERE keep AND t < w""",
)
def dedup_expire(spark, sf):
    """Rows come out as the watermark passes them; lapsed anchors are dropped."""
    rows = event_stream(spark, sf).select("event_id", "user_id", "ts")
    out = stateful.dedup_stream(rows, "user_id", "ts", "1h", "event_id", emit="on_watermark")
    return ntz(drained(out, "dedup-expire"), "ts")


@query(
    "dedup_window_cap",
    f"""WITH RECURSIVE {anchor_cte("events", "user_id", "ts", "event_id", "INTERVAL 7 DAYS", "event_id")}
        SELECT event_id, k AS user_id, t AS ts FROM verdicts WHERE keep""",
)
def dedup_window_cap(spark, sf):
    """A window of thirty days is used as seven."""
    rows = events(spark, sf).select("event_id", "user_id", "ts")
    return dedup.dedup_anchor(rows, "user_id", "ts", "30d", ["event_id"])


_TOPIC_WALK = f"""{MESSAGES}, ok AS (SELECT * FROM messages WHERE reason IS NULL),
  {anchor_cte("ok", "key_value", "ts", "event_id", DAY, "id, event_id, event_type, value")}"""


@query(
    "dedup_metrics",
    f"""WITH RECURSIVE {_TOPIC_WALK}
        SELECT (SELECT count(*) FROM events) AS events_processed,
               count(*) FILTER (NOT keep) AS events_deduped,
               count(*) FILTER (NOT keep) AS duplicates_blocked,
               count(*) FILTER (NOT keep) AS cache_hits,
               count(*) FILTER (keep) AS cache_misses,
               (SELECT count(*) FROM messages WHERE reason IS NOT NULL) AS error_count
        FROM verdicts""",
)
def dedup_metrics(spark, sf):
    rows = ingest.require_key(ingest.json_decode(event_topic(spark, sf)), "user_id")
    good, bad = ingest.split_errors(rows)
    judged = dedup.dedup_annotate(
        good.select("key_value", "timestamp", "offset").withColumnRenamed("key_value", "k"),
        "k", "timestamp", "24h", ["offset"],
    )
    return dedup.dedup_metrics(judged, bad)


@query(
    "dedup_metrics_observed",
    f"""WITH RECURSIVE {_TOPIC_WALK}
        SELECT count(*) AS events_processed, count(*) FILTER (NOT keep) AS events_deduped,
               count(*) FILTER (NOT keep) AS duplicates_blocked, count(*) FILTER (NOT keep) AS cache_hits,
               count(*) FILTER (keep) AS cache_misses, 0 AS error_count
        FROM verdicts""",
)
def dedup_metrics_observed(spark, sf):
    """Counters of the events judged, taken while the kept ones are written."""
    rows = ingest.require_key(ingest.json_decode(event_topic(spark, sf)), "user_id")
    good, _ = ingest.split_errors(rows)
    judged = dedup.dedup_annotate(
        good.select("key_value", "timestamp", "offset").withColumnRenamed("key_value", "k"),
        "k", "timestamp", "24h", ["offset"],
    )
    path = shared_dir(spark, "kept")
    return counters.observed(
        judged, lambda df: df.filter(~F.col("is_duplicate")).write.parquet(path), dedup.dedup_counters()
    )


@query(
    "dedup_joined",
    f"""WITH RECURSIVE {PURCHASE_CLICK}, {match_cte("sides", SIX_HOURS)},
        made AS (SELECT 'joined_' || l || '_' || r AS joined_id, k AS user_id,
                        greatest(lt, rt) AS made_at FROM found),
        {anchor_cte("made", "user_id", "made_at", "joined_id", DAY, "joined_id")}
        SELECT joined_id, k AS user_id, t AS made_at FROM verdicts WHERE keep""",
)
def dedup_joined(spark, sf):
    """Joined events deduplicated on a field found in the left payload."""
    left, right = sides(spark, sf)
    pairs = match.temporal_match(left, right, "user_id", "ts", "event_id", "6h", unique_ids=True)
    joined = match.joined_projection(pairs, left, right, "ts", "event_id", "user_id", unique_ids=True)
    rows = joined.select(
        "joined_id",
        canonical_key(joined, "left_data.user_id").alias("user_id"),
        F.greatest("left_time", "right_time").alias("made_at"),
    )
    return dedup.dedup_anchor(rows, "user_id", "made_at", "24h", ["joined_id"])


# ---------------------------------------------------------------------- joins

_PAIRS = f"WITH RECURSIVE {PURCHASE_CLICK}, {match_cte('sides', SIX_HOURS)}"
_LEDGER = f"""{_PAIRS}, ledger AS (
  SELECT s.k AS join_key, CASE WHEN s.side = 0 THEN 'left' ELSE 'right' END AS side,
         s.id AS event_id, s.ts AS event_time,
         CASE WHEN s.side = 0 THEN f.r ELSE f.l END AS matched_id,
         CASE WHEN s.side = 0 THEN f.rt ELSE f.lt END AS matched_time,
         f.l IS NOT NULL AS is_joined,
         f.l IS NULL OR CASE WHEN s.side = 0 THEN (f.lt, f.l) < (f.rt, f.r)
                             ELSE (f.rt, f.r) < (f.lt, f.l) END AS orphan_on_arrival
  FROM sides s LEFT JOIN found f
    ON (s.side = 0 AND f.l = s.id) OR (s.side = 1 AND f.r = s.id))"""


def _ledger(spark, sf, **options):
    left, right = sides(spark, sf)
    options.setdefault("unique_ids", True)
    return match.match_ledger(left, right, "user_id", "ts", "event_id", "6h", **options)


@query(
    "temporal_match",
    f"""{_PAIRS} SELECT k AS join_key, l AS left_id, r AS right_id, lt AS left_time, rt AS right_time
        FROM found""",
)
def temporal_match(spark, sf):
    return match.pairs(_ledger(spark, sf))


@query(
    "temporal_match_large_keys",
    f"""WITH RECURSIVE sides AS (
          SELECT 'all' AS k, event_id AS id, ts, (event_type = 'click')::INT AS side
          FROM events WHERE event_type IN ('purchase', 'click')),
        {match_cte("sides", "INTERVAL 5 MINUTES")}
        SELECT l AS left_id, r AS right_id FROM found""",
)
def temporal_match_large_keys(spark, sf):
    """One key holds everything; it is cut into time slices."""
    left, right = (s.withColumn("k", F.lit("all")) for s in sides(spark, sf))
    pairs = match.temporal_match(
        left, right, "k", "ts", "event_id", "5m", unique_ids=True, hot_rows=500
    )
    return pairs.select("left_id", "right_id")


@query("match_ledger", f"{_LEDGER} SELECT * FROM ledger")
def match_ledger(spark, sf):
    return _ledger(spark, sf)


def _stream_sides(spark, sf):
    rows = event_stream(spark, sf).select("event_id", "user_id", "ts", "event_type", "value")
    return rows.filter("event_type = 'purchase'"), rows.filter("event_type = 'click'")


@query(
    "temporal_match_stream",
    f"""{_PAIRS} SELECT 'joined_' || l || '_' || r AS joined_id, k AS join_key, lt AS left_time,
               rt AS right_time, abs(epoch_us(rt) - epoch_us(lt)) * 1000 AS join_delay
        FROM found""",
)
def temporal_match_stream(spark, sf):
    left, right = _stream_sides(spark, sf)
    out = stateful.match_stream(left, right, "user_id", "ts", "event_id", "6h")
    slim = out.select("joined_id", "join_key", "left_time", "right_time", "join_delay")
    return ntz(drained(slim, "match-stream"), "left_time", "right_time")


@query(
    "interval_join_all",
    """SELECT l.user_id, l.event_id AS left_event_id, r.event_id AS right_event_id
       FROM events l JOIN events r ON l.user_id = r.user_id
         AND r.ts BETWEEN l.ts - INTERVAL 1 HOUR AND l.ts + INTERVAL 1 HOUR
       WHERE l.event_type = 'purchase' AND r.event_type = 'click'""",
)
def interval_join_all(spark, sf):
    left, right = (s.select("user_id", "event_id", "ts") for s in sides(spark, sf))
    out = match.interval_join_all(left, right, "user_id", "ts", "1h")
    return out.select(F.col("left_user_id").alias("user_id"), "left_event_id", "right_event_id")


@query(
    "interval_join_stream",
    """SELECT l.event_id AS left_event_id, r.event_id AS right_event_id
       FROM events l JOIN events r ON l.user_id = r.user_id
         AND r.ts BETWEEN l.ts - INTERVAL 1 HOUR AND l.ts + INTERVAL 1 HOUR
       WHERE l.event_type = 'purchase' AND r.event_type = 'click'""",
)
def interval_join_stream(spark, sf):
    left, right = (s.select("user_id", "event_id", "ts") for s in _stream_sides(spark, sf))
    out = match.interval_join_stream(left, right, "user_id", "ts", "1h")
    return drained(out.select("left_event_id", "right_event_id"), "interval-stream")


@query(
    "side_tag",
    """SELECT CASE WHEN event_type = 'purchase' THEN 'left' ELSE 'right' END AS side, event_id,
              CASE WHEN event_type = 'purchase' THEN value END AS value
       FROM events WHERE event_type IN ('purchase', 'click')""",
)
def side_tag(spark, sf):
    left, right = sides(spark, sf)
    return match.side_tag(left.select("event_id", "value"), right.select("event_id"))


@query(
    "joined_projection",
    f"""{_PAIRS} SELECT 'joined_' || l || '_' || r AS joined_id, k AS join_key,
               a.value AS left_value, b.props AS right_props, lt AS left_time, rt AS right_time,
               abs(epoch_us(rt) - epoch_us(lt)) * 1000 AS join_delay
        FROM found JOIN events a ON a.event_id = l JOIN events b ON b.event_id = r""",
)
def joined_projection(spark, sf):
    left, right = sides(spark, sf)
    out = match.joined_projection(
        match.pairs(_ledger(spark, sf)), left, right, "ts", "event_id", "user_id", unique_ids=True
    )
    return out.select(
        "joined_id", "join_key",
        F.col("left_data.value").alias("left_value"),
        F.col("right_data.props").alias("right_props"),
        "left_time", "right_time", "join_delay",
    )


@query(
    "orphans_final",
    f"{_LEDGER} SELECT join_key, side, event_id, event_time FROM ledger WHERE NOT is_joined",
)
def orphans_final(spark, sf):
    return match.orphans_final(_ledger(spark, sf))


@query(
    "orphans_on_arrival",
    f"""{_LEDGER} SELECT side, count(*) FILTER (orphan_on_arrival) AS orphaned_events
        FROM ledger GROUP BY side""",
)
def orphans_on_arrival(spark, sf):
    return match.orphans_on_arrival(_ledger(spark, sf))


@query(
    "late_flag",
    """SELECT event_id, (event_id % 7) > 4 AS is_late FROM events""",
)
def late_flag(spark, sf):
    rows = _arrived(events(spark, sf).select("event_id", "ts"))
    return match.late_flag(rows, "ts", "arrived", "4m").select("event_id", "is_late")


def _arrived(rows):
    """Events that arrive up to six minutes after their time."""
    delay = F.make_dt_interval(mins=(F.col("event_id") % 7).cast("int"))
    return rows.withColumn("arrived", F.col("ts") + delay)


@query(
    "join_buffer_retention",
    f"""{_PAIRS}, passed AS (
          SELECT least(max(ts) FILTER (event_type = 'purchase'), max(ts) FILTER (event_type = 'click'))
                 AS w FROM events)
        SELECT 'joined_' || l || '_' || r AS joined_id FROM found, passed
        WHERE greatest(lt, rt) < date_trunc('milliseconds', w) - INTERVAL 5 MINUTES""",
)
def join_buffer_retention(spark, sf):
    """Rows are taken as the watermark (five minutes behind the slower side)
    passes them; waiting rows leave after the window plus five minutes."""
    left, right = _stream_sides(spark, sf)
    out = stateful.match_stream(
        left, right, "user_id", "ts", "event_id", "6h", emit="on_watermark", retention="5m"
    )
    return drained(out.select("joined_id"), "match-retention")


@query(
    "buffer_last_write_wins",
    f"""WITH RECURSIVE sides AS (
          SELECT CAST(user_id AS VARCHAR) AS k, event_id % 3 AS id, ts,
                 (event_type = 'click')::INT AS side
          FROM events WHERE event_type IN ('purchase', 'click')),
        {match_cte("sides", SIX_HOURS, replace=True)}
        SELECT k AS join_key, l AS left_id, r AS right_id, lt AS left_time, rt AS right_time FROM found""",
)
def buffer_last_write_wins(spark, sf):
    """Only three ids: a repeated id replaces the one that waits."""
    left, right = (
        s.withColumn("event_id", F.col("event_id") % 3) for s in sides(spark, sf)
    )
    return match.pairs(match.match_ledger(left, right, "user_id", "ts", "event_id", "6h"))


@query(
    "join_cleanup",
    f"""{_LEDGER} SELECT side, count(*) AS swept_events FROM ledger
        WHERE NOT is_joined
          AND event_time + INTERVAL 6 HOURS + INTERVAL 5 MINUTES < (SELECT max(ts) FROM sides)
        GROUP BY side""",
)
def join_cleanup(spark, sf):
    """Waiting events whose time has run out by the newest event."""
    ledger = _ledger(spark, sf)
    newest = F.lit(ledger.agg(F.max("event_time")).first()[0]).cast("timestamp_ntz")
    return match.sweep(ledger, "6h", newest)[1].groupBy("side").agg(
        F.count("*").alias("swept_events")
    )


_METRICS = """SELECT count(*) FILTER (side = 'left') AS left_events_processed,
       count(*) FILTER (side = 'right') AS right_events_processed,
       count(*) FILTER (side = 'left' AND is_joined) AS successful_joins,
       count(*) FILTER (side = 'left' AND orphan_on_arrival) AS orphaned_left_events,
       count(*) FILTER (side = 'right' AND orphan_on_arrival) AS orphaned_right_events,
       count(*) FILTER (event_id % 7 > 4 AND orphan_on_arrival) AS late_arrivals,
       0 AS error_count,
       count(*) FILTER (NOT is_joined) AS state_store_size
  FROM ledger"""


def _metrics(spark, sf):
    left, right = map(_arrived, sides(spark, sf))
    ledger = match.flag_ledger(
        _ledger(spark, sf), left, right, "user_id", "ts", "event_id", "arrived", "4m"
    )
    return match.join_metrics(ledger, late="is_late")


@query("join_metrics", f"{_LEDGER} {_METRICS}")
def join_metrics(spark, sf):
    return _metrics(spark, sf)


@query(
    "join_metrics_observed",
    f"{_LEDGER}, m AS ({_METRICS}) SELECT * REPLACE (0 AS late_arrivals) FROM m",
)
def join_metrics_observed(spark, sf):
    """The same counters, taken while the ledger is written."""
    return counters.observed(
        _ledger(spark, sf), lambda rows: rows.write.parquet(shared_dir(spark, "ledger")),
        match.join_counters(),
    )


@query(
    "join_stats",
    f"""{_LEDGER}, m AS ({_METRICS})
        SELECT left_events_processed + right_events_processed AS total_events_processed,
               successful_joins,
               CAST(successful_joins AS DOUBLE) / (left_events_processed + right_events_processed) * 100
                 AS join_rate_percent,
               CAST(successful_joins AS DOUBLE) / (left_events_processed + right_events_processed) * 100 * 2
                 AS match_rate_percent,
               orphaned_left_events + orphaned_right_events AS orphaned_events,
               late_arrivals, state_store_size, error_count,
               CAST(21600000000 AS BIGINT) AS time_window_micros
        FROM m""",
)
def join_stats(spark, sf):
    return match.join_stats(_metrics(spark, sf), "6h")
