"""Envelopes and routing, whole flows and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import routing, sagas, task_queue
from millrace.plans import control, counters, flows, metrics, rollups, spec
from millrace.session import shared_dir
from millrace.streaming.saga_state import saga_stream
from millrace.streaming.sinks import folder_writer
from millrace.streaming.task_state import released_tasks
from workload.common import (
    ORACLES,
    MESSAGES, anchor_cte, as_topic, drained, event_stream, event_topic, events,
    match_cte, ntz, query, stream, table,
)

HANDLED = ["purchase", "signup"]
# What filling an order takes (name, command, compensation).
ORDER_STEPS = (
    ("credit", "hold_credit", "free_credit"),
    ("lines", "pick_lines", "restock_lines"),
    ("freight", "book_freight", "unbook_freight"),
    ("invoice", "issue_invoice", "void_invoice"),
)


# ------------------------------------------------------- envelopes and routes

def _tasks(spark, sf):
    return routing.task_envelope(
        events(spark, sf), F.col("event_type"), ["user_id", "value"],
        task_id=F.concat(F.lit("task-"), F.col("event_id").cast("string")), at=F.col("ts"),
    )


def _published(spark, sf):
    return routing.event_envelope(
        events(spark, sf), F.col("event_type"), F.lit("shop"), F.col("user_id"), ["value"],
        event_id=F.concat(F.lit("ev-"), F.col("event_id").cast("string")), at=F.col("ts"),
    )


def _header(n):
    return F.col("headers")[n]["value"]


@query(
    "task_envelope",
    """SELECT 'task-' || event_id AS id, 'task-' || event_id AS key, event_type AS type, 1 AS priority,
              0 AS retries, 3 AS max_retries, ts AS timestamp, event_type AS task_type_header,
              '1' AS priority_header, CAST(user_id AS VARCHAR) AS payload_user, event_type AS value_type
       FROM events""",
)
def task_envelope(spark, sf):
    return _tasks(spark, sf).select(
        "id", "key", "type", "priority", "retries", "max_retries", "timestamp",
        _header(0).alias("task_type_header"), _header(1).alias("priority_header"),
        F.get_json_object("value", "$.payload.user_id").alias("payload_user"),
        F.get_json_object("value", "$.type").alias("value_type"),
    )


@query(
    "task_route",
    """SELECT 'task-' || event_id AS id, event_type AS handled_by,
              CASE WHEN event_type = 'purchase' THEN value * 2 END AS charged,
              CASE WHEN event_type = 'signup' AND value < 5 THEN 1 ELSE 0 END AS retries
       FROM events WHERE event_type IN ('purchase', 'signup')""",
)
def task_route(spark, sf):
    """Purchases are charged; signups under 5 fail and come back for a retry."""
    handlers = {
        "purchase": {"charged": F.col("payload.value") * 2},
        "signup": {"error": F.when(F.col("payload.value") < 5, "value too small")},
    }
    done = routing.task_outcomes(_tasks(spark, sf), handlers)
    return done.select("id", "handled_by", "charged", "retries")


# Purchases of uneven value ask for their hour; a signup of value v fails v % 6 times.
def _queue_handlers():
    return {
        "purchase": {"charged": F.col("payload.value") * 2},
        "signup": {"error": F.when(F.col("retries") < F.floor("payload.value") % 6, "not ready")},
    }


_ATTEMPTS_SQL = """SELECT * FROM (
    SELECT 'task-' || event_id AS id, n AS retries, priority, ts,
           CASE WHEN event_type = 'purchase' THEN value * 2 END AS charged,
           CASE WHEN n < fails THEN 'not ready' END AS error,
           greatest(ts, scheduled_at) + INTERVAL 30 SECOND * (2 ** n - 1)::INT AS due,
           CASE WHEN n >= fails THEN 'done' WHEN n < 3 THEN 'retry' ELSE 'dead' END AS outcome
    FROM (SELECT *, CASE WHEN event_type = 'signup' THEN floor(value)::BIGINT % 6 ELSE 0 END AS fails,
                 event_id % 5 AS priority,
                 CASE WHEN event_id % 3 = 0 THEN ts + INTERVAL 1 MINUTE * (event_id % 600 - 100) END AS scheduled_at
          FROM events WHERE event_type IN ('purchase', 'signup')), (SELECT unnest([0, 1, 2, 3]) AS n)
    WHERE n <= fails)"""


def _queued(rows):
    tasks = routing.task_envelope(
        rows, F.col("event_type"), ["user_id", "value", "event_id"],
        task_id=F.concat(F.lit("task-"), F.col("event_id").cast("string")), at=F.col("ts"),
    ).drop("key", "value", "headers")
    n = F.col("payload.event_id")
    return tasks.withColumns({
        "priority": (n % 5).cast("int"),
        "scheduled_at": F.when(n % 3 == 0, F.col("timestamp") + F.make_dt_interval(mins=(n % 600 - 100).cast("int"))),
    })


@query("task_attempts", f"SELECT id, retries, charged, error, due, outcome FROM ({_ATTEMPTS_SQL})")
def task_attempts(spark, sf):
    """Schedules, and retries with growing waits."""
    done = task_queue.task_attempts(_queued(events(spark, sf)), _queue_handlers())
    return ntz(done.select("id", "retries", "charged", "error", "due", "outcome"), "due")


@query(
    "task_queue_stream",
    f"""SELECT id, retries, priority, outcome, due FROM ({_ATTEMPTS_SQL})
        WHERE date_trunc('minute', due) + INTERVAL 1 MINUTE
              <= (SELECT date_trunc('millisecond', max(ts)) FROM events WHERE event_type IN ('purchase', 'signup'))
                 - INTERVAL 10 MINUTE""",
)
def task_queue_stream(spark, sf):
    """What a delay queue has released when its stream has run dry."""
    tasks = _queued(event_stream(spark, sf)).filter(F.col("type").isin(*HANDLED))
    out = released_tasks(tasks, _queue_handlers())
    done = drained(out, "task-queue").select("id", "retries", "priority", "outcome", "due")
    return ntz(done, "due")


@query(
    "event_envelope",
    """SELECT 'ev-' || event_id AS id, event_type AS type, 'shop' AS source,
              CAST(user_id AS VARCHAR) AS subject, CAST(user_id AS VARCHAR) AS key, ts AS timestamp,
              '1.0' AS version, event_type AS h0, 'shop' AS h1, '1.0' AS h2, '1.0' AS value_version
       FROM events""",
)
def event_envelope(spark, sf):
    return _published(spark, sf).select(
        "id", "type", "source", "subject", "key", "timestamp", "version",
        _header(0).alias("h0"), _header(1).alias("h1"), _header(2).alias("h2"),
        F.get_json_object("value", "$.version").alias("value_version"),
    )


@query(
    "event_route",
    """SELECT 'ev-' || event_id AS id,
              CASE WHEN event_type IN ('purchase', 'signup') THEN event_type END AS handled_by,
              CASE event_type WHEN 'purchase' THEN value WHEN 'signup' THEN 50.0 END AS worth
       FROM events""",
)
def event_route(spark, sf):
    handlers = {"purchase": {"worth": F.col("data.value")}, "signup": {"worth": F.lit(50.0)}}
    done = routing.route(_published(spark, sf), handlers, keep_rest=True)
    return done.select("id", "handled_by", "worth")


@query(
    "route_counts",
    """SELECT event_type, event_type IN ('purchase', 'signup') AS handled, count(*) AS events
       FROM events GROUP BY event_type""",
)
def route_counts(spark, sf):
    return routing.route_counts(_published(spark, sf), HANDLED)


def _sagas(spark, sf, orders=None):
    return routing.saga_start(
        orders if orders is not None else table(spark, sf, "orders"),
        F.lit("order-filling"), ["o_custkey", "o_totalprice"], ORDER_STEPS,
        saga_id=F.concat(F.lit("saga-"), F.col("o_orderkey").cast("string")),
        at=F.col("o_orderdate"),
    )


@query(
    "saga_start",
    """SELECT 'saga-' || o_orderkey AS saga_id, 'saga.started' AS type, 'saga-orchestrator' AS source,
              'saga-' || o_orderkey AS subject, 'order-filling' AS saga_type, 4 AS steps,
              o_orderdate AS timestamp
       FROM orders""",
)
def saga_start(spark, sf):
    return routing.saga_events(_sagas(spark, sf)).select(
        "data.saga_id", "type", "source", "subject", "data.saga_type", "data.steps", "timestamp"
    )


@query(
    "saga_steps",
    """SELECT 'saga-' || o_orderkey AS saga_id, 'order-filling' AS saga_type, n AS step_no,
              ['credit', 'lines', 'freight', 'invoice'][n + 1] AS name,
              ['hold_credit', 'pick_lines', 'book_freight', 'issue_invoice'][n + 1] AS command,
              ['free_credit', 'restock_lines', 'unbook_freight', 'void_invoice'][n + 1]
                AS compensate_with, 'pending' AS status
       FROM orders, (SELECT unnest([0, 1, 2, 3]) AS n)""",
)
def saga_steps(spark, sf):
    return routing.saga_steps(_sagas(spark, sf))


# What the steps of an order answer: some fail, some have not answered, some answer
# before their turn, and some answer twice, the second time the other way round.
_STEP_OK, _STEP_THERE = "(k + 5 * n) % 11 <> 0", "(k + 3 * n) % 13 <> 0"
_UNDO_OK, _UNDO_THERE = "(k + n) % 17 <> 0", "(k + n) % 7 <> 0"
_STEP_HOURS = "CASE WHEN k % 5 = 0 THEN 5 - n ELSE n + 1 END"


def _answers(orders):
    rows = orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_orderdate").cast("timestamp").alias("d"),
        F.explode(F.sequence(F.lit(0), F.lit(3))).alias("n"),
    )
    each = F.inline(F.expr(f"""filter(array(
        named_struct('kind', 'step', 'ok', {_STEP_OK}, 'hours', {_STEP_HOURS}, 'there', {_STEP_THERE}),
        named_struct('kind', 'step', 'ok', NOT ({_STEP_OK}), 'hours', 9, 'there', k % 3 = 0 AND {_STEP_THERE}),
        named_struct('kind', 'undo', 'ok', {_UNDO_OK}, 'hours', 20 - n, 'there', {_UNDO_THERE})), x -> x.there)"""))
    return rows.select("k", "d", "n", each).selectExpr(
        "concat('saga-', k) AS saga_id", "n AS step_no", "kind", "ok",
        "d + make_dt_interval(0, hours) AS at", "concat_ws('-', k, n, kind, hours) AS event_id",
    )


_SAGA_CTE = f"""n4 AS (SELECT unnest([0, 1, 2, 3]) AS n),
  f AS (SELECT o_orderkey AS k, n, o_orderdate AS d,
               CASE WHEN {_STEP_THERE} THEN {_STEP_OK} END AS ok,
               o_orderdate + INTERVAL 1 HOUR * ({_STEP_HOURS}) AS "at"
        FROM (SELECT *, o_orderkey AS k FROM orders), n4),
  ahead AS (SELECT *, coalesce(bool_and(coalesce(ok, false)) OVER w, true) AS due,
                   greatest(d, coalesce(max("at") OVER w, d)) AS due_at
            FROM f WINDOW w AS (PARTITION BY k ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  broke AS (SELECT k, n AS b, d, greatest(due_at, "at") AS t FROM ahead WHERE due AND NOT ok),
  u AS (SELECT k, n, b, t, CASE WHEN {_UNDO_THERE} THEN {_UNDO_OK} END AS ok,
               d + INTERVAL 1 HOUR * (20 - n) AS "at"
        FROM broke JOIN n4 ON n < b),
  back AS (SELECT *, coalesce(bool_and(coalesce(ok, false)) OVER w, true) AS due,
                  greatest(t, coalesce(max("at") OVER w, t)) AS due_at
           FROM u WINDOW w AS (PARTITION BY k ORDER BY n DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
  given AS (SELECT k, n AS seq, n AS step_no, 'step' AS kind, due_at AS "at", ok,
                   ['hold_credit', 'pick_lines', 'book_freight', 'issue_invoice'][n + 1] AS command
            FROM ahead WHERE due
            UNION ALL
            SELECT k, 2 * b - n, n, 'undo', due_at, ok,
                   ['free_credit', 'restock_lines', 'unbook_freight', 'void_invoice'][n + 1]
            FROM back WHERE due)"""
_COMMANDS_SQL = f"""WITH {_SAGA_CTE}
    SELECT 'saga-' || k AS saga_id, seq, step_no, kind, command, "at" FROM given"""


@query(
    "saga_progress",
    f"""WITH {_SAGA_CTE},
          last AS (SELECT k, arg_max(kind, seq) AS kind, arg_max(coalesce(ok::VARCHAR, '-'), seq) AS ok,
                          arg_max(step_no, seq) AS step_no, max(seq) FILTER (kind = 'step') AS top
                   FROM given GROUP BY k),
          ends AS (SELECT k, max(CASE WHEN ok IS NULL THEN g."at" ELSE greatest(g."at", coalesce(f."at", g."at")) END) AS "at"
                   FROM given g LEFT JOIN (SELECT k, n, 'step' AS kind, "at" FROM f
                                           UNION ALL SELECT k, n, 'undo', "at" FROM u) f
                     USING (k, kind) WHERE f.n = g.step_no GROUP BY k)
        SELECT 'saga-' || k AS id,
               CASE WHEN kind = 'step' AND ok = '-' THEN 'running'
                    WHEN kind = 'step' AND ok = 'true' THEN 'completed'
                    WHEN kind = 'undo' AND ok = '-' THEN 'compensating' ELSE 'failed' END AS status,
               CASE WHEN kind = 'step' AND ok = 'true' THEN 4 ELSE top END AS current_step, ends."at" AS last_updated
        FROM last JOIN ends USING (k)""",
)
def saga_progress(spark, sf):
    done = sagas.saga_progress(_sagas(spark, sf), _answers(table(spark, sf, "orders")))
    return ntz(done.select("id", "status", "current_step", "last_updated"), "last_updated")


@query("saga_commands", _COMMANDS_SQL)
def saga_commands(spark, sf):
    done = sagas.saga_progress(_sagas(spark, sf), _answers(table(spark, sf, "orders")))
    return ntz(sagas.saga_commands(done), "at")


@query("saga_commands_stream", _COMMANDS_SQL)
def saga_commands_stream(spark, sf):
    """Starts and answers as streams; commands as they become due."""
    starts, orders = _sagas(spark, sf, stream(spark, sf, "orders")), stream(spark, sf, "orders")
    out = saga_stream(starts, _answers(orders)).drop("status")
    return ntz(drained(out, "sagas"), "at")


# ---------------------------------------------------------------- whole flows

TOPIC_FLOW = {
    "name": "user-events-clean",
    "source": {"type": "kafka", "topic": "events"},
    "processing": {
        "filtering": {
            "enabled": True, "rules": [{"field": "event_type", "operator": "ne", "value": "error"}]
        },
        "deduplication": {"enabled": True, "key": "user_id", "time_window": "24h"},
        "transformation": {
            "enabled": True,
            "rules": [
                {"field": "value", "type": "rename", "value": "amount"},
                {"field": "currency", "type": "default", "value": "USD"},
                {"field": "amount", "type": "cast", "value": "string"},
            ],
        },
    },
    "sink": {"type": "clickhouse", "table": "events_clean"},
}
_FLOW_WALK = f"""{MESSAGES},
  ok AS (SELECT * FROM messages WHERE reason IS NULL AND event_type <> 'error'),
  {anchor_cte("ok", "key_value", "ts", "event_id", "INTERVAL 24 HOURS", "id, event_id, value")}"""
_FLOW_COLUMNS = {
    "id": "string", "user_id": "string", "amount": "double", "currency": "string",
    "_pipeline_name": "string", "_kafka_offset": "bigint",
}
_FLOW_SQL = f"""WITH RECURSIVE {_FLOW_WALK}
    SELECT id, CASE WHEN k <> 'null' THEN k END AS user_id, value AS amount, 'USD' AS currency,
           'user-events-clean' AS _pipeline_name, event_id AS _kafka_offset
    FROM verdicts WHERE keep"""


@query(
    "flow_spec",
    """WITH RECURSIVE """ + f"""{MESSAGES},
        ok AS (SELECT * FROM messages WHERE decode_error IS NULL AND event_id % 103 <> 0),
        {anchor_cte("ok", "key_value", "ts", "event_id", "INTERVAL 1 HOUR", "id")}
        SELECT id, 'from-json' AS _pipeline_name FROM verdicts WHERE keep""",
)
def flow_spec(spark, sf):
    """The flow is given as JSON text, its window as nanoseconds."""
    text = """{"name": "from-json", "source": {"type": "kafka", "topic": "events"},
               "processing": {"deduplication":
                 {"enabled": true, "key": "user_id", "time_window": 3600000000000}},
               "sink": {"type": "kafka", "topic": "out"}}"""
    flow = flows.compile_flow(spec.parse(text), {"events": event_topic(spark, sf)})
    records = flows.sink_rows(flow)
    return records.select(
        F.col("key").alias("id"),
        F.get_json_object("value", "$._pipeline_name").alias("_pipeline_name"),
    )


def _topic_flow(spark, sf):
    return flows.compile_flow(spec.parse(TOPIC_FLOW), {"events": event_topic(spark, sf)})


@query("flow_topic", _FLOW_SQL)
def flow_topic(spark, sf):
    return flows.columns_of(_topic_flow(spark, sf).output, _FLOW_COLUMNS)


@query("flow_topic_stream", _FLOW_SQL)
def flow_topic_stream(spark, sf):
    """The same specification over a stream."""
    topic = as_topic(event_stream(spark, sf))
    flow = flows.compile_flow(spec.parse(TOPIC_FLOW), {"events": topic})
    return drained(flows.columns_of(flow.output, _FLOW_COLUMNS), "flow-topic")


@query(
    "flow_dead_letters",
    f"""WITH {MESSAGES} SELECT reason AS error_reason, count(*) AS records
        FROM messages WHERE reason IS NOT NULL GROUP BY reason""",
)
def flow_dead_letters(spark, sf):
    """The same flow run to its end; the records it could not use, by reason."""
    root = shared_dir(spark, "flow-letters")
    manager = control.FlowManager(spark, root)
    topics = {"events": as_topic(event_stream(spark, sf))}
    manager.create(spec.parse(TOPIC_FLOW), topics, folder_writer(f"{root}/out"), interval=None)
    manager.wait(TOPIC_FLOW["name"])
    letters = manager.dead_letters(TOPIC_FLOW["name"])["record"]
    return letters.groupBy("error_reason").agg(F.count("*").alias("records"))


JOIN_FLOW = {
    "name": "purchase-click-join",
    "source": {
        "type": "kafka-join",
        "join": {
            "left_topic": "purchase", "right_topic": "click", "join_key": "user_id",
            "join_type": "temporal", "time_window": "6h",
        },
    },
    "processing": {"deduplication": {"enabled": True, "key": "user_id", "time_window": "12h"}},
    "sink": {"type": "kafka", "topic": "joined"},
}
_JOIN_SIDES = f"""{MESSAGES}, sides AS (
    SELECT key_value AS k, event_id AS id, ts, (event_type = 'click')::INT AS side FROM messages
    WHERE reason IS NULL AND event_type IN ('purchase', 'click'))"""
_JOIN_WALK = f"""{_JOIN_SIDES}, {match_cte("sides", "INTERVAL 6 HOURS")},
  made AS (SELECT 'joined_evt_' || l || '_evt_' || r AS joined_id, k AS user_id,
                  greatest(lt, rt) AS made_at, abs(epoch_us(rt) - epoch_us(lt)) * 1000 AS join_delay
           FROM found),
  {anchor_cte("made", "user_id", "made_at", "joined_id", "INTERVAL 12 HOURS", "joined_id, join_delay")}"""


def _join_flow(spark, sf):
    rows = events(spark, sf)
    topics = {
        name: as_topic(rows.filter(F.col("event_type") == name), name)
        for name in ("purchase", "click")
    }
    return flows.compile_flow(spec.parse(JOIN_FLOW), topics)


_JOIN_SQL = f"""WITH RECURSIVE {_JOIN_WALK}
    SELECT joined_id AS key, joined_id, k AS join_key, CAST(join_delay AS VARCHAR) AS join_delay,
           'join' AS _pipeline_type
    FROM verdicts WHERE keep"""


def _join_records(flow):
    names = ["joined_id", "join_key", "join_delay", "_pipeline_type"]
    return flows.sink_rows(flow).select(
        "key", *[F.get_json_object("value", f"$.{n}").alias(n) for n in names]
    )


@query("flow_join", _JOIN_SQL)
def flow_join(spark, sf):
    return _join_records(_join_flow(spark, sf))


@query("flow_join_stream", _JOIN_SQL)
def flow_join_stream(spark, sf):
    """The same specification over two streams, match and dedup in one query."""
    topics = {
        name: as_topic(event_stream(spark, sf).filter(F.col("event_type") == name), name)
        for name in ("purchase", "click")
    }
    flow = flows.compile_flow(spec.parse(JOIN_FLOW), topics)
    return drained(_join_records(flow), "flow-join")


@query(
    "flow_metrics",
    f"""WITH RECURSIVE {_FLOW_WALK}
        SELECT count(*) AS events_processed, count(*) FILTER (NOT keep) AS events_deduped,
               0 AS events_joined, count(*) FILTER (keep) AS events_sunk,
               (SELECT count(*) FROM messages WHERE reason IS NOT NULL) AS error_count
        FROM verdicts""",
)
def flow_metrics(spark, sf):
    return metrics.flow_metrics(_topic_flow(spark, sf))


@query(
    "flow_metrics_join",
    f"""WITH RECURSIVE {_JOIN_WALK}
        SELECT (SELECT count(*) FROM sides) AS events_processed,
               count(*) FILTER (NOT keep) AS events_deduped, (SELECT count(*) FROM found) AS events_joined,
               count(*) FILTER (keep) AS events_sunk,
               (SELECT count(*) FROM messages WHERE reason IS NOT NULL
                  AND event_type IN ('purchase', 'click')) AS error_count
        FROM verdicts""",
)
def flow_metrics_join(spark, sf):
    return metrics.flow_metrics(_join_flow(spark, sf))


@query("flow_metrics_observed", ORACLES["flow_metrics"])
def flow_metrics_observed(spark, sf):
    """The counters of a flow as the one run that writes its output sees them."""
    watched = flows.compile_flow(
        spec.parse(TOPIC_FLOW), {"events": event_topic(spark, sf)}, counters.Observer()
    )
    return metrics.run_observed(watched, lambda out: out.write.parquet(shared_dir(spark, "observed")))


@query("flow_metrics_join_observed", ORACLES["flow_metrics_join"])
def flow_metrics_join_observed(spark, sf):
    rows = events(spark, sf)
    topics = {
        name: as_topic(rows.filter(F.col("event_type") == name), name)
        for name in ("purchase", "click")
    }
    watched = flows.compile_flow(spec.parse(JOIN_FLOW), topics, counters.Observer())
    return metrics.run_observed(watched, lambda out: out.write.parquet(shared_dir(spark, "observed")))


@query("flow_metrics_stream", ORACLES["flow_metrics"])
def flow_metrics_stream(spark, sf):
    """The counters of a running flow, gathered from its micro-batches."""
    root = shared_dir(spark, "flow-metrics")
    manager = control.FlowManager(spark, root)
    topics = {"events": as_topic(event_stream(spark, sf))}
    manager.create(spec.parse(TOPIC_FLOW), topics, folder_writer(f"{root}/out"), interval=None)
    manager.wait(TOPIC_FLOW["name"])
    return manager.metrics(TOPIC_FLOW["name"])


@query(
    "throughput",
    """SELECT event_type, count(*) AS events, epoch_us(max(ts)) - epoch_us(min(ts)) AS span_micros,
              count(*) * 1e6 / (epoch_us(max(ts)) - epoch_us(min(ts))) AS throughput_per_sec
       FROM events GROUP BY event_type""",
)
def throughput(spark, sf):
    return metrics.stage_metrics(events(spark, sf), "ts", "event_type")


_HOURLY = """SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS events,
       CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value, max(value) AS max_value
  FROM events GROUP BY 1, 2"""


@query("windowed_analytics", _HOURLY)
def windowed_analytics(spark, sf):
    return metrics.windowed_analytics(events(spark, sf), "ts", "event_type", "value", "1 hour")


@query(
    "windowed_analytics_stream",
    f"""WITH h AS ({_HOURLY}) SELECT * FROM h
        WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTES""",
)
def windowed_analytics_stream(spark, sf):
    """Windows come out once the watermark has closed them."""
    rows = event_stream(spark, sf).withWatermark("ts", "10 minutes")
    out = metrics.windowed_analytics(rows, "ts", "event_type", "value", "1 hour")
    return ntz(drained(out, "windows"), "window_start")


@query(
    "session_analytics",
    """WITH g AS (SELECT user_id, ts,
                    CASE WHEN ts - lag(ts) OVER w < INTERVAL 1 HOUR THEN 0 ELSE 1 END AS fresh
                  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
            n AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS session FROM g)
       SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 1 HOUR AS session_end,
              count(*) AS events
       FROM n GROUP BY user_id, session""",
)
def session_analytics(spark, sf):
    return metrics.session_analytics(events(spark, sf), "ts", "user_id", "1 hour")


@query(
    "rollup_days",
    """SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, event_type AS "group", count(*) AS events,
              CAST(sum(CAST(value AS DECIMAL(18,4))) AS DOUBLE) AS total_value FROM events GROUP BY ALL""",
)
def rollup_days(spark, sf):
    """Days put together from stored hours; the events are read once."""
    path = shared_dir(spark, "hours")
    rollups.rolled_up(events(spark, sf), "ts", "event_type", "user_id", "value", "1 hour").write.parquet(path)
    days = rollups.merged(spark.read.parquet(path), "1 day")
    return rollups.readings(days, [0.5, 0.99]).select("window_start", "group", "events", "total_value")


@query("rollup_distinct_users")
def rollup_distinct_users(spark, sf):
    """Distinct users and quantiles of days made of hours; estimates, so tests
    hold them against exact counts instead of SQL."""
    hours = rollups.rolled_up(events(spark, sf), "ts", "event_type", "user_id", "value", "1 hour")
    return rollups.readings(rollups.merged(hours, "1 day"), [0.1, 0.5, 0.9, 0.99])
