"""Sources, filters and transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.functions.keys import canonical_key, variant_key
from millrace.operators import filters, transforms
from millrace.plans.flows import columns_of
from millrace.session import shared_dir
from millrace.sources import ingest, topic_log
from millrace.streaming import sinks
from workload.common import (
    MESSAGES, as_topic, drained, event_stream, event_topic, events, message,
    ntz, query, table,
)


@query(
    "topic_source",
    """SELECT 'events' AS topic, CAST(user_id AS VARCHAR) AS key, CAST(user_id % 3 AS INT) AS "partition",
              event_id AS "offset", ts AS timestamp FROM events""",
)
def topic_source(spark, sf):
    """The topic as a stream, run to its end."""
    topic = as_topic(event_stream(spark, sf)).drop("value")
    return ntz(drained(topic, "topic-source"), "timestamp")


@query(
    "join_source",
    """SELECT event_type AS topic, event_id AS "offset", ts AS timestamp
       FROM events WHERE event_type IN ('purchase', 'click')""",
)
def join_source(spark, sf):
    """Two independent topics, each its own stream."""
    out = []
    for name in ("purchase", "click"):
        rows = event_stream(spark, sf).filter(F.col("event_type") == name)
        topic = as_topic(rows, name).select("topic", "offset", "timestamp")
        out.append(drained(topic, f"join-source-{name}"))
    return ntz(out[0].unionByName(out[1]), "timestamp")


def _purchases_first(spark, sf):
    """The events as records of three partitions, in two appends."""
    root = shared_dir(spark, "topic-log")
    rows = as_topic(events(spark, sf), "events", "event_id", "event_type").drop("topic", "offset")
    order, at = ["timestamp", "event_id"], F.col("partition")
    parts = rows.filter("event_type = 'purchase'"), rows.filter("event_type <> 'purchase'")
    return root, [
        lambda part=part: topic_log.append(part, root, "events", 3, at, order) for part in parts
    ]


_LOG_SQL = """SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id % 3 AS INT) AS "partition",
                     row_number() OVER (PARTITION BY user_id % 3 ORDER BY (event_type <> 'purchase'), ts,
                                        event_id) - 1 AS "offset", ts AS timestamp
              FROM events"""


@query("topic_log_stream", _LOG_SQL)
def topic_log_stream(spark, sf):
    """A topic with offsets read as a stream in bounded micro-batches, stopped
    between two appends and started again from its checkpoint."""
    root, appends = _purchases_first(spark, sf)
    schema = None
    for write in appends:
        write()
        stream = topic_log.log_stream(spark, root, "events", "earliest", max_offsets=2_000_000)
        rows = stream.select("key", "partition", "offset", "timestamp")
        schema = rows.schema
        sink = sinks.folder_writer(f"{root}/out")
        run = sinks.start_sink(rows, sink, f"{root}/checkpoint", interval="0 seconds")
        run.processAllAvailable()
        run.stop()
    return ntz(sinks.read_folder(spark, f"{root}/out", schema), "timestamp")


@query(
    "topic_log_replay",
    f"""WITH log AS ({_LOG_SQL}),
             cut AS (SELECT date_trunc('day', max(ts)) - INTERVAL 10 DAY AS t FROM events),
             begin AS (SELECT "partition" AS p, min("offset") AS o FROM log, cut WHERE timestamp >= t GROUP BY 1)
        SELECT key, "partition", "offset", timestamp FROM log JOIN begin ON p = "partition" AND "offset" >= o""",
)
def topic_log_replay(spark, sf):
    """All records from the first one of each partition that is at a time or after it."""
    root, appends = _purchases_first(spark, sf)
    for write in appends:
        write()
    late = F.date_trunc("day", F.max("ts")) - F.expr("INTERVAL 10 DAY")
    cut = events(spark, sf).agg(F.date_format(late, "yyyy-MM-dd'T'HH:mm:ss").alias("cut")).first()["cut"]
    rows = topic_log.read_log(spark, root, "events", startingTimestamp=cut)
    return ntz(rows.select("key", "partition", "offset", "timestamp"), "timestamp")


@query(
    "topic_log_sink",
    """SELECT CAST(user_id % 3 AS INT) AS "partition", count(*) AS records, 0 AS first_offset,
              count(*) AS next_offset, count(*) AS offsets, count(DISTINCT user_id) AS keys,
              min(ts) AS earliest, max(ts) AS latest
       FROM events GROUP BY 1""",
)
def topic_log_sink(spark, sf):
    """A stream written into a topic, twice from the same checkpoint, and read back."""
    root = shared_dir(spark, "topic-log-sink")
    source = as_topic(event_stream(spark, sf)).drop("topic", "offset")
    for _ in range(2):
        topic_log.start_log_sink(
            source, root, "clean-events", f"{root}/checkpoint", "sink", 3, F.col("partition"), None
        ).awaitTermination()
    rows = topic_log.read_log(spark, root, "clean-events").groupBy("partition").agg(
        F.count("*").alias("records"),
        F.min("offset").alias("first_offset"),
        (F.max("offset") + 1).alias("next_offset"),
        F.countDistinct("offset").alias("offsets"),
        F.countDistinct("key").alias("keys"),
        F.min("timestamp").alias("earliest"),
        F.max("timestamp").alias("latest"),
    )
    return ntz(rows, "earliest", "latest")


@query(
    "json_decode",
    f"""WITH {MESSAGES}
        SELECT event_id AS "offset", decode_error AS error_reason,
               CASE WHEN decode_error IS NULL THEN id END AS id,
               CASE WHEN decode_error IS NULL THEN event_type END AS event_type,
               CASE WHEN decode_error IS NULL THEN value END AS value
        FROM messages""",
)
def json_decode(spark, sf):
    rows = ingest.json_decode(event_topic(spark, sf))
    data = F.col("data")
    return rows.select(
        "offset", "error_reason",
        F.try_variant_get(data["id"], "$", "string").alias("id"),
        F.try_variant_get(data["event_type"], "$", "string").alias("event_type"),
        F.try_variant_get(data["value"], "$", "double").alias("value"),
    )


@query(
    "json_decode_typed",
    f"""WITH {MESSAGES}
        SELECT event_id AS "offset", decode_error AS error_reason,
               CASE WHEN decode_error IS NULL THEN event_type END AS event_type,
               CASE WHEN decode_error IS NULL THEN value END AS value
        FROM messages""",
)
def json_decode_typed(spark, sf):
    schema = spark.range(0).selectExpr(
        "cast(null as string) event_type", "cast(null as double) value"
    ).schema
    rows = ingest.json_decode(event_topic(spark, sf), schema)
    return rows.select("offset", "error_reason", "data.event_type", "data.value")


@query(
    "ingest_metadata",
    f"""WITH {MESSAGES}
        SELECT id, 'events' AS _kafka_topic, CAST(user_id % 3 AS INT) AS _kafka_partition,
               event_id AS _kafka_offset, ts AS _kafka_timestamp, true AS stamped
        FROM messages WHERE decode_error IS NULL""",
)
def ingest_metadata(spark, sf):
    good, _ = ingest.split_errors(ingest.json_decode(event_topic(spark, sf)))
    out = columns_of(
        ingest.ingest_metadata(good),
        {
            "id": "string", "_kafka_topic": "string", "_kafka_partition": "int",
            "_kafka_offset": "bigint", "_kafka_timestamp": "timestamp", "_processed_at": "timestamp",
        },
    )
    stamped = out.withColumn("stamped", F.col("_processed_at").isNotNull()).drop("_processed_at")
    return ntz(stamped, "_kafka_timestamp")


@query("event_time_select", "SELECT event_id, ts AS event_time FROM events")
def event_time_select(spark, sf):
    topic = event_topic(spark, sf).withColumnRenamed("offset", "event_id")
    return ntz(ingest.event_time(topic).select("event_id", "event_time"), "event_time")


@query(
    "dead_letter",
    f"""WITH {MESSAGES}
        SELECT event_id AS "offset", 'events' AS topic, reason AS error_reason
        FROM messages WHERE reason IS NOT NULL""",
)
def dead_letter(spark, sf):
    rows = ingest.require_key(ingest.json_decode(event_topic(spark, sf)), "user_id")
    return ingest.split_errors(rows)[1].select("offset", "topic", "error_reason")


# -------------------------------------------------------------------- filters

_EVENT = ["event_id", "event_type", "user_id", "value"]


def _filtered(spark, sf, *rules):
    return filters.filter_rows(events(spark, sf).select(*_EVENT), rules)


@query("filter_eq", f"SELECT {', '.join(_EVENT)} FROM events WHERE event_type = 'purchase'")
def filter_eq(spark, sf):
    return _filtered(spark, sf, {"field": "event_type", "operator": "eq", "value": "purchase"})


@query("filter_ne", f"SELECT {', '.join(_EVENT)} FROM events WHERE event_type <> 'error'")
def filter_ne(spark, sf):
    return _filtered(spark, sf, {"field": "event_type", "operator": "ne", "value": "error"})


@query("filter_gt", f"SELECT {', '.join(_EVENT)} FROM events WHERE value > 20")
def filter_gt(spark, sf):
    return _filtered(spark, sf, {"field": "value", "operator": "gt", "value": 20})


@query("filter_lt", f"SELECT {', '.join(_EVENT)} FROM events WHERE value < 2.5")
def filter_lt(spark, sf):
    return _filtered(spark, sf, {"field": "value", "operator": "lt", "value": 2.5})


@query("filter_contains", "SELECT doc_id, n_chars FROM documents WHERE contains(text, 'ou')")
def filter_contains(spark, sf):
    rows = table(spark, sf, "documents")
    rule = {"field": "text", "operator": "contains", "value": "ou"}
    return filters.filter_rows(rows, [rule]).select("doc_id", "n_chars")


@query(
    "filter_contains_array",
    "SELECT vec_id, label FROM embeddings WHERE list_contains([label, label + 1], 3)",
)
def filter_contains_array(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn(
        "near", F.array("label", (F.col("label") + 1).cast("int"))
    )
    rule = {"field": "near", "operator": "contains", "value": 3}
    return filters.filter_rows(rows, [rule]).select("vec_id", "label")


@query(
    "filter_chain",
    f"""SELECT {', '.join(_EVENT)} FROM events
        WHERE event_type <> 'error' AND value > 5 AND value < 30 AND user_id < 100""",
)
def filter_chain(spark, sf):
    return _filtered(
        spark, sf,
        {"field": "event_type", "operator": "ne", "value": "error"},
        {"field": "value", "operator": "gt", "value": 5},
        {"field": "value", "operator": "lt", "value": 30},
        {"field": "user_id", "operator": "lt", "value": 100},
    )


@query(
    "filter_chain_schemaless",
    f"""WITH {MESSAGES}
        SELECT id, value FROM messages
        WHERE decode_error IS NULL AND contains(event_type, 'ur') AND value > 20
          AND event_id % 103 <> 0 AND event_id % 101 <> 0 AND user_id <> 7""",
)
def filter_chain_schemaless(spark, sf):
    good, _ = ingest.split_errors(ingest.json_decode(event_topic(spark, sf)))
    rules = [
        {"field": "event_type", "operator": "contains", "value": "ur"},
        {"field": "value", "operator": "gt", "value": 20},
        {"field": "user_id", "operator": "ne", "value": 7},
    ]
    kept = filters.filter_rows(good, rules)
    return columns_of(kept, {"id": "string", "value": "double"})


# ----------------------------------------------------------------- transforms

@query("rename", "SELECT event_id, value AS amount FROM events")
def rename(spark, sf):
    rows = events(spark, sf).select("event_id", "value")
    return transforms.rename(rows, "value", "amount")


@query(
    "rename_schemaless",
    f"""WITH {MESSAGES}
        SELECT event_id AS "offset", value AS amount,
               CASE WHEN event_id % 103 = 0 THEN NULL ELSE key_value END AS account,
               false AS has_user_id
        FROM messages WHERE decode_error IS NULL""",
)
def rename_schemaless(spark, sf):
    good, _ = ingest.split_errors(ingest.json_decode(event_topic(spark, sf)))
    rules = [
        {"field": "value", "type": "rename", "value": "amount"},
        {"field": "user_id", "type": "rename", "value": "account"},
    ]
    out = transforms.apply_rules(good, rules)
    data = F.col("data")
    return out.select(
        "offset",
        F.try_variant_get(data["amount"], "$", "double").alias("amount"),
        variant_key(data["account"]).alias("account"),
        F.map_contains_key(data, "user_id").alias("has_user_id"),
    )


@query(
    "default_absent",
    f"""WITH {MESSAGES}
        SELECT event_id AS "offset",
               CASE WHEN event_id % 103 = 0 THEN 'anonymous' ELSE key_value END AS user_text
        FROM messages WHERE decode_error IS NULL""",
)
def default_absent(spark, sf):
    """A JSON null is present and keeps its value."""
    good, _ = ingest.split_errors(ingest.json_decode(event_topic(spark, sf)))
    rule = {"field": "user_id", "type": "default", "value": "anonymous"}
    out = transforms.apply_rules(good, [rule])
    return out.select("offset", variant_key(F.col("data")["user_id"]).alias("user_text"))


@query(
    "default_typed",
    "SELECT event_id, CASE WHEN value > 50 THEN 'none' ELSE event_type END AS event_type FROM events",
)
def default_typed(spark, sf):
    rows = events(spark, sf).select(
        "event_id", F.when(F.col("value") <= 50, F.col("event_type")).alias("event_type")
    )
    return transforms.default(rows, "event_type", "none")


@query(
    "stamp_flow",
    "SELECT event_id, 'sessions' AS _pipeline_name, '1.0' AS _pipeline_version FROM events",
)
def stamp_flow(spark, sf):
    return transforms.stamp_flow(events(spark, sf).select("event_id"), "sessions")


@query(
    "stamp_join",
    """SELECT event_id, 'enrich' AS _pipeline_name, 'join' AS _pipeline_type, true AS stamped
       FROM events""",
)
def stamp_join(spark, sf):
    out = transforms.stamp_join(events(spark, sf).select("event_id"), "enrich")
    return out.withColumn("stamped", F.col("_processed_at").isNotNull()).drop("_processed_at")


@query("cast_string", "SELECT event_id, CAST(user_id AS VARCHAR) AS user_id FROM events")
def cast_string(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id")
    return transforms.cast(rows, "user_id", "string")


_NUMBER = "regexp_extract(props, '([0-9]+)', 1)"
_TEXT = f"""CASE event_id % 4 WHEN 0 THEN {_NUMBER} WHEN 1 THEN ' ' || {_NUMBER}
            WHEN 2 THEN '-' || {_NUMBER} || '.5' ELSE 'x' || {_NUMBER} END"""


def _texts(spark, sf):
    return events(spark, sf).select("event_id", F.expr(_TEXT).alias("n"))


@query("cast_unknown", "SELECT event_id, value AS amount FROM events")
def cast_unknown(spark, sf):
    """A cast to an unknown target is refused before a row is read; the other
    rules run."""
    rules = [
        {"type": "rename", "field": "value", "value": "amount"},
        {"type": "cast", "field": "amount", "value": "decimal128"},
    ]
    accepted, refused = [], []
    for rule in rules:
        try:
            transforms.check_rule(rule)
            accepted.append(rule)
        except ValueError:
            refused.append(rule["type"])
    if refused != ["cast"]:
        raise AssertionError(f"refused {refused}")
    rows = events(spark, sf).select("event_id", "value")
    return transforms.rename(rows, accepted[0]["field"], accepted[0]["value"])


@query(
    "cast_int",
    f"""WITH t AS (SELECT event_id, {_TEXT} AS n FROM events)
        SELECT event_id,
               CASE WHEN regexp_full_match(n, '[+-]?[0-9]+') THEN CAST(n AS BIGINT) END AS n,
               CASE WHEN NOT regexp_full_match(n, '[+-]?[0-9]+') THEN n END AS n__uncast
        FROM t""",
)
def cast_int(spark, sf):
    return transforms.cast(_texts(spark, sf), "n", "int")


@query(
    "cast_float",
    f"""WITH t AS (SELECT event_id, {_TEXT} AS n FROM events)
        SELECT event_id,
               CASE WHEN regexp_full_match(n, '[+-]?[0-9]+[.]?[0-9]*') THEN CAST(n AS DOUBLE) END AS n,
               CASE WHEN NOT regexp_full_match(n, '[+-]?[0-9]+[.]?[0-9]*') THEN n END AS n__uncast
        FROM t""",
)
def cast_float(spark, sf):
    return transforms.cast(_texts(spark, sf), "n", "float")


@query(
    "cast_schemaless",
    f"""WITH {MESSAGES}, t AS (SELECT *, {_TEXT} AS n FROM messages WHERE decode_error IS NULL)
        SELECT event_id AS "offset", CAST(value AS VARCHAR) AS value,
               regexp_full_match(n, '[+-]?[0-9]+') AS n_is_number,
               CASE WHEN regexp_full_match(n, '[+-]?[0-9]+') THEN CAST(CAST(n AS BIGINT) AS VARCHAR)
                    ELSE n END AS n
        FROM t""",
)
def cast_schemaless(spark, sf):
    """In a map, text that does not parse stays text."""
    raw = as_topic(events(spark, sf).withColumn("n", F.expr(_TEXT)), "events", "n")
    good, _ = ingest.split_errors(ingest.json_decode(raw))
    rules = [
        {"field": "n", "type": "compute", "value": "n"},
        {"field": "n", "type": "cast", "value": "int"},
        {"field": "value", "type": "cast", "value": "string"},
    ]
    out = transforms.apply_rules(good, rules)
    data = F.col("data")
    return out.select(
        "offset",
        F.when(F.schema_of_variant(data["value"]) == "STRING",
               F.try_variant_get(data["value"], "$", "string").cast("double").cast("string")
               ).alias("value"),
        (F.schema_of_variant(data["n"]) == "BIGINT").alias("n_is_number"),
        variant_key(data["n"]).alias("n"),
    )


@query("compute", "SELECT event_id, value, value * 2 + user_id AS score FROM events")
def compute(spark, sf):
    rows = events(spark, sf).select("event_id", "value", "user_id")
    return transforms.compute(rows, "score", "value * 2 + user_id").drop("user_id")


@query(
    "rule_chain",
    """SELECT event_id, value AS amount, CAST(user_id AS VARCHAR) AS account, 'USD' AS currency,
              value * 1.5 AS gross
       FROM events""",
)
def rule_chain(spark, sf):
    rows = events(spark, sf).select("event_id", "user_id", "value")
    return transforms.apply_rules(
        rows,
        [
            {"field": "value", "type": "rename", "value": "amount"},
            {"field": "user_id", "type": "cast", "value": "string"},
            {"field": "user_id", "type": "rename", "value": "account"},
            {"field": "currency", "type": "default", "value": "USD"},
            {"field": "gross", "type": "compute", "value": "amount * 1.5"},
            {"field": "amount", "type": "rename", "value": "amount"},
        ],
    )


@query(
    "canonical_key",
    f"""WITH {MESSAGES}
        SELECT event_id, CAST(user_id AS VARCHAR) AS by_number, event_type AS by_text,
               CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
                    ELSE CAST(value AS VARCHAR) END AS by_double,
               CASE WHEN event_id % 103 = 0 OR decode_error IS NOT NULL THEN NULL
                    ELSE key_value END AS by_variant
        FROM messages""",
)
def canonical_key_query(spark, sf):
    rows = events(spark, sf)
    entries = F.try_variant_get(F.try_parse_json(message(rows)), "$", "map<string,variant>")
    return rows.select(
        "event_id",
        canonical_key(rows, "user_id").alias("by_number"),
        canonical_key(rows, "event_type").alias("by_text"),
        canonical_key(rows, "value").alias("by_double"),
        variant_key(entries["user_id"]).alias("by_variant"),
    )
