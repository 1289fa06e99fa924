"""Compile a flow specification over topic-shaped frames.

Static frames give one batch plan, streaming frames a streaming plan. Filters
run before deduplication, transforms after it.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.fields import once
from millrace.functions.keys import variant_key
from millrace.operators import dedup, match
from millrace.operators.filters import filter_rows
from millrace.operators.transforms import Draft, apply_rules, flow_stamps, join_stamps
from millrace.plans.counters import Observer
from millrace.plans.spec import FlowSpec
from millrace.sources import ingest
from millrace.streaming import stateful

_RECORD = ["topic", "partition", "offset", "timestamp", "value"]


@dataclass(frozen=True)
class Flow:
    """A compiled flow.

    ``output`` is what goes to the sink, ``errors`` the dead letters,
    ``judged`` (batch only) every deduplicated event with its verdict and
    ``ledger`` (batch joins only) every joined-stream event.
    """

    spec: FlowSpec
    output: DataFrame
    errors: DataFrame
    judged: DataFrame | None = None
    ledger: DataFrame | None = None
    observer: Observer | None = None


def compile_flow(
    spec: FlowSpec, topics: Mapping[str, DataFrame], observer: Observer | None = None
) -> Flow:
    """``topics`` maps topic names to topic-shaped frames. An ``observer`` counts
    what passes while the flow runs (see ``counters``)."""
    if spec.source == "kafka":
        return _topic_flow(spec, topics[spec.topic], observer)
    return _join_flow(spec, topics[spec.join.left_topic], topics[spec.join.right_topic], observer)


def _watch(observer: Observer | None, df: DataFrame, part: str, **tests) -> DataFrame:
    return observer.watch(df, part, **tests) if observer is not None else df


def _decoded(
    spec: FlowSpec, raw: DataFrame, key: str | None, observer: Observer | None, part: str
) -> tuple[DataFrame, DataFrame]:
    rows = ingest.json_decode(raw.select(*_RECORD))
    if key:
        rows = ingest.require_key(rows, key)
    rows = _watch(observer, rows, part, error_count=F.col("error_reason").isNotNull())
    return ingest.split_errors(rows)


def _topic_flow(spec: FlowSpec, raw: DataFrame, observer: Observer | None) -> Flow:
    key = spec.dedup.key if spec.dedup else None
    good, bad = _decoded(spec, raw, key, observer, "decoded")
    good = _watch(observer, filter_rows(good, spec.filters), "accepted", events_in=F.lit(True))
    judged = None
    if spec.dedup:
        # Only the raw record goes through the scan; it is decoded again after,
        # which costs less than moving decoded payloads.
        slim = good.select(*_RECORD, "key_value")
        order = ["topic", "partition", "offset"]
        window = spec.dedup.time_window
        if raw.isStreaming:
            position = F.concat_ws(
                "/", "topic", F.lpad(F.col("partition").cast("string"), 10, "0"),
                F.lpad(F.col("offset").cast("string"), 19, "0"),
            )
            if spec.dedup.mode == "minute_bucket":
                minute = F.floor(F.unix_micros("timestamp") / dedup.MINUTE).cast("string")
                slim = slim.withColumn("key_value", F.concat_ws(" ", minute, "key_value"))
            kept = stateful.dedup_stream(
                slim.withColumn("position", position), "key_value", "timestamp", window,
                event_id="position",
            )
        elif spec.dedup.mode == "minute_bucket":
            kept = dedup.dedup_minute_bucket(slim, "key_value", "timestamp", window, order)
        else:
            judged = dedup.dedup_annotate(
                slim.withColumnRenamed("key_value", "dedup_key"), "dedup_key", "timestamp",
                window, order,
            )
            kept = judged.filter(~F.col("is_duplicate"))
        kept = _watch(observer, kept, "kept", events_sunk=F.lit(True))
        good = ingest.json_decode(kept.select(*_RECORD)).drop("error_reason")
    else:
        good = _watch(observer, good, "kept", events_sunk=F.lit(True))
    draft = Draft()
    draft.put(ingest.metadata_columns())
    draft.put(flow_stamps(spec.name))
    out = apply_rules(good, spec.transforms, draft=draft)
    return Flow(spec, out.select("data"), bad, judged=judged, observer=observer)


def _side(good: DataFrame) -> DataFrame:
    rows = ingest.ensure_id(good)
    return rows.select(
        "event_id", "key_value", F.col("timestamp").alias("event_time"),
        F.to_json("data").alias("payload"),
    )


def _joined_data(joined: DataFrame, name: str) -> DataFrame:
    """The joined event as a ``data`` map, payloads as nested objects."""

    def payload(side: str):
        return F.try_parse_json(F.col(f"{side}_data.payload"))

    entries = {
        "joined_id": F.col("joined_id").cast("variant"),
        "join_key": F.col("join_key").cast("variant"),
        "left_data": payload("left"),
        "right_data": payload("right"),
        "left_time": F.col("left_time").cast("variant"),
        "right_time": F.col("right_time").cast("variant"),
        "join_delay": F.col("join_delay").cast("variant"),
        "joined_at": F.current_timestamp().cast("variant"),
        "pipeline": F.lit(name).cast("variant"),
    }
    pairs = [c for n, v in entries.items() for c in (F.lit(n), v)]
    return once(joined, data=F.create_map(*pairs))


def joined_key(data, field: str):
    """Key text of a joined event's field: its own, the left's, the right's."""
    own = data[field]
    left = F.try_variant_get(data["left_data"], f"$['{field}']", "variant")
    right = F.try_variant_get(data["right_data"], f"$['{field}']", "variant")
    return variant_key(F.coalesce(own, left, right))


def _join_flow(
    spec: FlowSpec, left_raw: DataFrame, right_raw: DataFrame, observer: Observer | None
) -> Flow:
    join = spec.join
    left_good, left_bad = _decoded(spec, left_raw, join.join_key, observer, "left-decoded")
    right_good, right_bad = _decoded(spec, right_raw, join.join_key, observer, "right-decoded")
    left, right = (
        _side(_watch(observer, filter_rows(g, spec.filters), f"{side}-accepted", events_in=F.lit(True)))
        for side, g in (("left", left_good), ("right", right_good))
    )
    streaming = left_raw.isStreaming or right_raw.isStreaming
    ledger = None
    if join.join_type == "inner":
        pair = match.interval_join_stream if streaming else match.interval_join_all
        wide = pair(left, right, "key_value", "event_time", join.time_window)
        joined = wide.select(
            F.concat_ws("_", F.lit("joined"), "left_event_id", "right_event_id").alias("joined_id"),
            F.col("left_key_value").alias("join_key"),
            F.struct(F.col("left_payload").alias("payload")).alias("left_data"),
            F.struct(F.col("right_payload").alias("payload")).alias("right_data"),
            F.col("left_event_time").alias("left_time"),
            F.col("right_event_time").alias("right_time"),
            match._delay_ns(F.col("left_event_time"), F.col("right_event_time")).alias("join_delay"),
        )
    elif streaming:
        joined = stateful.match_stream(
            left, right, "key_value", "event_time", "event_id", join.time_window
        )
    else:
        ledger = match.match_ledger(
            left, right, "key_value", "event_time", "event_id", join.time_window
        )
        joined = match.joined_projection(
            match.pairs(ledger), left, right, "event_time", "event_id", "key_value"
        )
    joined = _watch(observer, joined, "joined", events_joined=F.lit(True))
    out = _joined_data(joined, spec.name)
    errors = left_bad.unionByName(right_bad)
    judged = None
    if spec.dedup:
        keyed = once(out, dedup_key=joined_key(F.col("data"), spec.dedup.key))
        keyed = _watch(observer, keyed, "keyed", error_count=F.col("dedup_key").isNull())
        missing = keyed.filter(F.col("dedup_key").isNull())
        errors = errors.unionByName(
            missing.select(F.to_json("data").alias("value"), F.lit("missing_key").alias("error_reason")),
            allowMissingColumns=True,
        )
        # A pair counts from its later half: that is when it was made.
        made_at = F.col("made_at") if streaming else F.greatest("left_time", "right_time")
        slim = keyed.filter(F.col("dedup_key").isNotNull()).select(
            "joined_id", "dedup_key", made_at.alias("made_at"), F.to_json("data").alias("body")
        )
        window = spec.dedup.time_window
        if streaming:
            kept = stateful.dedup_joined_stream(slim, "dedup_key", "body", window)
        else:
            judged = dedup.dedup_annotate(slim, "dedup_key", "made_at", window, ["joined_id"])
            kept = judged.filter(~F.col("is_duplicate"))
        body = F.try_variant_get(F.try_parse_json("body"), "$", "map<string,variant>")
        out = kept.select(body.alias("data"))
    out = _watch(observer, out, "kept", events_sunk=F.lit(True))
    draft = Draft()
    draft.put(join_stamps(spec.name))
    out = apply_rules(out.select("data"), spec.transforms, draft=draft)
    return Flow(spec, out.select("data"), errors, judged=judged, ledger=ledger, observer=observer)


def sink_rows(flow: Flow) -> DataFrame:
    """What the sink receives: topic records for a topic sink, else the rows."""
    if flow.spec.sink == "kafka":
        key = "id" if flow.spec.source == "kafka" else "joined_id"
        return ingest.to_topic(flow.output, key, flow.spec.sink_topic or "")
    return flow.output


def columns_of(flow_output: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Entries of ``data`` as typed columns; objects and arrays as JSON text."""
    out = []
    for name, kind in columns.items():
        value = F.col("data")[name]
        if kind == "string":
            text = F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value))
            out.append(F.when(~F.is_variant_null(value), text).alias(name))
        else:
            out.append(F.try_variant_get(value, "$", kind).alias(name))
    return flow_output.select(*out)

