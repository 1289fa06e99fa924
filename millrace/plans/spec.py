"""Flow specifications: source, processing and sink, from JSON or Python."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass

from millrace.functions.durations import micros
from millrace.operators import filters, transforms

# Source, join and sink kinds.
SOURCES = ("kafka", "kafka-join")
JOINS = ("temporal", "inner")
SINKS = ("clickhouse", "kafka")


@dataclass(frozen=True)
class JoinSpec:
    left_topic: str
    right_topic: str
    join_key: str
    time_window: str | int
    join_type: str = "temporal"


@dataclass(frozen=True)
class DedupSpec:
    key: str
    time_window: str | int
    mode: str = "anchor"


@dataclass(frozen=True)
class FlowSpec:
    name: str
    source: str
    topic: str | None = None
    join: JoinSpec | None = None
    dedup: DedupSpec | None = None
    filters: tuple[Mapping, ...] = ()
    transforms: tuple[Mapping, ...] = ()
    sink: str = "clickhouse"
    table: str | None = None
    sink_topic: str | None = None
    description: str = ""

    def __post_init__(self):
        problems = list(_problems(self))
        if problems:
            raise ValueError(f"invalid flow {self.name!r}: " + "; ".join(problems))


def _window_problems(label: str, window) -> list[str]:
    try:
        size = micros(window)
    except ValueError as error:
        return [str(error)]
    # Longer windows are clamped, not refused (see durations.window_micros).
    return [f"{label} window must be positive"] if size <= 0 else []


def _problems(spec: FlowSpec):
    if not spec.name:
        yield "a name is required"
    if spec.source not in SOURCES:
        yield f"unsupported source type: {spec.source!r}"
    if spec.source == "kafka" and not spec.topic:
        yield "a kafka source needs a topic"
    if spec.source == "kafka-join":
        if spec.join is None:
            yield "a kafka-join source needs a join"
        else:
            if spec.join.join_type not in JOINS:
                yield f"unknown join type: {spec.join.join_type!r}"
            yield from _window_problems("join", spec.join.time_window)
    if spec.dedup is not None:
        if not spec.dedup.key:
            yield "deduplication needs a key"
        if spec.dedup.mode not in ("anchor", "minute_bucket"):
            yield f"unknown deduplication mode: {spec.dedup.mode!r}"
        yield from _window_problems("deduplication", spec.dedup.time_window)
    for rule, check in [
        *((r, filters.check_rule) for r in spec.filters),
        *((r, transforms.check_rule) for r in spec.transforms),
    ]:
        try:
            check(rule)
        except ValueError as error:
            yield str(error)
    if spec.sink not in SINKS:
        yield f"unsupported sink type: {spec.sink!r}"


def _on(block: Mapping | None) -> bool:
    return bool(block) and block.get("enabled", True)


def parse(text: str | Mapping) -> FlowSpec:
    """A flow from its JSON form. Durations are ``"24h"`` or nanoseconds."""
    raw = json.loads(text) if isinstance(text, str) else text
    source, sink = raw.get("source", {}), raw.get("sink", {})
    processing = raw.get("processing", {})
    dedup = processing.get("deduplication")
    filtering = processing.get("filtering")
    transformation = processing.get("transformation")
    join = source.get("join")
    return FlowSpec(
        name=raw.get("name", ""),
        description=raw.get("description", ""),
        source=source.get("type", ""),
        topic=source.get("topic"),
        join=JoinSpec(**join) if join else None,
        dedup=DedupSpec(
            dedup.get("key", ""), dedup.get("time_window", 0), dedup.get("mode", "anchor")
        )
        if _on(dedup)
        else None,
        filters=tuple(filtering["rules"]) if _on(filtering) else (),
        transforms=tuple(transformation["rules"]) if _on(transformation) else (),
        sink=sink.get("type", ""),
        table=sink.get("table"),
        sink_topic=sink.get("topic"),
    )
