"""Keyed, time-windowed deduplication.

A key's first event is kept and becomes the anchor. Later events within the
window (inclusive) of the anchor are duplicates and do not move it; the first
one past the window is kept and becomes the new anchor.

Plan: one shuffle on the key, a sort by time, and one Arrow pass that carries a
single anchor across batches, so memory does not grow with the key. A key with
too many rows for one task is cut into time slices which run in parallel; the
anchor entering each slice is worked out beforehand from slice summaries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.durations import window_micros
from millrace.functions.keys import canonical_key
from millrace.operators import hotkeys
from millrace.session import shared_dir

KEY, SLICE, AT = "__key", "__slice", "__at"
MINUTE = 60_000_000
# Most summary steps kept on the driver over all slices of all hot keys.
STEP_BUDGET = 2_000_000
# Chains meet within a few windows, so a slice of some windows has a short summary;
# one of less than a window has a step for each of its rows.
WINDOWS_PER_SLICE = 8


# ---------------------------------------------------------------- the scan

def _starts(keys: pa.Array, slices: np.ndarray) -> np.ndarray:
    """Indexes where a new (key, slice) group begins inside a sorted batch."""
    n = len(keys)
    if n == 1:
        return np.zeros(1, dtype=np.int64)
    moved = pc.not_equal(keys.slice(1), keys.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    moved = moved | (slices[1:] != slices[:-1])
    return np.concatenate(([0], np.flatnonzero(moved) + 1))


def _mark(at: np.ndarray, starts: np.ndarray, anchors: dict[int, int], window: int):
    """Kept flags and anchor time of every row of one sorted batch.

    ``anchors`` maps a group's start index to the anchor it begins with. Groups
    are laid end to end on one axis, more than a window apart, so that the next
    kept row of any row is one ``searchsorted`` away and a row past its group's
    end lands on the next group's first row.
    """
    n = len(at)
    low = int(at.min())
    stride = int(at.max()) - low + window + 1
    if len(starts) * stride >= 1 << 62:
        return None
    group = np.zeros(n, dtype=np.int64)
    group[starts[1:]] = 1
    line = np.cumsum(group) * stride + (at - low)
    following = np.searchsorted(line, line + window, side="right").tolist()
    entry = {}
    for start, anchor in anchors.items():
        reach = anchor + window
        if reach >= int(at[start]):
            offset = int(line[start]) - int(at[start])
            bound = min(reach, low + stride - 1)
            entry[start] = int(np.searchsorted(line, offset + bound, side="right"))
    kept = []
    i = 0
    while i < n:
        while i in entry and entry[i] != i:
            i = entry[i]
            if i >= n:
                break
        if i >= n:
            break
        kept.append(i)
        i = following[i]
    keep = np.zeros(n, dtype=bool)
    keep[kept] = True
    last = np.maximum.accumulate(np.where(keep, np.arange(n), -1))
    first_seen = at[np.maximum(last, 0)]
    for start, end in entry.items():
        first_seen[start:end] = anchors[start]
    return keep, first_seen


class AnchorScan:
    """Marks sorted Arrow batches, carrying the anchor from batch to batch."""

    def __init__(self, window: int, seeds: dict[tuple[str, int], int] | None = None):
        self.window = window
        self.seeds = seeds or {}
        self.key = None
        self.slice = None
        self.anchor = 0

    def mark(self, keys: pa.Array, slices: np.ndarray, at: np.ndarray):
        starts = _starts(keys, slices)
        anchors = {}
        if self.key == keys[0].as_py() and self.slice == int(slices[0]):
            anchors[0] = self.anchor
        if self.seeds:
            for s in starts.tolist():
                seed = self.seeds.get((keys[s].as_py(), int(slices[s])))
                if seed is not None and s not in anchors:
                    anchors[s] = seed
        out = _mark(at, starts, anchors, self.window)
        if out is None:
            half = len(at) // 2
            a = self.mark(keys.slice(0, half), slices[:half], at[:half])
            b = self.mark(keys.slice(half), slices[half:], at[half:])
            return np.concatenate((a[0], b[0])), np.concatenate((a[1], b[1]))
        self.key, self.slice = keys[len(at) - 1].as_py(), int(slices[-1])
        self.anchor = int(out[1][-1])
        return out


def _batch_columns(batch: pa.RecordBatch):
    return (
        batch.column(batch.schema.get_field_index(KEY)),
        batch.column(batch.schema.get_field_index(SLICE)).to_numpy(),
        batch.column(batch.schema.get_field_index(AT)).to_numpy(),
    )


def _scanner(window: int, keep_columns: list[str], annotate: bool, seeds):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = AnchorScan(window, seeds.value if seeds is not None else None)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, slices, at = _batch_columns(batch)
            keep, first_seen = state.mark(keys, slices, at)
            body = batch.select(keep_columns)
            if annotate:
                columns = [*body.columns, pa.array(~keep), pa.array(first_seen), keys]
                names = [*keep_columns, "is_duplicate", "first_seen", "key_value"]
                yield pa.RecordBatch.from_arrays(columns, names=names)
            else:
                yield body.filter(pa.array(keep))

    return scan


# ------------------------------------------------- slices of very large keys

def _load_groups(batches: Iterator[pa.RecordBatch]):
    """(key, slice, sorted distinct times) per group; a group is one time slice
    of a hot key, of about equal numbers of rows."""
    held: list[np.ndarray] = []
    name = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        keys, slices, at = _batch_columns(batch)
        starts = _starts(keys, slices).tolist()
        for s, e in zip(starts, starts[1:] + [len(at)]):
            group = (keys[s].as_py(), int(slices[s]))
            if group != name and held:
                yield (*name, np.unique(np.concatenate(held)))
                held = []
            name = group
            held.append(np.unique(at[s:e]))
    if held:
        yield (*name, np.unique(np.concatenate(held)))


def _exits(at: np.ndarray, window: int) -> np.ndarray:
    """For each row, the last kept row of the chain that starts there."""
    n = len(at)
    following = np.searchsorted(at, at + window, side="right")
    end = np.where(following == n, np.arange(n), following)
    while True:
        further = end[end]
        if np.array_equal(further, end):
            return end
        end = further


def _summarise(window: int, max_steps: int):
    """Per slice: its time range and, if short enough, the map from the first
    kept time (entries up to ``upto``) to the last kept time (``exit``)."""

    def run(batches):
        for key, slice_no, at in _load_groups(batches):
            entries = int(np.searchsorted(at, at[0] + window, side="right")) + 1
            exits = at[_exits(at, window)][: min(entries, len(at))]
            ends = np.append(np.flatnonzero(exits[1:] != exits[:-1]), len(exits) - 1)
            small = len(ends) <= max_steps
            yield pa.RecordBatch.from_pydict(
                {
                    "key": [key],
                    "slice": pa.array([slice_no], pa.int32()),
                    "first": [int(at[0])],
                    "last": [int(at[-1])],
                    "upto": pa.array([at[ends].tolist() if small else None], pa.list_(pa.int64())),
                    "exit": pa.array([exits[ends].tolist() if small else None], pa.list_(pa.int64())),
                }
            )

    return run


_SUMMARY = (
    "key string, slice int, first bigint, last bigint, upto array<bigint>, exit array<bigint>"
)


def _walk(window: int, seeds: dict[tuple[str, int], int]):
    """Last kept time of each given slice, entered with the given anchor."""

    def run(batches):
        scan = AnchorScan(window, seeds)
        result: dict[tuple[str, int], int] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, slices, at = _batch_columns(batch)
            starts = _starts(keys, slices).tolist()
            _, first_seen = scan.mark(keys, slices, at)
            for s, e in zip(starts, starts[1:] + [len(at)]):
                result[(keys[s].as_py(), int(slices[s]))] = int(first_seen[e - 1])
        yield pa.RecordBatch.from_pydict(
            {
                "key": [k for k, _ in result],
                "slice": pa.array([s for _, s in result], pa.int32()),
                "anchor": pa.array(list(result.values()), pa.int64()),
            }
        )

    return run


def _slice_anchors(rows: DataFrame, window: int, grid: hotkeys.HotKeys):
    """Anchor entering each slice of the hot keys: ``{(key, slice): anchor}``.

    ``rows`` holds only the hot keys' (key, slice, at). Slice summaries come to
    the driver (one short record per slice, so bounded by the grid, not by the
    rows). A slice whose summary is too long is asked again, in a small job on
    that slice alone, once its anchor is known; all keys advance together.
    """
    spark = rows.sparkSession
    slim = rows.select(KEY, SLICE, AT)
    by_slice = slim.repartition(KEY, SLICE).sortWithinPartitions(KEY, SLICE, AT)
    cap = max(4, STEP_BUDGET // grid.slices())
    found: dict[str, list] = {}
    for r in by_slice.mapInArrow(_summarise(window, cap), _SUMMARY).collect():
        found.setdefault(r["key"], []).append(r)
    for parts in found.values():
        parts.sort(key=lambda r: r["slice"])

    seeds: dict[tuple[str, int], int] = {}
    anchor: dict[str, int | None] = dict.fromkeys(found)
    place = dict.fromkeys(found, 0)
    stored = None
    while True:
        pending: dict[tuple[str, int], int] = {}
        for key, parts in found.items():
            while place[key] < len(parts):
                part = parts[place[key]]
                known = anchor[key]
                if known is not None and known + window >= part["first"]:
                    seeds[(key, part["slice"])] = known
                    if known + window >= part["last"]:
                        place[key] += 1
                        continue
                if part["upto"] is None:
                    pending[(key, part["slice"])] = (
                        known if known is not None else part["first"] - window - 1
                    )
                    break
                entered = part["first"] if known is None else max(known + window + 1, part["first"])
                step = int(np.searchsorted(np.asarray(part["upto"]), entered, side="left"))
                anchor[key] = part["exit"][step]
                place[key] += 1
        if not pending:
            return seeds
        if stored is None:
            path = shared_dir(spark, "dedup-slices")
            by_slice.write.partitionBy(SLICE).parquet(path)
            stored = spark.read.schema(by_slice.schema).parquet(path)
        wanted = None
        for (key, slice_no), known in pending.items():
            one = (F.col(SLICE) == slice_no) & (F.col(KEY) == key) & (F.col(AT) > known + window)
            wanted = one if wanted is None else wanted | one
        answer = (
            stored.filter(F.col(SLICE).isin([s for _, s in pending]) & wanted)
            .select(KEY, SLICE, AT)
            .repartition(KEY, SLICE)
            .sortWithinPartitions(KEY, SLICE, AT)
            .mapInArrow(_walk(window, pending), "key string, slice int, anchor bigint")
            .collect()
        )
        for r in answer:
            anchor[r["key"]] = r["anchor"]
            place[r["key"]] += 1


# ------------------------------------------------------------------ operators

def _micros(df: DataFrame, ts: str) -> Column:
    kind = df.schema[ts].dataType
    column = F.col(ts)
    if isinstance(kind, T.TimestampNTZType):
        column = column.cast("timestamp")
    return F.unix_micros(column)


def _run(
    df: DataFrame,
    key: str | Column,
    ts: str,
    window,
    tie: Sequence[str],
    annotate: bool,
    hot_rows: int | None,
) -> DataFrame:
    size = window_micros(window)
    key_text = canonical_key(df, key) if isinstance(key, str) else key
    keyed = df.withColumn(KEY, key_text).withColumn(AT, _micros(df, ts))
    grid = hotkeys.find_hot_keys(keyed, KEY, AT, hot_rows).coarser(WINDOWS_PER_SLICE * size)
    sliced = grid.slice_column(keyed, KEY, F.col(AT), SLICE)
    seeds = None
    if grid:
        hot = sliced.filter(F.col(SLICE) > 0)
        seeds = df.sparkSession.sparkContext.broadcast(_slice_anchors(hot, size, grid))
    ordered = sliced.repartition(KEY, SLICE).sortWithinPartitions(KEY, SLICE, AT, *tie)
    fields = list(df.schema.fields)
    if annotate:
        fields += [
            T.StructField("is_duplicate", T.BooleanType()),
            T.StructField("first_seen", T.LongType()),
            T.StructField("key_value", T.StringType()),
        ]
    out = ordered.mapInArrow(_scanner(size, df.columns, annotate, seeds), T.StructType(fields))
    if annotate:
        seen = F.timestamp_micros("first_seen").cast(df.schema[ts].dataType)
        out = out.withColumn("first_seen", seen)
    return out


def dedup_anchor(
    df: DataFrame,
    key: str | Column,
    ts: str,
    window,
    tie: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """The kept events only. ``tie`` orders events of equal time."""
    return _run(df, key, ts, window, tie, annotate=False, hot_rows=hot_rows)


def dedup_annotate(
    df: DataFrame,
    key: str | Column,
    ts: str,
    window,
    tie: Sequence[str] = (),
    hot_rows: int | None = None,
) -> DataFrame:
    """Every event with ``is_duplicate``, ``first_seen`` and ``key_value``."""
    return _run(df, key, ts, window, tie, annotate=True, hot_rows=hot_rows)


def dedup_minute_bucket(
    df: DataFrame, key: str, ts: str, window, tie: Sequence[str] = ()
) -> DataFrame:
    """Deduplicate inside each clock minute only.

    With a window of a minute or more that is the first row per (key, minute),
    which Spark prunes before the shuffle; shorter windows use the anchor scan
    on (key, minute).
    """
    size = window_micros(window)
    key_text = canonical_key(df, key)
    minute = F.date_trunc("minute", F.col(ts))
    if size < MINUTE:
        both = F.concat_ws(" ", F.floor(_micros(df, ts) / MINUTE).cast("string"), key_text)
        return dedup_anchor(df, both, ts, window, tie)
    keyed = df.withColumn(KEY, key_text).withColumn("__minute", minute)
    order = Window.partitionBy(KEY, "__minute").orderBy(ts, *tie)
    return (
        keyed.withColumn("__n", F.row_number().over(order))
        .filter("__n = 1")
        .drop(KEY, "__minute", "__n")
    )


def dedup_batch(
    df: DataFrame, key: str, ts: str, window, tie: Sequence[str] = ()
) -> DataFrame:
    """A whole static batch with one result row per event, in a fixed order of
    precedence (time, then ``tie``)."""
    return dedup_annotate(df, key, ts, window, tie)


def dedup_counters(failed: Column | None = None) -> list[Column]:
    """The counters over annotated rows, for an aggregate or an observation."""
    hits = F.count_if(F.col("is_duplicate"))
    errors = F.count_if(failed if failed is not None else F.lit(False))
    total = F.count("*")
    return [
        total.alias("events_processed"),
        hits.alias("events_deduped"),
        hits.alias("duplicates_blocked"),
        hits.alias("cache_hits"),
        (total - hits - errors).alias("cache_misses"),
        errors.alias("error_count"),
    ]


def dedup_metrics(annotated: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Counters over an annotated result and, optionally, its error rows."""
    rows = annotated.select("is_duplicate", F.lit(False).alias("failed"))
    if errors is not None:
        rows = rows.unionAll(
            errors.select(F.lit(None).cast("boolean"), F.lit(True))
        )
    return rows.agg(*dedup_counters(F.col("failed")))
