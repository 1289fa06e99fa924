"""Deduplication and matching on unbounded streams.

State per key, kept by lanes of keys, rows of a micro-batch taken in time
order. Payload columns travel as one JSON text, so any column type works and the
state schema is fixed.

``emit="eager"`` answers in the micro-batch a row arrives in; rows that reach an
earlier time than the key's state has seen are judged against that state.
``emit="on_watermark"`` holds rows until the watermark passes them and so gives
the batch answer whatever the arrival order within the watermark delay.

Deduplication judges every row, however late: the engine drops late rows by the
watermarked column, so that column stays behind and only its watermark goes on.
Matching takes rows late enough to meet any event that may still wait.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from millrace.functions.durations import micros, window_micros
from millrace.functions.keys import canonical_key
from millrace.operators.dedup import _micros
from millrace.session import ROCKSDB
from millrace.streaming.lanes import FRAME, Lane, LaneStore, dealt

# Fixed value: extra time a waiting event stays after its window.
RETENTION = "5m"
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "ignoreNullFields": "false",
}


def _timer(at_micros: int) -> int:
    """First whole millisecond after a time."""
    return at_micros // 1000 + 1


class _Timers:
    """The timers one key asks for; its lane has the engine's."""

    def __init__(self):
        self.times: list[int] = []

    def registerTimer(self, ms: int) -> None:
        self.times.append(ms)


class _Ordered(StatefulProcessor):
    """Feeds each key's rows to ``take`` in (time, id, side) order, at once or when
    the watermark has passed them. Keys are dealt to lanes (see ``lanes.py``)."""

    columns: list[str]

    def __init__(self, window: int, hold: bool):
        self.window, self.hold = window, hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.store = LaneStore(handle)
        self.open_state(handle)

    def open_state(self, handle) -> None:
        """State of the lane's keys beside their parts."""

    def bind(self, key: str, entry) -> None:
        """Turn to a key, of which its part holds ``entry``, or None."""
        raise NotImplementedError

    def entry(self):
        """What the part is to hold of the key, or None, and when it is due."""
        raise NotImplementedError

    def due(self, entry) -> int:
        """When, in ms, an entry of a part is due."""
        raise NotImplementedError

    def take(self, key, rows: list[tuple]) -> list[tuple]:
        raise NotImplementedError

    def expire(self, watermark: int) -> None:
        raise NotImplementedError

    def lapse(self, ms: int) -> None:
        self.expire(ms * 1000)

    def _turned(self, lane: Lane, number: int, keys, act) -> None:
        """``act`` on some keys of a part, which is written if that changed it."""
        part, changed = lane.part(number), False
        for key in keys(part):
            before = part.get(key)
            self.bind(key, before)
            act(key)
            after = self.entry()
            if after != before:
                changed = True
                part[key] = after
                if after is None:
                    del part[key]
        if changed:
            lane.keep(number, part, min(map(self.due, part.values()), default=None))

    def _feed(self, lane: Lane, rows: list, late: int | None) -> Iterator[pd.DataFrame]:
        """Take rows ``[time, id, side, body, part, key, watermark]``."""
        parts: dict[int, dict[str, list]] = {}
        for row in rows:
            parts.setdefault(row[4], {}).setdefault(row[5], []).append(row)
        out: list[tuple] = []
        for number, keys in parts.items():

            def act(key: str) -> None:
                mine = sorted(keys[key], key=lambda r: (r[0], r[1] or "", r[2]))
                # Rows that were held came in time, if none that is late came with them.
                self.watermark = late if any(len(r) > 6 for r in mine) else None
                out.extend((key, *r) for r in self.take((key,), [tuple(r[:4]) for r in mine]))

            self._turned(lane, number, lambda part: keys, act)
            if len(out) >= FRAME:
                yield pd.DataFrame(out, columns=["key_value", *self.columns])
                out.clear()
        if out:
            yield pd.DataFrame(out, columns=["key_value", *self.columns])

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues):
        names = ["at", "event", "side", "body", "part", "key_value"]
        lane, watermark = self.store.open(), timerValues.getCurrentWatermarkInMs() * 1000
        arrived, held = [], []
        for pdf in rows:
            for row in zip(*(pdf[n].tolist() for n in names)):
                if self.hold and row[0] >= watermark:
                    held.append([*row])
                else:
                    arrived.append([*row, True])
        if held:
            lane.hold(held)
        # What the watermark has passed already is not held; timers fire after
        # the input, so what they would release goes first.
        if self.hold and arrived:
            arrived += lane.release(watermark)
        yield from self._feed(lane, arrived, watermark)
        lane.close(_timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        lane = self.store.open()
        if not lane.woken(expiredTimerInfo.getExpiryTimeInMs()):
            return
        ms = timerValues.getCurrentWatermarkInMs()
        if self.hold:
            yield from self._feed(lane, list(lane.release(ms * 1000)), None)
        for number in [n for n, due in lane.due.items() if due <= ms]:
            lapsing = lambda part: [k for k, entry in part.items() if self.due(entry) <= ms]
            self._turned(lane, number, lapsing, lambda key: self.lapse(ms))
        lane.close(_timer)

    def close(self) -> None:
        pass


class AnchorProcessor(_Ordered):
    """One anchor per key; it lapses when the watermark has moved a window past
    it, or past where the watermark was if the anchor came late."""

    columns = ["first_seen", "is_duplicate", "body"]
    schema = "key_value string, first_seen bigint, is_duplicate boolean, body string"

    def __init__(self, window: int, hold: bool, annotate: bool = False):
        super().__init__(window, hold)
        self.annotate = annotate

    def bind(self, key, entry):
        self.anchor = entry

    def entry(self):
        return self.anchor

    def due(self, entry):
        return _timer(entry[1])

    def take(self, key, rows):
        before = self.anchor[0] if self.anchor else None
        anchor, out = _judge(self.window, before, rows)
        if anchor != before:
            until = max(anchor, anchor if self.watermark is None else self.watermark) + self.window
            self.anchor = [anchor, until]
        return out if self.annotate else [r for r in out if not r[1]]

    def expire(self, watermark: int) -> None:
        if self.anchor and self.anchor[1] < watermark:
            self.anchor = None


def _judge(window: int, anchor: int | None, rows: list[tuple]) -> tuple[int | None, list[tuple]]:
    """The anchor after some rows in time order, and (first seen, duplicate,
    body) of each. A row older than the anchor counts as a duplicate."""
    out = []
    for at, _, _, body in rows:
        duplicate = anchor is not None and at - anchor <= window
        if not duplicate:
            anchor = at
        out.append((anchor, duplicate, body))
    return anchor, out


# A key with no more waiting events than this keeps them in one value.
SMALL = 256


class Room:
    """Waiting events of one key during one micro-batch.

    A small room is one value of state, read and written whole. A larger one lies
    in two maps: ``lines`` holds the events of a side and a stretch of time one
    window wide, in (time, id) order, ``places`` the time of each waiting id,
    unless ids are known not to repeat. There a stretch is read when an arrival
    can reach it and written if it changed, so what a batch moves does not grow
    with what else waits.
    """

    def __init__(self, lines, places, window: int, whole: list[tuple] | None = None):
        self.lines, self.places, self.window = lines, places, window
        self.width = max(window, 1)
        self.whole = whole is not None
        self.loaded: dict[tuple[int, int], list[tuple]] = {}
        # Of the ids met in this batch, or of all in a small room: time or None.
        self.known: dict[tuple[int, str], int | None] = {}
        self.moved: set[tuple[int, str]] = set()
        self.changed: set[tuple[int, int]] = set()
        for side, at, event, body in whole or ():
            self.loaded.setdefault((side, at // self.width), []).append((at, event, body))
            self.known[side, event] = at
        for line in self.loaded.values():
            line.sort()

    def _line(self, side: int, stretch: int) -> list[tuple]:
        at = (side, stretch)
        if at not in self.loaded:
            held = None if self.whole else self.lines.getValue(at)
            self.loaded[at] = [tuple(r) for r in held[0]] if held is not None else []
        return self.loaded[at]

    def _place(self, side: int, event: str) -> int | None:
        if (side, event) not in self.known:
            held = None if self.whole else self.places.getValue((side, event))
            self.known[side, event] = held[0] if held is not None else None
        return self.known[side, event]

    def _put(self, side: int, event: str, at: int | None) -> None:
        if self.places is not None:
            self.known[side, event] = at
            self.moved.add((side, event))

    def arrive(self, side: int, event: str, at: int, body: str) -> tuple | None:
        """The (time, id, body) taken from the other side: the oldest at most a
        window away. None if the event now waits, in place of one with its id."""
        low, high = at - self.window, at + self.window
        for stretch in range(low // self.width, high // self.width + 1):
            line = self._line(1 - side, stretch)
            k = bisect_left(line, (low,))
            if k < len(line) and line[k][0] <= high:
                self.changed.add((1 - side, stretch))
                took = line.pop(k)
                self._put(1 - side, took[1], None)
                return took
        before = self._place(side, event) if self.places is not None else None
        if before is not None:
            line = self._line(side, before // self.width)
            del line[bisect_left(line, (before, event))]
            self.changed.add((side, before // self.width))
        insort(self._line(side, at // self.width), (at, event, body))
        self.changed.add((side, at // self.width))
        self._put(side, event, at)
        return None

    def waiting(self) -> list[tuple]:
        """What a small room holds."""
        return [(side, *event) for (side, _), line in self.loaded.items() for event in line]

    def save(self) -> set[int]:
        """Write to the maps what changed, or all of a room that was small; the
        stretches written that hold something."""
        places = self.known if self.whole else self.moved
        for at in self.loaded if self.whole else self.changed:
            if self.loaded[at]:
                self.lines.updateValue(at, (self.loaded[at],))
            elif not self.whole:
                self.lines.removeKey(at)
        for name in places if self.places is not None else ():
            if self.known[name] is not None:
                self.places.updateValue(name, (self.known[name],))
            elif not self.whole:
                self.places.removeKey(name)
        return {stretch for (side, stretch), line in self.loaded.items() if line}


class _KeyValue:
    """The value of one key in a lane's map, read once."""

    def __init__(self, values, key: str, known: bool):
        self.values, self.key = values, (key,)
        self.held = values.getValue(self.key) if known else None

    def get(self):
        return self.held

    def update(self, value: tuple) -> None:
        self.held = value
        self.values.updateValue(self.key, value)

    def clear(self) -> None:
        if self.held is not None:
            self.values.removeKey(self.key)
        self.held = None


class _KeyMap:
    """One key's part of a lane's map, with the places that are taken, if listed."""

    def __init__(self, values, key: str, known: list[list] | None):
        self.values, self.key = values, key
        self.known = None if known is None else [list(k) for k in known]

    def getValue(self, at: tuple):
        if self.known is not None and [*at] not in self.known:
            return None
        return self.values.getValue((self.key, *at))

    def updateValue(self, at: tuple, value: tuple) -> None:
        if self.known is not None and [*at] not in self.known:
            self.known.append([*at])
        self.values.updateValue((self.key, *at), value)

    def removeKey(self, at: tuple) -> None:
        if self.known is not None and [*at] in self.known:
            self.known.remove([*at])
        self.values.removeKey((self.key, *at))

    def keys(self) -> list[tuple]:
        return [tuple(k) for k in self.known]


class MatchProcessor(_Ordered):
    """Waiting events of both sides; one-to-one, oldest first."""

    columns = ["left_id", "right_id", "left_at", "right_at", "left_body", "right_body", "made_at"]
    schema = (
        "key_value string, left_id string, right_id string, left_at bigint, right_at bigint, "
        "left_body string, right_body string, made_at timestamp"
    )

    def __init__(self, window: int, hold: bool, life: int, unique_ids: bool = False, small: int = SMALL):
        super().__init__(window, hold)
        # How far the watermark may pass an event that waits.
        self.life, self.unique_ids, self.small = life, unique_ids, small

    def open_state(self, handle) -> None:
        event = "at: bigint, event: string, body: string"
        self.all_rooms = handle.getMapState(
            "rooms", "key string", f"spilled boolean, waiting array<struct<side: int, {event}>>"
        )
        self.all_lines = handle.getMapState(
            "lines", "key string, side int, stretch bigint", f"waiting array<struct<{event}>>"
        )
        self.all_places = None
        if not self.unique_ids:
            self.all_places = handle.getMapState("places", "key string, side int, event string", "at bigint")

    def bind(self, key, entry):
        # Of a key its part holds the times it is due and the stretches that are in the map.
        self.times, lines = entry or ([], [])
        self.handle = _Timers()
        self.room = _KeyValue(self.all_rooms, key, entry is not None)
        self.lines = _KeyMap(self.all_lines, key, lines)
        self.places = _KeyMap(self.all_places, key, None) if self.all_places is not None else None

    def entry(self):
        if self.room.held is None:
            return None
        # Rounded up to quarters of a window, so that they stay few.
        step = max(self.window // 4000, 1)
        new = {-(-ms // step) * step for ms in self.handle.times}
        return [sorted({*self.times, *new}), self.lines.known]

    def due(self, entry):
        return entry[0][0]

    def lapse(self, ms):
        self.times = [t for t in self.times if t > ms]
        super().lapse(ms)

    def _over(self, stretch: int) -> int:
        """When the last event of a stretch has waited long enough."""
        return (stretch + 1) * max(self.window, 1) + self.life

    def _opened(self) -> Room:
        held = self.room.get()
        spilled = held is not None and held[0]
        whole = None if spilled else [tuple(r) for r in held[1]] if held is not None else []
        return Room(self.lines, self.places, self.window, whole)

    def _keep(self, waiting: list[tuple]) -> None:
        if waiting:
            self.room.update((False, waiting))
        else:
            self.room.clear()

    def take(self, key, rows):
        room, out, latest = self._opened(), [], None
        for at, event, side, body in rows:
            took = room.arrive(side, event or "", at, body)
            if took is None:
                latest = at if latest is None else max(latest, at)
                continue
            mine, other = (event, at, body), (took[1], took[0], took[2])
            left, right = (mine, other) if side == 0 else (other, mine)
            made_at = pd.Timestamp(max(left[1], right[1]), unit="us", tz="UTC")
            out.append((left[0], right[0], left[1], right[1], left[2], right[2], made_at))
        waiting = room.waiting() if room.whole else []
        if room.whole and len(waiting) <= self.small:
            self._keep(waiting)
            if latest is not None:
                self.handle.registerTimer(_timer(latest + self.life))
        else:
            if room.whole:
                self.room.update((True, []))
            for stretch in room.save():
                self.handle.registerTimer(_timer(self._over(stretch)))
        return out

    def expire(self, watermark: int) -> None:
        held = self.room.get()
        if held is None:
            return
        if not held[0]:
            kept = [tuple(r) for r in held[1] if r[1] + self.life >= watermark]
            if len(kept) < len(held[1]):
                self._keep(kept)
            return
        left = 0
        for side, stretch in [tuple(k) for k in self.lines.keys()]:
            if self._over(stretch) >= watermark:
                left += 1
                continue
            if self.places is not None:
                for _, event, _ in self.lines.getValue((side, stretch))[0]:
                    self.places.removeKey((side, event))
            self.lines.removeKey((side, stretch))
        if not left:
            self.room.clear()


def _packed(df: DataFrame, key: str, ts: str, event_id: str | None, side: int, delay: str):
    """The fixed columns the processors read, watermarked on ``ts``."""
    # These processors need the RocksDB store; queries take the session's value.
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    kind = df.schema[ts].dataType
    if not isinstance(kind, T.TimestampType):
        raise ValueError(f"{ts} must be a timestamp column on a stream")
    event = F.col(event_id).cast("string") if event_id else F.lit("")
    return df.select(
        canonical_key(df, key).alias("key_value"),
        F.col(ts).alias("__time"),
        _micros(df, ts).alias("at"),
        event.alias("event"),
        F.lit(side).alias("side"),
        F.to_json(F.struct(*df.columns), _JSON).alias("body"),
    ).withWatermark("__time", delay)


def _check_emit(emit: str) -> bool:
    if emit not in ("eager", "on_watermark"):
        raise ValueError(f"unknown emit mode: {emit!r}")
    return emit == "on_watermark"


def dedup_stream(
    df: DataFrame,
    key: str,
    ts: str,
    window,
    event_id: str | None = None,
    delay: str = "10 minutes",
    emit: str = "eager",
    annotate: bool = False,
) -> DataFrame:
    """Kept events of a stream, or all of them annotated. State per key is one
    anchor, dropped when the watermark passes its window. ``delay`` sets that
    watermark; rows later than it are judged by the anchor that is there, or
    kept if there is none."""
    size, hold = window_micros(window), _check_emit(emit)
    keyed = _packed(df, key, ts, event_id, 0, delay).drop("__time")
    keyed = keyed.withColumns(dealt("key_value")).groupBy("lane")
    out = keyed.transformWithStateInPandas(
        AnchorProcessor(size, hold, annotate), AnchorProcessor.schema, "append", "EventTime"
    )
    row = out.withColumn("__row", F.from_json("body", df.schema, _JSON))
    if not annotate:
        return row.select("__row.*")
    seen = F.timestamp_micros("first_seen").alias("first_seen")
    return row.select("__row.*", "is_duplicate", seen, "key_value")


def match_stream(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    event_id: str,
    window,
    delay: str | None = None,
    emit: str = "eager",
    retention=RETENTION,
    unique_ids: bool = False,
) -> DataFrame:
    """One-to-one matches of two streams as joined events (see
    ``match.joined_projection``), with ``made_at``, the later of the two times,
    as the event time of whatever follows.

    An event waits until the slower side is its window and ``retention`` ahead.
    The default ``delay`` of an eager match is two windows and ``retention``, so
    any row that the engine drops is too late for every event that waits; held
    rows (``on_watermark``) are held for 5 minutes. With a ``delay`` of the
    caller's, the watermark has to be that far ahead instead. Events lapse by
    stretches of one window, so some wait up to a window longer. A repeated id
    replaces the waiting one; ``unique_ids`` says there are none and saves looking.
    """
    size, hold = window_micros(window), _check_emit(emit)
    life = size + micros(retention)
    if delay is None and hold:
        delay = "5 minutes"
    elif delay is None:
        delay, life = f"{life + size} microseconds", -size
    both = _packed(left, key, ts, event_id, 0, delay).unionByName(
        _packed(right, key, ts, event_id, 1, delay)
    )
    processor = MatchProcessor(size, hold, life, unique_ids)
    out = both.withColumns(dealt("key_value")).groupBy("lane").transformWithStateInPandas(
        processor, MatchProcessor.schema, "append", "EventTime", eventTimeColumnName="made_at"
    )
    return out.select(
        F.concat_ws("_", F.lit("joined"), "left_id", "right_id").alias("joined_id"),
        F.col("key_value").alias("join_key"),
        F.from_json("left_body", left.schema, _JSON).alias("left_data"),
        F.from_json("right_body", right.schema, _JSON).alias("right_data"),
        F.timestamp_micros("left_at").alias("left_time"),
        F.timestamp_micros("right_at").alias("right_time"),
        (F.abs(F.col("right_at") - F.col("left_at")) * 1000).alias("join_delay"),
        "made_at",
    )


def dedup_joined_stream(df: DataFrame, key: str, body: str, window) -> DataFrame:
    """Kept rows (as their ``body`` text) of a matched stream, judged by the key
    text in ``key`` at ``made_at``; runs in the same query as the match."""
    keyed = df.select(
        F.col(key).alias("key_value"), _micros(df, "made_at").alias("at"),
        F.col("joined_id").alias("event"), F.lit(0).alias("side"), F.col(body).alias("body"),
    )
    judged = keyed.withColumns(dealt("key_value")).groupBy("lane").transformWithStateInPandas(
        AnchorProcessor(window_micros(window), False), AnchorProcessor.schema, "append", "EventTime"
    )
    return judged.select("body")
