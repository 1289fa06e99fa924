"""One-to-one temporal matching of two event sets, and its ledger.

Per key, events of both sides are taken in time order. An event takes the
oldest waiting event of the other side that is at most a window away, and both
are used up; otherwise it waits.

While one side waits the other does not, and the waiting events are always that
side's most recent ones. The state of a key is therefore one signed number
``q``: lefts waiting (positive) or rights waiting (negative). Each arrival
clamps ``q`` to the number of events still inside the window and then moves it
by one, and clamp-and-add steps compose into one clamp-and-add step. That is
what lets a very large key be cut into time slices that run in parallel with
three numbers passed between them. Partners are named by their rank within
(key, side) and brought together by one shuffle on (key, side, rank), which is
unique and so cannot be skewed.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.durations import interval, micros, window_micros
from millrace.functions.keys import canonical_key
from millrace.operators import hotkeys
from millrace.operators.dedup import AT, KEY, SLICE, _batch_columns, _micros, _starts
from millrace.session import shared_dir

LEFT, RIGHT = 0, 1
SIDE, EVENT, GONE = "__side", "__event", "__gone"


def side_tag(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs in one frame with a ``side`` column; columns are joined by
    name and absent ones are null."""
    return left.withColumn("side", F.lit("left")).unionByName(
        right.withColumn("side", F.lit("right")), allowMissingColumns=True
    )


def _slim(df: DataFrame, key: str, ts: str, event_id: str, side: int) -> DataFrame:
    return df.select(
        canonical_key(df, key).alias(KEY),
        _micros(df, ts).alias(AT),
        F.lit(side).alias(SIDE),
        F.col(event_id).alias(EVENT),
    )


def tagged(left, right, key, ts, event_id) -> DataFrame:
    """Both sides reduced to (key, time, side, id)."""
    return _slim(left, key, ts, event_id, LEFT).unionAll(
        _slim(right, key, ts, event_id, RIGHT)
    )


# ------------------------------------------------------------------- the scan

# Bounds that clamp nothing.
FREE = (np.iinfo(np.int64).min, np.iinfo(np.int64).max)


# Few places a block: the passes of all levels together are what small batches pay.
BLOCK = 16


def _clamped(q: int, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """``q`` after each of a row of clamps.

    Clamps compose: one after another they amount to one pair of bounds. The row
    is cut into blocks that are composed side by side, one place of all blocks at
    a time; the same is done for the blocks' totals, and each block then clamps
    the value that enters it.
    """
    n = len(low)
    width = min(BLOCK, n)
    blocks = -(-n // width)
    a, b = (np.full(blocks * width, free) for free in FREE)
    a[:n], b[:n] = low, high
    a, b = (np.ascontiguousarray(x.reshape(blocks, width).T) for x in (a, b))
    for above, here in zip(range(width - 1), range(1, width)):
        a[here], b[here] = (np.minimum(np.maximum(x[above], a[here]), b[here]) for x in (a, b))
    enters = np.full(blocks, q, dtype=np.int64)
    if blocks > 1:
        enters[1:] = _clamped(q, a[-1], b[-1])[:-1]
    return np.minimum(np.maximum(enters, a), b).T.ravel()[:n]


def _composed(low: np.ndarray, high: np.ndarray) -> tuple[int, int]:
    """The bounds that all clamps amount to, by halving."""
    while len(low) > 1:
        if len(low) % 2:
            low, high = np.append(low, FREE[0]), np.append(high, FREE[1])
        a, b = low[1::2], high[1::2]
        low, high = (np.minimum(np.maximum(x[::2], a), b) for x in (low, high))
    return int(low[0]), int(high[0])


def _walk(q: int, step: np.ndarray, low: np.ndarray, high: np.ndarray):
    """``q`` before each arrival, clamped to the window, and after the last.

    Each arrival clamps and adds. With the sum of the steps so far taken off,
    only clamps are left, and those compose.
    """
    if not len(step):
        return step, q
    moved = np.cumsum(step) - step
    states = _clamped(q, low - moved, high - moved) + moved
    return states, int(states[-1] + step[-1])


def _partners(step, waiting, lefts, rights):
    """Own rank and the rank of the partner taken (0: none) of each arrival,
    given the arrivals of both sides before it."""
    is_left = step == 1
    rank = np.where(is_left, lefts, rights) + 1
    takes_right, takes_left = is_left & (waiting < 0), ~is_left & (waiting > 0)
    partner = np.where(
        takes_right, rights + waiting + 1, np.where(takes_left, lefts - waiting + 1, 0)
    )
    return rank, partner


class WindowScan:
    """Walks sorted arrivals of whole keys. How many are still inside the
    window is looked up in the times themselves, so no departures are needed;
    of a key that goes on in the next batch the times of one window are kept."""

    NONE = np.empty(0, dtype=np.int64)

    def __init__(self, window: int):
        self.window = window
        self.key = None
        self.q = 0
        self.totals = (0, 0)
        self.recent = (self.NONE, self.NONE)

    def feed(self, keys: pa.Array, at: np.ndarray, side: np.ndarray):
        """(rank, partner rank or 0) of every row of a batch."""
        n = len(at)
        starts = _starts(keys, np.zeros(n, dtype=np.int32))
        low = int(at.min())
        stride = int(at.max()) - low + self.window + 1
        if len(starts) * stride >= 1 << 62:
            half = n // 2
            parts = [
                self.feed(keys.slice(a, b - a), at[a:b], side[a:b])
                for a, b in ((0, half), (half, n))
            ]
            return tuple(np.concatenate(c) for c in zip(*parts))
        if keys[0].as_py() != self.key:
            self.q, self.totals, self.recent = 0, (0, 0), (self.NONE, self.NONE)
        sizes = np.diff(np.append(starts, n))
        line = np.repeat(np.arange(len(starts)) * stride, sizes) + (at - low)
        first = int(sizes[0])
        inside, before = [], []
        for s in (LEFT, RIGHT):
            mine = side == s
            prior = np.cumsum(mine) - mine
            open_ = prior - np.searchsorted(line[mine], line - self.window, side="left")
            kept = self.recent[s]
            open_[:first] += len(kept) - np.searchsorted(kept, at[:first] - self.window, side="left")
            rank = prior - np.repeat(prior[starts], sizes)
            rank[:first] += self.totals[s]
            inside.append(open_)
            before.append(rank)
        step = np.where(side == LEFT, 1, -1)
        waiting, self.q = _walk(self.q, step, -inside[RIGHT], inside[LEFT])
        last = int(starts[-1])
        floor = int(at[-1]) - self.window
        recent, totals = [], []
        for s in (LEFT, RIGHT):
            times = at[last:][side[last:] == s]
            if last == 0:
                times = np.concatenate((self.recent[s], times))
            recent.append(times[np.searchsorted(times, floor, side="left") :])
            totals.append(int(before[s][-1]) + int(side[-1] == s))
        self.recent, self.totals = tuple(recent), tuple(totals)
        self.key = keys[n - 1].as_py()
        return _partners(step, waiting, before[LEFT], before[RIGHT])

def _counts(batch: pa.RecordBatch, starts: np.ndarray, carried: tuple[int, int, int, int]):
    """Running arrivals and departures per side, before each row.

    ``carried`` holds the first group's counts when it continues an earlier
    batch or slice; other groups start from zero.
    """
    side = batch.column(batch.schema.get_field_index(SIDE)).to_numpy()
    gone = batch.column(batch.schema.get_field_index(GONE)).to_numpy()
    sizes = np.diff(np.append(starts, len(side)))
    before = []
    for i, (s, g) in enumerate(((LEFT, 0), (RIGHT, 0), (LEFT, 1), (RIGHT, 1))):
        hit = ((side == s) & (gone == g)).astype(np.int64)
        total = np.cumsum(hit)
        prior = total - hit
        base = prior[starts].copy()
        base[0] -= carried[i]
        before.append((prior - np.repeat(base, sizes), hit))
    return side, gone, before


class RankScan:
    """Walks sorted arrivals and departures, carrying five numbers per key."""

    FRESH = (0, 0, 0, 0, 0)

    def __init__(self, seeds: dict[tuple[str, int], tuple[int, int, int, int, int]] | None = None):
        self.seeds = seeds or {}
        self.name = None
        self.state = self.FRESH

    def feed(self, batch: pa.RecordBatch):
        """(rows, side, rank, partner rank or 0) of the arrivals in a batch."""
        keys, slices, _ = _batch_columns(batch)
        starts = _starts(keys, slices)
        first = (keys[0].as_py(), int(slices[0]))
        seeded = None
        if first != self.name:
            self.state = self.seeds.get(first, self.FRESH)
        if self.seeds:
            seeded = {
                s: self.seeds[name]
                for s in starts[1:].tolist()
                if (name := (keys[s].as_py(), int(slices[s]))) in self.seeds
            }
        if seeded:
            edges = sorted({0, *seeded, batch.num_rows})
            parts = []
            for a, b in zip(edges, edges[1:]):
                rows, *rest = self.feed(batch.slice(a, b - a))
                parts.append((rows + a, *rest))
            return tuple(np.concatenate(c) for c in zip(*parts))

        side, gone, before = _counts(batch, starts, self.state[:4])
        (l_in, _), (r_in, _), (l_out, _), (r_out, _) = before
        rows = np.flatnonzero(gone == 0)
        step = np.where(side[rows] == LEFT, 1, -1)
        waiting, q = _walk(self.state[4], step, (r_out - r_in)[rows], (l_in - l_out)[rows])
        rank, partner = _partners(step, waiting, l_in[rows], r_in[rows])
        ends = [int(c[-1] + h[-1]) for c, h in before]
        self.state = (*ends, int(q))
        self.name = (keys[batch.num_rows - 1].as_py(), int(slices[-1]))
        return rows, side[rows], rank, partner


_RANKED = "key string, rank bigint, side int, at bigint, event {id}, partner bigint"


def _window_ranker(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = WindowScan(window)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            named = dict(zip(batch.schema.names, batch.columns))
            side = named[SIDE].to_numpy()
            rank, partner = scan.feed(named[KEY], named[AT].to_numpy(), side)
            yield pa.RecordBatch.from_arrays(
                [named[KEY], pa.array(rank, pa.int64()), named[SIDE], named[AT], named[EVENT],
                 pa.array(partner, pa.int64())],
                names=["key", "rank", "side", "at", "event", "partner"],
            )

    return run


def _ranker(seeds):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = RankScan(seeds.value if seeds is not None else None)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            rows, side, rank, partner = scan.feed(batch)
            if not len(rows):
                continue
            taken = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays(
                [
                    taken.column(taken.schema.get_field_index(KEY)),
                    pa.array(rank, pa.int64()),
                    pa.array(side, pa.int32()),
                    taken.column(taken.schema.get_field_index(AT)),
                    taken.column(taken.schema.get_field_index(EVENT)),
                    pa.array(partner, pa.int64()),
                ],
                names=["key", "rank", "side", "at", "event", "partner"],
            )

    return run


# ------------------------------------------------- slices of very large keys

def _slice_effect(counts: dict[tuple[str, int], tuple[int, int, int, int]]):
    """Per slice, the clamp-and-add its arrivals compose to: (low, high, add)."""

    def run(batches):
        scan_name, held = None, list(RankScan.FRESH[:4])
        effect: dict[tuple[str, int], list[int]] = {}
        for batch in batches:
            if batch.num_rows == 0:
                continue
            keys, slices, _ = _batch_columns(batch)
            starts = _starts(keys, slices).tolist()
            for a, b in zip(starts, starts[1:] + [batch.num_rows]):
                name = (keys[a].as_py(), int(slices[a]))
                if name != scan_name:
                    scan_name, held = name, list(counts[name])
                part = batch.slice(a, b - a)
                side, gone, before = _counts(part, np.zeros(1, dtype=np.int64), tuple(held))
                (l_in, _), (r_in, _), (l_out, _), (r_out, _) = before
                rows = np.flatnonzero(gone == 0)
                low, high, add = effect.get(name, (*FREE, 0))
                if len(rows):
                    step = np.where(side[rows] == LEFT, 1, -1)
                    moved = add + np.cumsum(step) - step
                    bounds = (r_out - r_in)[rows] - moved, (l_in - l_out)[rows] - moved
                    low, high = _composed(*(np.append(x, y) for x, y in zip((low, high), bounds)))
                    add += int(step.sum())
                effect[name] = (low, high, add)
                held = [int(c[-1] + h[-1]) for c, h in before]
        yield pa.RecordBatch.from_pydict(
            {
                "key": [k for k, _ in effect],
                "slice": pa.array([s for _, s in effect], pa.int32()),
                "low": pa.array([e[0] for e in effect.values()], pa.int64()),
                "high": pa.array([e[1] for e in effect.values()], pa.int64()),
                "add": pa.array([e[2] for e in effect.values()], pa.int64()),
            }
        )

    return run


def _slice_states(rows: DataFrame):
    """State entering each slice of the hot keys. Only one short record per
    slice reaches the driver."""
    kinds = [((LEFT, 0), "a"), ((RIGHT, 0), "b"), ((LEFT, 1), "c"), ((RIGHT, 1), "d")]
    tallies = rows.groupBy(KEY, SLICE).agg(
        *[
            F.count_if((F.col(SIDE) == side) & (F.col(GONE) == gone)).alias(name)
            for (side, gone), name in kinds
        ]
    )
    tallies = sorted(tallies.collect(), key=lambda r: (r[KEY], r[SLICE]))
    counts: dict[tuple[str, int], tuple[int, int, int, int]] = {}
    key, held = None, (0, 0, 0, 0)
    for r in tallies:
        if r[KEY] != key:
            key, held = r[KEY], (0, 0, 0, 0)
        counts[(key, r[SLICE])] = held
        held = tuple(h + r[n] for h, n in zip(held, "abcd"))
    shared = rows.sparkSession.sparkContext.broadcast(counts)
    effects = {
        (r["key"], r["slice"]): r
        for r in rows.repartition(KEY, SLICE)
        .sortWithinPartitions(KEY, SLICE, AT, GONE, EVENT, SIDE)
        .mapInArrow(
            lambda batches: _slice_effect(shared.value)(batches),
            "key string, slice int, low bigint, high bigint, add bigint",
        )
        .collect()
    }
    states, key, q = {}, None, 0
    for name in sorted(counts):
        if name[0] != key:
            key, q = name[0], 0
        states[name] = (*counts[name], q)
        e = effects[name]
        q = min(max(q, e["low"]), e["high"]) + e["add"]
    return states


# ------------------------------------------------------- repeated event ids

class WaitingRoom:
    """Waiting events of one key, each side in (time, id) order and at most one
    per event id. An arrival takes the oldest of the other side that lies within
    the window before or after it.

    ``ordered`` arrivals never look back, so what they have left behind is let
    go; else whoever owns the room expires it.
    """

    def __init__(self, window: int, ordered: bool = True):
        self.window, self.ordered = window, ordered
        self.lines: tuple[list, list] = ([], [])
        self.sides: tuple[dict, dict] = ({}, {})
        self.arrivals = 0

    def add(self, side: int, event, at: int, arrival: int = 0) -> None:
        """Let an event wait, in place of an earlier one with its id."""
        line, known = self.lines[side], self.sides[side]
        if event in known:
            del line[bisect_left(line, (known[event][0], event))]
        known[event] = (at, arrival)
        insort(line, (at, event))

    def arrive(self, side: int, event, at: int):
        """The (id, time, arrival number) taken from the other side, or None if
        the event now waits."""
        if self.ordered:
            for line, known in zip(self.lines, self.sides):
                gone = bisect_left(line, (at - self.window,))
                for _, old in line[:gone]:
                    del known[old]
                del line[:gone]
        self.arrivals += 1
        line, known = self.lines[1 - side], self.sides[1 - side]
        k = bisect_left(line, (at - self.window,))
        if k < len(line) and line[k][0] <= at + self.window:
            _, taken = line.pop(k)
            return taken, *known.pop(taken)
        self.add(side, event, at, self.arrivals)
        return None


def _roomer(window: int, id_type: pa.DataType):
    """Ledger of sorted arrivals whose ids may repeat; memory is one key's
    waiting events."""

    def run(batches):
        key, room = None, WaitingRoom(window)
        for batch in batches:
            out: list[tuple] = []
            data = batch.select([KEY, AT, SIDE, EVENT]).to_pydict()
            for k, at, side, event in zip(*data.values()):
                if k != key:
                    key, room = k, WaitingRoom(window)
                took = room.arrive(side, event, at)
                n = room.arrivals
                if took is None:
                    out.append((k, n, side, event, at, None, None, True))
                else:
                    out.append((k, n, side, event, at, took[0], took[1], False))
                    out.append((k, took[2], 1 - side, took[0], took[1], event, at, True))
            if out:
                columns = list(zip(*out))
                types = [pa.string(), pa.int64(), pa.int32(), id_type, pa.int64(), id_type, pa.int64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["key", "n", "side", "event", "at", "mate", "mate_at", "waited"],
                )

    return run


_LEDGER = "key string, n bigint, side int, event {id}, at bigint, mate {id}, mate_at bigint, waited boolean"


def _by_key(events: DataFrame) -> DataFrame:
    """Rows of a key in one partition, in a shuffle of their own. By the key alone
    that shuffle is left out above a join by the key; should the join then turn
    into a broadcast one while it runs, rows stay where they were written. The
    number makes it differ from the join's."""
    return events.repartition(KEY, F.lit(0))


def _room_ledger(events: DataFrame, window: int) -> DataFrame:
    id_type = events.schema[EVENT].dataType
    arrow_type = pa.int64() if isinstance(id_type, T.LongType) else pa.string()
    if not isinstance(id_type, (T.LongType, T.StringType)):
        events = events.withColumn(EVENT, F.col(EVENT).cast("string"))
    rows = (
        _by_key(events)
        .sortWithinPartitions(KEY, AT, EVENT, SIDE)
        .mapInArrow(
            _roomer(window, arrow_type),
            _LEDGER.format(id="bigint" if arrow_type == pa.int64() else "string"),
        )
    )
    # A waiting event appears once when it arrives and, if taken, once more;
    # its arrival number within the key tells repeats of one id apart.
    return (
        rows.groupBy("key", "n", "side", "event", "at", "waited")
        .agg(F.max("mate").alias("mate"), F.max("mate_at").alias("mate_at"))
        .drop("n")
        .withColumn("event", F.col("event").cast(id_type))
        .withColumn("mate", F.col("mate").cast(id_type))
    )


# ------------------------------------------------------------------ operators

def _ranked_slices(events: DataFrame, window: int, grid, schema: str) -> DataFrame:
    """Ranks and partners of the hot keys, slice by slice in parallel.

    Each event also departs when its window ends, so that a slice knows how
    many are inside the window from two running counts.
    """
    hot = events.filter(F.col(KEY).isin(list(grid.grid)))
    moves = hot.withColumn(
        "__m",
        F.array(
            F.struct(F.col(AT).alias("t"), F.lit(0).alias("g")),
            F.struct((F.col(AT) + window).alias("t"), F.lit(1).alias("g")),
        ),
    ).select(KEY, SIDE, EVENT, F.inline("__m").alias(AT, GONE))
    # A departure only counts; its id would be shuffled for nothing.
    moves = moves.withColumn(EVENT, F.when(F.col(GONE) == 0, F.col(EVENT)))
    sliced = grid.slice_column(moves, KEY, F.col(AT), SLICE)
    seeds = events.sparkSession.sparkContext.broadcast(_slice_states(sliced))
    return (
        sliced.repartition(KEY, SLICE)
        .sortWithinPartitions(KEY, SLICE, AT, GONE, EVENT, SIDE)
        .mapInArrow(_ranker(seeds), schema)
    )


def _rank_ledger(events: DataFrame, window: int, hot_rows: int | None) -> DataFrame:
    grid = hotkeys.find_hot_keys(events, KEY, AT, hot_rows)
    sliced = grid.slice_column(events, KEY, F.col(AT), SLICE)
    schema = _RANKED.format(id=events.schema[EVENT].dataType.simpleString())
    ranked = (
        sliced.filter(F.col(SLICE) == 0)
        .select(KEY, AT, SIDE, EVENT)
        .transform(_by_key)
        .sortWithinPartitions(KEY, AT, EVENT, SIDE)
        .mapInArrow(_window_ranker(window), schema)
    )
    if grid:
        ranked = ranked.unionAll(_ranked_slices(events, window, grid, schema))
    id_type = events.schema[EVENT].dataType.simpleString()
    # Every arrival files itself under its own rank; one that takes a partner
    # also files itself under the partner's rank on the other side.
    own = F.struct(
        F.col("side").alias("s"),
        F.col("rank").alias("r"),
        F.when(F.lit(True), F.struct("event", "at")).alias("holder"),
        (F.col("partner") == 0).alias("waited"),
        F.when(F.lit(False), F.struct("event", "at")).alias("taker"),
    )
    call = F.struct(
        (F.lit(1) - F.col("side")).alias("s"),
        F.col("partner").alias("r"),
        F.when(F.lit(False), F.struct("event", "at")).alias("holder"),
        F.lit(None).cast("boolean").alias("waited"),
        F.when(F.lit(True), F.struct("event", "at")).alias("taker"),
    )
    filed = ranked.select(
        "key", F.inline(F.when(F.col("partner") > 0, F.array(own, call)).otherwise(F.array(own)))
    )
    met = filed.groupBy("key", "s", "r").agg(
        F.max("holder.event").alias("h"),
        F.max("holder.at").alias("h_at"),
        F.bool_or("waited").alias("waited"),
        F.max("taker.event").alias("t"),
        F.max("taker.at").alias("t_at"),
    )
    waiter = F.struct(
        F.col("s").alias("side"), F.col("h").alias("event"), F.col("h_at").alias("at"),
        F.col("t").alias("mate"), F.col("t_at").alias("mate_at"), F.lit(True).alias("waited"),
    )
    taker = F.struct(
        (F.lit(1) - F.col("s")).alias("side"), F.col("t").alias("event"), F.col("t_at").alias("at"),
        F.col("h").alias("mate"), F.col("h_at").alias("mate_at"), F.lit(False).alias("waited"),
    )
    return met.select(
        "key",
        F.inline(
            F.when(F.col("waited") & F.col("t_at").isNotNull(), F.array(waiter, taker))
            .when(F.col("waited"), F.array(waiter))
            .otherwise(F.array().cast("array<struct<side:int,event:%s,at:bigint,mate:%s,"
                                       "mate_at:bigint,waited:boolean>>" % (id_type, id_type)))
        ),
    )


def staged(events: DataFrame) -> DataFrame:
    """The four slim columns written to the shared folder once, because the
    split below reads them four times and their source may be costly."""
    path = shared_dir(events.sparkSession, "match-events")
    events.write.parquet(path)
    return events.sparkSession.read.schema(events.schema).parquet(path)


def match_ledger(
    left: DataFrame,
    right: DataFrame,
    key: str,
    ts: str,
    event_id: str,
    window,
    unique_ids: bool = False,
    hot_rows: int | None = None,
) -> DataFrame:
    """One row per event: ``join_key, side, event_id, event_time, matched_id,
    matched_time, is_joined, orphan_on_arrival``.

    ``is_joined`` says whether the event was ever matched; ``orphan_on_arrival``
    whether it had to wait. With ``unique_ids`` false, keys in which an id
    repeats on one side follow the replace rule (a repeated id replaces the
    waiting one); keys without repeats use the sliceable scan either way.
    """
    size = window_micros(window)
    events = tagged(left, right, key, ts, event_id)
    if unique_ids:
        ledger = _rank_ledger(events, size, hot_rows)
    else:
        events = staged(events)
        repeats = (
            events.groupBy(KEY, SIDE, EVENT).count().filter("count > 1").select(KEY).distinct()
        )
        if repeats.isEmpty():
            ledger = _rank_ledger(events, size, hot_rows)
        else:
            plain = events.join(repeats, KEY, "left_anti")
            doubled = events.join(repeats, KEY, "left_semi")
            ledger = _rank_ledger(plain, size, hot_rows).unionByName(_room_ledger(doubled, size))
    kind = left.schema[ts].dataType
    return ledger.select(
        F.col("key").alias("join_key"),
        F.when(F.col("side") == LEFT, "left").otherwise("right").alias("side"),
        F.col("event").alias("event_id"),
        F.timestamp_micros("at").cast(kind).alias("event_time"),
        F.col("mate").alias("matched_id"),
        F.timestamp_micros("mate_at").cast(kind).alias("matched_time"),
        F.col("mate_at").isNotNull().alias("is_joined"),
        F.col("waited").alias("orphan_on_arrival"),
    )


def pairs(ledger: DataFrame) -> DataFrame:
    """Matched pairs: ``join_key, left_id, right_id, left_time, right_time``."""
    return ledger.filter("side = 'left' AND is_joined").select(
        "join_key",
        F.col("event_id").alias("left_id"),
        F.col("matched_id").alias("right_id"),
        F.col("event_time").alias("left_time"),
        F.col("matched_time").alias("right_time"),
    )


def temporal_match(left, right, key, ts, event_id, window, **options) -> DataFrame:
    """Pairs of the one-to-one consuming match."""
    return pairs(match_ledger(left, right, key, ts, event_id, window, **options))


def _delay_ns(left_time, right_time):
    def as_micros(c):
        return F.unix_micros(c.cast("timestamp"))

    return F.abs(as_micros(right_time) - as_micros(left_time)) * 1000


def joined_projection(
    matched: DataFrame, left: DataFrame, right: DataFrame, ts: str, event_id: str, key: str,
    unique_ids: bool = False,
) -> DataFrame:
    """Joined events with both payloads, times and the delay in nanoseconds.

    Payloads are fetched back by (key, id, time), so unmatched rows and wide
    columns never enter the scan. Rows alike in all three stand for one event
    and any one of them gives the payload; ``unique_ids`` says there are none.
    """
    l = left.select(
        canonical_key(left, key).alias("join_key"),
        F.col(event_id).alias("left_id"), F.col(ts).alias("left_time"),
        F.struct(*left.columns).alias("left_data"),
    )
    r = right.select(
        canonical_key(right, key).alias("join_key"),
        F.col(event_id).alias("right_id"), F.col(ts).alias("right_time"),
        F.struct(*right.columns).alias("right_data"),
    )
    left_key, right_key = (["join_key", f"{side}_id", f"{side}_time"] for side in ("left", "right"))
    if not unique_ids:
        l, r = l.dropDuplicates(left_key), r.dropDuplicates(right_key)
    # Sizes are estimated from compressed files, where payloads look small enough
    # to be broadcast; merging sends no side through the driver.
    return (
        matched.join(l.hint("merge"), left_key)
        .join(r.hint("merge"), right_key)
        .select(
            F.concat_ws("_", F.lit("joined"), "left_id", "right_id").alias("joined_id"),
            "join_key",
            "left_data",
            "right_data",
            "left_time",
            "right_time",
            _delay_ns(F.col("left_time"), F.col("right_time")).alias("join_delay"),
        )
    )


def orphans_final(ledger: DataFrame) -> DataFrame:
    """Events that were never matched."""
    return ledger.filter(~F.col("is_joined")).select("join_key", "side", "event_id", "event_time")


def orphans_on_arrival(ledger: DataFrame) -> DataFrame:
    """Per side, how many events had to wait (whether or not matched later)."""
    return ledger.groupBy("side").agg(
        F.count_if("orphan_on_arrival").alias("orphaned_events")
    )


def sweep(
    ledger: DataFrame, window, now: Column, retention="5m"
) -> tuple[DataFrame, DataFrame]:
    """(still waiting, swept): unmatched events split by whether their window
    plus ``retention`` has run out at ``now``."""
    life = window_micros(window) + micros(retention)
    waiting = ledger.filter(~F.col("is_joined"))
    over = F.col("event_time") + F.expr(interval(life)) < now
    return waiting.filter(~over), waiting.filter(over)


def late_flag(df: DataFrame, ts: str, arrival: str, window) -> DataFrame:
    """Add ``is_late``: the event arrived more than a window after its time."""
    size = window_micros(window)
    late = _micros(df, arrival) - _micros(df, ts) > size
    return df.withColumn("is_late", late)


def flag_ledger(
    ledger: DataFrame, left: DataFrame, right: DataFrame, key: str, ts: str, event_id: str,
    arrival: str, window,
) -> DataFrame:
    """The ledger with ``is_late`` (see ``late_flag``) of each event. Rows alike in
    key, id and time are one event, late if any of them is."""
    on = ["join_key", "side", "event_id", "event_time"]

    def marks(df: DataFrame, side: str) -> DataFrame:
        return late_flag(df, ts, arrival, window).select(
            canonical_key(df, key).alias("join_key"), F.lit(side).alias("side"),
            F.col(event_id).alias("event_id"), F.col(ts).alias("event_time"), "is_late",
        )

    both = marks(left, "left").unionAll(marks(right, "right"))
    late = both.filter("is_late").select(on).distinct().withColumn("is_late", F.lit(True))
    flagged = ledger.join(late, on, "left")
    return flagged.withColumn("is_late", F.coalesce("is_late", F.lit(False)))


def join_counters(late: Column | None = None, failed: Column | None = None) -> list[Column]:
    """The counters over ledger rows, for an aggregate or an observation."""
    side, waited = F.col("side"), F.col("orphan_on_arrival")
    none = F.lit(False)
    return [
        F.count_if(side == "left").alias("left_events_processed"),
        F.count_if(side == "right").alias("right_events_processed"),
        F.count_if((side == "left") & F.col("is_joined")).alias("successful_joins"),
        F.count_if((side == "left") & waited).alias("orphaned_left_events"),
        F.count_if((side == "right") & waited).alias("orphaned_right_events"),
        F.count_if((late if late is not None else none) & waited).alias("late_arrivals"),
        F.count_if(failed if failed is not None else none).alias("error_count"),
        F.count_if(waited & ~F.col("is_joined")).alias("state_store_size"),
    ]


def join_metrics(
    ledger: DataFrame, late: str | None = None, errors: DataFrame | None = None
) -> DataFrame:
    """Counters over the ledger. ``late`` names a boolean ledger column; a late
    event counts only if it had to wait. ``state_size`` is what still waits."""
    is_late = F.col(late) if late else F.lit(False)
    rows = ledger.select(
        "side", "is_joined", "orphan_on_arrival", is_late.alias("late"),
        F.lit(False).alias("failed"),
    )
    if errors is not None:
        none = F.lit(None)
        rows = rows.unionAll(
            errors.select(
                none.cast("string"), none.cast("boolean"), none.cast("boolean"),
                none.cast("boolean"), F.lit(True),
            )
        )
    return rows.agg(*join_counters(F.col("late"), F.col("failed")))


def join_stats(metrics: DataFrame, window) -> DataFrame:
    """Summary rates. ``join_rate_percent`` counts pairs per event and so cannot
    pass 50; ``match_rate_percent`` counts matched events per event."""
    total = F.col("left_events_processed") + F.col("right_events_processed")
    joins = F.col("successful_joins")
    rate = F.when(total > 0, joins / total * 100).otherwise(F.lit(0.0))
    return metrics.select(
        total.alias("total_events_processed"),
        joins.alias("successful_joins"),
        rate.alias("join_rate_percent"),
        (rate * 2).alias("match_rate_percent"),
        (F.col("orphaned_left_events") + F.col("orphaned_right_events")).alias("orphaned_events"),
        "late_arrivals",
        "state_store_size",
        "error_count",
        F.lit(window_micros(window)).cast("bigint").alias("time_window_micros"),
    )


def interval_join_all(
    left: DataFrame, right: DataFrame, key: str, ts: str, window, salt: int = 1
) -> DataFrame:
    """Every pair with equal keys and times at most a window apart.

    Time is cut into cells one window wide and the equality runs on (key, cell),
    so a key holding most rows is spread over its cells; each left row visits
    three neighbouring cells. ``salt`` above 1 also spreads a single cell.
    Left columns get the prefix ``left_`` and right ones ``right_``.
    """
    size = window_micros(window)
    width = max(size, 1)
    l = left.select(*[F.col(c).alias(f"left_{c}") for c in left.columns])
    r = right.select(*[F.col(c).alias(f"right_{c}") for c in right.columns])
    lt, rt = _micros(l, f"left_{ts}"), _micros(r, f"right_{ts}")
    l = l.withColumn("__k", canonical_key(l, f"left_{key}")).withColumn("__lt", lt)
    r = r.withColumn("__k", canonical_key(r, f"right_{key}")).withColumn("__rt", rt)
    home = F.floor(F.col("__lt") / width)
    l = l.withColumn("__c", F.explode(F.array(home - 1, home, home + 1)))
    r = r.withColumn("__c", F.floor(F.col("__rt") / width))
    on = ["__k", "__c"]
    if salt > 1:
        r = r.withColumn("__z", F.pmod(F.xxhash64("__rt", "__k"), F.lit(salt)))
        l = l.withColumn("__z", F.explode(F.sequence(F.lit(0), F.lit(salt - 1)).cast("array<bigint>")))
        on.append("__z")
    near = F.abs(F.col("__lt") - F.col("__rt")) <= size
    return l.join(r, on).filter(near).drop(*on, "__lt", "__rt")


def interval_join_stream(
    left: DataFrame, right: DataFrame, key: str, ts: str, window, delay: str = "5 minutes"
) -> DataFrame:
    """The same join over two streams: watermarks on both sides bound the state
    (buffered rows live for the window plus ``delay``)."""
    bound = F.expr(interval(window_micros(window)))
    l = left.select(*[F.col(c).alias(f"left_{c}") for c in left.columns])
    r = right.select(*[F.col(c).alias(f"right_{c}") for c in right.columns])
    l = l.withWatermark(f"left_{ts}", delay)
    r = r.withWatermark(f"right_{ts}", delay)
    return l.join(
        r,
        (canonical_key(l, f"left_{key}") == canonical_key(r, f"right_{key}"))
        & (F.col(f"right_{ts}") >= F.col(f"left_{ts}") - bound)
        & (F.col(f"right_{ts}") <= F.col(f"left_{ts}") + bound),
    )
