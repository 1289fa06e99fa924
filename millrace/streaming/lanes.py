"""Keys dealt to lanes: the engine is called once a lane and batch, not once a key.

A lane's state is an index, parts and segments. A part is one value with what is
known of its keys and when each is due; a batch reads and writes the parts that
its rows fall into. Rows that wait lie in segments, in time order; what a time
passes is read from the segments that begin before it, and what is left of those
goes into new ones. The index has the first time of each segment and the next
due time of each part, and the lane has one timer, for the earliest of all.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessorHandle

# A part holds about 300 of 10 million keys.
LANES, PARTS = 1024, 32
# Rows of a segment, and of one output frame.
SEGMENT, FRAME = 500, 10_000


def dealt(key: str, lanes: int = LANES, parts: int = PARTS) -> dict[str, Column]:
    """The ``lane`` and ``part`` of a key."""
    spread = F.pmod(F.xxhash64(key), F.lit(lanes * parts))
    return {"lane": (spread % lanes).cast("int"), "part": F.floor(spread / lanes).cast("int")}


class LaneStore:
    """The state variables of one partition's lanes."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.handle = handle
        self.index = handle.getValueState("index", "body string")
        self.parts = handle.getMapState("parts", "part int", "body string")
        self.segments = handle.getMapState("segments", "n bigint", "body string")

    def open(self) -> Lane:
        return Lane(self)


class Lane:
    """One lane during one call of the engine; ``close`` writes its index."""

    def __init__(self, store: LaneStore):
        self.store = store
        held = store.index.get()
        self.before = held[0] if held is not None else None
        known = json.loads(self.before) if self.before else {"wake": None, "next": 0, "held": [], "due": {}}
        self.wake, self.next = known["wake"], known["next"]
        self.held: list[list[int]] = known["held"]  # (first time, number) of each segment
        self.due: dict[int, int] = {int(part): ms for part, ms in known["due"].items()}

    def hold(self, rows: list[list]) -> None:
        """Let rows wait; the first field of each is its time."""
        rows.sort(key=lambda r: r[0])
        for k in range(0, len(rows), SEGMENT):
            cut = rows[k:k + SEGMENT]
            self.store.segments.updateValue((self.next,), (json.dumps(cut),))
            self.held.append([cut[0][0], self.next])
            self.next += 1

    def release(self, limit: int) -> Iterator[list]:
        """The waiting rows before a time, in time order. No more segments are in
        memory than overlap; to be read to its end."""
        passed = sorted(s for s in self.held if s[0] < limit)
        self.held = [s for s in self.held if s[0] >= limit]
        rest, heap, n = [], [], 0
        for first, number in [*passed, [limit, None]]:
            while heap and heap[0][0] < first:
                yield heapq.heappop(heap)[2]
            if number is None:
                break
            for row in json.loads(self.store.segments.getValue((number,))[0]):
                if row[0] < limit:
                    heapq.heappush(heap, (row[0], n, row))
                    n += 1
                else:
                    rest.append(row)
            self.store.segments.removeKey((number,))
        self.hold(rest)

    def part(self, number: int) -> dict:
        return json.loads(self.store.parts.getValue((number,))[0]) if number in self.due else {}

    def keep(self, number: int, part: dict, due: int | None) -> None:
        """Write a part; ``due`` is the earliest time, in ms, that a key waits for."""
        if part:
            self.store.parts.updateValue((number,), (json.dumps(part),))
            self.due[number] = due
        elif number in self.due:
            self.store.parts.removeKey((number,))
            del self.due[number]

    def woken(self, ms: int) -> bool:
        """Whether a timer that fired is the lane's own; it is spent then."""
        if ms != self.wake:
            return False
        self.wake = None
        return True

    def close(self, first_due) -> None:
        """``first_due`` turns the time of the first waiting row into that of a timer."""
        times = list(self.due.values())
        if self.held:
            times.append(first_due(min(s[0] for s in self.held)))
        wake = min(times, default=None)
        if wake != self.wake:
            if self.wake is not None:
                self.store.handle.deleteTimer(self.wake)
            if wake is not None:
                self.store.handle.registerTimer(wake)
            self.wake = wake
        if wake is None:
            if self.before is not None:
                self.store.index.clear()
            return
        body = json.dumps({"wake": wake, "next": self.next, "held": self.held, "due": self.due})
        if body != self.before:
            self.store.index.update((body,))
