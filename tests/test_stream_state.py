"""The waiting room of a stream match: against one sorted list, and what it moves."""

import random

import pytest

from millrace.operators.match import WaitingRoom
from millrace.streaming.stateful import MatchProcessor


class Value:
    """One value of state that counts the entries read and written."""

    held, moved = None, 0

    def get(self):
        self.moved += len(self.held[1]) if self.held else 0
        return self.held

    def update(self, value):
        self.held = (value[0], list(value[1]))
        self.moved += len(value[1])

    def clear(self):
        self.held = None


class Handle:
    def registerTimer(self, at):
        pass


def processor_of(window, life=0, unique=False, small=8):
    made = MatchProcessor(window, False, life, unique, small)
    made.handle, made.room, made.lines, made.places = Handle(), Value(), Map(), None if unique else Map()
    return made


class Map(dict):
    """A map of state that counts the entries read and written."""

    moved = 0

    def _size(self, value):
        return len(value[0]) if isinstance(value[0], list) else 1

    def getValue(self, key):
        value = self.get(key)
        self.moved += self._size(value) if value is not None else 0
        return value

    def updateValue(self, key, value):
        self.moved += self._size(value)
        self[key] = (list(value[0]),) if isinstance(value[0], list) else value

    def removeKey(self, key):
        self.pop(key, None)

    def exists(self):
        return bool(self)


@pytest.mark.parametrize("window", [0, 1, 10, 300])
@pytest.mark.parametrize("unique", [True, False])
@pytest.mark.parametrize("small", [0, 8, 10_000])
def test_same_partners_as_one_list(window, unique, small):
    rng = random.Random(window)
    processor, plain = processor_of(window, 0, unique, small), WaitingRoom(window, ordered=False)
    n = 0
    for _ in range(60):
        rows, want = [], []
        for _ in range(rng.randrange(12)):
            n += 1
            event = str(n if unique else rng.randrange(40))
            rows.append((rng.randrange(2000) - 500, event, rng.randrange(2), f"body{n}"))
        for at, event, side, _ in rows:
            took = plain.arrive(side, event, at)
            if took:
                want.append((event, took[0]) if side == 0 else (took[0], event))
        assert [r[:2] for r in processor.take(None, rows)] == want
    spilled, whole = processor.room.held or (False, [])
    held = [(s, at, e) for (s, _), (line,) in processor.lines.items() for at, e, _ in line]
    held += [(s, at, e) for s, at, e, _ in whole]
    assert sorted(held) == sorted((s, at, e) for s in (0, 1) for at, e in plain.lines[s])
    assert spilled == (small < 100 and bool(held)) or not held
    if spilled and not unique:
        assert {(s, e): at for s, at, e in held} == dict((k, v[0]) for k, v in processor.places.items())


def test_a_batch_moves_only_what_it_reaches():
    moved = []
    for waiting in (1_000, 100_000):
        processor = processor_of(100)
        processor.take(None, [(n * 10, f"e{n}", 0, "x") for n in range(waiting)])
        parts = (processor.room, processor.lines, processor.places)
        for p in parts:
            p.moved = 0
        out = processor.take(None, [(5_000, "r", 1, "y"), (5_001, "new", 0, "z")])
        assert out[0][2] == 4_900
        moved.append(sum(p.moved for p in parts))
    assert moved[0] == moved[1] < 80


@pytest.mark.parametrize("small", [0, 100])
def test_lapsed_events_go_with_their_ids(small):
    processor = processor_of(10, 5, small=small)
    processor.take(None, [(at, f"e{n}", 0, "") for n, at in enumerate((0, 9, 10, 35))])
    processor.expire(26)
    spilled, whole = processor.room.held
    assert spilled == (small == 0)
    assert [e for _, _, e, _ in whole] == ["e3"] if small else list(processor.lines) == [(0, 3)]
    assert sorted(processor.places) == ([] if small else [(0, "e3")])
    processor.expire(10**9)
    assert processor.room.held is None and not processor.lines and not processor.places
    processor.expire(10**9)
