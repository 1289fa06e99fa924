"""XXH64 of many byte ranges at once (the public xxHash specification)."""

from __future__ import annotations

import numpy as np

# Fixed values of the hash.
P1 = np.uint64(11400714785074694791)
P2 = np.uint64(14029467366897019727)
P3 = np.uint64(1609587929392839161)
P4 = np.uint64(9650029242287828579)
P5 = np.uint64(2870177450012600261)


def _rotl(x, bits):
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _round(acc, lane):
    return _rotl(acc + lane * P2, 31) * P1


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 42) -> np.ndarray:
    """One unsigned hash for each range [start, end) of the bytes."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    lanes8 = np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))
    lanes4 = np.ndarray(len(data) + 1, dtype="<u4", buffer=padded, strides=(1,))
    at, left = starts.astype(np.int64), (ends - starts).astype(np.int64)
    seed = np.uint64(seed)
    with np.errstate(over="ignore"):
        acc = np.full(len(at), seed + P5, dtype=np.uint64)
        size = left.astype(np.uint64)
        wide = np.flatnonzero(left >= 32)
        if len(wide):
            v = [np.full(len(wide), s, dtype=np.uint64) for s in (seed + P1 + P2, seed + P2, seed, seed - P1)]
            on, pos, rest = np.arange(len(wide)), at[wide].copy(), left[wide].copy()
            while len(on):
                for k in range(4):
                    v[k][on] = _round(v[k][on], lanes8[pos[on] + 8 * k])
                pos[on] += 32
                rest[on] -= 32
                on = on[rest[on] >= 32]
            total = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
            for k in range(4):
                total = (total ^ _round(np.uint64(0), v[k])) * P1 + P4
            acc[wide], at[wide], left[wide] = total, pos, rest
        acc += size
        on = np.flatnonzero(left >= 8)
        while len(on):
            acc[on] = _rotl(acc[on] ^ _round(np.uint64(0), lanes8[at[on]]), 27) * P1 + P4
            at[on] += 8
            left[on] -= 8
            on = on[left[on] >= 8]
        on = np.flatnonzero(left >= 4)
        if len(on):
            acc[on] = _rotl(acc[on] ^ (lanes4[at[on]].astype(np.uint64) * P1), 23) * P2 + P3
            at[on] += 4
            left[on] -= 4
        on = np.flatnonzero(left >= 1)
        while len(on):
            acc[on] = _rotl(acc[on] ^ (padded[at[on]].astype(np.uint64) * P5), 11) * P1
            at[on] += 1
            left[on] -= 1
            on = on[left[on] >= 1]
        acc = (acc ^ (acc >> np.uint64(33))) * P2
        acc = (acc ^ (acc >> np.uint64(29))) * P3
        return acc ^ (acc >> np.uint64(32))
