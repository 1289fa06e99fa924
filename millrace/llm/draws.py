"""Exact draws without replacement, for populations of any size."""

from __future__ import annotations

import numpy as np


def hypergeometric(good: int, bad: int, n: int, rng: np.random.Generator) -> int:
    """How many of ``n`` items drawn from ``good + bad`` are good.

    Inverts the distribution over its whole support, but for values more than
    forty standard deviations from the mean, which double precision cannot see.
    """
    low, high = max(0, n - bad), min(n, good)
    if low == high:
        return low
    total = good + bad
    mean = n * good / total
    spread = 40 * (mean * (bad / total) * ((total - n) / max(1, total - 1))) ** 0.5 + 10
    low, high = max(low, int(mean - spread)), min(high, int(mean + spread) + 1)
    k = np.arange(low, high, dtype=np.float64)
    steps = np.log(good - k) + np.log(n - k) - np.log(k + 1) - np.log(bad - n + k + 1)
    weight = np.concatenate([[0.0], np.cumsum(steps)])
    share = np.cumsum(np.exp(weight - weight.max()))
    return low + min(int(np.searchsorted(share, rng.random() * share[-1], "right")), len(share) - 1)


def multivariate_hypergeometric(counts: list[int], n: int, rng: np.random.Generator) -> list[int]:
    """How many of each kind are among ``n`` items drawn from all."""
    left, drawn = sum(counts), []
    for count in counts:
        left -= count
        got = hypergeometric(count, left, n, rng)
        drawn.append(got)
        n -= got
    return drawn
