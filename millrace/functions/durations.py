"""Durations: ``"24h"``, ``"5m30s"``, timedelta or integer nanoseconds."""

from __future__ import annotations

import logging
import re
from datetime import timedelta

log = logging.getLogger(__name__)

# Duration units in microseconds, and the longest window allowed.
_UNIT_MICROS = {
    "ns": 0.001,
    "us": 1,
    "ms": 1_000,
    "s": 1_000_000,
    "m": 60_000_000,
    "h": 3_600_000_000,
    "d": 86_400_000_000,
}
MAX_WINDOW_MICROS = 7 * 86_400_000_000

_PART = re.compile(r"(\d+(?:\.\d+)?)(ns|us|ms|s|m|h|d)")


def micros(value: str | int | timedelta) -> int:
    """Microseconds of a duration; a bare integer is nanoseconds."""
    if isinstance(value, timedelta):
        return (value.days * 86_400 + value.seconds) * 1_000_000 + value.microseconds
    if isinstance(value, bool) or not isinstance(value, (int, str)):
        raise ValueError(f"not a duration: {value!r}")
    if isinstance(value, int):
        return value // 1_000
    text = value.strip()
    parts = _PART.findall(text)
    if not parts or "".join(n + u for n, u in parts) != text:
        raise ValueError(f"not a duration: {value!r}")
    return int(round(sum(float(n) * _UNIT_MICROS[u] for n, u in parts)))


def window_micros(value: str | int | timedelta) -> int:
    """A non-negative window, clamped to seven days on every path, with a warning."""
    size = micros(value)
    if size < 0:
        raise ValueError(f"negative window: {value!r}")
    if size > MAX_WINDOW_MICROS:
        log.warning("window %r is narrowed to seven days", value)
    return min(size, MAX_WINDOW_MICROS)


def interval(size_micros: int) -> str:
    """SQL interval literal for a count of microseconds."""
    return f"INTERVAL '{size_micros // 1_000_000}.{size_micros % 1_000_000:06d}' SECOND"
