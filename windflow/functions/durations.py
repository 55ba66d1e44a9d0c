"""Durations such as `20 seconds`."""

from __future__ import annotations

# Microseconds per unit.
_MICROS = {"microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
           "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000}


def micros(duration: str) -> int:
    """`"1 hour 30 minutes"` in microseconds."""
    parts = duration.split()
    if not parts or len(parts) % 2:
        raise ValueError(f"not a duration: {duration!r}")
    total = 0
    for amount, unit in zip(parts[::2], parts[1::2]):
        unit = unit.lower().rstrip("s")
        if unit not in _MICROS:
            raise ValueError(f"unknown unit in {duration!r}")
        total += int(amount) * _MICROS[unit]
    return total


def interval(duration: str) -> str:
    """The duration as a Spark SQL interval literal."""
    return f"INTERVAL '{micros(duration) / 1e6:.6f}' SECOND"


def hours(duration: str) -> float:
    return micros(duration) / _MICROS["hour"]
