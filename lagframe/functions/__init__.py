"""Column-level building blocks (all JVM-side, ANSI-safe)."""

from lagframe.functions.scalar import (
    arrival_instant, epoch_seconds, is_missing, is_missing_numeric, on_time,
    parse_date, parse_instant, shift_hours, time_of_day, to_double, to_int,
    zero_pad,
)

__all__ = [
    "arrival_instant", "epoch_seconds", "is_missing", "is_missing_numeric",
    "on_time", "parse_date", "parse_instant", "shift_hours", "time_of_day",
    "to_double", "to_int", "zero_pad",
]
