"""Scalar column functions.

Spark 4 runs with ANSI mode on, where a plain ``cast`` of bad text raises.
Everything here uses the ``try_`` forms, so malformed input becomes NULL
instead of failing the job, and integer text such as ``1.00`` is read
through DOUBLE so it does not turn into NULL either.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DoubleType, FloatType, NumericType, StringType,
)

from lagframe.schemas import DATE_FORMAT, ON_TIME_THRESHOLD


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: Column | str) -> Column:
    """Text or number to DOUBLE; unparsable text becomes NULL."""
    return _c(c).try_cast("double")


def to_int(c: Column | str) -> Column:
    """Text or number to INT through DOUBLE, so ``1.00`` is 1; NaN is NULL."""
    return _c(c).try_cast("double").try_cast("int")


def zero_pad(c: Column | str, width: int = 4) -> Column:
    """Left-pad with zeros to ``width``; longer text is cut to ``width``."""
    return F.lpad(_c(c), width, "0")


def time_of_day(c: Column | str) -> Column:
    """``HHmm`` as a number of up to 4 digits to ``HH:mm`` text."""
    padded = zero_pad(to_int(c).cast("string"), 4)
    return F.concat(F.substring(padded, 1, 2), F.lit(":"), F.substring(padded, 3, 2))


def parse_date(c: Column | str, fmt: str = DATE_FORMAT) -> Column:
    """Text to DATE; text not in ``fmt`` becomes NULL."""
    return F.try_to_date(_c(c), fmt)


def parse_instant(date: Column | str, time: Column | str, fmt: str) -> Column:
    """Date and time-of-day text to TIMESTAMP (NULL when invalid, e.g. 24:00)."""
    text = F.concat(_c(date).cast("string"), F.lit(" "), _c(time))
    return F.try_to_timestamp(text, F.lit(fmt))


def epoch_seconds(c: Column | str) -> Column:
    """Seconds since the epoch of a DATE or TIMESTAMP (session zone)."""
    return F.unix_timestamp(_c(c).cast("timestamp"))


def arrival_instant(departure: Column | str, elapsed_minutes: Column | str,
                    zone_delta_hours: Column | str) -> Column:
    """Local arrival = local departure + elapsed minutes + zone delta hours.

    Minutes and hours are truncated to whole seconds as a LONG cast does.
    """
    seconds = (epoch_seconds(departure)
               + (to_double(elapsed_minutes) * 60).try_cast("long")
               + (_c(zone_delta_hours) * 3600).try_cast("long"))
    return F.timestamp_seconds(seconds)


def shift_hours(ts: Column | str, hours: Column | str | int) -> Column:
    """``ts - INTERVAL hours HOURS`` (exact instant arithmetic)."""
    h = F.lit(hours) if isinstance(hours, int) else _c(hours)
    return _c(ts) - F.make_dt_interval(hours=h)


def is_missing(c: Column | str, data_type: DataType) -> Column:
    """Missing in the profile sense: NULL, or empty text for strings."""
    col = _c(c)
    if isinstance(data_type, StringType):
        return col.isNull() | (col == F.lit(""))
    return col.isNull()


def is_missing_numeric(c: Column | str, data_type: DataType) -> Column:
    """Missing in the imputation sense: NULL, or NaN for floating columns."""
    col = _c(c)
    if isinstance(data_type, (DoubleType, FloatType)):
        return col.isNull() | F.isnan(col)
    if isinstance(data_type, StringType):
        return col.isNull() | (col == F.lit(""))
    if isinstance(data_type, NumericType):
        return col.isNull()
    return col.isNull()


def on_time(delay: Column | str, threshold: float = ON_TIME_THRESHOLD) -> Column:
    """1 when ``delay <= threshold``, else 0 (NULL delay gives 0)."""
    return F.when(_c(delay) <= F.lit(threshold), F.lit(1)).otherwise(F.lit(0))
