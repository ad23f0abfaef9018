"""Semi and anti joins of legs with the observations of their lags.

Whether a leg has any observation at its lags needs no observation row: per
(airport, phase, window) one number holds a bit for every hour that is
occupied, built by a bitwise OR that combines before the shuffle. A leg tests the
bits of its own lags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagframe.operators.lagjoin import (HOUR, LEG_ARRIVAL, LEG_DEPARTURE, LEG_DEST, LEG_ORIGIN, OBS_AIRPORT,
                                        OBS_INSTANT, _band_keys, _check_lag, _check_snap, _instant, _window_seconds)
from lagframe.operators.rename import qcol
from lagframe.schemas import MAX_LAG_HOURS

# Two windows of max_lag + 1 hours each lie in one number.
MOST_LAGS = 30


def occupied_hours(obs: DataFrame, max_lag: int = MAX_LAG_HOURS, snap: str | None = None) -> DataFrame:
    """(_airport, _phase, _window, _hours): bit max_lag + 1 + i for the i-th hour of the window, and the
    lower bits for the window before it."""
    _check_lag(max_lag)
    _check_snap(snap)
    if max_lag > MOST_LAGS:
        raise ValueError(f"max_lag may be {MOST_LAGS} at most")
    at = _instant(OBS_INSTANT, snap)
    phase, window = _band_keys(at, max_lag)
    hour = ((F.unix_seconds(at) - window) / HOUR).cast("int")
    width = _window_seconds(max_lag)
    rows = obs.where(qcol(OBS_INSTANT).isNotNull() & qcol(OBS_AIRPORT).isNotNull()).select(
        qcol(OBS_AIRPORT).alias("_airport"), phase.alias("_phase"), F.inline(F.array(
            F.struct(window.alias("_window"), (hour + max_lag + 1).alias("_bit")),
            F.struct((window + F.lit(width)).alias("_window"), hour.alias("_bit")))))
    bit = F.expr("shiftleft(1L, _bit)")
    return rows.groupBy("_airport", "_phase", "_window").agg(F.bit_or(bit).alias("_hours"))


def _flagged(legs: DataFrame, hours: DataFrame, airport: str, instant: str, flag: str, max_lag: int,
             snap: str | None) -> DataFrame:
    """``legs`` with ``flag``: whether any lag of the endpoint is occupied."""
    at = _instant(instant, snap)
    phase, window = _band_keys(at, max_lag)
    keyed = legs.withColumns({"_l_phase": phase, "_l_window": window,
                              "_l_hour": ((F.unix_seconds(at) - window) / HOUR).cast("int")})
    joined = keyed.join(hours, (qcol(airport) == F.col("_airport")) & (F.col("_l_phase") == F.col("_phase"))
                        & (F.col("_l_window") == F.col("_window")), "left")
    lags = F.expr(f"shiftleft({(1 << max_lag + 1) - 1}L, _l_hour + 1)")
    found = F.coalesce(F.col("_hours").bitwiseAND(lags) != 0, F.lit(False))
    return joined.withColumn(flag, found).drop("_airport", "_phase", "_window", "_hours", "_l_phase", "_l_window", "_l_hour")


def _with_flags(legs: DataFrame, obs: DataFrame, max_lag: int, snap: str | None) -> DataFrame:
    hours = occupied_hours(obs, max_lag, snap)
    out = _flagged(legs, hours, LEG_ORIGIN, LEG_DEPARTURE, "_at_origin", max_lag, snap)
    return _flagged(out, hours, LEG_DEST, LEG_ARRIVAL, "_at_dest", max_lag, snap)


def _either(side: str) -> Column:
    sides = {"origin": F.col("_at_origin"), "dest": F.col("_at_dest"), "any": F.col("_at_origin") | F.col("_at_dest"),
             "both": F.col("_at_origin") & F.col("_at_dest")}
    if side not in sides:
        raise ValueError(f"side must be one of {', '.join(sides)}, got {side!r}")
    return sides[side]


def legs_observed(legs: DataFrame, obs: DataFrame, side: str = "any", max_lag: int = MAX_LAG_HOURS,
                  snap: str | None = None) -> DataFrame:
    """The legs with an observation at one of their lags: at the origin, the dest, any of them or both.

    Every leg at most once, with its own columns only. A missing airport or
    instant matches nothing.
    """
    kept = _either(side)
    return _with_flags(legs, obs, max_lag, snap).where(kept).select(*[qcol(c) for c in legs.columns])


def legs_unobserved(legs: DataFrame, obs: DataFrame, side: str = "any", max_lag: int = MAX_LAG_HOURS,
                    snap: str | None = None) -> DataFrame:
    """The other legs: those that ``legs_observed`` of the same arguments leaves out."""
    kept = _either(side)
    return _with_flags(legs, obs, max_lag, snap).where(~kept).select(*[qcol(c) for c in legs.columns])
