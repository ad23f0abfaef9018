"""Sessions of observations per station, and the outages between them.

A session goes on as long as the next observation comes within ``gap_hours``. Sessions
are found in time bins first, so a station is as many groups as it has bins; only the
sessions of the bins, not the observations, are then merged along the station.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lagframe.operators.asof import _hours, _timed
from lagframe.operators.lagjoin import OBS_AIRPORT

BIN_GAPS = 24      # a bin is so many gaps long


def _islands(rows: DataFrame, keys: list[str], gap: int) -> DataFrame:
    """``rows`` with _island: a number that rises where more than ``gap`` lies before a row."""
    order = Window.partitionBy(*keys).orderBy("_start")
    apart = F.col("_start") - F.lag("_end").over(order) > gap
    return rows.withColumn("_apart", F.coalesce(apart, F.lit(False)).cast("int")) \
        .withColumn("_island", F.sum("_apart").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))


def observation_sessions(obs: DataFrame, gap_hours: int = 3) -> DataFrame:
    """One row per station and session: its station, ``session_start`` and
    ``session_end`` (instants of the first and last observation), ``observations``, and
    ``outage_before`` in seconds since the session before (null for a station's first).

    An observation exactly ``gap_hours`` after the last one belongs to its session.
    Observations without a station or an instant are left out; repeated ones count each.
    """
    gap = _hours("gap_hours", gap_hours)
    # one row per instant, combined before the shuffle
    instants = (_timed(obs, gap * BIN_GAPS).groupBy("_airport", "_bin", "_at").agg(F.count(F.lit(1)).alias("_n"))
                .select("_airport", "_bin", F.col("_at").alias("_start"), F.col("_at").alias("_end"), "_n"))
    spans = [F.min("_start").alias("_start"), F.max("_end").alias("_end"), F.sum("_n").alias("_n")]
    local = _islands(instants, ["_airport", "_bin"], gap).groupBy("_airport", "_bin", "_island").agg(*spans)
    whole = _islands(local.select("_airport", "_start", "_end", "_n"), ["_airport"], gap) \
        .groupBy("_airport", "_island").agg(*spans)
    before = F.lag("_end").over(Window.partitionBy("_airport").orderBy("_start"))
    return whole.select(F.col("_airport").alias(OBS_AIRPORT), F.timestamp_seconds("_start").alias("session_start"),
                        F.timestamp_seconds("_end").alias("session_end"), F.col("_n").alias("observations"),
                        (F.col("_start") - before).alias("outage_before"))
