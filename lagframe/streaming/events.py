"""Event-time streams: windowed measures with late data, and a join of two streams.

Both take prepared tables as streams, so any source that Spark reads as one will do. State is
bounded by the watermark: a window, or a row that waits for its partner, is kept until the
watermark says that nothing more can come for it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lagframe.operators.lagjoin import OBS_AIRPORT, OBS_INSTANT, _check_lag
from lagframe.operators.asof import _endpoint, _hours
from lagframe.operators.rename import qcol
from lagframe.schemas import MAX_LAG_HOURS


def windowed_measures(obs: DataFrame, measure: str, window_hours: int = 3, late_hours: int | None = None) -> DataFrame:
    """Per station and window of event time: observations, values, mean and minimum of the measure.

    Columns: the station, ``window_start``, ``window_end``, ``observations``, ``values``, ``mean`` (14 digits), ``minimum``. NaN
    is no value. Rows without a station or an instant are left out. A stream needs
    ``late_hours``: a window is emitted once the latest instant seen is that much beyond its
    end, and observations of emitted windows are dropped (see ``late_groups``). The same call on
    a table gives all windows.
    """
    span = _hours("window_hours", window_hours)
    rows = obs.where(qcol(OBS_INSTANT).isNotNull() & qcol(OBS_AIRPORT).isNotNull())
    if obs.isStreaming:
        if late_hours is None:
            raise ValueError("a stream needs late_hours")
        rows = rows.withWatermark(OBS_INSTANT, f"{int(late_hours)} hours")
    value = F.when(~F.isnan(qcol(measure).cast("double")), qcol(measure).cast("double"))
    grouped = rows.groupBy(qcol(OBS_AIRPORT), F.window(qcol(OBS_INSTANT), f"{span} seconds").alias("_window"))
    # 14 digits: the last ones depend on the order of the sum, which a stream can't repeat
    mean = F.when(F.count(value) > 0, F.format_string("%.13e", F.avg(value)).cast("double"))
    return (grouped.agg(F.count(F.lit(1)).alias("observations"), F.count(value).alias("values"), mean.alias("mean"),
                        F.min(value).alias("minimum"))
            .select(qcol(OBS_AIRPORT), F.col("_window.start").alias("window_start"), F.col("_window.end").alias("window_end"),
                    "observations", "values", "mean", "minimum"))


def late_groups(query: StreamingQuery) -> int:
    """(station, window) groups of single batches that came after their window was emitted, so far as
    the query's progress reports reach back (``spark.sql.streaming.numRecentProgressUpdates``)."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def lagged_side_stream(legs: DataFrame, obs: DataFrame, side: str = "origin", max_lag: int = MAX_LAG_HOURS,
                       late_hours: int = 24, columns: list[str] | None = None) -> DataFrame:
    """Legs x lags joined with the observations of one endpoint, both arriving as streams.

    As ``lag_join_side``: one row per leg, lag and matching observation, and one with
    nulls where none matches, which a stream emits when the watermark passes the lagged instant.
    Either side may come ``late_hours`` late, beyond the ``max_lag`` hours that a leg's own
    lags reach back. Legs without an instant or airport match nothing and wait for nothing:
    their rows come with the next batch. ``columns`` names the observation columns.
    """
    _check_lag(max_lag)
    airport, instant, suffix = _endpoint(side)
    names = list(obs.columns) if columns is None else list(columns)
    delay = f"{int(late_hours) + max_lag} hours"
    lagged = legs.select("*", F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias("hours_lag"))
    lagged = lagged.withColumn("lag_instant", qcol(instant) - F.make_dt_interval(hours=F.col("hours_lag")))
    right = obs.where(qcol(OBS_INSTANT).isNotNull() & qcol(OBS_AIRPORT).isNotNull()) \
        .select(qcol(OBS_AIRPORT).alias("_airport"), qcol(OBS_INSTANT).alias("_at"), *[qcol(c).alias(c + suffix) for c in names])
    known = qcol(airport).isNotNull() & qcol("lag_instant").isNotNull()
    waiting, lost = lagged.where(known), lagged.where(~known)
    if legs.isStreaming:
        waiting, right = waiting.withWatermark("lag_instant", delay), right.withWatermark("_at", delay)
    # the instants are equal, so the watermark of one tells when the other can't come any more
    joined = waiting.join(right, (qcol(airport) == F.col("_airport")) & (F.col("lag_instant") == F.col("_at")), "left")
    nothing = [F.lit(None).cast(right.schema[c + suffix].dataType).alias(c + suffix) for c in names]
    return joined.drop("_airport", "_at").unionByName(lost.select("*", *nothing))
