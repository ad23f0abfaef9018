"""Joins of legs with observations in time order: as-of, range aggregates, rolling measures.

All three cut time into bins and work per (station, bin), so that a hub
is many tasks. What a row needs from the time before its bin is bounded by the
tolerance, and a bin is at least that long: the last observation of the bin
before, or copies of that bin's instants, go into the next one. Bins that hold
very many legs are dealt out to several tasks (see ``_dealt``), and observations
are reduced to one row per (station, instant) before they are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagframe.operators.lagjoin import (LEG_ARRIVAL, LEG_DEPARTURE, LEG_DEST, LEG_ORIGIN, OBS_AIRPORT, OBS_INSTANT)
from lagframe.operators.rename import bq, qcol
from lagframe.schemas import DEST_SUFFIX, MAX_LAG_HOURS, ORIGIN_SUFFIX

HOUR = 3600
TOLERANCE_HOURS = 12
# Legs of one (station, bin) that a task takes; a bin with more is dealt out to
# several. So at most one bin per this many legs is listed, whatever the skew.
LEGS_PER_TASK = 1_000_000
LOST_PARTS = 4096    # over which legs without an airport or an instant are spread

ENDPOINTS = {"origin": (LEG_ORIGIN, LEG_DEPARTURE, ORIGIN_SUFFIX), "dest": (LEG_DEST, LEG_ARRIVAL, DEST_SUFFIX)}


def _endpoint(side: str) -> tuple[str, str, str]:
    if side not in ENDPOINTS:
        raise ValueError(f"side must be 'origin' or 'dest', got {side!r}")
    return ENDPOINTS[side]


def _sides(side: str) -> list[str]:
    if side == "both":
        return list(ENDPOINTS)
    _endpoint(side)
    return [side]


def _hours(name: str, hours: int) -> int:
    if not isinstance(hours, int) or isinstance(hours, bool) or hours < 1:
        raise ValueError(f"{name} must be a positive int of hours, got {hours!r}")
    return hours * HOUR


def _bin(seconds: Column, width: int) -> Column:
    return F.floor(seconds / F.lit(width)).cast("long")


def _keyed_legs(legs: DataFrame, airport: str, instant: str, width: int) -> DataFrame:
    """_airport, _at (epoch seconds), _bin and the whole leg as ``_leg``."""
    at = F.unix_seconds(qcol(instant))
    return legs.select(qcol(airport).alias("_airport"), at.alias("_at"), _bin(at, width).alias("_bin"),
                       F.struct(*[qcol(c) for c in legs.columns]).alias("_leg"))


def _heavy_bins(legs: DataFrame, side: str, width: int, per_task: int) -> DataFrame | None:
    """(_h_airport, _h_bin, _parts) of the bins with more than ``per_task`` legs, or None.

    One narrow aggregation over the keys of the table as given; such bins are
    dealt to ceil(n / per_task) parts.
    """
    airport, instant, _ = _endpoint(side)
    heavy = (legs.where(qcol(airport).isNotNull() & qcol(instant).isNotNull())
             .groupBy(qcol(airport).alias("_h_airport"), _bin(F.unix_seconds(qcol(instant)), width).alias("_h_bin")).count()
             .where(F.col("count") > per_task).select("_h_airport", "_h_bin", F.ceil(F.col("count") / per_task).cast("int").alias("_parts")))
    rows = heavy.collect()      # one row per ``per_task`` legs at most
    return legs.sparkSession.createDataFrame(rows, heavy.schema) if rows else None


def _dealt(legs: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """Keyed legs with ``_part``: those of heavy bins in several, by a hash of the leg."""
    spread = F.xxhash64("_leg")
    # legs that match nothing go anywhere
    lost = F.col("_airport").isNull() | F.col("_bin").isNull()
    if heavy is None:
        return legs.withColumn("_part", F.when(lost, F.pmod(spread, F.lit(LOST_PARTS))).otherwise(0).cast("int"))
    dealt = legs.join(F.broadcast(heavy), (F.col("_airport") == F.col("_h_airport")) & (F.col("_bin") == F.col("_h_bin")), "left")
    parts = F.when(lost, LOST_PARTS).otherwise(F.coalesce("_parts", F.lit(1))).cast("long")
    return dealt.withColumn("_part", F.pmod(spread, parts).cast("int")).drop("_h_airport", "_h_bin", "_parts")


def _for_all_parts(rows: DataFrame, heavy: DataFrame | None) -> DataFrame:
    """``rows`` (with _airport, _bin) once for each part of their bin, as ``_part``."""
    if heavy is None:
        return rows.withColumn("_part", F.lit(0))
    joined = rows.join(F.broadcast(heavy), (F.col("_airport") == F.col("_h_airport")) & (F.col("_bin") == F.col("_h_bin")), "left")
    parts = F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1)
    return joined.withColumn("_part", F.explode(parts)).drop("_h_airport", "_h_bin", "_parts")


def _timed(obs: DataFrame, width: int) -> DataFrame:
    """Observations with a station and an instant: _airport, _at, _bin and their columns."""
    at = F.unix_seconds(qcol(OBS_INSTANT))
    return (obs.where(qcol(OBS_INSTANT).isNotNull() & qcol(OBS_AIRPORT).isNotNull())
            .select(qcol(OBS_AIRPORT).alias("_airport"), at.alias("_at"), _bin(at, width).alias("_bin"),
                    *[qcol(c) for c in obs.columns]))


def lag_join_asof(legs: DataFrame, obs: DataFrame, side: str = "origin", tolerance_hours: int = TOLERANCE_HOURS,
                  tie_by: str | None = None, columns: list[str] | None = None,
                  legs_per_task: int = LEGS_PER_TASK) -> DataFrame:
    """Each leg with the latest observation at or before its instant at that endpoint.

    One row per leg, with the observation's columns (all, or ``columns``) under the
    endpoint's suffix and its age in seconds (``observation_age`` + suffix); null
    where none lies within ``tolerance_hours`` or the leg has no airport or instant.
    ``side`` is ``origin``, ``dest`` or ``both``.
    Of several observations at that instant the one with the least ``tie_by`` counts
    (or the least row). Observations are reduced to one per (station, instant) and the
    last of every bin before the merge; legs are shuffled once per endpoint.
    """
    width = _hours("tolerance_hours", tolerance_hours)
    # on the table as given, before anything is joined to it
    heavy = {s: _heavy_bins(legs, s, width, legs_per_task) for s in _sides(side)}
    for s, bins in heavy.items():
        legs = _asof_side(legs, obs, s, width, tie_by, columns, bins)
    return legs


def _asof_side(legs: DataFrame, obs: DataFrame, side: str, width: int, tie_by: str | None, columns: list[str] | None,
               heavy: DataFrame | None) -> DataFrame:
    airport, instant, suffix = _endpoint(side)
    names = list(obs.columns) if columns is None else list(columns)
    payload = F.struct(*[qcol(c) for c in names]).alias("_obs")
    tie = qcol(tie_by) if tie_by else F.struct(*[qcol(c) for c in obs.columns])
    single = (_timed(obs, width).select("_airport", "_at", "_bin", payload, tie.alias("_tie"))
              .groupBy("_airport", "_at", "_bin").agg(F.min_by("_obs", "_tie").alias("_obs")))
    last = (single.groupBy("_airport", "_bin").agg(F.max(F.col("_at")).alias("_at"), F.max_by("_obs", "_at").alias("_obs"))
            .select("_airport", "_at", (F.col("_bin") + 1).alias("_bin"), "_obs"))
    keyed = _dealt(_keyed_legs(legs, airport, instant, width), heavy)
    seen = _for_all_parts(single.select("_airport", "_at", "_bin", "_obs").unionByName(last), heavy)
    events = seen.unionByName(keyed, allowMissingColumns=True)
    # at equal instants observations come first
    order = Window.partitionBy("_airport", "_bin", "_part").orderBy("_at", F.col("_leg").isNotNull()) \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = F.last(F.when(F.col("_leg").isNull(), F.struct("_at", "_obs")), ignorenulls=True).over(order)
    merged = events.withColumn("_found", found).where("_leg is not null")
    near = merged.selectExpr("_leg", "_at", f"CASE WHEN _at - _found._at <= {width} THEN _found END AS _found")
    return near.selectExpr(*[f"_leg.{bq(c)} AS {bq(c)}" for c in legs.columns],
                           *[f"_found._obs.{bq(c)} AS {bq(c + suffix)}" for c in names],
                           f"_at - _found._at AS {bq('observation_age' + suffix)}")


def _instants(obs: DataFrame, measure: str, width: int) -> DataFrame:
    """One row per (station, instant): _rows, _n and _sum of the measure, _min."""
    value = F.when(~F.isnan(qcol(measure).cast("double")), qcol(measure).cast("double"))
    return (_timed(obs, width).groupBy("_airport", "_at", "_bin")
            .agg(F.count(F.lit(1)).alias("_rows"), F.count(value).alias("_n"), F.sum(value).alias("_sum"),
                 F.min(value).alias("_min")))


def _with_next_bin(instants: DataFrame) -> DataFrame:
    """Every row in its own bin (``_copy`` 0) and in the next one (1)."""
    return instants.select("*", F.posexplode(F.array("_bin", F.col("_bin") + 1)).alias("_copy", "_of_bin")) \
        .drop("_bin").withColumnRenamed("_of_bin", "_bin")


def lag_range_stats(legs: DataFrame, obs: DataFrame, measure: str, side: str = "origin", hours: int = MAX_LAG_HOURS,
                    legs_per_task: int = LEGS_PER_TASK) -> DataFrame:
    """Legs with statistics of the observations in [instant - hours, instant] at that endpoint, or at both.

    Adds, under the endpoint's suffix, ``observations`` (their number),
    ``values`` (how many have the measure) and ``mean`` of the measure (null
    without values). One row per leg; without an airport or an instant the numbers are 0.
    Running sums over a bin and a copy of the bin before are read at both ends of
    the range, and their difference is the answer: no pair of leg and observation is listed.
    """
    span = _hours("hours", hours)
    heavy = {s: _heavy_bins(legs, s, span + HOUR, legs_per_task) for s in _sides(side)}
    for s, bins in heavy.items():
        legs = _range_side(legs, obs, measure, s, span, bins)
    return legs


def _range_side(legs: DataFrame, obs: DataFrame, measure: str, side: str, span: int, heavy: DataFrame | None) -> DataFrame:
    airport, instant, suffix = _endpoint(side)
    width = span + HOUR
    keyed = _dealt(_keyed_legs(legs, airport, instant, width), heavy)
    # both ends of a leg's range stand in the bin of its instant; the number ties them together there
    ends = (keyed.withColumn("_id", F.monotonically_increasing_id())
            .select("_airport", "_bin", "_part", "_id", F.inline(F.array(
                F.struct((F.col("_at") - span).alias("_at"), F.lit(0).alias("_turn"),
                         F.when(F.lit(False), F.col("_leg")).alias("_leg")),
                F.struct(F.col("_at"), F.lit(2).alias("_turn"), F.col("_leg"))))))
    seen = _for_all_parts(_with_next_bin(_instants(obs, measure, width)).drop("_copy", "_min"), heavy)
    # the lower end comes before the observations of its instant, the upper one behind them
    events = seen.withColumn("_turn", F.lit(1)).unionByName(ends, allowMissingColumns=True)
    group = ["_airport", "_bin", "_part"]
    order = Window.partitionBy(*group).orderBy("_at", "_turn").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ["_rows", "_n", "_sum"]
    running = events.withColumns({c: F.coalesce(F.sum(c).over(order), F.lit(0)) for c in sums}).where("_turn <> 1")
    # grouped on the window's partitioning: no further shuffle
    upper = F.col("_turn") == 2
    both = running.groupBy(*group, "_id").agg(
        F.first("_leg", ignorenulls=True).alias("_leg"),
        *[F.sum(F.when(upper, F.col(c)).otherwise(-F.col(c))).alias(c) for c in sums])
    return both.selectExpr(*[f"_leg.{bq(c)} AS {bq(c)}" for c in legs.columns],
                           f"CAST(_rows AS BIGINT) AS {bq('observations' + suffix)}",
                           f"CAST(_n AS BIGINT) AS {bq('values' + suffix)}",
                           f"CASE WHEN _n > 0 THEN _sum / _n END AS {bq('mean' + suffix)}")


def rolling_measures(obs: DataFrame, measure: str, hours: tuple[int, ...] = (3, 12)) -> DataFrame:
    """Per station and instant: rows, and minimum and mean of the measure over the last hours.

    Columns: the station, the instant, ``observations`` at it, and per span h
    ``min_<h>h`` and ``mean_<h>h`` over the observations in [instant - h, instant]
    (null without values; NaN is no value). A bin is as long as the longest
    span and takes a copy of the one before, so a station is as many groups as it has bins.
    """
    spans = {h: _hours("hours", h) for h in hours}
    if not spans:
        raise ValueError("hours must name one span at least")
    rows = _with_next_bin(_instants(obs, measure, max(spans.values())))
    out = [F.col("_airport").alias(OBS_AIRPORT), F.timestamp_seconds("_at").alias(OBS_INSTANT), F.col("_rows").alias("observations")]
    for h, span in spans.items():
        frame = Window.partitionBy("_airport", "_bin").orderBy("_at").rangeBetween(-span, Window.currentRow)
        rows = rows.withColumns({f"_min_{h}": F.min("_min").over(frame), f"_sum_{h}": F.sum("_sum").over(frame),
                                 f"_n_{h}": F.sum("_n").over(frame)})
        out += [F.col(f"_min_{h}").alias(f"min_{h}h"),
                F.when(F.col(f"_n_{h}") > 0, F.col(f"_sum_{h}") / F.col(f"_n_{h}")).alias(f"mean_{h}h")]
    return rows.where("_copy = 0").select(*out)
