"""Typed leg and observation tables from the raw text feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagframe.functions.scalar import (
    parse_date, parse_instant, time_of_day, to_double, to_int, zero_pad,
)
from lagframe.operators.rename import prefix_columns, qcol
from lagframe.plans.guards import broadcast_dimension
from lagframe.schemas import (
    DATE_FORMAT, DELAY_COLUMNS, FLAG_COLUMNS, LEG_DOUBLE_COLUMNS, LEG_DROP_COLUMNS,
    LEG_INSTANT_FORMAT, LEG_INT_COLUMNS, LEG_PREFIX, MEASURE_COLUMNS,
    OBS_INSTANT_FORMAT, OBS_PREFIX,
)

WBAN_WIDTH = 5


def normalize_wban(c) -> F.Column:
    """WBAN text trimmed and zero-padded to 5 digits on both join sides,
    so a dimension that lost leading zeros still matches the feed. Longer
    ids stay as they are."""
    text = F.trim(F.col(c) if isinstance(c, str) else c)
    return F.when(F.length(text) < WBAN_WIDTH, zero_pad(text, WBAN_WIDTH)).otherwise(text)


def station_dimension(stations: DataFrame, normalize: bool = True) -> DataFrame:
    """(AirportID, WBAN, TimeZone, tz_hours), size-checked for broadcast."""
    wban = normalize_wban("WBAN") if normalize else F.col("WBAN")
    dim = stations.select(
        F.trim("AirportID").alias("AirportID"), wban.alias("WBAN"),
        F.trim("TimeZone").alias("TimeZone"), to_int(F.trim("TimeZone")).alias("tz_hours"))
    return broadcast_dimension(dim)


def type_legs(legs: DataFrame) -> DataFrame:
    """Drop unused feed columns and type the rest (ANSI-safe casts)."""
    present = set(legs.columns)
    df = legs.drop(*[c for c in LEG_DROP_COLUMNS if c in present])
    typed = {"FL_DATE": parse_date("FL_DATE", DATE_FORMAT),
             "CRS_DEP_TIME": time_of_day("CRS_DEP_TIME")}
    typed.update({c: to_double(c) for c in LEG_DOUBLE_COLUMNS if c in present})
    typed.update({c: to_int(c) for c in LEG_INT_COLUMNS if c in present})
    df = df.withColumns(typed)
    return df.withColumn("TIMESTAMP", parse_instant("FL_DATE", "CRS_DEP_TIME", LEG_INSTANT_FORMAT))


def zero_fill(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NULL and NaN delays become 0.0."""
    cols = [c for c in (columns or DELAY_COLUMNS) if c in df.columns]
    return df.na.fill(0.0, cols)


def completed(df: DataFrame) -> DataFrame:
    """Drop cancelled and diverted legs; a NULL flag drops the leg too."""
    return df.where((F.col("DIVERTED") != 1) & (F.col("CANCELLED") != 1))


def join_origin_station(legs: DataFrame, dim: DataFrame) -> DataFrame:
    """Inner join on the origin airport; adds ``_origin_tz`` (hours)."""
    origin = dim.select(F.col("AirportID").alias("_o_airport"), F.col("tz_hours").alias("_origin_tz"))
    return legs.join(origin, F.col("ORIGIN_AIRPORT_ID") == F.col("_o_airport"), "inner").drop("_o_airport")


def join_dest_station(legs: DataFrame, dim: DataFrame) -> DataFrame:
    """Inner join on the destination airport; keeps the destination's
    AirportID and WBAN and adds ``_dest_tz`` (hours)."""
    dest = dim.select(F.col("AirportID").alias("_d_airport"), "AirportID", "WBAN",
                      F.col("tz_hours").alias("_dest_tz"))
    return legs.join(dest, F.col("DEST_AIRPORT_ID") == F.col("_d_airport"), "inner").drop("_d_airport")


def prepare_legs(legs: DataFrame, stations: DataFrame, prefix: str = LEG_PREFIX,
                 normalize: bool = True) -> DataFrame:
    """Leg table: typed, zero-filled delays, completed legs only, zone delta
    from the two stations, carrier columns dropped, names prefixed.

    The completion filter is applied before the (broadcast) station joins.
    """
    dim = station_dimension(stations, normalize)
    df = completed(zero_fill(type_legs(legs)))
    keep = [c for c in df.columns if c not in ("CANCELLED", "DIVERTED")]
    df = join_dest_station(join_origin_station(df, dim), dim)
    df = df.select(*[qcol(c) for c in keep], "AirportID", "WBAN",
                   (F.col("_dest_tz") - F.col("_origin_tz")).alias("Delta_Lag"))
    return prefix_columns(df, prefix)


def cast_measures(obs: DataFrame, measures: list[str] | None = None) -> DataFrame:
    """Measures to DOUBLE; bad text (``M``, empty) becomes NULL."""
    present = set(obs.columns)
    return obs.withColumns({c: to_double(c) for c in (measures or MEASURE_COLUMNS) if c in present})


def prepare_observations(obs: DataFrame, stations: DataFrame, prefix: str = OBS_PREFIX,
                         measures: list[str] | None = None, normalize: bool = True) -> DataFrame:
    """Observation table: measures typed, flags dropped, station airport and
    zone attached (one WBAN may serve two airports), instant parsed."""
    dim = station_dimension(stations, normalize).select("WBAN", "AirportID", "TimeZone")
    df = cast_measures(obs, measures)
    df = df.drop(*[c for c in FLAG_COLUMNS if c in df.columns])
    if normalize:
        df = df.withColumn("WBAN", normalize_wban("WBAN"))
    df = df.join(dim, "WBAN", "inner").withColumnRenamed("AirportID", "ORIGIN_AIRPORT_ID")
    df = df.withColumns({"Time": zero_pad("Time", 4), "Date": parse_date("Date", DATE_FORMAT)})
    df = df.withColumn("WEATHER_TIMESTAMP", parse_instant("Date", "Time", OBS_INSTANT_FORMAT))
    return prefix_columns(df, prefix)


def leg_losses(legs: DataFrame, stations: DataFrame, normalize: bool = True) -> DataFrame:
    """One row: how many raw legs each cleaning step removes.

    n_legs, n_not_completed (cancelled, diverted or a NULL flag),
    n_unknown_origin / n_unknown_dest (completed legs whose airport is not
    in the station dimension, lost by the inner joins), n_kept. One pass:
    left joins with the broadcast station keys, then counts."""
    dim = station_dimension(stations, normalize)
    typed = type_legs(legs)
    done = (F.col("DIVERTED") != 1) & (F.col("CANCELLED") != 1)
    flagged = typed.select("ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", F.coalesce(done, F.lit(False)).alias("_done"))
    keys = dim.select("AirportID").distinct()  # an airport listed twice is known once
    o = keys.select(F.col("AirportID").alias("_o_known"))
    d = keys.select(F.col("AirportID").alias("_d_known"))
    j = (flagged.join(o, F.col("ORIGIN_AIRPORT_ID") == F.col("_o_known"), "left")
         .join(d, F.col("DEST_AIRPORT_ID") == F.col("_d_known"), "left"))
    done_c = F.col("_done")
    return j.agg(
        F.count(F.lit(1)).alias("n_legs"),
        F.count_if(~done_c).alias("n_not_completed"),
        F.count_if(done_c & F.col("_o_known").isNull()).alias("n_unknown_origin"),
        F.count_if(done_c & F.col("_d_known").isNull()).alias("n_unknown_dest"),
        F.count_if(done_c & F.col("_o_known").isNotNull() & F.col("_d_known").isNotNull()).alias("n_kept"))
