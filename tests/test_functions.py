"""Edge rows of the cleaning functions (ANSI on)."""

import datetime as dt
import math

import pytest

from lagframe.functions import scalar
from lagframe.operators import clean, lagjoin
from tests import helpers


def one(spark, expr, value, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first().r


@pytest.mark.parametrize("raw,expected", [("5", "00:05"), ("45", "00:45"), ("959", "09:59"),
                                          ("12345", "12:34"), ("1.00", "00:01"), (None, None)])
def test_time_of_day(spark, raw, expected):
    assert one(spark, scalar.time_of_day("x"), raw) == expected


def test_ansi_is_on_and_casts_are_safe(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"
    assert one(spark, scalar.to_int("x"), "1.00") == 1
    assert one(spark, scalar.to_int("x"), "NaN") is None
    assert one(spark, scalar.to_double("x"), "M") is None
    assert one(spark, scalar.to_double("x"), "") is None
    assert one(spark, scalar.to_double("x"), " 12 ") == 12.0
    assert one(spark, scalar.parse_date("x"), "20120101") is None
    assert one(spark, scalar.parse_date("x"), "2012-01-31") == dt.date(2012, 1, 31)


def test_midnight_2400_is_null_not_error(spark):
    df = spark.createDataFrame([("2024-01-01", "24:00")], "d string, t string")
    assert df.select(scalar.parse_instant("d", "t", "yyyy-MM-dd HH:mm").alias("r")).first().r is None


def test_on_time_boundary(spark):
    df = spark.createDataFrame([(15.0,), (15.01,), (None,)], "x double")
    assert [r.r for r in df.select(scalar.on_time("x").alias("r")).collect()] == [1, 0, 0]


def _prepared(spark, rows, st=helpers.STATIONS):
    return clean.prepare_legs(helpers.legs(spark, rows), helpers.stations(spark, st))


def test_prepare_legs_filters_fills_and_zones(spark):
    rows = [
        (1, "2024-01-01", "A", "B", "1005", None, "0.00", "0.00", "90"),    # westbound, NULL delay
        (2, "2024-01-01", "A", "B", "1005", "NaN", "1.00", "0.00", "90"),   # cancelled
        (3, "2024-01-01", "A", "B", "1005", "3", None, "0.00", "90"),       # NULL flag: removed
        (4, "2024-01-01", "A", "Z", "1005", "3", "0", "0", "90"),           # unknown airport
        (5, "2024-01-01", "A", "B", "2400", "NaN", "0", "0", "90"),         # 24:00 kept, NULL instant
    ]
    out = {r.FT_event_id: r for r in lagjoin.add_arrival(_prepared(spark, rows)).collect()}
    assert sorted(out) == [1, 5]
    a = out[1]
    assert a.FT_ARR_DELAY_NEW == 0.0 and a.FT_Delta_Lag == -3
    assert a.FT_TIMESTAMP == dt.datetime(2024, 1, 1, 10, 5)
    assert a.FT_DEST_DATE_TIME == dt.datetime(2024, 1, 1, 8, 35)
    assert a.FT_AirportID == "B" and a.FT_WBAN == "00200"
    assert out[5].FT_TIMESTAMP is None and out[5].FT_ARR_DELAY_NEW == 0.0


def test_leg_schema_golden_order(spark):
    df = lagjoin.map_legs(_prepared(spark, [(1, "2024-01-01", "A", "B", "5", "1", "0", "0", "60")]))
    assert df.columns == ["FT_event_id", "FT_FL_DATE", "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID",
                          "FT_CRS_DEP_TIME", "FT_ARR_DELAY_NEW", "FT_CRS_ELAPSED_TIME", "FT_TIMESTAMP",
                          "FT_AirportID", "FT_WBAN", "FT_Delta_Lag", "FT_DEST_DATE_TIME",
                          "FT_JOIN_KEY_ORIGIN", "FT_JOIN_KEY_DEST"]
    types = dict(df.dtypes)
    assert types["FT_Delta_Lag"] == "int" and types["FT_FL_DATE"] == "date"
    assert types["FT_TIMESTAMP"] == "timestamp" and types["FT_ARR_DELAY_NEW"] == "double"


def test_observations_wban_normalised_and_fan_out(spark):
    st = [("A", "3856", "-6"), ("B", "03972", "-5"), ("C", "3972", "-7")]
    o = helpers.obs(spark, [(1, "03856", "2024-01-01", "51", "M"), (2, "3972", "2024-01-01", "0051", "10")])
    out = clean.prepare_observations(o, helpers.stations(spark, st)).collect()
    by = sorted((r.OT_oid, r.OT_ORIGIN_AIRPORT_ID, r.OT_Visibility) for r in out)
    assert by == [(1, "A", None), (2, "B", 10.0), (2, "C", 10.0)]
    assert all(r.OT_WEATHER_TIMESTAMP == dt.datetime(2024, 1, 1, 0, 51) for r in out)
    assert all(r.OT_Time == "0051" for r in out)


def test_flags_dropped_and_measures_cast(spark):
    df = spark.createDataFrame([("100", "2024-01-01", "0100", "12", "x", "ok")],
                               "WBAN string, Date string, Time string, Visibility string, "
                               "VisibilityFlag string, SkyCondition string")
    out = clean.prepare_observations(df, helpers.stations(spark))
    assert "OT_VisibilityFlag" not in out.columns and dict(out.dtypes)["OT_Visibility"] == "double"
    assert dict(out.dtypes)["OT_SkyCondition"] == "string"


def test_nan_delay_zero_filled(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (3.0,)], "ARR_DELAY_NEW double")
    vals = [r[0] for r in clean.zero_fill(df).collect()]
    assert vals == [0.0, 0.0, 3.0] and not any(math.isnan(v) for v in vals)


def test_leg_losses_counts_each_step(spark):
    rows = [
        (1, "2024-01-01", "A", "B", "1005", "0", "0.00", "0.00", "90"),
        (2, "2024-01-01", "A", "B", "1005", "0", "1.00", "0.00", "90"),   # cancelled
        (3, "2024-01-01", "A", "B", "1005", "0", None, "0.00", "90"),     # NULL flag
        (4, "2024-01-01", "Z", "B", "1005", "0", "0", "0", "90"),         # unknown origin
        (5, "2024-01-01", "A", "Y", "1005", "0", "0", "0", "90"),         # unknown destination
    ]
    r = clean.leg_losses(helpers.legs(spark, rows), helpers.stations(spark)).first()
    assert (r.n_legs, r.n_not_completed, r.n_unknown_origin, r.n_unknown_dest, r.n_kept) == (5, 2, 1, 1, 1)
    kept = clean.prepare_legs(helpers.legs(spark, rows), helpers.stations(spark)).count()
    assert kept == r.n_kept
