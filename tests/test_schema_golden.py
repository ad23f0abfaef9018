"""With complete feeds the wide layout has the published shape:
15 leg columns + 12 lags x (24 origin + 28 destination) = 639 columns."""

from collections import Counter

from lagframe.operators import clean, lagjoin
from lagframe.schemas import LEG_FEED_SCHEMA, OBS_FEED_SCHEMA
from tests import helpers


def test_wide_golden_shape(spark):
    leg = ["2024-01-01", "1", "7", "A", "B", "1005", "3", "0.00", "0.00", "90", "", "", ""]
    obs = ["100", "2024-01-01", "0805"] + ["1"] * 18 + ["CLR", "", "AA"] + ["x"] * 20
    legs = spark.createDataFrame([leg], LEG_FEED_SCHEMA)
    observations = spark.createDataFrame([obs], OBS_FEED_SCHEMA)
    st = helpers.stations(spark)
    wide = lagjoin.lag_join_wide(lagjoin.map_legs(clean.prepare_legs(legs, st)),
                                 lagjoin.map_observations(clean.prepare_observations(observations, st)))
    assert len(wide.columns) == 639
    types = Counter(t for _, t in wide.dtypes)
    assert types == {"double": 436, "string": 163, "timestamp": 26, "date": 13, "int": 1}
    assert wide.columns[:15] == [
        "FT_FL_DATE", "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID", "FT_CRS_DEP_TIME", "FT_ARR_DELAY_NEW",
        "FT_CRS_ELAPSED_TIME", "FT_WEATHER_DELAY", "FT_NAS_DELAY", "FT_TIMESTAMP", "FT_AirportID", "FT_WBAN",
        "FT_Delta_Lag", "FT_DEST_DATE_TIME", "FT_JOIN_KEY_ORIGIN", "FT_JOIN_KEY_DEST"]
    assert wide.columns[15] == "OT_StationType_Part_0"
    assert wide.count() == 1


def test_long_training_table_golden_columns(spark):
    from lagframe.operators import quality
    leg = ["2024-01-01", "1", "7", "A", "B", "1005", "3", "0.00", "0.00", "90", "", "", ""]
    obs = ["100", "2024-01-01", "0805"] + ["1"] * 18 + ["CLR", "", "AA"] + ["x"] * 20
    st = helpers.stations(spark)
    legs = lagjoin.map_legs(clean.prepare_legs(spark.createDataFrame([leg], LEG_FEED_SCHEMA), st))
    observations = lagjoin.map_observations(
        clean.prepare_observations(spark.createDataFrame([obs], OBS_FEED_SCHEMA), st))
    table = quality.build_training_table(lagjoin.lag_join_long(legs, observations))
    assert len(table.columns) == 21 and not any(c.startswith("OT_") for c in table.columns)
    assert {"hours_lag", "FT_OnTime", "FT_ORIGIN_UNIX_TS", "FT_DEST_UNIX_TS"} <= set(table.columns)
