"""Raw feed schemas and the fixed values the pipeline must agree on."""

from __future__ import annotations

from pyspark.sql.types import StringType, StructField, StructType

# ---------------------------------------------------------------------------
# Fixed values. These must equal the source pipeline's for equal results:
# feed column names, the measure and flag lists, the layout drop rules and
# the default parameters. They are stated here once, in natural order.
# ---------------------------------------------------------------------------

# Leg feed, in file order; the trailing unnamed column is read as _c12.
LEG_FEED_COLUMNS = [
    "FL_DATE", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM",
    "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME", "ARR_DELAY_NEW",
    "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME", "WEATHER_DELAY", "NAS_DELAY",
    "_c12",
]
# Leg columns removed while cleaning (carrier identifiers, trailing column).
LEG_DROP_COLUMNS = ["_c12", "OP_CARRIER_AIRLINE_ID", "OP_CARRIER_FL_NUM"]
# Delay columns: NULL and NaN become 0.0.
DELAY_COLUMNS = ["ARR_DELAY_NEW", "WEATHER_DELAY", "NAS_DELAY"]
# Leg columns typed as double and as int.
LEG_DOUBLE_COLUMNS = ["ARR_DELAY_NEW", "CRS_ELAPSED_TIME", "WEATHER_DELAY", "NAS_DELAY"]
LEG_INT_COLUMNS = ["CANCELLED", "DIVERTED"]

# Observation measures typed as double.
MEASURE_COLUMNS = [
    "StationType", "Visibility", "DryBulbFarenheit", "DryBulbCelsius",
    "WetBulbFarenheit", "WetBulbCelsius", "DewPointFarenheit", "DewPointCelsius",
    "RelativeHumidity", "WindSpeed", "WindDirection", "ValueForWindCharacter",
    "StationPressure", "PressureTendency", "PressureChange", "SeaLevelPressure",
    "HourlyPrecip", "Altimeter",
]
# Observation text columns kept untouched.
OBS_TEXT_COLUMNS = ["SkyCondition", "WeatherType", "RecordType"]
# Observation quality-flag columns, dropped.
FLAG_COLUMNS = [
    "SkyConditionFlag", "VisibilityFlag", "WeatherTypeFlag", "DryBulbFarenheitFlag",
    "DryBulbCelsiusFlag", "WetBulbFarenheitFlag", "WetBulbCelsiusFlag",
    "DewPointFarenheitFlag", "DewPointCelsiusFlag", "RelativeHumidityFlag",
    "WindSpeedFlag", "WindDirectionFlag", "ValueForWindCharacterFlag",
    "StationPressureFlag", "PressureTendencyFlag", "PressureChangeFlag",
    "SeaLevelPressureFlag", "RecordTypeFlag", "HourlyPrecipFlag", "AltimeterFlag",
]
# Station dimension columns.
STATION_COLUMNS = ["AirportID", "WBAN", "TimeZone"]

# Wide layout: observation columns not repeated per origin lag
# (the destination side keeps all of them).
WIDE_ORIGIN_DROP = ["OT_WBAN", "OT_JOIN_KEY", "OT_Date", "OT_Time"]

# Formats of the feeds.
DATE_FORMAT = "yyyy-MM-dd"
LEG_INSTANT_FORMAT = "yyyy-MM-dd HH:mm"
OBS_INSTANT_FORMAT = "yyyy-MM-dd HHmm"

# Default parameters.
MAX_LAG_HOURS = 11            # lags 0..11 inclusive
ON_TIME_THRESHOLD = 15.0      # minutes, on time when delay <= threshold
MISSING_THRESHOLD = 0.8       # keep a column when missing share <= threshold
NUM_TREES = 10
MAX_DEPTH = 5
PCA_K = 4
SEED = 42
TRAIN_FRACTION = 0.8

# Prefixes and suffixes of the name-mangled intermediate schemas.
LEG_PREFIX = "FT_"
OBS_PREFIX = "OT_"
ORIGIN_SUFFIX = "_ORIG"
DEST_SUFFIX = "_DEST"
# ---------------------------------------------------------------------------


def all_strings(names: list[str]) -> StructType:
    """A raw CSV schema: every column a nullable string."""
    return StructType([StructField(n, StringType(), True) for n in names])


LEG_FEED_SCHEMA = all_strings(LEG_FEED_COLUMNS)
OBS_FEED_SCHEMA = all_strings(
    ["WBAN", "Date", "Time"] + MEASURE_COLUMNS + OBS_TEXT_COLUMNS + FLAG_COLUMNS)
STATION_SCHEMA = all_strings(STATION_COLUMNS)
