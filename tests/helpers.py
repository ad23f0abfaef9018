"""Small builders of raw feeds for unit tests."""

from pyspark.sql.types import LongType, StringType, StructField, StructType

STATIONS = [("A", "100", "-5"), ("B", "200", "-8"), ("C", "300", "-6")]


def stations(spark, rows=STATIONS):
    return spark.createDataFrame(rows, "AirportID string, WBAN string, TimeZone string")


LEG_COLS = ["FL_DATE", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME", "ARR_DELAY_NEW",
            "CANCELLED", "DIVERTED", "CRS_ELAPSED_TIME"]


def legs(spark, rows):
    """rows: (event_id, FL_DATE, origin, dest, dep_time, delay, cancelled, diverted, elapsed)."""
    schema = StructType([StructField("event_id", LongType())] +
                        [StructField(c, StringType()) for c in LEG_COLS])
    return spark.createDataFrame(rows, schema)


def obs(spark, rows):
    """rows: (oid, WBAN, Date, Time, Visibility)."""
    return spark.createDataFrame(
        rows, "oid bigint, WBAN string, Date string, Time string, Visibility string")
