"""Legs, observations and stations derived from the driver's tables.

No leg or weather feed ships with the test data, so the three inputs are
derived from ``events`` and ``nation`` by fixed arithmetic that an SQL
engine can repeat exactly. Work grows with ``events``: every event is one
leg and one observation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the derivation (shared with the SQL oracles).
N_AIRPORTS = 25          # airports are nation keys 0..24
WBAN_OFFSET = 100        # WBAN of airport k is k + 100
DEST_STRIDE = 7          # destination = (user_id * 7 + event_id) % 25
NULL_DELAY_EVERY = 11    # ARR_DELAY_NEW is NULL when event_id % 11 = 0
DIVERTED_EVERY = 50      # DIVERTED when event_id % 50 = 0
ELAPSED_BASE, ELAPSED_SPAN = 30, 300   # CRS_ELAPSED_TIME = 30 + event_id % 300
NULL_VISIBILITY_EVERY = 17             # Visibility is NULL when event_id % 17 = 0
DUP_RUN = 7              # obs_dup: 7 consecutive events share a station


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _day(ts: str = "ts"):
    return F.date_format(F.col(ts), "yyyy-MM-dd")


def _hhmm(ts: str = "ts"):
    return (F.hour(ts) * 100 + F.minute(ts)).cast("string")


def fixture_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station dimension (AirportID, WBAN, TimeZone) as raw text."""
    nation = load_table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey").cast("string").alias("AirportID"),
        (F.col("n_nationkey") + WBAN_OFFSET).cast("string").alias("WBAN"),
        (F.lit(-4) - F.col("n_regionkey")).cast("string").alias("TimeZone"),
    )


def fixture_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed leg feed, one leg per event (keeps ``event_id`` as leg id)."""
    ev = load_table(spark, sf_dir, "events")
    return ev.select(
        _day().alias("FL_DATE"),
        (F.col("user_id") % N_AIRPORTS).cast("string").alias("ORIGIN_AIRPORT_ID"),
        ((F.col("user_id") * DEST_STRIDE + F.col("event_id")) % N_AIRPORTS)
        .cast("string").alias("DEST_AIRPORT_ID"),
        _hhmm().alias("CRS_DEP_TIME"),
        F.when(F.col("event_id") % NULL_DELAY_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value")).alias("ARR_DELAY_NEW"),
        F.when(F.col("event_type") == "error", 1).otherwise(0).alias("CANCELLED"),
        F.when(F.col("event_id") % DIVERTED_EVERY == 0, 1).otherwise(0).alias("DIVERTED"),
        (F.lit(ELAPSED_BASE) + F.col("event_id") % ELAPSED_SPAN).cast("double")
        .alias("CRS_ELAPSED_TIME"),
        F.col("event_id"),
    )


def fixture_legs_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leg feed as CSV text: numbers as strings, flags as ``0.00``/``1.00``."""
    legs = fixture_legs(spark, sf_dir)
    flag = lambda c: F.when(F.col(c) == 1, "1.00").otherwise("0.00").alias(c)
    return legs.select(
        "FL_DATE", "ORIGIN_AIRPORT_ID", "DEST_AIRPORT_ID", "CRS_DEP_TIME",
        F.col("ARR_DELAY_NEW").cast("string").alias("ARR_DELAY_NEW"),
        flag("CANCELLED"), flag("DIVERTED"),
        F.col("CRS_ELAPSED_TIME").cast("string").alias("CRS_ELAPSED_TIME"),
        "event_id",
    )


def fixture_delivery(spark: SparkSession, sf_dir: str, number: int) -> DataFrame:
    """Two deliveries of the leg feed: each leaves out and repeats other legs, the second corrects some delays."""
    legs = fixture_legs_raw(spark, sf_dir)
    left_out, repeated = ((10, 50), (9, 25))[number - 1]
    legs = legs.where(F.col("event_id") % left_out != 0)
    if number == 2:
        corrected = F.when(F.col("event_id") % 40 == 1, "0.0").otherwise(F.col("ARR_DELAY_NEW"))
        legs = legs.withColumn("ARR_DELAY_NEW", corrected)
    return legs.unionByName(legs.where(F.col("event_id") % repeated == 3))


def fixture_observations(spark: SparkSession, sf_dir: str, dup: bool = False) -> DataFrame:
    """Typed observation feed, one per event; ``dup`` shares stations in runs."""
    ev = load_table(spark, sf_dir, "events")
    station = F.col("event_id") - F.col("event_id") % DUP_RUN if dup else F.col("event_id")
    return ev.select(
        (station % N_AIRPORTS + WBAN_OFFSET).cast("string").alias("WBAN"),
        _day().alias("Date"),
        _hhmm().alias("Time"),
        F.when(F.col("event_id") % NULL_VISIBILITY_EVERY == 0, F.lit(None).cast("double"))
        .otherwise(F.col("value")).alias("Visibility"),
        F.col("event_id").alias("oid"),
    )


def fixture_observations_raw(spark: SparkSession, sf_dir: str, dup: bool = False) -> DataFrame:
    """The observation feed as CSV text (measures as strings)."""
    obs = fixture_observations(spark, sf_dir, dup)
    return obs.withColumn("Visibility", F.col("Visibility").cast("string"))
