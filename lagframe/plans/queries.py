"""Named queries over the driver's tables, one per operator.

Each callable takes (spark, sf_dir) and returns a DataFrame over the whole
derived tables. Results go through ``present`` so that another engine's
output can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagframe.operators import (asof, clean, cube, diff, lagjoin, layout, learn, occupancy, quality,
                                 sessions)
from lagframe.operators.rename import prefix_columns, suffix_columns
from lagframe.plans.guards import materialize
from lagframe.plans.report import present, presented
from lagframe.schemas import DEST_SUFFIX, ORIGIN_SUFFIX, all_strings
from lagframe.session import configure, scratch_path
from lagframe.sources import days, fixtures, sampling
from lagframe.sources.csv import read_feed, write_csv

# Parameters of the registered queries.
SPARSE_THRESHOLD_DOCS = 0.5
SAMPLE_FRACTION = 0.1
SAMPLE_PCT = 30
RULE_MAX_ELAPSED = 180.0   # fixed rule for the metrics check: on time if short
RANGE_PARTITIONS = 8
PROFILED = ["OT_WEATHER_TIMESTAMP", "OT_Visibility"]
PROFILE_FOLDS = {"instants": "count(OT_WEATHER_TIMESTAMP)", "visibilities": "count(OT_Visibility)", "visibility": "sum(OT_Visibility)"}
MEAN_DECIMALS = 9          # means of few values: no ties of rounding there


class Tables:
    """Lazily built fixture tables of one scale factor."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf = sf_dir

    def table(self, name: str) -> DataFrame:
        return fixtures.load_table(self.spark, self.sf, name)

    @cached_property
    def stations(self):
        return fixtures.fixture_stations(self.spark, self.sf)

    @cached_property
    def legs_raw(self):
        return fixtures.fixture_legs_raw(self.spark, self.sf)

    @cached_property
    def obs_raw(self):
        return fixtures.fixture_observations_raw(self.spark, self.sf)

    @cached_property
    def obs_dup_raw(self):
        return fixtures.fixture_observations_raw(self.spark, self.sf, dup=True)

    @cached_property
    def legs(self):
        return clean.prepare_legs(self.legs_raw, self.stations)

    @cached_property
    def obs(self):
        return clean.prepare_observations(self.obs_raw, self.stations)

    @cached_property
    def legs_mapped(self):
        return lagjoin.map_legs(self.legs)

    @cached_property
    def obs_mapped(self):
        return lagjoin.map_observations(self.obs)

    @cached_property
    def obs_dup_mapped(self):
        return lagjoin.map_observations(clean.prepare_observations(self.obs_dup_raw, self.stations))

    @cached_property
    def long(self):
        return lagjoin.lag_join_long(self.legs_mapped, self.obs_mapped)

    def long_profile(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """``quality.profile`` of columns of ``long``, or of ``long`` labelled."""
        legs = quality.label_on_time(self.legs_mapped) if quality.LABEL in columns else self.legs_mapped
        return quality.profile_lag_join(legs, self.obs_mapped, columns)

    @cached_property
    def docs_labels(self):
        return self.table("documents").join(self.table("labels"), "doc_id", "left")


Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn):
    QUERIES[fn.__name__[2:]] = fn   # strip the "q_" prefix
    return fn


# ---------------------------------------------------------------- cleaning
@query
def q_prepare_legs(spark, sf):
    return present(Tables(spark, sf).legs)


@query
def q_prepare_observations(spark, sf):
    return present(Tables(spark, sf).obs)


@query
def q_leg_losses(spark, sf):
    t = Tables(spark, sf)
    return clean.leg_losses(t.legs_raw, t.stations)


@query
def q_cast_legs(spark, sf):
    return present(clean.type_legs(Tables(spark, sf).legs_raw))


@query
def q_cast_measures(spark, sf):
    return present(clean.cast_measures(Tables(spark, sf).obs_raw))


@query
def q_completed_legs(spark, sf):
    return present(clean.completed(clean.type_legs(Tables(spark, sf).legs_raw)))


@query
def q_zero_fill(spark, sf):
    typed = clean.type_legs(Tables(spark, sf).legs_raw)
    return present(clean.zero_fill(typed).select("event_id", "ARR_DELAY_NEW"))


@query
def q_on_time_label(spark, sf):
    legs = quality.label_on_time(Tables(spark, sf).legs)
    return legs.select("FT_event_id", F.round("FT_ARR_DELAY_NEW", 4).alias("FT_ARR_DELAY_NEW"), "FT_OnTime")


@query
def q_prefix_columns(spark, sf):
    return prefix_columns(Tables(spark, sf).obs_raw, "OT_")


@query
def q_suffix_columns(spark, sf):
    return present(suffix_columns(Tables(spark, sf).obs, "_ORIG"))


# ------------------------------------------------------- scalar functions
@query
def q_time_of_day(spark, sf):
    from lagframe.functions.scalar import time_of_day, to_int, zero_pad
    raw = Tables(spark, sf).legs_raw
    return raw.select("event_id", "CRS_DEP_TIME",
                      zero_pad(to_int("CRS_DEP_TIME").cast("string"), 4).alias("padded"),
                      time_of_day("CRS_DEP_TIME").alias("time_of_day"))


@query
def q_parse_dates(spark, sf):
    from lagframe.functions.scalar import parse_date
    raw = Tables(spark, sf).legs_raw
    return present(raw.select("event_id", "FL_DATE", parse_date("FL_DATE").alias("flight_date")))


@query
def q_parse_instants(spark, sf):
    t = Tables(spark, sf)
    legs = clean.type_legs(t.legs_raw).select(
        F.col("event_id").alias("id"), F.lit("departure").alias("kind"), F.col("TIMESTAMP").alias("instant"))
    obs = t.obs.select(F.col("OT_oid").alias("id"), F.lit("observation").alias("kind"),
                       F.col("OT_WEATHER_TIMESTAMP").alias("instant"))
    return present(legs.unionByName(obs))


@query
def q_epoch_seconds(spark, sf):
    from lagframe.functions.scalar import epoch_seconds
    legs = Tables(spark, sf).legs
    return legs.select("FT_event_id", epoch_seconds("FT_TIMESTAMP").alias("departure_seconds"),
                       epoch_seconds("FT_FL_DATE").alias("date_seconds"))


@query
def q_arrival_instant(spark, sf):
    legs = Tables(spark, sf).legs_mapped
    return present(legs.select("FT_event_id", "FT_TIMESTAMP", "FT_CRS_ELAPSED_TIME", "FT_Delta_Lag",
                               "FT_DEST_DATE_TIME"))


@query
def q_zone_delta(spark, sf):
    legs = Tables(spark, sf).legs
    return legs.select("FT_event_id", "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID", "FT_Delta_Lag")


@query
def q_join_keys(spark, sf):
    t = Tables(spark, sf)
    legs = t.legs_mapped
    origin = legs.select(F.col("FT_event_id").alias("id"), F.lit("origin").alias("kind"),
                         F.col("FT_JOIN_KEY_ORIGIN").alias("join_key"))
    dest = legs.select(F.col("FT_event_id").alias("id"), F.lit("dest").alias("kind"),
                       F.col("FT_JOIN_KEY_DEST").alias("join_key"))
    obs = t.obs_mapped.select(F.col("OT_oid").alias("id"), F.lit("observation").alias("kind"),
                              F.col("OT_JOIN_KEY").alias("join_key"))
    return origin.unionByName(dest).unionByName(obs)


@query
def q_lag_instants(spark, sf):
    lagged = lagjoin.leg_lags(Tables(spark, sf).legs_mapped)
    return present(lagged.select("FT_event_id", "hours_lag", "FT_ORIGIN_DATE_TIME_LAG", "FT_DEST_DATE_TIME_LAG"))


# ------------------------------------------------------------------ joins
@query
def q_origin_station_join(spark, sf):
    t = Tables(spark, sf)
    dim = clean.station_dimension(t.stations)
    out = clean.join_origin_station(clean.type_legs(t.legs_raw), dim)
    return out.select("event_id", "ORIGIN_AIRPORT_ID", F.col("_origin_tz").alias("ORIGIN_TIME_ZONE"))


@query
def q_dest_station_join(spark, sf):
    t = Tables(spark, sf)
    dim = clean.station_dimension(t.stations)
    out = clean.join_dest_station(clean.type_legs(t.legs_raw), dim)
    return out.select("event_id", "DEST_AIRPORT_ID", "AirportID", "WBAN",
                      F.col("_dest_tz").alias("DEST_TIME_ZONE"))


@query
def q_obs_station_join(spark, sf):
    t = Tables(spark, sf)
    obs = t.obs
    return obs.select("OT_oid", "OT_WBAN", "OT_ORIGIN_AIRPORT_ID", "OT_TimeZone")


@query
def q_leg_lags(spark, sf):
    return present(lagjoin.leg_lags(Tables(spark, sf).legs_mapped))


@query
def q_lag_join_origin(spark, sf):
    t = Tables(spark, sf)
    return lagjoin.lag_join_side(t.legs_mapped, t.obs_mapped, "origin", show=presented)


@query
def q_lag_join_dest(spark, sf):
    t = Tables(spark, sf)
    return lagjoin.lag_join_side(t.legs_mapped, t.obs_mapped, "dest", show=presented)


@query
def q_lag_join_long(spark, sf):
    t = Tables(spark, sf)
    return lagjoin.lag_join_long(t.legs_mapped, t.obs_mapped, show=presented)


@query
def q_lag_join_long_dup(spark, sf):
    t = Tables(spark, sf)
    return lagjoin.lag_join_long(t.legs_mapped, t.obs_dup_mapped, show=presented)


@query
def q_lag_join_wide(spark, sf):
    t = Tables(spark, sf)
    return present(lagjoin.lag_join_wide(t.legs_mapped, t.obs_dup_mapped, dedup_by="OT_oid"))


def _asof(spark, sf, tolerance_hours):
    t = Tables(spark, sf)
    return asof.lag_join_asof(t.legs_mapped, t.obs_dup_mapped, "both", tolerance_hours, tie_by="OT_oid",
                              columns=["OT_WEATHER_TIMESTAMP", "OT_Visibility", "OT_oid"])


@query
def q_lag_join_asof(spark, sf):
    """Legs with the latest observation of the last 12 hours at either endpoint."""
    return present(_asof(spark, sf, 12))


@query
def q_training_table_asof(spark, sf):
    """Label, sparse drop and imputation with the latest weather of two weeks: its columns stay and are imputed."""
    return present(quality.build_training_table(materialize(_asof(spark, sf, 14 * 24), "checkpoint")))


@query
def q_lag_range_stats(spark, sf):
    """Legs with count and mean visibility over the 11 hours up to each endpoint's instant."""
    t = Tables(spark, sf)
    return present(asof.lag_range_stats(t.legs_mapped, t.obs_dup_mapped, "OT_Visibility", "both"), MEAN_DECIMALS)


@query
def q_rolling_measures(spark, sf):
    """Minimum and mean visibility of the last 3 and 12 hours at every station and instant."""
    return present(asof.rolling_measures(Tables(spark, sf).obs_dup_mapped, "OT_Visibility"), MEAN_DECIMALS)


@query
def q_legs_observed(spark, sf):
    """Legs with an observation at a lag of both endpoints, hours matched as hours."""
    t = Tables(spark, sf)
    return present(occupancy.legs_observed(t.legs_mapped, t.obs_dup_mapped, "both", snap="hour"))


@query
def q_legs_unobserved(spark, sf):
    """Legs without any observation at their lags."""
    t = Tables(spark, sf)
    return present(occupancy.legs_unobserved(t.legs_mapped, t.obs_dup_mapped))


@query
def q_on_time_cube(spark, sf):
    """Legs, legs on time and different departure days by origin, destination and weekday, in all groupings."""
    legs = quality.label_on_time(Tables(spark, sf).legs).withColumns({
        "weekday": F.weekday("FT_FL_DATE"), "day": F.unix_date("FT_FL_DATE")})
    return cube.grouping_sets(legs, ["FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID", "weekday"],
                              {"n_on_time": F.col(quality.LABEL) == 1}, "day")


@query
def q_feed_diff(spark, sf):
    """Rows added, removed and changed between two deliveries of the leg feed."""
    spark = configure(spark)
    return diff.diff_rows(fixtures.fixture_delivery(spark, sf, 1), fixtures.fixture_delivery(spark, sf, 2), ["event_id"])


@query
def q_rewritten_days(spark, sf):
    """Legs written by day, some days written again with corrected delays, and those days read back."""
    t = Tables(spark, sf)
    path = scratch_path(t.spark, "days")
    days.write_days(t.legs, path, "FT_FL_DATE")
    chosen = t.legs.where("FT_event_id % 97 = 0").select("FT_FL_DATE").distinct()
    rerun = t.legs.join(chosen, "FT_FL_DATE", "left_semi").withColumn("FT_ARR_DELAY_NEW", F.col("FT_ARR_DELAY_NEW") + 1)
    days.write_days(rerun.select(*t.legs.columns), path, "FT_FL_DATE")
    read = t.legs.where("FT_event_id % 53 = 0").select("FT_FL_DATE")
    return present(days.read_days(t.spark, path, read, "FT_FL_DATE").select(*t.legs.columns))


@query
def q_observation_sessions(spark, sf):
    """Sessions of observations at every station, and the outages before them."""
    return present(sessions.observation_sessions(Tables(spark, sf).obs_dup_mapped, gap_hours=2))


@query
def q_lag_match_profile(spark, sf):
    """Flagship: per lag, rows, matches at each end and mean visibility."""
    t = Tables(spark, sf)
    return lag_match_profile(lagjoin.lag_join_long(t.legs_mapped, t.obs_mapped, columns=PROFILED, folds=PROFILE_FOLDS))


@query
def q_lag_match_profile_snapped(spark, sf):
    """The same profile with instants matched to the hour on both sides."""
    t = Tables(spark, sf)
    return lag_match_profile(lagjoin.lag_join_long(t.legs_mapped, t.obs_mapped, snap="hour", columns=PROFILED,
                                                   folds=PROFILE_FOLDS))


def lag_match_profile(folded: DataFrame) -> DataFrame:
    """Of the folded long layout: a match counts for every row that repeats it."""
    # an origin match is repeated for the destination's, and the other way round
    by_dest, by_origin = (f"greatest({lagjoin.MATCHES}{suffix}, 1)" for suffix in (DEST_SUFFIX, ORIGIN_SUFFIX))
    return (folded.groupBy("hours_lag").agg(
        F.sum(lagjoin.fold_weight()).alias("n_rows"),
        F.expr(f"sum(coalesce(instants_ORIG, 0L) * {by_dest})").alias("origin_matches"),
        F.expr(f"sum(coalesce(instants_DEST, 0L) * {by_origin})").alias("dest_matches"),
        F.expr(f"round(try_divide(sum(visibility_ORIG * {by_dest}), sum(visibilities_ORIG * {by_dest})), 4)").alias("origin_visibility"),
        F.expr(f"round(try_divide(sum(visibility_DEST * {by_origin}), sum(visibilities_DEST * {by_origin})), 4)").alias("dest_visibility")))


# ------------------------------------------------------------ aggregation
@query
def q_row_count(spark, sf):
    t = Tables(spark, sf)
    count, folded = F.count(F.lit(1)), lagjoin.lag_join_long(t.legs_mapped, t.obs_mapped, folds={})
    parts = [("legs_raw", t.legs_raw, count), ("legs", t.legs, count), ("observations", t.obs, count),
             ("lag_join_long", folded, F.coalesce(F.sum(lagjoin.fold_weight()), F.lit(0)))]
    out = None
    for name, df, rows in parts:
        one = df.agg(rows.alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query
def q_missing_profile(spark, sf):
    return present(quality.missing_profile(Tables(spark, sf).docs_labels))


@query
def q_drop_sparse_columns(spark, sf):
    return present(quality.drop_sparse_columns(Tables(spark, sf).docs_labels, SPARSE_THRESHOLD_DOCS))


@query
def q_impute_eligible(spark, sf):
    t = Tables(spark, sf)
    # the columns of the join alone: its profile needs no rows
    long = lagjoin.lag_join_long(t.legs_mapped, t.obs_mapped, heavy=False)
    return present(quality.impute_eligible(long, profile_of=t.long_profile))


@query
def q_impute_mean(spark, sf):
    return present(quality.impute_mean(Tables(spark, sf).obs))


def _training_table(spark, sf):
    # profiled without its rows, the join is read by the output alone and needn't be written
    t = Tables(spark, sf)
    return quality.build_training_table(t.long, profile_of=t.long_profile)


@query
def q_training_table(spark, sf):
    return present(_training_table(spark, sf))


@query
def q_training_table_wide(spark, sf):
    """Label, sparse drop and imputation over the wide layout."""
    t = Tables(spark, sf)
    wide = materialize(lagjoin.lag_join_wide(t.legs_mapped, t.obs_dup_mapped, dedup_by="OT_oid"), "checkpoint")
    return present(quality.build_training_table(wide))


@query
def q_category_index(spark, sf):
    legs = Tables(spark, sf).legs
    cols = ["FT_ORIGIN_AIRPORT_ID", "FT_CRS_DEP_TIME"]
    indexed = learn.category_indexer(cols, invalid="skip").fit(legs).transform(legs)
    parts = [indexed.groupBy(F.col(c).alias("value"), F.col(c + "_indexed").cast("long").alias("idx"))
             .agg(F.count(F.lit(1)).alias("n")).select(F.lit(c).alias("column_name"), "value", "n", "idx")
             for c in cols]
    return parts[0].unionByName(parts[1])


@query
def q_classifier_metrics(spark, sf):
    legs = quality.label_on_time(Tables(spark, sf).legs)
    pred = legs.select(F.col("FT_OnTime").cast("double").alias("label"),
                       F.when(F.col("FT_CRS_ELAPSED_TIME") <= RULE_MAX_ELAPSED, 1.0).otherwise(0.0)
                       .alias("prediction"))
    return present(learn.classifier_metrics(pred, "label", "prediction"))


# ----------------------------------------------------- sources and layout
@query
def q_csv_scan(spark, sf):
    t = Tables(spark, sf)
    path = scratch_path(spark, "legs-csv")
    write_csv(t.legs_raw, path)
    schema = all_strings([f.name for f in t.legs_raw.schema.fields])
    back = read_feed(spark, path, schema)
    typed = clean.type_legs(back).withColumn("event_id", F.col("event_id").try_cast("long"))
    return present(typed)


@query
def q_csv_round_trip(spark, sf):
    legs = Tables(spark, sf).legs
    path = scratch_path(spark, "legs-prepared-csv")
    write_csv(legs, path)
    return present(spark.read.schema(legs.schema).option("header", True).csv(path))


@query
def q_sample_rows(spark, sf):
    return present(sampling.sample_rows(Tables(spark, sf).legs, SAMPLE_FRACTION))


@query
def q_sample_by_key(spark, sf):
    return present(sampling.sample_by_key(Tables(spark, sf).legs, "FT_FL_DATE", SAMPLE_PCT))


@query
def q_legs_by_time(spark, sf):
    return present(layout.order_by_time(Tables(spark, sf).legs))


@query
def q_range_partitioned(spark, sf):
    return present(layout.range_partition(Tables(spark, sf).legs, RANGE_PARTITIONS))


# --------------------------------------------------------------- learning
@query
def q_date_features(spark, sf):
    legs = Tables(spark, sf).legs
    return present(learn.date_features(legs.select("FT_event_id", "FT_FL_DATE", "FT_TIMESTAMP")))


@query
def q_split_by_key(spark, sf):
    lagged = lagjoin.leg_lags(Tables(spark, sf).legs_mapped)
    return learn.split_column(lagged, "FT_event_id").select("FT_event_id", "hours_lag", "split")


def _trained(spark, sf):
    return learn.train_classifier(_training_table(spark, sf), quality.LABEL, split_key="FT_event_id")


@query
def q_train_classifier(spark, sf):
    return present(_trained(spark, sf).metrics())


@query
def q_scored_labels(spark, sf):
    """Every row of the test split with its label, as the scoring returns it."""
    scored = _trained(spark, sf).predictions
    return scored.select("FT_event_id", "hours_lag", quality.LABEL, F.col("indexedLabel").cast("int").alias("label_index"))


@query
def q_score_rows(spark, sf):
    trained = _trained(spark, sf)
    return trained.predictions.select("FT_event_id", "hours_lag", quality.LABEL, "indexedLabel", "prediction")
