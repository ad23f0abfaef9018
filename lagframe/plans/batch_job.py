"""The whole batch job: feeds -> typed tables -> lagged join -> training
table -> classifier metrics.

With ``out`` the job writes the training table, the metrics and the seconds
of its steps below that folder. The join result is materialised once in the shared checkpoint folder
before the profiling action, so the several passes that follow (profile,
split, encoder fits, forest levels) read it instead of recomputing the
join each time.
"""

from __future__ import annotations

import time
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from lagframe.operators.clean import prepare_legs, prepare_observations
from lagframe.operators.lagjoin import lag_join, map_legs, map_observations
from lagframe.operators.learn import TrainedClassifier, train_classifier
from lagframe.operators.quality import LABEL, build_training_table
from lagframe.plans.guards import materialize
from lagframe.schemas import (
    MAX_DEPTH, MAX_LAG_HOURS, MISSING_THRESHOLD, NUM_TREES, ON_TIME_THRESHOLD, PCA_K, SEED,
)
from lagframe.session import scratch_path
from lagframe.sources.csv import read_feed, stage_to_parquet, write_csv, write_metrics
from lagframe.sources.sampling import sample_by_key


# Columns identifying a leg in the training table; in the long layout the
# default split hashes them, so the lag rows of one leg stay together.
LEG_IDENTITY = ["FT_FL_DATE", "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID", "FT_CRS_DEP_TIME",
                "FT_CRS_ELAPSED_TIME"]


@dataclass
class PipelineConfig:
    layout: str = "long"
    max_lag: int = MAX_LAG_HOURS
    on_time_threshold: float = ON_TIME_THRESHOLD
    missing_threshold: float = MISSING_THRESHOLD
    num_trees: int = NUM_TREES
    max_depth: int = MAX_DEPTH
    k: int = PCA_K
    scale: bool = True
    seed: int = SEED
    sample_pct: int | None = None          # keep legs and observations of the same days
    split_key: str | list[str] | None = None   # default for long: hash of LEG_IDENTITY
    features: list[str] | None = None
    materialize_with: str = "checkpoint"
    snap: str | None = None                # "hour": match instants truncated to the hour
    wide_kwargs: dict = field(default_factory=dict)


@dataclass
class PipelineResult:
    joined: DataFrame
    table: DataFrame
    trained: TrainedClassifier
    metrics: DataFrame
    seconds: dict[str, float] = field(default_factory=dict)


def prepare(legs_raw: DataFrame, obs_raw: DataFrame, stations: DataFrame,
            cfg: PipelineConfig) -> tuple[DataFrame, DataFrame]:
    legs = map_legs(prepare_legs(legs_raw, stations))
    obs = map_observations(prepare_observations(obs_raw, stations))
    if cfg.sample_pct is not None:
        # legs only: their lookups reach back over midnight
        legs = sample_by_key(legs, "FT_FL_DATE", cfg.sample_pct)
    return legs, obs


def write_results(result: PipelineResult, out: str) -> None:
    """``table`` (Parquet), ``metrics.csv`` and ``execution_times.csv`` below ``out``; what lies there is replaced.

    The table keeps its tasks' files; the reports are one file each.
    """
    out = out.rstrip("/")
    result.table.write.mode("overwrite").parquet(f"{out}/table")
    write_metrics(result.metrics, f"{out}/metrics.csv")
    times = result.metrics.sparkSession.createDataFrame(list(result.seconds.items()), "Task string, `Duration (seconds)` double")
    write_csv(times, f"{out}/execution_times.csv", single_file=True)


def run(legs_raw: DataFrame, obs_raw: DataFrame, stations: DataFrame,
        cfg: PipelineConfig | None = None, out: str | None = None) -> PipelineResult:
    """The job over raw feeds; ``out`` names the folder of its results, if they shall be written."""
    cfg = cfg or PipelineConfig()
    seconds, began = {}, time.monotonic()
    legs, obs = prepare(legs_raw, obs_raw, stations, cfg)
    joined = lag_join(legs, obs, cfg.layout, cfg.max_lag, snap=cfg.snap, **cfg.wide_kwargs)
    joined = materialize(joined, cfg.materialize_with)
    seconds["JoinOperations"], began = time.monotonic() - began, time.monotonic()
    table = build_training_table(joined, cfg.on_time_threshold, cfg.missing_threshold)
    seconds["Filtering"], began = time.monotonic() - began, time.monotonic()
    split_key = cfg.split_key
    if split_key is None and cfg.layout == "long":
        split_key = [c for c in LEG_IDENTITY if c in table.columns] or None
    trained = train_classifier(table, LABEL, cfg.features, cfg.num_trees, cfg.max_depth, cfg.k,
                               cfg.scale, cfg.seed, split_key)
    seconds["Training"] = time.monotonic() - began
    result = PipelineResult(joined, table, trained, trained.metrics(), seconds)
    if out:
        write_results(result, out)
    return result


def run_from_csv(spark, legs_path: str, obs_path: str, stations_path: str,
                 cfg: PipelineConfig | None = None, legs_schema=None, obs_schema=None,
                 stage: bool = True, out: str | None = None) -> PipelineResult:
    """The job from the three CSV feeds (directories or files, with header).

    With ``stage`` the two large feeds are first written once as Parquet
    under the shared checkpoint folder, so every later pass scans typed
    columns instead of re-parsing text. ``out`` as in ``run``."""
    legs = read_feed(spark, legs_path, legs_schema)
    obs = read_feed(spark, obs_path, obs_schema)
    stations = read_feed(spark, stations_path)
    if stage:
        legs = stage_to_parquet(legs, scratch_path(spark, "legs-feed"))
        obs = stage_to_parquet(obs, scratch_path(spark, "obs-feed"))
    return run(legs, obs, stations, cfg, out)
