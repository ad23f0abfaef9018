"""Headline timings of the pipeline stages on the driver's tables.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default sf0.1) and prints
one JSON line. Each stage is executed to completion with the no-op sink
(all rows produced, nothing collected to Python). One untimed pass over
a 10x smaller scale factor ($BENCH_WARMUP_DIR, default sf0.01) warms the
JVM first (code generation, JIT), so the timings are steady-state; set
BENCH_WARMUP=0 to time cold.

``stages`` groups the timings like the published stage table:
Restatements (typed tables), JoinOperations + Filtering (lagged join,
profile, sparse drop, imputation) and RandomForrest (fit, score, metrics).
"""

from __future__ import annotations

import collections
import glob
import io
import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from lagframe.operators import lagjoin, learn, quality  # noqa: E402
from lagframe.operators.clean import prepare_legs, prepare_observations  # noqa: E402
from lagframe.plans.guards import materialize  # noqa: E402
from lagframe.session import get_session, scratch_path  # noqa: E402
from lagframe.sources.csv import read_feed, stage_to_parquet, write_csv  # noqa: E402
from lagframe.sources import fixtures  # noqa: E402


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(results: dict, name: str, fn):
    sc = _SPARK[0].sparkContext if _SPARK else None
    if sc is not None:
        sc.setJobGroup(name, name)
    t0 = time.perf_counter()
    out = fn()
    results[name] = round(time.perf_counter() - t0, 3)
    return out


_SPARK: list = []


def shuffle_mb(event_dir: str, groups: set[str]) -> dict[str, float]:
    """Shuffle bytes written per job group, from the session's event log."""
    try:
        import zstandard
    except ImportError:
        return {}
    stage_group, written = {}, collections.Counter()
    for path in glob.glob(os.path.join(event_dir, "**", "events_*"), recursive=True):
        with open(path, "rb") as fh:
            raw = zstandard.ZstdDecompressor().stream_reader(fh) if path.endswith(".zstd") else fh
            for line in io.TextIOWrapper(raw, encoding="utf-8"):
                e = json.loads(line)
                if e.get("Event") == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for sid in e["Stage IDs"]:
                        stage_group[sid] = g
                elif e.get("Event") == "SparkListenerTaskEnd":
                    w = (e.get("Task Metrics") or {}).get("Shuffle Write Metrics") or {}
                    written[stage_group.get(e["Stage ID"])] += w.get("Shuffle Bytes Written", 0)
    return {g: round(written[g] / 1e6, 2) for g in sorted(groups) if g in written}


WARMUP_DIR = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.01")


PIPELINE = ["load_feeds", "prepare_legs", "prepare_observations", "materialize_join", "training_table",
            "train_classifier", "score_and_metrics"]


def stages(spark, sf_dir: str, q: dict[str, float]) -> dict:
    stations = fixtures.fixture_stations(spark, sf_dir)
    # the feeds as CSV text (written outside the timings), then read and
    # staged once to Parquet, as run_from_csv does
    feeds = scratch_path(spark, "bench-feeds")
    write_csv(fixtures.fixture_legs_raw(spark, sf_dir), f"{feeds}/legs")
    write_csv(fixtures.fixture_observations_raw(spark, sf_dir), f"{feeds}/obs")
    legs_raw, obs_raw = timed(q, "load_feeds", lambda: (
        stage_to_parquet(read_feed(spark, f"{feeds}/legs"), f"{feeds}/legs.parquet"),
        stage_to_parquet(read_feed(spark, f"{feeds}/obs"), f"{feeds}/obs.parquet")))

    legs = lagjoin.map_legs(prepare_legs(legs_raw, stations))
    obs = lagjoin.map_observations(prepare_observations(obs_raw, stations))
    timed(q, "prepare_legs", lambda: run_noop(legs))
    timed(q, "prepare_observations", lambda: run_noop(obs))
    long = lagjoin.lag_join_long(legs, obs)
    timed(q, "lag_join_long", lambda: run_noop(long))
    timed(q, "lag_join_long_exploded_plan", lambda: run_noop(lagjoin.lag_join_long_exploded(legs, obs)))
    timed(q, "lag_join_wide", lambda: run_noop(lagjoin.lag_join_wide(legs, obs, dedup_by="OT_oid")))
    timed(q, "lag_match_profile", lambda: run_noop(long.groupBy("hours_lag").agg(
        F.count(F.lit(1)), F.count("OT_WEATHER_TIMESTAMP_ORIG"), F.count("OT_WEATHER_TIMESTAMP_DEST"))))

    staged = timed(q, "materialize_join", lambda: materialize(long, "checkpoint"))
    table = timed(q, "training_table", lambda: materialize(quality.build_training_table(staged), "checkpoint"))
    trained = timed(q, "train_classifier", lambda: learn.train_classifier(
        table, quality.LABEL, split_key="FT_event_id"))
    metrics = timed(q, "score_and_metrics", lambda: {r.metric: r.value for r in trained.metrics().collect()})

    # wide layout end to end (keyed, de-duplicated): one row per leg
    wide = lagjoin.lag_join_wide(legs, obs, dedup_by="OT_oid")
    wstaged = timed(q, "wide_materialize_join", lambda: materialize(wide, "checkpoint"))
    wtable = timed(q, "wide_training_table",
                   lambda: materialize(quality.build_training_table(wstaged), "checkpoint"))
    wtrained = timed(q, "wide_train_classifier", lambda: learn.train_classifier(
        wtable, quality.LABEL, split_key="FT_event_id"))
    timed(q, "wide_score_and_metrics", lambda: wtrained.metrics().collect())
    return metrics


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    # stage metrics come from Spark's event log, written to a fresh folder
    # (the UI and its REST interface stay off)
    event_dir = os.path.join(os.environ.get("BENCH_EVENT_DIR", "/tmp"), f"lagframe-events-{uuid.uuid4().hex}")
    os.makedirs(event_dir, exist_ok=True)
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, extra_conf={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + event_dir})
    _SPARK.append(spark)
    if os.environ.get("BENCH_WARMUP", "1") != "0" and os.path.isdir(WARMUP_DIR):
        stages(spark, WARMUP_DIR, {})
    q: dict[str, float] = {}
    metrics = stages(spark, sf_dir, q)
    spark.stop()                       # flushes the event log
    shuffles = shuffle_mb(event_dir, set(q))
    total = round(sum(q[k] for k in PIPELINE), 3)
    wide = {
        "Load data": q["load_feeds"],
        "Restatements": round(q["prepare_legs"] + q["prepare_observations"], 3),
        "JoinOperations+Filtering": round(q["wide_materialize_join"] + q["wide_training_table"], 3),
        "RandomForrest": round(q["wide_train_classifier"] + q["wide_score_and_metrics"], 3),
    }
    grouped = {
        "Load data": q["load_feeds"],
        "Restatements": round(q["prepare_legs"] + q["prepare_observations"], 3),
        "JoinOperations+Filtering": round(q["materialize_join"] + q["training_table"], 3),
        "RandomForrest": round(q["train_classifier"] + q["score_and_metrics"], 3),
    }
    print(json.dumps({"metric": "long_layout_total", "value": total, "unit": "sec", "queries": q,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "cpus": int(cpus), "stages": grouped, "stages_wide": wide,
                      "shuffle_written_mb": shuffles,
                      "wide_layout_total": round(sum(wide.values()), 3),
                      "baseline_long_layout_sec": {"Load data": 11.97, "Restatements": 1.69, "JoinOperations+Filtering": 119.90,
                                                   "RandomForrest": 701.27},
                      "baseline_wide_layout_sec": {"Load data": 10.99, "Restatements": 1.56, "JoinOperations+Filtering": 452.05,
                                                   "RandomForrest": 109.23},
                      "model_metrics": metrics}))


if __name__ == "__main__":
    main()
