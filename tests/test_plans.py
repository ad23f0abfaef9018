"""Plan shape, PCA scaling, label order, the whole pipeline."""

from pyspark.ml.feature import PCA, StandardScaler, StringIndexer, VectorAssembler

from lagframe.operators import clean
from lagframe.plans.batch_job import PipelineConfig, run
from lagframe.plans.queries import Tables
from tests import helpers

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_stations_are_broadcast_and_scans_pruned(spark):
    legs = clean.prepare_legs(helpers.legs(spark, [(1, "2024-01-01", "A", "B", "5", "1", "0", "0", "60")]),
                              helpers.stations(spark))
    assert "BroadcastHashJoin" in _plan(legs)
    t = Tables(spark, SF)
    scan = [ln for ln in t.legs._jdf.queryExecution().executedPlan().treeString().split("\n") if "events" in ln]
    assert scan and all("props" not in ln for ln in scan)


def test_unscaled_pca_is_dominated_by_epoch_seconds(spark):
    rows = [(1.7e9 + i * 3600.0, float(i % 5), float(i % 3), float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "t double, a double, b double, c double")
    vec = VectorAssembler(inputCols=["t", "a", "b", "c"], outputCol="v").transform(df)
    raw = PCA(k=2, inputCol="v", outputCol="p").fit(vec).explainedVariance[0]
    scaled = StandardScaler(inputCol="v", outputCol="s", withMean=True, withStd=True).fit(vec).transform(vec)
    std = PCA(k=2, inputCol="s", outputCol="p").fit(scaled).explainedVariance[0]
    assert raw > 0.9999 and std < 0.6


def test_majority_label_gets_index_zero(spark):
    df = spark.createDataFrame([(1,)] * 8 + [(0,)] * 2, "FT_OnTime int")
    model = StringIndexer(inputCol="FT_OnTime", outputCol="l", handleInvalid="skip").fit(df)
    assert model.labels == ["1", "0"]


def test_pipeline_end_to_end(spark):
    t = Tables(spark, SF)
    res = run(t.legs_raw, t.obs_raw, t.stations,
              PipelineConfig(num_trees=3, max_depth=3, split_key="FT_event_id"))
    m = {r.metric: r.value for r in res.metrics.collect()}
    assert len(m) == 8 and 0 <= m["accuracy"] <= 1
    assert res.joined.count() == 9420
    assert "FT_OnTime" in res.table.columns and not any(c.startswith("OT_") for c in res.table.columns)


def test_job_from_csv_feeds(spark, tmp_dir):
    import os

    from lagframe.plans.batch_job import run_from_csv
    from lagframe.sources.csv import write_csv
    t = Tables(spark, SF)
    paths = {n: os.path.join(tmp_dir, n) for n in ("legs", "obs", "stations")}
    write_csv(t.legs_raw, paths["legs"])
    write_csv(t.obs_raw, paths["obs"])
    write_csv(t.stations, paths["stations"], single_file=True)
    out = os.path.join(tmp_dir, "results")
    res = run_from_csv(spark, paths["legs"], paths["obs"], paths["stations"],
                       PipelineConfig(num_trees=2, max_depth=2), out=out)
    assert res.joined.count() == 9420
    table = spark.read.parquet(out + "/table")
    assert table.columns == res.table.columns and table.exceptAll(res.table).isEmpty() and res.table.exceptAll(table).isEmpty()
    written = {r.metric: float(r.value) for r in spark.read.option("header", True).csv(out + "/metrics.csv").collect()}
    assert written == {r.metric: r.value for r in res.metrics.collect()}
    times = spark.read.option("header", True).csv(out + "/execution_times.csv")
    assert times.columns == ["Task", "Duration (seconds)"] and {r.Task for r in times.collect()} == set(res.seconds)
    assert res.metrics.count() == 8
    # default long-layout split: a leg's lag rows never straddle train and test
    leg = ["FT_FL_DATE", "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID", "FT_CRS_DEP_TIME", "FT_CRS_ELAPSED_TIME"]
    tr, te = res.trained.train.select(*leg).distinct(), res.trained.test.select(*leg).distinct()
    assert te.count() > 0 and tr.intersect(te).count() == 0


def test_observation_index_shuffles_once(spark):
    from lagframe.operators import lagjoin
    t = Tables(spark, SF)
    assert _plan(lagjoin.observation_index(t.obs_mapped)).count("Exchange hashpartitioning") == 1


def test_wide_index_is_reduced_before_its_copies(spark):
    """A partial aggregate below the first exchange, the copies above it."""
    from lagframe.operators import lagjoin
    t = Tables(spark, SF)
    plan = _plan(lagjoin.observation_index(t.obs_mapped, dedup=True, dedup_by="OT_oid"))
    assert plan.count("Exchange hashpartitioning") == 2
    below = plan.rsplit("Exchange hashpartitioning", 1)[1]
    assert "partial_min_by" in below and "Generate explode" not in below


def test_only_named_columns_are_shuffled(spark):
    from lagframe.operators import lagjoin
    t = Tables(spark, SF)
    out = lagjoin.lag_join_long(t.legs_mapped, t.obs_mapped, heavy=False, columns=["OT_Visibility"])
    assert [c for c in out.columns if c.startswith("OT_")] == ["OT_Visibility_ORIG", "OT_Visibility_DEST"]
    assert "OT_oid" not in _plan(out) and "OT_JOIN_KEY" not in _plan(out)
