"""Lag joins whose work grows with the legs, not with the pairs of observations."""

import re

import pytest
from pyspark.sql import functions as F

from lagframe.operators import lagjoin, quality
from lagframe.plans import queries
from lagframe.plans.report import present, presented
from tests.test_lagjoin import _canon, _random_case, _tables


def _heavy_case(spark):
    """Light and heavy instants at both ends, repeated rows, null measures, legs without match."""
    n = 2 * lagjoin.MAX_LIST_PER_INSTANT + 9
    leg_rows = [(i, "2024-01-02", "A", "B", str(100 + i % 4), str(i), "0", "0", "60") for i in range(6)]
    leg_rows.append((9, "2024-01-02", "C", "A", "100", None, "0", "0", None))
    obs_rows = [(j // 2, "100", "2024-01-01", "2201", None if j % 5 else str(j)) for j in range(n)]
    obs_rows += [(1000 + j, "200", "2024-01-01", "2102", str(j)) for j in range(n)]
    obs_rows += [(2000, "100", "2024-01-02", "0002", "5"), (2001, "200", "2024-01-01", "2302", None)]
    return _tables(spark, leg_rows, obs_rows)


@pytest.mark.parametrize("snap", [None, "hour"])
@pytest.mark.parametrize("case", [_heavy_case, lambda s: _random_case(s, 21)])
def test_folded_rows_stand_for_the_long_ones(spark, case, snap):
    legs, obs = case(spark)
    long = lagjoin.lag_join_long(legs, obs, snap=snap)
    folded = lagjoin.lag_join_long(legs, obs, snap=snap, folds=queries.PROFILE_FOLDS)
    assert folded.count() == legs.count() * 12 < long.count()
    want = long.groupBy("hours_lag").agg(
        F.count(F.lit(1)), F.count("OT_WEATHER_TIMESTAMP_ORIG"), F.count("OT_WEATHER_TIMESTAMP_DEST"),
        F.round(F.avg("OT_Visibility_ORIG"), 4), F.round(F.avg("OT_Visibility_DEST"), 4))
    assert _canon(queries.lag_match_profile(folded)) == _canon(want)


@pytest.mark.parametrize("case", [_heavy_case, lambda s: _random_case(s, 22)])
def test_profile_without_rows(spark, case):
    legs, obs = case(spark)
    show = lambda df: df.withColumn("mean", F.round("mean", 6))
    long = lagjoin.lag_join_long(legs, obs)
    assert _canon(show(quality.profile_lag_join(legs, obs))) == _canon(show(quality.profile(long)))
    empty = quality.profile_lag_join(legs.limit(0), obs)
    assert _canon(empty) == _canon(quality.profile(long.limit(0)))
    labelled = lambda df, columns: quality.profile_lag_join(quality.label_on_time(legs), obs, columns)
    a, b = quality.build_training_table(long), quality.build_training_table(long, profile_of=labelled)
    assert a.columns == b.columns and _canon(present(a)) == _canon(present(b))


def test_shown_before_rows_are_repeated(spark):
    for legs, obs in (_heavy_case(spark), _random_case(spark, 23)):
        assert _canon(lagjoin.lag_join_long(legs, obs, show=presented)) == _canon(present(lagjoin.lag_join_long_exploded(legs, obs).select(
            *lagjoin.lag_join_long(legs, obs, heavy=False).columns)))
        for side in ("origin", "dest"):
            shown = lagjoin.lag_join_side(legs, obs, side, show=presented)
            assert _canon(shown) == _canon(present(lagjoin.lag_join_side(legs, obs, side, heavy=False)))


def test_no_generated_row_is_shuffled(spark):
    """Heavy instants too: every exchange lies below the rows made of the observations."""
    legs, obs = _heavy_case(spark)
    plan = lagjoin.lag_join_long(legs, obs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan[:plan.rindex("Generate explode(_d")] and "Generate explode(_o" in plan


def test_generated_methods_are_compiled(spark):
    """The JVM interprets methods of 8000 bytes and more for ever."""
    legs, obs = _random_case(spark, 24)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = lagjoin.lag_join_long(legs, obs, heavy=False, show=presented)._jdf.queryExecution().executedPlan()
        text = spark._jvm.org.apache.spark.sql.execution.debug.__getattr__("package$").__getattr__("MODULE$").codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", text)]
    assert sizes and max(sizes) < 8000
