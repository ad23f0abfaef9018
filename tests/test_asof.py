"""As-of join, range statistics, rolling measures and occupancy against plain loops."""

from __future__ import annotations

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from lagframe.operators import asof, occupancy

START = dt.datetime(2015, 3, 1)
LEGS = ("FT_id long, FT_ORIGIN_AIRPORT_ID string, FT_DEST_AIRPORT_ID string, FT_TIMESTAMP timestamp, "
        "FT_DEST_DATE_TIME timestamp")
OBS = "OT_oid long, OT_ORIGIN_AIRPORT_ID string, OT_WEATHER_TIMESTAMP timestamp, OT_Visibility double"


def some_time(rng, minutes):
    return None if rng.random() < .05 else START + dt.timedelta(minutes=rng.randrange(minutes))


@pytest.fixture(scope="module")
def rows():
    """A third of legs and observations at one airport and instant; nulls, NaN, ties and repeats."""
    rng = random.Random(9)
    noon = START + dt.timedelta(hours=24)
    airport = lambda: rng.choice(["A", "A", "B", "C", None])
    legs = [(i, airport(), airport(), some_time(rng, 5000), some_time(rng, 5000)) for i in range(300)]
    legs += [(300 + i, "H", "H", noon, noon + dt.timedelta(hours=3)) for i in range(150)] + legs[:3]
    value = lambda: rng.choice([None, math.nan, rng.random() * 10])
    obs = [(i, airport(), some_time(rng, 5000), value()) for i in range(400)]
    obs += [(1000 + i, "H", noon - dt.timedelta(hours=1), value()) for i in range(150)] + obs[:2]
    obs += [(2000, "A", START + dt.timedelta(minutes=720), 1.0), (2001, "A", START + dt.timedelta(minutes=720), 2.0)]
    legs += [(900, "A", "B", START + dt.timedelta(minutes=720), START), (901, "A", "B", START + dt.timedelta(minutes=1440), START)]
    return legs, obs


@pytest.fixture(scope="module")
def frames(spark, rows):
    return spark.createDataFrame(rows[0], LEGS).repartition(3), spark.createDataFrame(rows[1], OBS).repartition(3)


@pytest.mark.parametrize("per_task", [asof.LEGS_PER_TASK, 20])
@pytest.mark.parametrize("side,airport,at", [("origin", 1, 3), ("dest", 2, 4)])
def test_asof_equals_plain_search(frames, rows, side, airport, at, per_task):
    legs, obs = frames
    suffix = "_ORIG" if side == "origin" else "_DEST"
    out = asof.lag_join_asof(legs, obs, side, tolerance_hours=6, tie_by="OT_oid", legs_per_task=per_task)
    found = sorted((tuple(r) for r in out.collect()), key=str)
    expected = []
    for leg in rows[0]:
        best = min((o for o in rows[1] if o[1] is not None and o[1] == leg[airport] and o[2] and leg[at]
                    and dt.timedelta(0) <= leg[at] - o[2] <= dt.timedelta(hours=6)),
                   key=lambda o: (leg[at] - o[2], o[0]), default=None)
        age = int((leg[at] - best[2]).total_seconds()) if best else None
        expected.append((*leg, *(best or (None,) * 4), age))
    assert list(map(str, found)) == list(map(str, sorted(expected, key=str)))
    assert out.columns[-1] == "observation_age" + suffix and f"OT_oid{suffix}" in out.columns


@pytest.mark.parametrize("per_task", [asof.LEGS_PER_TASK, 20])
@pytest.mark.parametrize("side,airport,at", [("origin", 1, 3), ("dest", 2, 4)])
def test_range_stats_equal_plain_sums(frames, rows, side, airport, at, per_task):
    legs, obs = frames
    out = asof.lag_range_stats(legs, obs, "OT_Visibility", side, hours=11, legs_per_task=per_task)
    found = sorted(((r[0], *r[5:7], None if r[7] is None else round(r[7], 6)) for r in out.collect()), key=str)
    expected = []
    for leg in rows[0]:
        near = [o[3] for o in rows[1] if o[1] is not None and o[1] == leg[airport] and o[2] and leg[at]
                and dt.timedelta(0) <= leg[at] - o[2] <= dt.timedelta(hours=11)]
        values = [v for v in near if v is not None and not math.isnan(v)]
        expected.append((leg[0], len(near), len(values), round(sum(values) / len(values), 6) if values else None))
    assert found == sorted(expected, key=str)


@pytest.mark.parametrize("per_task", [asof.LEGS_PER_TASK, 20])
def test_both_endpoints_equal_one_after_the_other(frames, per_task):
    legs, obs = frames
    key = lambda df: sorted(map(str, map(tuple, df.collect())))
    one = asof.lag_join_asof(asof.lag_join_asof(legs, obs, "origin", tie_by="OT_oid"), obs, "dest", tie_by="OT_oid")
    both = asof.lag_join_asof(legs, obs, "both", tie_by="OT_oid", legs_per_task=per_task)
    assert both.columns == one.columns and key(both) == key(one)
    stats = asof.lag_range_stats(legs, obs, "OT_Visibility", "both", legs_per_task=per_task)
    assert stats.columns[-6:] == [f"{n}{s}" for s in ("_ORIG", "_DEST") for n in ("observations", "values", "mean")]
    assert stats.count() == legs.count()


def test_rolling_measures_equal_plain_windows(frames, rows):
    found = {(r[0], r[1]): r[2:] for r in asof.rolling_measures(frames[1], "OT_Visibility", (3, 12)).collect()}
    seen = {(o[1], o[2]) for o in rows[1] if o[1] is not None and o[2]}
    assert set(found) == seen
    for (airport, at), (n, *rest) in found.items():
        here = [o for o in rows[1] if o[1] == airport and o[2]]
        assert n == sum(o[2] == at for o in here)
        for hours, low, mean in ((3, *rest[:2]), (12, *rest[2:])):
            values = [o[3] for o in here if dt.timedelta(0) <= at - o[2] <= dt.timedelta(hours=hours)
                      and o[3] is not None and not math.isnan(o[3])]
            assert low == (min(values) if values else None)
            assert (mean is None) == (not values) and (not values or abs(mean - sum(values) / len(values)) < 1e-9)


@pytest.mark.parametrize("snap", [None, "hour"])
@pytest.mark.parametrize("side", ["origin", "dest", "any", "both"])
def test_occupancy_equals_plain_search(frames, rows, side, snap):
    def cut(t):
        return t.replace(minute=0) if snap and t else t

    seen = {(o[1], cut(o[2])) for o in rows[1] if o[1] is not None and o[2]}

    def at(airport, instant):
        return bool(instant) and any((airport, cut(instant) - dt.timedelta(hours=h)) in seen for h in range(6))

    rule = {"origin": lambda o, d: o, "dest": lambda o, d: d, "any": lambda o, d: o or d, "both": lambda o, d: o and d}[side]
    expected = sorted(leg[0] for leg in rows[0] if rule(at(leg[1], leg[3]), at(leg[2], leg[4])))
    legs, obs = frames
    out = occupancy.legs_observed(legs, obs, side, max_lag=5, snap=snap)
    assert out.columns == legs.columns and sorted(r[0] for r in out.collect()) == expected
    rest = sorted(r[0] for r in occupancy.legs_unobserved(legs, obs, side, max_lag=5, snap=snap).collect())
    assert sorted(rest + expected) == sorted(leg[0] for leg in rows[0])


def test_empty_inputs_and_bad_arguments(frames):
    legs, obs = frames
    none = obs.limit(0)
    assert asof.lag_join_asof(legs, none).where(F.col("OT_oid_ORIG").isNotNull()).count() == 0
    assert asof.lag_range_stats(legs, none, "OT_Visibility").agg(F.sum("observations_ORIG")).first()[0] == 0
    assert asof.rolling_measures(none, "OT_Visibility").count() == 0
    assert occupancy.legs_unobserved(legs, none).count() == legs.count()
    assert asof.lag_join_asof(legs.limit(0), obs).count() == 0
    for bad in (lambda: asof.lag_join_asof(legs, obs, "x"), lambda: asof.lag_join_asof(legs, obs, tolerance_hours=0),
                lambda: asof.rolling_measures(obs, "OT_Visibility", ()), lambda: occupancy.legs_observed(legs, obs, "x"),
                lambda: occupancy.occupied_hours(obs, 31)):
        with pytest.raises(ValueError):
            bad()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_is_listed(frames):
    """No join of legs with observations at all: they meet in one sorted exchange."""
    legs, obs = frames
    for out in (asof.lag_join_asof(legs, obs), asof.lag_range_stats(legs, obs, "OT_Visibility")):
        plan = plan_of(out)
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "SortMergeJoin" not in plan
        assert "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan
