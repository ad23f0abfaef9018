"""Lagged joins: edge rows, invariants, and equality with the textbook plan."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from lagframe.operators import clean, lagjoin
from tests import helpers


def _tables(spark, leg_rows, obs_rows, st=helpers.STATIONS):
    s = helpers.stations(spark, st)
    legs = lagjoin.map_legs(clean.prepare_legs(helpers.legs(spark, leg_rows), s))
    obs = lagjoin.map_observations(clean.prepare_observations(helpers.obs(spark, obs_rows), s))
    return legs, obs


def _canon(df):
    return sorted(tuple("NULL" if v is None else str(v) for v in r) for r in df.collect())


def test_lag_bounds_and_exact_minute(spark):
    # leg A->B departs 2024-01-02 01:05 local; observations at A 0h, 3h (previous day 22:05),
    # 11h, 12h before and one minute before departure
    legs, obs = _tables(spark, [(1, "2024-01-02", "A", "B", "105", "0", "0", "0", "60")], [
        (10, "100", "2024-01-02", "0105", "1"), (11, "100", "2024-01-01", "2205", "2"),
        (12, "100", "2024-01-01", "1405", "3"), (13, "100", "2024-01-01", "1305", "4"),
        (14, "100", "2024-01-02", "0104", "5")])
    long = lagjoin.lag_join_long(legs, obs)
    got = {r.hours_lag: r.OT_oid_ORIG for r in long.collect()}
    assert long.count() == 12
    assert got[0] == 10 and got[3] == 11 and got[11] == 12
    assert sum(v is not None for v in got.values()) == 3            # 12 h and 1 min: no match
    row3 = [r for r in long.collect() if r.hours_lag == 3][0]
    assert row3.FT_ORIGIN_DATE_TIME_LAG == dt.datetime(2024, 1, 1, 22, 5)


def test_destination_uses_local_arrival(spark):
    # A (-5) -> B (-8), dep 10:05, 90 min: local arrival 08:35; observation at B 2 h before
    legs, obs = _tables(spark, [(1, "2024-01-01", "A", "B", "1005", "0", "0", "0", "90")],
                        [(20, "200", "2024-01-01", "0635", "7")])
    got = [(r.hours_lag, r.OT_oid_DEST) for r in lagjoin.lag_join_long(legs, obs).collect()
           if r.OT_oid_DEST is not None]
    assert got == [(2, 20)]


def _random_case(spark, seed, n_legs=60, n_obs=400, dup=True):
    rnd = random.Random(seed)
    airports = ["A", "B", "C"]
    wban = {"A": "100", "B": "200", "C": "300"}
    leg_rows, obs_rows = [], []
    for i in range(n_legs):
        o, d = rnd.choice(airports), rnd.choice(airports)
        day = f"2024-01-0{rnd.randint(1, 3)}"
        hhmm = str(rnd.choice([0, 5, 100, 1159, 1200, 2355, 1330]) + rnd.choice([0, 0, 1]))
        leg_rows.append((i, day, o, d, hhmm, str(rnd.randint(0, 40)), "0", "0", str(rnd.choice([45, 60, 180, 361]))))
    for j in range(n_obs):
        a = rnd.choice(airports)
        day = f"2024-01-0{rnd.randint(1, 3)}"
        hhmm = f"{rnd.randint(0, 23):02d}{rnd.choice([0, 5, 1, 30, 59, 35]):02d}"
        oid = j if not dup or j % 3 else j - 1
        obs_rows.append((j, wban[a], day, hhmm, str(oid % 17)))
    return _tables(spark, leg_rows, obs_rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_band_join_equals_exploded_joins(spark, seed):
    legs, obs = _random_case(spark, seed)
    a = lagjoin.lag_join_long(legs, obs)
    b = lagjoin.lag_join_long_exploded(legs, obs).select(*a.columns)
    assert _canon(a) == _canon(b)
    assert a.where("OT_oid_ORIG IS NOT NULL OR OT_oid_DEST IS NOT NULL").count() > 0


def test_side_join_matches_exploded(spark):
    legs, obs = _random_case(spark, 3)
    a = lagjoin.lag_join_side(legs, obs, "dest")
    b = lagjoin.lag_join_long_exploded(legs, obs).select(*a.columns).distinct()
    assert _canon(a.distinct()) == _canon(b)


def test_long_rows_are_legs_times_lags_when_unique(spark):
    legs, obs = _random_case(spark, 4, dup=False)
    obs1 = obs.dropDuplicates(["OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP"])
    assert lagjoin.lag_join_long(legs, obs1).count() == legs.count() * 12
    assert lagjoin.lag_join_long(legs, obs1, max_lag=2).count() == legs.count() * 3


def test_wide_is_pivot_of_long_over_deduplicated(spark):
    legs, obs = _random_case(spark, 5)
    wide = lagjoin.lag_join_wide(legs, obs, columns=["OT_oid", "OT_Visibility"], dedup_by="OT_oid")
    assert wide.count() == legs.count()
    first = obs.groupBy("OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP").agg(F.min("OT_oid").alias("m"))
    dedup = obs.join(first, (obs.OT_ORIGIN_AIRPORT_ID == first.OT_ORIGIN_AIRPORT_ID)
                     & (obs.OT_WEATHER_TIMESTAMP == first.OT_WEATHER_TIMESTAMP) & (obs.OT_oid == first.m),
                     "left_semi")
    long = lagjoin.lag_join_long(legs, dedup)
    piv = long.groupBy("FT_event_id").agg(*[
        F.max(F.when(F.col("hours_lag") == h, F.col("OT_oid_ORIG"))).alias(f"OT_oid_Part_{h}")
        for h in range(12)] + [
        F.max(F.when(F.col("hours_lag") == h, F.col("OT_oid_DEST"))).alias(f"OT_oid_Dest_Part_{h}")
        for h in range(12)])
    cols = ["FT_event_id"] + [f"OT_oid_Part_{h}" for h in range(12)] + [f"OT_oid_Dest_Part_{h}" for h in range(12)]
    assert _canon(wide.select(*cols)) == _canon(piv.select(*cols))


def test_wide_schema_rule(spark):
    legs, obs = _random_case(spark, 6)
    wide = lagjoin.lag_join_wide(legs, obs)
    n_obs = len(obs.columns)
    assert len(wide.columns) == len(legs.columns) + 12 * ((n_obs - 4) + n_obs)
    assert "OT_WBAN_Part_0" not in wide.columns and "OT_WBAN_Dest_Part_0" in wide.columns


def test_layout_by_name_refuses_unknown_arguments(spark):
    legs, obs = _random_case(spark, 7, dup=False)
    with pytest.raises(TypeError):
        lagjoin.lag_join(legs, obs, "long", columns=["OT_Visibility"])
    with pytest.raises(TypeError):
        lagjoin.lag_join(legs, obs, "wide", bogus=1)
    with pytest.raises(ValueError):
        lagjoin.lag_join(legs, obs, "tall")


def test_layout_choice(spark):
    legs, obs = _random_case(spark, 8, n_legs=5, n_obs=20)
    assert lagjoin.lag_join(legs, obs, "long").count() >= 60
    with pytest.raises(ValueError):
        lagjoin.lag_join(legs, obs, "cols")


def test_repartitioning_changes_nothing(spark):
    legs, obs = _random_case(spark, 9)
    a = lagjoin.lag_join_long(legs, obs)
    b = lagjoin.lag_join_long(legs.repartition(7), obs.repartition(3, "OT_oid"))
    assert _canon(a) == _canon(b)


def test_no_nested_loop_or_cartesian(spark):
    legs, obs = _random_case(spark, 10, n_legs=5, n_obs=20)
    for df in (lagjoin.lag_join_long(legs, obs), lagjoin.lag_join_wide(legs, obs)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_heavy_instant_is_expanded_exactly(spark):
    """More observations at one (airport, instant) than an index entry holds:
    the rows hitting it are expanded by a join, with the same result."""
    n = lagjoin.MAX_LIST_PER_INSTANT + 6
    leg_rows = [(i, "2024-01-02", "A", "B", str(100 + i), "0", "0", "0", "60") for i in range(4)]
    obs_rows = [(j, "100", "2024-01-01", "2201", str(j)) for j in range(n)]          # heavy at A
    # leg 2 departs A 01:02 and arrives B (3 h west, 60 min) at 23:02 the day before
    obs_rows += [(1000 + j, "200", "2024-01-01", "2102", str(j)) for j in range(n)]  # heavy at B
    obs_rows += [(2000, "100", "2024-01-02", "0002", "5"), (2001, "200", "2024-01-01", "2302", "6")]
    legs, obs = _tables(spark, leg_rows, obs_rows)
    assert lagjoin.heavy_observations(obs).count() == 2 * n
    a = lagjoin.lag_join_long(legs, obs)
    b = lagjoin.lag_join_long_exploded(legs, obs).select(*a.columns)
    assert _canon(a) == _canon(b)
    assert a.count() == 4 * 12 + 2 * (n - 1)
    side = lagjoin.lag_join_side(legs, obs, "origin")
    assert side.count() == b.select("FT_event_id", "hours_lag", "OT_oid_ORIG").distinct().count()


def test_expanding_path_on_ordinary_data(spark):
    legs, obs = _random_case(spark, 11)
    assert not lagjoin.has_heavy_instants(obs)
    a = lagjoin.lag_join_long(legs, obs, heavy=True)
    b = lagjoin.lag_join_long(legs, obs, heavy=False)
    assert _canon(a) == _canon(b.select(*a.columns))
    c = lagjoin.lag_join_side(legs, obs, "dest", heavy=True)
    d = lagjoin.lag_join_side(legs, obs, "dest", heavy=False)
    assert _canon(c) == _canon(d.select(*c.columns))


def test_snap_to_hour(spark):
    # departure 01:05; observations at 22:51 and 00:51 the day before / same day
    legs, obs = _tables(spark, [(1, "2024-01-02", "A", "B", "105", "0", "0", "0", "60")], [
        (10, "100", "2024-01-01", "2251", "1"), (11, "100", "2024-01-02", "0051", "2")])
    exact = lagjoin.lag_join_long(legs, obs)
    assert exact.where("OT_oid_ORIG IS NOT NULL").count() == 0
    snapped = {r.hours_lag: r.OT_oid_ORIG for r in lagjoin.lag_join_long(legs, obs, snap="hour").collect()}
    assert snapped[3] == 10 and snapped[1] == 11 and sum(v is not None for v in snapped.values()) == 2
    wide = lagjoin.lag_join_wide(legs, obs, columns=["OT_oid"], snap="hour").first()
    assert wide.OT_oid_Part_3 == 10 and wide.OT_oid_Part_1 == 11 and wide.OT_oid_Part_0 is None
    with pytest.raises(ValueError):
        lagjoin.lag_join_long(legs, obs, snap="minute")


def test_wide_picks_smallest_id_at_heavy_instant(spark):
    n = lagjoin.MAX_LIST_PER_INSTANT + 6
    legs, obs = _tables(spark, [(1, "2024-01-02", "A", "B", "101", "0", "0", "0", "60")],
                        [(500 - j, "100", "2024-01-01", "2201", str(j)) for j in range(n)])
    w = lagjoin.lag_join_wide(legs, obs, columns=["OT_oid"], dedup_by="OT_oid").first()
    assert w.OT_oid_Part_3 == 500 - (n - 1)
    assert sum(getattr(w, f"OT_oid_Part_{h}") is not None for h in range(12)) == 1


def test_a_third_of_all_rows_at_one_instant(spark):
    """Legs and observations: exact, and the heavy observations pass no exchange by instant."""
    n = 120
    leg_rows = [(i, "2024-01-02", "A", "B", "100", "0", "0", "0", "60") for i in range(n)]
    leg_rows += [(n + i, "2024-01-02", "AB"[i % 2], "B", str(100 * (i % 24)), "0", "0", "0", "60") for i in range(2 * n)]
    obs_rows = [(j, "100", "2024-01-01", "2200", str(j)) for j in range(n)]
    obs_rows += [(n + j, ["100", "200"][j % 2], "2024-01-01", f"{j % 24:02d}{j % 60:02d}", str(j)) for j in range(2 * n)]
    legs, obs = _tables(spark, leg_rows, obs_rows)
    a = lagjoin.lag_join_long(legs, obs)
    b = lagjoin.lag_join_long_exploded(legs, obs).select(*a.columns)
    assert a.count() > 100 * n and _canon(a) == _canon(b)
    narrow = lagjoin.lag_join_side(legs, obs, "origin", columns=["OT_oid"])
    assert narrow.count() == lagjoin.lag_join_side(legs, obs, "origin", heavy=False).count()
    assert sum(r._n for r in lagjoin.heavy_instants(obs).collect()) == lagjoin.heavy_observations(obs).count() == n
    plan = lagjoin.heavy_observations(obs, lagjoin.heavy_instants(obs))._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
