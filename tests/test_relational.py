"""Grouping sets, multiset difference and sessions against plain counting."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from lagframe.operators import cube, diff, sessions


def test_cube_equals_plain_counting(spark):
    """Null dimensions, null and negative ids, ids in several bitmaps, a third of rows in one group."""
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), rng.choice([1, 2, None]), rng.choice([None, -5, 0, 7, 40_000, 70_000]), rng.random() < .3)
            for _ in range(400)] + [("a", 1, i, True) for i in range(200)]
    df = spark.createDataFrame(rows, "x string, y int, id long, ok boolean").repartition(5)
    found = {(r.grouping_id, r.x, r.y): (r.n_rows, r.n_ok, r.distinct_id)
             for r in cube.grouping_sets(df, ["x", "y"], {"n_ok": F.col("ok")}, "id").collect()}
    expected = {}
    for n in range(3):
        for kept in combinations((0, 1), n):
            number = sum(1 << 1 - i for i in (0, 1) if i not in kept)
            groups = {}
            for r in rows:
                groups.setdefault((number, *(r[i] if i in kept else None for i in (0, 1))), []).append(r)
            expected |= {k: (len(g), sum(r[3] for r in g), len({r[2] for r in g} - {None})) for k, g in groups.items()}
    assert found == expected
    some = cube.grouping_sets(df, ["x", "y"], {}, "id", [("x",), ()])
    assert {r.grouping_id for r in some.collect()} == {1, 3} and "Expand" not in some._jdf.queryExecution().toString()
    none = cube.grouping_sets(df.limit(0), ["x"], {"n_ok": F.col("ok")}, "id").collect()
    assert [tuple(r) for r in none] == [(None, 1, 0, 0, 0)]
    with pytest.raises(ValueError):
        cube.grouping_sets(df, ["x"], {}, "id", [("z",)])


def test_difference_equals_counters(spark):
    rng = random.Random(2)
    value = lambda: rng.choice([None, "a", "b", ""])
    rows = [(rng.choice([None, *range(30)]), value(), value()) for _ in range(300)]
    one, two = rows[:220] + rows[:9] * 3, rows[60:] + rows[100:110]
    frames = [spark.createDataFrame(r, "k int, x string, `y z` string").repartition(3) for r in (one, two)]
    gained = Counter(two)
    gained.subtract(Counter(one))
    plain = {(*r, "added" if n > 0 else "removed", abs(n)) for r, n in gained.items() if n}
    assert set(map(tuple, diff.diff_rows(*frames).collect())) == plain
    assert diff.diff_rows(*frames).count() == len(plain)
    both = {k for k in range(30) if {"added", "removed"} <= {p[3] for p in plain if p[0] == k}}
    keyed = {(*p[:3], {"added": "changed_to", "removed": "changed_from"}[p[3]] if p[0] in both else p[3], p[4]) for p in plain}
    assert both and set(map(tuple, diff.diff_rows(*frames, key=["k"]).collect())) == keyed
    assert diff.diff_rows(frames[0], frames[0]).isEmpty()
    assert diff.diff_rows(frames[0].limit(0), frames[0]).agg(F.sum("copies")).first()[0] == len(one)
    # a null and its neighbour change places
    swapped = [spark.createDataFrame([r], "a string, b string") for r in ((None, "v"), ("v", None))]
    assert diff.diff_rows(*swapped).count() == 2
    with pytest.raises(ValueError):
        diff.diff_rows(frames[0], frames[1].drop("x"))


def test_sessions_equal_plain_gaps(spark):
    rng = random.Random(3)
    start, rows = dt.datetime(2015, 3, 1), []
    for station in ["A", "B", "H", None]:
        at = start
        for _ in range(300):
            rows.append((station, at if rng.random() > .02 else None))
            at += dt.timedelta(minutes=rng.choice([0, 10, 119, 120, 121, 500]) if station != "H" else 1)
    rows += [("G", start), ("G", start + dt.timedelta(hours=2)), ("G", start + dt.timedelta(hours=4, seconds=1))]
    obs = spark.createDataFrame(rows, "OT_ORIGIN_AIRPORT_ID string, OT_WEATHER_TIMESTAMP timestamp").repartition(4)
    expected = []
    for station in ["A", "B", "G", "H"]:
        times, last = sorted(t for s, t in rows if s == station and t), None
        for t in times:
            if last and t - last[2] <= dt.timedelta(hours=2):
                last[2:4] = t, last[3] + 1
            else:
                last = [station, t, t, 1, int((t - last[2]).total_seconds()) if last else None]
                expected.append(last)
    found = sessions.observation_sessions(obs, 2)
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(str(tuple(x)) for x in expected)
    assert sum(x[0] == "G" for x in expected) == 2
    assert sessions.observation_sessions(obs.limit(0)).count() == 0
