"""Streams of event time against the batch operators."""

from __future__ import annotations

import datetime as dt
import math
import os
import random
from collections import Counter

import pytest

from lagframe.operators import lagjoin
from lagframe.streaming import lagged_side_stream, late_groups, windowed_measures

START = dt.datetime(2015, 3, 1)
OBS = "OT_oid long, OT_ORIGIN_AIRPORT_ID string, OT_WEATHER_TIMESTAMP timestamp, OT_Visibility double"
LEGS = "FT_id long, FT_ORIGIN_AIRPORT_ID string, FT_DEST_AIRPORT_ID string, FT_TIMESTAMP timestamp, FT_DEST_DATE_TIME timestamp"


def hour(h):
    return START + dt.timedelta(minutes=round(60 * h))


def write(spark, rows, schema, folder, name):
    """One file a batch, in the order of their names and times."""
    path = os.path.join(folder, name)
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(path)
    os.utime(next(os.path.join(path, f) for f in os.listdir(path) if f.endswith(".parquet")),
             (1e9 + int(name), 1e9 + int(name)))


def stream(spark, schema, folder):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(folder)


def run(df, out, checkpoint):
    query = (df.writeStream.format("parquet").outputMode("append").option("path", out)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination(300)
    return query


def rows_of(df):
    return Counter(str(tuple(None if isinstance(v, float) and math.isnan(v) else v for v in r)) for r in df.collect())


@pytest.mark.parametrize("restart", [False, True])
def test_windows_equal_the_batch_on_rows_in_time(spark, tmp_dir, restart):
    """Late rows are dropped and counted; a restart goes on where the first run ended."""
    rng = random.Random(1)
    batches, n = [], 0
    for base in (0, 10, 20, 30):
        batch = []
        for _ in range(60):
            batch.append((n, rng.choice(["A", "B", None]), hour(base + 10 * rng.random()) if rng.random() > .05 else None,
                          rng.choice([None, math.nan, rng.random()])))
            n += 1
        batches.append(batch)
    # after batch 3 the watermark stands at its latest instant less 5 hours
    batches.append([(9000 + i, "A", hour(1 + i), 1.0) for i in range(4)] + [(9100, "B", hour(39), 2.0)])
    batches.append([(9999, "Z", hour(500), 0.0)])
    out, checkpoint, src = (os.path.join(tmp_dir, x) for x in ("out", "ckpt", "src"))
    late, dropped, watermark, in_time = 0, set(), None, []
    for batch in batches:
        for r in batch:
            end = r[2] and hour(3 * math.floor((r[2] - START).total_seconds() / 10800) + 3)
            if r[1] and r[2] and watermark and end <= watermark:
                dropped.add((batch[0][0], r[1], end))
            else:
                in_time.append(r)
        top = max(r[2] for b in batches[:batches.index(batch) + 1] for r in b if r[2] and r[1])
        watermark = top - dt.timedelta(hours=5)
    for i, batch in enumerate(batches):
        write(spark, batch, OBS, src, str(i))
        if restart and i == 2:
            late += late_groups(run(windowed_measures(stream(spark, OBS, src), "OT_Visibility", 3, 5), out, checkpoint))
    late += late_groups(run(windowed_measures(stream(spark, OBS, src), "OT_Visibility", 3, 5), out, checkpoint))
    batch = windowed_measures(spark.createDataFrame([r for r in in_time if r[0] != 9999], OBS), "OT_Visibility", 3)
    assert rows_of(spark.read.parquet(out).select(*batch.columns)) == rows_of(batch)
    assert late == len(dropped) > 0
    with pytest.raises(ValueError):
        windowed_measures(stream(spark, OBS, src), "OT_Visibility", 3)


def test_stream_stream_join_equals_the_batch(spark, tmp_dir):
    """Observations before and after their legs, legs without a match, missing keys."""
    rng = random.Random(2)
    legs = [(i, rng.choice(["A", "B", None]), "A", rng.choice([None, *map(hour, range(20, 40))]), hour(50)) for i in range(40)]
    obs = [(i, rng.choice(["A", "B", None]), rng.choice([None, *map(hour, range(10, 40))]), float(i)) for i in range(60)]
    legs += legs[:2]
    folders = [os.path.join(tmp_dir, x) for x in ("legs", "obs")]
    flush = hour(2000)
    for i in range(4):
        write(spark, legs[i::4], LEGS, folders[0], str(i))
        write(spark, obs[(i + 2) % 4::4], OBS, folders[1], str(i))
    for i in (4, 5):
        write(spark, [(-i, "Z", "Z", flush + dt.timedelta(days=i), flush)], LEGS, folders[0], str(i))
        write(spark, [(-i, "Y", flush + dt.timedelta(days=i), 0.0)], OBS, folders[1], str(i))
    out = os.path.join(tmp_dir, "out")
    joined = lagged_side_stream(stream(spark, LEGS, folders[0]), stream(spark, OBS, folders[1]), "origin", 5, late_hours=100)
    run(joined, out, os.path.join(tmp_dir, "ckpt"))
    static = spark.createDataFrame(legs, LEGS), spark.createDataFrame(obs, OBS)
    batch = lagjoin.lag_join_side(*static, "origin", max_lag=5)
    names = [c for c in batch.columns if not c.endswith("LAG")]
    assert rows_of(spark.read.parquet(out).where("FT_id >= 0").select(*names)) == rows_of(batch.select(*names))
    assert rows_of(lagged_side_stream(*static, "origin", 5).select(*names)) == rows_of(batch.select(*names))
