"""The streaming run gives the batch result."""

import os

import pytest
from pyspark.errors import StreamingQueryException

from lagframe.operators import clean, lagjoin
from lagframe.sources.csv import write_csv
from lagframe.streaming import lagged_legs_stream, start_lagged_legs
from tests import helpers
from tests.test_lagjoin import _canon


def test_stream_equals_batch(spark, tmp_dir):
    rows = [(i, "2024-01-02", "A", "B", str(100 * (i % 24) + 5), str(i), "0", "0", "90") for i in range(30)]
    legs_raw = helpers.legs(spark, rows).select(*helpers.LEG_COLS, "event_id")
    src = os.path.join(tmp_dir, "legs")
    write_csv(legs_raw, src)
    st = helpers.stations(spark)
    obs_rows = [(j, "100", "2024-01-02", f"{j % 24:02d}05", str(j)) for j in range(24)]
    obs = lagjoin.map_observations(clean.prepare_observations(helpers.obs(spark, obs_rows), st))
    stream = lagged_legs_stream(spark, src, obs, st, schema=legs_raw.schema)
    out = os.path.join(tmp_dir, "out")
    q = start_lagged_legs(stream, out)
    q.awaitTermination(120)
    got = spark.read.parquet(out)
    batch = lagjoin.lag_join_long(lagjoin.map_legs(clean.prepare_legs(legs_raw, st)), obs)
    assert got.count() == 30 * 12
    assert _canon(got.select(*batch.columns)) == _canon(batch)


def test_stream_reads_columns_by_name(spark, tmp_dir):
    """Files whose columns stand in another order than the schema; another order later fails."""
    rows = [(i, "2024-01-02", "A", "B", str(100 * (i % 24) + 5), str(i), "0", "0", "90") for i in range(10)]
    legs_raw = helpers.legs(spark, rows).select(*helpers.LEG_COLS, "event_id")
    src, out = os.path.join(tmp_dir, "legs"), os.path.join(tmp_dir, "out")
    write_csv(legs_raw.select(*reversed(legs_raw.columns)), src)
    st = helpers.stations(spark)
    obs = lagjoin.map_observations(clean.prepare_observations(helpers.obs(spark, [(0, "100", "2024-01-02", "0005", "1")]), st))
    stream = lagged_legs_stream(spark, src, obs, st, schema=legs_raw.schema)
    start_lagged_legs(stream, out).awaitTermination(120)
    batch = lagjoin.lag_join_long(lagjoin.map_legs(clean.prepare_legs(legs_raw, st)), obs)
    assert _canon(spark.read.parquet(out).select(*batch.columns)) == _canon(batch)
    legs_raw.write.mode("append").option("header", True).csv(src)
    with pytest.raises(StreamingQueryException):
        start_lagged_legs(stream, os.path.join(tmp_dir, "out2")).awaitTermination(120)
