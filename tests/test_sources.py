"""CSV feeds and sinks, samples, layout helpers, broadcast guard."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lagframe.operators import layout
from lagframe.plans.guards import broadcast_dimension, materialize
from lagframe.schemas import LEG_FEED_SCHEMA
from lagframe.sources import csv, sampling


def test_leg_feed_with_trailing_unnamed_column(spark, tmp_dir):
    path = os.path.join(tmp_dir, "legs")
    os.makedirs(path)
    header = ",".join(f.name for f in LEG_FEED_SCHEMA.fields[:-1]) + ","
    with open(os.path.join(path, "part1.csv"), "w") as fh:
        fh.write(header + "\n2024-01-01,1,2,10,20,5,1.00,0.00,0.00,60.00,,,\n")
    df = csv.read_feed(spark, path, LEG_FEED_SCHEMA)
    r = df.drop("_c12").first()
    assert r.ORIGIN_AIRPORT_ID == "10" and r.CANCELLED == "0.00" and r.WEATHER_DELAY is None


def test_header_names_without_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "st.csv")
    with open(p, "w") as fh:
        fh.write("AirportID,WBAN,TimeZone\n10685,54831,-6\n")
    df = csv.read_feed(spark, p)
    assert df.dtypes == [("AirportID", "string"), ("WBAN", "string"), ("TimeZone", "string")]


def test_metrics_sink_single_file(spark, tmp_dir):
    m = spark.createDataFrame([("accuracy", 0.5), ("f1Score", 0.4)], "metric string, value double")
    out = os.path.join(tmp_dir, "metrics.csv")
    csv.write_metrics(m, out)
    files = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(files) == 1
    assert open(files[0]).read().splitlines()[0] == "metric,value"


def test_sample_by_key_is_stable_and_sample_rows_seeded(spark):
    df = spark.range(5000).select(F.col("id"), F.date_add(F.lit("2024-01-01").cast("date"),
                                                         (F.col("id") % 60).cast("int")).alias("day"))
    a = {r.id for r in sampling.sample_by_key(df, "day", 30).collect()}
    b = {r.id for r in sampling.sample_by_key(df.repartition(9), "day", 30).collect()}
    assert a == b and 0 < len(a) < 5000
    assert sampling.sample_rows(df, 0.1).count() == sampling.sample_rows(df, 0.1).count()


def test_layout_keeps_rows(spark):
    df = spark.range(100).select(F.col("id").alias("FT_event_id"),
                                 F.timestamp_seconds(F.col("id") * 7 % 13).alias("FT_TIMESTAMP"))
    assert sorted(layout.range_partition(df, 4).collect()) == sorted(df.collect())
    ordered = [r.FT_TIMESTAMP for r in layout.order_by_time(df).collect()]
    assert ordered == sorted(ordered)


def test_broadcast_guard(spark):
    small = spark.range(10)
    big = spark.range(1000)
    plan = spark.range(100).join(broadcast_dimension(small), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert broadcast_dimension(big, max_rows=100)._jdf.queryExecution().logical().toString().find("broadcast") < 0


def test_materialize_checkpoint(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    out = materialize(df, "checkpoint")
    assert out.count() == 10
    assert materialize(df, "parquet").count() == 10


def two_orders(folder):
    os.makedirs(folder)
    for name, lines in (("a.csv", ["A,B,C,", "1,2,3,", "4,,6,"]), ("b.csv", ["C,A,B,", "3,1,2,"]), ("c d.csv", ["A,B,C,", "7,8,9,"])):
        with open(os.path.join(folder, name), "w") as fh:
            fh.write("\n".join(lines) + "\n")


def test_files_of_different_header_order(spark, tmp_dir):
    """Read right by groups of headers; never by place."""
    path = os.path.join(tmp_dir, "feed")
    two_orders(path)
    schema = StructType([StructField(n, StringType()) for n in ("B", "A", "_c3")])
    expected = sorted([("2", "1", None), (None, "4", None), ("2", "1", None), ("8", "7", None)], key=str)
    found = csv.read_feed(spark, path, schema, mixed_headers=True)
    assert found.columns == ["B", "A", "_c3"] and sorted(map(tuple, found.collect()), key=str) == expected
    assert sorted(map(tuple, csv.read_feed(spark, path, mixed_headers=True).select("A", "B", "C").collect()), key=str) == \
        sorted([("1", "2", "3"), ("4", None, "6"), ("1", "2", "3"), ("7", "8", "9")], key=str)
    with pytest.raises(Exception, match="header|read"):
        csv.read_feed(spark, path, schema).collect()
    os.remove(os.path.join(path, "b.csv"))
    assert sorted(csv.read_feed(spark, path).select("C").collect()) == [("3",), ("6",), ("9",)]


def test_a_column_that_is_named_like_an_unnamed_one_is_read(spark, tmp_dir):
    path = os.path.join(tmp_dir, "feed.csv")
    with open(path, "w") as fh:
        fh.write("A,_c1\n1,2\n")
    assert csv.read_feed(spark, path).collect() == [("1", "2")]
