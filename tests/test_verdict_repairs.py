"""Rows that earlier code cut, dropped or counted twice."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lagframe.operators import clean, quality
from lagframe.session import checkpoint_dir
from lagframe.sources.csv import read_feed


def test_wban_is_padded_but_never_cut(spark):
    df = spark.createDataFrame([("123",), (" 12345 ",), ("123456",), (None,)], "w string")
    assert [r[0] for r in df.select(clean.normalize_wban("w")).collect()] == ["00123", "12345", "123456", None]


def test_infinite_mean_is_imputed(spark):
    df = spark.createDataFrame([(1.0,), (float("inf"),), (None,)] + [(2.0,)] * 20, "f double")
    assert quality.impute_mean(df, 0.5).where("f is null").count() == 0


def test_feed_columns_are_taken_by_name(spark, tmp_dir):
    spark.createDataFrame([("A", "2024-01-01", "z")], "ORIGIN string, FL_DATE string, extra string") \
        .write.option("header", True).csv(tmp_dir + "/feed")
    schema = StructType([StructField(n, StringType()) for n in ("FL_DATE", "ORIGIN")])
    out = read_feed(spark, tmp_dir + "/feed", schema)
    assert [tuple(r) for r in out.collect()] == [("2024-01-01", "A")] and out.columns == ["FL_DATE", "ORIGIN"]
    with pytest.raises(ValueError, match="NONE"):
        read_feed(spark, tmp_dir + "/feed", StructType([StructField("NONE", StringType())]))


def test_cluster_without_a_shared_folder_raises():
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())
