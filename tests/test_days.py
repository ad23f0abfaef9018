"""Tables by day: what a rerun touches, and what a read opens."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from lagframe.sources.days import read_days, write_days


def files(path):
    return {f: os.stat(f).st_mtime_ns for f in glob.glob(path + "/part_day=*/*.parquet")}


def table(spark):
    """A third of the rows on one day, some without a day."""
    day = "date_add(date'2015-03-01', cast(if(id % 3 = 0, 0, id % 12) as int))"
    return spark.range(600).selectExpr("id", f"if(id % 100 = 7, null, {day}) as day", "cast(id as string) as `a b`").repartition(5)


def test_a_rerun_touches_its_days_only(spark, tmp_dir):
    path, df = os.path.join(tmp_dir, "t"), table(spark)
    # so few rows would be merged into one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_days(df, path, "day", rows_per_file=50)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    before = files(path)
    assert read_days(spark, path).select(*df.columns).exceptAll(df).isEmpty() and read_days(spark, path).count() == 600
    heavy = [f for f in before if "2015-03-01" in f]
    assert len(heavy) > 2 and any("__HIVE_DEFAULT" in f for f in before)
    changed = df.where("day = date'2015-03-05' and id % 2 = 0").withColumn("a b", F.lit("new"))
    write_days(changed, path, "day", rows_per_file=50)
    after = files(path)
    others = {f: t for f, t in before.items() if "2015-03-05" not in f}
    assert {f: t for f, t in after.items() if "2015-03-05" not in f} == others
    expected = df.where("day <> date'2015-03-05' or day is null").unionByName(changed)
    found = read_days(spark, path).select(*df.columns)
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()
    with pytest.raises(ValueError):
        write_days(df.withColumnRenamed("a b", "part_day"), path, "day")


def test_a_read_opens_its_days_only(spark, tmp_dir):
    path, df = os.path.join(tmp_dir, "t"), table(spark)
    write_days(df, path, "day")
    wanted = spark.createDataFrame([("2015-03-02",), ("2015-03-05",), ("2030-01-01",)], "d string").where("d > '2015-03-03'")
    out = read_days(spark, path, wanted, "d")
    assert {r.id for r in out.collect()} == {r.id for r in df.where("day = date'2015-03-05'").collect()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan.lower()
