"""Tables in folders by day: reruns of a day, and reads of a few days."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lagframe.operators.rename import qcol
from lagframe.plans.guards import broadcast_dimension

DAY = "part_day"
ROWS_PER_FILE = 5_000_000


def write_days(df: DataFrame, path: str, day: str, rows_per_file: int = ROWS_PER_FILE) -> None:
    """Write Parquet below ``path``, one folder a day of the date or instant ``day``.

    Only the days that ``df`` holds are replaced; files of other days stay as they are. Rows
    without a day have a folder of their own. Rows are dealt to tasks by day, and those of a day
    with more than ``rows_per_file`` rows to several, so that neither a day's files are many
    small ones nor a heavy day is one task.
    """
    if DAY in (c.lower() for c in df.columns):
        raise ValueError(f"the table has a column {DAY} already")
    dated = df.withColumn(DAY, F.to_date(qcol(day)))
    sizes = dated.groupBy(DAY).count().where(F.col("count") > rows_per_file) \
        .select(F.col(DAY).alias("_day"), F.ceil(F.col("count") / rows_per_file).cast("int").alias("_files"))
    dealt = dated.join(broadcast_dimension(sizes), qcol(DAY).eqNullSafe(F.col("_day")), "left")
    file = F.pmod(F.xxhash64(*[qcol(c) for c in df.columns]), F.coalesce("_files", F.lit(1)).cast("long"))
    spread = dealt.withColumn("_file", file).drop("_day", "_files").repartition(DAY, "_file").drop("_file")
    spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DAY).parquet(path)


def read_days(spark: SparkSession, path: str, days: DataFrame | None = None, day: str | None = None) -> DataFrame:
    """The table below ``path``, without the folder's column.

    With ``days`` only rows of the days in its column ``day``: the days are found out when the
    job runs, and the scan opens their folders alone.
    """
    table = spark.read.parquet(path)
    if days is not None:
        wanted = broadcast_dimension(days.select(F.to_date(qcol(day)).alias("_day")).distinct())
        table = table.join(wanted, F.col(DAY) == F.col("_day"), "left_semi")
    return table.drop(DAY)
