"""CSV feeds in, CSV reports out."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def feed_columns(spark: SparkSession, path: str | list[str], schema: StructType | None) -> tuple[StructType, list[Column]]:
    """(the columns of the file in its order, what to select of them).

    Names come from the header of one file. A column without a name there
    (read as ``_c<place>``) can't be told by name: it is null where ``schema``
    asks for it and left out otherwise.
    """
    names = spark.read.option("header", True).csv(path).columns
    line = spark.read.text(path).first()
    unnamed = {n for i, n in enumerate(names) if n == f"_c{i}" and n not in (line[0] if line else "")}
    wanted = schema or StructType([StructField(n, StringType()) for n in names if n not in unnamed])
    missing = [f.name for f in wanted if f.name not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    types = {f.name: f.dataType for f in wanted}
    there = StructType([StructField(n, types.get(n, StringType())) for n in names])
    return there, [F.lit(None).cast(f.dataType).alias(f.name) if f.name in unnamed else F.col(f"`{f.name}`") for f in wanted]


def header_groups(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a feed by equal header line, from one pass over the lines; one row a file to the driver."""
    lines = (spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start",
                                          F.monotonically_increasing_id().alias("id"))
             .where("file_block_start = 0").groupBy("file_path").agg(F.min(F.struct("id", "value")).alias("first")))
    groups: dict[str, list[str]] = {}
    for r in lines.select("file_path", "first.value").collect():
        groups.setdefault(r["value"], []).append(unquote(r["file_path"]))
    return [sorted(files) for _, files in sorted(groups.items())]


def read_feed(spark: SparkSession, path: str | list[str], schema: StructType | None = None,
              mixed_headers: bool = False) -> DataFrame:
    """Read a headed CSV feed (a file or a directory) as text columns.

    Names come from the header, every column a string (no inference pass
    over the data). With ``schema`` its columns are selected by name and
    typed, in its order, wherever the file has them; a missing one raises,
    others (such as the unnamed last one, ``_c12``) are left out.

    All files must have the columns that are read in the same places: a file whose header
    differs there fails the job that reads it. With ``mixed_headers`` the files are read
    by groups of equal headers, at the cost of one more pass over the lines.
    """
    if mixed_headers:
        parts = [read_feed(spark, files, schema) for files in header_groups(spark, path)]
        if not parts:
            return read_feed(spark, path, schema)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=schema is None)
        return out
    there, columns = feed_columns(spark, path, schema)
    reader = spark.read.option("header", True).option("mode", "PERMISSIVE").option("enforceSchema", False)
    return reader.schema(there).csv(path).select(*columns)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """Write with a header, replacing ``path``.

    ``single_file`` funnels the table through one task: only for
    report-sized tables (metrics, profiles), never for row-level data.
    """
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def stage_to_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a feed once as Parquet (optionally partitioned, e.g. by date)
    and return the staged table: later scans are columnar, pruned and
    filter-pushed instead of re-parsing every CSV line."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write a (metric, value) table as one headed CSV file under ``path``."""
    write_csv(metrics.select("metric", "value"), path, single_file=True)
