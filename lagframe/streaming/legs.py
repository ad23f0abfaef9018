"""Stream-static lagged join of arriving leg feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from lagframe.operators.clean import prepare_legs
from lagframe.operators.lagjoin import lag_join_long, map_legs
from lagframe.schemas import LEG_FEED_SCHEMA, MAX_LAG_HOURS
from lagframe.session import scratch_path
from lagframe.sources.csv import feed_columns


def lagged_legs_stream(spark: SparkSession, legs_dir: str, observations: DataFrame,
                       stations: DataFrame, schema: StructType = LEG_FEED_SCHEMA,
                       max_lag: int = MAX_LAG_HOURS, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming long layout: CSV leg files under ``legs_dir`` joined with a
    static, prepared observation table. Same columns as the batch join.

    Columns are read by name, in the places they have in a file that lies there
    at the start (without any, in those of ``schema``); a later file with other places fails the query."""
    there, columns = schema, [F.col(f"`{f.name}`") for f in schema]
    if not spark.read.text(legs_dir).isEmpty():
        there, columns = feed_columns(spark, legs_dir, schema)
    reader = spark.readStream.schema(there).option("header", True).option("enforceSchema", False)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    legs = map_legs(prepare_legs(reader.csv(legs_dir).select(*columns), stations))
    return lag_join_long(legs, observations, max_lag)


def start_lagged_legs(stream: DataFrame, out_path: str, checkpoint: str | None = None,
                      available_now: bool = True) -> StreamingQuery:
    """Append the lagged rows as Parquet; progress is kept in a checkpoint
    under the shared ``spark.checkpoint.dir`` so a restart resumes."""
    ckpt = checkpoint or scratch_path(stream.sparkSession, "stream-ckpt")
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("path", out_path).option("checkpointLocation", ckpt))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
