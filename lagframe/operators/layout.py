"""User-level layout: report ordering and range partitioning.

Neither changes a result; both exist for writing sorted output. The joins
and aggregations leave partitioning to their own exchanges and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def order_by_time(df: DataFrame, instant: str = "FT_TIMESTAMP", tiebreak: str = "FT_event_id") -> DataFrame:
    """Total order on (instant, tiebreak), NULL instants last."""
    return df.orderBy(F.col(instant).asc_nulls_last(), F.col(tiebreak).asc_nulls_last())


def range_partition(df: DataFrame, n: int, instant: str = "FT_TIMESTAMP") -> DataFrame:
    """Range-partition by instant into ``n`` partitions (sampled bounds)."""
    return df.repartitionByRange(n, F.col(instant))
