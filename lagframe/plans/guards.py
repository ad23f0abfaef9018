"""Broadcast only behind a size check; cut lineage in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark import StorageLevel

from lagframe.session import scratch_path

# A dimension is broadcast only when it has at most this many rows
# (stations: a few hundred to a few thousand, three short columns).
DIMENSION_MAX_ROWS = 200_000


def broadcast_dimension(df: DataFrame, max_rows: int = DIMENSION_MAX_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast if it is proven to hold <= ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Beyond the bound the
    frame is returned unhinted, and the join falls back to a shuffle (or
    to AQE's own runtime broadcast when the shuffled side turns out small).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def materialize(df: DataFrame, how: str = "checkpoint") -> DataFrame:
    """Compute ``df`` once for several downstream actions.

    ``checkpoint`` writes to the shared ``spark.checkpoint.dir`` and cuts
    lineage (survives executor loss without recomputation); ``parquet``
    writes a staged table there and reads it back; ``persist`` keeps
    blocks in memory/disk and recomputes lost ones from lineage.
    """
    if how == "checkpoint":
        from lagframe.session import checkpoint_dir
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    if how == "parquet":
        path = scratch_path(df.sparkSession, "stage")
        df.write.mode("overwrite").parquet(path)
        return df.sparkSession.read.parquet(path)
    if how == "persist":
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        out.count()
        return out
    raise ValueError(f"unknown materialisation {how!r}: use checkpoint, parquet or persist")
