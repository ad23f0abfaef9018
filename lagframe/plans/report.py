"""Presentation of result tables for comparison with other engines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DateType, DoubleType, FloatType, StructType, TimestampNTZType, TimestampType,
)

from lagframe.operators.rename import bq

DECIMALS = 4


def present(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Dates as ``yyyy-MM-dd``, instants as ``yyyy-MM-dd HH:mm:ss`` text,
    doubles rounded (to 4 decimals); other columns unchanged."""
    return df.selectExpr(*presented(df.schema, decimals))


def presented(schema: StructType, decimals: int = DECIMALS) -> list[str]:
    """The columns of a schema as ``present`` shows them, in SQL text."""
    out = []
    for f in schema.fields:
        c, t = bq(f.name), f.dataType
        if isinstance(t, DateType):
            e = f"date_format({c}, 'yyyy-MM-dd')"
        elif isinstance(t, (TimestampType, TimestampNTZType)):
            e = f"date_format({c}, 'yyyy-MM-dd HH:mm:ss')"
        elif isinstance(t, (DoubleType, FloatType)):
            e = f"round(CAST({c} AS DOUBLE), {decimals})"
        else:
            out.append(c)
            continue
        out.append(f"{e} AS {c}")
    return out
