"""Bulk renames in one projection (no per-column withColumnRenamed chain)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bq(name: str) -> str:
    """A column name quoted for SQL text (safe for dots and spaces)."""
    return "`" + name.replace("`", "``") + "`"


def sq(text: str) -> str:
    """A string literal for SQL text."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def qcol(name: str):
    """Column by exact name, safe for dots and spaces."""
    return F.col(bq(name))


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Rename every column in one positional rename."""
    return df.toDF(*[prefix + c for c in df.columns])


def suffix_columns(df: DataFrame, suffix: str) -> DataFrame:
    return df.toDF(*[c + suffix for c in df.columns])
