"""Grouping sets with exact distinct counts, built from the finest groups.

Rows are read and grouped once, by all dimensions; every coarser grouping adds up
those partial results, so no row is expanded per grouping set. Distinct
ids are kept as bitmaps (one bit an id, 32,768 ids to a bitmap), which merge by OR where
counts can't be added. They suit ids that lie close together, such as days or row numbers.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagframe.operators.rename import bq, qcol
from lagframe.plans.guards import materialize


def all_sets(dimensions: list[str]) -> list[tuple[str, ...]]:
    """Every subset of the dimensions, the finest first: a cube."""
    return [s for n in range(len(dimensions), -1, -1) for s in combinations(dimensions, n)]


def finest_groups(df: DataFrame, dimensions: list[str], flags: dict[str, Column], distinct: str) -> DataFrame:
    """One row per group of all dimensions and bitmap of ids: _n, a count per flag, _bits."""
    at = df.select(*[qcol(d).alias(f"_d{i}") for i, d in enumerate(dimensions)], qcol(distinct).cast("long").alias("_id"),
                   *[flag.cast("boolean").alias(f"_f{i}") for i, flag in enumerate(flags.values())])
    bucket = F.bitmap_bucket_number("_id").alias("_bucket")
    return at.groupBy(*[f"_d{i}" for i in range(len(dimensions))], bucket).agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(f"_f{i}").alias(f"_f{i}") for i in range(len(flags))],
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias("_bits"))


def grouping_sets(df: DataFrame, dimensions: list[str], flags: dict[str, Column], distinct: str,
                  sets: list[tuple[str, ...]] | None = None) -> DataFrame:
    """Counts for each of the grouping ``sets`` (default: all, a cube).

    Columns: the dimensions (null where they are summed over), ``grouping_id`` (a
    bit per dimension that is summed over, the last dimension's lowest, as in SQL),
    ``n_rows``, the rows for which each of ``flags`` is true, and
    ``distinct_<id>``: how many different values ``distinct``, a whole number, takes (null not
    counted). Null values of a dimension are groups of their own. An empty
    table gives no groups, but 0 for the set of no dimensions.
    """
    sets = all_sets(dimensions) if sets is None else [tuple(s) for s in sets]
    unknown = {d for s in sets for d in s} - set(dimensions)
    if unknown or not dimensions:
        raise ValueError(f"unknown dimensions: {sorted(unknown)}" if unknown else "name one dimension at least")
    names = [f"_f{i}" for i in range(len(flags))]
    finest = materialize(finest_groups(df, dimensions, flags, distinct), "parquet")
    out = None
    for chosen in sets:
        keys = [f"_d{i}" for i, d in enumerate(dimensions) if d in chosen]
        sums = [F.sum(c).alias(c) for c in ("_n", *names)]
        merged = finest.groupBy(*keys, "_bucket").agg(*sums, F.bitmap_or_agg("_bits").alias("_bits"))
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("_n", *names)]
        level = merged.groupBy(*keys).agg(*sums, F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).alias("_ids"))
        shown = [f"_d{i} AS {bq(d)}" if d in chosen else
                 f"CAST(NULL AS {df.schema[d].dataType.simpleString()}) AS {bq(d)}" for i, d in enumerate(dimensions)]
        number = sum(1 << len(dimensions) - 1 - i for i, d in enumerate(dimensions) if d not in chosen)
        level = level.selectExpr(*shown, f"{number} AS grouping_id", "_n AS n_rows",
                                 *[f"{n} AS {bq(name)}" for n, name in zip(names, flags)], f"_ids AS {bq('distinct_' + distinct)}")
        out = level if out is None else out.unionByName(level)
    return out
