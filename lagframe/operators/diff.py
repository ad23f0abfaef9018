"""What changed between two deliveries of a feed, as multisets of rows.

Only a row's fingerprint (128 bits) and a signed counter are shuffled, combined in each
task before. Fingerprints whose counters cancel are done; the rows of the others, as a rule few,
are then looked up and counted by their values.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lagframe.operators.rename import qcol
from lagframe.plans.guards import broadcast_dimension, materialize

CHANGES = ("added", "removed", "changed_to", "changed_from")


def _fingerprinted(df: DataFrame) -> DataFrame:
    """``df`` with _p and _q: two hashes of the row, nulls told apart from missing neighbours."""
    columns = [qcol(c) for c in df.columns]
    nulls = F.concat(*[F.when(c.isNull(), "1").otherwise("0") for c in columns])
    return df.withColumns({"_p": F.xxhash64(*columns, nulls), "_q": F.xxhash64(nulls, F.lit(17), *columns)})


def diff_rows(before: DataFrame, after: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Rows that ``after`` has more or fewer copies of than ``before``.

    All columns, ``change`` and ``copies`` (how many more or fewer): ``added`` and ``removed``;
    with ``key``, rows of a key that has both are ``changed_to`` and ``changed_from``. Rows
    equal in all columns are one row of the result; nulls equal nulls. Both sides must have the
    same columns and types. A key with a null in it marks no change.
    """
    if before.dtypes != after.dtypes:
        raise ValueError(f"the deliveries differ in their columns: {before.dtypes} and {after.dtypes}")
    missing = [c for c in key or [] if c not in before.columns]
    if missing:
        raise ValueError(f"unknown key columns: {missing}")
    sides = [(_fingerprinted(df), sign) for df, sign in ((before, -1), (after, 1))]
    counters = [df.groupBy("_p", "_q").agg((F.count(F.lit(1)) * sign).alias("_n")) for df, sign in sides]
    open_prints = materialize(counters[0].unionByName(counters[1]).groupBy("_p", "_q").agg(F.sum("_n").alias("_n"))
                              .where("_n <> 0").select("_p", "_q"), "parquet")
    near = broadcast_dimension(open_prints)
    rows = [df.join(near, ["_p", "_q"], "left_semi").select(*[qcol(c) for c in before.columns], F.lit(sign).alias("_n"))
            for df, sign in sides]
    counted = (rows[0].unionByName(rows[1]).groupBy(*[qcol(c) for c in before.columns]).agg(F.sum("_n").alias("_n"))
               .where("_n <> 0"))
    change = F.when(F.col("_n") > 0, "added").otherwise("removed")
    if key:
        counted = materialize(counted, "parquet")
        both = (counted.groupBy(*[qcol(c).alias(f"_k{i}") for i, c in enumerate(key)])
                .agg(F.min("_n").alias("_least"), F.max("_n").alias("_most")).where("_least < 0 and _most > 0").drop("_least", "_most"))
        same = [qcol(c) == F.col(f"_k{i}") for i, c in enumerate(key)]
        counted = counted.join(broadcast_dimension(materialize(both, "parquet")), same, "left")
        marked = F.col("_k0").isNotNull()
        change = F.when(marked, F.when(F.col("_n") > 0, "changed_to").otherwise("changed_from")).otherwise(change)
    return counted.select(*[qcol(c) for c in before.columns], change.alias("change"), F.abs("_n").alias("copies"))
