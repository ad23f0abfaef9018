"""Column profiling, sparse-column drop, mean imputation, labelling.

One aggregation pass computes, for every column, the row count, the
missing count in the profile sense (NULL, or empty text), the missing
count in the imputation sense (NULL, or NaN) and the mean of numeric
columns over present values. The driver receives one row per column
(bounded by the table's width, not its length) and builds the next
projection from it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, IntegerType, StringType

from lagframe.functions.scalar import on_time
from lagframe.operators import lagjoin
from lagframe.operators.rename import bq, sq
from lagframe.schemas import DEST_SUFFIX, MAX_LAG_HOURS, MISSING_THRESHOLD, ON_TIME_THRESHOLD, ORIGIN_SUFFIX

LABEL = "FT_OnTime"
LABEL_SOURCE = "FT_ARR_DELAY_NEW"
# Column types eligible for mean imputation (LONG columns are left alone).
IMPUTABLE_TYPES = (IntegerType, DoubleType)


def _missing_sql(c: str, dtype) -> str:
    """Missing in the profile sense: NULL, or empty text for strings."""
    if isinstance(dtype, StringType):
        return f"({c} IS NULL OR {c} = '')"
    return f"{c} IS NULL"


def _missing_numeric_sql(c: str, dtype) -> str:
    """Missing in the imputation sense: NULL, or NaN for floating columns."""
    if isinstance(dtype, (DoubleType, FloatType)):
        return f"({c} IS NULL OR isnan({c}))"
    return _missing_sql(c, dtype)


def _mean_sql(c: str, dtype) -> str:
    if isinstance(dtype, DoubleType):
        return f"avg(CASE WHEN isnan({c}) THEN NULL ELSE {c} END)"
    if isinstance(dtype, IMPUTABLE_TYPES):
        return f"CAST(avg({c}) AS DOUBLE)"
    return "CAST(NULL AS DOUBLE)"


def profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row per column: position, column_name, data_type, n_rows,
    n_missing (NULL or empty text), n_missing_numeric (NULL or NaN),
    missing_share, missing_share_numeric, mean (numeric columns).

    The expressions are generated as SQL text: one aggregate per column
    and kind, then one row per column from an array of structs."""
    cols = list(columns or df.columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = ["count(1) AS _n"]
    for i, name in enumerate(cols):
        c, t = bq(name), types[name]
        aggs += [f"count_if({_missing_sql(c, t)}) AS _a{i}",
                 f"count_if({_missing_numeric_sql(c, t)}) AS _b{i}",
                 f"{_mean_sql(c, t)} AS _m{i}"]
    return _profile_rows(df, cols, types, aggs)


def _profile_rows(df: DataFrame, cols: list[str], types: dict, aggs: list[str]) -> DataFrame:
    """One row per column from the aggregates _n, and _a, _b and _m by column."""
    entries = [f"named_struct('position', {i}, 'column_name', {sq(name)}, "
               f"'data_type', {sq(types[name].simpleString())}, 'n_missing', _a{i}, "
               f"'n_missing_numeric', _b{i}, 'mean', _m{i})" for i, name in enumerate(cols)]
    one = df.agg(*[F.expr(a) for a in aggs])
    rows = one.selectExpr("_n AS n_rows", f"inline(array({', '.join(entries)}))")
    return rows.selectExpr(
        "position", "column_name", "data_type", "n_rows", "n_missing", "n_missing_numeric",
        "try_divide(CAST(n_missing AS DOUBLE), CAST(n_rows AS DOUBLE)) AS missing_share",
        "try_divide(CAST(n_missing_numeric AS DOUBLE), CAST(n_rows AS DOUBLE)) AS missing_share_numeric",
        "mean")


def profile_lag_join(legs: DataFrame, obs: DataFrame, columns: list[str] | None = None,
                     max_lag: int = MAX_LAG_HOURS, snap: str | None = None) -> DataFrame:
    """``profile`` of ``lag_join_long(legs, obs)`` without its rows.

    Leg columns are weighted with the rows of their leg and lag; observation
    columns are folded by instant and weighted with the matches of the other endpoint."""
    schema = lagjoin.lag_join_long(legs, obs, max_lag, heavy=False, snap=snap).schema
    cols = list(columns or schema.names)
    types = {f.name: f.dataType for f in schema.fields}
    sides = {c + suffix: (c, suffix) for suffix in (ORIGIN_SUFFIX, DEST_SUFFIX) for c in obs.columns}
    folds = {}
    for i, name in enumerate(obs.columns):
        c, t = bq(name), obs.schema[name].dataType
        if not any(name + suffix in cols for suffix in (ORIGIN_SUFFIX, DEST_SUFFIX)):
            continue
        folds |= {f"_a{i}": f"count_if({_missing_sql(c, t)})", f"_b{i}": f"count_if({_missing_numeric_sql(c, t)})"}
        if isinstance(t, IMPUTABLE_TYPES):
            folds[f"_s{i}"] = f"sum(CASE WHEN {_missing_numeric_sql(c, t)} THEN NULL ELSE CAST({c} AS DOUBLE) END)"
    weighted = lagjoin.lag_join_long(legs, obs, max_lag, snap=snap, folds=folds).withColumn("_w", lagjoin.fold_weight())
    aggs = ["coalesce(sum(_w), 0L) AS _n"]
    for i, name in enumerate(cols):
        t = types[name]
        if name in sides:
            c, suffix = sides[name]
            k, n = obs.columns.index(c), f"{lagjoin.MATCHES}{suffix}"
            w = f"greatest({lagjoin.MATCHES}{DEST_SUFFIX if suffix == ORIGIN_SUFFIX else ORIGIN_SUFFIX}, 1)"
            a, b = (f"IF({n} = 0, 1, _{x}{k}{suffix}) * {w}" for x in "ab")
            total, present = f"_s{k}{suffix} * {w}", f"IF({n} = 0, 0, {n} - _b{k}{suffix}) * {w}"
        else:
            c = bq(name)
            a, b = f"IF({_missing_sql(c, t)}, _w, 0)", f"IF({_missing_numeric_sql(c, t)}, _w, 0)"
            total, present = f"IF({_missing_numeric_sql(c, t)}, NULL, CAST({c} AS DOUBLE)) * _w", f"_w - {b}"
        mean = f"try_divide(sum({total}), sum({present}))" if isinstance(t, IMPUTABLE_TYPES) else "CAST(NULL AS DOUBLE)"
        aggs += [f"coalesce(sum({a}), 0L) AS _a{i}", f"coalesce(sum({b}), 0L) AS _b{i}", f"{mean} AS _m{i}"]
    return _profile_rows(weighted, cols, types, aggs)


def missing_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """(position, column_name, n_rows, n_missing, missing_share)."""
    return profile(df, columns).select("position", "column_name", "n_rows", "n_missing", "missing_share")


# As ``profile``: (frame, columns) to a row per column.
ProfileOf = Callable[[DataFrame, list[str]], DataFrame]


def _collect_profile(df: DataFrame, profile_of: ProfileOf = profile):
    rows = sorted(profile_of(df, df.columns).collect(), key=lambda r: r.position)
    if not rows or rows[0].n_rows == 0:
        raise ValueError("cannot profile an empty table: missing shares are undefined")
    return rows


def sparse_keep(rows, threshold: float) -> list[str]:
    """Columns whose missing share is <= threshold, in input order."""
    return [r.column_name for r in rows if r.missing_share <= threshold]


def drop_sparse_columns(df: DataFrame, threshold: float = MISSING_THRESHOLD) -> DataFrame:
    """Keep columns whose missing share (NULL or empty) is <= threshold."""
    return df.selectExpr(*[bq(c) for c in sparse_keep(_collect_profile(df), threshold)])


def _imputable(df: DataFrame, exclude) -> set[str]:
    return {f.name for f in df.schema.fields
            if isinstance(f.dataType, IMPUTABLE_TYPES) and f.name not in set(exclude)}


def impute_eligible(df: DataFrame, max_missing: float = 1 - MISSING_THRESHOLD,
                    exclude: tuple[str, ...] | list[str] = (), profile_of: ProfileOf = profile) -> DataFrame:
    """(position, column_name, n_missing, missing_share, eligible) for the
    int and double columns; eligible when the share (NULL or NaN) is
    strictly below ``max_missing``. ``profile_of`` may know the profile of
    ``df`` without its rows (see ``profile_lag_join``)."""
    cols = [c for c in df.columns if c in _imputable(df, exclude)]
    p = profile_of(df, cols)
    return p.select("position", "column_name", F.col("n_missing_numeric").alias("n_missing"),
                    F.col("missing_share_numeric").alias("missing_share"),
                    (F.col("missing_share_numeric") < F.lit(max_missing)).alias("eligible"))


def _impute_exprs(df: DataFrame, rows, max_missing: float, exclude) -> list[str]:
    """SQL projection of ``df``: eligible columns take their mean where
    missing (an int column the truncated mean), others pass through."""
    imputable = _imputable(df, exclude)
    types = {f.name: f.dataType for f in df.schema.fields}
    fill = {r.column_name: r.mean for r in rows
            if r.column_name in imputable and r.missing_share_numeric < max_missing and r.mean is not None}
    out = []
    for name in df.columns:
        c = bq(name)
        if name in fill:
            t = types[name]
            missing = _missing_numeric_sql(c, t)
            out.append(f"CASE WHEN {missing} THEN CAST(CAST('{fill[name]!r}' AS DOUBLE) AS {t.simpleString()}) "
                       f"ELSE {c} END AS {c}")
        else:
            out.append(c)
    return out


def impute_mean(df: DataFrame, max_missing: float = 1 - MISSING_THRESHOLD,
                exclude: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Replace NULL/NaN by the column mean in int and double columns whose
    missing share is below ``max_missing`` (ints take the truncated mean)."""
    rows = _collect_profile(df)
    return df.selectExpr(*_impute_exprs(df, rows, max_missing, exclude))


def label_on_time(df: DataFrame, source: str = LABEL_SOURCE,
                  threshold: float = ON_TIME_THRESHOLD, label: str = LABEL) -> DataFrame:
    return df.withColumn(label, on_time(source, threshold))


def build_training_table(joined: DataFrame, on_time_threshold: float = ON_TIME_THRESHOLD,
                         missing_threshold: float = MISSING_THRESHOLD,
                         exclude: tuple[str, ...] | list[str] = (LABEL, "hours_lag"),
                         source: str = LABEL_SOURCE, profile_of: ProfileOf = profile) -> DataFrame:
    """Label, drop sparse columns (share <= threshold kept), mean-impute
    (share < 1 - threshold). One profiling job decides both projections;
    ``profile_of`` may know the profile of the labelled table without its rows."""
    labelled = label_on_time(joined, source, on_time_threshold)
    rows = _collect_profile(labelled, profile_of)
    keep = sparse_keep(rows, missing_threshold)
    reduced = labelled.selectExpr(*[bq(c) for c in keep])
    kept_rows = [r for r in rows if r.column_name in set(keep)]
    return reduced.selectExpr(*_impute_exprs(reduced, kept_rows, 1 - missing_threshold, exclude))
