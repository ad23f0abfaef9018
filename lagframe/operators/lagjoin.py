"""Lagged two-endpoint joins of legs with station observations.

Each leg is matched with the observations taken exactly ``h`` hours
(h = 0..max_lag) before its local departure, at the origin, and before
its local arrival, at the destination.

Plan. Instead of exploding every leg into ``max_lag + 1`` rows and
shuffling that 12x table through two joins, the join is a bucketed band
join: observations are indexed by (airport, second-of-hour phase,
(max_lag + 1)-hour window), each copied into two windows, and legs take
two equi-joins on those keys at their own size (AQE picks broadcast or
sort-merge). Right after each join a leg keeps only its own max_lag + 1
lookups, and the lag rows are generated last, by native generators inside
the same stage, without another shuffle. The keys spread a hub airport
over phases and windows, so no single key concentrates the legs, and each
index entry is bounded by the window. Observations repeated at one
(airport, instant) are listed up to MAX_LIST_PER_INSTANT; those of a heavier
instant are dealt into parts of about that many. Legs that look into a window
with a heavy instant are joined with each of its parts, so that no list grows
with the data and no row is shuffled after it is generated. The wide layout
reduces observations to one per instant before it copies them.

Aggregates over the long layout need no pair of observations: with ``folds``
every instant is reduced to its count and the aggregates named before its
copies, and a leg and lag stand for origin matches x destination matches rows
(``fold_weight``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from lagframe.functions.scalar import arrival_instant, epoch_seconds, shift_hours
from lagframe.operators.rename import bq, qcol
from lagframe.plans.guards import broadcast_dimension, materialize
from lagframe.schemas import DEST_SUFFIX, MAX_LAG_HOURS, ORIGIN_SUFFIX, WIDE_ORIGIN_DROP

# Leg and observation columns the joins address.
LEG_ORIGIN, LEG_DEST = "FT_ORIGIN_AIRPORT_ID", "FT_DEST_AIRPORT_ID"
LEG_DEPARTURE, LEG_ARRIVAL = "FT_TIMESTAMP", "FT_DEST_DATE_TIME"
OBS_AIRPORT, OBS_INSTANT = "OT_ORIGIN_AIRPORT_ID", "OT_WEATHER_TIMESTAMP"
LAG = "hours_lag"
# Columns of a schema as SQL text, one for each in their order and of their names.
Shown = Callable[[StructType], list[str]]


# --------------------------------------------------------------------------
# Leg timing and keys
# --------------------------------------------------------------------------

def add_arrival(legs: DataFrame) -> DataFrame:
    """FT_DEST_DATE_TIME: local arrival from departure, duration, zone delta."""
    return legs.withColumn(LEG_ARRIVAL, arrival_instant(
        LEG_DEPARTURE, "FT_CRS_ELAPSED_TIME", "FT_Delta_Lag"))


def add_join_keys(legs: DataFrame) -> DataFrame:
    """Text keys airport_date (origin) and airport_arrival-instant (dest)."""
    return legs.withColumns({
        "FT_JOIN_KEY_ORIGIN": F.concat(F.col(LEG_ORIGIN), F.lit("_"), F.col("FT_FL_DATE").cast("string")),
        "FT_JOIN_KEY_DEST": F.concat(F.col(LEG_DEST), F.lit("_"), F.col(LEG_ARRIVAL).cast("string")),
    })


def map_legs(legs: DataFrame) -> DataFrame:
    """Arrival instant plus both text keys."""
    return add_join_keys(add_arrival(legs))


def map_observations(obs: DataFrame) -> DataFrame:
    """OT_JOIN_KEY = airport_date."""
    return obs.withColumn("OT_JOIN_KEY", F.concat(
        F.col(OBS_AIRPORT), F.lit("_"), F.col("OT_Date").cast("string")))


def _check_lag(max_lag: int) -> None:
    if not isinstance(max_lag, int) or max_lag < 0:
        raise ValueError(f"max_lag must be a non-negative int, got {max_lag!r}")


def leg_lags(legs: DataFrame, max_lag: int = MAX_LAG_HOURS) -> DataFrame:
    """One row per leg and lag 0..max_lag with the lagged instants.

    A generator on the leg rows (no join with a lag table)."""
    _check_lag(max_lag)
    out = legs.select(
        "*",
        epoch_seconds(LEG_DEPARTURE).alias("FT_ORIGIN_UNIX_TS"),
        epoch_seconds(LEG_ARRIVAL).alias("FT_DEST_UNIX_TS"),
        F.explode(F.sequence(F.lit(0), F.lit(max_lag))).alias(LAG))
    return out.withColumns({
        "FT_ORIGIN_DATE_TIME_LAG": shift_hours(LEG_DEPARTURE, LAG),
        "FT_DEST_DATE_TIME_LAG": shift_hours(LEG_ARRIVAL, LAG),
    })


# --------------------------------------------------------------------------
# Observation index: a band join bucketed by (airport, phase, window)
# --------------------------------------------------------------------------
#
# An observation at instant t matches a leg departing at d with lag h iff
# t = d - h hours, 0 <= h <= max_lag. So t and d share the second within the
# hour (the phase), and t lies in [d - max_lag h, d]. With windows of
# (max_lag + 1) hours, that range touches the leg's window and the one
# before, so each observation is replicated into its own window and the
# next one (2x, not 12x). A group (airport, phase, window) holds a small
# map instant -> observations (at most 2 x (max_lag + 1) instants).

HOUR = 3600
SNAPS = (None, "hour")


def _check_snap(snap: str | None) -> None:
    if snap not in SNAPS:
        raise ValueError(f"snap must be None or 'hour', got {snap!r}")


def _instant(name: str, snap: str | None) -> Column:
    """The instant a join matches on: exact, or truncated to the hour."""
    return F.date_trunc("hour", F.col(name)) if snap else F.col(name)


def _instant_sql(name: str, snap: str | None) -> str:
    return f"date_trunc('hour', {bq(name)})" if snap else bq(name)


def _window_seconds(max_lag: int) -> int:
    return (max_lag + 1) * HOUR


def _band_keys(instant: Column, max_lag: int) -> tuple[Column, Column]:
    """(phase, window start) of an instant, in whole epoch seconds."""
    secs = F.unix_seconds(instant)
    width = _window_seconds(max_lag)
    return F.pmod(secs, F.lit(HOUR)), secs - F.pmod(secs, F.lit(width))


# Observations at one (airport, instant) beyond this count are not gathered
# into one index entry, but dealt into parts of about as many.
MAX_LIST_PER_INSTANT = 64


def _valid(obs: DataFrame) -> DataFrame:
    return obs.where(F.col(OBS_INSTANT).isNotNull() & F.col(OBS_AIRPORT).isNotNull())


def _shown(schema: StructType, show: Shown | None) -> list[str]:
    return [bq(f.name) for f in schema.fields] if show is None else show(schema)


def _timed(obs: DataFrame, snap: str | None, columns: list[str] | None, *extra: Column,
           show: Shown | None = None) -> DataFrame:
    """(_airport, _ts, _obs) of the observations that can match, ``_obs``
    holding ``columns`` (default: all) and nothing else of the row."""
    names = obs.columns if columns is None else columns
    payload = F.struct(*[F.expr(e) for e in _shown(StructType([obs.schema[c] for c in names]), show)]).alias("_obs")
    return _valid(obs).select(F.col(OBS_AIRPORT).alias("_airport"),
                              _instant(OBS_INSTANT, snap).alias("_ts"), payload, *extra)


_INDEX_KEYS = ["_airport", "_phase", "_window"]


def _windows(rows: DataFrame, max_lag: int) -> DataFrame:
    """Rows with _airport and _ts, every one in its window and the next."""
    phase, window = _band_keys(F.col("_ts"), max_lag)
    width = _window_seconds(max_lag)
    return rows.select("*", phase.alias("_phase"), F.explode(F.array(window, window + F.lit(width))).alias("_window"))


def _spread(rows: DataFrame, max_lag: int, keys: list[str] = _INDEX_KEYS) -> DataFrame:
    """``_windows``, hash-partitioned by ``keys``."""
    return _windows(rows, max_lag).repartition(*keys)


def heavy_instants(obs: DataFrame, max_list: int = MAX_LIST_PER_INSTANT, snap: str | None = None) -> DataFrame:
    """(_airport, _ts, _n) of the instants holding more than ``max_list``
    observations: one narrow aggregation over the keys, combined before its
    shuffle. At most one row per ``max_list`` observations, normally none."""
    return (_timed(obs, snap, [OBS_INSTANT]).groupBy("_airport", "_ts").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") > F.lit(max_list)))


def has_heavy_instants(obs: DataFrame, max_list: int = MAX_LIST_PER_INSTANT,
                       snap: str | None = None) -> bool:
    """Does any (airport, instant) hold more than ``max_list`` observations?"""
    return not heavy_instants(obs, max_list, snap).isEmpty()


def _at_heavy(rows: DataFrame, heavy: DataFrame, how: str) -> DataFrame:
    """Rows with _airport and _ts at a heavy instant (left_semi) or not (left_anti)."""
    keys = broadcast_dimension(heavy.select(F.col("_airport").alias("_h_airport"), F.col("_ts").alias("_h_ts")))
    return rows.join(keys, (F.col("_airport") == F.col("_h_airport")) & (F.col("_ts") == F.col("_h_ts")), how)


def heavy_observations(obs: DataFrame, heavy: DataFrame | None = None, snap: str | None = None,
                       columns: list[str] | None = None) -> DataFrame:
    """(_airport, _ts, _obs) of the observations at heavy instants, which stay
    where they are: they never pass an exchange by instant."""
    heavy = heavy_instants(obs, snap=snap) if heavy is None else heavy
    return _at_heavy(_timed(obs, snap, columns), heavy, "left_semi")


def _dealt(rows: DataFrame, heavy: DataFrame) -> DataFrame:
    """Rows with ``_part``: 0 for those of light instants, others by a hash of their place.

    Of every heavy instant one more row without observation is in part 0: it
    tells a leg of that part that the instant isn't empty."""
    marks = heavy.select("_airport", "_ts", F.lit(0).cast("long").alias("_part"))
    keys = broadcast_dimension(heavy.select(F.col("_airport").alias("_h_airport"), F.col("_ts").alias("_h_ts"), _parts_of("_n").alias("_parts")))
    found = (rows.withColumn("_place", F.xxhash64(F.monotonically_increasing_id()))
             .join(keys, (F.col("_airport") == F.col("_h_airport")) & (F.col("_ts") == F.col("_h_ts")), "left"))
    part = F.coalesce(F.pmod("_place", "_parts"), F.lit(0))
    return found.select(*rows.columns, part.alias("_part")).unionByName(marks, allowMissingColumns=True)


def _parts_of(n: str) -> Column:
    return F.ceil(F.col(n) / F.lit(MAX_LIST_PER_INSTANT))


def _window_parts(heavy: DataFrame, max_lag: int) -> DataFrame:
    """(_airport, _phase, _window, _parts) of the windows with a heavy instant."""
    return _windows(heavy, max_lag).groupBy(*_INDEX_KEYS).agg(F.max(_parts_of("_n")).alias("_parts"))


def observation_index(obs: DataFrame, max_lag: int = MAX_LAG_HOURS,
                      dedup_by: str | None = None, dedup: bool = False,
                      heavy: DataFrame | None = None, snap: str | None = None,
                      columns: list[str] | None = None, folds: dict[str, str] | None = None,
                      show: Shown | None = None) -> DataFrame:
    """(_airport, _phase, _window, _index map<timestamp, value>).

    With ``dedup`` the value is the single observation with the smallest
    ``dedup_by`` (or the smallest row); observations are reduced to one per
    (airport, instant), combined before the shuffle, and only then copied
    into their windows. With ``folds`` (SQL aggregates by name) they are reduced
    likewise, to struct(_matches, folds). Otherwise it is the list of the observations at
    that instant. Those of the instants in ``heavy`` (see
    ``heavy_instants``) are dealt into parts, numbered by one more column
    ``_part``; without it the input must hold none. One exchange serves the aggregations and the join
    with the legs: all run on the (airport, phase, window) partitioning.
    ``columns`` names what is kept of an observation, ``show`` what is made of it.
    """
    _check_lag(max_lag)
    keys = _INDEX_KEYS
    if dedup:
        tie = qcol(dedup_by) if dedup_by else F.struct(*[qcol(c) for c in obs.columns])
        single = (_timed(obs, snap, columns, tie.alias("_tie")).groupBy("_airport", "_ts")
                  .agg(F.min_by("_obs", "_tie").alias("_v")))
        per_instant = _spread(single, max_lag)
    elif folds is not None:
        folded = F.struct(F.count(F.lit(1)).alias("_matches"), *[F.expr(e).alias(n) for n, e in folds.items()])
        per_instant = _spread(_valid(obs).groupBy(F.col(OBS_AIRPORT).alias("_airport"), _instant(OBS_INSTANT, snap).alias("_ts"))
                              .agg(folded.alias("_v")), max_lag)
    else:
        rows = _timed(obs, snap, columns, show=show)
        if heavy is not None:
            rows, keys = _dealt(rows, heavy), [*_INDEX_KEYS, "_part"]
        per_instant = _spread(rows, max_lag, keys).groupBy(*keys, "_ts").agg(F.collect_list("_obs").alias("_v"))
    return per_instant.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_ts", "_v"))).alias("_index"))


def _attach(legs: DataFrame, index: DataFrame, airport: str, instant: str, tag: str,
            max_lag: int, snap: str | None = None, parts: DataFrame | None = None) -> DataFrame:
    """Left equi-join of legs with the index on (airport, phase, window),
    keeping only this leg's own lookups: ``_<tag>_hits`` is an array whose
    element h holds the value at exactly ``instant - h hours`` (NULL when
    none). The index map itself is dropped right after the join, so a
    later shuffle of the legs carries at most max_lag + 1 entries.

    With ``parts`` (see ``_window_parts``) a leg is one row per part of its
    window, numbered by ``_<tag>_part``: the first also without a value."""
    phase, window = _band_keys(_instant(instant, snap), max_lag)
    keyed = legs.select("*", phase.alias(f"_{tag}_lphase"), window.alias(f"_{tag}_lwindow"))
    right = index.toDF(*[f"_{tag}{c}" for c in index.columns])
    cond = ((F.col(airport) == F.col(f"_{tag}_airport"))
            & (F.col(f"_{tag}_lphase") == F.col(f"_{tag}_phase"))
            & (F.col(f"_{tag}_lwindow") == F.col(f"_{tag}_window")))
    kept = [bq(c) for c in legs.columns]
    if parts is not None:
        dim = parts.toDF(*[f"_{tag}{c}" for c in parts.columns])
        numbered = keyed.join(broadcast_dimension(dim), cond, "left")
        keyed = numbered.select(*[qcol(c) for c in keyed.columns], F.explode(
            F.sequence(F.lit(0).cast("long"), F.coalesce(f"_{tag}_parts", F.lit(1)) - 1)).alias(f"_{tag}_lpart"))
        cond = cond & (F.col(f"_{tag}_lpart") == F.col(f"_{tag}_part"))
        kept.append(f"_{tag}_lpart")
    # one lookup for all lags: spelled out, they make a method too large for the JVM's compiler
    at = _instant_sql(instant, snap)
    lookups = f"transform({_lags(max_lag)}, h -> `_{tag}_index`[{at} - INTERVAL '1' HOUR * h]) AS _{tag}_hits"
    return keyed.join(right, cond, "left").selectExpr(*kept, lookups)


def _lags(max_lag: int) -> str:
    return f"sequence(0, {max_lag})"


def _lookup(tag: str, h: int | str) -> str:
    """SQL: the value at exactly ``h`` hours before the instant (NULL if none)."""
    return f"`_{tag}_hits`[{h}]"


# --------------------------------------------------------------------------
# Long layout
# --------------------------------------------------------------------------

def _heavy_table(obs: DataFrame, heavy: bool | None, snap: str | None) -> DataFrame | None:
    """The heavy instants, written once, or None for the plan without them."""
    if heavy is False:
        return None
    found = materialize(heavy_instants(obs, snap=snap), "parquet")
    return None if heavy is None and found.isEmpty() else found


def _by_lag(joined: DataFrame, legs: DataFrame, sides: list[tuple[str, str, str]], max_lag: int,
            show: Shown | None, unix: dict[str, str]) -> DataFrame:
    """One row per leg and lag: the leg, ``unix`` columns, the lag, its instants, and by side its value.

    ``sides`` are (tag, instant, name of the lagged instant). What is shown of a
    leg and a lag is made here, before any row is repeated for its observations."""
    at = [bq(f.name) for f in legs.schema.fields]
    parts = [c for c in joined.columns if c in [f"_{tag}_lpart" for tag, _, _ in sides]]
    raw = [x for tag, _, _ in sides for x in (f"_{tag}_at", f"_{tag}_hits")]
    per_leg = joined.selectExpr(*_shown(legs.schema, show), *[f"{e} AS {n}" for n, e in unix.items()], *parts,
                                *[x for tag, instant, _ in sides for x in (f"{bq(instant)} AS _{tag}_at", f"_{tag}_hits")])
    rows = per_leg.selectExpr(*at, *unix, *parts, *raw, f"explode({_lags(max_lag)}) AS _lag")
    rows = rows.selectExpr(*at, *unix, *parts, "_lag", *[
        x for tag, _, name in sides for x in (f"_{tag}_at - INTERVAL '1' HOUR * _lag AS {bq(name)}", f"{_lookup(tag, '_lag')} AS _{tag}")])
    for tag, _, _ in sides:
        if f"_{tag}_lpart" in parts:
            # an instant without observations is a row of the first part only
            rows = rows.where(f"(_{tag} IS NULL AND _{tag}_lpart = 0) OR size(_{tag}) > 0")
    instants = StructType([StructField(name, legs.schema[instant].dataType) for _, instant, name in sides])
    return rows.selectExpr(*at, *unix, f"CAST(_lag AS INT) AS {LAG}", *_shown(instants, show), *[f"_{tag}" for tag, _, _ in sides])


def _listed(rows: DataFrame, sides: list[tuple[str, str]], names: list[str]) -> DataFrame:
    """Rows of ``_by_lag`` repeated for their observations; ``sides`` are (tag, suffix)."""
    keep = [bq(c) for c in rows.columns[:-len(sides)]]
    for i, (tag, _) in enumerate(sides):
        after = [f"_{t}" for t, _ in sides[i + 1:]]
        before = [f"_{t}_obs" for t, _ in sides[:i]]
        rows = rows.selectExpr(*keep, *before, f"explode_outer(_{tag}) AS _{tag}_obs", *after)
    return rows.selectExpr(*keep, *[f"_{tag}_obs.{bq(c)} AS {bq(c + suffix)}" for tag, suffix in sides for c in names])


def fold_weight() -> Column:
    """Rows of the long layout that a row of the folded one stands for."""
    return F.expr(f"greatest({MATCHES + ORIGIN_SUFFIX}, 1) * greatest({MATCHES + DEST_SUFFIX}, 1)")


# Observations matched at an endpoint, in the folded layout.
MATCHES = "_matches"
_SIDES = {"origin": ("o", LEG_ORIGIN, LEG_DEPARTURE, "FT_ORIGIN_DATE_TIME_LAG", ORIGIN_SUFFIX),
          "dest": ("d", LEG_DEST, LEG_ARRIVAL, "FT_DEST_DATE_TIME_LAG", DEST_SUFFIX)}


def _joined(legs: DataFrame, obs: DataFrame, sides: list[str], max_lag: int, heavy: bool | None, snap: str | None,
            names: list[str], show: Shown | None, folds: dict[str, str] | None, unix: dict[str, str]) -> DataFrame:
    """``_by_lag`` of the legs with the observations at the named sides."""
    table = None if folds is not None else _heavy_table(obs, heavy, snap)
    index = observation_index(obs, max_lag, heavy=table, snap=snap, columns=names, folds=folds, show=show)
    parts = None if table is None else _window_parts(table, max_lag)
    joined = legs
    for side in sides:
        tag, airport, instant, _, _ = _SIDES[side]
        joined = _attach(joined, index, airport, instant, tag, max_lag, snap, parts)
    return _by_lag(joined, legs, [(_SIDES[x][0], _SIDES[x][2], _SIDES[x][3]) for x in sides], max_lag, show, unix)


def lag_join_long(legs: DataFrame, obs: DataFrame, max_lag: int = MAX_LAG_HOURS,
                  heavy: bool | None = None, snap: str | None = None,
                  columns: list[str] | None = None, show: Shown | None = None,
                  folds: dict[str, str] | None = None) -> DataFrame:
    """Long layout: one row per leg, lag and matching observation pair.

    Row multiplicity equals two chained left joins of the exploded legs:
    per leg and lag, max(1, origin matches) x max(1, destination matches).
    The rows are generated after the joins, within the same stage.

    ``snap="hour"`` matches instants truncated to the hour on both sides
    (off by default: exact instants). ``heavy`` selects the plan for
    instants holding more than
    ``MAX_LIST_PER_INSTANT`` observations; None checks the observations
    first (one narrow aggregation). Without heavy instants every index
    entry is a bounded list and the rows come from one pass; with them,
    a leg is joined with each part of the windows it looks into, so no
    observation list grows without bound. ``columns`` names
    the observation columns of the result (default: all); others aren't shuffled.

    ``show`` gives the columns of a schema as SQL text: the result is that of
    showing the finished rows, but each leg, lag and observation is shown once
    and not in every row. ``folds`` gives the folded layout instead: one row per
    leg and lag, for each endpoint the number of matches (``MATCHES``, 0 if none) and
    the SQL aggregates named over the matching observations (null if none), suffixed
    like columns. It grows with the legs, not with the pairs.
    """
    _check_lag(max_lag)
    _check_snap(snap)
    names = _observation_columns(obs, columns)
    unix = {"FT_ORIGIN_UNIX_TS": f"unix_timestamp({bq(LEG_DEPARTURE)})", "FT_DEST_UNIX_TS": f"unix_timestamp({bq(LEG_ARRIVAL)})"}
    rows = _joined(legs, obs, ["origin", "dest"], max_lag, heavy, snap, names, show, folds, unix)
    if folds is None:
        return _listed(rows, [("o", ORIGIN_SUFFIX), ("d", DEST_SUFFIX)], names)
    values = [e for tag, suffix in (("o", ORIGIN_SUFFIX), ("d", DEST_SUFFIX)) for e in (
        f"coalesce(_{tag}._matches, 0L) AS {MATCHES + suffix}", *(f"_{tag}.{bq(n)} AS {bq(n + suffix)}" for n in folds))]
    return rows.selectExpr(*[bq(c) for c in rows.columns[:-2]], *values)


def lag_join_side(legs: DataFrame, obs: DataFrame, side: str = "origin",
                  max_lag: int = MAX_LAG_HOURS, heavy: bool | None = None,
                  snap: str | None = None, columns: list[str] | None = None, show: Shown | None = None) -> DataFrame:
    """One endpoint only: legs x lags left-joined with that endpoint's
    observations (suffix _ORIG or _DEST); ``heavy``, ``columns`` and ``show`` as in
    ``lag_join_long``."""
    _check_lag(max_lag)
    if side not in ("origin", "dest"):
        raise ValueError(f"side must be 'origin' or 'dest', got {side!r}")
    _check_snap(snap)
    names = _observation_columns(obs, columns)
    rows = _joined(legs, obs, [side], max_lag, heavy, snap, names, show, None, {})
    return _listed(rows, [(_SIDES[side][0], _SIDES[side][4])], names)


def lag_join_long_exploded(legs: DataFrame, obs: DataFrame, max_lag: int = MAX_LAG_HOURS) -> DataFrame:
    """The same long layout by the textbook plan (explode legs, two left
    joins). Kept as an executable definition for tests and comparison."""
    lagged = leg_lags(legs, max_lag)
    o = obs.toDF(*[c + ORIGIN_SUFFIX for c in obs.columns])
    d = obs.toDF(*[c + DEST_SUFFIX for c in obs.columns])
    out = lagged.join(o, (F.col("FT_ORIGIN_DATE_TIME_LAG") == F.col(OBS_INSTANT + ORIGIN_SUFFIX))
                      & (F.col(LEG_ORIGIN) == F.col(OBS_AIRPORT + ORIGIN_SUFFIX)), "left")
    return out.join(d, (F.col("FT_DEST_DATE_TIME_LAG") == F.col(OBS_INSTANT + DEST_SUFFIX))
                    & (F.col(LEG_DEST) == F.col(OBS_AIRPORT + DEST_SUFFIX)), "left")


# --------------------------------------------------------------------------
# Wide layout
# --------------------------------------------------------------------------

def _observation_columns(obs: DataFrame, columns: list[str] | None) -> list[str]:
    names = list(obs.columns if columns is None else columns)
    missing = [c for c in names if c not in obs.columns]
    if missing:
        raise ValueError(f"unknown observation columns: {missing}")
    if not names:
        raise ValueError("name one observation column at least")
    return names


def wide_columns(obs: DataFrame, columns: list[str] | None = None) -> tuple[list[str], list[str]]:
    """Observation columns repeated per lag: (origin side, destination side)."""
    if columns is not None:
        names = _observation_columns(obs, columns)
        return names, names
    return [c for c in obs.columns if c not in WIDE_ORIGIN_DROP], list(obs.columns)


def lag_join_wide(legs: DataFrame, obs: DataFrame, max_lag: int = MAX_LAG_HOURS,
                  columns: list[str] | None = None, dedup_by: str | None = None,
                  snap: str | None = None) -> DataFrame:
    """Wide layout, keyed by airport: one row per leg, observation columns
    ``<c>_Part_<h>`` (origin) and ``<c>_Dest_Part_<h>`` (destination).

    Observations are first reduced to one per (airport, instant), so the
    result equals 2 x (max_lag + 1) chained keyed left joins over the
    de-duplicated observations, with exactly as many rows as legs.
    """
    o_cols, d_cols = wide_columns(obs, columns)
    _check_snap(snap)
    index = observation_index(obs, max_lag, dedup_by, dedup=True, snap=snap, columns=d_cols)
    joined = _attach(_attach(legs, index, LEG_ORIGIN, LEG_DEPARTURE, "o", max_lag, snap),
                     index, LEG_DEST, LEG_ARRIVAL, "d", max_lag, snap)
    keep = [bq(c) for c in legs.columns]
    lags = range(max_lag + 1)
    # one map lookup per lag and side; the field projections read its result
    looked = joined.selectExpr(*keep, *[f"{_lookup('o', h)} AS _o{h}" for h in lags],
                               *[f"{_lookup('d', h)} AS _d{h}" for h in lags])
    out = list(keep)
    for h in lags:
        out += [f"_o{h}.{bq(c)} AS {bq(f'{c}_Part_{h}')}" for c in o_cols]
        out += [f"_d{h}.{bq(c)} AS {bq(f'{c}_Dest_Part_{h}')}" for c in d_cols]
    return looked.selectExpr(*out)


def lag_join(legs: DataFrame, obs: DataFrame, layout: str = "long", max_lag: int = MAX_LAG_HOURS,
             snap: str | None = None, **wide) -> DataFrame:
    """Choose the layout by name: ``long`` or ``wide``. What else is given
    goes to the wide layout; the long one takes nothing more."""
    if layout == "long":
        if wide:
            raise TypeError(f"the long layout doesn't take {', '.join(sorted(wide))}")
        return lag_join_long(legs, obs, max_lag, snap=snap)
    if layout == "wide":
        return lag_join_wide(legs, obs, max_lag, snap=snap, **wide)
    raise ValueError(f"invalid layout {layout!r}: accepted values are 'long' or 'wide'")
