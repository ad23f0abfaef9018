"""Equivalent DuckDB SQL for the registered queries.

Written independently of the Spark plans: the textbook forms (explode the
legs, chained left joins, window ranks) over the same fixture derivation.
Column kinds: s text, i int, l bigint, d double, D date, T timestamp,
b boolean. Dates and instants are compared as text, doubles rounded to 4.
"""

from __future__ import annotations

MAX_LAG = 11

# ------------------------------------------------------------- fixtures
STATIONS = """stations AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS AirportID,
         lpad(CAST(n_nationkey + 100 AS VARCHAR), 5, '0') AS WBAN,
         CAST(-4 - n_regionkey AS VARCHAR) AS TimeZone,
         CAST(-4 - n_regionkey AS INTEGER) AS tz_hours
  FROM nation)"""

LEGS_RAW = """legs_raw AS (
  SELECT strftime(ts, '%Y-%m-%d') AS FL_DATE,
         CAST(user_id % 25 AS VARCHAR) AS ORIGIN_AIRPORT_ID,
         CAST((user_id * 7 + event_id) % 25 AS VARCHAR) AS DEST_AIRPORT_ID,
         CAST(hour(ts) * 100 + minute(ts) AS VARCHAR) AS CRS_DEP_TIME,
         CAST(CASE WHEN event_id % 11 = 0 THEN NULL ELSE value END AS VARCHAR) AS ARR_DELAY_NEW,
         CASE WHEN event_type = 'error' THEN '1.00' ELSE '0.00' END AS CANCELLED,
         CASE WHEN event_id % 50 = 0 THEN '1.00' ELSE '0.00' END AS DIVERTED,
         CAST(CAST(30 + event_id % 300 AS DOUBLE) AS VARCHAR) AS CRS_ELAPSED_TIME,
         event_id
  FROM events)"""

_HHMM = "lpad(CAST(CAST(trunc(TRY_CAST(CRS_DEP_TIME AS DOUBLE)) AS INTEGER) AS VARCHAR), 4, '0')"

LEGS_TYPED = f"""legs_typed0 AS (
  SELECT CAST(TRY_STRPTIME(FL_DATE, '%Y-%m-%d') AS DATE) AS FL_DATE,
         ORIGIN_AIRPORT_ID, DEST_AIRPORT_ID,
         substr({_HHMM}, 1, 2) || ':' || substr({_HHMM}, 3, 2) AS CRS_DEP_TIME,
         TRY_CAST(ARR_DELAY_NEW AS DOUBLE) AS ARR_DELAY_NEW,
         CAST(trunc(TRY_CAST(CANCELLED AS DOUBLE)) AS INTEGER) AS CANCELLED,
         CAST(trunc(TRY_CAST(DIVERTED AS DOUBLE)) AS INTEGER) AS DIVERTED,
         TRY_CAST(CRS_ELAPSED_TIME AS DOUBLE) AS CRS_ELAPSED_TIME,
         event_id
  FROM legs_raw),
legs_typed AS (
  SELECT *, TRY_STRPTIME(CAST(FL_DATE AS VARCHAR) || ' ' || CRS_DEP_TIME, '%Y-%m-%d %H:%M') AS "TIMESTAMP"
  FROM legs_typed0)"""

LEGS_PREPARED = """legs_prepared AS (
  SELECT l.FL_DATE AS FT_FL_DATE, l.ORIGIN_AIRPORT_ID AS FT_ORIGIN_AIRPORT_ID,
         l.DEST_AIRPORT_ID AS FT_DEST_AIRPORT_ID, l.CRS_DEP_TIME AS FT_CRS_DEP_TIME,
         COALESCE(CASE WHEN isnan(l.ARR_DELAY_NEW) THEN NULL ELSE l.ARR_DELAY_NEW END, 0.0) AS FT_ARR_DELAY_NEW,
         l.CRS_ELAPSED_TIME AS FT_CRS_ELAPSED_TIME, l.event_id AS FT_event_id,
         l."TIMESTAMP" AS FT_TIMESTAMP, d.AirportID AS FT_AirportID, d.WBAN AS FT_WBAN,
         CAST(d.tz_hours - o.tz_hours AS INTEGER) AS FT_Delta_Lag
  FROM legs_typed l
  JOIN stations o ON l.ORIGIN_AIRPORT_ID = o.AirportID
  JOIN stations d ON l.DEST_AIRPORT_ID = d.AirportID
  WHERE l.DIVERTED <> 1 AND l.CANCELLED <> 1)"""

LEGS_MAPPED = """legs_mapped0 AS (
  SELECT *, FT_TIMESTAMP + to_seconds(CAST(trunc(FT_CRS_ELAPSED_TIME * 60) AS BIGINT)
                                      + CAST(FT_Delta_Lag AS BIGINT) * 3600) AS FT_DEST_DATE_TIME
  FROM legs_prepared),
legs_mapped AS (
  SELECT *, FT_ORIGIN_AIRPORT_ID || '_' || CAST(FT_FL_DATE AS VARCHAR) AS FT_JOIN_KEY_ORIGIN,
            FT_DEST_AIRPORT_ID || '_' || CAST(FT_DEST_DATE_TIME AS VARCHAR) AS FT_JOIN_KEY_DEST
  FROM legs_mapped0)"""


def obs_raw(dup: bool = False, name: str = "obs_raw") -> str:
    station = "(event_id - event_id % 7)" if dup else "event_id"
    return f"""{name} AS (
  SELECT CAST({station} % 25 + 100 AS VARCHAR) AS WBAN, strftime(ts, '%Y-%m-%d') AS Date,
         CAST(hour(ts) * 100 + minute(ts) AS VARCHAR) AS Time,
         CAST(CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS VARCHAR) AS Visibility,
         event_id AS oid
  FROM events)"""


def obs_prepared(src: str = "obs_raw", name: str = "obs_prepared") -> str:
    return f"""{name}0 AS (
  SELECT s.WBAN AS OT_WBAN, CAST(TRY_STRPTIME(o.Date, '%Y-%m-%d') AS DATE) AS OT_Date,
         lpad(o.Time, 4, '0') AS OT_Time, TRY_CAST(o.Visibility AS DOUBLE) AS OT_Visibility,
         o.oid AS OT_oid, s.AirportID AS OT_ORIGIN_AIRPORT_ID, s.TimeZone AS OT_TimeZone
  FROM {src} o JOIN stations s ON CASE WHEN length(trim(o.WBAN)) < 5 THEN lpad(trim(o.WBAN), 5, '0') ELSE trim(o.WBAN) END = s.WBAN),
{name} AS (
  SELECT *, TRY_STRPTIME(CAST(OT_Date AS VARCHAR) || ' ' || OT_Time, '%Y-%m-%d %H%M') AS OT_WEATHER_TIMESTAMP
  FROM {name}0)"""


def obs_mapped(src: str = "obs_prepared", name: str = "obs_mapped") -> str:
    return f"""{name} AS (
  SELECT *, OT_ORIGIN_AIRPORT_ID || '_' || CAST(OT_Date AS VARCHAR) AS OT_JOIN_KEY FROM {src})"""


LEGS_LAGGED = f"""legs_lagged0 AS (
  SELECT *, CAST(epoch(FT_TIMESTAMP) AS BIGINT) AS FT_ORIGIN_UNIX_TS,
            CAST(epoch(FT_DEST_DATE_TIME) AS BIGINT) AS FT_DEST_UNIX_TS,
            CAST(unnest(generate_series(0, {MAX_LAG})) AS INTEGER) AS hours_lag
  FROM legs_mapped),
legs_lagged AS (
  SELECT *, FT_TIMESTAMP - to_hours(hours_lag) AS FT_ORIGIN_DATE_TIME_LAG,
            FT_DEST_DATE_TIME - to_hours(hours_lag) AS FT_DEST_DATE_TIME_LAG
  FROM legs_lagged0)"""

# ------------------------------------------------------------- columns
C_LEGS_RAW = [("FL_DATE", "s"), ("ORIGIN_AIRPORT_ID", "s"), ("DEST_AIRPORT_ID", "s"),
              ("CRS_DEP_TIME", "s"), ("ARR_DELAY_NEW", "s"), ("CANCELLED", "s"), ("DIVERTED", "s"),
              ("CRS_ELAPSED_TIME", "s"), ("event_id", "l")]
C_LEGS_TYPED = [("FL_DATE", "D"), ("ORIGIN_AIRPORT_ID", "s"), ("DEST_AIRPORT_ID", "s"),
                ("CRS_DEP_TIME", "s"), ("ARR_DELAY_NEW", "d"), ("CANCELLED", "i"), ("DIVERTED", "i"),
                ("CRS_ELAPSED_TIME", "d"), ("event_id", "l"), ("TIMESTAMP", "T")]
C_LEGS = [("FT_FL_DATE", "D"), ("FT_ORIGIN_AIRPORT_ID", "s"), ("FT_DEST_AIRPORT_ID", "s"),
          ("FT_CRS_DEP_TIME", "s"), ("FT_ARR_DELAY_NEW", "d"), ("FT_CRS_ELAPSED_TIME", "d"),
          ("FT_event_id", "l"), ("FT_TIMESTAMP", "T"), ("FT_AirportID", "s"), ("FT_WBAN", "s"),
          ("FT_Delta_Lag", "i")]
C_LEGS_MAPPED = C_LEGS + [("FT_DEST_DATE_TIME", "T"), ("FT_JOIN_KEY_ORIGIN", "s"), ("FT_JOIN_KEY_DEST", "s")]
C_OBS_RAW = [("WBAN", "s"), ("Date", "s"), ("Time", "s"), ("Visibility", "s"), ("oid", "l")]
C_OBS = [("OT_WBAN", "s"), ("OT_Date", "D"), ("OT_Time", "s"), ("OT_Visibility", "d"), ("OT_oid", "l"),
         ("OT_ORIGIN_AIRPORT_ID", "s"), ("OT_TimeZone", "s"), ("OT_WEATHER_TIMESTAMP", "T")]
C_OBS_MAPPED = C_OBS + [("OT_JOIN_KEY", "s")]
C_LAG_EXTRA = [("FT_ORIGIN_UNIX_TS", "l"), ("FT_DEST_UNIX_TS", "l"), ("hours_lag", "i"),
               ("FT_ORIGIN_DATE_TIME_LAG", "T"), ("FT_DEST_DATE_TIME_LAG", "T")]
C_LEGS_LAGGED = C_LEGS_MAPPED + C_LAG_EXTRA
C_LONG = (C_LEGS_LAGGED + [(c + "_ORIG", k) for c, k in C_OBS_MAPPED]
          + [(c + "_DEST", k) for c, k in C_OBS_MAPPED])
WIDE_ORIGIN_DROP = {"OT_WBAN", "OT_JOIN_KEY", "OT_Date", "OT_Time"}


def q(name: str) -> str:
    return '"' + name + '"'


def fmt(expr: str, kind: str) -> str:
    if kind == "D":
        return f"strftime({expr}, '%Y-%m-%d')"
    if kind == "T":
        return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
    if kind == "d":
        return f"round({expr}, 4)"
    return expr


def present(cols, src: str, alias: str | None = None, where: str = "") -> str:
    pre = f"{alias}." if alias else ""
    items = ",\n       ".join(f"{fmt(pre + q(c), k)} AS {q(c)}" for c, k in cols)
    return f"SELECT {items}\nFROM {src}{(' ' + alias) if alias else ''}{(' WHERE ' + where) if where else ''}"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


BASE_LEGS = (STATIONS, LEGS_RAW, LEGS_TYPED, LEGS_PREPARED)
BASE_MAPPED = BASE_LEGS + (LEGS_MAPPED,)
BASE_OBS = (obs_raw(), obs_prepared(), obs_mapped())


def long_cte(obs: str = "obs_mapped", name: str = "long", snap: bool = False) -> str:
    o = ", ".join(f"o.{q(c)} AS {q(c + '_ORIG')}" for c, _ in C_OBS_MAPPED)
    d = ", ".join(f"d.{q(c)} AS {q(c + '_DEST')}" for c, _ in C_OBS_MAPPED)
    t = (lambda e: f"date_trunc('hour', {e})") if snap else (lambda e: e)
    return f"""{name} AS (
  SELECT l.*, {o}, {d}
  FROM legs_lagged l
  LEFT JOIN {obs} o ON l.FT_ORIGIN_AIRPORT_ID = o.OT_ORIGIN_AIRPORT_ID
                   AND {t('l.FT_ORIGIN_DATE_TIME_LAG')} = {t('o.OT_WEATHER_TIMESTAMP')}
  LEFT JOIN {obs} d ON l.FT_DEST_AIRPORT_ID = d.OT_ORIGIN_AIRPORT_ID
                   AND {t('l.FT_DEST_DATE_TIME_LAG')} = {t('d.OT_WEATHER_TIMESTAMP')})"""


BASE_LONG = BASE_MAPPED + BASE_OBS + (LEGS_LAGGED, long_cte())


def _numeric(cols):
    return [(c, k) for c, k in cols if k in ("i", "d")]


def wide_sql(keyed: bool, max_lag: int, obs_ctes, dedup: bool, obs: str = "obs_mapped") -> str:
    origin = [(c, k) for c, k in C_OBS_MAPPED if c not in WIDE_ORIGIN_DROP]
    dest = list(C_OBS_MAPPED)
    ctes = list(BASE_MAPPED) + list(obs_ctes)
    src = obs
    if dedup:
        ctes.append(f"""obs_one AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY OT_ORIGIN_AIRPORT_ID, OT_WEATHER_TIMESTAMP ORDER BY OT_oid) AS rn
    FROM {obs} WHERE OT_WEATHER_TIMESTAMP IS NOT NULL) WHERE rn = 1)""")
        src = "obs_one"
    joins, cols = [], [(f"l.{q(c)}", c, k) for c, k in C_LEGS_MAPPED]
    for h in range(max_lag + 1):
        for side, tcol, acol, keep, tag in (
                ("o", "FT_TIMESTAMP", "FT_ORIGIN_AIRPORT_ID", origin, "_Part_"),
                ("d", "FT_DEST_DATE_TIME", "FT_DEST_AIRPORT_ID", dest, "_Dest_Part_")):
            a = f"{side}{h}"
            cond = f"l.{tcol} - to_hours({h}) = {a}.OT_WEATHER_TIMESTAMP"
            if keyed:
                cond += f" AND l.{acol} = {a}.OT_ORIGIN_AIRPORT_ID"
            joins.append(f"LEFT JOIN {src} {a} ON {cond}")
            cols += [(f"{a}.{q(c)}", f"{c}{tag}{h}", k) for c, k in keep]
    items = ",\n       ".join(f"{fmt(e, k)} AS {q(n)}" for e, n, k in cols)
    return with_(*ctes) + f"SELECT {items}\nFROM legs_mapped l\n" + "\n".join(joins)


def side_sql(side: str) -> str:
    suffix = "_ORIG" if side == "origin" else "_DEST"
    lag_col = "FT_ORIGIN_DATE_TIME_LAG" if side == "origin" else "FT_DEST_DATE_TIME_LAG"
    airport = "FT_ORIGIN_AIRPORT_ID" if side == "origin" else "FT_DEST_AIRPORT_ID"
    cols = C_LEGS_MAPPED + [("hours_lag", "i"), (lag_col, "T")] + [(c + suffix, k) for c, k in C_OBS_MAPPED]
    o = ", ".join(f"o.{q(c)} AS {q(c + suffix)}" for c, _ in C_OBS_MAPPED)
    cte = f"""side AS (
  SELECT l.*, {o} FROM legs_lagged l
  LEFT JOIN obs_mapped o ON l.{airport} = o.OT_ORIGIN_AIRPORT_ID AND l.{lag_col} = o.OT_WEATHER_TIMESTAMP)"""
    return with_(*BASE_MAPPED, *BASE_OBS, LEGS_LAGGED, cte) + present(cols, "side")


def bucket(expr: str) -> str:
    """pmod(pmod(key, 1000003) * 7919 + 13, 100), with SQL's signed modulo."""
    inner = f"((({expr}) % 1000003 + 1000003) % 1000003)"
    return f"((({inner} * 7919 + 13) % 100 + 100) % 100)"


def profile_sql(cols, src: str, nan_as_missing: bool, extra_where=None) -> str:
    """Rows (position, column_name, n_missing, ...) via UNION ALL."""
    parts = []
    for i, (c, k) in enumerate(cols):
        if nan_as_missing:
            miss = f"{q(c)} IS NULL" + (f" OR isnan({q(c)})" if k == "d" else "")
        else:
            miss = f"{q(c)} IS NULL" + (f" OR {q(c)} = ''" if k == "s" else "")
        parts.append(f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS column_name, "
                     f"count(*) AS n_rows, count(*) FILTER (WHERE {miss}) AS n_missing FROM {src}")
    return "\nUNION ALL\n".join(parts)


def oracles() -> dict[str, str]:
    s: dict[str, str] = {}
    s["prepare_legs"] = with_(*BASE_LEGS) + present(C_LEGS, "legs_prepared")
    s["prepare_observations"] = with_(STATIONS, obs_raw(), obs_prepared()) + present(C_OBS, "obs_prepared")
    s["cast_legs"] = with_(STATIONS, LEGS_RAW, LEGS_TYPED) + present(C_LEGS_TYPED, "legs_typed")
    s["leg_losses"] = with_(STATIONS, LEGS_RAW, LEGS_TYPED, """f AS (
  SELECT l.*, COALESCE(l.DIVERTED <> 1 AND l.CANCELLED <> 1, false) AS done,
         o.AirportID AS o_known, d.AirportID AS d_known
  FROM legs_typed l
  LEFT JOIN stations o ON l.ORIGIN_AIRPORT_ID = o.AirportID
  LEFT JOIN stations d ON l.DEST_AIRPORT_ID = d.AirportID)""") + (
        "SELECT count(*) AS n_legs, count(*) FILTER (WHERE NOT done) AS n_not_completed, "
        "count(*) FILTER (WHERE done AND o_known IS NULL) AS n_unknown_origin, "
        "count(*) FILTER (WHERE done AND d_known IS NULL) AS n_unknown_dest, "
        "count(*) FILTER (WHERE done AND o_known IS NOT NULL AND d_known IS NOT NULL) AS n_kept FROM f")
    s["cast_measures"] = with_(obs_raw()) + (
        "SELECT WBAN, Date, Time, round(TRY_CAST(Visibility AS DOUBLE), 4) AS Visibility, oid FROM obs_raw")
    s["completed_legs"] = with_(LEGS_RAW, LEGS_TYPED) + present(
        C_LEGS_TYPED, "legs_typed", where="DIVERTED <> 1 AND CANCELLED <> 1")
    s["zero_fill"] = with_(LEGS_RAW, LEGS_TYPED) + (
        "SELECT event_id, round(COALESCE(CASE WHEN isnan(ARR_DELAY_NEW) THEN NULL ELSE ARR_DELAY_NEW END, 0.0), 4)"
        " AS ARR_DELAY_NEW FROM legs_typed")
    s["on_time_label"] = with_(*BASE_LEGS) + (
        "SELECT FT_event_id, round(FT_ARR_DELAY_NEW, 4) AS FT_ARR_DELAY_NEW, "
        "CASE WHEN FT_ARR_DELAY_NEW <= 15.0 THEN 1 ELSE 0 END AS FT_OnTime FROM legs_prepared")
    s["prefix_columns"] = with_(obs_raw()) + (
        "SELECT WBAN AS OT_WBAN, Date AS OT_Date, Time AS OT_Time, Visibility AS OT_Visibility, oid AS OT_oid "
        "FROM obs_raw")
    s["suffix_columns"] = with_(STATIONS, obs_raw(), obs_prepared()) + (
        "SELECT " + ", ".join(f"{fmt(q(c), k)} AS {q(c + '_ORIG')}" for c, k in C_OBS) + " FROM obs_prepared")
    s["time_of_day"] = with_(LEGS_RAW) + (
        f"SELECT event_id, CRS_DEP_TIME, {_HHMM} AS padded, "
        f"substr({_HHMM}, 1, 2) || ':' || substr({_HHMM}, 3, 2) AS time_of_day FROM legs_raw")
    s["parse_dates"] = with_(LEGS_RAW) + (
        "SELECT event_id, FL_DATE, strftime(CAST(TRY_STRPTIME(FL_DATE, '%Y-%m-%d') AS DATE), '%Y-%m-%d') "
        "AS flight_date FROM legs_raw")
    s["parse_instants"] = with_(STATIONS, LEGS_RAW, LEGS_TYPED, obs_raw(), obs_prepared()) + (
        "SELECT event_id AS id, 'departure' AS kind, strftime(\"TIMESTAMP\", '%Y-%m-%d %H:%M:%S') AS instant "
        "FROM legs_typed UNION ALL "
        "SELECT OT_oid AS id, 'observation' AS kind, strftime(OT_WEATHER_TIMESTAMP, '%Y-%m-%d %H:%M:%S') "
        "AS instant FROM obs_prepared")
    s["epoch_seconds"] = with_(*BASE_LEGS) + (
        "SELECT FT_event_id, CAST(epoch(FT_TIMESTAMP) AS BIGINT) AS departure_seconds, "
        "CAST(epoch(CAST(FT_FL_DATE AS TIMESTAMP)) AS BIGINT) AS date_seconds FROM legs_prepared")
    s["arrival_instant"] = with_(*BASE_MAPPED) + present(
        [("FT_event_id", "l"), ("FT_TIMESTAMP", "T"), ("FT_CRS_ELAPSED_TIME", "d"), ("FT_Delta_Lag", "i"),
         ("FT_DEST_DATE_TIME", "T")], "legs_mapped")
    s["zone_delta"] = with_(*BASE_LEGS) + (
        "SELECT FT_event_id, FT_ORIGIN_AIRPORT_ID, FT_DEST_AIRPORT_ID, FT_Delta_Lag FROM legs_prepared")
    s["join_keys"] = with_(*BASE_MAPPED, *BASE_OBS) + (
        "SELECT FT_event_id AS id, 'origin' AS kind, FT_JOIN_KEY_ORIGIN AS join_key FROM legs_mapped UNION ALL "
        "SELECT FT_event_id AS id, 'dest' AS kind, FT_JOIN_KEY_DEST AS join_key FROM legs_mapped UNION ALL "
        "SELECT OT_oid AS id, 'observation' AS kind, OT_JOIN_KEY AS join_key FROM obs_mapped")
    s["lag_instants"] = with_(*BASE_MAPPED, LEGS_LAGGED) + present(
        [("FT_event_id", "l"), ("hours_lag", "i"), ("FT_ORIGIN_DATE_TIME_LAG", "T"),
         ("FT_DEST_DATE_TIME_LAG", "T")], "legs_lagged")
    s["origin_station_join"] = with_(STATIONS, LEGS_RAW, LEGS_TYPED) + (
        "SELECT l.event_id, l.ORIGIN_AIRPORT_ID, s.tz_hours AS ORIGIN_TIME_ZONE "
        "FROM legs_typed l JOIN stations s ON l.ORIGIN_AIRPORT_ID = s.AirportID")
    s["dest_station_join"] = with_(STATIONS, LEGS_RAW, LEGS_TYPED) + (
        "SELECT l.event_id, l.DEST_AIRPORT_ID, s.AirportID, s.WBAN, s.tz_hours AS DEST_TIME_ZONE "
        "FROM legs_typed l JOIN stations s ON l.DEST_AIRPORT_ID = s.AirportID")
    s["obs_station_join"] = with_(STATIONS, obs_raw(), obs_prepared()) + (
        "SELECT OT_oid, OT_WBAN, OT_ORIGIN_AIRPORT_ID, OT_TimeZone FROM obs_prepared")
    s["leg_lags"] = with_(*BASE_MAPPED, LEGS_LAGGED) + present(C_LEGS_LAGGED, "legs_lagged")
    s["lag_join_origin"] = side_sql("origin")
    s["lag_join_dest"] = side_sql("dest")
    s["lag_join_long"] = with_(*BASE_LONG) + present(C_LONG, "long")
    s["lag_join_long_dup"] = with_(*BASE_MAPPED, obs_raw(True), obs_prepared(), obs_mapped(),
                                   LEGS_LAGGED, long_cte()) + present(C_LONG, "long")
    s["lag_join_wide"] = wide_sql(True, MAX_LAG, (obs_raw(True), obs_prepared(), obs_mapped()), dedup=True)
    s["lag_match_profile"] = with_(*BASE_LONG) + (
        "SELECT hours_lag, count(*) AS n_rows, count(OT_WEATHER_TIMESTAMP_ORIG) AS origin_matches, "
        "count(OT_WEATHER_TIMESTAMP_DEST) AS dest_matches, round(avg(OT_Visibility_ORIG), 4) AS origin_visibility, "
        "round(avg(OT_Visibility_DEST), 4) AS dest_visibility FROM long GROUP BY hours_lag")
    s["lag_match_profile_snapped"] = with_(*BASE_MAPPED, *BASE_OBS, LEGS_LAGGED, long_cte(snap=True)) + (
        "SELECT hours_lag, count(*) AS n_rows, count(OT_WEATHER_TIMESTAMP_ORIG) AS origin_matches, "
        "count(OT_WEATHER_TIMESTAMP_DEST) AS dest_matches, round(avg(OT_Visibility_ORIG), 4) AS origin_visibility, "
        "round(avg(OT_Visibility_DEST), 4) AS dest_visibility FROM long GROUP BY hours_lag")
    s["row_count"] = with_(*BASE_LONG) + (
        "SELECT 'legs_raw' AS table_name, count(*) AS n_rows FROM legs_raw UNION ALL "
        "SELECT 'legs', count(*) FROM legs_prepared UNION ALL "
        "SELECT 'observations', count(*) FROM obs_prepared UNION ALL "
        "SELECT 'lag_join_long', count(*) FROM long")
    dup = BASE_MAPPED + (obs_raw(True), obs_prepared(), obs_mapped())
    ends = {"_ORIG": ("FT_ORIGIN_AIRPORT_ID", "FT_TIMESTAMP"), "_DEST": ("FT_DEST_AIRPORT_ID", "FT_DEST_DATE_TIME")}
    asof_cols, joins, asof_raw = [("OT_WEATHER_TIMESTAMP", "T"), ("OT_Visibility", "d"), ("OT_oid", "l")], "", []
    for tail, (airport, at) in ends.items():
        joins += (f" ASOF LEFT JOIN obs_one o{tail} ON l.{airport} = o{tail}.OT_ORIGIN_AIRPORT_ID"
                  f" AND l.{at} >= o{tail}.OT_WEATHER_TIMESTAMP")
        near = f"l.{at} <= o{tail}.OT_WEATHER_TIMESTAMP + INTERVAL 12 HOURS"
        asof_raw += [f"CASE WHEN {near} THEN o{tail}.{c} END AS {q(c + tail)}" for c, k in asof_cols]
        asof_raw.append(f"CASE WHEN {near} THEN CAST(epoch(l.{at}) - epoch(o{tail}.OT_WEATHER_TIMESTAMP) AS BIGINT) END"
                        f" AS observation_age{tail}")
    all_asof = [*C_LEGS_MAPPED, *[x for t in ends for x in (*((c + t, k) for c, k in asof_cols), ("observation_age" + t, "l"))]]
    leg_out = [f"{fmt('l.' + q(c), k)} AS {q(c)}" for c, k in C_LEGS_MAPPED]
    asof_ctes = with_(*dup, """obs_one AS (
  SELECT * FROM obs_mapped WHERE OT_WEATHER_TIMESTAMP IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY OT_ORIGIN_AIRPORT_ID, OT_WEATHER_TIMESTAMP ORDER BY OT_oid) = 1)""",
        "joined AS (SELECT " + ", ".join(["l.*", *asof_raw]) + " FROM legs_mapped l" + joins + ")")
    s["lag_join_asof"] = asof_ctes + present(all_asof, "joined")
    clean_value = "CASE WHEN isnan({0}) THEN NULL ELSE {0} END"
    imputed = [f"round(COALESCE({v}, (SELECT avg({v}) FROM joined)), 4) AS {c}" if (v := clean_value.format(c)) and "Visibility" in c
               else f"{fmt(q(c), k)} AS {q(c)}" for c, k in all_asof]
    # a fifth of the values may be missing for a column to be imputed; those of this table miss less
    s["training_table_asof"] = asof_ctes.replace("INTERVAL 12 HOURS", "INTERVAL 336 HOURS") + (
        "SELECT " + ", ".join(imputed) + ", CASE WHEN FT_ARR_DELAY_NEW <= 15.0 THEN 1 ELSE 0 END AS FT_OnTime FROM joined")
    value = "CASE WHEN isnan(o.OT_Visibility) THEN NULL ELSE o.OT_Visibility END"
    stats = [f"""stats{tail} AS (
  SELECT l.FT_event_id AS id, count(o.OT_oid) AS observations, count({value}) AS n, avg({value}) AS mean
  FROM legs_mapped l LEFT JOIN obs_mapped o ON l.{airport} = o.OT_ORIGIN_AIRPORT_ID
   AND o.OT_WEATHER_TIMESTAMP BETWEEN l.{at} - INTERVAL 11 HOURS AND l.{at} GROUP BY l.FT_event_id)"""
             for tail, (airport, at) in ends.items()]
    s["lag_range_stats"] = with_(*dup, *stats) + (
        "SELECT " + ", ".join(leg_out + [f"s{t}.observations AS observations{t}, s{t}.n AS values{t}, "
                                         f"round(s{t}.mean, 9) AS mean{t}" for t in ends])
        + " FROM legs_mapped l" + "".join(f" JOIN stats{t} s{t} ON s{t}.id = l.FT_event_id" for t in ends))
    rolled = ", ".join(
        f"round(min(low) OVER w{h}, 9) AS min_{h}h, "
        f"round(CASE WHEN sum(n) OVER w{h} > 0 THEN sum(total) OVER w{h} / sum(n) OVER w{h} END, 9) AS mean_{h}h"
        for h in (3, 12))
    s["rolling_measures"] = with_(*dup, f"""instants AS (
  SELECT OT_ORIGIN_AIRPORT_ID, OT_WEATHER_TIMESTAMP, count(*) AS observations, count({value}) AS n,
         sum({value}) AS total, min({value}) AS low
  FROM obs_mapped o WHERE OT_WEATHER_TIMESTAMP IS NOT NULL AND OT_ORIGIN_AIRPORT_ID IS NOT NULL GROUP BY 1, 2)""") + (
        "SELECT OT_ORIGIN_AIRPORT_ID, " + fmt("OT_WEATHER_TIMESTAMP", "T") + f" AS OT_WEATHER_TIMESTAMP, observations, {rolled}"
        " FROM instants WINDOW " + ", ".join(
            f"w{h} AS (PARTITION BY OT_ORIGIN_AIRPORT_ID ORDER BY OT_WEATHER_TIMESTAMP "
            f"RANGE BETWEEN INTERVAL {h} HOURS PRECEDING AND CURRENT ROW)" for h in (3, 12)))
    hour = "date_trunc('hour', {})"
    lagged = [f"""seen{tail} AS (
  SELECT DISTINCT l.FT_event_id AS id FROM legs_mapped l, obs_mapped o, generate_series(0, {MAX_LAG}) AS g(h)
  WHERE l.{airport} = o.OT_ORIGIN_AIRPORT_ID AND {{0}} - to_hours(CAST(h AS INTEGER)) = {{1}})"""
              .format(t.format(f"l.{at}"), t.format("o.OT_WEATHER_TIMESTAMP"))
              for t in ("{}", hour) for tail, (airport, at) in ends.items()]
    present_legs = "SELECT " + ", ".join(leg_out) + " FROM legs_mapped l WHERE "
    s["legs_unobserved"] = with_(*dup, *lagged[:2]) + present_legs + (
        "FT_event_id NOT IN (SELECT id FROM seen_ORIG) AND FT_event_id NOT IN (SELECT id FROM seen_DEST)")
    s["legs_observed"] = with_(*dup, *lagged[2:]) + present_legs + (
        "FT_event_id IN (SELECT id FROM seen_ORIG) AND FT_event_id IN (SELECT id FROM seen_DEST)")
    dims = "FT_ORIGIN_AIRPORT_ID, FT_DEST_AIRPORT_ID, weekday"
    s["on_time_cube"] = with_(*BASE_LEGS, "days AS (SELECT *, CAST(isodow(FT_FL_DATE) - 1 AS INTEGER) AS weekday FROM legs_prepared)") + (
        f"SELECT {dims}, CAST(grouping_id({dims}) AS INTEGER) AS grouping_id, count(*) AS n_rows, "
        "count(*) FILTER (WHERE FT_ARR_DELAY_NEW <= 15.0) AS n_on_time, count(DISTINCT FT_FL_DATE) AS distinct_day "
        f"FROM days GROUP BY CUBE ({dims})")
    feed = ", ".join(q(c) for c, _ in C_LEGS_RAW)
    fixed = feed.replace(q("ARR_DELAY_NEW"), "CASE WHEN event_id % 40 = 1 THEN '0.0' ELSE ARR_DELAY_NEW END AS ARR_DELAY_NEW")
    delivery = ("one AS (SELECT {0} FROM legs_raw WHERE event_id % 10 <> 0 UNION ALL SELECT {0} FROM legs_raw "
                "WHERE event_id % 10 <> 0 AND event_id % 50 = 3)").format(feed)
    second = ("two AS (SELECT {0} FROM legs_raw WHERE event_id % 9 <> 0 UNION ALL SELECT {0} FROM legs_raw "
              "WHERE event_id % 9 <> 0 AND event_id % 25 = 3)").format(fixed)
    s["feed_diff"] = with_(LEGS_RAW, delivery, second,
                           f"gone AS (SELECT {feed}, count(*) AS copies FROM (FROM one EXCEPT ALL FROM two) GROUP BY ALL)",
                           f"come AS (SELECT {feed}, count(*) AS copies FROM (FROM two EXCEPT ALL FROM one) GROUP BY ALL)") + (
        f"SELECT {feed}, CASE WHEN event_id IN (SELECT event_id FROM come) THEN 'changed_from' ELSE 'removed' END AS change, copies "
        f"FROM gone UNION ALL SELECT {feed}, CASE WHEN event_id IN (SELECT event_id FROM gone) THEN 'changed_to' ELSE 'added' END, copies FROM come")
    s["observation_sessions"] = with_(*dup, """timed AS (
  SELECT OT_ORIGIN_AIRPORT_ID AS a, OT_WEATHER_TIMESTAMP AS t FROM obs_mapped
  WHERE OT_ORIGIN_AIRPORT_ID IS NOT NULL AND OT_WEATHER_TIMESTAMP IS NOT NULL)""",
        """marked AS (SELECT *, CASE WHEN t > lag(t) OVER (PARTITION BY a ORDER BY t) + INTERVAL 2 HOURS THEN 1 ELSE 0 END AS b
  FROM timed)""",
        "numbered AS (SELECT *, sum(b) OVER (PARTITION BY a ORDER BY t) AS g FROM marked)",
        "found AS (SELECT a, g, min(t) AS s, max(t) AS e, count(*) AS n FROM numbered GROUP BY a, g)") + (
        "SELECT a AS OT_ORIGIN_AIRPORT_ID, " + fmt("s", "T") + " AS session_start, " + fmt("e", "T") + " AS session_end, "
        "n AS observations, CAST(epoch(s) - epoch(lag(e) OVER (PARTITION BY a ORDER BY s)) AS BIGINT) AS outage_before FROM found")
    later = ("again AS (SELECT DISTINCT FT_FL_DATE AS d FROM legs_prepared WHERE FT_event_id % 97 = 0)",
             "read AS (SELECT DISTINCT FT_FL_DATE AS d FROM legs_prepared WHERE FT_event_id % 53 = 0)",
             "stored AS (SELECT * REPLACE (FT_ARR_DELAY_NEW + CASE WHEN FT_FL_DATE IN (SELECT d FROM again) THEN 1 ELSE 0 END "
             "AS FT_ARR_DELAY_NEW) FROM legs_prepared)")
    s["rewritten_days"] = with_(*BASE_LEGS, *later) + present(C_LEGS, "stored", where="FT_FL_DATE IN (SELECT d FROM read)")
    docs = [("doc_id", "l"), ("text", "s"), ("lang", "s"), ("source", "s"), ("n_chars", "l"),
            ("quality", "i"), ("toxic", "i")]
    dl = ("docs_labels AS (SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic "
          "FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)")
    s["missing_profile"] = with_(dl, "p AS (" + profile_sql(docs, "docs_labels", False) + ")") + (
        "SELECT position, column_name, n_rows, n_missing, "
        "round(CAST(n_missing AS DOUBLE) / n_rows, 4) AS missing_share FROM p")
    s["drop_sparse_columns"] = with_(dl) + "SELECT doc_id, text, lang, source, n_chars FROM docs_labels"
    numeric_long = _numeric(C_LONG)
    s["impute_eligible"] = with_(*BASE_LONG, "p AS (" + profile_sql(numeric_long, "long", True) + ")") + (
        "SELECT position, column_name, n_missing, round(CAST(n_missing AS DOUBLE) / n_rows, 4) AS missing_share, "
        "CAST(n_missing AS DOUBLE) / n_rows < CAST(1.0 AS DOUBLE) - CAST(0.8 AS DOUBLE) AS eligible FROM p")
    obs_imputed = [(c, k) for c, k in C_OBS]
    items = ", ".join(
        ("round(COALESCE(CASE WHEN isnan(OT_Visibility) THEN NULL ELSE OT_Visibility END, "
         "(SELECT avg(CASE WHEN isnan(OT_Visibility) THEN NULL ELSE OT_Visibility END) FROM obs_prepared)), 4)"
         " AS OT_Visibility") if c == "OT_Visibility" else f"{fmt(q(c), k)} AS {q(c)}"
        for c, k in obs_imputed)
    s["impute_mean"] = with_(STATIONS, obs_raw(), obs_prepared()) + f"SELECT {items} FROM obs_prepared"
    train_cols = C_LEGS_LAGGED + [("FT_OnTime", "i")]
    s["training_table"] = with_(*BASE_LONG, "lab AS (SELECT *, CASE WHEN FT_ARR_DELAY_NEW <= 15.0 THEN 1 ELSE 0 END"
                                " AS FT_OnTime FROM long)") + present(train_cols, "lab")
    s["training_table_wide"] = with_(*BASE_LEGS, LEGS_MAPPED) + present(
        C_LEGS_MAPPED + [("FT_OnTime", "i")],
        "(SELECT *, CASE WHEN FT_ARR_DELAY_NEW <= 15.0 THEN 1 ELSE 0 END AS FT_OnTime FROM legs_mapped)", "w")
    ci = []
    for c in ("FT_ORIGIN_AIRPORT_ID", "FT_CRS_DEP_TIME"):
        ci.append(f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n, "
                  f"row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS idx "
                  f"FROM legs_prepared WHERE {c} IS NOT NULL GROUP BY {c}")
    s["category_index"] = with_(*BASE_LEGS) + "\nUNION ALL\n".join(ci)
    s["classifier_metrics"] = with_(*BASE_LEGS, """pred AS (
  SELECT CAST(CASE WHEN FT_ARR_DELAY_NEW <= 15.0 THEN 1 ELSE 0 END AS DOUBLE) AS label,
         CASE WHEN FT_CRS_ELAPSED_TIME <= 180.0 THEN 1.0 ELSE 0.0 END AS prediction FROM legs_prepared)""",
        """conf AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2)""",
        """per AS (
  SELECT l.label, l.n_l, l.tp, COALESCE(p.pp, 0) AS pp,
         CASE WHEN COALESCE(p.pp, 0) > 0 THEN l.tp / p.pp ELSE 0.0 END AS prec,
         l.tp / l.n_l AS rec
  FROM (SELECT label, CAST(sum(n) AS DOUBLE) AS n_l,
               CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) AS tp
        FROM conf GROUP BY label) l
  LEFT JOIN (SELECT prediction, CAST(sum(n) AS DOUBLE) AS pp FROM conf GROUP BY prediction) p
    ON l.label = p.prediction)""",
        """tot AS (
  SELECT sum(n_l) AS n, sum(tp) AS tp,
         sum(n_l * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) AS wf,
         sum(n_l * rec) AS wr, sum(n_l * prec) AS wp FROM per)""") + (
        "SELECT 'accuracy' AS metric, round(tp / n, 4) AS value FROM tot UNION ALL "
        "SELECT 'f1Score', round(wf / n, 4) FROM tot UNION ALL "
        "SELECT 'recall', round(wr / n, 4) FROM tot UNION ALL "
        "SELECT 'precision', round(wp / n, 4) FROM tot")
    s["csv_scan"] = with_(STATIONS, LEGS_RAW, LEGS_TYPED) + present(C_LEGS_TYPED, "legs_typed")
    s["csv_round_trip"] = s["prepare_legs"]
    s["sample_by_key"] = with_(*BASE_LEGS) + present(
        C_LEGS, "legs_prepared", where=bucket("datediff('day', DATE '1970-01-01', FT_FL_DATE)") + " < 30")
    s["legs_by_time"] = s["prepare_legs"]
    s["range_partitioned"] = s["prepare_legs"]
    s["date_features"] = with_(*BASE_LEGS) + (
        "SELECT FT_event_id, round(CAST(epoch(CAST(FT_FL_DATE AS TIMESTAMP)) AS DOUBLE), 4) AS FT_FL_DATE, "
        "round(CAST(epoch(FT_TIMESTAMP) AS DOUBLE), 4) AS FT_TIMESTAMP FROM legs_prepared")
    s["split_by_key"] = with_(*BASE_MAPPED, LEGS_LAGGED) + (
        f"SELECT FT_event_id, hours_lag, CASE WHEN {bucket('FT_event_id')} < 80 THEN 'train' ELSE 'test' END "
        "AS split FROM legs_lagged")
    s["scored_labels"] = with_(*BASE_MAPPED, LEGS_LAGGED) + (
        f"""SELECT FT_event_id, hours_lag, FT_OnTime,
  CASE WHEN FT_OnTime = (SELECT label FROM (
      SELECT CASE WHEN FT_ARR_DELAY_NEW <= 15 THEN 1 ELSE 0 END AS label, count(*) AS n FROM legs_lagged
      WHERE {bucket('FT_event_id')} < 80 GROUP BY 1 ORDER BY n DESC, label LIMIT 1)) THEN 0 ELSE 1 END AS label_index
FROM (SELECT FT_event_id, hours_lag, CASE WHEN FT_ARR_DELAY_NEW <= 15 THEN 1 ELSE 0 END AS FT_OnTime FROM legs_lagged
      WHERE {bucket('FT_event_id')} >= 80)""")
    return s
