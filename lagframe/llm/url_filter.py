"""URL filters: dated list entries as validity intervals, joined as of fetch time.

A list is a history of entries (key, day, action, verdict). The last entry
of a key up to a moment tells whether the key is listed then, so entries
turn into half-open intervals from an ``add`` to the key's next entry. A
capture is looked up under every suffix of its host and under its host with
the first path segment; the longest key listed at fetch time decides.

Intervals are cut into time bins, so the as-of join is an equi-join on key
and bin with a residual time check: a host that holds a third of all
captures is spread over the bins, and a key with a long history is compared
bin by bin. All of it is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lagframe.llm.common import pick, stage

DAY = 86_400
BIN_SECONDS = 7 * DAY
HOST = "^[A-Za-z][A-Za-z0-9+.\\-]*://(?:[^/?#@]*@)?([^/?#:]*)"
SEGMENT = "^[A-Za-z][A-Za-z0-9+.\\-]*://[^/?#]*/([^/?#]+)"


def host_of(url: str) -> Column:
    """Lower-case host without user, port and closing dots; empty if there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), "[.]+$", ""), F.lit(""))


def segment_of(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, SEGMENT, 1), F.lit(""))


def lookup_keys(host: Column, segment: Column) -> Column:
    """Host suffixes of two labels or more, the host itself, and host/segment."""
    labels = F.split(host, "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.greatest(F.size(labels) - 1, F.lit(1))),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    path = F.when(segment != "", F.array(F.concat(host, F.lit("/"), segment))).otherwise(F.array().cast("array<string>"))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(suffixes, path)))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """key, verdict, valid_from, valid_to (null: still valid) from dated entries.

    Of entries of one key and day the last by (action, verdict) holds, so
    that ``remove`` beats ``add``. Entries with a null key or day are void.
    """
    order = Window.partitionBy("key").orderBy("day", "action", "verdict")
    return (entries.where("key is not null and day is not null")
            .withColumn("next_day", F.lead("day").over(order))
            .where("action = 'add' and (next_day is null or next_day > day)")
            .select("key", "verdict", (F.col("day") * DAY).cast("long").alias("valid_from"),
                    (F.col("next_day") * DAY).cast("long").alias("valid_to")))


def evaluate(captures: DataFrame, entries: DataFrame) -> DataFrame:
    """page_id, fetched_at, n_listed, matched_key, verdict, blocked of every capture.

    ``captures`` has page_id, url and fetched_at (epoch seconds). Null or
    hostless URLs and null times match nothing and pass; ties and repeated
    rows are each judged alone; no entries block nothing; an empty table
    gives none. ``blocked`` is true if the longest listed key says block.
    """
    captures = pick(captures, "page_id", "url", "fetched_at")
    rows = captures.select(F.monotonically_increasing_id().alias("row"), "page_id", "fetched_at",
                           lookup_keys(host_of("url"), segment_of("url")).alias("keys"))
    intervals = validity_intervals(pick(entries, "key", "day", "action", "verdict"))
    horizon = captures.agg(F.max("fetched_at")).first()[0] or 0
    until = F.least(F.coalesce(F.col("valid_to") - 1, F.lit(horizon)), F.lit(horizon))
    bins = F.sequence(F.floor(F.col("valid_from") / BIN_SECONDS), F.floor(until / BIN_SECONDS))
    binned = stage(intervals.where(F.col("valid_from") <= horizon).select("*", F.explode(bins).alias("bin")), "intervals")
    looked = rows.select("row", "page_id", "fetched_at", F.explode_outer("keys").alias("key"),
                         F.floor(F.col("fetched_at") / BIN_SECONDS).alias("bin"))
    hit = ((looked["key"] == binned["key"]) & (looked["bin"] == binned["bin"])
           & (looked["fetched_at"] >= binned["valid_from"])
           & (binned["valid_to"].isNull() | (looked["fetched_at"] < binned["valid_to"])))
    found = F.when(binned["key"].isNotNull(), F.struct(F.length(binned["key"]).alias("n"), binned["key"].alias("key"),
                                                       binned["verdict"].alias("verdict")))
    best = (looked.join(binned, hit, "left").select("row", "page_id", looked["fetched_at"], found.alias("found"))
            .groupBy("row", "page_id", "fetched_at")
            .agg(F.max("found").alias("best"), F.count("found").alias("n_listed")))
    return best.select("page_id", "fetched_at", "n_listed", F.col("best.key").alias("matched_key"),
                       F.col("best.verdict").alias("verdict"),
                       F.coalesce(F.col("best.verdict") == "block", F.lit(False)).alias("blocked"))


# Fetch times and list histories for crawled pages that come without them:
# both follow from MD5 digits of the page's number and of the list key.
FIRST_DAY = 19_723          # 2024-01-01 as days since 1970
DAYS = 365
HISTORY = 4                 # entries of a key at most


def digits(text: Column, n: int, start: int = 1) -> Column:
    """The number written by hexadecimal digits of the text's MD5."""
    return F.conv(F.substring(F.md5(text.cast("binary")), start, n), 16, 10).cast("long")


def derived_captures(pages: DataFrame) -> DataFrame:
    """Captures of ``pages``: fetched within the year, at a second given by the page's number."""
    moment = F.lit(FIRST_DAY * DAY) + digits(F.col("page_id").cast("string"), 7) % (DAYS * DAY)
    return pick(pages, "page_id", "url").select("page_id", "url", moment.cast("long").alias("fetched_at"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A list history over the keys under which ``pages`` are looked up.

    A third of the keys have up to HISTORY entries, in turn add and remove.
    """
    keys = (pick(pages, "url").select(F.explode(lookup_keys(host_of("url"), segment_of("url"))).alias("key")).distinct()
            .where(digits(F.col("key"), 4) % 3 == 0))
    nth = F.explode(F.sequence(F.lit(1), (digits(F.col("key"), 2, 5) % HISTORY + 1).cast("int")))
    own = F.concat_ws("#", F.col("key"), F.col("nth").cast("string"))
    return keys.select("key", nth.alias("nth")).select(
        "key", (F.lit(FIRST_DAY) + digits(own, 5) % DAYS).cast("long").alias("day"),
        F.when(F.col("nth") % 2 == 1, "add").otherwise("remove").alias("action"),
        F.when(digits(own, 3, 6) % 4 == 0, "allow").otherwise("block").alias("verdict"))


# The same in SQL, from ``pages`` alone; {host}, {segment} are the patterns above.
SQL = f"""
WITH parsed AS (
  SELECT page_id, coalesce(regexp_replace(lower(regexp_extract(url, '{HOST}', 1)), '[.]+$', ''), '') AS host,
         coalesce(regexp_extract(url, '{SEGMENT}', 1), '') AS segment,
         {FIRST_DAY * DAY} + CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 7) AS BIGINT) % {DAYS * DAY} AS fetched_at,
         row_number() OVER () AS row_no
  FROM pages),
labels AS (SELECT *, len(string_split(host, '.')) AS n FROM parsed WHERE host <> ''),
looked AS (
  SELECT DISTINCT row_no, fetched_at, key FROM (
    SELECT row_no, fetched_at, array_to_string(list_slice(string_split(host, '.'), i, n), '.') AS key
    FROM (SELECT *, unnest(range(1, greatest(n - 1, 1) + 1)) AS i FROM labels)
    UNION ALL
    SELECT row_no, fetched_at, host || '/' || segment FROM labels WHERE segment <> '')),
listed_keys AS (
  SELECT key FROM (SELECT DISTINCT key FROM looked) WHERE CAST('0x' || substr(md5(key), 1, 4) AS BIGINT) % 3 = 0),
history AS (
  SELECT key, unnest(range(1, CAST('0x' || substr(md5(key), 5, 2) AS BIGINT) % {HISTORY} + 2)) AS nth FROM listed_keys),
entries AS (
  SELECT key, {FIRST_DAY} + CAST('0x' || substr(md5(key || '#' || nth), 1, 5) AS BIGINT) % {DAYS} AS day,
         CASE WHEN nth % 2 = 1 THEN 'add' ELSE 'remove' END AS action,
         CASE WHEN CAST('0x' || substr(md5(key || '#' || nth), 6, 3) AS BIGINT) % 4 = 0
              THEN 'allow' ELSE 'block' END AS verdict
  FROM history),
latest AS (
  SELECT l.row_no, l.key, e.action, e.verdict,
         row_number() OVER (PARTITION BY l.row_no, l.key ORDER BY e.day DESC, e.action DESC, e.verdict DESC) AS nth_last
  FROM looked l JOIN entries e ON l.key = e.key AND e.day * {DAY} <= l.fetched_at),
listed AS (
  SELECT row_no, key, verdict, row_number() OVER (PARTITION BY row_no ORDER BY length(key) DESC, key DESC) AS place,
         count(*) OVER (PARTITION BY row_no) AS n_listed
  FROM latest WHERE nth_last = 1 AND action = 'add')
SELECT p.page_id, p.fetched_at, coalesce(l.n_listed, 0) AS n_listed, l.key AS matched_key, l.verdict,
       coalesce(l.verdict = 'block', false) AS blocked
FROM parsed p LEFT JOIN listed l ON p.row_no = l.row_no AND l.place = 1
"""
