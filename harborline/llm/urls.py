"""Operator 4, URL filters by a temporal list join (DataFrame operations only).

A list is a table of dated entries: a pattern was added or removed on a day.
Entries become validity intervals, and every capture is judged by the entries
in force when it was fetched: an as-of join.  A pattern is a host, a parent
domain of at least two labels, or a host with the first segment of a path; a
capture has a handful of candidate patterns, so the join is an equality on the
pattern with a range test on the day, never a scan of the list.  A host that
holds a third of all captures meets few intervals; Spark may split that side.

Defined results: a null or malformed URL has no candidates and is not blocked;
of two entries for one pattern on one day a removal wins; repeating an action
changes nothing; captures equal in id, URL and day come out once; empty lists
block nothing; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)"
FOREVER = "9999-12-31"


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.$", "")


def candidates(url: Column) -> Column:
    """All patterns that a URL can match, the most specific first."""
    h = host(url)
    labels = F.split(h, r"\.")
    n = F.size(labels)
    parents = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.array_join(F.slice(labels, i, n), "."))
    segment = F.regexp_extract(url, SEGMENT, 1)
    path = F.when(segment != "", F.array(F.concat(h, F.lit("/"), segment))).otherwise(F.array().cast("array<string>"))
    return F.when(h != "", F.concat(path, parents)).otherwise(F.array().cast("array<string>"))


def validity_intervals(entries: DataFrame) -> DataFrame:
    """(pattern, valid_from, valid_to) from (pattern, listed_on, action): to is exclusive."""
    daily = entries.groupBy("pattern", "listed_on").agg(F.min(F.col("action") != "remove").alias("active"))
    w = Window.partitionBy("pattern").orderBy("listed_on")
    changes = daily.withColumn("was", F.lag("active", 1, False).over(w)).where("active != was")
    changes = changes.withColumn("valid_to", F.coalesce(F.lead("listed_on").over(w), F.lit(FOREVER).cast("date")))
    return changes.where("active").select("pattern", F.col("listed_on").alias("valid_from"), "valid_to")


def evaluate(captures: DataFrame, entries: DataFrame, id_col: str = "page_id", url_col: str = "url", day_col: str = "fetched_on") -> DataFrame:
    """One row per capture: blocked, how many entries applied, the most specific of them and since when."""
    seen = captures.select(F.col(id_col).alias(id_col), F.col(url_col).alias("url"), F.col(day_col).alias("fetched_on"))
    each = seen.select(id_col, "url", "fetched_on", F.posexplode_outer(candidates(F.col("url"))).alias("rank", "pattern"))
    spans = validity_intervals(entries).withColumnRenamed("pattern", "listed")
    at = (F.col("pattern") == F.col("listed")) & (F.col("fetched_on") >= F.col("valid_from")) & (F.col("fetched_on") < F.col("valid_to"))
    joined = each.join(spans, at, "left")
    best = F.min(F.when(F.col("listed").isNotNull(), F.struct("rank", "listed", "valid_from")))
    out = joined.groupBy(id_col, "url", "fetched_on").agg(F.count("listed").alias("n_active"), best.alias("best"))
    return out.select(id_col, "url", "fetched_on", (F.col("n_active") > 0).alias("blocked"), "n_active", F.col("best.listed").alias("pattern"), F.col("best.valid_from").alias("active_since"))


def _hex(c: Column, at: int) -> Column:
    return F.conv(F.substring(F.md5(c), at, 4), 16, 10).cast("int")


def derived_captures(pages: DataFrame) -> DataFrame:
    """Pages with a day of fetching in 2024, derived from page_id since the table has none."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (_hex(F.col("page_id").cast("string"), 1) % 366).cast("int"))
    return pages.select("page_id", "url", day.alias("fetched_on"))


def derived_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts of the pages, derived by digests: a third of them are listed, some removed, some again."""
    hosts = pages.select(host(F.col("url")).alias("h")).where("h != ''").distinct()
    parents = hosts.select(F.regexp_extract("h", r"^[^.]+\.([^.]+\..+)$", 1).alias("h")).where("h != ''").distinct()
    paths = hosts.select(F.concat("h", F.lit("/en")).alias("h"))
    patterns = hosts.union(parents).union(paths).distinct().where(_hex(F.col("h"), 1) % 3 == 0)
    first = F.date_add(F.lit("2023-10-01").cast("date"), _hex(F.col("h"), 5) % 400)
    second = F.date_add(first, _hex(F.col("h"), 9) % 120)
    third = F.date_add(second, 1 + _hex(F.col("h"), 13) % 60)
    events = F.array(
        F.struct(first.alias("on"), F.lit("add").alias("action"), F.lit(0).alias("need")),
        F.struct(second.alias("on"), F.lit("remove").alias("action"), F.lit(1).alias("need")),
        F.struct(third.alias("on"), F.lit("add").alias("action"), F.lit(2).alias("need")),
    )
    each = patterns.select("h", F.explode(events).alias("e")).where(F.col("e.need") <= _hex(F.col("h"), 17) % 3)
    return each.select(F.col("h").alias("pattern"), F.col("e.on").alias("listed_on"), "e.action")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return evaluate(derived_captures(pages), derived_entries(pages))


OP4_SQL = r"""
WITH p AS (
  SELECT page_id, url,
    regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', '') AS h,
    regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]+)', 1) AS seg,
    DATE '2024-01-01' + CAST(('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 4))::INT % 366 AS INT) AS fetched_on
  FROM pages
), hosts AS (SELECT DISTINCT h FROM p WHERE h <> ''),
pats AS (
  SELECT h FROM hosts
  UNION SELECT regexp_extract(h, '^[^.]+\.([^.]+\..+)$', 1) FROM hosts WHERE regexp_extract(h, '^[^.]+\.([^.]+\..+)$', 1) <> ''
  UNION SELECT h || '/en' FROM hosts
), listed AS (
  SELECT h, ('0x' || substr(md5(h), 5, 4))::INT AS a, ('0x' || substr(md5(h), 9, 4))::INT AS b,
    ('0x' || substr(md5(h), 13, 4))::INT AS c, ('0x' || substr(md5(h), 17, 4))::INT % 3 AS k
  FROM pats WHERE ('0x' || substr(md5(h), 1, 4))::INT % 3 = 0
), entries AS (
  SELECT h, DATE '2023-10-01' + a % 400 AS d, 'add' AS action FROM listed
  UNION ALL SELECT h, DATE '2023-10-01' + a % 400 + b % 120, 'remove' FROM listed WHERE k >= 1
  UNION ALL SELECT h, DATE '2023-10-01' + a % 400 + b % 120 + 1 + c % 60, 'add' FROM listed WHERE k >= 2
), cand AS (
  SELECT page_id, url, fetched_on, 0 AS rk, h || '/' || seg AS pattern FROM p WHERE h <> '' AND seg <> ''
  UNION ALL
  SELECT page_id, url, fetched_on, i, array_to_string(list_slice(string_split(h, '.'), i, len(string_split(h, '.'))), '.')
  FROM p, generate_series(1, 12) g(i)
  WHERE h <> '' AND i <= greatest(len(string_split(h, '.')) - 1, 1)
), state AS (
  SELECT c.page_id, c.url, c.fetched_on, c.rk, c.pattern,
    max(e.d) AS last_day
  FROM cand c JOIN entries e ON e.h = c.pattern AND e.d <= c.fetched_on
  GROUP BY ALL
), act AS (
  SELECT s.page_id, s.url, s.fetched_on, s.rk, s.pattern,
    (SELECT max(e.d) FROM entries e WHERE e.h = s.pattern AND e.d <= s.last_day AND e.action = 'add'
       AND NOT EXISTS (SELECT 1 FROM entries r WHERE r.h = e.h AND r.d = e.d AND r.action = 'remove')) AS since
  FROM state s
  WHERE NOT EXISTS (SELECT 1 FROM entries e WHERE e.h = s.pattern AND e.d = s.last_day AND e.action = 'remove')
)
SELECT DISTINCT p.page_id, p.url, p.fetched_on, coalesce(n, 0) > 0 AS blocked, coalesce(n, 0) AS n_active, x.pattern, x.since AS active_since
FROM p LEFT JOIN (
  SELECT page_id, url, fetched_on, count(*) AS n, arg_min(pattern, rk) AS pattern, arg_min(since, rk) AS since
  FROM act GROUP BY ALL) x ON x.page_id = p.page_id AND x.url = p.url AND x.fetched_on = p.fetched_on
"""

QUERIES = {"op4_url_filters": op4_url_filters}
ORACLE_SQL = {"op4_url_filters": OP4_SQL}
