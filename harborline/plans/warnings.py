"""Event features, neighbours, alternatives, event studies, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import live as lv
from . import panels as pl
from . import views as v
from .panels import ALERTS, BASE, FULL, LABELS
from .vessels import KM
from .views import HAZARDS, PROFILES, with_views

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


PREPARED = "pe AS (SELECT event_id, bool_or(upper(alert_level) = 'RED') AS is_red, min(from_date) AS from_date, min(latitude) AS latitude, min(longitude) AS longitude, min(listed_port) AS listed_port FROM v_events WHERE event_type <> 'DR' GROUP BY 1)"
EXPOSED = f"""ex AS (SELECT p.port_id, e.event_id, CAST(date_trunc('week', e.from_date) AS DATE) + CAST(7 * k AS INT) AS week_start, CASE WHEN {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} <= 800 THEN {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} END AS km, e.listed_port = p.port_id AS listed, e.is_red, e.from_date
  FROM v_profiles p JOIN pe e ON {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} <= 800 OR e.listed_port = p.port_id CROSS JOIN generate_series(0, 2) g(k))"""


@query("prepare_events", with_views("SELECT event_id, is_red, from_date, latitude, longitude FROM pe", HAZARDS, PREPARED))
def prepare_events(spark: SparkSession, sf: str) -> DataFrame:
    return prepared(spark, sf).drop("ports")


def prepared(spark: SparkSession, sf: str) -> DataFrame:
    return ev.prepare_events(v.hazards(spark, sf))


@query("event_exposure", with_views("SELECT * FROM ex", PROFILES, HAZARDS, PREPARED, EXPOSED))
def event_exposure(spark: SparkSession, sf: str) -> DataFrame:
    return ev.event_exposure(prepared(spark, sf), v.profiles(spark, sf))


@v.once
def daily_exposure(spark: SparkSession, sf: str) -> DataFrame:
    return ev.daily_exposure(v.hazards(spark, sf), v.profiles(spark, sf))


ATTACHED = "att AS (SELECT w.origin_week, w.target_week, w.horizon, w.port_id, w.y, min(e.km) AS event_km, coalesce(bool_or(e.listed), false) AS event_listed FROM wa w LEFT JOIN ex e ON e.port_id = w.port_id AND e.week_start = w.target_week AND e.from_date <= w.origin_week + 15 GROUP BY 1, 2, 3, 4, 5)"


@query("attach_events", with_views("SELECT * FROM att", *FULL, PROFILES, HAZARDS, PREPARED, EXPOSED, ATTACHED))
def attach_events(spark: SparkSession, sf: str) -> DataFrame:
    w = pl.warning_rows(spark, sf).select("origin_week", "target_week", "horizon", "port_id", "y")
    return ev.attach_events(w, event_exposure(spark, sf))


NEIGHBOURS = f"nb AS (SELECT a.port_id, b.port_id AS other_id, {KM.format(a='a.latitude', b='a.longitude', c='b.latitude', d='b.longitude')} AS km FROM v_profiles a JOIN v_profiles b ON a.port_id <> b.port_id AND {KM.format(a='a.latitude', b='a.longitude', c='b.latitude', d='b.longitude')} <= 6000)"


@query("region_features", with_views("SELECT l.port_id, l.week_start, r.neighbours, r.neighbour_drops, r.neighbour_z, w.world_drops FROM lb l LEFT JOIN (SELECT nb.port_id, o.week_start, count(*) AS neighbours, avg(CAST(o.is_drop AS INT)) AS neighbour_drops, avg(o.z) AS neighbour_z FROM nb JOIN lb o ON o.port_id = nb.other_id AND o.eligible GROUP BY 1, 2) r ON r.port_id = l.port_id AND r.week_start = l.week_start LEFT JOIN (SELECT week_start, avg(CAST(is_drop AS INT)) AS world_drops FROM lb WHERE eligible GROUP BY 1) w ON w.week_start = l.week_start", *BASE, LABELS, PROFILES, NEIGHBOURS))
def region_features(spark: SparkSession, sf: str) -> DataFrame:
    return ev.region_features(pl.label_drops(spark, sf), v.profiles(spark, sf), 6000.0)


@query("alternatives", with_views("SELECT origin_week, horizon, port_id, other_id, km, rank FROM (SELECT f.origin_week, f.horizon, f.port_id, nb.other_id, nb.km, row_number() OVER (PARTITION BY f.origin_week, f.horizon, f.port_id ORDER BY nb.km, nb.other_id) AS rank FROM al f JOIN nb ON nb.port_id = f.port_id JOIN al q ON q.origin_week = f.origin_week AND q.horizon = f.horizon AND q.port_id = nb.other_id WHERE f.flagged AND q.last_z <= 0.2) WHERE rank <= 3", *FULL, ALERTS, PROFILES, NEIGHBOURS))
def alternatives(spark: SparkSession, sf: str) -> DataFrame:
    scores = pl.top_budget_alerts(spark, sf).withColumnRenamed("last_z", "score")
    return ev.alternatives(scores, v.profiles(spark, sf), 6000.0, 0.2)


@query("merge_history", with_views("SELECT origin_week, horizon, port_id, last_z * 2 AS last_z FROM al WHERE origin_week >= DATE '2001-06-01' UNION ALL SELECT origin_week, horizon, port_id, last_z FROM al WHERE origin_week < DATE '2001-06-01'", *FULL, ALERTS))
def merge_history(spark: SparkSession, sf: str) -> DataFrame:
    old = pl.top_budget_alerts(spark, sf).select("origin_week", "horizon", "port_id", "last_z")
    return ev.merge_history(old, old.where("origin_week >= '2001-06-01'").withColumn("last_z", F.col("last_z") * 2), "origin_week")


HISTORY = "hi AS (SELECT al.origin_week, al.target_week, al.horizon, al.port_id, wa.base_rate AS chance, al.flagged FROM al JOIN wa USING (origin_week, target_week, horizon, port_id))"
RECORD = "tr AS (SELECT hi.*, lb.is_drop AS happened, lb.drop_pct FROM hi JOIN lb ON lb.port_id = hi.port_id AND lb.week_start = hi.target_week AND lb.is_drop IS NOT NULL)"


def history(spark: SparkSession, sf: str) -> DataFrame:
    """Warnings as they were given: the alerts of every past origin, with the base rate as their chance."""
    rates = pl.warning_rows(spark, sf).select("origin_week", "target_week", "horizon", "port_id", F.col("base_rate").alias("chance"))
    return pl.top_budget_alerts(spark, sf).select("origin_week", "target_week", "horizon", "port_id", "flagged").join(rates, ["origin_week", "target_week", "horizon", "port_id"])


@query("track_record", with_views("SELECT * FROM tr", *FULL, ALERTS, HISTORY, RECORD))
def track_record(spark: SparkSession, sf: str) -> DataFrame:
    return lv.track_record(history(spark, sf), pl.label_drops(spark, sf), "port_id", "week_start")


@query("record_recent", with_views("SELECT target_week, port_id, horizon, chance, happened, drop_pct FROM (SELECT *, row_number() OVER (PARTITION BY target_week, port_id ORDER BY chance DESC, horizon) AS r FROM tr WHERE flagged AND origin_week IN (SELECT DISTINCT origin_week FROM tr ORDER BY 1 DESC LIMIT 6)) WHERE r = 1", *FULL, ALERTS, HISTORY, RECORD))
def record_recent(spark: SparkSession, sf: str) -> DataFrame:
    return lv.recent_record(track_record(spark, sf), "port_id")


QUERIES["region_expectation"] = lambda spark, sf: pl.warning_rows(spark, sf).join(v.profiles(spark, sf).select("port_id", "continent"), "port_id").groupBy("origin_week", "horizon", "continent").agg(F.sum("base_rate").alias("expected"))
ORACLE_SQL["region_expectation"] = with_views("SELECT origin_week, horizon, continent, sum(base_rate) AS expected FROM wa JOIN v_profiles USING (port_id) GROUP BY 1, 2, 3", *FULL, PROFILES)
QUERIES["weekly_origins"] = lambda spark, sf: pl.warning_rows(spark, sf).groupBy("origin_week").agg(F.count_distinct("horizon").alias("h")).where("h = 3").select("origin_week")
ORACLE_SQL["weekly_origins"] = with_views("SELECT origin_week FROM wa GROUP BY 1 HAVING count(DISTINCT horizon) = 3", *FULL)

EPISODES = "ep AS (SELECT port_id * 10 + k AS episode_id, port_id, DATE '1997-01-06' + CAST(k * 371 AS INT) AS start_week FROM v_profiles CROSS JOIN generate_series(0, 3) g(k))"
CHANGES = """ch AS (SELECT e.episode_id, e.port_id, e.start_week, CAST(o.k AS INT) AS "offset", b.base, g.y, CASE WHEN b.base > 0 THEN g.y / b.base - 1 END AS change FROM ep e
  JOIN (SELECT port_id, week_start, CASE WHEN count(y) OVER w >= 4 THEN avg(y) OVER w END AS base FROM g WINDOW w AS (PARTITION BY port_id ORDER BY week_start ROWS BETWEEN 10 PRECEDING AND 3 PRECEDING)) b ON b.port_id = e.port_id AND b.week_start = e.start_week
  CROSS JOIN generate_series(0, 26) o(k) JOIN g ON g.port_id = e.port_id AND g.week_start = e.start_week + CAST(7 * o.k AS INT))"""


@query("episode_changes", with_views("SELECT * FROM ch", *BASE, PROFILES, EPISODES, CHANGES))
def episode_changes(spark: SparkSession, sf: str) -> DataFrame:
    each = v.profiles(spark, sf).select("port_id", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    episodes = each.select((F.col("port_id") * 10 + F.col("k")).alias("episode_id"), "port_id", F.expr("date_add(DATE '1997-01-06', k * 371)").alias("start_week"))
    return ev.episode_changes(pl.weekly_grid(spark, sf), episodes, "port_id", "week_start")


@query("placebo_noise", with_views("SELECT port_id, sqrt(avg(m * m)) AS noise, count(*) AS placebos FROM (SELECT port_id, start_week, avg(change) AS m FROM ch GROUP BY 1, 2 HAVING count(change) >= 14) GROUP BY 1", *BASE, PROFILES, EPISODES, CHANGES))
def placebo_noise(spark: SparkSession, sf: str) -> DataFrame:
    return ev.placebo_noise(episode_changes(spark, sf))
