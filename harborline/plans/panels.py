"""Queries over daily and weekly panels, labels and forecasts, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import panels as pa
from ..operators import temporal
from . import views as v
from .views import ACTIVITY, HAZARDS, TRANSITS, with_views
from .vessels import KM

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


MEAN = "CASE WHEN count(*) FILTER (WHERE age BETWEEN {1} AND {2}) = {2} - {1} + 1 THEN avg(o.{0}) FILTER (WHERE age BETWEEN {1} AND {2}) END AS {3}"
ROLL = f"""roll AS (SELECT chokepoint_id, transit_date, any_value(n) AS n_total, any_value(c) AS capacity, {MEAN.format("n_total", 0, 6, "n_total_7d")}, {MEAN.format("n_total", 7, 34, "n_total_prior_28d")},
  {MEAN.format("capacity", 0, 6, "capacity_7d")}, {MEAN.format("capacity", 7, 34, "capacity_prior_28d")}
  FROM (SELECT t.chokepoint_id, t.transit_date, t.n_total AS n, t.capacity AS c, t.transit_date - b.transit_date AS age, b.n_total, b.capacity FROM v_transits t JOIN v_transits b ON b.chokepoint_id = t.chokepoint_id AND b.transit_date BETWEEN t.transit_date - 34 AND t.transit_date) o GROUP BY 1, 2)"""
YEAR = """yr AS (SELECT a.*, b.n_total_7d AS n_total_7d_year_ago, b.capacity_7d AS capacity_7d_year_ago, 100.0 * (a.n_total_7d - b.n_total_7d) / nullif(b.n_total_7d, 0) AS n_total_7d_vs_year_ago_pct,
  100.0 * (a.capacity_7d - b.capacity_7d) / nullif(b.capacity_7d, 0) AS capacity_7d_vs_year_ago_pct FROM roll a LEFT JOIN roll b ON b.chokepoint_id = a.chokepoint_id AND b.transit_date = a.transit_date - 364)"""
PLACES = "places AS (SELECT chokepoint_id, CAST(length(chokepoint_id) * 6 - 40 AS DOUBLE) AS latitude, CAST(length(chokepoint_id) * 17 - 100 AS DOUBLE) AS longitude FROM (SELECT DISTINCT o_orderpriority AS chokepoint_id FROM orders))"
NEAR = f"""near AS (SELECT t.chokepoint_id, t.transit_date, coalesce(x.n, 0) AS nearby_events, x.nearby_types, x.nearby_max_alert FROM v_transits t LEFT JOIN (
  SELECT p.chokepoint_id, d.transit_date, count(DISTINCT event_id) AS n, string_agg(DISTINCT event_type, '; ' ORDER BY event_type) AS nearby_types, max(CASE alert_level WHEN 'RED' THEN 3 WHEN 'ORANGE' THEN 2 ELSE 1 END) AS nearby_max_alert
  FROM places p JOIN v_events e ON {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} <= 2000 JOIN tdays d ON d.transit_date BETWEEN e.from_date AND e.to_date GROUP BY 1, 2) x ON x.chokepoint_id = t.chokepoint_id AND x.transit_date = t.transit_date)"""


@query("chokepoint_7d", with_views("SELECT * FROM roll", TRANSITS, ROLL))
def chokepoint_7d(spark: SparkSession, sf: str) -> DataFrame:
    t = v.transits(spark, sf).select("chokepoint_id", "transit_date", "n_total", "capacity")
    return pa.rolling_days(t, "chokepoint_id", "transit_date", ["n_total", "capacity"])


@query("chokepoint_year_ago", with_views("SELECT * FROM yr", TRANSITS, ROLL, YEAR))
def chokepoint_year_ago(spark: SparkSession, sf: str) -> DataFrame:
    return pa.year_ago(chokepoint_7d(spark, sf), "chokepoint_id", "transit_date", ["n_total_7d", "capacity_7d"])


@v.once
def places(spark: SparkSession, sf: str) -> DataFrame:
    n = F.length("o_orderpriority")
    return v.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("chokepoint_id"), (n * 6 - 40).cast("double").alias("latitude"), (n * 17 - 100).cast("double").alias("longitude")).distinct()


@query("hazards_near", with_views("SELECT * FROM near", TRANSITS, HAZARDS, PLACES, NEAR))
def hazards_near(spark: SparkSession, sf: str) -> DataFrame:
    return pa.hazards_near(v.transits(spark, sf), places(spark, sf), v.hazards(spark, sf), "chokepoint_id", "transit_date", 2000.0)


@query("chokepoint_daily", with_views("SELECT yr.*, p.latitude, p.longitude, nearby_events, nearby_types, nearby_max_alert, 100.0 * (n_total_7d - n_total_prior_28d) / nullif(n_total_prior_28d, 0) AS n_total_vs_prior_28d_pct FROM yr JOIN near USING (chokepoint_id, transit_date) JOIN places p USING (chokepoint_id)", TRANSITS, HAZARDS, PLACES, ROLL, YEAR, NEAR))
def chokepoint_daily(spark: SparkSession, sf: str) -> DataFrame:
    out = chokepoint_year_ago(spark, sf).join(hazards_near(spark, sf), ["chokepoint_id", "transit_date"]).join(places(spark, sf), "chokepoint_id")
    return out.withColumn("n_total_vs_prior_28d_pct", pa.pct_change(F.col("n_total_7d"), F.col("n_total_prior_28d")))


SUMS = ["portcalls", "portcalls_tanker", "portcalls_container", "portcalls_dry_bulk", "import_total", "export_total"]
WEEKLY = f"""pw AS (SELECT w.week_start, w.port_id, newest.port_name, newest.country, w.days_reported, {', '.join(f'w.{c}' for c in SUMS)}, w.days_reported = 7 AS is_complete_week
  FROM (SELECT activity_date - CAST(extract(isodow FROM activity_date) - 1 AS INT) AS week_start, port_id, count(DISTINCT activity_date) AS days_reported, max(activity_date) AS last_day,
    {', '.join(f'CAST(sum({c}) AS {"DOUBLE" if "total" in c else "BIGINT"}) AS {c}' for c in SUMS)} FROM v_activity GROUP BY 1, 2) w
  JOIN v_activity newest ON newest.port_id = w.port_id AND newest.activity_date = w.last_day)"""


@query("port_weekly", with_views("SELECT * FROM pw", ACTIVITY, WEEKLY))
def port_weekly(spark: SparkSession, sf: str) -> DataFrame:
    return pa.port_weekly(v.activity(spark, sf), SUMS)


GRID = """g AS (SELECT p.port_id, w.week_start, CASE WHEN x.is_complete_week THEN CAST(x.portcalls AS DOUBLE) END AS y FROM (SELECT DISTINCT port_id FROM pw) p
  CROSS JOIN (SELECT CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS week_start FROM (SELECT min(week_start) AS a, max(week_start) AS b FROM pw)) w
  LEFT JOIN pw x ON x.port_id = p.port_id AND x.week_start = w.week_start)"""
BASE = (ACTIVITY, WEEKLY, GRID)


@query("weekly_grid", with_views("SELECT * FROM g", *BASE))
@v.once
def weekly_grid(spark: SparkSession, sf: str) -> DataFrame:
    return temporal.weekly_grid(port_weekly(spark, sf), "port_id", "week_start", "portcalls", "is_complete_week")


@query("trailing_mean", with_views("SELECT *, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 3 PRECEDING) AS mean_4, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 51 PRECEDING) AS mean_52 FROM g", *BASE))
def trailing_mean(spark: SparkSession, sf: str) -> DataFrame:
    return pa.trailing(weekly_grid(spark, sf), "port_id", "week_start", "y", [4, 52])


@query("size_band", with_views("SELECT port_id, week_start, CASE WHEN m < 5 THEN 'small' WHEN m < 50 THEN 'medium' WHEN m >= 50 THEN 'large' END AS size_band FROM (SELECT *, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 51 PRECEDING) AS m FROM g)", *BASE))
def size_band(spark: SparkSession, sf: str) -> DataFrame:
    m = F.col("mean_52")
    out = trailing_mean(spark, sf)
    return out.select("port_id", "week_start", F.when(m < 5, "small").when(m < 50, "medium").when(m >= 50, "large").alias("size_band"))


LABELS = """l0 AS (SELECT *, CASE WHEN k >= 10 THEN b0 END AS base, CASE WHEN k >= 10 THEN greatest((q3 - q1) / 1.349, sqrt(b0)) END AS spread FROM (
  SELECT *, count(y) OVER w AS k, quantile_cont(y, 0.5) OVER w AS b0, quantile_cont(y, 0.25) OVER w AS q1, quantile_cont(y, 0.75) OVER w AS q3 FROM g
  WINDOW w AS (PARTITION BY port_id ORDER BY week_start ROWS BETWEEN 13 PRECEDING AND 1 PRECEDING))),
l1 AS (SELECT port_id, week_start, y, base, spread, coalesce(y IS NOT NULL AND base >= 3, false) AS eligible FROM l0),
lb AS (SELECT *, CASE WHEN eligible THEN (y - base) / spread END AS z, CASE WHEN eligible THEN 1 - y / base END AS drop_pct,
  CASE WHEN eligible THEN (1 - y / base) >= 0.30 AND (y - base) / spread <= -1.5 END AS is_drop FROM l1)"""


@query("label_drops", with_views("SELECT * FROM lb", *BASE, LABELS))
@v.once
def label_drops(spark: SparkSession, sf: str) -> DataFrame:
    return pa.label_drops(weekly_grid(spark, sf), "port_id", "week_start", min_base=3.0, min_z=1.5)


SEASONAL = """se AS (SELECT *, CASE WHEN coalesce(p1, p2, p3) IS NOT NULL THEN is_drop AND (coalesce(p1, false) OR coalesce(p2, false) OR coalesce(p3, false)) END AS is_seasonal,
  CASE WHEN coalesce(p1, p2, p3) IS NOT NULL THEN is_drop AND NOT (coalesce(p1, false) OR coalesce(p2, false) OR coalesce(p3, false)) END AS is_disruption
  FROM (SELECT *, lag(is_drop, 51) OVER w AS p1, lag(is_drop, 52) OVER w AS p2, lag(is_drop, 53) OVER w AS p3 FROM lb WINDOW w AS (PARTITION BY port_id ORDER BY week_start)))"""


@query("seasonal_flags", with_views("SELECT port_id, week_start, is_drop, is_seasonal, is_disruption FROM se", *BASE, LABELS, SEASONAL))
def seasonal_flags(spark: SparkSession, sf: str) -> DataFrame:
    return pa.seasonal_flags(label_drops(spark, sf), "port_id", "week_start").select("port_id", "week_start", "is_drop", "is_seasonal", "is_disruption")


@query("drop_episodes", with_views("""SELECT port_id, min(week_start) AS start_week, count(*) AS weeks, max(drop_pct) AS deepest, arg_min(base, week_start) AS base FROM (
  SELECT *, row_number() OVER (PARTITION BY port_id ORDER BY week_start) - row_number() OVER (PARTITION BY port_id, is_drop ORDER BY week_start) AS run FROM lb WHERE eligible) WHERE is_drop GROUP BY port_id, run""", *BASE, LABELS))
def drop_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return pa.drop_episodes(label_drops(spark, sf), "port_id", "week_start")


RATED = """wk AS (SELECT week_start, CAST(count(*) FILTER (WHERE is_drop) AS BIGINT) AS h, count(is_drop) AS k FROM lb GROUP BY 1),
po AS (SELECT week_start, CASE WHEN sum(k) OVER o > 0 THEN sum(h) OVER o / sum(k) OVER o END AS pooled FROM wk WINDOW o AS (ORDER BY week_start)),
ra AS (SELECT lb.*, count(*) FILTER (WHERE is_drop) OVER w AS hits, count(is_drop) OVER w AS known, pooled,
  (count(*) FILTER (WHERE is_drop) OVER w + 26.0 * coalesce(pooled, 0)) / (count(is_drop) OVER w + 26.0) AS base_rate FROM lb JOIN po USING (week_start) WINDOW w AS (PARTITION BY port_id ORDER BY week_start))"""


@query("base_rate", with_views("SELECT port_id, week_start, hits, known, pooled, base_rate FROM ra", *BASE, LABELS, RATED))
def base_rate(spark: SparkSession, sf: str) -> DataFrame:
    return rated(spark, sf).select("port_id", "week_start", "hits", "known", "pooled", "base_rate")


@v.once
def rated(spark: SparkSession, sf: str) -> DataFrame:
    return pa.base_rate(label_drops(spark, sf), "port_id", "week_start")


WARN = """wa AS (SELECT * FROM (""" + " UNION ALL ".join(f"""SELECT week_start AS origin_week, lead(week_start, {h}) OVER w AS target_week, {h} AS horizon, port_id, CAST(lead(is_drop, {h}) OVER w AS INT) AS y, lead(is_drop, {h}) OVER w AND lead(drop_pct, {h}) OVER w >= 0.5 AS big, base_rate, z AS origin_z, is_drop AS origin_drop FROM ra WINDOW w AS (PARTITION BY port_id ORDER BY week_start)""" for h in (1, 2, 3)) + """) WHERE y IS NOT NULL),
sc AS (SELECT *, coalesce(-origin_z, 0.0) AS last_z, coalesce(CAST(CAST(origin_drop AS INT) AS DOUBLE), 0.0) + base_rate / 2 AS last_drop FROM wa)"""
FULL = (*BASE, LABELS, RATED, WARN)


@query("warning_rows", with_views("SELECT * FROM wa", *FULL))
def warning_rows(spark: SparkSession, sf: str) -> DataFrame:
    return pa.warning_rows(rated(spark, sf), "port_id", "week_start")


@query("rule_scores", with_views("SELECT origin_week, horizon, port_id, last_z, last_drop FROM sc", *FULL))
def rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    return pa.rule_scores(warning_rows(spark, sf)).select("origin_week", "horizon", "port_id", "last_z", "last_drop")


ALERTS = "al AS (SELECT origin_week, target_week, horizon, port_id, y, last_z, row_number() OVER (PARTITION BY origin_week, horizon ORDER BY last_z DESC, port_id) AS rank, row_number() OVER (PARTITION BY origin_week, horizon ORDER BY last_z DESC, port_id) <= ceil(count(*) OVER (PARTITION BY origin_week, horizon) * 0.05) AS flagged FROM sc)"


@query("top_budget_alerts", with_views("SELECT * FROM al", *FULL, ALERTS))
def top_budget_alerts(spark: SparkSession, sf: str) -> DataFrame:
    scored = pa.rule_scores(warning_rows(spark, sf)).select("origin_week", "target_week", "horizon", "port_id", "y", "last_z")
    return pa.top_budget_alerts(scored, ["origin_week", "horizon"], "last_z", "port_id", 0.05)


@query("average_precision", with_views("""SELECT horizon, CAST(sum(n) AS BIGINT) AS n, CAST(sum(tp) AS BIGINT) AS positives, sum(tp * ctp / cn) / nullif(sum(tp), 0) AS average_precision FROM (
  SELECT horizon, tp, n, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM (SELECT horizon, last_z, CAST(sum(y) AS DOUBLE) AS tp, count(*) AS n FROM sc GROUP BY 1, 2) WINDOW w AS (PARTITION BY horizon ORDER BY last_z DESC)) GROUP BY 1""", *FULL))
def average_precision(spark: SparkSession, sf: str) -> DataFrame:
    scored = pa.rule_scores(warning_rows(spark, sf))
    return pa.average_precision(scored, ["horizon"], "last_z", "y")


@query("flag_stats", with_views("SELECT horizon, count(*) FILTER (WHERE flagged) / count(DISTINCT origin_week) AS alerts_per_week, count(*) FILTER (WHERE flagged AND y = 1) / nullif(count(*) FILTER (WHERE flagged), 0) AS precision, count(*) FILTER (WHERE flagged AND y = 1) / nullif(sum(y), 0) AS recall FROM al GROUP BY 1", *FULL, ALERTS))
def flag_stats(spark: SparkSession, sf: str) -> DataFrame:
    f = F.sum(F.col("flagged").cast("int"))
    hit = F.sum((F.col("flagged") & (F.col("y") == 1)).cast("int"))
    out = top_budget_alerts(spark, sf).groupBy("horizon").agg(f.alias("f"), hit.alias("hit"), F.sum("y").alias("pos"), F.count_distinct("origin_week").alias("weeks"))
    return out.select("horizon", (F.col("f") / F.col("weeks")).alias("alerts_per_week"), pa.safe_ratio(F.col("hit"), F.col("f")).alias("precision"), pa.safe_ratio(F.col("hit"), F.col("pos")).alias("recall"))


@query("history_features", with_views("""SELECT port_id, week_start, y, lag_0, lag_1, lag_2, lag_3, mean_4, mean_8, mean_13, mean_52, sqrt(greatest(s13 - mean_13 * mean_13, 0)) / nullif(mean_13, 0) AS cv_13, mean_4 / nullif(mean_13, 0) AS trend,
  lag(mean_4, 52) OVER w AS mean_4_year_ago, mean_4 / nullif(lag(mean_4, 52) OVER w, 0) AS vs_year_ago FROM (SELECT *, y AS lag_0, lag(y, 1) OVER w AS lag_1, lag(y, 2) OVER w AS lag_2, lag(y, 3) OVER w AS lag_3,
  avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 3 PRECEDING) AS mean_4, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 7 PRECEDING) AS mean_8, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 12 PRECEDING) AS mean_13,
  avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 51 PRECEDING) AS mean_52, avg(y * y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 12 PRECEDING) AS s13 FROM g WINDOW w AS (PARTITION BY port_id ORDER BY week_start)) WINDOW w AS (PARTITION BY port_id ORDER BY week_start)""", *BASE))
def history_features(spark: SparkSession, sf: str) -> DataFrame:
    return pa.history_features(weekly_grid(spark, sf), "port_id", "week_start")


FORECASTS = """f0 AS (SELECT *, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 7 PRECEDING) AS m8, avg(y) OVER (PARTITION BY port_id ORDER BY week_start ROWS 3 PRECEDING) AS last_4 FROM g),
f1 AS (SELECT *, lag(m8, 52) OVER (PARTITION BY port_id ORDER BY week_start) AS before FROM f0),
f2 AS (SELECT *, CASE WHEN m8 IS NULL OR before IS NULL THEN 1.0 WHEN before = 0 THEN 5.0 ELSE least(greatest(m8 / before, 0.2), 5.0) END AS ratio FROM f1),
fc AS (SELECT port_id, origin_week, horizon, actual, last_year, last_year * ratio AS last_year_scaled, last_4, (coalesce(last_year, 0) + coalesce(y2, 0) + coalesce(y3, 0)) / nullif((last_year IS NOT NULL)::INT + (y2 IS NOT NULL)::INT + (y3 IS NOT NULL)::INT, 0) AS seasonal_avg FROM (""" + " UNION ALL ".join(f"""SELECT port_id, week_start AS origin_week, {h} AS horizon, ratio, last_4, lead(y, {h}) OVER w AS actual, lag(y, {52 - h}) OVER w AS last_year, lag(y, {104 - h}) OVER w AS y2, lag(y, {156 - h}) OVER w AS y3 FROM f2 WINDOW w AS (PARTITION BY port_id ORDER BY week_start)""" for h in (1, 2, 3, 4)) + ") WHERE actual IS NOT NULL)"


@query("baseline_forecasts", with_views("SELECT * FROM fc", *BASE, FORECASTS))
def baseline_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return pa.baseline_forecasts(weekly_grid(spark, sf), "port_id", "week_start")


MODELS = ["last_year", "last_year_scaled", "last_4", "seasonal_avg"]
WAPE = ", ".join(f"sum(abs({m} - actual)) / nullif(sum(actual), 0) AS wape_{m}, sum(abs({m} - actual)) / nullif(sum(abs(last_year - actual)), 0) AS rel_{m}" for m in MODELS)


@query("score_wape", with_views(f"SELECT horizon, count(*) AS n, sum(actual) AS total, {WAPE} FROM fc WHERE last_year IS NOT NULL AND last_4 IS NOT NULL AND seasonal_avg IS NOT NULL GROUP BY 1", *BASE, FORECASTS))
def score_wape(spark: SparkSession, sf: str) -> DataFrame:
    return pa.score_wape(baseline_forecasts(spark, sf), ["horizon"], MODELS, "last_year")


@query("score_breakdowns", with_views(f"SELECT horizon, CAST(extract(year FROM origin_week) AS INT) AS year, count(*) AS n, sum(actual) AS total, {WAPE} FROM fc WHERE last_year IS NOT NULL AND last_4 IS NOT NULL AND seasonal_avg IS NOT NULL GROUP BY GROUPING SETS ((horizon), (2))", *BASE, FORECASTS).replace("(2))", "(year))"))
def score_breakdowns(spark: SparkSession, sf: str) -> DataFrame:
    f = baseline_forecasts(spark, sf).withColumn("year", F.year("origin_week"))
    by_h = pa.score_wape(f, ["horizon"], MODELS, "last_year").withColumn("year", F.lit(None).cast("int"))
    by_y = pa.score_wape(f, ["year"], MODELS, "last_year").withColumn("horizon", F.lit(None).cast("int"))
    return by_h.unionByName(by_y)


@query("backtest_origins", with_views("SELECT week_start AS origin_week FROM (SELECT week_start, row_number() OVER (ORDER BY week_start) AS n FROM (SELECT DISTINCT week_start FROM g WHERE y IS NOT NULL AND week_start >= DATE '1996-01-01')) WHERE (n - 1) % 4 = 0 AND week_start <= (SELECT max(week_start) FROM g WHERE y IS NOT NULL) - 28", *BASE))
def backtest_origins(spark: SparkSession, sf: str) -> DataFrame:
    known = weekly_grid(spark, sf).where("y IS NOT NULL").select("week_start").distinct()
    last = known.agg(F.date_sub(F.max("week_start"), 28).alias("last"))
    from pyspark.sql import Window

    n = F.row_number().over(Window.orderBy("week_start"))  # a row per calendar week
    out = known.where("week_start >= '1996-01-01'").withColumn("n", n).crossJoin(F.broadcast(last))
    return out.where("(n - 1) % 4 = 0 AND week_start <= last").select(F.col("week_start").alias("origin_week"))
