"""Season forecasts of grain exports, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import seasons as se
from . import explore as ex
from . import views as v
from .explore import SALES
from .views import as_cte, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()

#: Seasons needed for a fit, by anchor, and for a range; weeks on either side; fixed weights by commodity and anchor.
LEAST = {"usda": 2, "last_season": 2}
LEAST_RANGE, NEAR = 2, 2
FIXED = {("STANDARD", "usda"): 0.0, ("STANDARD", "last_season"): 1.0}

PROJECTIONS = "wd AS (SELECT f.commodity, f.season + 1 AS season, CAST(make_date(f.season + 1, 9, 10) + to_months(CAST(k AS INT)) AS DATE) AS release_date, f.final_mt * (0.9 + 0.02 * k) AS usda_mt FROM fi f CROSS JOIN generate_series(0, 11) g(k) WHERE f.season >= 1997)"


def projections(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly projections of a season's exports, made of the total of the season before; none before 1998."""
    final = ex.export_pace(spark, sf).where("final_shipped_mt IS NOT NULL").groupBy("commodity", "season").agg(F.max("final_shipped_mt").alias("f")).where("season >= 1997")
    each = final.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(11)))).withColumn("season", F.col("season") + 1)
    return each.select("commodity", "season", F.add_months(F.make_date("season", F.lit(9), F.lit(10)), F.col("k")).alias("release_date"), (F.col("f") * (0.9 + 0.02 * F.col("k"))).alias("usda_mt"))


@query("projection_history", with_views("SELECT commodity, season, release_date, usda_mt, usda_mt - lag(usda_mt) OVER (PARTITION BY commodity, season ORDER BY release_date) AS change FROM wd", SALES, PROJECTIONS))
def projection_history(spark: SparkSession, sf: str) -> DataFrame:
    """Each season's projection over its releases."""
    from pyspark.sql import Window

    before = F.lag("usda_mt").over(Window.partitionBy("commodity", "season").orderBy("release_date"))
    return projections(spark, sf).withColumn("change", F.col("usda_mt") - before)


PACE = as_cte("ep", ex.ORACLE_SQL["export_pace"], "SELECT c.commodity, c.season, c.my_week")
FRAME = """sf AS (SELECT e.commodity, e.season, e.my_week, e.week_ending, e.commitments_mt, t.last_season_mt, e.pace_projection_mt, w.usda_mt, w.release_date AS usda_release_date, t.final_mt
 FROM ep e JOIN (SELECT *, lag(final_mt) OVER (PARTITION BY commodity ORDER BY season) AS last_season_mt FROM (SELECT commodity, season, max(final_shipped_mt) AS final_mt FROM ep GROUP BY 1, 2)) t ON t.commodity = e.commodity AND t.season = e.season
 ASOF LEFT JOIN wd w ON w.commodity = e.commodity AND w.season = e.season AND e.week_ending + 7 >= w.release_date WHERE e.pace_projection_mt > 0 AND t.last_season_mt > 0),
an AS (SELECT *, CASE WHEN usda_mt > 0 THEN 'usda' ELSE 'last_season' END AS anchor, CASE WHEN usda_mt > 0 THEN usda_mt ELSE last_season_mt END AS anchor_mt FROM sf)"""
START = (SALES, PACE, PROJECTIONS, FRAME)


@query("season_frame", with_views("SELECT * FROM sf", *START))
def season_frame(spark: SparkSession, sf: str) -> DataFrame:
    return se.season_frame(ex.export_pace(spark, sf), projections(spark, sf))


@query("season_anchor", with_views("SELECT commodity, season, my_week, anchor, anchor_mt FROM an", *START))
def season_anchor(spark: SparkSession, sf: str) -> DataFrame:
    return se.anchored(season_frame(spark, sf)).select("commodity", "season", "my_week", "anchor", "anchor_mt")


FIT = """tr AS (SELECT r.commodity, r.season, r.my_week, r.anchor, count(*) AS n, count(DISTINCT h.season) AS n_train_seasons, sum(ln(h.pace_projection_mt / h.anchor_mt)) AS sx, sum(ln(h.final_mt / h.anchor_mt)) AS sy, sum(pow(ln(h.pace_projection_mt / h.anchor_mt), 2)) AS sxx, sum(ln(h.pace_projection_mt / h.anchor_mt) * ln(h.final_mt / h.anchor_mt)) AS sxy, sum(pow(ln(h.final_mt / h.anchor_mt), 2)) AS syy
  FROM an r JOIN an h ON h.commodity = r.commodity AND h.anchor = r.anchor AND h.season < r.season AND h.final_mt > 0 AND abs(h.my_week - r.my_week) <= 2 GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT h.season) >= 2),
gr AS (SELECT tr.*, i / 20.0 AS a, CASE WHEN anchor = 'usda' THEN (sy - i / 20.0 * sx) / n ELSE 0.0 END AS level FROM tr CROSS JOIN generate_series(0, 20) g(i) WHERE commodity <> 'STANDARD' OR i = CASE WHEN anchor = 'usda' THEN 0 ELSE 20 END),
fw AS (SELECT commodity, season, my_week, anchor, n_train_seasons, arg_min(a, (e, a)) AS pace_weight, arg_min(level, (e, a)) AS level_adjust FROM (SELECT *, round(syy - 2 * a * sxy + a * a * sxx - CASE WHEN anchor = 'usda' THEN n * level * level ELSE 0 END, 9) AS e FROM gr) GROUP BY 1, 2, 3, 4, 5),
fo AS (SELECT an.*, fw.n_train_seasons, fw.pace_weight, fw.level_adjust, anchor_mt * exp(level_adjust + pace_weight * ln(pace_projection_mt / anchor_mt)) AS forecast_mt FROM an JOIN fw USING (commodity, season, my_week, anchor))"""


@query("fit_pace_weight", with_views("SELECT * FROM fw", *START, FIT))
def fit_pace_weight(spark: SparkSession, sf: str) -> DataFrame:
    return se.fit_pace_weight(se.anchored(season_frame(spark, sf)), LEAST, NEAR, FIXED)


@query("season_forecast", with_views("SELECT commodity, season, my_week, anchor, forecast_mt FROM fo", *START, FIT))
def season_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return forecasts(spark, sf).select("commodity", "season", "my_week", "anchor", "forecast_mt")


def forecasts(spark: SparkSession, sf: str) -> DataFrame:
    return se.season_forecast(se.anchored(season_frame(spark, sf)), fit_pace_weight(spark, sf))


RANGE = """ra AS (SELECT r.commodity, r.season, r.my_week, r.anchor, count(DISTINCT h.season) AS n_range_seasons, CASE WHEN count(DISTINCT h.season) >= 2 THEN quantile_cont(ln(h.final_mt / h.forecast_mt), 0.1) END AS low, CASE WHEN count(DISTINCT h.season) >= 2 THEN quantile_cont(ln(h.final_mt / h.forecast_mt), 0.9) END AS high
  FROM fo r JOIN fo h ON h.commodity = r.commodity AND h.anchor = r.anchor AND h.season < r.season AND h.final_mt > 0 AND abs(h.my_week - r.my_week) <= 2 GROUP BY 1, 2, 3, 4),
gf AS (SELECT fo.*, coalesce(ra.n_range_seasons, 0) AS n_range_seasons, forecast_mt * exp(ra.low) AS forecast_low_mt, forecast_mt * exp(ra.high) AS forecast_high_mt FROM fo LEFT JOIN ra USING (commodity, season, my_week, anchor))"""


@query("forecast_range", with_views("SELECT commodity, season, my_week, anchor, n_range_seasons, forecast_low_mt, forecast_high_mt FROM gf", *START, FIT, RANGE))
def forecast_range(spark: SparkSession, sf: str) -> DataFrame:
    return ranged(spark, sf).select("commodity", "season", "my_week", "anchor", "n_range_seasons", "forecast_low_mt", "forecast_high_mt")


def ranged(spark: SparkSession, sf: str) -> DataFrame:
    return se.forecast_range(forecasts(spark, sf), LEAST_RANGE, NEAR)


@query("grain_export_forecast", with_views("SELECT commodity, season, my_week, week_ending, commitments_mt, last_season_mt, pace_projection_mt, usda_mt, usda_release_date, anchor, forecast_mt, forecast_low_mt, forecast_high_mt, pace_weight, level_adjust, n_train_seasons, n_range_seasons, final_mt FROM gf WHERE season = (SELECT max(season) FROM gf x WHERE x.commodity = gf.commodity)", *START, FIT, RANGE))
def grain_export_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """Every week of the newest season of each commodity."""
    out = ranged(spark, sf)
    newest = out.groupBy("commodity").agg(F.max("season").alias("season"))
    return out.join(newest, ["commodity", "season"], "left_semi").drop("anchor_mt")


STAGES = [(1, 8), (9, 26), (27, 39), (40, 53)]
STAGE = "CASE " + " ".join(f"WHEN my_week BETWEEN {a} AND {b} THEN 'weeks {a}-{b}'" for a, b in STAGES) + " END"
MISS = {"forecast": "forecast_mt", "pace": "pace_projection_mt", "last_season": "last_season_mt", "usda": "usda_mt"}
TESTED = f"""bt AS (SELECT commodity, anchor, {STAGE} AS stage, count(DISTINCT season) AS seasons, {", ".join(f"quantile_cont(abs({c} / final_mt - 1) * 100, 0.5) AS miss_{n}" for n, c in MISS.items())}, 100 * avg(CASE WHEN forecast_low_mt IS NOT NULL THEN CAST(final_mt BETWEEN forecast_low_mt AND forecast_high_mt AS INT) END) AS in_range_pct FROM gf WHERE final_mt IS NOT NULL GROUP BY 1, 2, 3)"""


@query("forecast_backtest", with_views("SELECT * FROM bt", *START, FIT, RANGE, TESTED))
def forecast_backtest(spark: SparkSession, sf: str) -> DataFrame:
    return se.forecast_backtest(ranged(spark, sf), STAGES, MISS)


@query("stage_months", with_views("SELECT commodity, anchor, stage, " + "CASE stage " + "".join(f" WHEN 'weeks {a}-{b}' THEN strftime(DATE '2001-09-01' + {(a - 1) * 7 + 6}, '%b') || '-' || strftime(DATE '2001-09-01' + {min(b * 7, 365) - 1}, '%b')" for a, b in STAGES) + " END AS months FROM bt", *START, FIT, RANGE, TESTED))
def stage_months(spark: SparkSession, sf: str) -> DataFrame:
    """The months of a stage of a season that starts in September."""
    return se.stage_months(forecast_backtest(spark, sf), "2001-09-01").select("commodity", "anchor", "stage", "months")
