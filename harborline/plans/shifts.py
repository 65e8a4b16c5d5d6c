"""Route-shift studies over strait transits and ports, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import port_shifts as ps
from ..operators import shifts as sh
from ..operators.keyed import keep_last
from . import views as v
from .streams import shared
from .views import ACTIVITY, PROFILES, TRANSITS, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()

TYPES = ["total", "tanker", "container", "dry_bulk"]
SUEZ, CAPE = "1-URGENT", "5-LOW"
ONSET = sh.Episode("red_sea", "1997-06-02", "1998-06-01", (SUEZ,), (CAPE, "2-HIGH"))
RETURN = sh.Episode("suez_return", "1999-09-06", "2000-03-06", (SUEZ,), (CAPE,))
RECENT = sh.Episode("recent", "2001-06-04", "2001-07-30", ("3-MEDIUM",), ("4-NOT SPECIFIED",))
EPISODES = [ONSET, RETURN, RECENT]
FOLLOWERS, LEAD_TYPE = ["container", "tanker"], "container"

WEEKLY = "w0 AS (SELECT chokepoint_id, CAST(date_trunc('week', transit_date) AS DATE) AS week_start, " + ", ".join(f"avg(CAST(n_{t} AS DOUBLE)) AS {t}" for t in TYPES) + " FROM v_transits GROUP BY 1, 2 HAVING count(*) = 7),\nwt AS (" + " UNION ALL ".join(f"SELECT chokepoint_id, week_start, '{t}' AS ship_type, {t} AS transits FROM w0" for t in TYPES) + ")"
GRID = """gt AS (SELECT s.chokepoint_id, s.ship_type, w.week_start, wt.transits AS y FROM (SELECT DISTINCT chokepoint_id, ship_type FROM wt) s CROSS JOIN (SELECT CAST(unnest(generate_series(a, b, INTERVAL 7 DAY)) AS DATE) AS week_start FROM (SELECT min(week_start) AS a, max(week_start) AS b FROM wt)) w
  LEFT JOIN wt ON wt.chokepoint_id = s.chokepoint_id AND wt.ship_type = s.ship_type AND wt.week_start = w.week_start)"""
EPISODE_ROWS = "ep AS (SELECT episode, chokepoint_id, role, place, CAST(s AS DATE) AS start_week, CAST(s AS DATE) - 28 AS from_day, CAST(e AS DATE) AS to_day FROM (VALUES " + ", ".join(f"('{e.name}', '{c}', '{role}', {i}, '{e.start}', '{e.end}')" for e in EPISODES for role, cs in (("route", e.route), ("alternative", e.alternatives)) for i, c in enumerate(cs)) + ") t(episode, chokepoint_id, role, place, s, e))"
PLACEBOS = """ps AS (SELECT chokepoint_id, method, start_week FROM (SELECT chokepoint_id, m.method, week_start AS start_week, CASE WHEN m.method = 'raw' THEN lo_raw ELSE lo_sea END AS lo, hi FROM (SELECT chokepoint_id, week_start, lag(week_start, 10) OVER w AS lo_raw, lag(week_start, 62) OVER w AS lo_sea, lead(week_start, 26) OVER w AS hi
   FROM (SELECT DISTINCT chokepoint_id, week_start FROM gt) WINDOW w AS (PARTITION BY chokepoint_id ORDER BY week_start)) CROSS JOIN (VALUES ('raw'), ('seasonal')) m(method)) x
  WHERE lo IS NOT NULL AND hi IS NOT NULL AND NOT EXISTS (SELECT 1 FROM ep WHERE ep.chokepoint_id = x.chokepoint_id AND x.hi >= ep.from_day AND x.lo <= ep.to_day))"""
PATHS = """bs AS (SELECT *, lag(base, 52) OVER o AS base_ya, y - lag(y, 52) OVER o AS dy FROM (SELECT *, CASE WHEN count(y) OVER w >= 4 THEN avg(y) OVER w END AS base FROM gt WINDOW w AS (PARTITION BY chokepoint_id, ship_type ORDER BY week_start ROWS BETWEEN 10 PRECEDING AND 3 PRECEDING)) WINDOW o AS (PARTITION BY chokepoint_id, ship_type ORDER BY week_start)),
pa AS (SELECT p.chokepoint_id, b.ship_type, p.method, p.start_week, CAST(k AS INT) AS off, CASE WHEN p.method = 'raw' THEN t.y - b.base ELSE t.dy - (b.base - b.base_ya) END AS change FROM ps p JOIN bs b ON b.chokepoint_id = p.chokepoint_id AND b.week_start = p.start_week CROSS JOIN generate_series(0, 26) g(k)
  LEFT JOIN bs t ON t.chokepoint_id = b.chokepoint_id AND t.ship_type = b.ship_type AND t.week_start = p.start_week + CAST(7 * k AS INT))"""
MEASURED = """nz AS (SELECT chokepoint_id, ship_type, method, sqrt(avg(m * m)) AS noise FROM (SELECT chokepoint_id, ship_type, method, start_week, CASE WHEN count(change) >= 7 THEN round(avg(change), 12) END AS m FROM pa WHERE off BETWEEN 13 AND 26 GROUP BY 1, 2, 3, 4) GROUP BY 1, 2, 3),
me AS (SELECT s.chokepoint_id, s.ship_type, coalesce(arg_min(nz.method, (nz.noise, nz.method)) FILTER (WHERE nz.noise IS NOT NULL), 'raw') AS method FROM (SELECT DISTINCT chokepoint_id, ship_type FROM gt) s LEFT JOIN nz ON nz.chokepoint_id = s.chokepoint_id AND nz.ship_type = s.ship_type GROUP BY 1, 2),
rp AS (SELECT ep.episode, ep.role, me.chokepoint_id, me.ship_type, me.method, ep.start_week, CAST(k AS INT) AS off, b.base, CASE WHEN me.method = 'raw' THEN t.y - b.base ELSE t.dy - (b.base - b.base_ya) END AS change FROM ep JOIN me ON me.chokepoint_id = ep.chokepoint_id JOIN bs b ON b.chokepoint_id = me.chokepoint_id AND b.ship_type = me.ship_type AND b.week_start = ep.start_week
  CROSS JOIN generate_series(0, 26) g(k) LEFT JOIN bs t ON t.chokepoint_id = b.chokepoint_id AND t.ship_type = b.ship_type AND t.week_start = ep.start_week + CAST(7 * k AS INT)),
r1 AS (SELECT *, coalesce(max(CASE WHEN change IS NOT NULL THEN off END) OVER (PARTITION BY episode, role, chokepoint_id, ship_type) + 1, 0) AS seen, avg(change) OVER (PARTITION BY episode, role, chokepoint_id, ship_type ORDER BY off ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS smooth FROM rp),
r2 AS (SELECT *, CASE WHEN seen > 13 THEN 13 ELSE greatest(0, seen - 3) END AS f, CASE WHEN seen > 13 THEN 26 ELSE seen - 1 END AS l FROM r1),
o1 AS (SELECT episode, role, chokepoint_id, ship_type, method, seen AS weeks_seen, seen > 13 AS settled, max(base) AS before, f, l, CASE WHEN count(change) FILTER (WHERE off BETWEEN f AND l) >= greatest(1, (l - f + 1) // 2) THEN round(avg(change) FILTER (WHERE off BETWEEN f AND l), 12) END AS change FROM r2 GROUP BY episode, role, chokepoint_id, ship_type, method, seen, f, l),
on1 AS (SELECT chokepoint_id, ship_type, method, f, l, sqrt(avg(m * m)) AS noise FROM (SELECT pa.chokepoint_id, pa.ship_type, pa.method, f, l, start_week, CASE WHEN count(change) >= greatest(1, (l - f + 1) // 2) THEN round(avg(change), 12) END AS m FROM pa JOIN (SELECT DISTINCT chokepoint_id, ship_type, method, f, l FROM o1) w ON w.chokepoint_id = pa.chokepoint_id AND w.ship_type = pa.ship_type AND w.method = pa.method WHERE off BETWEEN f AND l GROUP BY 1, 2, 3, 4, 5, 6) GROUP BY 1, 2, 3, 4, 5),
o2 AS (SELECT o1.*, on1.noise, CASE WHEN on1.noise > 0 THEN o1.change / on1.noise END AS z, coalesce(c.n, 0) AS placebos FROM o1 LEFT JOIN on1 ON on1.chokepoint_id = o1.chokepoint_id AND on1.ship_type = o1.ship_type AND on1.method = o1.method AND on1.f = o1.f AND on1.l = o1.l LEFT JOIN (SELECT chokepoint_id, method, count(*) AS n FROM ps GROUP BY 1, 2) c ON c.chokepoint_id = o1.chokepoint_id AND c.method = o1.method),
ms AS (SELECT o2.episode, o2.role, o2.chokepoint_id, o2.ship_type, o2.method, o2.weeks_seen, o2.settled, o2.before, o2.change, o2.noise, o2.z, o2.placebos, min(off) FILTER (WHERE abs(z) >= 2 AND sign(o2.change) * smooth >= 0.5 * abs(o2.change)) AS half_weeks, min(off) FILTER (WHERE abs(z) >= 2 AND sign(o2.change) * smooth >= 0.9 * abs(o2.change)) AS most_weeks
  FROM o2 JOIN r2 ON r2.episode = o2.episode AND r2.role = o2.role AND r2.chokepoint_id = o2.chokepoint_id AND r2.ship_type = o2.ship_type GROUP BY o2.episode, o2.role, o2.chokepoint_id, o2.ship_type, o2.method, o2.weeks_seen, o2.settled, o2.before, o2.change, o2.noise, o2.z, o2.placebos)"""
STUDY = (TRANSITS, WEEKLY, GRID, EPISODE_ROWS, PLACEBOS, PATHS, MEASURED)


@query("weekly_transits", with_views("SELECT * FROM wt", TRANSITS, WEEKLY))
def weekly_transits(spark: SparkSession, sf: str) -> DataFrame:
    """From daily copies of which the last of each day counts."""
    daily = v.transits(spark, sf).withColumn("seq", F.lit(2))
    older = daily.where("day(transit_date) % 9 = 0").withColumns({"n_total": F.col("n_total") + 5, "seq": F.lit(1)})
    return sh.weekly_transits(keep_last(daily.unionByName(older), ["chokepoint_id", "transit_date"], "seq"), TYPES)


@query("series_grid", with_views("SELECT * FROM gt", TRANSITS, WEEKLY, GRID))
def series_grid(spark: SparkSession, sf: str) -> DataFrame:
    return sh.series_grid(weekly_transits(spark, sf))


def episodes(spark: SparkSession) -> DataFrame:
    return sh.episode_rows(spark, EPISODES)


@query("placebo_starts", with_views("SELECT * FROM ps", TRANSITS, WEEKLY, GRID, EPISODE_ROWS, PLACEBOS))
def placebo_starts(spark: SparkSession, sf: str) -> DataFrame:
    return sh.placebo_starts(series_grid(spark, sf), episodes(spark))


@query("measure_episodes", with_views("SELECT episode, role, chokepoint_id, ship_type, method, weeks_seen, settled, before, change, noise, z, placebos FROM ms", *STUDY))
def measure_episodes(spark: SparkSession, sf: str) -> DataFrame:
    return measured(spark, sf).drop("half_weeks", "most_weeks")


def measured(spark: SparkSession, sf: str) -> DataFrame:
    return sh.measure_episodes(v.stored(series_grid(spark, sf)), episodes(spark))


@query("weeks_to_fraction", with_views("SELECT episode, role, chokepoint_id, ship_type, half_weeks, most_weeks FROM ms", *STUDY))
def weeks_to_fraction(spark: SparkSession, sf: str) -> DataFrame:
    return measured(spark, sf).select("episode", "role", "chokepoint_id", "ship_type", "half_weeks", "most_weeks")


@query("route_transfers", with_views("""SELECT l.episode, l.ship_type, l.change AS route_change, a.alt_change, CASE WHEN abs(l.change) >= 2 * l.noise THEN -a.alt_change / nullif(l.change, 0) END AS ratio, CASE WHEN abs(l.change) >= 2 * l.noise THEN sqrt(a.na2 + pow(-a.alt_change / nullif(l.change, 0) * l.noise, 2)) / nullif(abs(l.change), 0) END AS ratio_noise
 FROM ms l JOIN ep ON ep.episode = l.episode AND ep.chokepoint_id = l.chokepoint_id AND ep.role = 'route' AND ep.place = 0 AND l.role = 'route' JOIN (SELECT episode, ship_type, sum(change) AS alt_change, sum(noise * noise) AS na2 FROM ms WHERE role = 'alternative' GROUP BY 1, 2) a ON a.episode = l.episode AND a.ship_type = l.ship_type""", *STUDY))
def route_transfers(spark: SparkSession, sf: str) -> DataFrame:
    return sh.route_transfers(v.stored(measured(spark, sf)), episodes(spark))


CURVE = f"""lc AS (SELECT ship_type, off, least(max(share) OVER (PARTITION BY ship_type ORDER BY off), 1.0) AS share FROM (SELECT r2.ship_type, r2.off, coalesce(greatest(r2.smooth / nullif(ms.change, 0), 0.0), 0.0) AS share FROM r2 JOIN ms ON ms.episode = r2.episode AND ms.role = r2.role AND ms.chokepoint_id = r2.chokepoint_id AND ms.ship_type = r2.ship_type WHERE r2.episode = 'red_sea' AND r2.chokepoint_id = '{CAPE}'))"""
FITTED = f"""fb AS (SELECT ship_type, max(change) FILTER (WHERE episode = 'red_sea' AND chokepoint_id = '{CAPE}') AS gain, max(change) FILTER (WHERE episode = 'suez_return' AND chokepoint_id = '{CAPE}') AS now, max(change) FILTER (WHERE episode = 'red_sea' AND chokepoint_id = '{SUEZ}') AS s0, max(change) FILTER (WHERE episode = 'suez_return' AND chokepoint_id = '{SUEZ}') AS s1 FROM ms GROUP BY 1),
fr AS (SELECT b.ship_type, b.gain, b.now, o.suez_part, o.cape_part, least(greatest((o.suez_part + o.cape_part) / 2, 0.0), 1.0) AS share_back FROM fb b CROSS JOIN (SELECT s1 / nullif(-s0, 0) AS suez_part, -now / nullif(gain, 0) AS cape_part FROM fb WHERE ship_type = 'container') o)"""
STEP = f"""nw AS (SELECT g.ship_type, l.last_week, avg(g.y) AS level FROM gt g JOIN (SELECT ship_type, max(week_start) AS last_week FROM gt WHERE chokepoint_id = '{CAPE}' AND y IS NOT NULL GROUP BY 1) l ON l.ship_type = g.ship_type AND g.week_start BETWEEN l.last_week - 14 AND l.last_week WHERE g.chokepoint_id = '{CAPE}' GROUP BY 1, 2),
yr AS (SELECT nw.ship_type, nw.last_week, CAST(n AS INT) AS n, nw.last_week - 14 - CAST(364 * n AS INT) AS lo, nw.last_week + 56 - CAST(364 * n AS INT) AS hi FROM nw CROSS JOIN generate_series(1, 40) g(n)),
yu AS (SELECT yr.*, (SELECT avg(y) FROM gt WHERE gt.chokepoint_id = '{CAPE}' AND gt.ship_type = yr.ship_type AND gt.week_start BETWEEN yr.lo AND yr.lo + 14) AS usual FROM yr WHERE lo >= (SELECT min(week_start) FROM gt) AND NOT EXISTS (SELECT 1 FROM ep WHERE ep.chokepoint_id = '{CAPE}' AND yr.hi >= ep.from_day AND yr.lo <= ep.to_day)),
st AS (SELECT yu.ship_type, CAST(k AS INT) AS step, coalesce(avg(g.y - yu.usual), 0.0) AS season FROM yu CROSS JOIN generate_series(1, 8) s(k) LEFT JOIN gt g ON g.chokepoint_id = '{CAPE}' AND g.ship_type = yu.ship_type AND g.week_start = yu.last_week + CAST(7 * k AS INT) - 364 * yu.n GROUP BY 1, 2)"""
MIRROR = f"""mf AS (SELECT nw.last_week + CAST(7 * k AS INT) AS week_start, nw.ship_type, CAST((nw.last_week - DATE '{RETURN.start}') // 7 + k AS INT) AS weeks_since_return, nw.level + CASE WHEN m.method = 'seasonal' THEN coalesce(st.season, 0) ELSE 0 END AS no_change,
  nw.level + CASE WHEN m.method = 'seasonal' THEN coalesce(st.season, 0) ELSE 0 END + CASE WHEN nw.ship_type IN ('container', 'tanker') THEN -fr.share_back * fr.gain * lc.share - fr.now ELSE 0 END AS model, nw.level + CASE WHEN m.method = 'seasonal' THEN coalesce(st.season, 0) ELSE 0 END - (fr.gain + fr.now) AS all_back
 FROM nw CROSS JOIN generate_series(1, 8) s(k) JOIN fr ON fr.ship_type = nw.ship_type JOIN ms m ON m.episode = 'red_sea' AND m.chokepoint_id = '{CAPE}' AND m.ship_type = nw.ship_type LEFT JOIN st ON st.ship_type = nw.ship_type AND st.step = k
  LEFT JOIN lc ON lc.ship_type = nw.ship_type AND lc.off = least((nw.last_week - DATE '{RETURN.start}') // 7 + k, 26))"""
RESPONSE = (*STUDY, CURVE, FITTED, STEP, MIRROR)


@query("lag_curve", with_views('SELECT ship_type, off AS "offset", share FROM lc', *STUDY, CURVE))
def lag_curve(spark: SparkSession, sf: str) -> DataFrame:
    grid = v.stored(series_grid(spark, sf))
    return sh.lag_curve(grid, v.stored(sh.measure_episodes(grid, episodes(spark))), ONSET.name, CAPE, ONSET.start)


@query("fit_return", with_views("SELECT * FROM fr", *STUDY, FITTED))
def fit_return(spark: SparkSession, sf: str) -> DataFrame:
    return sh.fit_return(v.stored(measured(spark, sf)), ONSET.name, RETURN.name, SUEZ, CAPE, LEAD_TYPE)


@query("seasonal_step", with_views("SELECT * FROM st", *STUDY, STEP))
def seasonal_step(spark: SparkSession, sf: str) -> DataFrame:
    return sh.seasonal_step(v.stored(series_grid(spark, sf)), episodes(spark), CAPE)


def mirrored(spark: SparkSession, weekly: DataFrame) -> DataFrame:
    grid, e = v.stored(sh.series_grid(weekly)), episodes(spark)
    return sh.mirror_forecast(grid, v.stored(sh.measure_episodes(grid, e)), e, ONSET, RETURN, SUEZ, CAPE, FOLLOWERS, LEAD_TYPE)


@query("mirror_forecast", with_views("SELECT * FROM mf", *RESPONSE))
def mirror_forecast(spark: SparkSession, sf: str) -> DataFrame:
    return mirrored(spark, weekly_transits(spark, sf))


#: What was known when the forecast was frozen.
FROZEN_AT = "2001-06-04"
EARLY = ("wt AS (SELECT * FROM wa0 WHERE week_start < DATE '" + FROZEN_AT + "')",)
FROZEN = (TRANSITS, WEEKLY.replace("\nwt AS", "\nwa0 AS"), *EARLY, *RESPONSE[2:])


@query("freeze_forecast", with_views(f"SELECT *, DATE '{FROZEN_AT}' AS frozen_on, (SELECT max(week_start) FROM wt) AS data_through FROM mf", *FROZEN))
def freeze_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """A dated forecast, written once with what it was made of, and read back."""
    weekly = weekly_transits(spark, sf).where(F.col("week_start") < FROZEN_AT)
    through = weekly.agg(F.max("week_start").alias("data_through"))
    out = mirrored(spark, weekly).withColumn("frozen_on", F.to_date(F.lit(FROZEN_AT))).crossJoin(F.broadcast(through))
    path = f"{shared(spark)}/frozen_on={FROZEN_AT}"
    out.write.mode("error").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


@query("forecast_mae", with_views("SELECT coalesce(ship_type, 'all') AS ship_type, count(*) AS weeks, avg(abs(model - actual)) AS model, avg(abs(no_change - actual)) AS no_change, avg(abs(all_back - actual)) AS all_back FROM (SELECT mf.*, a.transits AS actual FROM mf JOIN wa0 a ON a.chokepoint_id = '5-LOW' AND a.ship_type = mf.ship_type AND a.week_start = mf.week_start) GROUP BY GROUPING SETS ((ship_type), ())", *FROZEN))
def forecast_mae(spark: SparkSession, sf: str) -> DataFrame:
    return sh.forecast_mae(freeze_forecast(spark, sf), weekly_transits(spark, sf), CAPE)


@query("forecast_panel", with_views("SELECT coalesce(a.week_start, f.week_start) AS week_start, coalesce(a.ship_type, f.ship_type) AS ship_type, a.transits AS actual, f.model, f.no_change, f.all_back FROM (SELECT * FROM wa0 WHERE chokepoint_id = '5-LOW' AND week_start >= DATE '2000-01-01') a FULL JOIN mf f ON f.week_start = a.week_start AND f.ship_type = a.ship_type", *FROZEN))
def forecast_panel(spark: SparkSession, sf: str) -> DataFrame:
    """Actual weeks beside the frozen forecasts."""
    actual = weekly_transits(spark, sf).where((F.col("chokepoint_id") == CAPE) & (F.col("week_start") >= "2000-01-01")).select("week_start", "ship_type", F.col("transits").alias("actual"))
    return actual.join(freeze_forecast(spark, sf).select("week_start", "ship_type", *sh.FORECASTS), ["week_start", "ship_type"], "full")


# --- ports

METRICS = {"calls": "calls", "tanker": "calls", "imports": "imports", "exports": "imports"}
LEAST = {"calls": 0.5, "imports": 5.0}
SHOCK, PAIRS = (1999, 2000), [(1996, 1997), (1997, 1998), (1998, 1999)]
NAME = "1999-2000"
LEVELS = """sw AS (SELECT port_id, CAST(extract(year FROM activity_date) AS INT) AS year, CAST(sum(portcalls) AS DOUBLE) AS calls, CAST(sum(portcalls_tanker) AS DOUBLE) AS tanker, sum(import_total) AS imports, sum(export_total) AS exports, count(*) AS days FROM v_activity WHERE extract(month FROM activity_date) BETWEEN 2 AND 7 GROUP BY 1, 2),
lv AS (""" + " UNION ALL ".join(f"SELECT port_id, year, '{m}' AS metric, {m} / (days / 7.0) AS weekly FROM sw WHERE days >= 0.95 * (SELECT max(days) FROM sw)" for m in METRICS) + ")"
CHANGED = f"""pc AS (SELECT *, lr - quantile_cont(lr, 0.5) OVER (PARTITION BY pair, metric, band) AS effect FROM (SELECT a.port_id, a.metric, CAST(a.year AS VARCHAR) || '-' || CAST(b.year AS VARCHAR) AS pair, CASE WHEN s.weekly < 2.5 * l THEN 'small' WHEN s.weekly < 7.5 * l THEN 'medium' ELSE 'large' END AS band, a.weekly AS weekly_before, b.weekly AS weekly_after, ln((b.weekly + 1) / (a.weekly + 1)) AS lr
  FROM lv a JOIN lv b ON b.port_id = a.port_id AND b.metric = a.metric AND b.year = a.year + 1 JOIN (VALUES {", ".join(f"('{m}', '{s}', {LEAST[s]})" for m, s in METRICS.items())}) t(metric, size_metric, l) ON t.metric = a.metric JOIN lv s ON s.port_id = a.port_id AND s.year = a.year AND s.metric = t.size_metric WHERE s.weekly >= l AND a.year BETWEEN 1996 AND 1999))"""
FLAGGED = """bn AS (SELECT metric, band, max(effect) FILTER (WHERE r = 1 + CAST(round(0.025 * (n - 1)) AS BIGINT)) AS usual_low, max(effect) FILTER (WHERE r = 1 + CAST(round(0.975 * (n - 1)) AS BIGINT)) AS usual_high FROM (SELECT *, row_number() OVER (PARTITION BY metric, band ORDER BY effect) AS r, count(*) OVER (PARTITION BY metric, band) AS n FROM pc WHERE pair <> '1999-2000') GROUP BY 1, 2),
fs AS (SELECT p.port_id, p.metric, p.band, p.weekly_before, p.weekly_after, p.effect, usual_low, usual_high, port_extreme, coalesce(port_pairs, 0) AS port_pairs, p.effect NOT BETWEEN usual_low AND usual_high AS beyond_usual, p.effect NOT BETWEEN usual_low AND usual_high AND abs(p.effect) > coalesce(port_extreme, 0) AS flagged, (exp(p.effect) - 1) * 100 AS percent
  FROM pc p LEFT JOIN bn ON bn.metric = p.metric AND bn.band = p.band LEFT JOIN (SELECT port_id, metric, max(abs(effect)) AS port_extreme, count(*) AS port_pairs FROM pc WHERE pair <> '1999-2000' GROUP BY 1, 2) o ON o.port_id = p.port_id AND o.metric = p.metric WHERE p.pair = '1999-2000')"""
#: A box of latitudes and longitudes that is a group of its own, and reasons other than the shock, by port name or country code.
BOXES, REASONS = {"Red Sea": (-30.0, 30.0, -60.0, 60.0)}, [("port_name", {"NATION_3": "strike", "NATION_8": "new terminal"}), ("iso3", {"NAT": "sanctions"})]
GROUPS = """gl AS (SELECT port_id, CASE WHEN latitude BETWEEN -30 AND 30 AND longitude BETWEEN -60 AND 60 THEN 'Red Sea' ELSE continent END AS "group", coalesce(CASE port_name WHEN 'NATION_3' THEN 'strike' WHEN 'NATION_8' THEN 'new terminal' END, CASE upper(substr(port_name, 1, 3)) WHEN 'NAT' THEN 'sanctions' END) AS confounder FROM v_profiles)"""
PORTS = (ACTIVITY, LEVELS, CHANGED)


def windows(spark: SparkSession, sf: str) -> DataFrame:
    a = v.activity(spark, sf).where("month(activity_date) BETWEEN 2 AND 7")
    total = lambda c, n: F.sum(F.col(c).cast("double")).alias(n)
    return a.groupBy("port_id", F.year("activity_date").alias("year")).agg(total("portcalls", "calls"), total("portcalls_tanker", "tanker"), total("import_total", "imports"), total("export_total", "exports"), F.count("*").alias("days"))


@query("weekly_levels", with_views("SELECT * FROM lv", ACTIVITY, LEVELS))
def weekly_levels(spark: SparkSession, sf: str) -> DataFrame:
    return ps.weekly_levels(windows(spark, sf), list(METRICS))


def changed(spark: SparkSession, sf: str, pairs: list[tuple[int, int]]) -> DataFrame:
    return ps.port_changes(weekly_levels(spark, sf), pairs, METRICS, LEAST)


@query("flag_shifts", with_views("SELECT * FROM fs", *PORTS, FLAGGED))
def flag_shifts(spark: SparkSession, sf: str) -> DataFrame:
    return ps.flag_shifts(changed(spark, sf, [SHOCK, *PAIRS]), NAME)


@query("flag_counts", with_views("SELECT metric, count(*) AS ports, count(*) FILTER (WHERE beyond_usual) AS outside_band, count(*) * 0.05 AS expected_by_chance, count(*) FILTER (WHERE flagged) AS flagged, count(*) FILTER (WHERE flagged AND effect > 0) AS gained, count(*) FILTER (WHERE flagged AND effect < 0) AS lost FROM fs GROUP BY 1", *PORTS, FLAGGED))
def flag_counts(spark: SparkSession, sf: str) -> DataFrame:
    return ps.flag_counts(flag_shifts(spark, sf))


@query("label_groups", with_views('SELECT * FROM gl', PROFILES, GROUPS))
def label_groups(spark: SparkSession, sf: str) -> DataFrame:
    return ps.label_groups(v.profiles(spark, sf).withColumn("iso3", F.upper(F.substring("port_name", 1, 3))), BOXES, REASONS).select("port_id", "group", "confounder")


@query("group_effects", with_views("""SELECT s.*, coalesce(p.pairs, 0) AS pairs, p.noise, s.mean / p.noise AS z FROM (SELECT "group", metric, avg(effect) AS mean, count(*) AS ports FROM pc JOIN gl USING (port_id) WHERE pair = '1999-2000' GROUP BY 1, 2) s
 LEFT JOIN (SELECT "group", metric, count(*) AS pairs, sqrt(avg(m * m)) AS noise FROM (SELECT "group", metric, pair, avg(effect) AS m FROM pc JOIN gl USING (port_id) WHERE pair <> '1999-2000' GROUP BY 1, 2, 3) GROUP BY 1, 2) p ON p."group" = s."group" AND p.metric = s.metric""", ACTIVITY, PROFILES, LEVELS, CHANGED, GROUPS))
def group_effects(spark: SparkSession, sf: str) -> DataFrame:
    return ps.group_effects(changed(spark, sf, [SHOCK, *PAIRS]).join(label_groups(spark, sf), "port_id"), NAME)
