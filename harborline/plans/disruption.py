"""Features, scores and reports of drop warnings, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import clip, safe_ratio
from ..operators import events as ev
from ..operators import panels as pa
from ..operators import scoring as sc
from ..operators.spatial import nearest_k, spatial_join
from ..operators.temporal import rows
from . import explore as ex
from . import panels as pl
from . import views as v
from . import warnings as wa
from .panels import BASE, FULL, LABELS, PLACES
from .vessels import KM
from .views import ACTIVITY, HAZARDS, PROFILES, TRANSITS, as_cte, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()
KEYS = ["origin_week", "target_week", "horizon", "port_id"]
MODELS = ["last_z", "last_drop", "base_rate"]
SHARE = 0.05

# --- scores

LONG = "ml AS (" + " UNION ALL ".join(f"SELECT '{m}' AS model, origin_week, target_week, horizon, port_id, y, coalesce(big, false) AS big, {m} AS score FROM sc" for m in MODELS) + ")"
SIZES = as_cte("sb", pl.ORACLE_SQL["size_band"], "SELECT port_id, week_start, CASE WHEN m < 5")


def scored_sql(source: str, keys: str, budget: str) -> str:
    """SQL of score_models over a long table."""
    return f"""SELECT * FROM (SELECT {keys}, count(*) AS n, avg(y) AS rate, count(*) FILTER (WHERE flagged AND y = 1) / nullif(count(*) FILTER (WHERE flagged), 0) AS precision,
  count(*) FILTER (WHERE flagged AND y = 1) / nullif(sum(y), 0) AS recall, count(*) FILTER (WHERE flagged AND big) / nullif(count(*) FILTER (WHERE big), 0) AS big_recall
  FROM (SELECT *, row_number() OVER (PARTITION BY {keys}, {budget} ORDER BY score DESC, port_id) <= ceil(count(*) OVER (PARTITION BY {keys}, {budget}) * {SHARE}) AS flagged FROM {source}) GROUP BY {keys})
 JOIN (SELECT {keys}, sum(tp * ctp / cn) / nullif(sum(tp), 0) AS average_precision FROM (SELECT {keys}, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM (
  SELECT {keys}, score, CAST(sum(y) AS DOUBLE) AS tp, count(*) AS n FROM {source} GROUP BY {keys}, score) WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC)) GROUP BY {keys}) USING ({keys})"""


def long_scores(spark: SparkSession, sf: str) -> DataFrame:
    return pa.rule_scores(pl.warning_rows(spark, sf)).unpivot([*KEYS, "y", "big"], MODELS, "model", "score")


@query("score_warnings", with_views(scored_sql("ml", "model, horizon", "origin_week"), *FULL, LONG))
def score_warnings(spark: SparkSession, sf: str) -> DataFrame:
    return sc.score_models(long_scores(spark, sf), ["horizon"], ["origin_week"], "port_id", SHARE)


GROUPED = """mg AS (SELECT ml.*, 'all' AS grouping, 'all' AS value FROM ml UNION ALL SELECT ml.*, 'horizon', CAST(horizon AS VARCHAR) FROM ml UNION ALL SELECT ml.*, 'year', CAST(extract(year FROM origin_week) AS VARCHAR) FROM ml
  UNION ALL SELECT ml.*, 'size', coalesce(size_band, 'unknown') FROM ml LEFT JOIN sb ON sb.port_id = ml.port_id AND sb.week_start = ml.origin_week)"""


@query("rule_backtest", with_views(scored_sql("mg", "model, grouping, value", "origin_week, horizon"), *FULL, LONG, SIZES, GROUPED))
def rule_backtest(spark: SparkSession, sf: str) -> DataFrame:
    """All rows, and by horizon, size of the port and year."""
    sizes = pl.size_band(spark, sf).withColumnRenamed("week_start", "origin_week")
    long = long_scores(spark, sf).join(sizes, ["port_id", "origin_week"], "left")
    each = sc.in_groups(long, {"all": F.lit("all"), "horizon": F.col("horizon"), "year": F.year("origin_week"), "size": F.coalesce("size_band", F.lit("unknown"))})
    return sc.score_models(each, ["grouping", "value"], ["origin_week", "horizon"], "port_id", SHARE)


GOAL = "sw AS (" + scored_sql("ml", "model, horizon", "origin_week") + ")"


@query("goal_check", with_views("SELECT m.horizon, m.average_precision AS model_ap, r.rule_ap, m.average_precision / nullif(r.rule_ap, 0) AS ratio, m.precision, m.recall FROM sw m JOIN (SELECT horizon, max(average_precision) AS rule_ap FROM sw WHERE model <> 'last_drop' GROUP BY 1) r ON r.horizon = m.horizon WHERE m.model = 'last_drop'", *FULL, LONG, GOAL))
def goal_check(spark: SparkSession, sf: str) -> DataFrame:
    """One model against the best of the other rules, by horizon."""
    s = score_warnings(spark, sf)
    rule = s.where("model <> 'last_drop'").groupBy("horizon").agg(F.max("average_precision").alias("rule_ap"))
    m = s.where("model = 'last_drop'").select("horizon", F.col("average_precision").alias("model_ap"), "precision", "recall")
    return m.join(rule, "horizon").withColumn("ratio", safe_ratio(F.col("model_ap"), F.col("rule_ap")))


@query("pr_curve", with_views("""SELECT k, n, tp / n AS precision, tp / all_tp AS recall FROM (SELECT DISTINCT CAST(round(pow(10, i * log10(all_n) / 59)) AS BIGINT) AS k, all_tp FROM (SELECT max(n) AS all_n, max(tp) AS all_tp FROM bl) CROSS JOIN generate_series(0, 59) g(i)) JOIN bl ON k > bl.before AND k <= bl.n""", *FULL, """bl AS (SELECT block, CAST(sum(n) OVER w AS BIGINT) AS n, CAST(sum(tp) OVER w AS BIGINT) AS tp, CAST(sum(n) OVER w AS BIGINT) - n AS before FROM (SELECT CAST(round(base_rate / 0.001) AS BIGINT) AS block, count(*) AS n, sum(y) AS tp FROM wa GROUP BY 1) WINDOW w AS (ORDER BY block DESC))"""))
def pr_curve(spark: SparkSession, sf: str) -> DataFrame:
    return sc.pr_curve(pl.warning_rows(spark, sf), "base_rate")


RADII = [0.0, 100.0, 200.0, 300.0, 500.0, 800.0]
ATT = (*FULL, PROFILES, HAZARDS, wa.PREPARED, wa.EXPOSED, wa.ATTACHED)


@query("tune_radius", with_views("""SELECT arg_max(radius, (ap, -radius)) AS radius, max(ap) AS average_precision FROM (SELECT radius, coalesce(sum(tp * ctp / cn) / nullif(sum(tp), 0), 0) AS ap FROM (
  SELECT radius, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM (SELECT r.radius, CAST(coalesce(a.event_km <= r.radius, false) OR a.event_listed AS INT) + s.base_rate / 2 AS score, CAST(sum(a.y) AS DOUBLE) AS tp, count(*) AS n
   FROM att a JOIN sc s USING (origin_week, target_week, horizon, port_id) CROSS JOIN (SELECT unnest([0.0, 100.0, 200.0, 300.0, 500.0, 800.0]) AS radius) r WHERE a.origin_week < DATE '1999-01-01' GROUP BY 1, 2) WINDOW w AS (PARTITION BY radius ORDER BY score DESC)) GROUP BY 1)""", *ATT))
def tune_radius(spark: SparkSession, sf: str) -> DataFrame:
    """The radius whose event rule has the best average precision on early origins, the smaller at a tie."""
    rates = pl.warning_rows(spark, sf).select(*KEYS, "base_rate")
    known = wa.attach_events(spark, sf).where("origin_week < '1999-01-01'").join(rates, KEYS)
    each = known.withColumn("radius", F.explode(F.array(*map(F.lit, RADII))))
    hit = F.coalesce(F.col("event_km") <= F.col("radius"), F.lit(False)) | F.col("event_listed")
    ap = pa.average_precision(each.withColumn("score", hit.cast("int") + F.col("base_rate") / 2), ["radius"], "score", "y").withColumn("ap", F.coalesce("average_precision", F.lit(0.0)))
    return ap.agg(F.max_by("radius", F.struct("ap", -F.col("radius"))).alias("radius"), F.max("ap").alias("average_precision"))


# --- features

YEAR_AGO = """ya AS (SELECT port_id, week_start + 364 AS target_week, coalesce(lag(is_drop) OVER w, false) OR coalesce(is_drop, false) OR coalesce(lead(is_drop) OVER w, false) AS dropped_last_year FROM lb WINDOW w AS (PARTITION BY port_id ORDER BY week_start))"""


@query("year_ago_drops", with_views("SELECT * FROM ya", *BASE, LABELS, YEAR_AGO))
def year_ago_drops(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a port dropped within a week of the target week a year before it."""
    w = Window.partitionBy("port_id").orderBy("week_start")
    known = lambda c: F.coalesce(c, F.lit(False))
    near = known(F.lag("is_drop").over(w)) | known(F.col("is_drop")) | known(F.lead("is_drop").over(w))
    return pl.label_drops(spark, sf).select("port_id", F.date_add("week_start", 364).alias("target_week"), near.alias("dropped_last_year"))


EVENT_FEATURES = """ef AS (SELECT w.origin_week, w.target_week, w.horizon, w.port_id, count(*) AS event_n, count(*) FILTER (WHERE e.is_red) AS event_n_red, min(e.km) FILTER (WHERE e.is_red) AS event_red_km, min(w.target_week - e.from_date) AS event_days, arg_min(t.event_type, (coalesce(e.km, 1e9), e.event_id)) AS event_type
  FROM wa w JOIN ex e ON e.port_id = w.port_id AND e.week_start = w.target_week AND e.from_date <= w.origin_week + 15 JOIN (SELECT DISTINCT event_id, event_type FROM v_events) t ON t.event_id = e.event_id GROUP BY 1, 2, 3, 4)"""


@query("event_features", with_views("SELECT * FROM ef", *ATT, EVENT_FEATURES))
def event_features(spark: SparkSession, sf: str, warnings: DataFrame | None = None) -> DataFrame:
    """Per warning row, the events known at release that could hit the target week."""
    e = wa.daily_exposure(spark, sf).withColumn("target_week", F.explode(ev.hit_weeks("from_date")))
    warnings = pl.warning_rows(spark, sf) if warnings is None else warnings
    known = warnings.select(*KEYS).join(e, ["port_id", "target_week"]).where(F.col("from_date") <= F.date_add("origin_week", 15))
    return known.groupBy(*KEYS).agg(F.sum("n").alias("event_n"), F.sum("n_red").alias("event_n_red"), F.min("red_km").alias("event_red_km"), F.min(F.datediff("target_week", "from_date")).cast("long").alias("event_days"), F.min("nearest")["event_type"].alias("event_type"))


STATE = """cs AS (SELECT chokepoint_id, transit_date, s7 / nullif(lag(s7, 364) OVER w, 0) - 1 AS vs_year_ago, s7 / nullif(p28 / 4, 0) - 1 AS vs_prior_28d FROM (
  SELECT chokepoint_id, transit_date, CASE WHEN count(*) OVER a = 7 THEN CAST(sum(n_total) OVER a AS DOUBLE) END AS s7, CASE WHEN count(*) OVER b = 28 THEN CAST(sum(n_total) OVER b AS DOUBLE) END AS p28 FROM v_transits
  WINDOW a AS (PARTITION BY chokepoint_id ORDER BY transit_date ROWS 6 PRECEDING), b AS (PARTITION BY chokepoint_id ORDER BY transit_date ROWS BETWEEN 34 PRECEDING AND 7 PRECEDING)) WINDOW w AS (PARTITION BY chokepoint_id ORDER BY transit_date))"""


@query("chokepoint_state", with_views("SELECT * FROM cs", TRANSITS, STATE))
def chokepoint_state(spark: SparkSession, sf: str) -> DataFrame:
    """Seven days' transits against those 364 rows before, and against the average week of the 28 rows before; full windows only."""
    t = v.transits(spark, sf).select("chokepoint_id", "transit_date", F.col("n_total").cast("double").alias("x"))
    a, b = rows("chokepoint_id", "transit_date", -6, 0), rows("chokepoint_id", "transit_date", -34, -7)
    full = lambda w, n: F.when(F.count("x").over(w) == n, F.sum("x").over(w))
    t = t.withColumns({"s7": full(a, 7), "p28": full(b, 28) / 4})
    before = F.lag("s7", 364).over(Window.partitionBy("chokepoint_id").orderBy("transit_date"))
    return t.withColumn("before", before).select("chokepoint_id", "transit_date", (safe_ratio(F.col("s7"), F.col("before")) - 1).alias("vs_year_ago"), (safe_ratio(F.col("s7"), F.col("p28")) - 1).alias("vs_prior_28d"))


CHOKES = f"""cf AS (SELECT o.origin_week, n.port_id, {", ".join(f"max({c}) FILTER (WHERE r = {i}) AS choke{i}_{c}" for i in (1, 2) for c in ("km", "vs_year_ago", "vs_prior_28d"))} FROM (SELECT DISTINCT origin_week FROM wa) o CROSS JOIN (
  SELECT p.port_id, c.chokepoint_id, {KM.format(a='p.latitude', b='p.longitude', c='c.latitude', d='c.longitude')} AS km, row_number() OVER (PARTITION BY p.port_id ORDER BY {KM.format(a='p.latitude', b='p.longitude', c='c.latitude', d='c.longitude')}, c.chokepoint_id) AS r FROM v_profiles p CROSS JOIN places c) n
  JOIN cs ON cs.chokepoint_id = n.chokepoint_id AND cs.transit_date = o.origin_week + 13 WHERE r <= 2 GROUP BY 1, 2)"""
CHOKED = (*FULL, PROFILES, TRANSITS, PLACES, STATE, CHOKES)
#: Half of the earth's circumference: every strait is within it.
ANYWHERE_KM = 20_020.0


@query("chokepoint_features", with_views("SELECT * FROM cf", *CHOKED))
def chokepoint_features(spark: SparkSession, sf: str, warnings: DataFrame | None = None) -> DataFrame:
    """Per origin and port, the state of the two nearest straits as known two days before release."""
    straits = pl.places(spark, sf)
    near = nearest_k(spatial_join(v.profiles(spark, sf), straits, ANYWHERE_KM, "port_id", "chokepoint_id"), "port_id", "chokepoint_id", 2)
    warnings = pl.warning_rows(spark, sf) if warnings is None else warnings
    origins = warnings.select("origin_week").distinct().withColumn("transit_date", F.date_add("origin_week", 13))
    each = chokepoint_state(spark, sf).join(origins, "transit_date").join(near, "chokepoint_id")
    of = lambda c, i: F.max(F.when(F.col("rank") == i, F.col(c))).alias(f"choke{i}_{c}")
    return each.groupBy("origin_week", "port_id").agg(*[of(c, i) for i in (1, 2) for c in ("km", "vs_year_ago", "vs_prior_28d")])


DROPS = as_cte("ds", ex.ORACLE_SQL["drop_state"], "SELECT port_id, week_start, lag(z, 1)")
HISTORY = as_cte("hf", pl.ORACLE_SQL["history_features"], "SELECT port_id, week_start, y, lag_0")
REGION = as_cte("rf", wa.ORACLE_SQL["region_features"], "SELECT l.port_id, l.week_start, r.neighbours")
TRAITS = as_cte("pt", ex.ORACLE_SQL["fleet_shares"], "SELECT port_id, 100.0 * sum(portcalls_tanker)")
OWN = ["z_1", "min_z_4", "weeks_since", "drops_52", "rel_spread"]
PAST = ["mean_4", "mean_13", "mean_52", "cv_13", "trend", "vs_year_ago"]
CHOKE = [f"choke{i}_{c}" for i in (1, 2) for c in ("km", "vs_year_ago", "vs_prior_28d")]
NUMERIC = ["base_rate", "last_z", "last_drop", *OWN, *PAST, "event_n", "event_n_red", *CHOKE, "neighbours", "neighbour_drops", "neighbour_z", "world_drops", "tanker_pct", "container_pct", "latitude", "longitude"]
INPUTS = f"""fx AS (SELECT s.origin_week, s.target_week, s.horizon, s.port_id, s.y, s.base_rate, s.origin_z, s.last_z, s.last_drop, {", ".join(f"ds.{c}" for c in OWN)}, {", ".join(f"hf.{c}" for c in PAST)}, coalesce(ya.dropped_last_year, false) AS dropped_last_year,
  coalesce(ef.event_n, 0) AS event_n, coalesce(ef.event_n_red, 0) AS event_n_red, ef.event_red_km, ef.event_days, coalesce(ef.event_type, 'none') AS event_type, {", ".join(f"cf.{c}" for c in CHOKE)},
  coalesce(rf.neighbours, 0) AS neighbours, rf.neighbour_drops, rf.neighbour_z, rf.world_drops, pt.tanker_pct, pt.container_pct, p.continent, p.latitude, p.longitude, coalesce(sb.size_band, 'unknown') AS size_band
 FROM sc s LEFT JOIN ds ON ds.port_id = s.port_id AND ds.week_start = s.origin_week LEFT JOIN hf ON hf.port_id = s.port_id AND hf.week_start = s.origin_week LEFT JOIN ya ON ya.port_id = s.port_id AND ya.target_week = s.target_week
  LEFT JOIN ef ON ef.origin_week = s.origin_week AND ef.target_week = s.target_week AND ef.horizon = s.horizon AND ef.port_id = s.port_id LEFT JOIN cf ON cf.port_id = s.port_id AND cf.origin_week = s.origin_week LEFT JOIN rf ON rf.port_id = s.port_id AND rf.week_start = s.origin_week
  LEFT JOIN pt ON pt.port_id = s.port_id LEFT JOIN v_profiles p ON p.port_id = s.port_id LEFT JOIN sb ON sb.port_id = s.port_id AND sb.week_start = s.origin_week)"""
ALL = (*FULL, PROFILES, TRANSITS, HAZARDS, PLACES, wa.PREPARED, wa.EXPOSED, wa.NEIGHBOURS, STATE, CHOKES, EVENT_FEATURES, YEAR_AGO, DROPS, HISTORY, REGION, TRAITS, SIZES, INPUTS)


def with_inputs(warnings: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Warning rows with everything that is known of them at release."""
    at = lambda df: df.withColumnRenamed("week_start", "origin_week")
    p = v.profiles(spark, sf).select("port_id", "continent", "latitude", "longitude")
    out = pa.rule_scores(warnings).drop("big", "origin_drop")
    out = out.join(at(ex.drop_state(spark, sf)), ["port_id", "origin_week"], "left").join(at(pl.history_features(spark, sf)).select("port_id", "origin_week", *PAST), ["port_id", "origin_week"], "left")
    out = out.join(year_ago_drops(spark, sf), ["port_id", "target_week"], "left").join(event_features(spark, sf, warnings), KEYS, "left").join(chokepoint_features(spark, sf, warnings), ["port_id", "origin_week"], "left")
    out = out.join(at(wa.region_features(spark, sf)), ["port_id", "origin_week"], "left").join(ex.fleet_shares(spark, sf), "port_id", "left").join(p, "port_id", "left").join(at(pl.size_band(spark, sf)), ["port_id", "origin_week"], "left")
    fill = {"dropped_last_year": False, "event_n": 0, "event_n_red": 0, "event_type": "none", "neighbours": 0, "size_band": "unknown"}
    return out.withColumns({c: F.coalesce(c, F.lit(x)) for c, x in fill.items()})


@query("disruption_features", with_views("SELECT * FROM fx", *ALL))
def disruption_features(spark: SparkSession, sf: str) -> DataFrame:
    with v.kept():
        return with_inputs(pl.warning_rows(spark, sf), spark, sf)


ONE = ["base_rate", "last_z", *OWN, *PAST, "neighbour_z"]


@query("single_feature_ap", with_views("""SELECT b.feature, b.sign, b.ap_before, a.ap AS ap_after FROM (SELECT feature, arg_max(sign, (ap, sign)) AS sign, max(ap) AS ap_before FROM ap WHERE NOT late GROUP BY 1) b JOIN ap a ON a.late AND a.feature = b.feature AND a.sign = b.sign""", *ALL,
  "lf AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, target_week, y FROM fx" for c in ONE) + ")",
  """ap AS (SELECT feature, sign, late, coalesce(sum(tp * ctp / cn) / nullif(sum(tp), 0), 0) AS ap FROM (SELECT feature, sign, late, tp, sum(tp) OVER w AS ctp, sum(n) OVER w AS cn FROM (SELECT feature, sign, target_week >= DATE '1999-01-01' AS late, coalesce(round(x, 9) * sign, -1e300) AS score, CAST(sum(y) AS DOUBLE) AS tp, count(*) AS n
   FROM lf CROSS JOIN (SELECT unnest([1, -1]) AS sign) GROUP BY 1, 2, 3, 4) WINDOW w AS (PARTITION BY feature, sign, late ORDER BY score DESC)) GROUP BY 1, 2, 3)"""))
def single_feature_ap(spark: SparkSession, sf: str) -> DataFrame:
    return sc.single_feature_ap(disruption_features(spark, sf), ONE, "target_week", "1999-01-01")


@query("describe_features", with_views("SELECT feature, count(x) / count(*) AS filled, quantile_cont(x, 0.5) FILTER (WHERE y = 1) AS median_drop, quantile_cont(x, 0.5) FILTER (WHERE y = 0) AS median_calm, NULL AS mode_drop, NULL AS mode_calm FROM lf GROUP BY 1 UNION ALL SELECT 'size_band', 1.0, NULL, NULL, max(size_band) FILTER (WHERE y = 1), max(size_band) FILTER (WHERE y = 0) FROM (SELECT y, size_band, row_number() OVER (PARTITION BY y ORDER BY count(*) DESC, size_band) AS r FROM fx GROUP BY 1, 2) WHERE r = 1", *ALL, "lf AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, y FROM fx" for c in ONE) + ")"))
def describe_features(spark: SparkSession, sf: str) -> DataFrame:
    f = disruption_features(spark, sf)
    m = sc.modes(f, "size_band", "y").agg(*[F.max(F.when(F.col("y") == k, F.col("mode"))).alias(n) for k, n in ((1, "mode_drop"), (0, "mode_calm"))])
    return sc.describe_features(f, ONE).unionByName(m.select(F.lit("size_band").alias("feature"), F.lit(1.0).alias("filled"), "mode_drop", "mode_calm"), allowMissingColumns=True)


@query("recency_weights", with_views("SELECT origin_week, target_week, horizon, port_id, pow(0.5, ((SELECT max(target_week) FROM wa) - target_week) / 7.0 / 104) AS weight FROM wa", *FULL))
def recency_weights(spark: SparkSession, sf: str) -> DataFrame:
    """Half as much weight for every two years of age."""
    w = pl.warning_rows(spark, sf).select(*KEYS)
    newest = w.agg(F.max("target_week").alias("newest"))
    return w.crossJoin(F.broadcast(newest)).select(*KEYS, F.pow(F.lit(0.5), F.datediff("newest", "target_week") / 7 / 104).alias("weight"))


# --- reports


@query("nearby_events", with_views(f"""SELECT w.origin_week, p.port_id, e.event_id, CASE WHEN {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} <= 800 THEN {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} END AS km, e.listed_port = p.port_id AS listed, e.is_red, e.from_date
 FROM v_profiles p JOIN pe e ON {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} <= 800 OR e.listed_port = p.port_id JOIN (SELECT DISTINCT week_start AS origin_week FROM g) w ON e.from_date > w.origin_week + 15 - 42 AND e.from_date <= w.origin_week + 15""", *BASE, PROFILES, HAZARDS, wa.PREPARED))
def nearby_events(spark: SparkSession, sf: str) -> DataFrame:
    """For each release (15 days after its origin week) the events of the 42 days before it, near a port or listing it."""
    e = wa.prepared(spark, sf)
    near = spatial_join(v.profiles(spark, sf), e, 800.0, "port_id", "event_id")
    listed = e.select("event_id", F.explode("ports").alias("port_id"), F.lit(True).alias("listed"))
    out = near.join(listed, ["port_id", "event_id"], "full").join(e.select("event_id", "is_red", "from_date"), "event_id")
    first = F.trunc(F.date_sub("from_date", 9), "week")  # the first Monday whose release is not before the event
    out = out.withColumn("origin_week", F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.date_add(first, k * 7))))
    out = out.join(pl.weekly_grid(spark, sf).select(F.col("week_start").alias("origin_week")).distinct(), "origin_week", "left_semi")
    return out.select("origin_week", "port_id", "event_id", "km", F.coalesce("listed", F.lit(False)).alias("listed"), "is_red", "from_date")


DETAILS = """WITH_LAST AS (SELECT *, row_number() OVER (PARTITION BY port_id ORDER BY week_start DESC) AS r FROM lb)"""


@query("port_details", with_views("""SELECT a.port_id, a.calls, a.usual, a.marks, a.known_weeks, coalesce(d.drops, 0) AS drops, d.last_drops FROM (SELECT port_id, string_agg(coalesce(CAST(CAST(y AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY week_start) AS calls, string_agg(coalesce(CAST(CAST(round(base) AS BIGINT) AS VARCHAR), '-'), ',' ORDER BY week_start) AS usual, string_agg(CASE WHEN is_drop THEN 'D' WHEN is_drop IS NULL THEN '-' ELSE '.' END, '' ORDER BY week_start) AS marks, count(is_drop) AS known_weeks FROM WITH_LAST WHERE r <= 52 GROUP BY 1) a
 LEFT JOIN (SELECT port_id, count(*) AS drops, string_agg(CAST(week_start AS VARCHAR), ',' ORDER BY week_start DESC) FILTER (WHERE k <= 6) AS last_drops FROM (SELECT port_id, week_start, row_number() OVER (PARTITION BY port_id ORDER BY week_start DESC) AS k FROM lb WHERE is_drop) GROUP BY 1) d ON d.port_id = a.port_id""", *BASE, LABELS, DETAILS))
def port_details(spark: SparkSession, sf: str) -> DataFrame:
    """The last 52 weeks of each port in a row of their own: calls, the usual, marks; and its last six drops."""
    w = Window.partitionBy("port_id").orderBy(F.desc("week_start"))
    lb = pl.label_drops(spark, sf)
    last = lb.withColumn("r", F.row_number().over(w)).where("r <= 52")
    text = lambda c: F.coalesce(c.cast("long").cast("string"), F.lit("-"))
    series = lambda c, sep: F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("week_start", c.alias("x")))), lambda s: s["x"]), sep)
    mark = F.when(F.col("is_drop"), "D").when(F.col("is_drop").isNull(), "-").otherwise(".")
    out = last.groupBy("port_id").agg(series(text(F.col("y")), ",").alias("calls"), series(text(F.round("base")), ",").alias("usual"), series(mark, "").alias("marks"), F.count("is_drop").alias("known_weeks"))
    drops = lb.where("is_drop").withColumn("k", F.row_number().over(w)).groupBy("port_id")
    recent = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("k") <= 6, F.col("week_start"))), asc=False), lambda d: d.cast("string")), ",")
    drops = drops.agg(F.count("*").alias("drops"), recent.alias("last_drops"))
    return out.join(drops, "port_id", "left").withColumn("drops", F.coalesce("drops", F.lit(0)))


@query("freshness_gate", with_views("SELECT max(week_start) AS newest_week, max(week_start) + 15 AS release_date, DATE '2001-11-28' - (max(week_start) + 15) AS days_old, DATE '2001-11-28' - (max(week_start) + 15) <= 7 AS is_fresh, (SELECT max(origin_week) FROM wa) AS newest_labelled FROM g WHERE y IS NOT NULL", *FULL))
def freshness_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the newest release is at most seven days old, and the newest origin with a known outcome."""
    newest = pl.weekly_grid(spark, sf).where("y IS NOT NULL").agg(F.max("week_start").alias("newest_week"))
    labelled = pl.warning_rows(spark, sf).agg(F.max("origin_week").alias("newest_labelled"))
    days = F.datediff(F.lit("2001-11-28").cast("date"), F.date_add("newest_week", 15)).cast("long")
    return newest.crossJoin(F.broadcast(labelled)).select("newest_week", F.date_add("newest_week", 15).alias("release_date"), days.alias("days_old"), (days <= 7).alias("is_fresh"), "newest_labelled")


# --- port-call forecasts

#: First days of three moving holidays in Singapore's calendar; a production job passes its own list.
HOLIDAYS = {
    "lunar_new_year": ["1994-02-10", "1995-01-31", "1996-02-19", "1997-02-07", "1998-01-28", "1999-02-16", "2000-02-05", "2001-01-24", "2002-02-12"],
    "eid_al_fitr": ["1994-03-14", "1995-03-03", "1996-02-20", "1997-02-09", "1998-01-30", "1999-01-19", "2000-01-08", "2000-12-27", "2001-12-16", "2002-12-06"],
    "eid_al_adha": ["1994-05-21", "1995-05-10", "1996-04-28", "1997-04-18", "1998-04-08", "1999-03-28", "2000-03-16", "2001-03-06", "2002-02-23"],
}
OFFSETS = "ho AS (SELECT week_start" + "".join(f""", (SELECT greatest(least(round(arg_min(w.week_start + 3 - d, (abs(w.week_start + 3 - d), d)) / 7.0, 1), 8), -8) FROM (SELECT CAST(unnest({days}) AS DATE) AS d)) AS weeks_from_{name}""" for name, days in HOLIDAYS.items()) + " FROM (SELECT DISTINCT week_start FROM g) w)"


@query("holiday_offsets", with_views("SELECT * FROM ho", *BASE, OFFSETS))
def holiday_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """Weeks from the middle of each week back to the nearest day of each holiday, within eight weeks."""
    middle = F.date_add("week_start", 3)

    def offset(days: list[str]):  # noqa: ANN202
        near = F.array_min(F.transform(F.array(*[F.lit(d).cast("date") for d in days]), lambda d: F.struct(F.abs(F.datediff(middle, d)).alias("gap"), d.alias("day"))))
        return clip(F.round(F.datediff(middle, near["day"]) / 7, 1), -8.0, 8.0)

    weeks = pl.weekly_grid(spark, sf).select("week_start").distinct()
    return weeks.select("week_start", *[offset(d).alias(f"weeks_from_{n}") for n, d in HOLIDAYS.items()])


@query("forecast_features", with_views("""SELECT f.port_id, f.origin_week, f.horizon, f.origin_week + CAST(7 * f.horizon AS INT) AS target_week, f.actual, f.last_year, f.seasonal_avg, hf.lag_0, hf.lag_1, hf.lag_2, hf.lag_3, hf.mean_4, hf.mean_8, hf.mean_13, hf.mean_52, hf.cv_13, hf.trend, hf.vs_year_ago, CAST(extract(week FROM f.origin_week + CAST(7 * f.horizon AS INT)) AS INT) AS target_week_of_year,
 ho.weeks_from_lunar_new_year, ho.weeks_from_eid_al_fitr, ho.weeks_from_eid_al_adha, pt.tanker_pct, pt.container_pct, p.continent, p.latitude, p.longitude, p.vessel_count_total, ln(1 + f.actual) - ln(1 + hf.mean_4) AS target
 FROM fc f JOIN hf ON hf.port_id = f.port_id AND hf.week_start = f.origin_week AND hf.mean_4 IS NOT NULL LEFT JOIN ho ON ho.week_start = f.origin_week + CAST(7 * f.horizon AS INT) LEFT JOIN pt ON pt.port_id = f.port_id LEFT JOIN v_profiles p ON p.port_id = f.port_id""", *BASE, PROFILES, pl.FORECASTS, HISTORY, TRAITS, OFFSETS))
def forecast_features(spark: SparkSession, sf: str) -> DataFrame:
    """History, calendar and port traits of every origin and horizon, and the log change to forecast."""
    f = pl.baseline_forecasts(spark, sf).select("port_id", "origin_week", "horizon", "actual", "last_year", "seasonal_avg")
    f = f.withColumn("target_week", F.expr("date_add(origin_week, 7 * horizon)")).withColumn("target_week_of_year", F.weekofyear("target_week"))
    past = pl.history_features(spark, sf).where("mean_4 IS NOT NULL").withColumnRenamed("week_start", "origin_week").drop("y", "mean_4_year_ago")
    p = v.profiles(spark, sf).select("port_id", "continent", "latitude", "longitude", "vessel_count_total")
    out = f.join(past, ["port_id", "origin_week"]).join(holiday_offsets(spark, sf).withColumnRenamed("week_start", "target_week"), "target_week", "left")
    out = out.join(ex.fleet_shares(spark, sf), "port_id", "left").join(p, "port_id", "left")
    return out.withColumn("target", F.log1p("actual") - F.log1p("mean_4"))
