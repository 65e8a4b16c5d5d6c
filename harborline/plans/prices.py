"""Oil price features, targets and tests of forecasts, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import models as mo
from ..operators import regression as rg
from ..operators import weekly as wk
from . import views as v
from .views import ACTIVITY, PRICES, TRANSITS, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()

#: Horizons and release lag in weeks, days from a week's end to its publication, groups of countries, stock series.
HORIZONS, LAG_WEEKS = (1, 2, 4), 1
FLOWS_OUT, STOCKS_OUT = 4, 5
EXPORTERS = {"gulf": ["MIDDLE EAST"], "americas": ["AMERICA"], "atlantic": ["AMERICA", "AFRICA"]}
IMPORTERS = {"asia": ["ASIA"], "europe": ["EUROPE"], "atlantic": ["AMERICA", "EUROPE"]}
CHOKEPOINTS = {"hormuz": "1-URGENT", "suez": "2-HIGH", "malacca": "3-MEDIUM"}
STOCKS = {
    "crude": ("Crude Oil", "NUS", "commercial"),
    "cushing": ("Crude Oil", "YCUOK", "commercial"),
    "gasoline": ("Total Gasoline", "NUS", "commercial"),
    "distillate": ("Distillate Fuel Oil", "NUS", "commercial"),
    "spr": ("Crude Oil", "NUS", "spr"),
}
PRICE_FEATURES = ["r1", "r4", "r13", "r52", "vol4", "spread", "spread_chg4", "dd52"]
SHIPPING = ["exp_world", *[f"exp_{g}" for g in EXPORTERS], *[f"imp_{g}" for g in IMPORTERS], *[f"choke_{g}" for g in CHOKEPOINTS]]
STOCK_FEATURES = [*[f"stock_{s}_{k}" for s in ("crude", "cushing", "gasoline", "distillate") for k in ("chg1", "chg4", "dev5y")], "stock_spr_chg4"]
FEATURE_SETS = {"price": PRICE_FEATURES, "price_stocks": [*PRICE_FEATURES, *STOCK_FEATURES], "full": [*PRICE_FEATURES, *STOCK_FEATURES, *[f"{s}_{k}" for s in SHIPPING for k in ("w4", "yoy")]]}

#: Ridge strengths, quantile that targets are clipped to; the first test week, weeks between fits and of validation.
STRENGTHS, WINSOR = (1.0, 3.0, 10.0, 30.0, 100.0, 300.0, 1000.0, 3000.0), 0.02
EVAL_START, RETRAIN_WEEKS, VALID_WEEKS = "1998-01-02", 13, 52

FRIDAY = "CAST({0} AS DATE) + CAST((12 - extract(dow FROM {0})) % 7 AS INT)"
MEMBERS = ", ".join(f"('{p}{n}', '{c}', '{p}')" for p, groups in (("exp_", EXPORTERS), ("imp_", IMPORTERS)) for n, cs in groups.items() for c in cs)
FLOWS = f"""
wf0 AS (SELECT activity_date, 'exp_world' AS series, sum(export_total) AS x FROM v_activity GROUP BY 1
  UNION ALL SELECT activity_date, series, sum(CASE side WHEN 'exp_' THEN export_total ELSE import_total END) FROM v_activity JOIN (VALUES {MEMBERS}) AS m(series, member, side) ON member = country GROUP BY 1, 2),
wf AS (SELECT {FRIDAY.format('activity_date')} AS week_end, series, sum(x) AS value, count(*) AS days FROM wf0 GROUP BY 1, 2)"""


@query("weekly_flows", with_views("SELECT * FROM wf", ACTIVITY, FLOWS))
def weekly_flows(spark: SparkSession, sf: str) -> DataFrame:
    return wk.group_flows(v.activity(spark, sf), "activity_date", "country", "export_total", "import_total", EXPORTERS, IMPORTERS)


def stocks(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows of weekly stocks by product, area and kind; some weeks of some series are missing."""
    part, kinds = F.col("l_partkey"), ("Crude Oil", "Total Gasoline", "Distillate Fuel Oil", "Propane")
    product = F.element_at(F.array(*map(F.lit, kinds)), (F.pmod(part, F.lit(4)) + 1).cast("int"))
    keys = [wk.friday(F.to_date("l_shipdate")).alias("report_date"), product.alias("product"), F.when(F.pmod("l_suppkey", F.lit(3)) == 0, "YCUOK").otherwise("NUS").alias("area_code"), F.when(F.col("l_returnflag") == "R", "spr").otherwise("commercial").alias("stock_type")]
    return v.table(spark, sf, "lineitem").groupBy(*keys).agg(F.sum("l_quantity").alias("value_thousand_bbl"))


NAMES = ", ".join(f"('stock_{n}', '{p}', '{a}', '{t}')" for n, (p, a, t) in STOCKS.items())
WEEKLY_STOCKS = f"""
v_stocks AS (SELECT {FRIDAY.format('l_shipdate')} AS report_date, ['Crude Oil', 'Total Gasoline', 'Distillate Fuel Oil', 'Propane'][CAST(l_partkey % 4 AS INT) + 1] AS product,
    CASE l_suppkey % 3 WHEN 0 THEN 'YCUOK' ELSE 'NUS' END AS area_code, CASE l_returnflag WHEN 'R' THEN 'spr' ELSE 'commercial' END AS stock_type, sum(l_quantity) AS value_thousand_bbl FROM lineitem GROUP BY 1, 2, 3, 4),
ws AS (SELECT report_date AS week_end, series, value_thousand_bbl AS value FROM v_stocks JOIN (VALUES {NAMES}) AS n(series, p, a, t) ON p = product AND a = area_code AND t = stock_type)"""


@query("weekly_stocks", with_views("SELECT * FROM ws", WEEKLY_STOCKS))
def weekly_stocks(spark: SparkSession, sf: str) -> DataFrame:
    names = {f"stock_{n}": (F.col("product") == p) & (F.col("area_code") == a) & (F.col("stock_type") == t) for n, (p, a, t) in STOCKS.items()}
    return wk.named_series(stocks(spark, sf).withColumns({"week_end": F.col("report_date"), "value": F.col("value_thousand_bbl")}), names, ["week_end", "value"])


def shipping(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly flows and chokepoint transits, long, with the days of each week."""
    names = {f"choke_{n}": F.col("chokepoint_id") == c for n, c in CHOKEPOINTS.items()}
    daily = wk.named_series(v.transits(spark, sf), names, ["transit_date", "n_tanker"])
    transits = daily.groupBy(wk.friday(F.col("transit_date")).alias("week_end"), "series").agg(F.sum("n_tanker").cast("double").alias("value"), F.count("*").alias("days"))
    return weekly_flows(spark, sf).unionByName(transits)


SHIP_GRID = f"""
sh AS (SELECT * FROM wf UNION ALL SELECT {FRIDAY.format('transit_date')} AS week_end, series, CAST(sum(n_tanker) AS DOUBLE), count(*) FROM v_transits
  JOIN (VALUES {', '.join(f"('choke_{n}', '{c}')" for n, c in CHOKEPOINTS.items())}) AS n(series, c) ON c = chokepoint_id GROUP BY 1, 2),
shg AS (SELECT s.series, w.week_end, CASE WHEN days >= 7 THEN value END AS value FROM (SELECT DISTINCT series FROM sh) s
  CROSS JOIN (SELECT CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM sh) w LEFT JOIN sh ON sh.series = s.series AND sh.week_end = w.week_end)"""
SHIPS = (ACTIVITY, TRANSITS, FLOWS, SHIP_GRID)


def pivoted(source: str, columns: dict[str, str]) -> str:
    """SQL of a wide table: each column as the value of the series and field given to it."""
    cells = ", ".join(f"max({field}) FILTER (WHERE series = '{series}') AS {name}" for name, (series, field) in columns.items())
    return f"SELECT week_end, {cells} FROM {source} GROUP BY 1"


@query("weekly_wide_grid", with_views(pivoted("shg", {s: (s, "value") for s in SHIPPING}), *SHIPS))
def weekly_wide_grid(spark: SparkSession, sf: str) -> DataFrame:
    return wk.wide(wk.week_grid(shipping(spark, sf)), SHIPPING, ["value"])


FLOW_FEATURES = """
ff AS (SELECT series, week_end, value, CASE WHEN value / nullif(avg(value) OVER p, 0) > 0 THEN ln(value / avg(value) OVER p) END AS w4,
    CASE WHEN avg(value) OVER l / nullif(avg(value) OVER y, 0) > 0 THEN ln(avg(value) OVER l / avg(value) OVER y) END AS yoy
  FROM shg WINDOW p AS (PARTITION BY series ORDER BY week_end ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), l AS (PARTITION BY series ORDER BY week_end ROWS 3 PRECEDING),
    y AS (PARTITION BY series ORDER BY week_end ROWS BETWEEN 55 PRECEDING AND 52 PRECEDING))"""


@query("flow_features", with_views("SELECT * FROM ff", *SHIPS, FLOW_FEATURES))
def flow_features(spark: SparkSession, sf: str) -> DataFrame:
    return wk.flow_features(wk.week_grid(shipping(spark, sf)))


STOCK_SQL = """
wsg AS (SELECT s.series, w.week_end, value FROM (SELECT DISTINCT series FROM ws) s
  CROSS JOIN (SELECT CAST(unnest(generate_series(min(week_end), max(week_end), INTERVAL 7 DAY)) AS DATE) AS week_end FROM ws) w LEFT JOIN ws ON ws.series = s.series AND ws.week_end = w.week_end),
sf5 AS (SELECT a.series, a.week_end, avg(b.value) AS five FROM wsg a JOIN wsg b ON b.series = a.series AND (a.week_end - b.week_end) IN (364, 728, 1092, 1456, 1820) GROUP BY 1, 2),
sf AS (SELECT a.series, a.week_end, a.value, a.value / nullif(b.value, 0) - 1 AS chg1, a.value / nullif(c.value, 0) - 1 AS chg4, a.value / nullif(five, 0) - 1 AS dev5y
  FROM wsg a LEFT JOIN wsg b ON b.series = a.series AND b.week_end = a.week_end - 7 LEFT JOIN wsg c ON c.series = a.series AND c.week_end = a.week_end - 28 LEFT JOIN sf5 f ON f.series = a.series AND f.week_end = a.week_end)"""


@query("stock_features", with_views("SELECT * FROM sf", WEEKLY_STOCKS, STOCK_SQL))
def stock_features(spark: SparkSession, sf: str) -> DataFrame:
    return wk.stock_features(wk.week_grid(weekly_stocks(spark, sf), None))


def origins(spark: SparkSession, sf: str) -> DataFrame:
    return wk.fridays(v.prices(spark, sf), "price_date", "origin")


ORIGINS = f"og AS (SELECT CAST(unnest(generate_series({FRIDAY.format('min(price_date)')}, max(price_date), INTERVAL 7 DAY)) AS DATE) AS origin FROM v_prices)"
TARGETS = "tg AS (SELECT o.origin, " + ", ".join(f"CASE WHEN o.origin + {7 * h} <= (SELECT max(price_date) FROM v_prices) THEN ln(f{h}.brent_usd / n.brent_usd) END AS y{h}" for h in HORIZONS) + " FROM og o ASOF LEFT JOIN v_prices n ON o.origin >= n.price_date " + " ".join(f"ASOF LEFT JOIN v_prices f{h} ON o.origin + {7 * h} >= f{h}.price_date" for h in HORIZONS) + ")"


@query("price_targets", with_views("SELECT * FROM tg", PRICES, ORIGINS, TARGETS))
def price_targets(spark: SparkSession, sf: str) -> DataFrame:
    return wk.price_targets(v.prices(spark, sf), origins(spark, sf), HORIZONS)


ORIGIN_PRICES = """
op0 AS (SELECT *, brent_usd - wti_usd AS spread, ln(brent_usd / lag(brent_usd) OVER (ORDER BY price_date)) AS r FROM v_prices),
op1 AS (SELECT *, CASE WHEN count(r) OVER w20 = 20 THEN stddev_samp(r) OVER w20 * sqrt(252) END AS vol4, CASE WHEN count(*) OVER w260 >= 200 THEN max(brent_usd) OVER w260 END AS high52
  FROM op0 WINDOW w20 AS (ORDER BY price_date ROWS 19 PRECEDING), w260 AS (ORDER BY price_date ROWS 259 PRECEDING)),
opf AS (SELECT o.origin, n.brent_usd, n.vol4, n.spread, ln(n.brent_usd / a.brent_usd) AS r1, ln(n.brent_usd / b.brent_usd) AS r4, ln(n.brent_usd / c.brent_usd) AS r13, ln(n.brent_usd / d.brent_usd) AS r52,
    n.spread - b.spread AS spread_chg4, ln(n.brent_usd / n.high52) AS dd52
  FROM og o ASOF LEFT JOIN op1 n ON o.origin >= n.price_date ASOF LEFT JOIN op1 a ON o.origin - 7 >= a.price_date ASOF LEFT JOIN op1 b ON o.origin - 28 >= b.price_date
    ASOF LEFT JOIN op1 c ON o.origin - 91 >= c.price_date ASOF LEFT JOIN op1 d ON o.origin - 364 >= d.price_date)"""
SHIP_COLUMNS = {f"{s}_{k}": (s, k) for s in SHIPPING for k in ("w4", "yoy")}
STOCK_COLUMNS = {c: (c.rsplit("_", 1)[0], c.rsplit("_", 1)[1]) for c in STOCK_FEATURES}
OIL_FEATURES = f"""
ofs AS ({pivoted('ff', SHIP_COLUMNS)}), oft AS ({pivoted('sf', STOCK_COLUMNS)}),
ofx AS (SELECT opf.*, ofs.* EXCLUDE (week_end), oft.* EXCLUDE (week_end), tg.* EXCLUDE (origin) FROM opf LEFT JOIN ofs ON ofs.week_end = opf.origin - 7 LEFT JOIN oft ON oft.week_end = opf.origin - 7 JOIN tg ON tg.origin = opf.origin)"""


@query("oil_features", with_views("SELECT * FROM ofx", *SHIPS, PRICES, FLOW_FEATURES, WEEKLY_STOCKS, STOCK_SQL, ORIGINS, ORIGIN_PRICES, TARGETS, OIL_FEATURES))
def oil_features(spark: SparkSession, sf: str) -> DataFrame:
    """A row for each Friday: what was published by then, and the changes of the price that followed."""
    ships = wk.wide(flow_features(spark, sf), SHIPPING, ["w4", "yoy"]).withColumn("published", F.date_add("week_end", FLOWS_OUT))
    held = wk.wide(stock_features(spark, sf), [f"stock_{s}" for s in STOCKS], ["chg1", "chg4", "dev5y"]).select("week_end", *STOCK_FEATURES).withColumn("published", F.date_add("week_end", STOCKS_OUT))
    out = wk.origin_prices(v.prices(spark, sf), origins(spark, sf))
    out = wk.known_by(wk.known_by(out, ships, LAG_WEEKS), held, LAG_WEEKS)
    return out.join(price_targets(spark, sf), "origin")


def by_horizon(features: DataFrame) -> DataFrame:
    """Every origin once for each horizon, with its outcome y."""
    cells = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"y{h}").alias("y")) for h in HORIZONS])
    return features.withColumn("_h", F.explode(cells)).select(*[c for c in features.columns if c not in {f"y{h}" for h in HORIZONS}], "_h.*")


SIMPLE = "smp AS (" + " UNION ALL ".join(
    f"SELECT * FROM (SELECT origin, {h} AS horizon, y{h} AS y, unnest([{{'m': 'no_change', 'p': 0.0}}, {{'m': 'drift', 'p': avg(y{h}) OVER (ORDER BY origin ROWS BETWEEN UNBOUNDED PRECEDING AND {h} PRECEDING)}}, {{'m': 'momentum', 'p': r4 * {h} / 4}}, {{'m': 'reversal', 'p': -r1 * {h}}}]) AS x FROM ofp)" for h in HORIZONS
) + "), sm AS (SELECT origin, horizon, y, x.m AS model, x.p AS prediction FROM smp WHERE y IS NOT NULL AND x.p IS NOT NULL)"
PRICES_ONLY = (PRICES, ORIGINS, ORIGIN_PRICES, TARGETS, "ofp AS (SELECT opf.origin, r1, r4, tg.* EXCLUDE (origin) FROM opf JOIN tg ON tg.origin = opf.origin)", SIMPLE)


def simple_forecasts(spark: SparkSession, sf: str) -> DataFrame:
    """Forecasts that need no fit: none, the mean outcome known by then, the last month's change carried on, the last week's turned round."""
    prices = wk.origin_prices(v.prices(spark, sf), origins(spark, sf)).select("origin", "r1", "r4").join(price_targets(spark, sf), "origin")
    rows = by_horizon(prices)
    w = Window.partitionBy("horizon").orderBy("origin")  # a row per week
    mean = F.coalesce(*[F.when(F.col("horizon") == h, F.avg("y").over(w.rowsBetween(Window.unboundedPreceding, -h))) for h in HORIZONS])
    models = {"no_change": F.lit(0.0), "drift": mean, "momentum": F.col("r4") * F.col("horizon") / 4, "reversal": -F.col("r1") * F.col("horizon")}
    return rows.select("origin", "horizon", "y", *[c.alias(m) for m, c in models.items()]).unpivot(["origin", "horizon", "y"], list(models), "model", "prediction").where("y IS NOT NULL AND prediction IS NOT NULL")


SCORES = "count(*) AS n, 1 - sum((y - prediction) ** 2) / nullif(sum(y * y), 0) AS r2, avg(CASE WHEN sign(prediction) = sign(y) THEN 1.0 ELSE 0.0 END) FILTER (WHERE prediction <> 0) AS hit_rate"


@query("score_r2_hit", with_views(f"SELECT model, horizon, NULL AS year, {SCORES} FROM sm GROUP BY 1, 2 UNION ALL SELECT model, horizon, extract(year FROM origin) AS year, {SCORES} FROM sm GROUP BY 1, 2, 3", *PRICES_ONLY))
def score_r2_hit(spark: SparkSession, sf: str) -> DataFrame:
    """Scores of the simple forecasts by model and horizon, over all years (year null) and by year."""
    return scored(simple_forecasts(spark, sf))


def scored(forecasts: DataFrame) -> DataFrame:
    dated = forecasts.withColumn("year", F.year("origin"))
    whole = rg.r2_and_hits(dated, ["model", "horizon"], "y", "prediction").withColumn("year", F.lit(None).cast("int"))
    return whole.unionByName(rg.r2_and_hits(dated, ["model", "horizon", "year"], "y", "prediction"))


def horner(cs: tuple[float, ...]) -> str:
    out = repr(cs[0])
    for c in cs[1:]:
        out = f"({out} * x + {c!r})"
    return out


CW = f"""
cw0 AS (SELECT model, horizon, origin, y * y - ((y - prediction) ** 2 - prediction ** 2) AS f FROM sm WHERE model <> 'no_change'),
cw1 AS (SELECT *, f - avg(f) OVER (PARTITION BY model, horizon) AS d, row_number() OVER (PARTITION BY model, horizon ORDER BY origin) AS i FROM cw0),
cw2 AS (SELECT a.model, a.horizon, b.i - a.i AS k, sum(a.d * b.d) AS s FROM cw1 a JOIN cw1 b ON b.model = a.model AND b.horizon = a.horizon AND b.i - a.i BETWEEN 0 AND a.horizon - 1 GROUP BY 1, 2, 3),
cw3 AS (SELECT model, horizon, sum(CASE k WHEN 0 THEN s ELSE 2 * (1 - k / horizon) * s END) AS s FROM cw2 GROUP BY 1, 2),
cw4 AS (SELECT c.model, c.horizon, count(*) AS n, CASE WHEN count(*) >= 10 AND any_value(s) > 0 THEN avg(f) / sqrt(any_value(s) / count(*) / count(*)) END AS t FROM cw0 c JOIN cw3 v ON v.model = c.model AND v.horizon = c.horizon GROUP BY 1, 2),
cw5 AS (SELECT *, abs(t) AS x, exp(-t * t / 2) * CASE WHEN abs(t) < 7.07106781186547 THEN {horner(rg.TAIL_ABOVE).replace('x', 'abs(t)')} / {horner(rg.TAIL_BELOW).replace('x', 'abs(t)')}
  ELSE 1 / (abs(t) + 1 / (abs(t) + 2 / (abs(t) + 3 / (abs(t) + 4 / (abs(t) + 0.65))))) / 2.506628274631 END AS tail FROM cw4)
SELECT model, horizon, n, t, CASE WHEN t >= 0 THEN tail WHEN t < 0 THEN 1 - tail END AS p FROM cw5"""


@query("clark_west", with_views(CW.strip().removeprefix("cw0"), *PRICES_ONLY, "cw0"))
def clark_west(spark: SparkSession, sf: str) -> DataFrame:
    """Whether the simple forecasts beat no change by more than luck; overlapping targets of h weeks take h - 1 lags."""
    f = simple_forecasts(spark, sf).where("model != 'no_change'")
    return rg.clark_west(f, ["model", "horizon"], "origin", "y", "prediction", F.col("horizon") - 1, max(HORIZONS) - 1)


def cutoffs(features: DataFrame) -> DataFrame:
    """The first test week and every RETRAIN_WEEKS-th after it, each with the next; a calendar."""
    w = Window.orderBy("origin")
    tested = features.where((F.col("origin") >= EVAL_START) & F.col("y1").isNotNull())
    every = tested.select("origin", (F.row_number().over(w) - 1).alias("i")).where(F.pmod("i", F.lit(RETRAIN_WEEKS)) == 0)
    return every.select(F.col("origin").alias("cutoff"), F.lead("origin").over(w).alias("until"))


def ridges(features: DataFrame, at: DataFrame, tests: DataFrame) -> DataFrame:
    """Forecasts of tests (cutoff, horizon, origin, y, inputs) by the nested ridges, the drift and no change, all fitted at the cutoffs."""
    names = FEATURE_SETS["full"]
    folded = rg.folds_of(by_horizon(features).where("y IS NOT NULL").select("origin", "horizon", "y", *names), at.select("cutoff"), "origin", VALID_WEEKS)
    fits = v.stored(rg.fit_ridges(folded, names, {f"ridge_{s}": c for s, c in FEATURE_SETS.items()}, "y", STRENGTHS, WINSOR))
    keep = ["origin", "horizon", "cutoff", "y", "model", "prediction", "strength", "valid_r2"]
    out = rg.predict_ridges(tests, fits, names).select(*keep)
    plain = tests.join(rg.drift(folded, "y", WINSOR), rg.KEYS).withColumn("no_change", F.lit(0.0)).unpivot(["origin", "horizon", "cutoff", "y"], ["drift", "no_change"], "model", "prediction")
    return out.unionByName(plain, allowMissingColumns=True)


@query("ridge_walk_forward")
def ridge_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Ridges on nested inputs, refitted at every cutoff, forecasting the weeks up to the next one."""
    features = v.stored(oil_features(spark, sf))
    at = v.stored(cutoffs(features))
    tests = by_horizon(features).where("y IS NOT NULL").crossJoin(F.broadcast(at)).where("origin >= cutoff AND (until IS NULL OR origin < until)").drop("until")
    return ridges(features, at, tests)


@query("ridge_scores")
def ridge_scores(spark: SparkSession, sf: str) -> DataFrame:
    """R2, hit rate and Clark-West test of the ridges by horizon, over all years and by year."""
    f = v.stored(ridge_walk_forward(spark, sf))
    tested = rg.clark_west(f.where("model != 'no_change'"), ["model", "horizon"], "origin", "y", "prediction", F.col("horizon") - 1, max(HORIZONS) - 1)
    return scored(f).join(tested.drop("n"), ["model", "horizon"], "left").withColumns({c: F.when(F.col("year").isNull(), F.col(c)) for c in ("t", "p")})


@query("latest_price_forecast")
def latest_price_forecast(spark: SparkSession, sf: str) -> DataFrame:
    """The newest origin with a close, forecast by models fitted on all that is known by then."""
    features = v.stored(oil_features(spark, sf))
    newest = features.where("brent_usd IS NOT NULL").agg(F.max("origin").alias("cutoff"))
    tests = by_horizon(features).join(F.broadcast(newest), F.col("origin") == F.col("cutoff"))
    out = ridges(features, newest, tests).join(features.select("origin", "brent_usd"), "origin")
    return out.withColumn("target", F.date_add("origin", 7 * F.col("horizon"))).drop("cutoff", "y")


@query("boosted_walk_forward")
def boosted_walk_forward(spark: SparkSession, sf: str) -> DataFrame:
    """Boosted trees on all inputs, one per horizon and yearly cutoff, their number chosen on the year before it."""
    features = v.stored(oil_features(spark, sf))
    rows = v.stored(mo.prepared(by_horizon(features).where("y IS NOT NULL"), FEATURE_SETS["full"]).select("origin", "horizon", "y", "features"))
    return mo.boosted_folds(rows, "origin", "horizon", "y", HORIZONS, ["1999-12-31", "2000-12-29"], VALID_WEEKS, WINSOR)
