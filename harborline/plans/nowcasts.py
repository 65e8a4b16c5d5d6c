"""Oil nowcasts by coast and by country, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nowcast as nc
from ..operators.keyed import keep_last
from . import views as v
from .views import ACTIVITY, PROFILES, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()

#: Flow and goods chapters of each series, coasts, fit lengths and the months that errors are judged from.
SERIES = {"all_oil_exports": ("X", ("2709", "2710", "2711")), "all_oil_imports": ("M", ("2709", "2710", "2711")), "crude_exports": ("X", ("2709",)), "crude_imports": ("M", ("2709",))}
COASTS = ("gulf", "east", "west", "other")
FIT_MONTHS, COUNTRY_FIT_MONTHS, LAG = 24, 36, 2
FIRST, TEST_FROM, EARLY, TOP = "1997-01-01", 1999, "1997-01-01", 3
#: Crude terminals of each country; ports whose name contains OFFSHORE are terminals anywhere.
TERMINALS = {"AFRICA": ("NATION_0", "NATION_10"), "AMERICA": ("NATION_6",), "ASIA": ("NATION_2", "NATION_12"), "EUROPE": ("NATION_3",), "MIDDLE EAST": ("NATION_4", "NATION_9")}
OFFSHORE = "_2"


def census(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows of monthly trade by product, in several vintages; a month is out 35 days after its end."""
    lines = v.table(spark, sf, "lineitem")
    part = F.col("l_partkey")
    out = lines.groupBy(
        F.trunc("l_shipdate", "month").alias("period_date"),
        F.when(F.col("l_linestatus") == "F", "M").otherwise("X").alias("flow_code"),
        F.concat(F.lit("27"), F.lpad((9 + F.pmod(part, F.lit(4))).cast("string"), 2, "0"), F.when(F.pmod(part, F.lit(8)) < 4, "00").otherwise("10")).alias("commodity_code"),
        F.when(F.pmod("l_suppkey", F.lit(2)) == 0, "1").otherwise("2").alias("export_origin"),
        F.pmod("l_linenumber", F.lit(3)).alias("ingest_seq"),
    ).agg((F.sum("l_quantity") * 1000).alias("vessel_weight_kg"))
    newest = lines.agg(F.to_date(F.max("l_shipdate")).alias("newest"))
    return out.crossJoin(F.broadcast(newest)).where(F.date_add(F.last_day("period_date"), 35) <= F.col("newest")).drop("newest")


CENSUS = """
v_census AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS period_date, CASE l_linestatus WHEN 'F' THEN 'M' ELSE 'X' END AS flow_code,
    '27' || lpad(CAST(9 + l_partkey % 4 AS VARCHAR), 2, '0') || CASE WHEN l_partkey % 8 < 4 THEN '00' ELSE '10' END AS commodity_code,
    CASE l_suppkey % 2 WHEN 0 THEN '1' ELSE '2' END AS export_origin, l_linenumber % 3 AS ingest_seq, sum(l_quantity) * 1000 AS vessel_weight_kg
  FROM lineitem GROUP BY 1, 2, 3, 4, 5 HAVING last_day(CAST(date_trunc('month', l_shipdate) AS DATE)) + 35 <= (SELECT CAST(max(l_shipdate) AS DATE) FROM lineitem))"""
CENSUS_SERIES = """
cs0 AS (SELECT a.* FROM v_census a WHERE NOT EXISTS (SELECT 1 FROM v_census b WHERE b.period_date = a.period_date AND b.flow_code = a.flow_code
    AND b.commodity_code = a.commodity_code AND b.export_origin = a.export_origin AND b.ingest_seq > a.ingest_seq)),
cs AS (SELECT series, period_date AS month, sum(vessel_weight_kg) / 1000 AS value FROM cs0 JOIN (VALUES ('all_oil_exports', 'X', '2709'),
    ('all_oil_exports', 'X', '2710'), ('all_oil_exports', 'X', '2711'), ('all_oil_imports', 'M', '2709'), ('all_oil_imports', 'M', '2710'),
    ('all_oil_imports', 'M', '2711'), ('crude_exports', 'X', '2709'), ('crude_imports', 'M', '2709')) AS s(series, flow, code)
    ON flow_code = flow AND commodity_code[1:4] = code GROUP BY 1, 2)"""


@query("census_series", with_views("SELECT * FROM cs", CENSUS, CENSUS_SERIES))
def census_series(spark: SparkSession, sf: str) -> DataFrame:
    """The latest vintage of each key, in tonnes, summed into the series."""
    latest = keep_last(census(spark, sf), ["period_date", "flow_code", "commodity_code", "export_origin"], "ingest_seq")
    latest = latest.withColumns({"code": F.substring("commodity_code", 1, 4), "tonnes": F.col("vessel_weight_kg") / 1000})
    return nc.series_totals(latest, SERIES, "period_date", "flow_code", "code", "tonnes")


def coast_months(spark: SparkSession, sf: str) -> DataFrame:
    """Complete months of tonnes by coast and flow, long; places without a position are 'other'."""
    lat, lon = F.col("latitude"), F.col("longitude")
    coast = F.when(lat.isNull() | (lat > 50), "other").when(lon < -60, "west").when((lat < 0) & (lon < 60), "gulf").otherwise("east")
    daily = v.activity(spark, sf).join(v.profiles(spark, sf).select("port_id", "latitude", "longitude"), "port_id", "left").withColumn("region", coast)
    months = nc.complete_months(daily, ["region"], "activity_date", {"X": "export_total", "M": "import_total"})
    return months.unpivot(["region", "month"], ["X", "M"], "flow", "tonnes")


COAST_MONTHS = """
cm0 AS (SELECT CASE WHEN latitude IS NULL OR latitude > 50 THEN 'other' WHEN longitude < -60 THEN 'west' WHEN latitude < 0 AND longitude < 60 THEN 'gulf' ELSE 'east' END AS region,
    CAST(date_trunc('month', activity_date) AS DATE) AS month, sum(export_total) AS x, sum(import_total) AS m, count(DISTINCT activity_date) AS days
  FROM v_activity LEFT JOIN v_profiles USING (port_id) GROUP BY 1, 2),
cmo AS (SELECT 'X' AS flow, month, region, x AS tonnes FROM cm0 WHERE days = extract(day FROM last_day(month)) UNION ALL SELECT 'M', month, region, m FROM cm0 WHERE days = extract(day FROM last_day(month)))"""
PANEL = """
mp0 AS (SELECT flow, month, coalesce(sum(tonnes) FILTER (WHERE region = 'gulf'), 0) AS gulf, coalesce(sum(tonnes) FILTER (WHERE region = 'east'), 0) AS east,
    coalesce(sum(tonnes) FILTER (WHERE region = 'west'), 0) AS west, coalesce(sum(tonnes) FILTER (WHERE region = 'other'), 0) AS other FROM cmo GROUP BY 1, 2),
mp1 AS (SELECT series, CAST(unnest(generate_series(a, b, INTERVAL 1 MONTH)) AS DATE) AS month, flow FROM (SELECT flow, min(month) AS a, max(month) AS b FROM mp0 GROUP BY 1)
  JOIN (VALUES ('all_oil_exports', 'X'), ('all_oil_imports', 'M'), ('crude_exports', 'X'), ('crude_imports', 'M')) AS s(series, f) ON f = flow),
mp AS (SELECT g.series, g.month, cs.value AS official, gulf, east, west, other, gulf + east + west + other AS activity
  FROM mp1 g LEFT JOIN mp0 ON mp0.flow = g.flow AND mp0.month = g.month LEFT JOIN cs ON cs.series = g.series AND cs.month = g.month)"""
BY_COAST = (ACTIVITY, PROFILES, CENSUS, CENSUS_SERIES, COAST_MONTHS, PANEL)


@query("monthly_panel", with_views("SELECT * FROM mp", *BY_COAST))
def monthly_panel(spark: SparkSession, sf: str) -> DataFrame:
    return nc.monthly_panel(census_series(spark, sf), coast_months(spark, sf), {s: f for s, (f, _) in SERIES.items()}, COASTS)


GUESSES = """
ng0 AS (SELECT *, official / nullif(activity, 0) AS ratio, row_number() OVER (PARTITION BY series ORDER BY month) AS i FROM mp),
ng AS (SELECT series, month, official, activity, lag(official) OVER w AS last, CASE WHEN count(official) OVER w3 = 3 THEN avg(official) OVER w3 END AS avg3,
    CASE WHEN i > 12 AND count(ratio) OVER w12 >= 7 THEN quantile_cont(ratio, 0.5) OVER w12 END * activity AS ratio12
  FROM ng0 WINDOW w AS (PARTITION BY series ORDER BY month), w3 AS (PARTITION BY series ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
    w12 AS (PARTITION BY series ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))"""
PUBLISHED = f"""
pn0 AS (SELECT series, month, ratio12 AS nowcast, official, 100 * (ratio12 / nullif(official, 0) - 1) AS error_pct, activity, official IS NULL AS is_live, 'ratio12' AS model
  FROM ng WHERE month >= DATE '{FIRST}' AND activity IS NOT NULL AND ratio12 IS NOT NULL),
pn1 AS (SELECT *, CASE WHEN extract(year FROM month) >= {TEST_FROM} THEN abs(error_pct) END AS e FROM pn0),
pn2 AS (SELECT *, list_sort(list(e) FILTER (WHERE e IS NOT NULL) OVER (PARTITION BY series)) AS all_e,
    list_sort(list(e) FILTER (WHERE e IS NOT NULL) OVER (PARTITION BY series ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS then_e FROM pn1)
SELECT series, month, nowcast, official, error_pct, activity, is_live, model, list_aggregate(all_e, 'quantile_cont', 0.5) AS typical_error_pct,
  list_aggregate(then_e, 'quantile_cont', 0.5) AS typical_then_pct, all_e[CAST(round(0.9 * (len(all_e) - 1)) AS INT) + 1] AS p90_error_pct,
  then_e[CAST(round(0.9 * (len(then_e) - 1)) AS INT) + 1] AS p90_then_pct, t.official_through
FROM pn2 LEFT JOIN (SELECT series AS s, max(month) AS official_through FROM cs WHERE value IS NOT NULL GROUP BY 1) t ON t.s = series"""


@query("oil_trade_nowcast", with_views(PUBLISHED.strip().removeprefix("pn0"), *BY_COAST, GUESSES.rstrip() + ",\npn0"))
def oil_trade_nowcast(spark: SparkSession, sf: str) -> DataFrame:
    guesses = nc.nowcast_guesses(monthly_panel(spark, sf))
    return nc.published_nowcast(guesses, census_series(spark, sf), "series", "ratio12", FIRST, TEST_FROM)


def reported(spark: SparkSession, sf: str) -> DataFrame:
    """Landed rows of oil trade by country, in two vintages."""
    orders = v.table(spark, sf, "orders").join(v.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    nations = v.table(spark, sf, "nation").join(v.table(spark, sf, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    product = F.when(F.col("o_orderpriority") < "4", "Crude oil").otherwise("Gasoline")
    flow = F.when(F.col("o_orderstatus") == "O", "Imports").otherwise("Exports")
    unit = F.when(F.pmod("o_orderkey", F.lit(7)) == 0, "KTONS").otherwise("KBBL")
    joined = orders.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    keys = [F.date_format("o_orderdate", "yyyy-MM").alias("period"), F.col("r_name").alias("reporting_country"), product.alias("product"), flow.alias("flow"), unit.alias("unit"), F.pmod("o_orderkey", F.lit(2)).alias("ingest_seq")]
    return joined.groupBy(*keys).agg(F.sum(F.floor("o_totalprice")).cast("double").alias("quantity_barrels"))


REPORTED = """
v_reported AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, r_name AS reporting_country, CASE WHEN o_orderpriority < '4' THEN 'Crude oil' ELSE 'Gasoline' END AS product,
    CASE o_orderstatus WHEN 'O' THEN 'Imports' ELSE 'Exports' END AS flow, CASE o_orderkey % 7 WHEN 0 THEN 'KTONS' ELSE 'KBBL' END AS unit, o_orderkey % 2 AS ingest_seq,
    CAST(sum(floor(o_totalprice)) AS DOUBLE) AS quantity_barrels
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL)"""
REPORTED_EXPORTS = """
re AS (SELECT reporting_country AS country, CAST(period || '-01' AS DATE) AS month, arg_max(quantity_barrels, ingest_seq) AS reported
  FROM v_reported WHERE product = 'Crude oil' AND flow = 'Exports' AND unit = 'KBBL' GROUP BY 1, 2)"""


@query("reported_exports", with_views("SELECT * FROM re", REPORTED, REPORTED_EXPORTS))
def reported_exports(spark: SparkSession, sf: str) -> DataFrame:
    """Crude exports in thousand barrels: the latest vintage of each period and country."""
    crude = reported(spark, sf).where("product = 'Crude oil' AND flow = 'Exports' AND unit = 'KBBL'")
    latest = keep_last(crude, ["period", "reporting_country"], "ingest_seq")
    return latest.select(F.col("reporting_country").alias("country"), F.to_date(F.concat("period", F.lit("-01"))).alias("month"), F.col("quantity_barrels").alias("reported"))


NAMED = " OR ".join(f"(country = '{c}' AND port_name IN ({', '.join(map(repr, names))}))" for c, names in TERMINALS.items())
BY_COUNTRY = (ACTIVITY, REPORTED, REPORTED_EXPORTS, f"""
ct0 AS (SELECT country, port_id, CAST(date_trunc('month', activity_date) AS DATE) AS month, arg_max(port_name, activity_date) AS port_name, sum(export_total) AS tonnes
  FROM v_activity GROUP BY 1, 2, 3 HAVING count(DISTINCT activity_date) = extract(day FROM last_day(CAST(date_trunc('month', activity_date) AS DATE)))),
ct1 AS (SELECT country, port_id, row_number() OVER (PARTITION BY country ORDER BY sum(tonnes) DESC, port_id) AS r FROM ct0 WHERE month < DATE '{EARLY}' GROUP BY 1, 2),
ct2 AS (SELECT ct0.country, month, sum(tonnes) AS total, coalesce(sum(tonnes) FILTER (WHERE {NAMED.replace('country', 'ct0.country')} OR contains(port_name, '{OFFSHORE}')), 0) AS terminals,
    {', '.join(f'coalesce(sum(tonnes) FILTER (WHERE r = {i}), 0) AS port_{i}' for i in range(1, TOP + 1))}
  FROM ct0 LEFT JOIN ct1 ON ct1.country = ct0.country AND ct1.port_id = ct0.port_id GROUP BY 1, 2),
ct AS (SELECT g.country, g.month, ct2.* EXCLUDE (country, month) FROM (SELECT country, CAST(unnest(generate_series(min(month), max(month), INTERVAL 1 MONTH)) AS DATE) AS month FROM ct2 GROUP BY country) g
  LEFT JOIN ct2 ON ct2.country = g.country AND ct2.month = g.month)""")  # fmt: skip


@query("country_terminals", with_views("SELECT * FROM ct", *BY_COUNTRY))
def country_terminals(spark: SparkSession, sf: str) -> DataFrame:
    name = F.max_by("port_name", "activity_date").alias("port_name")
    monthly = nc.complete_months(v.activity(spark, sf), ["country", "port_id"], "activity_date", {"tonnes": "export_total"}, [name])
    return nc.terminal_panel(monthly, "country", "port_id", "port_name", "tonnes", TERMINALS, OFFSHORE, EARLY, TOP)


def country_panel(spark: SparkSession, sf: str) -> DataFrame:
    return country_terminals(spark, sf).join(reported_exports(spark, sf), ["country", "month"], "left")


LAGGED = """
lm0 AS (SELECT ct.*, reported, row_number() OVER (PARTITION BY ct.country ORDER BY ct.month) AS i, CASE WHEN reported > 0 THEN reported END / nullif(total, 0) AS rt, CASE WHEN reported > 0 THEN reported END / nullif(terminals, 0) AS rm
  FROM ct LEFT JOIN re ON re.country = ct.country AND re.month = ct.month),
lm AS (SELECT country, month, reported, lag(reported, 2) OVER w AS last, CASE WHEN i > 13 AND count(rt) OVER f >= 6 THEN quantile_cont(rt, 0.5) OVER f END * total AS country_ratio,
    CASE WHEN i > 13 AND count(rm) OVER f >= 6 THEN quantile_cont(rm, 0.5) OVER f END * terminals AS terminal_ratio, lag(reported, 2) OVER w * terminals / nullif(lag(terminals, 2) OVER w, 0) AS terminal_change
  FROM lm0 WINDOW w AS (PARTITION BY country ORDER BY month), f AS (PARTITION BY country ORDER BY month ROWS BETWEEN 13 PRECEDING AND 2 PRECEDING))"""


@query("lagged_models", with_views("SELECT * FROM lm", *BY_COUNTRY, LAGGED))
def lagged_models(spark: SparkSession, sf: str) -> DataFrame:
    return nc.lagged_guesses(country_panel(spark, sf), "country", lag=LAG).select("country", "month", "reported", "last", "country_ratio", "terminal_ratio", "terminal_change")


@query("nnls_nowcast")
def nnls_nowcast(spark: SparkSession, sf: str) -> DataFrame:
    """Non-negative least squares of official figures on the coasts, and of reported exports on the biggest ports."""
    coasts = nc.nonnegative_fit(monthly_panel(spark, sf), "series", "official", list(COASTS), -FIT_MONTHS, -1, FIT_MONTHS // 2)
    ports = nc.nonnegative_fit(country_panel(spark, sf), "country", "reported", [f"port_{i}" for i in range(1, TOP + 1)], -LAG - COUNTRY_FIT_MONTHS + 1, -LAG, COUNTRY_FIT_MONTHS // 2)
    one = lambda df, model, entity, actual: df.where("guess IS NOT NULL").select(F.lit(model).alias("model"), F.col(entity).alias("entity"), "month", "n", *[F.get("weights", F.lit(i)).alias(f"weight_{i + 1}") for i in range(len(COASTS))], F.col("guess").alias("nowcast"), F.col(actual).alias("actual"))
    return one(coasts, "coasts", "series", "official").unionByName(one(ports, "ports", "country", "reported"))
