"""Exploration queries, grain and trade panels, oil series, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import pct_change, safe_ratio
from ..operators.keyed import keep_one, top_per_group
from ..operators.temporal import full_mean, rows
from . import panels as pl
from . import views as v
from .panels import BASE, WEEKLY
from .views import ACTIVITY, POSITIONS, PRICES, PROFILES, TRANSITS, VESSELS, with_views
from .vessels import REGISTER, register

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


GLOBAL = "gw AS (SELECT week_start, CAST(sum(portcalls) AS BIGINT) AS portcalls, CAST(sum(portcalls_tanker) AS BIGINT) AS tanker, CAST(sum(portcalls_container) AS BIGINT) AS container FROM pw WHERE is_complete_week GROUP BY 1)"


@query("global_weekly", with_views("SELECT * FROM gw", ACTIVITY, WEEKLY, GLOBAL))
def global_weekly(spark: SparkSession, sf: str) -> DataFrame:
    w = pl.port_weekly(spark, sf).where("is_complete_week")
    return w.groupBy("week_start").agg(F.sum("portcalls").alias("portcalls"), F.sum("portcalls_tanker").alias("tanker"), F.sum("portcalls_container").alias("container"))


@query("rolling_13w", with_views("SELECT port_id, week_start, CASE WHEN count(y) OVER w = 13 THEN avg(y) OVER w END AS mean_13 FROM g WINDOW w AS (PARTITION BY port_id ORDER BY week_start ROWS BETWEEN 6 PRECEDING AND 6 FOLLOWING)", *BASE))
def rolling_13w(spark: SparkSession, sf: str) -> DataFrame:
    return pl.weekly_grid(spark, sf).select("port_id", "week_start", full_mean(F.col("y"), rows("port_id", "week_start", -6, 6), 13).alias("mean_13"))


@query("fleet_shares", with_views("SELECT port_id, 100.0 * sum(portcalls_tanker) / nullif(sum(portcalls), 0) AS tanker_pct, 100.0 * sum(portcalls_container) / nullif(sum(portcalls), 0) AS container_pct FROM v_activity GROUP BY 1", ACTIVITY))
def fleet_shares(spark: SparkSession, sf: str) -> DataFrame:
    share = lambda c: (100.0 * safe_ratio(F.sum(c), F.sum("portcalls")))
    return v.activity(spark, sf).groupBy("port_id").agg(share("portcalls_tanker").alias("tanker_pct"), share("portcalls_container").alias("container_pct"))


QUERIES["port_traits"] = fleet_shares
ORACLE_SQL["port_traits"] = ORACLE_SQL["fleet_shares"]


@query("top_ports_52w", with_views("SELECT port_id, avg(portcalls) AS weekly_calls FROM pw WHERE week_start > (SELECT max(week_start) FROM pw) - 364 GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15", ACTIVITY, WEEKLY))
def top_ports_52w(spark: SparkSession, sf: str) -> DataFrame:
    w = pl.port_weekly(spark, sf)
    last = w.agg(F.max("week_start").alias("last"))
    recent = w.crossJoin(F.broadcast(last)).where("week_start > date_sub(last, 364)")
    return recent.groupBy("port_id").agg(F.avg("portcalls").alias("weekly_calls")).orderBy(F.desc("weekly_calls"), "port_id").limit(15)


@query("month_year_heatmap", with_views("SELECT y AS year, " + ", ".join(f"avg(n) FILTER (WHERE m = {m}) AS m{m}" for m in range(1, 13)) + " FROM (SELECT extract(year FROM activity_date) AS y, extract(month FROM activity_date) AS m, CAST(sum(portcalls) AS BIGINT) AS n FROM v_activity GROUP BY activity_date, 1, 2) GROUP BY 1", ACTIVITY))
def month_year_heatmap(spark: SparkSession, sf: str) -> DataFrame:
    daily = v.activity(spark, sf).groupBy("activity_date").agg(F.sum("portcalls").alias("n"))
    out = daily.withColumns({"year": F.year("activity_date"), "month": F.concat(F.lit("m"), F.month("activity_date").cast("string"))})
    return out.groupBy("year").pivot("month", [f"m{m}" for m in range(1, 13)]).agg(F.avg("n"))


@query("port_size_distribution", with_views("SELECT count(*) AS ports, avg(m) AS mean, quantile_cont(m, 0.5) AS median, count(*) FILTER (WHERE m < 5) AS small, sum(m) FILTER (WHERE r <= 0.1) / sum(m) AS top_decile_share FROM (SELECT m, percent_rank() OVER (ORDER BY m DESC, port_id) AS r FROM (SELECT port_id, avg(portcalls) AS m FROM pw WHERE is_complete_week GROUP BY 1))", ACTIVITY, WEEKLY))
def port_size_distribution(spark: SparkSession, sf: str) -> DataFrame:
    m = pl.port_weekly(spark, sf).where("is_complete_week").groupBy("port_id").agg(F.avg("portcalls").alias("m"))
    m = m.withColumn("r", F.percent_rank().over(Window.orderBy(F.desc("m"), "port_id")))  # a row per port
    return m.agg(F.count("*").alias("ports"), F.avg("m").alias("mean"), F.percentile("m", F.lit(0.5)).alias("median"), F.count(F.when(F.col("m") < 5, 1)).alias("small"), (F.sum(F.when(F.col("r") <= 0.1, F.col("m"))) / F.sum("m")).alias("top_decile_share"))


@query("top_n_spatial_labels", with_views("SELECT port_id, port_name, latitude, longitude, vessel_count_total FROM v_profiles ORDER BY vessel_count_total DESC, port_id LIMIT 10", PROFILES))
def top_n_spatial_labels(spark: SparkSession, sf: str) -> DataFrame:
    p = v.profiles(spark, sf).select("port_id", "port_name", "latitude", "longitude", "vessel_count_total")
    return p.orderBy(F.desc("vessel_count_total"), "port_id").limit(10)


@query("before_after_means", with_views("SELECT chokepoint_id, avg(n_total) FILTER (WHERE transit_date < DATE '1998-01-01') AS before, avg(n_total) FILTER (WHERE transit_date >= DATE '1998-01-01') AS after, 100.0 * (avg(n_total) FILTER (WHERE transit_date >= DATE '1998-01-01') - avg(n_total) FILTER (WHERE transit_date < DATE '1998-01-01')) / avg(n_total) FILTER (WHERE transit_date < DATE '1998-01-01') AS pct FROM v_transits WHERE transit_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31' GROUP BY 1", TRANSITS))
def before_after_means(spark: SparkSession, sf: str) -> DataFrame:
    late = F.col("transit_date") >= "1998-01-01"
    out = v.transits(spark, sf).where(F.col("transit_date").between("1997-01-01", "1998-12-31")).groupBy("chokepoint_id")
    out = out.agg(F.avg(F.when(~late, F.col("n_total"))).alias("before"), F.avg(F.when(late, F.col("n_total"))).alias("after"))
    return out.withColumn("pct", pct_change(F.col("after"), F.col("before")))


STRAITS = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
WIDE = "wide AS (SELECT CAST(date_trunc('week', transit_date) AS DATE) AS week_start, " + ", ".join(f"avg(n_total) FILTER (WHERE chokepoint_id = '{s}') AS s{i}" for i, s in enumerate(STRAITS)) + " FROM v_transits GROUP BY 1)"


@query("weekly_wide", with_views("SELECT * FROM wide", TRANSITS, WIDE))
def weekly_wide(spark: SparkSession, sf: str) -> DataFrame:
    t = v.transits(spark, sf).withColumn("week_start", F.trunc("transit_date", "week"))
    return t.groupBy("week_start").agg(*[F.avg(F.when(F.col("chokepoint_id") == s, F.col("n_total"))).alias(f"s{i}") for i, s in enumerate(STRAITS)])


PAIRED = [(i, j) for i in range(len(STRAITS)) for j in range(i + 1, len(STRAITS))]
MOVES = f"""mv0 AS (SELECT week_start, {", ".join(f"s{i} / nullif(lag(s{i}) OVER (ORDER BY week_start), 0) - 1 AS c{i}" for i in range(len(STRAITS)))} FROM wide),
mv1 AS (SELECT * FROM mv0 WHERE {" AND ".join(f"c{i} IS NOT NULL" for i in range(len(STRAITS)))}),
mv AS ({" UNION ALL ".join(f"SELECT '{STRAITS[i]}' AS a, '{STRAITS[j]}' AS b, week_start, c{i} AS x, c{j} AS y FROM mv1" for i, j in PAIRED)}),
mvr AS (SELECT *, rank() OVER (PARTITION BY a, b ORDER BY x) + (count(*) OVER (PARTITION BY a, b, x) - 1) / 2.0 AS rx, rank() OVER (PARTITION BY a, b ORDER BY y) + (count(*) OVER (PARTITION BY a, b, y) - 1) / 2.0 AS ry,
  row_number() OVER (PARTITION BY a, b ORDER BY abs(x) + abs(y) DESC, week_start) AS extreme FROM mv)"""


@query("pct_change_corr", with_views("SELECT a, b, count(*) AS weeks, corr(x, y) AS pearson, corr(rx, ry) AS spearman, corr(x, y) FILTER (WHERE extreme > 2) AS trimmed FROM mvr GROUP BY 1, 2", TRANSITS, WIDE, MOVES))
def pct_change_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Which straits move together: correlations of weekly changes in percent, of their ranks, and without a pair's two most extreme weeks.

    Weeks in which any strait has no change to compare are left out of all pairs.
    """
    names, w = [f"c{i}" for i in range(len(STRAITS))], Window.orderBy("week_start")  # a row per calendar week
    moves = weekly_wide(spark, sf).select("week_start", *[(safe_ratio(F.col(f"s{i}"), F.lag(f"s{i}").over(w)) - 1).alias(c) for i, c in enumerate(names)]).dropna(subset=names)
    pairs = F.array(*[F.struct(F.lit(STRAITS[i]).alias("a"), F.lit(STRAITS[j]).alias("b"), F.col(names[i]).alias("x"), F.col(names[j]).alias("y")) for i, j in PAIRED])
    each = moves.select("week_start", F.explode(pairs).alias("p")).select("week_start", "p.*")
    return paired_correlations(each, ["a", "b"], "week_start")


def paired_correlations(df: DataFrame, by: list[str], tie: str, drop: int = 2) -> DataFrame:
    """Pearson's and Spearman's correlation of x and y by group (equal values share their mean rank), and Pearson's without the ``drop`` rows of largest |x| + |y|."""
    own = Window.partitionBy(*by)
    mean_rank = lambda c: F.rank().over(own.orderBy(c)) + (F.count("*").over(Window.partitionBy(*by, c)) - 1) / 2
    ranked = df.withColumns({"rx": mean_rank("x"), "ry": mean_rank("y"), "extreme": F.row_number().over(own.orderBy((F.abs("x") + F.abs("y")).desc(), tie))})
    calm = lambda c: F.when(F.col("extreme") > drop, F.col(c))
    return ranked.groupBy(*by).agg(F.count("*").alias("weeks"), F.corr("x", "y").alias("pearson"), F.corr("rx", "ry").alias("spearman"), F.corr(calm("x"), calm("y")).alias("trimmed"))


@query("area_calls_per_week", with_views("SELECT CASE WHEN longitude < -30 THEN 'west' WHEN longitude < 60 THEN 'middle' ELSE 'east' END AS area, CAST(date_trunc('month', activity_date) AS DATE) AS month, sum(portcalls) / count(DISTINCT date_trunc('week', activity_date)) AS calls_per_week FROM v_activity JOIN v_profiles USING (port_id) GROUP BY 1, 2", ACTIVITY, PROFILES))
def area_calls_per_week(spark: SparkSession, sf: str) -> DataFrame:
    area = F.when(F.col("longitude") < -30, "west").when(F.col("longitude") < 60, "middle").otherwise("east")
    joined = v.activity(spark, sf).select("port_id", "activity_date", "portcalls").join(v.profiles(spark, sf).select("port_id", "longitude"), "port_id")
    return joined.groupBy(area.alias("area"), F.trunc("activity_date", "month").alias("month")).agg((F.sum("portcalls") / F.count_distinct(F.trunc("activity_date", "week"))).alias("calls_per_week"))


@query("vessel_groups", with_views("SELECT CASE WHEN regexp_matches(vessel_type, 'MACH|AUTO') THEN 'cargo' WHEN vessel_type LIKE '%BUILD%' THEN 'tanker' ELSE 'other' END AS vessel_group, count(DISTINCT coalesce(p.imo, p.mmsi)) AS vessels, count(*) AS reports FROM v_positions p LEFT JOIN reg r ON r.imo = p.imo GROUP BY 1", POSITIONS, VESSELS, REGISTER))
def vessel_groups(spark: SparkSession, sf: str) -> DataFrame:
    group = F.when(F.col("vessel_type").rlike("MACH|AUTO"), "cargo").when(F.col("vessel_type").contains("BUILD"), "tanker").otherwise("other")
    joined = v.positions(spark, sf).select("imo", "mmsi").join(register(spark, sf).select("imo", "vessel_type"), "imo", "left")
    return joined.groupBy(group.alias("vessel_group")).agg(F.count_distinct(F.coalesce("imo", "mmsi")).alias("vessels"), F.count("*").alias("reports"))


SPEEDS = """sp0 AS (SELECT sog, CASE WHEN regexp_matches(vessel_type, 'MACH|AUTO') THEN 'cargo' WHEN vessel_type LIKE '%BUILD%' THEN 'tanker' ELSE 'other' END AS vessel_group FROM v_positions p LEFT JOIN reg r ON r.imo = p.imo WHERE sog BETWEEN 0 AND 30),
spq AS (SELECT vessel_group, count(*) AS n, avg(sog) AS mean, quantile_cont(sog, 0.25) AS q1, quantile_cont(sog, 0.5) AS median, quantile_cont(sog, 0.75) AS q3 FROM sp0 WHERE sog >= 0.5 GROUP BY 1)"""


@query("speed_profile", with_views("""SELECT 'histogram' AS kind, NULL AS vessel_group, least(floor(sog / 0.5) * 0.5, 29.5) AS bin, count(*) AS n, avg(sog) AS mean, NULL::DOUBLE AS q1, NULL::DOUBLE AS median, NULL::DOUBLE AS q3, NULL::DOUBLE AS low, NULL::DOUBLE AS high FROM sp0 GROUP BY 3
 UNION ALL SELECT 'box', q.vessel_group, NULL, any_value(q.n), any_value(q.mean), any_value(q1), any_value(median), any_value(q3), min(sog) FILTER (WHERE sog >= q1 - 1.5 * (q3 - q1)), max(sog) FILTER (WHERE sog <= q3 + 1.5 * (q3 - q1)) FROM spq q JOIN sp0 s ON s.vessel_group = q.vessel_group AND sog >= 0.5 GROUP BY q.vessel_group""", POSITIONS, VESSELS, REGISTER, SPEEDS))
def speed_profile(spark: SparkSession, sf: str) -> DataFrame:
    """Possible speeds in half knots, and boxes of moving ships by group with whiskers at 1.5 quartile ranges."""
    group = F.when(F.col("vessel_type").rlike("MACH|AUTO"), "cargo").when(F.col("vessel_type").contains("BUILD"), "tanker").otherwise("other")
    p = v.positions(spark, sf).where("sog BETWEEN 0 AND 30").select("imo", "sog").join(register(spark, sf).select("imo", "vessel_type"), "imo", "left").select("sog", group.alias("vessel_group"))
    bars = p.groupBy(F.least(F.floor(F.col("sog") / 0.5) * 0.5, F.lit(29.5)).alias("bin")).agg(F.count("*").alias("n"), F.avg("sog").alias("mean")).withColumn("kind", F.lit("histogram"))
    moving = p.where("sog >= 0.5")
    boxes = moving.groupBy("vessel_group").agg(F.count("*").alias("n"), F.avg("sog").alias("mean"), *[F.percentile("sog", F.lit(q)).alias(c) for c, q in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))])
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    ends = moving.join(F.broadcast(boxes), "vessel_group").groupBy("vessel_group").agg(F.min(F.when(F.col("sog") >= F.col("q1") - reach, F.col("sog"))).alias("low"), F.max(F.when(F.col("sog") <= F.col("q3") + reach, F.col("sog"))).alias("high"))
    box = boxes.join(ends, "vessel_group").withColumn("kind", F.lit("box"))
    columns = ["kind", "vessel_group", "bin", "n", "mean", "q1", "median", "q3", "low", "high"]
    return box.unionByName(bars, allowMissingColumns=True).select(columns)


@query("latest_snapshot", with_views("SELECT event_id, partition_date FROM v_positions WHERE partition_date = (SELECT max(partition_date) FROM v_positions)", POSITIONS))
def latest_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf).select("event_id", "partition_date")
    return p.join(F.broadcast(p.agg(F.max("partition_date").alias("partition_date"))), "partition_date", "left_semi")


@query("label_counts", "SELECT upper(event_type) AS label, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM events GROUP BY 1")
def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    out = v.table(spark, sf, "events").groupBy(F.upper("event_type").alias("label")).agg(F.count("*").alias("n"))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))  # a row per label


@query("summarize", "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, avg({c}) AS mean, quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, 100.0 * (count(*) - count({c})) / count(*) AS null_pct FROM lineitem" for c in ("l_quantity", "l_discount", "l_linenumber")) + ")")
def summarize(spark: SparkSession, sf: str) -> DataFrame:
    df = v.table(spark, sf, "lineitem")
    q = lambda c, x: F.percentile(c, F.lit(x))
    cells = [F.struct(F.lit(c).alias("column_name"), F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max"), F.avg(c).alias("mean"), q(c, 0.25).alias("q25"), q(c, 0.5).alias("q50"), q(c, 0.75).alias("q75"), (100.0 * F.count(F.when(F.col(c).isNull(), 1)) / F.count("*")).alias("null_pct")) for c in ("l_quantity", "l_discount", "l_linenumber")]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c"))


# --- trade


FLOWS = "fl AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CASE l_linestatus WHEN 'F' THEN 'M' ELSE 'X' END AS flow, p_brand AS partner, p_type AS product, CASE WHEN l_returnflag = 'R' THEN 'KG' ELSE 'T' END AS unit, l_quantity AS quantity, round(l_extendedprice) AS value_usd FROM lineitem JOIN part ON p_partkey = l_partkey)"


def flows(spark: SparkSession, sf: str) -> DataFrame:
    """Trade records: month, flow, partner, product, unit, quantity and value."""
    lines = v.table(spark, sf, "lineitem").join(v.table(spark, sf, "part").select("p_partkey", "p_brand", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return lines.select(F.trunc("l_shipdate", "month").alias("month"), F.when(F.col("l_linestatus") == "F", "M").otherwise("X").alias("flow"), F.col("p_brand").alias("partner"), F.col("p_type").alias("product"), F.when(F.col("l_returnflag") == "R", "KG").otherwise("T").alias("unit"), F.col("l_quantity").alias("quantity"), F.round("l_extendedprice").alias("value_usd"))


@query("trade_totals", with_views("SELECT month, coalesce(sum(value_usd) FILTER (WHERE flow = 'M'), 0) / 1e9 AS imports, coalesce(sum(value_usd) FILTER (WHERE flow = 'X'), 0) / 1e9 AS exports, (coalesce(sum(value_usd) FILTER (WHERE flow = 'X'), 0) - coalesce(sum(value_usd) FILTER (WHERE flow = 'M'), 0)) / 1e9 AS balance FROM fl GROUP BY 1", FLOWS))
def trade_totals(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda f: F.coalesce(F.sum(F.when(F.col("flow") == f, F.col("value_usd"))), F.lit(0.0)) / 1e9
    return flows(spark, sf).groupBy("month").agg(of("M").alias("imports"), of("X").alias("exports"), (F.coalesce(F.sum(F.when(F.col("flow") == "X", F.col("value_usd"))), F.lit(0.0)) / 1e9 - of("M")).alias("balance"))


@query("top_partners_12m", with_views("SELECT partner, coalesce(sum(value_usd) FILTER (WHERE flow = 'M'), 0) AS imports, coalesce(sum(value_usd) FILTER (WHERE flow = 'X'), 0) AS exports FROM fl WHERE month > (SELECT max(month) FROM fl) - INTERVAL 12 MONTH GROUP BY 1 ORDER BY sum(value_usd) DESC, 1 LIMIT 12", FLOWS))
def top_partners_12m(spark: SparkSession, sf: str) -> DataFrame:
    f = flows(spark, sf)
    recent = f.crossJoin(F.broadcast(f.agg(F.max("month").alias("last")))).where("month > add_months(last, -12)")
    of = lambda x: F.coalesce(F.sum(F.when(F.col("flow") == x, F.col("value_usd"))), F.lit(0.0))
    out = recent.groupBy("partner").agg(of("M").alias("imports"), of("X").alias("exports"), F.sum("value_usd").alias("total"))
    return out.orderBy(F.desc("total"), "partner").limit(12).drop("total")


@query("top_chapters", with_views("SELECT product, min(partner) AS label, sum(value_usd) AS value_usd FROM fl WHERE flow = 'M' GROUP BY 1 ORDER BY 3 DESC, 1 LIMIT 5", FLOWS))
def top_chapters(spark: SparkSession, sf: str) -> DataFrame:
    out = flows(spark, sf).where("flow = 'M'").groupBy("product").agg(F.min("partner").alias("label"), F.sum("value_usd").alias("value_usd"))
    return out.orderBy(F.desc("value_usd"), "product").limit(5)


MONTHLY = "tm AS (SELECT product, flow, month, sum(CASE WHEN unit = 'T' THEN quantity ELSE quantity / 1000 END) AS quantity_mt, sum(value_usd) AS value_usd FROM fl GROUP BY 1, 2, 3)"


@query("trade_monthly", with_views("SELECT a.product, a.flow, a.month, a.quantity_mt, a.value_usd, a.value_usd / nullif(a.quantity_mt, 0) AS usd_per_mt, p.quantity_mt AS quantity_prior_year_mt, 100.0 * (a.quantity_mt - p.quantity_mt) / nullif(p.quantity_mt, 0) AS quantity_vs_prior_year_pct, (SELECT avg(b.quantity_mt) FROM tm b WHERE b.product = a.product AND b.flow = a.flow AND extract(month FROM b.month) = extract(month FROM a.month) AND b.month < a.month AND b.month >= a.month - INTERVAL 60 MONTH) AS quantity_avg5_mt FROM tm a LEFT JOIN tm p ON p.product = a.product AND p.flow = a.flow AND p.month = a.month - INTERVAL 12 MONTH", FLOWS, MONTHLY))
def trade_monthly(spark: SparkSession, sf: str) -> DataFrame:
    mt = F.sum(F.when(F.col("unit") == "T", F.col("quantity")).otherwise(F.col("quantity") / 1000))
    m = flows(spark, sf).groupBy("product", "flow", "month").agg(mt.alias("quantity_mt"), F.sum("value_usd").alias("value_usd"))
    # the same month of other years is one partition; years are the order
    w = Window.partitionBy("product", "flow", F.month("month")).orderBy(F.year("month"))
    prior = F.sum("quantity_mt").over(w.rangeBetween(-1, -1))
    m = m.withColumns({"quantity_prior_year_mt": prior, "quantity_avg5_mt": F.avg("quantity_mt").over(w.rangeBetween(-5, -1))})
    return m.withColumns({"usd_per_mt": safe_ratio(F.col("value_usd"), F.col("quantity_mt")), "quantity_vs_prior_year_pct": pct_change(F.col("quantity_mt"), F.col("quantity_prior_year_mt"))})


@query("per_day_rate", with_views("SELECT product, flow, month, quantity_mt / extract(day FROM last_day(month)) AS mt_per_day FROM tm", FLOWS, MONTHLY))
def per_day_rate(spark: SparkSession, sf: str) -> DataFrame:
    return trade_monthly(spark, sf).select("product", "flow", "month", (F.col("quantity_mt") / F.day(F.last_day("month"))).alias("mt_per_day"))


@query("unit_coverage", with_views("SELECT partner, unit, min(month) AS first_month, max(month) AS last_month, count(DISTINCT month) AS months FROM fl GROUP BY 1, 2", FLOWS))
def unit_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return flows(spark, sf).groupBy("partner", "unit").agg(F.min("month").alias("first_month"), F.max("month").alias("last_month"), F.count_distinct("month").alias("months"))


@query("series_coverage", with_views("SELECT extract(year FROM price_date) AS year, count(brent_usd) AS brent, count(wti_usd) AS wti FROM v_prices GROUP BY 1", PRICES))
def series_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return v.prices(spark, sf).groupBy(F.year("price_date").alias("year")).agg(F.count("brent_usd").alias("brent"), F.count("wti_usd").alias("wti"))


QUERIES["coverage_table"] = lambda spark, sf: flows(spark, sf).groupBy("product", "flow").agg(F.min("month").alias("first"), F.max("month").alias("last"), F.count("*").alias("n"))
ORACLE_SQL["coverage_table"] = with_views('SELECT product, flow, min(month) AS "first", max(month) AS "last", count(*) AS n FROM fl GROUP BY 1, 2', FLOWS)


@query("sanctions_match", with_views("SELECT count(DISTINCT s.imo) AS listed, count(DISTINCT p.imo) AS seen FROM (SELECT imo FROM v_vessels WHERE mmsi % 9 = 0) s LEFT JOIN (SELECT DISTINCT imo FROM v_positions) p USING (imo)", POSITIONS, VESSELS))
def sanctions_match(spark: SparkSession, sf: str) -> DataFrame:
    listed = v.vessels(spark, sf).where("mmsi % 9 = 0").select("imo").distinct()
    seen = v.positions(spark, sf).select(F.col("imo").alias("seen_imo")).distinct()
    return listed.join(seen, F.col("imo") == F.col("seen_imo"), "left").agg(F.count("imo").alias("listed"), F.count("seen_imo").alias("seen"))


@query("sanctions_last_seen", with_views("SELECT imo, event_id, latitude, longitude FROM (SELECT p.*, row_number() OVER (PARTITION BY imo ORDER BY timestamp DESC, event_id DESC) AS n FROM v_positions p WHERE imo IN (SELECT imo FROM v_vessels WHERE mmsi % 9 = 0)) WHERE n = 1", POSITIONS, VESSELS))
def sanctions_last_seen(spark: SparkSession, sf: str) -> DataFrame:
    listed = v.vessels(spark, sf).where("mmsi % 9 = 0").select("imo")
    p = v.positions(spark, sf).join(listed, "imo", "left_semi")
    return keep_one(p, ["imo"], [F.desc("timestamp"), F.desc("event_id")]).select("imo", "event_id", "latitude", "longitude")


# --- seasons


SALES = """sl0 AS (SELECT p_type AS commodity, c_nationkey AS country, CAST(date_trunc('week', l_shipdate) AS DATE) + 3 AS week_ending, l_quantity AS q, l_returnflag AS f
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN part ON p_partkey = l_partkey WHERE p_type IN ('STANDARD', 'ECONOMY', 'PROMO')),
sl AS (SELECT commodity, country, week_ending, CAST(extract(year FROM week_ending) AS INT) - CASE WHEN extract(month FROM week_ending) >= 9 THEN 0 ELSE 1 END AS season, sum(q) AS weekly, sum(CASE WHEN f = 'N' THEN q ELSE 0 END) AS open FROM sl0 GROUP BY 1, 2, 3, 4),
wt AS (SELECT *, CAST((week_ending - make_date(season, 9, 1)) // 7 + 1 AS INT) AS my_week FROM (SELECT commodity, season, week_ending, sum(weekly) AS weekly_mt, sum(open) AS outstanding_mt, count(*) AS n_destinations FROM sl GROUP BY 1, 2, 3)),
cu AS (SELECT *, sum(weekly_mt) OVER w AS shipped_mt, sum(weekly_mt) OVER w + outstanding_mt AS commitments_mt, avg(weekly_mt) OVER (PARTITION BY commodity, season ORDER BY week_ending ROWS 3 PRECEDING) AS weekly_4wk FROM wt WINDOW w AS (PARTITION BY commodity, season ORDER BY week_ending)),
fi AS (SELECT commodity, season, arg_max(shipped_mt, my_week) AS final_mt FROM cu GROUP BY 1, 2 HAVING season < (SELECT max(season) FROM cu c2 WHERE c2.commodity = cu.commodity))"""


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly export sales by commodity, season and country; seasons begin in September."""
    t = lambda n: v.table(spark, sf, n)
    lines = t("lineitem").join(t("part").where(F.col("p_type").isin("STANDARD", "ECONOMY", "PROMO")).select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    lines = lines.join(t("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    week = F.date_add(F.trunc("l_shipdate", "week"), 3)
    season = F.year("week_ending") - F.when(F.month("week_ending") >= 9, 0).otherwise(1)
    lines = lines.withColumn("week_ending", week).withColumn("season", season)
    return lines.groupBy(F.col("p_type").alias("commodity"), F.col("c_nationkey").alias("country"), "week_ending", "season").agg(F.sum("l_quantity").alias("weekly"), F.sum(F.when(F.col("l_returnflag") == "N", F.col("l_quantity")).otherwise(0.0)).alias("open"))


def marketing_week(season: Column, day: Column) -> Column:
    return (F.floor(F.datediff(day, F.make_date(season, F.lit(9), F.lit(1))) / 7) + 1).cast("int")


@query("marketing_year_week", with_views("SELECT * FROM wt", SALES))
def marketing_year_week(spark: SparkSession, sf: str) -> DataFrame:
    out = sales(spark, sf).groupBy("commodity", "season", "week_ending").agg(F.sum("weekly").alias("weekly_mt"), F.sum("open").alias("outstanding_mt"), F.count("*").alias("n_destinations"))
    return out.withColumn("my_week", marketing_week(F.col("season"), F.col("week_ending")))


def season_state(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("commodity", "season").orderBy("week_ending")
    out = marketing_year_week(spark, sf).withColumn("shipped_mt", F.sum("weekly_mt").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return out.withColumns({"commitments_mt": F.col("shipped_mt") + F.col("outstanding_mt"), "weekly_4wk": F.avg("weekly_mt").over(w.rowsBetween(-3, 0))})


@query("season_curves", with_views("SELECT commodity, season, week_ending, shipped_mt, row_number() OVER (PARTITION BY commodity, season ORDER BY week_ending) AS n FROM cu", SALES))
def season_curves(spark: SparkSession, sf: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("commodity", "season").orderBy("week_ending"))
    return season_state(spark, sf).select("commodity", "season", "week_ending", "shipped_mt", n.alias("n"))


@query("export_pace", with_views("""SELECT c.commodity, c.season, c.my_week, c.week_ending, c.commitments_mt, c.shipped_mt, c.weekly_4wk, p.commitments_mt AS commitments_prior_year_mt, 100.0 * (c.commitments_mt - p.commitments_mt) / nullif(p.commitments_mt, 0) AS commitments_vs_prior_year_pct,
 b.avg5 AS commitments_avg5_mt, b.n AS n_baseline_years, b.share AS share_committed_avg5, c.commitments_mt / nullif(b.share, 0) AS pace_projection_mt, f.final_mt AS final_shipped_mt
 FROM cu c LEFT JOIN cu p ON p.commodity = c.commodity AND p.season = c.season - 1 AND p.my_week = c.my_week LEFT JOIN fi f ON f.commodity = c.commodity AND f.season = c.season
 LEFT JOIN (SELECT c.commodity, c.season, c.my_week, avg(b.commitments_mt) AS avg5, count(*) AS n, avg(b.commitments_mt / nullif(g.final_mt, 0)) AS share FROM cu c JOIN cu b ON b.commodity = c.commodity AND b.my_week = c.my_week AND b.season BETWEEN c.season - 5 AND c.season - 1 LEFT JOIN fi g ON g.commodity = b.commodity AND g.season = b.season GROUP BY 1, 2, 3) b ON b.commodity = c.commodity AND b.season = c.season AND b.my_week = c.my_week""", SALES))
def export_pace(spark: SparkSession, sf: str) -> DataFrame:
    """Where a season stands against the same week of earlier ones."""
    s = season_state(spark, sf)
    newest = F.max("season").over(Window.partitionBy("commodity"))
    final = s.withColumn("newest", newest).where("season < newest").groupBy("commodity", "season").agg(F.max_by("shipped_mt", "my_week").alias("final_shipped_mt"))
    s = s.join(final, ["commodity", "season"], "left")
    w = Window.partitionBy("commodity", "my_week").orderBy("season")
    past, last = w.rangeBetween(-5, -1), w.rangeBetween(-1, -1)
    share = safe_ratio(F.col("commitments_mt"), F.col("final_shipped_mt"))
    n = F.count("*").over(past)
    s = s.withColumn("own_share", share).withColumns({"commitments_prior_year_mt": F.sum("commitments_mt").over(last), "commitments_avg5_mt": F.avg("commitments_mt").over(past), "n_baseline_years": F.when(n > 0, n), "share_committed_avg5": F.avg("own_share").over(past)})
    s = s.withColumns({"commitments_vs_prior_year_pct": pct_change(F.col("commitments_mt"), F.col("commitments_prior_year_mt")), "pace_projection_mt": safe_ratio(F.col("commitments_mt"), F.col("share_committed_avg5"))})
    return s.select("commodity", "season", "my_week", "week_ending", "commitments_mt", "shipped_mt", "weekly_4wk", "commitments_prior_year_mt", "commitments_vs_prior_year_pct", "commitments_avg5_mt", "n_baseline_years", "share_committed_avg5", "pace_projection_mt", "final_shipped_mt")


@query("latest_pace", with_views("SELECT commodity, season, my_week, commitments_mt FROM (SELECT *, row_number() OVER (PARTITION BY commodity ORDER BY week_ending DESC) AS n FROM cu) WHERE n = 1", SALES))
def latest_pace(spark: SparkSession, sf: str) -> DataFrame:
    return keep_one(season_state(spark, sf), ["commodity"], [F.desc("week_ending")]).select("commodity", "season", "my_week", "commitments_mt")


@query("export_destinations", with_views("SELECT commodity, season, week_ending, country, weekly, 100.0 * weekly / nullif(sum(weekly) OVER (PARTITION BY commodity, week_ending), 0) AS share_pct FROM sl", SALES))
def export_destinations(spark: SparkSession, sf: str) -> DataFrame:
    total = F.sum("weekly").over(Window.partitionBy("commodity", "week_ending"))
    return sales(spark, sf).select("commodity", "season", "week_ending", "country", "weekly", (100.0 * safe_ratio(F.col("weekly"), total)).alias("share_pct"))


@query("buyers_by_season", with_views("SELECT season, CASE WHEN r <= 4 THEN country ELSE -1 END AS buyer, sum(t) AS total FROM (SELECT season, country, sum(weekly) AS t FROM sl WHERE season < (SELECT max(season) FROM sl) GROUP BY 1, 2) JOIN (SELECT country, row_number() OVER (ORDER BY sum(weekly) DESC, country) AS r FROM sl GROUP BY 1) USING (country) GROUP BY 1, 2", SALES))
def buyers_by_season(spark: SparkSession, sf: str) -> DataFrame:
    s = sales(spark, sf)
    rank = F.row_number().over(Window.orderBy(F.desc("t"), "country"))  # a row per country
    ranked = s.groupBy("country").agg(F.sum("weekly").alias("t")).select("country", rank.alias("r"))
    done = s.crossJoin(F.broadcast(s.agg(F.max("season").alias("newest")))).where("season < newest").join(ranked, "country")
    return done.groupBy("season", F.when(F.col("r") <= 4, F.col("country")).otherwise(-1).alias("buyer")).agg(F.sum("weekly").alias("total"))


# --- prices


@query("daily_prices", with_views("SELECT price_date, brent_usd, wti_usd FROM v_prices", PRICES))
def daily_prices(spark: SparkSession, sf: str) -> DataFrame:
    return v.prices(spark, sf)


FEATURES = "pf AS (SELECT price_date, brent_usd - wti_usd AS spread, ln(brent_usd / lag(brent_usd, 5) OVER o) AS r_5, CASE WHEN count(r) OVER w20 = 20 THEN stddev_samp(r) OVER w20 * sqrt(252) END AS vol_20, CASE WHEN count(*) OVER w260 >= 200 THEN brent_usd / max(brent_usd) OVER w260 - 1 END AS drawdown FROM (SELECT *, ln(brent_usd / lag(brent_usd) OVER (ORDER BY price_date)) AS r FROM v_prices) WINDOW o AS (ORDER BY price_date), w20 AS (ORDER BY price_date ROWS 19 PRECEDING), w260 AS (ORDER BY price_date ROWS 259 PRECEDING))"


@query("price_features", with_views("SELECT * FROM pf", PRICES, FEATURES))
def price_features(spark: SparkSession, sf: str) -> DataFrame:
    """One series of daily closes: a row per calendar day, so ordered windows are cheap."""
    o = Window.orderBy("price_date")
    p = v.prices(spark, sf).withColumn("r", F.log(F.col("brent_usd") / F.lag("brent_usd").over(o)))
    w20, w260 = o.rowsBetween(-19, 0), o.rowsBetween(-259, 0)
    vol = F.when(F.count("r").over(w20) == 20, F.stddev_samp("r").over(w20) * F.sqrt(F.lit(252.0)))
    down = F.when(F.count("*").over(w260) >= 200, F.col("brent_usd") / F.max("brent_usd").over(w260) - 1)
    return p.select("price_date", (F.col("brent_usd") - F.col("wti_usd")).alias("spread"), F.log(F.col("brent_usd") / F.lag("brent_usd", 5).over(o)).alias("r_5"), vol.alias("vol_20"), down.alias("drawdown"))


@query("weekly_chokepoints", with_views("SELECT chokepoint_id, transit_date + CAST((12 - extract(dow FROM transit_date)) % 7 AS INT) AS week_end, CAST(sum(n_tanker) AS BIGINT) AS tankers, count(*) AS days FROM v_transits GROUP BY 1, 2", TRANSITS))
def weekly_chokepoints(spark: SparkSession, sf: str) -> DataFrame:
    """Weeks from Saturday to Friday."""
    friday = F.date_add("transit_date", F.pmod(4 - F.weekday("transit_date"), F.lit(7)))
    return v.transits(spark, sf).groupBy("chokepoint_id", friday.alias("week_end")).agg(F.sum("n_tanker").alias("tankers"), F.count("*").alias("days"))


@query("coast_tonnes", with_views("SELECT CASE WHEN longitude < 0 THEN 'west' ELSE 'east' END AS coast, CAST(date_trunc('month', activity_date) AS DATE) AS month, sum(import_total) AS imports, sum(export_total) AS exports FROM v_activity JOIN v_profiles USING (port_id) GROUP BY 1, 2 HAVING count(DISTINCT activity_date) = extract(day FROM last_day(CAST(date_trunc('month', activity_date) AS DATE)))", ACTIVITY, PROFILES))
def coast_tonnes(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly sums by coast, of complete months."""
    coast = F.when(F.col("longitude") < 0, "west").otherwise("east")
    joined = v.activity(spark, sf).join(v.profiles(spark, sf).select("port_id", "longitude"), "port_id")
    out = joined.groupBy(coast.alias("coast"), F.trunc("activity_date", "month").alias("month")).agg(F.sum("import_total").alias("imports"), F.sum("export_total").alias("exports"), F.count_distinct("activity_date").alias("days"))
    return out.where(F.col("days") == F.day(F.last_day("month"))).drop("days")


NOWCAST = """nc0 AS (SELECT month, sum(imports) AS current, sum(imports) * (0.5 + extract(month FROM month) / 100) AS census FROM (SELECT CAST(date_trunc('month', activity_date) AS DATE) AS month, import_total AS imports FROM v_activity) GROUP BY 1),
nc AS (SELECT month, census AS actual, lag(census) OVER o AS last, avg(census) OVER (ORDER BY month ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS avg3, CASE WHEN count(census / current) OVER r >= 7 THEN quantile_cont(census / current, 0.5) OVER r END * current AS ratio12 FROM nc0 WINDOW o AS (ORDER BY month), r AS (ORDER BY month ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))"""


@query("nowcast_models", with_views("SELECT * FROM nc", ACTIVITY, NOWCAST))
def nowcast_models(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly series: a row per calendar month."""
    m = v.activity(spark, sf).groupBy(F.trunc("activity_date", "month").alias("month")).agg(F.sum("import_total").alias("current"))
    m = m.withColumn("actual", F.col("current") * (0.5 + F.month("month") / 100)).withColumn("ratio", F.col("actual") / F.col("current"))
    o = Window.orderBy("month")
    r = o.rowsBetween(-12, -1)
    ratio = F.when(F.count("ratio").over(r) >= 7, F.percentile("ratio", F.lit(0.5)).over(r)) * F.col("current")
    return m.select("month", "actual", F.lag("actual").over(o).alias("last"), F.avg("actual").over(o.rowsBetween(-3, -1)).alias("avg3"), ratio.alias("ratio12"))


LONG = "lg AS (SELECT month, model, actual, prediction, abs(prediction / actual - 1) * 100 AS error_pct FROM (SELECT month, actual, 'last' AS model, last AS prediction FROM nc UNION ALL SELECT month, actual, 'avg3', avg3 FROM nc UNION ALL SELECT month, actual, 'ratio12', ratio12 FROM nc) WHERE prediction IS NOT NULL)"


@query("nowcast_backtest", with_views("SELECT * FROM lg", ACTIVITY, NOWCAST, LONG))
def nowcast_backtest(spark: SparkSession, sf: str) -> DataFrame:
    out = nowcast_models(spark, sf).unpivot(["month", "actual"], ["last", "avg3", "ratio12"], "model", "prediction").where("prediction IS NOT NULL")
    return out.withColumn("error_pct", F.abs(F.col("prediction") / F.col("actual") - 1) * 100)


@query("nowcast_scores", with_views("SELECT model, extract(year FROM month) AS year, quantile_cont(error_pct, 0.5) AS median_error, count(*) AS n FROM lg GROUP BY GROUPING SETS ((model, year), (model))".replace("extract(year FROM month) AS year", "year").replace("FROM lg", "FROM (SELECT *, extract(year FROM month) AS year FROM lg)"), ACTIVITY, NOWCAST, LONG))
def nowcast_scores(spark: SparkSession, sf: str) -> DataFrame:
    b = nowcast_backtest(spark, sf).withColumn("year", F.year("month"))
    return b.groupingSets([("model", "year"), ("model",)], "model", "year").agg(F.percentile("error_pct", F.lit(0.5)).alias("median_error"), F.count("*").alias("n"))


@query("choose_model", with_views("SELECT arg_min(model, (e, model)) AS chosen, min(e) AS median_error FROM (SELECT model, quantile_cont(error_pct, 0.5) AS e FROM lg WHERE extract(year FROM month) IN (1997, 1998) GROUP BY 1)", ACTIVITY, NOWCAST, LONG))
def choose_model(spark: SparkSession, sf: str) -> DataFrame:
    e = nowcast_backtest(spark, sf).where("year(month) IN (1997, 1998)").groupBy("model").agg(F.percentile("error_pct", F.lit(0.5)).alias("e"))
    return e.agg(F.min_by("model", F.struct("e", "model")).alias("chosen"), F.min("e").alias("median_error"))


@query("calibration_bins", with_views("SELECT CASE WHEN base_rate < 0.01 THEN 0 WHEN base_rate < 0.02 THEN 1 WHEN base_rate < 0.05 THEN 2 WHEN base_rate < 0.1 THEN 3 ELSE 4 END AS bin, count(*) AS n, avg(base_rate) AS predicted, avg(y) AS actual FROM wa GROUP BY 1", *pl.FULL))
def calibration_bins(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("base_rate")
    b = F.when(p < 0.01, 0).when(p < 0.02, 1).when(p < 0.05, 2).when(p < 0.1, 3).otherwise(4)
    return pl.warning_rows(spark, sf).groupBy(b.alias("bin")).agg(F.count("*").alias("n"), F.avg("base_rate").alias("predicted"), F.avg("y").alias("actual"))


@query("record_weekly", with_views("SELECT target_week, count(*) FILTER (WHERE flagged) AS alerts, count(*) FILTER (WHERE flagged AND y = 1) AS hits, count(DISTINCT port_id) FILTER (WHERE y = 1) AS disrupted, count(DISTINCT port_id) FILTER (WHERE y = 1 AND flagged) AS caught FROM al GROUP BY 1", *pl.FULL, pl.ALERTS))
def record_weekly(spark: SparkSession, sf: str) -> DataFrame:
    f, y = F.col("flagged"), F.col("y") == 1
    return pl.top_budget_alerts(spark, sf).groupBy("target_week").agg(F.count(F.when(f, 1)).alias("alerts"), F.count(F.when(f & y, 1)).alias("hits"), F.count_distinct(F.when(y, F.col("port_id"))).alias("disrupted"), F.count_distinct(F.when(y & f, F.col("port_id"))).alias("caught"))


@query("drop_state", with_views("SELECT port_id, week_start, lag(z, 1) OVER w AS z_1, min(z) OVER (PARTITION BY port_id ORDER BY week_start ROWS 3 PRECEDING) AS min_z_4, coalesce(least((week_start - max(CASE WHEN is_drop THEN week_start END) OVER w) // 7, 156), 156) AS weeks_since, count(*) FILTER (WHERE is_drop) OVER (PARTITION BY port_id ORDER BY week_start ROWS 51 PRECEDING) AS drops_52, spread / nullif(base, 0) AS rel_spread FROM lb WINDOW w AS (PARTITION BY port_id ORDER BY week_start)", *BASE, pl.LABELS))
def drop_state(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("port_id").orderBy("week_start")
    last = F.max(F.when(F.col("is_drop"), F.col("week_start"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    since = F.coalesce(F.least(F.floor(F.datediff("week_start", last) / 7), F.lit(156)), F.lit(156))
    return pl.label_drops(spark, sf).select("port_id", "week_start", F.lag("z", 1).over(w).alias("z_1"), F.min("z").over(rows("port_id", "week_start", -3, 0)).alias("min_z_4"), since.alias("weeks_since"), F.count(F.when(F.col("is_drop"), 1)).over(rows("port_id", "week_start", -51, 0)).alias("drops_52"), safe_ratio(F.col("spread"), F.col("base")).alias("rel_spread"))


@query("season_windows", with_views("SELECT port_id, CAST(extract(year FROM activity_date) AS INT) AS year, CAST(sum(portcalls) AS BIGINT) AS calls, sum(import_total) AS imports, count(*) AS days FROM v_activity WHERE extract(month FROM activity_date) BETWEEN 2 AND 7 GROUP BY 1, 2", ACTIVITY))
def season_windows(spark: SparkSession, sf: str) -> DataFrame:
    a = v.activity(spark, sf).where("month(activity_date) BETWEEN 2 AND 7")
    return a.groupBy("port_id", F.year("activity_date").alias("year")).agg(F.sum("portcalls").alias("calls"), F.sum("import_total").alias("imports"), F.count("*").alias("days"))


@query("yearly_changes", with_views("SELECT a.port_id, a.year, ln((a.calls + 1.0) / (b.calls + 1.0)) - quantile_cont(ln((a.calls + 1.0) / (b.calls + 1.0)), 0.5) OVER (PARTITION BY a.year) AS change FROM sw a JOIN sw b ON b.port_id = a.port_id AND b.year = a.year - 1", ACTIVITY, "sw AS (" + ORACLE_SQL["season_windows"][ORACLE_SQL["season_windows"].index("SELECT port_id, CAST(extract(year FROM activity_date)") :] + ")"))
def yearly_changes(spark: SparkSession, sf: str) -> DataFrame:
    s = season_windows(spark, sf)
    before = s.select("port_id", (F.col("year") + 1).alias("year"), F.col("calls").alias("before"))
    out = s.join(before, ["port_id", "year"]).withColumn("lr", F.log((F.col("calls") + 1.0) / (F.col("before") + 1.0)))
    return out.select("port_id", "year", (F.col("lr") - F.percentile("lr", F.lit(0.5)).over(Window.partitionBy("year"))).alias("change"))


@query("top_us_ports", with_views("SELECT port_id, imports, rank FROM (SELECT *, row_number() OVER (ORDER BY imports DESC, port_id) AS rank FROM (SELECT port_id, sum(import_total) AS imports FROM v_activity WHERE extract(year FROM activity_date) = (SELECT extract(year FROM max(activity_date)) FROM v_activity) GROUP BY 1)) WHERE rank <= 15", ACTIVITY))
def top_us_ports(spark: SparkSession, sf: str) -> DataFrame:
    a = v.activity(spark, sf)
    last = a.agg(F.year(F.max("activity_date")).alias("last"))
    recent = a.crossJoin(F.broadcast(last)).where("year(activity_date) = last").groupBy("port_id").agg(F.sum("import_total").alias("imports"))
    return top_per_group(recent.withColumn("all", F.lit(1)), ["all"], [F.desc("imports"), F.asc("port_id")], 15).drop("all")
