"""Table writes, snapshots, revisions, stored inventories and page tables, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import pct_change, safe_ratio
from ..operators import keyed
from . import explore as ex
from . import panels as pl
from . import vessels as ve
from . import views as v
from .streams import shared
from .views import ACTIVITY, POSITIONS, PROFILES, TRANSITS, VESSELS, as_cte, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()

# --- writes


@query("append_rows", "SELECT event_id, user_id, value FROM events UNION ALL SELECT event_id, user_id, value FROM events WHERE event_id % 10 = 0")
def append_rows(spark: SparkSession, sf: str) -> DataFrame:
    """A table without a key: a second batch is added to the first."""
    e = v.table(spark, sf, "events").select("event_id", "user_id", "value")
    path = shared(spark)
    e.write.parquet(path)
    e.where("event_id % 10 = 0").write.mode("append").parquet(path)
    return spark.read.schema(e.schema).parquet(path)


@query("pk_replace", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-02-01' ELSE TIMESTAMP '2024-01-01' END AS ingested_at FROM customer")
def pk_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the batch replace those of the same key, and are stamped anew."""
    at = lambda df, day: df.withColumn("ingested_at", F.lit(day).cast("timestamp_ntz"))
    stored = v.table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    batch = stored.where("c_custkey % 4 = 0").withColumn("c_acctbal", F.col("c_acctbal") + 1)
    return keyed.upsert(at(stored, "2024-01-01"), at(batch, "2024-02-01"), ["c_custkey"])


@query("write_curated", with_views("SELECT 'curated_vessels' AS table_name, count(*) AS rows FROM reg", VESSELS, ve.REGISTER))
def write_curated(spark: SparkSession, sf: str) -> DataFrame:
    """Replaces a curated table and counts what it wrote on the way, without a second scan."""
    path, seen = f"{shared(spark)}/curated_vessels", Observation()
    for df in (ve.register(spark, sf).limit(0), ve.register(spark, sf)):
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    written = spark.read.parquet(path).agg(F.count("*").alias("stored"))
    return written.where(F.col("stored") == seen.get["rows"]).select(F.lit("curated_vessels").alias("table_name"), F.lit(seen.get["rows"]).cast("long").alias("rows"))


SNAPSHOT = ["orders", "customer", "events", "region"]


@query("export_snapshot")
def export_snapshot(spark: SparkSession, sf: str) -> DataFrame:
    """(table_name, rows, bytes) of a Parquet copy of every table that has rows; the sizes are those of the files."""
    path, out = shared(spark), []
    for name in SNAPSHOT:
        df = v.table(spark, sf, name)
        if not df.isEmpty():
            df.write.option("compression", "zstd").parquet(f"{path}/{name}")
            files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{path}/{name}").agg(F.sum("length").alias("bytes"))
            out.append(spark.read.parquet(f"{path}/{name}").agg(F.count("*").alias("rows")).crossJoin(files).select(F.lit(name).alias("table_name"), "rows", "bytes"))  # a row and a row
    first, *rest = out
    for df in rest:
        first = first.unionByName(df)
    return first


@query("seed_missing", "SELECT 'nation' AS table_name, count(*) AS rows, 0 AS new_rows FROM nation UNION ALL SELECT 'orders', count(*), count(*) FROM orders")
def seed_missing(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot goes into empty tables only, on the columns that both have."""
    nation, orders = v.table(spark, sf, "nation"), v.table(spark, sf, "orders")
    tables = {"nation": (nation, nation), "orders": (orders.select("o_orderkey", "o_orderstatus", F.lit("").alias("o_clerk")).limit(0), orders)}
    out = []
    for name, (stored, snapshot) in tables.items():
        fresh = keyed.project_to_schema(snapshot, stored.schema) if stored.isEmpty() else stored.limit(0)
        count = lambda df: df.agg(F.count("*").alias("n"))
        out.append(count(stored.unionByName(fresh)).withColumnRenamed("n", "rows").crossJoin(count(fresh).withColumnRenamed("n", "new_rows")).select(F.lit(name).alias("table_name"), "rows", "new_rows"))
    return out[0].unionByName(out[1])


LABELS = [(1_000, "n<1K"), (10_000, "1K<n<10K"), (100_000, "10K<n<100K"), (1_000_000, "100K<n<1M"), (10_000_000, "1M<n<10M"), (100_000_000, "10M<n<100M")]
LAST_LABEL = "100M<n<1B"


def size_label(n: Column) -> Column:
    """Rows as one of seven bands."""
    out = F.lit(LAST_LABEL)
    for below, name in reversed(LABELS):
        out = F.when(n < below, name).otherwise(out)
    return out


@query("size_bucket", "SELECT source, n, CASE " + " ".join(f"WHEN n < {b} THEN '{name}'" for b, name in LABELS) + f" ELSE '{LAST_LABEL}' END AS size FROM (SELECT event_type AS source, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'lineitem squared', count(*) * count(*) FROM lineitem)")
def size_bucket(spark: SparkSession, sf: str) -> DataFrame:
    lines = v.table(spark, sf, "lineitem").agg(F.count("*").alias("n"))
    every = v.table(spark, sf, "events").groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("n")).unionByName(lines.select(F.lit("lineitem").alias("source"), "n")).unionByName(lines.select(F.lit("lineitem squared").alias("source"), (F.col("n") * F.col("n")).alias("n")))
    return every.withColumn("size", size_label(F.col("n")))


@query("revision_window", with_views("SELECT chokepoint_id, transit_date, CASE WHEN transit_date > (SELECT max(transit_date) FROM v_transits) - 30 THEN n_total + 1 ELSE n_total END AS n_total FROM v_transits", TRANSITS))
def revision_window(spark: SparkSession, sf: str) -> DataFrame:
    """The last thirty days are read again, revised, and upserted."""
    t = v.transits(spark, sf).select("chokepoint_id", "transit_date", "n_total")
    last = t.agg(F.max("transit_date").alias("last"))
    batch = t.crossJoin(F.broadcast(last)).where("transit_date > date_sub(last, 30)").select("chokepoint_id", "transit_date", (F.col("n_total") + 1).alias("n_total"))
    return keyed.upsert(t, batch, ["chokepoint_id", "transit_date"])


@query("first_vintage_only", "SELECT o_orderkey, report_number, release_date FROM (SELECT o_orderkey, o_custkey AS report_number, CAST(o_orderdate AS DATE) AS release_date, min(CAST(o_orderdate AS DATE)) OVER (PARTITION BY o_custkey) AS first_date FROM orders) WHERE release_date = first_date")
def first_vintage_only(spark: SparkSession, sf: str) -> DataFrame:
    """A report number that was released before is skipped."""
    o = v.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("report_number"), F.to_date("o_orderdate").alias("release_date"))
    first = F.min("release_date").over(Window.partitionBy("report_number"))
    return o.withColumn("first_date", first).where("release_date = first_date").drop("first_date")


@query("merge_columns", "SELECT o_orderkey, o_totalprice, NULL AS o_orderstatus FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 2 = 1")
def merge_columns(spark: SparkSession, sf: str) -> DataFrame:
    """Files of the old schema and of a wider one, read as one table."""
    o, path = v.table(spark, sf, "orders"), shared(spark)
    o.where("o_orderkey % 2 = 0").select("o_orderkey", "o_totalprice").write.parquet(f"{path}/version=1")
    o.where("o_orderkey % 2 = 1").select("o_orderkey", "o_totalprice", "o_orderstatus").write.parquet(f"{path}/version=2")
    return spark.read.option("mergeSchema", True).parquet(path).drop("version")


@query("table_inventory")
def table_inventory(spark: SparkSession, sf: str) -> DataFrame:
    """Files and rows of the larger tables."""
    one = lambda t: v.table(spark, sf, t).select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes")).groupBy("file", "bytes").agg(F.count("*").alias("rows")).withColumns({"table_name": F.lit(t), "n_columns": F.lit(len(v.table(spark, sf, t).columns))})
    return one("orders").unionByName(one("lineitem")).unionByName(one("events"))


@query("sample_describe")
def sample_describe(spark: SparkSession, sf: str) -> DataFrame:
    """Describes a random tenth of the order lines; which rows these are depends on the seed and the files."""
    return v.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_discount").sample(0.1, seed=3).summary("count", "mean", "stddev", "min", "25%", "50%", "75%", "max")


# --- runs of many steps


@query("curation_run")
def curation_run(spark: SparkSession, sf: str) -> DataFrame:
    """Every step of curation with the rows it left; a step that fails is a row with its error, and the others go on."""
    def broken(s: SparkSession, d: str) -> DataFrame:
        return v.positions(s, d).select("no_such_column")

    steps = {"dedup": ve.QUERIES["dedup_last"], "clean": ve.QUERIES["clean_sentinels"], "validate": ve.QUERIES["validation_report"], "enrich_positions": ve.QUERIES["curated_positions"], "enrich_vessels": ve.QUERIES["curated_vessels"], "broken": broken}
    return run_steps(spark, sf, steps)


def run_steps(spark: SparkSession, sf: str, steps: dict) -> DataFrame:
    from pyspark.errors import PySparkException

    out = []
    for name, step in steps.items():
        try:
            out.append((name, step(spark, sf).count(), None))
        except PySparkException as e:
            out.append((name, None, type(e).__name__))
    return spark.createDataFrame(out, "step string, rows long, error string")


@query("rebuild_available")
def rebuild_available(spark: SparkSession, sf: str) -> DataFrame:
    """Builds the panels whose tables are there, and counts them."""
    from pyspark.errors import AnalysisException

    needs = {"port_weekly": ["lineitem", "supplier"], "chokepoint_7d": ["orders"], "trade_monthly": ["lineitem", "part"], "export_pace": ["lineitem", "part", "orders", "customer"], "not_landed": ["carriers"]}
    steps = pl.QUERIES | ex.QUERIES

    def there(name: str) -> bool:
        try:
            v.table(spark, sf, name)
        except AnalysisException:
            return False
        return True

    return run_steps(spark, sf, {k: steps[k] for k, tables in needs.items() if all(map(there, tables))})


# --- exploration and pages


def spearman(df: DataFrame, a: str, b: str) -> DataFrame:
    """Rank correlation, ties at their mean rank; series are calendar-sized."""
    def ranked(c: str) -> Column:
        return F.rank().over(Window.orderBy(c)) + (F.count("*").over(Window.partitionBy(c)) - 1) / 2

    known = df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    return known.select("*", ranked(a).alias("_ra"), ranked(b).alias("_rb")).agg(F.corr(a, b).alias("pearson"), F.corr("_ra", "_rb").alias("spearman"), F.count("*").alias("n"))


JOINED = "jw AS (SELECT week_start, 100.0 * (p - lag(p) OVER o) / nullif(lag(p) OVER o, 0) AS a, 100.0 * (t - lag(t) OVER o) / nullif(lag(t) OVER o, 0) AS b FROM (SELECT g.week_start, g.portcalls AS p, w.t FROM gw g JOIN (SELECT CAST(date_trunc('week', transit_date) AS DATE) AS week_start, CAST(sum(n_total) AS BIGINT) AS t FROM v_transits GROUP BY 1 HAVING count(DISTINCT transit_date) = 7) w USING (week_start)) WINDOW o AS (ORDER BY week_start))"
RANKED = "SELECT corr(a, b) AS pearson, corr(ra, rb) AS spearman, count(*) AS n FROM (SELECT a, b, rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra, rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb FROM {t} WHERE a IS NOT NULL AND b IS NOT NULL)"


@query("weekly_join_corr", with_views(RANKED.format(t="jw"), ACTIVITY, pl.WEEKLY, ex.GLOBAL, TRANSITS, JOINED))
def weekly_join_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Weekly changes of port calls and of strait transits, correlated."""
    t = v.transits(spark, sf).groupBy(F.trunc("transit_date", "week").alias("week_start")).agg(F.sum("n_total").alias("t"), F.count_distinct("transit_date").alias("d")).where("d = 7")
    both = ex.global_weekly(spark, sf).select("week_start", F.col("portcalls").alias("p")).join(t, "week_start")
    o = Window.orderBy("week_start")  # a row per calendar week
    both = both.select("week_start", pct_change(F.col("p"), F.lag("p").over(o)).alias("a"), pct_change(F.col("t"), F.lag("t").over(o)).alias("b"))
    return spearman(both, "a", "b")


@query("nowcast_vs_actual", with_views("SELECT month, actual, ratio12, 100 * actual / b.a AS actual_index, 100 * ratio12 / b.r AS nowcast_index, 100.0 * (actual - lag(actual, 12) OVER o) / nullif(lag(actual, 12) OVER o, 0) AS actual_yoy, 100.0 * (ratio12 - lag(ratio12, 12) OVER o) / nullif(lag(ratio12, 12) OVER o, 0) AS nowcast_yoy FROM nc CROSS JOIN (SELECT avg(actual) AS a, avg(ratio12) AS r FROM nc WHERE extract(year FROM month) = 1997) b WINDOW o AS (ORDER BY month)", ACTIVITY, ex.NOWCAST))
def nowcast_vs_actual(spark: SparkSession, sf: str) -> DataFrame:
    """Both series rebased to 1997, and their changes over a year."""
    n = ex.nowcast_models(spark, sf).select("month", "actual", "ratio12")
    base = n.where("year(month) = 1997").agg(F.avg("actual").alias("a"), F.avg("ratio12").alias("r"))
    o = Window.orderBy("month")  # a row per month
    yoy = lambda c: pct_change(F.col(c), F.lag(c, 12).over(o))
    return n.crossJoin(F.broadcast(base)).select("month", "actual", "ratio12", (100 * F.col("actual") / F.col("a")).alias("actual_index"), (100 * F.col("ratio12") / F.col("r")).alias("nowcast_index"), yoy("actual").alias("actual_yoy"), yoy("ratio12").alias("nowcast_yoy"))


@query("monthly_teu", with_views("SELECT port_id, CAST(date_trunc('month', activity_date) AS DATE) AS month, sum(import_total) AS imports, sum(export_total) AS exports, (sum(import_total) - sum(export_total)) / nullif(sum(import_total) + sum(export_total), 0) AS imbalance FROM v_activity GROUP BY 1, 2", ACTIVITY))
def monthly_teu(spark: SparkSession, sf: str) -> DataFrame:
    m = v.activity(spark, sf).groupBy("port_id", F.trunc("activity_date", "month").alias("month")).agg(F.sum("import_total").alias("imports"), F.sum("export_total").alias("exports"))
    return m.withColumn("imbalance", safe_ratio(F.col("imports") - F.col("exports"), F.col("imports") + F.col("exports")))


@query("tracks_by_group", with_views("SELECT CAST(date_trunc('month', p.timestamp) AS DATE) AS month, coalesce(r.vessel_type, 'unknown') AS vessel_group, count(DISTINCT p.mmsi) AS vessels, count(*) AS tracks FROM v_positions p LEFT JOIN reg r ON r.imo = p.imo GROUP BY 1, 2", POSITIONS, VESSELS, ve.REGISTER))
def tracks_by_group(spark: SparkSession, sf: str) -> DataFrame:
    joined = v.positions(spark, sf).select("imo", "mmsi", "timestamp").join(ve.register(spark, sf).select("imo", "vessel_type"), "imo", "left")
    return joined.groupBy(F.trunc("timestamp", "month").alias("month"), F.coalesce("vessel_type", F.lit("unknown")).alias("vessel_group")).agg(F.count_distinct("mmsi").alias("vessels"), F.count("*").alias("tracks"))


PROXY = as_cte("px", ve.ORACLE_SQL["port_congestion_proxy"], "SELECT a.port_id, l.as_of")
BANDED = "bd AS (SELECT *, CASE WHEN baseline_avg < 0.5 THEN 'under 0.5' WHEN baseline_avg < 1 THEN '0.5 to 1' ELSE '1 and more' END AS band FROM px WHERE ratio_vs_baseline IS NOT NULL)"


@query("ratio_by_size", with_views("SELECT band, 'all' AS kind, NULL AS port_id, count(*) AS ports, min(ratio_vs_baseline) AS low, quantile_cont(ratio_vs_baseline, 0.5) AS middle, max(ratio_vs_baseline) AS high FROM bd GROUP BY 1 UNION ALL SELECT band, CASE WHEN r <= 5 THEN 'top' ELSE 'bottom' END, port_id, 1, ratio_vs_baseline, ratio_vs_baseline, ratio_vs_baseline FROM (SELECT *, row_number() OVER (ORDER BY ratio_vs_baseline DESC, port_id) AS r, row_number() OVER (ORDER BY ratio_vs_baseline, port_id) AS q FROM bd WHERE baseline_avg >= 0.3) WHERE r <= 5 OR q <= 5", ACTIVITY, PROXY, BANDED))
def ratio_by_size(spark: SparkSession, sf: str) -> DataFrame:
    """Congestion ratios by size of port, and the five highest and lowest of ports that are not tiny."""
    size, ratio = F.col("baseline_avg"), F.col("ratio_vs_baseline")
    p = ve.QUERIES["port_congestion_proxy"](spark, sf).where("ratio_vs_baseline IS NOT NULL").withColumn("band", F.when(size < 0.5, "under 0.5").when(size < 1, "0.5 to 1").otherwise("1 and more"))
    by = p.groupBy("band").agg(F.count("*").alias("ports"), F.min(ratio).alias("low"), F.percentile(ratio, F.lit(0.5)).alias("middle"), F.max(ratio).alias("high")).withColumns({"kind": F.lit("all"), "port_id": F.lit(None).cast("long")})
    big = p.where(size >= 0.3)
    ends = [big.orderBy(o, "port_id").limit(5).withColumn("kind", F.lit(k)) for o, k in ((ratio.desc(), "top"), (ratio.asc(), "bottom"))]
    ends[1] = ends[1].join(ends[0].select("port_id"), "port_id", "left_anti")
    each = [e.select("band", "kind", "port_id", F.lit(1).cast("long").alias("ports"), ratio.alias("low"), ratio.alias("middle"), ratio.alias("high")) for e in ends]
    return by.unionByName(each[0]).unionByName(each[1])


@query("weather_recent", "SELECT user_id AS location, avg(value) AS mean_value, max(value) AS max_value, count(*) AS readings FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 7 DAY GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 20")
def weather_recent(spark: SparkSession, sf: str) -> DataFrame:
    """The last seven days by location, the twenty with most readings."""
    e = v.table(spark, sf, "events")
    last = e.agg(F.max("ts").alias("last"))
    recent = e.crossJoin(F.broadcast(last)).where("ts >= last - INTERVAL 7 DAYS")
    out = recent.groupBy(F.col("user_id").alias("location")).agg(F.avg("value").alias("mean_value"), F.max("value").alias("max_value"), F.count("*").alias("readings"))
    return out.orderBy(F.desc("readings"), "location").limit(20)


@query("dash_ports", with_views("SELECT px.port_id, p.port_name, p.latitude, p.longitude, px.recent_avg, px.baseline_avg, px.ratio_vs_baseline FROM px JOIN v_profiles p USING (port_id) WHERE px.baseline_avg >= 0.3 AND p.latitude IS NOT NULL", ACTIVITY, PROFILES, PROXY))
def dash_ports(spark: SparkSession, sf: str) -> DataFrame:
    """Ports above a least size with their place."""
    p = v.profiles(spark, sf).where("latitude IS NOT NULL").select("port_id", "port_name", "latitude", "longitude")
    return ve.QUERIES["port_congestion_proxy"](spark, sf).where("baseline_avg >= 0.3").join(p, "port_id").select("port_id", "port_name", "latitude", "longitude", "recent_avg", "baseline_avg", "ratio_vs_baseline")


@query("dash_grain", with_views("SELECT c.commodity, c.my_week, c.commitments_mt AS this_season, p.commitments_mt AS prior_season, (SELECT CASE WHEN count(*) = 5 THEN avg(b.commitments_mt) END FROM cu b WHERE b.commodity = c.commodity AND b.my_week = c.my_week AND b.season BETWEEN c.season - 5 AND c.season - 1) AS mean_5 FROM cu c LEFT JOIN cu p ON p.commodity = c.commodity AND p.season = c.season - 1 AND p.my_week = c.my_week WHERE c.season = (SELECT max(season) FROM cu m WHERE m.commodity = c.commodity)", ex.SALES))
def dash_grain(spark: SparkSession, sf: str) -> DataFrame:
    """The newest season week by week beside the one before it and the mean of five, if all five are there."""
    s = ex.season_state(spark, sf)
    w = Window.partitionBy("commodity", "my_week").orderBy("season")
    past = w.rangeBetween(-5, -1)
    s = s.withColumns({"prior_season": F.sum("commitments_mt").over(w.rangeBetween(-1, -1)), "mean_5": F.when(F.count("*").over(past) == 5, F.avg("commitments_mt").over(past)), "newest": F.max("season").over(Window.partitionBy("commodity"))})
    return s.where("season = newest").select("commodity", "my_week", F.col("commitments_mt").alias("this_season"), "prior_season", "mean_5")
