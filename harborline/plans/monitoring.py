"""Monitoring and audit queries, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import keyed
from ..operators import monitoring as mo
from . import views as v
from .views import POSITIONS, RUNS, TRANSITS, with_views

QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


COLUMNS = ["imo", "destination", "latitude", "sog"]
NULLS = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS total_rows, (count(*) - count({c})) / count(*) AS null_rate FROM {{t}} HAVING count(*) > count({c})" for c in COLUMNS)


@query("table_quality", with_views(NULLS.format(t="v_positions"), POSITIONS))
def table_quality(spark: SparkSession, sf: str) -> DataFrame:
    return mo.null_rates(v.positions(spark, sf).select(*COLUMNS))


@query("quality_thresholds", with_views(f"SELECT * FROM ({NULLS.format(t='v_positions')}) WHERE null_rate > 0.15", POSITIONS))
def quality_thresholds(spark: SparkSession, sf: str) -> DataFrame:
    return table_quality(spark, sf).where("null_rate > 0.15")


CALLS = "pcalls AS (SELECT CASE WHEN event_id % 13 <> 0 THEN source END AS source, destination, sog FROM v_positions)"
CALL_COLUMNS = ["source", "destination", "sog"]


def _nulls_of(name: str, table: str, columns: list[str]) -> str:
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, (count(*) - count({c})) / count(*) AS null_rate FROM {table} HAVING count(*) > count({c})" for c in columns)


@query("quality_report", with_views(f"SELECT * FROM ({_nulls_of('positions', 'v_positions', COLUMNS)} UNION ALL {_nulls_of('port_calls', 'pcalls', CALL_COLUMNS)}) UNION ALL SELECT 'all tables', NULL, (SELECT count(*) FROM v_positions) + (SELECT count(*) FROM pcalls) + (SELECT count(*) FROM orders), NULL", POSITIONS, CALLS))
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Null rates of every table, one scan each, and the rows of all."""
    p = v.positions(spark, sf)
    calls = p.select(F.when(F.col("event_id") % 13 != 0, F.col("source")).alias("source"), "destination", "sog")
    tables = {"positions": p.select(*COLUMNS), "port_calls": calls, "orders": v.table(spark, sf, "orders")}
    rates = [mo.null_rates(df).select(F.lit(name).alias("table_name"), "column_name", "total_rows", "null_rate") for name, df in tables.items()]
    counts = [df.agg(F.count("*").alias("n")) for df in tables.values()]
    total = counts[0].union(counts[1]).union(counts[2]).agg(F.sum("n").alias("total_rows")).select(F.lit("all tables").alias("table_name"), "total_rows")
    return rates[0].union(rates[1]).union(rates[2]).unionByName(total, allowMissingColumns=True)


@query("overview_counts", "SELECT 'orders' AS table_name, count(*) AS n FROM orders UNION ALL SELECT 'events', count(*) FROM events UNION ALL SELECT 'customer', count(*) FROM customer")
def overview_counts(spark: SparkSession, sf: str) -> DataFrame:
    one = lambda t: v.table(spark, sf, t).agg(F.count("*").alias("n")).select(F.lit(t).alias("table_name"), "n")
    return one("orders").union(one("events")).union(one("customer"))


def as_of():  # noqa: ANN201
    """The time that checks judge at."""
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


AGE = "(epoch(TIMESTAMP '2024-02-01') - floor(epoch(max({c})))) / 3600"


@query("stale_partitions", with_views("SELECT source, max(partition_date) AS newest, CAST(epoch(TIMESTAMP '2024-02-01') - epoch(CAST(max(partition_date) AS TIMESTAMP)) AS DOUBLE) / 3600 AS hours_old FROM v_positions WHERE event_id % 17 <> 3 OR source <> 'beta' GROUP BY 1 HAVING max(partition_date) < DATE '2024-02-01'", POSITIONS))
def stale_partitions(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf).where("event_id % 17 <> 3 OR source <> 'beta'")
    return mo.stale_sources(p, "source", "partition_date", as_of(), {}, 0.0).drop("limit_hours")


@query("stale_source_alerts", with_views(f"SELECT source, max(collection_ts) AS newest, {AGE.format(c='collection_ts')} AS hours_old, CASE WHEN source = 'click' THEN 40.0 ELSE 2.0 END AS limit_hours FROM v_runs WHERE status = 'success' GROUP BY 1 HAVING {AGE.format(c='collection_ts')} > CASE WHEN source = 'click' THEN 40.0 ELSE 2.0 END", RUNS))
def stale_source_alerts(spark: SparkSession, sf: str) -> DataFrame:
    return mo.stale_sources(v.runs(spark, sf).where("status = 'success'"), "source", "collection_ts", as_of(), {"click": 40.0}, 2.0)


SLA = "sla AS (SELECT * FROM (VALUES ('click', 1.0), ('view', 0.5), ('error', 2.0), ('absent', 49.0), ('signup', 1000.0)) t(source, sla_hours))"


@query("freshness_sla", with_views(f"SELECT source, sla_hours, newest, hours_old, CASE WHEN newest IS NOT NULL THEN 100 * (hours_old / sla_hours - 1) END AS pct_over, CASE WHEN newest IS NULL OR hours_old / sla_hours > 2 THEN 'critical' WHEN hours_old / sla_hours > 1.5 THEN 'high' ELSE 'medium' END AS severity FROM sla LEFT JOIN (SELECT source, max(collection_ts) AS newest, {AGE.format(c='collection_ts')} AS hours_old FROM v_runs GROUP BY 1) r USING (source) WHERE newest IS NULL OR hours_old > sla_hours", RUNS, SLA))
def freshness_sla(spark: SparkSession, sf: str) -> DataFrame:
    slas = spark.createDataFrame([("click", 1.0), ("view", 0.5), ("error", 2.0), ("absent", 49.0), ("signup", 1000.0)], "source string, sla_hours double")
    return mo.freshness_sla(v.runs(spark, sf), slas, "source", "collection_ts", as_of())


@query("volume_anomaly", with_views("""SELECT source, run_id, rows_written, n, z, CASE WHEN abs(z) > 3 THEN 'high' ELSE 'medium' END AS severity FROM (SELECT *, count(rows_written) OVER w AS n,
 CASE WHEN count(rows_written) OVER w >= 5 AND stddev_pop(rows_written) OVER w > 0 THEN (rows_written - avg(rows_written) OVER w) / stddev_pop(rows_written) OVER w END AS z FROM v_runs WINDOW w AS (PARTITION BY source ORDER BY collection_ts, run_id ROWS 29 PRECEDING)) WHERE abs(z) > 1.6""", RUNS))
def volume_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return mo.volume_anomalies(v.runs(spark, sf), "source", ["collection_ts", "run_id"], "rows_written", alert=1.6).select("source", "run_id", "rows_written", "n", "z", "severity")


@query("duration_anomaly", with_views("SELECT source, run_id, duration_ms, z FROM (SELECT *, CASE WHEN stddev_pop(duration_ms) OVER w > 0 THEN (duration_ms - avg(duration_ms) OVER w) / stddev_pop(duration_ms) OVER w END AS z FROM v_runs WINDOW w AS (PARTITION BY source ORDER BY collection_ts, run_id ROWS UNBOUNDED PRECEDING)) WHERE z > 2", RUNS))
def duration_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    return mo.duration_anomalies(v.runs(spark, sf), "source", ["collection_ts", "run_id"], "duration_ms").select("source", "run_id", "duration_ms", "z")


@query("row_drop_alerts", with_views("SELECT source, c.n AS rows, b.n AS rows_before, 1 - c.n / b.n AS lost_share FROM (SELECT source, count(*) AS n FROM v_runs WHERE rows_written % 2 = 0 OR source = 'click' GROUP BY 1) c JOIN (SELECT source, count(*) AS n FROM v_runs GROUP BY 1) b USING (source) WHERE c.n < b.n * 0.99", RUNS))
def row_drop_alerts(spark: SparkSession, sf: str) -> DataFrame:
    r = v.runs(spark, sf)
    count = lambda df: df.groupBy("source").agg(F.count("*").alias("rows"))
    return mo.row_drops(count(r.where("rows_written % 2 = 0 OR source = 'click'")), count(r), "source")


SPIKES = " UNION ALL ".join(f"SELECT source, '{c}' AS column_name, count(*) FILTER (WHERE NOT f AND {c} IS NULL) / count(*) FILTER (WHERE NOT f) AS old_rate, count(*) FILTER (WHERE f AND {c} IS NULL) / count(*) FILTER (WHERE f) AS new_rate FROM sp GROUP BY 1 HAVING count(*) FILTER (WHERE f) >= 50 AND count(*) FILTER (WHERE NOT f) >= 50" for c in ("imo", "sog"))
SPIKED = "sp AS (SELECT source, timestamp >= TIMESTAMP '2024-01-20' AS f, imo, CASE WHEN NOT (timestamp >= TIMESTAMP '2024-01-20' AND event_id % 2 = 0) THEN sog END AS sog FROM v_positions)"


@query("null_spike_alerts", with_views(f"SELECT * FROM ({SPIKES}) WHERE new_rate - old_rate >= 0.25", POSITIONS, SPIKED))
def null_spike_alerts(spark: SparkSession, sf: str) -> DataFrame:
    new = F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz")
    p = v.positions(spark, sf).withColumn("sog", F.when(~(new & (F.col("event_id") % 2 == 0)), F.col("sog")))
    return mo.null_spikes(p, "source", new, ["imo", "sog"])


@query("run_alerts", with_views(f"SELECT source, 'stale' AS kind FROM ({ORACLE_SQL['stale_source_alerts'].partition('SELECT source, max(collection_ts)')[1]}{ORACLE_SQL['stale_source_alerts'].partition('SELECT source, max(collection_ts)')[2]}) UNION ALL SELECT source, 'rows' FROM ({ORACLE_SQL['row_drop_alerts'][ORACLE_SQL['row_drop_alerts'].index('SELECT source, c.n'):]}) UNION ALL SELECT source, 'nulls' FROM ({SPIKES}) WHERE new_rate - old_rate >= 0.25", RUNS, POSITIONS, SPIKED))
def run_alerts(spark: SparkSession, sf: str) -> DataFrame:
    stale = stale_source_alerts(spark, sf).select("source", F.lit("stale").alias("kind"))
    spikes = null_spike_alerts(spark, sf).select("source", F.lit("nulls").alias("kind"))
    return stale.unionByName(row_drop_alerts(spark, sf).select("source", F.lit("rows").alias("kind"))).unionByName(spikes)


@query("schema_drift", "SELECT 'o_orderdate' AS column_name, 'unexpected' AS problem, count(o_orderdate) AS filled FROM orders UNION ALL SELECT 'o_clerk', 'missing', 0")
def schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Columns that are not in the table's specification, with the rows that fill them, and those that are absent."""
    return mo.schema_drift(v.table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_clerk"])


@query("source_status", with_views("SELECT source, max(collection_ts) AS last_run, max(collection_ts) FILTER (WHERE status = 'success') AS last_success, count(*) FILTER (WHERE status = 'success') AS successes, count(*) FILTER (WHERE status <> 'success') AS errors FROM v_runs GROUP BY 1", RUNS))
def source_status(spark: SparkSession, sf: str) -> DataFrame:
    return mo.source_status(v.runs(spark, sf), "source", "collection_ts")


@query("last_success", with_views("SELECT source, max(collection_ts) AS last_success, arg_max(run_id, (collection_ts, run_id)) AS run_id FROM v_runs WHERE status = 'success' GROUP BY 1", RUNS))
def last_success(spark: SparkSession, sf: str) -> DataFrame:
    ok = v.runs(spark, sf).where("status = 'success'")
    return ok.groupBy("source").agg(F.max("collection_ts").alias("last_success"), F.max_by("run_id", F.struct("collection_ts", "run_id")).alias("run_id"))


@query("source_history", with_views("SELECT source, run_id, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY collection_ts DESC, run_id DESC) AS rank FROM v_runs) WHERE rank <= 10", RUNS))
def source_history(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.top_per_group(v.runs(spark, sf), ["source"], [F.desc("collection_ts"), F.desc("run_id")], 10).select("source", "run_id", "rank")


QUERIES["lineage_query"] = lambda spark, sf: source_history(spark, sf).where("source = 'click'")
ORACLE_SQL["lineage_query"] = ORACLE_SQL["source_history"] + " AND source = 'click'"


@query("lineage_summary", with_views("SELECT source, status, count(*) AS runs, CAST(sum(rows_written) AS BIGINT) AS rows, min(collection_ts) AS first_run, max(collection_ts) AS last_run FROM v_runs GROUP BY 1, 2", RUNS))
def lineage_summary(spark: SparkSession, sf: str) -> DataFrame:
    return v.runs(spark, sf).groupBy("source", "status").agg(F.count("*").alias("runs"), F.sum("rows_written").alias("rows"), F.min("collection_ts").alias("first_run"), F.max("collection_ts").alias("last_run"))


@query("lineage_record", with_views("SELECT run_id, substr(sha256('{\"rows\":' || CAST(rows_written AS VARCHAR) || ',\"source\":\"' || source || '\"}'), 1, 16) AS config_hash FROM v_runs", RUNS))
def lineage_record(spark: SparkSession, sf: str) -> DataFrame:
    config = F.to_json(F.struct(F.col("rows_written").alias("rows"), "source"))
    return v.runs(spark, sf).select("run_id", F.substring(F.sha2(config, 256), 1, 16).alias("config_hash"))


@query("source_consistency", with_views("SELECT CAST(partition_date AS DATE) AS day, count(*) FILTER (WHERE source = 'alpha') AS alpha, count(*) FILTER (WHERE source = 'beta') AS beta, (count(*) FILTER (WHERE source = 'alpha') > 0) = (count(*) FILTER (WHERE source = 'beta') > 0) AS both_or_neither FROM v_positions WHERE sog < 1 GROUP BY 1", POSITIONS))
def source_consistency(spark: SparkSession, sf: str) -> DataFrame:
    out = v.positions(spark, sf).where("sog < 1").groupBy(F.col("partition_date").alias("day")).pivot("source", ["alpha", "beta"]).agg(F.count("sog"))
    out = out.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("alpha", "beta")})
    return out.withColumn("both_or_neither", (F.col("alpha") > 0) == (F.col("beta") > 0))


@query("key_uniqueness", with_views("SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT mmsi, partition_date FROM v_positions)) AS keys FROM v_positions", POSITIONS))
def key_uniqueness(spark: SparkSession, sf: str) -> DataFrame:
    return v.positions(spark, sf).agg(F.count("*").alias("rows"), F.count_distinct(F.struct("mmsi", "partition_date")).alias("keys"))


@query("source_coverage", with_views("SELECT source, count(*) AS rows, count(imo) AS imo, count(destination) AS destination FROM v_positions GROUP BY 1", POSITIONS))
def source_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return v.positions(spark, sf).groupBy("source").agg(F.count("*").alias("rows"), F.count("imo").alias("imo"), F.count("destination").alias("destination"))


@query("freshness_table", "SELECT 'orders' AS table_name, min(CAST(o_orderdate AS DATE)) AS first_day, max(CAST(o_orderdate AS DATE)) AS last_day, DATE '2024-02-01' - max(CAST(o_orderdate AS DATE)) AS days_since FROM orders UNION ALL SELECT 'lineitem', min(CAST(l_shipdate AS DATE)), max(CAST(l_shipdate AS DATE)), DATE '2024-02-01' - max(CAST(l_shipdate AS DATE)) FROM lineitem")
def freshness_table(spark: SparkSession, sf: str) -> DataFrame:
    def one(t: str, c: str) -> DataFrame:
        d = v.table(spark, sf, t).agg(F.min(F.to_date(c)).alias("first_day"), F.max(F.to_date(c)).alias("last_day"))
        return d.select(F.lit(t).alias("table_name"), "first_day", "last_day", F.datediff(F.lit("2024-02-01").cast("date"), "last_day").cast("long").alias("days_since"))

    return one("orders", "o_orderdate").union(one("lineitem", "l_shipdate"))


@query("dash_chokepoints", with_views("SELECT t.chokepoint_id, t.transit_date, t.n_total, s.lifetime FROM v_transits t JOIN (SELECT chokepoint_id, CAST(sum(n_total) AS BIGINT) AS lifetime FROM v_transits GROUP BY 1) s USING (chokepoint_id) WHERE t.transit_date > (SELECT max(transit_date) FROM v_transits) - 30", TRANSITS))
def dash_chokepoints(spark: SparkSession, sf: str) -> DataFrame:
    t = v.transits(spark, sf)
    total = t.groupBy("chokepoint_id").agg(F.sum("n_total").alias("lifetime"))
    last = t.agg(F.max("transit_date").alias("last"))
    return t.crossJoin(F.broadcast(last)).where("transit_date > date_sub(last, 30)").join(total, "chokepoint_id").select("chokepoint_id", "transit_date", "n_total", "lifetime")


def _cooldown(key, frame):  # noqa: ANN001, ANN202
    """Alerts that fire: none within a day of the last one that did."""
    frame = frame.sort_values(["collection_ts", "run_id"])
    keep, last = [], None
    for t in frame["collection_ts"]:
        fire = last is None or (t - last).total_seconds() >= 86_400
        keep.append(fire)
        last = t if fire else last
    return frame[keep]


SLOW = """slow AS (SELECT source, run_id, collection_ts, row_number() OVER (PARTITION BY source ORDER BY collection_ts, run_id) AS i FROM (SELECT *, CASE WHEN stddev_pop(duration_ms) OVER w > 0 THEN (duration_ms - avg(duration_ms) OVER w) / stddev_pop(duration_ms) OVER w END AS z
  FROM v_runs WINDOW w AS (PARTITION BY source ORDER BY collection_ts, run_id ROWS UNBOUNDED PRECEDING)) WHERE z > 2),
fired AS (SELECT source, i FROM slow WHERE i = 1 UNION ALL SELECT source, n FROM (SELECT f.source, (SELECT min(s.i) FROM slow s WHERE s.source = f.source AND s.collection_ts >= (SELECT collection_ts FROM slow o WHERE o.source = f.source AND o.i = f.i) + INTERVAL 1 DAY) AS n FROM fired f) WHERE n IS NOT NULL)"""


@query("alert_cooldown", with_views(" SELECT source, run_id, collection_ts FROM slow JOIN fired USING (source, i)", RUNS, SLOW).replace("WITH", "WITH RECURSIVE", 1))
def alert_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    """Sequential by nature: whether an alert fires depends on the last that did, as long as alerts are less than a day apart.

    A gap of a day starts anew, so groups are a source's alerts between two such gaps;
    the windows run over a source's own runs, a row for each time it was collected.
    """
    alerts = duration_anomaly(spark, sf).join(v.runs(spark, sf).select("run_id", "collection_ts"), "run_id").select("source", "run_id", "collection_ts")
    gap = F.expr("collection_ts - lag(collection_ts) OVER (PARTITION BY source ORDER BY collection_ts, run_id) >= INTERVAL 1 DAY")
    alerts = alerts.withColumn("gap", F.coalesce(gap, F.lit(True)).cast("int"))
    alerts = alerts.withColumn("stretch", F.expr("sum(gap) OVER (PARTITION BY source ORDER BY collection_ts, run_id)")).drop("gap")
    return alerts.groupBy("source", "stretch").applyInPandas(_cooldown, alerts.schema).drop("stretch")
