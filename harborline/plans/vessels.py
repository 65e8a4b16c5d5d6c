"""Queries over positions, vessels and ports, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expr import haversine_km
from ..operators import curation as cu
from ..operators import keyed, spatial, temporal
from ..operators import positions as po
from . import views as v
from .views import POSITIONS, PRICES, PROFILES, HAZARDS, VESSELS, ACTIVITY, RUNS, with_views

EXEMPT = ["gamma"]
QUERIES, ORACLE_SQL = {}, {}


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


# --- scans and table writes


@query("read_filtered", with_views("SELECT event_id, mmsi, source, partition_date FROM v_positions WHERE partition_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-09' AND source = 'beta'", POSITIONS))
def read_filtered(spark: SparkSession, sf: str) -> DataFrame:
    df = v.positions(spark, sf).where(F.col("partition_date").between("2024-01-05", "2024-01-09") & (F.col("source") == "beta"))
    return df.select("event_id", "mmsi", "source", "partition_date")


@query("sql_query", "SELECT l_returnflag, count(*) AS n FROM lineitem WHERE l_quantity > 10 AND l_linestatus = 'O' GROUP BY 1")
def sql_query(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql("SELECT l_returnflag, count(*) AS n FROM {lines} WHERE l_quantity > :least AND l_linestatus = :status GROUP BY 1", {"least": 10, "status": "O"}, lines=v.table(spark, sf, "lineitem"))


@query("latest_timestamp", with_views("SELECT max(timestamp) AS latest FROM v_positions WHERE source = 'alpha'", POSITIONS))
def latest_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    return v.positions(spark, sf).where("source = 'alpha'").agg(F.max("timestamp").alias("latest"))


@query("list_sources")
def list_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and newest file of each source."""
    files = spark.read.parquet(f"{sf}/events.parquet").select("event_type", F.col("_metadata.file_modification_time").alias("at"))
    return files.groupBy(F.col("event_type").alias("source")).agg(F.count("*").alias("rows"), F.max("at").alias("newest_file"))


KEYS = ["imo", "mmsi"]


@query("upsert_keys", with_views("""
, b AS (SELECT imo, mmsi, vessel_name || ' NEW' AS vessel_name, vessel_type, CASE WHEN mmsi % 3 = 0 THEN 2 ELSE 1 END AS ingest_seq FROM ves1 WHERE mmsi % 2 = 0
  UNION ALL SELECT NULL, mmsi, vessel_name, vessel_type, 1 FROM ves1 WHERE mmsi <= 5),
s AS (SELECT imo, mmsi, vessel_name, vessel_type, 0 AS ingest_seq FROM ves1 UNION ALL SELECT NULL, mmsi, 'old', vessel_type, 0 FROM ves1 WHERE mmsi <= 9)
SELECT * FROM b UNION ALL SELECT * FROM s WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.imo IS NOT DISTINCT FROM s.imo AND b.mmsi IS NOT DISTINCT FROM s.mmsi)""", VESSELS))
def upsert_keys(spark: SparkSession, sf: str) -> DataFrame:
    one = v.vessels(spark, sf).where("ingest_seq = 1").select("imo", "mmsi", "vessel_name", "vessel_type")
    none = F.lit(None).cast("long").alias("imo")
    seq = F.lit(0).alias("ingest_seq")
    stored = one.select("*", seq).union(one.where("mmsi <= 9").select(none, "mmsi", F.lit("old"), "vessel_type", seq))
    batch = one.where("mmsi % 2 = 0").select("imo", "mmsi", F.concat("vessel_name", F.lit(" NEW")).alias("vessel_name"), "vessel_type", F.when(F.col("mmsi") % 3 == 0, 2).otherwise(1).alias("ingest_seq"))
    batch = batch.union(one.where("mmsi <= 5").select(none, "mmsi", "vessel_name", "vessel_type", F.lit(1)))
    return keyed.upsert(stored, batch, KEYS, "ingest_seq")


@query("dedup_batch_last", with_views("SELECT imo, mmsi, vessel_name, ingest_seq FROM (SELECT *, row_number() OVER (PARTITION BY imo ORDER BY ingest_seq DESC) AS n FROM v_vessels) WHERE n = 1", VESSELS))
def dedup_batch_last(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.keep_last(v.vessels(spark, sf), ["imo"], "ingest_seq").select("imo", "mmsi", "vessel_name", "ingest_seq")


QUERIES["dedup_last"] = QUERIES["latest_per_key"] = dedup_batch_last
ORACLE_SQL["dedup_last"] = ORACLE_SQL["latest_per_key"] = ORACLE_SQL["dedup_batch_last"]


@query("dedup_first", with_views("SELECT mmsi, imo, min(event_id) AS event_id FROM v_positions GROUP BY 1, 2", POSITIONS))
def dedup_first(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.keep_first(v.positions(spark, sf), ["mmsi", "imo"], "event_id").select("mmsi", "imo", "event_id")


@query("project_to_schema", "SELECT CAST(event_id AS BIGINT) AS event_id, CAST(NULL AS VARCHAR) AS absent, TRY_CAST(event_type AS DOUBLE) AS event_type, CAST(ts AS DATE) AS partition_date FROM (SELECT *, ts AS partition_date FROM events)")
def project_to_schema(spark: SparkSession, sf: str) -> DataFrame:
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("absent", T.StringType()), T.StructField("event_type", T.DoubleType()), T.StructField("partition_date", T.DateType())])
    return keyed.project_to_schema(v.table(spark, sf, "events").withColumn("partition_date", F.col("ts")), schema)


@query("rewrite_partitions", with_views("SELECT event_id, source, partition_date FROM v_positions WHERE (source, partition_date) IN (SELECT DISTINCT source, partition_date FROM v_positions WHERE event_id % 997 = 0)", POSITIONS))
def rewrite_partitions(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf).select("event_id", "source", "partition_date")
    return keyed.touched_partitions(p, p.where("event_id % 997 = 0"), ["source", "partition_date"])


@query("missing_partitions", with_views("SELECT DISTINCT date_trunc('month', activity_date)::DATE AS month FROM v_activity WHERE activity_date > DATE '1999-06-30' AND date_trunc('month', activity_date) NOT IN (SELECT date_trunc('month', transit_date) FROM v_transits WHERE extract(month FROM transit_date) % 2 = 0)", ACTIVITY, v.TRANSITS))
def missing_partitions(spark: SparkSession, sf: str) -> DataFrame:
    month = lambda c: F.trunc(c, "month").alias("month")
    published = v.activity(spark, sf).where("activity_date > '1999-06-30'").select(month("activity_date")).distinct()
    stored = v.transits(spark, sf).where("month(transit_date) % 2 = 0").select(month("transit_date")).distinct()
    return published.join(stored, "month", "left_anti")


@query("month_runs", """WITH m AS (SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS m FROM orders WHERE extract(month FROM o_orderdate) NOT IN (3, 8)),
r AS (SELECT m, extract(year FROM m) * 12 + extract(month FROM m) - row_number() OVER (ORDER BY m) AS run FROM m),
c AS (SELECT m, run, (row_number() OVER (PARTITION BY run ORDER BY m) - 1) // 3 AS chunk FROM r)
SELECT min(m) AS first_month, max(m) AS last_month, count(*) AS n_months FROM c GROUP BY run, chunk""")
def month_runs(spark: SparkSession, sf: str) -> DataFrame:
    months = v.table(spark, sf, "orders").select(F.trunc("o_orderdate", "month").alias("m")).where("month(m) NOT IN (3, 8)").distinct()
    return keyed.month_runs(months, "m", 3)


@query("backfill_units", "SELECT CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE) AS unit FROM (SELECT min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS b FROM orders)")
def backfill_units(spark: SparkSession, sf: str) -> DataFrame:
    ends = v.table(spark, sf, "orders").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    return ends.select(F.explode(F.expr("sequence(trunc(a, 'month'), b, interval 1 month)")).alias("unit"))


@query("anti_or_semi_keys", with_views("SELECT DISTINCT mmsi FROM v_positions WHERE mmsi NOT IN (SELECT mmsi FROM v_positions WHERE sog < 1 AND mmsi IS NOT NULL)", POSITIONS))
def anti_or_semi_keys(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf)
    return p.select("mmsi").distinct().join(p.where("sog < 1"), "mmsi", "left_anti")


# --- curation

CLEAN = """SELECT event_id, CASE WHEN latitude BETWEEN -90 AND 90 THEN latitude END AS latitude, CASE WHEN longitude BETWEEN -180 AND 180 THEN longitude END AS longitude,
 CASE WHEN sog BETWEEN 0 AND 102.2 THEN sog END AS sog, CASE WHEN cog >= 0 AND cog < 360 THEN cog END AS cog, CASE WHEN heading BETWEEN 0 AND 359 THEN heading END AS heading FROM v_positions"""


@query("clean_sentinels", with_views(CLEAN, POSITIONS))
def clean_sentinels(spark: SparkSession, sf: str) -> DataFrame:
    return cu.clean_sentinels(v.positions(spark, sf)).select("event_id", *cu.VALID)


UNKEYED = "(SELECT event_id, CASE WHEN mmsi % 5 <> 0 THEN mmsi END AS mmsi, timestamp, CASE WHEN event_id % 13 <> 0 THEN source END AS source FROM v_positions)"


def _unkeyed(spark: SparkSession, sf: str) -> DataFrame:
    return v.positions(spark, sf).withColumns({"mmsi": F.expr("CASE WHEN mmsi % 5 <> 0 THEN mmsi END"), "source": F.expr("CASE WHEN event_id % 13 <> 0 THEN source END")})


@query("clean_drop_unkeyed", with_views(f"SELECT event_id, mmsi, source FROM {UNKEYED} WHERE source IS NULL OR source = 'gamma' OR (mmsi IS NOT NULL AND timestamp IS NOT NULL)", POSITIONS))
def clean_drop_unkeyed(spark: SparkSession, sf: str) -> DataFrame:
    return cu.drop_unkeyed(_unkeyed(spark, sf), EXEMPT).select("event_id", "mmsi", "source")


@query("clean_count_changes", with_views("""SELECT count(*) FILTER (WHERE NOT latitude BETWEEN -90 AND 90) AS latitude_nulled, count(*) FILTER (WHERE NOT longitude BETWEEN -180 AND 180) AS longitude_nulled,
 count(*) FILTER (WHERE NOT sog BETWEEN 0 AND 102.2) AS sog_nulled, count(*) FILTER (WHERE cog < 0 OR cog >= 360) AS cog_nulled, count(*) FILTER (WHERE NOT heading BETWEEN 0 AND 359) AS heading_nulled,
 count(*) FILTER (WHERE source <> 'gamma' AND (mmsi % 5 = 0 OR timestamp IS NULL) AND event_id % 13 <> 0) AS rows_dropped FROM v_positions""", POSITIONS))
def clean_count_changes(spark: SparkSession, sf: str) -> DataFrame:
    return cu.count_changes(_unkeyed(spark, sf), EXEMPT)


@query("clean_port_coords", with_views("SELECT event_id, CASE WHEN latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 THEN latitude END AS latitude, CASE WHEN latitude BETWEEN -90 AND 90 AND longitude BETWEEN -180 AND 180 THEN longitude END AS longitude FROM v_positions", POSITIONS))
def clean_port_coords(spark: SparkSession, sf: str) -> DataFrame:
    return cu.clean_pairs(v.positions(spark, sf)).select("event_id", "latitude", "longitude")




@query("validation_report", with_views("""SELECT c.n AS "check", c.failed, c.total, c.failed = 0 AS passed FROM (
 SELECT 'imo_not_null' AS n, count(*) FILTER (WHERE imo IS NULL) AS failed, count(*) AS total FROM v_positions
 UNION ALL SELECT 'destination_not_null', count(*) FILTER (WHERE destination IS NULL AND source <> 'gamma'), count(*) FROM v_positions
 UNION ALL SELECT 'latitude_range', count(*) FILTER (WHERE latitude < -90 OR latitude > 90), count(*) FROM v_positions
 UNION ALL SELECT 'cog_range', count(*) FILTER (WHERE cog < 0 OR cog > 360), count(*) FROM v_positions
 UNION ALL SELECT 'sog_positive', count(*) FILTER (WHERE sog < 0), count(*) FROM v_positions) c""", POSITIONS))
def validation_report(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col
    return cu.validation_report(v.positions(spark, sf), {"imo_not_null": c("imo").isNull(), "destination_not_null": c("destination").isNull() & (c("source") != "gamma"), "latitude_range": (c("latitude") < -90) | (c("latitude") > 90), "cog_range": (c("cog") < 0) | (c("cog") > 360), "sog_positive": c("sog") < 0})


for _one in ("validate_not_null", "validate_range", "validate_positive"):
    _at = {"validate_not_null": "imo_not_null", "validate_range": "latitude_range", "validate_positive": "sog_positive"}[_one]
    QUERIES[_one] = lambda spark, sf, _at=_at: validation_report(spark, sf).where(F.col("check") == _at)
    ORACLE_SQL[_one] = ORACLE_SQL["validation_report"] + f" WHERE c.n = '{_at}'"

PORTS = """pts AS (SELECT s_suppkey // 4 AS unlocode, s_suppkey AS k, ['unlocode', 'digitraffic', 'other', 'other'][CAST(s_suppkey % 4 AS INT) + 1] AS source,
 CASE WHEN s_suppkey % 7 <> 0 THEN s_name END AS port_name, CASE WHEN s_suppkey % 3 <> 0 THEN s_nationkey END AS country,
 CASE WHEN s_suppkey % 9 <> 4 THEN CAST(s_suppkey AS DOUBLE) END AS latitude, CASE WHEN s_suppkey % 5 <> 0 THEN s_acctbal END AS longitude FROM supplier),
ranked AS (SELECT *, (CASE source WHEN 'unlocode' THEN 0 WHEN 'digitraffic' THEN 1 ELSE 2 END, k) AS place, latitude IS NOT NULL AND longitude IS NOT NULL AS located FROM pts)"""


@query("ports_by_code", with_views("""SELECT c.unlocode, n.port_name, o.country, p.latitude, p.longitude FROM (SELECT DISTINCT unlocode FROM pts) c
 LEFT JOIN ranked n ON n.unlocode = c.unlocode AND n.place = (SELECT min(place) FROM ranked x WHERE x.unlocode = c.unlocode AND x.port_name IS NOT NULL)
 LEFT JOIN ranked o ON o.unlocode = c.unlocode AND o.place = (SELECT min(place) FROM ranked x WHERE x.unlocode = c.unlocode AND x.country IS NOT NULL)
 LEFT JOIN ranked p ON p.unlocode = c.unlocode AND p.place = (SELECT min(place) FROM ranked x WHERE x.unlocode = c.unlocode AND x.located)""", PORTS))
def ports_by_code(spark: SparkSession, sf: str) -> DataFrame:
    """Every supplier is a row of a code; of two rows of one source the smaller key counts."""
    k = F.col("s_suppkey")
    unless = lambda c, x: F.when(~c, x)
    source = F.element_at(F.array(*map(F.lit, ("unlocode", "digitraffic", "other", "other"))), (k % 4 + 1).cast("int"))
    p = v.table(spark, sf, "supplier").select(F.floor(k / 4).alias("unlocode"), k.alias("k"), source.alias("source"), unless(k % 7 == 0, F.col("s_name")).alias("port_name"), unless(k % 3 == 0, F.col("s_nationkey")).alias("country"), unless(k % 9 == 4, k.cast("double")).alias("latitude"), unless(k % 5 == 0, F.col("s_acctbal")).alias("longitude"))
    rank = F.struct(F.when(F.col("source") == "unlocode", 0).when(F.col("source") == "digitraffic", 1).otherwise(2).alias("r"), F.col("k"))
    return cu.best_by_source(p, "unlocode", rank, ["port_name", "country"], ("latitude", "longitude"))


REGISTER = "reg AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY imo ORDER BY ingest_seq DESC) AS n FROM v_vessels) WHERE n = 1)"


def register(spark: SparkSession, sf: str) -> DataFrame:
    return keyed.keep_last(v.vessels(spark, sf), ["imo"], "ingest_seq")


@query("enrich_vessels", with_views("SELECT p.event_id, p.imo, r.vessel_type, r.year_built, r.gross_tonnage FROM v_positions p LEFT JOIN reg r ON r.imo = p.imo", POSITIONS, VESSELS, REGISTER))
def enrich_vessels(spark: SparkSession, sf: str) -> DataFrame:
    r = register(spark, sf).select("imo", "vessel_type", "year_built", "gross_tonnage")
    return v.positions(spark, sf).select("event_id", "imo").join(r, "imo", "left")


@query("curated_positions", with_views("SELECT p.event_id, p.imo, p.destination, r.vessel_type, r.year_built, length(p.destination) AS destination_country FROM v_positions p LEFT JOIN reg r ON r.imo = p.imo", POSITIONS, VESSELS, REGISTER))
def curated_positions(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf)
    ports = p.select("destination").where("destination IS NOT NULL").distinct().withColumn("destination_country", F.length("destination"))
    r = register(spark, sf).select("imo", "vessel_type", "year_built")
    return p.select("event_id", "imo", "destination").join(r, "imo", "left").join(ports, "destination", "left")


QUERIES["enrich_ports"] = lambda spark, sf: curated_positions(spark, sf).select("event_id", "destination", "destination_country")
ORACLE_SQL["enrich_ports"] = with_views("SELECT event_id, destination, length(destination) AS destination_country FROM v_positions", POSITIONS)


@query("curated_vessels", with_views("SELECT imo, vessel_name, year_built, 2024 - year_built AS vessel_age FROM reg", VESSELS, REGISTER))
def curated_vessels(spark: SparkSession, sf: str) -> DataFrame:
    return register(spark, sf).select("imo", "vessel_name", "year_built", (F.year(F.lit("2024-06-30").cast("date")) - F.col("year_built")).alias("vessel_age"))


@query("port_congestion_proxy", with_views("""SELECT a.port_id, l.as_of, avg(portcalls) FILTER (WHERE l.as_of - activity_date < 7) AS recent_avg, avg(portcalls) AS baseline_avg, count(portcalls) AS baseline_days,
 avg(portcalls) FILTER (WHERE l.as_of - activity_date < 7) / nullif(avg(portcalls), 0) AS ratio_vs_baseline
 FROM v_activity a JOIN (SELECT port_id, max(activity_date) AS as_of FROM v_activity GROUP BY 1) l ON l.port_id = a.port_id WHERE l.as_of - activity_date < 90 GROUP BY 1, 2""", ACTIVITY))
def port_congestion_proxy(spark: SparkSession, sf: str) -> DataFrame:
    return cu.congestion_proxy(v.activity(spark, sf), "port_id", "activity_date", "portcalls")


# --- positions

SECONDS = lambda a, b: f"(epoch_us({b}) - epoch_us({a})) / 1e6"


@query("port_activity_ais", with_views(f"""SELECT destination, count(DISTINCT imo) + max(CASE WHEN imo IS NULL THEN 1 ELSE 0 END) AS vessels, count(timestamp) AS reports, min(timestamp) AS first_seen, max(timestamp) AS last_seen,
 avg(sog) AS avg_sog, avg(draught) AS avg_draught, {SECONDS('min(timestamp)', 'max(timestamp)')} AS observed_seconds FROM v_positions WHERE destination IS NOT NULL GROUP BY 1""", POSITIONS))
def port_activity_ais(spark: SparkSession, sf: str) -> DataFrame:
    return po.by_destination(v.positions(spark, sf), "imo")


QUERIES["destination_summary"] = lambda spark, sf: port_activity_ais(spark, sf).drop("observed_seconds")
ORACLE_SQL["destination_summary"] = with_views("SELECT destination, count(DISTINCT imo) + max(CASE WHEN imo IS NULL THEN 1 ELSE 0 END) AS vessels, count(timestamp) AS reports, min(timestamp) AS first_seen, max(timestamp) AS last_seen, avg(sog) AS avg_sog, avg(draught) AS avg_draught FROM v_positions WHERE destination IS NOT NULL GROUP BY 1", POSITIONS)


@query("congestion_ratio", with_views("""SELECT destination, count(DISTINCT imo) FILTER (WHERE sog < 1) AS slow_vessels, count(DISTINCT imo) AS vessels, avg(sog) FILTER (WHERE sog < 1) AS avg_slow_sog,
 min(timestamp) FILTER (WHERE sog < 1) AS first_slow, max(timestamp) FILTER (WHERE sog < 1) AS last_slow, count(DISTINCT imo) FILTER (WHERE sog < 1) / count(DISTINCT imo) AS congestion_ratio
 FROM v_positions WHERE sog IS NOT NULL AND destination IS NOT NULL GROUP BY 1 HAVING count(DISTINCT imo) FILTER (WHERE sog < 1) > 0""", POSITIONS))
def congestion_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return po.congestion_ratio(v.positions(spark, sf), "imo")


@query("dwell_times", with_views(f"""SELECT imo, arg_min(vessel_name, (timestamp, event_id)) AS vessel_name, arg_min(coalesce(destination, ''), (timestamp, event_id)) AS d0, min(timestamp) AS start, max(timestamp) AS "end", count(*) AS reports, avg(sog) AS avg_sog, {SECONDS('min(timestamp)', 'max(timestamp)')} AS dwell_seconds
 FROM v_positions WHERE sog < 1 AND imo IS NOT NULL GROUP BY 1 HAVING count(*) >= 2""", POSITIONS))
def dwell_times(spark: SparkSession, sf: str) -> DataFrame:
    return po.dwell_times(v.positions(spark, sf), "imo").withColumn("d0", F.coalesce("destination", F.lit(""))).drop("destination")


@query("dwell_visits", with_views(f"""SELECT imo, min(timestamp) AS start, max(timestamp) AS "end", count(*) AS reports, {SECONDS('min(timestamp)', 'max(timestamp)')} AS dwell_seconds FROM (
 SELECT *, row_number() OVER (PARTITION BY imo ORDER BY timestamp, event_id) - row_number() OVER (PARTITION BY imo, sog < 20 ORDER BY timestamp, event_id) AS run FROM v_positions WHERE imo IS NOT NULL AND sog IS NOT NULL) WHERE sog < 20 GROUP BY imo, run""", POSITIONS))
def dwell_visits(spark: SparkSession, sf: str) -> DataFrame:
    return po.dwell_visits(v.positions(spark, sf), "imo", 20.0)


@query("vessel_tracks", with_views(f"""SELECT imo, arg_min(vessel_name, k) AS vessel_name, arg_min(latitude, k) AS start_lat, arg_min(longitude, k) AS start_lon, arg_max(latitude, k) AS end_lat, arg_max(longitude, k) AS end_lon, min(timestamp) AS start_time, max(timestamp) AS end_time,
 avg(sog) AS avg_sog, max(sog) AS max_sog, count(*) AS positions, nullif(arg_max(coalesce(destination, ''), k), '') AS last_destination, {SECONDS('min(timestamp)', 'max(timestamp)')} AS duration_seconds FROM (SELECT *, (timestamp, event_id) AS k FROM v_positions WHERE imo IS NOT NULL) GROUP BY 1""", POSITIONS))
def vessel_tracks(spark: SparkSession, sf: str) -> DataFrame:
    return po.vessel_tracks(v.positions(spark, sf), "imo")


QUERIES["active_vessels"] = lambda spark, sf: v.positions(spark, sf).where("imo IS NOT NULL").groupBy("imo").agg(F.count("*").alias("reports"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), F.avg("sog").alias("avg_sog"), F.avg("latitude").alias("avg_lat"), F.avg("longitude").alias("avg_lon"))
ORACLE_SQL["active_vessels"] = with_views("SELECT imo, count(*) AS reports, min(timestamp) AS first_seen, max(timestamp) AS last_seen, avg(sog) AS avg_sog, avg(latitude) AS avg_lat, avg(longitude) AS avg_lon FROM v_positions WHERE imo IS NOT NULL GROUP BY 1", POSITIONS)

SEGMENTS = """seg AS (SELECT * FROM (SELECT imo, event_id, latitude, longitude, sog, cog, timestamp, lead(latitude) OVER w AS to_latitude, lead(longitude) OVER w AS to_longitude, lead(timestamp) OVER w AS to_timestamp, count(*) OVER (PARTITION BY imo) AS n
 FROM v_positions WHERE imo IS NOT NULL WINDOW w AS (PARTITION BY imo ORDER BY timestamp, event_id)) WHERE n >= 2 AND to_latitude IS NOT NULL)"""
KM = "2 * 6371.0 * asin(least(1.0, sqrt(pow(sin(radians({c} - {a}) / 2), 2) + cos(radians({a})) * cos(radians({c})) * pow(sin(radians({d} - {b}) / 2), 2))))"


@query("route_segments", with_views("SELECT imo, event_id, latitude, longitude, to_latitude, to_longitude, sog, cog, timestamp, to_timestamp FROM seg", POSITIONS, SEGMENTS))
def route_segments(spark: SparkSession, sf: str) -> DataFrame:
    return po.route_segments(v.positions(spark, sf), "imo")


@query("segment_metrics", with_views(f"SELECT event_id, {KM.format(a='latitude', b='longitude', c='to_latitude', d='to_longitude')} AS km, {SECONDS('timestamp', 'to_timestamp')} / 3600 AS hours FROM seg", POSITIONS, SEGMENTS))
def segment_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return po.segment_metrics(route_segments(spark, sf)).select("event_id", "km", "hours")


@query("port_pairs", with_views("""SELECT destination AS origin, nxt AS to_port, count(DISTINCT imo) AS vessels FROM (
 SELECT imo, destination, lead(destination) OVER (PARTITION BY imo ORDER BY t, e) AS nxt FROM (SELECT imo, destination, min(timestamp) AS t, arg_min(event_id, (timestamp, event_id)) AS e FROM v_positions WHERE imo IS NOT NULL AND destination IS NOT NULL GROUP BY 1, 2)) WHERE nxt IS NOT NULL GROUP BY 1, 2""", POSITIONS))
def port_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return po.port_pairs(v.positions(spark, sf), "imo")


@query("types_by_destination", with_views("SELECT destination, vessel_type, count(DISTINCT p.imo) AS vessels FROM v_positions p LEFT JOIN reg r ON r.imo = p.imo WHERE destination IS NOT NULL AND p.imo IS NOT NULL GROUP BY 1, 2", POSITIONS, VESSELS, REGISTER))
def types_by_destination(spark: SparkSession, sf: str) -> DataFrame:
    return po.types_by_destination(v.positions(spark, sf), register(spark, sf), "imo")


# --- joins


@query("haversine_km", with_views(f"SELECT event_id, {KM.format(a='latitude', b='longitude', c='30.5', d='32.4')} AS km FROM v_positions WHERE latitude <= 90", POSITIONS))
def haversine(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf).where("latitude <= 90")
    return p.select("event_id", haversine_km(F.col("latitude"), F.col("longitude"), F.lit(30.5), F.lit(32.4)).alias("km"))


PAIRS = f"prs AS (SELECT p.port_id, e.event_id, {KM.format(a='p.latitude', b='p.longitude', c='e.latitude', d='e.longitude')} AS km FROM v_profiles p CROSS JOIN v_events e)"


@query("spatial_join", with_views("SELECT port_id, event_id, km FROM prs WHERE km <= 800", PROFILES, HAZARDS, PAIRS))
def spatial_join(spark: SparkSession, sf: str) -> DataFrame:
    return spatial.spatial_join(v.profiles(spark, sf), v.hazards(spark, sf), 800.0, "port_id", "event_id")


@query("nearest_k", with_views("SELECT port_id, event_id, km, rank FROM (SELECT *, row_number() OVER (PARTITION BY port_id ORDER BY km, event_id) AS rank FROM prs WHERE km <= 3000) WHERE rank <= 2", PROFILES, HAZARDS, PAIRS))
def nearest_k(spark: SparkSession, sf: str) -> DataFrame:
    pairs = spatial.spatial_join(v.profiles(spark, sf), v.hazards(spark, sf), 3000.0, "port_id", "event_id")
    return spatial.nearest_k(pairs, "port_id", "event_id", 2)


@query("asof_backward", with_views("SELECT o.o_orderkey, p.brent_usd, p.wti_usd FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) - 3 AS d FROM orders) o ASOF LEFT JOIN (SELECT * FROM v_prices WHERE extract(dow FROM price_date) NOT IN (0, 6)) p ON o.d >= p.price_date", PRICES))
def asof_backward(spark: SparkSession, sf: str) -> DataFrame:
    """Prices at order dates; the whole calendar is one key here, so months carry the last price of the month before."""
    orders = v.table(spark, sf, "orders").select("o_orderkey", F.date_sub(F.to_date("o_orderdate"), 3).alias("d"))
    closes = v.prices(spark, sf).where("dayofweek(price_date) NOT IN (1, 7)")
    days = closes.agg(F.min("price_date").alias("a"), F.max("price_date").alias("b")).select(F.explode(F.expr("sequence(a, b + interval 7 days, interval 1 day)")).alias("d"))
    # prices are calendar-sized: every day gets its last close first, then orders join by day
    filled = temporal.asof_backward(days.withColumn("k", F.lit(1)), closes.withColumn("k", F.lit(1)), "d", "price_date", ["k"], ["brent_usd", "wti_usd"])
    return orders.join(filled.drop("k"), "d", "left").drop("d")


@query("interval_range_join", with_views("SELECT d.transit_date, count(*) AS n FROM tdays d JOIN v_events e ON d.transit_date BETWEEN e.from_date AND e.to_date GROUP BY 1", v.TRANSITS, HAZARDS))
def interval_range_join(spark: SparkSession, sf: str) -> DataFrame:
    days = v.transits(spark, sf).select("transit_date").distinct()
    return temporal.interval_join(days, v.hazards(spark, sf), "transit_date", "from_date", "to_date").groupBy("transit_date").agg(F.count("*").alias("n"))
