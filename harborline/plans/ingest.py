"""Ingest queries: payloads are made of the tables by Spark and parsed again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import parse as ps
from . import views as v
from .views import POSITIONS, with_views

QUERIES, ORACLE_SQL = {}, {}
#: Rows of a payload at most, keys running on: files have a bounded size, however many there are.
PAYLOAD_ROWS = 1000


def query(name: str, sql: str | None = None):  # noqa: ANN201
    def add(f):  # noqa: ANN001, ANN202
        QUERIES[name] = f
        if sql is not None:
            ORACLE_SQL[name] = sql
        return f

    return add


def stamp(c: str):  # noqa: ANN201
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


@query("parse_geojson_positions", with_views("SELECT mmsi, CASE WHEN event_id % 5 <> 0 THEN imo END AS imo, vessel_name, latitude, longitude, timestamp FROM v_positions", POSITIONS))
def parse_geojson_positions(spark: SparkSession, sf: str) -> DataFrame:
    p = v.positions(spark, sf)
    imo = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(F.col("imo").cast("string"))
    feature = F.struct(F.struct(F.array("longitude", "latitude").alias("coordinates")).alias("geometry"), F.struct(F.col("mmsi").cast("string").alias("mmsi"), imo.alias("imo"), F.col("vessel_name").alias("name"), stamp("timestamp").alias("timestamp")).alias("properties"))
    raw = p.groupBy("partition_date", F.floor(F.col("event_id") / PAYLOAD_ROWS)).agg(F.to_json(F.struct(F.collect_list(feature).alias("features"))).alias("value"))
    return ps.geojson_positions(raw).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def envelopes(spark: SparkSession, sf: str) -> DataFrame:
    """Position reports and ship data in message envelopes."""
    e = F.col("event_id")
    meta = F.struct(F.col("mmsi").alias("MMSI"), F.concat("vessel_name", F.lit("  ")).alias("ShipName"), F.concat(stamp("timestamp"), F.lit("123 +0000 UTC")).alias("time_utc"))
    report = F.struct(F.col("latitude").alias("Latitude"), F.col("longitude").alias("Longitude"), F.col("sog").alias("Sog"))
    static = F.struct(F.coalesce("imo", F.lit(0)).alias("ImoNumber"), F.struct((e % 3).alias("A"), F.lit(0).alias("B"), (e % 4).alias("C"), (e % 2).alias("D")).alias("Dimension"))
    kind = F.when(e % 4 == 0, "ShipStaticData").otherwise("PositionReport")
    message = F.struct(F.when(e % 4 != 0, report).alias("PositionReport"), F.when(e % 4 == 0, static).alias("ShipStaticData"))
    return v.positions(spark, sf).select(F.to_json(F.struct(kind.alias("MessageType"), meta.alias("MetaData"), message.alias("Message"))).alias("value"))


@query("parse_ais_messages", with_views("SELECT mmsi, vessel_name, timestamp, latitude, longitude, sog, NULL::BIGINT AS imo, NULL::DOUBLE AS length_m, NULL::DOUBLE AS beam_m FROM v_positions WHERE event_id % 4 <> 0 UNION ALL SELECT mmsi, vessel_name, timestamp, NULL, NULL, NULL, imo, nullif(event_id % 3, 0), nullif(event_id % 4 + event_id % 2, 0) FROM v_positions WHERE event_id % 4 = 0", POSITIONS))
def parse_ais_messages(spark: SparkSession, sf: str) -> DataFrame:
    positions, vessels = ps.ais_messages(envelopes(spark, sf))
    return positions.unionByName(vessels, allowMissingColumns=True).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query("parse_arcgis_features", "SELECT o_orderkey AS port_id, CAST(o_orderdate AS DATE) AS activity_date, CASE WHEN o_orderkey % 3 <> 2 THEN CAST(o_custkey AS INT) END AS portcalls FROM orders WHERE o_orderkey % 7 <> 0")
def parse_arcgis_features(spark: SparkSession, sf: str) -> DataFrame:
    k, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    date = F.when(k % 3 == 0, F.date_format(d, "yyyy-MM-dd")).when(k % 3 == 1, F.date_format(d, "yyyy/MM/dd")).otherwise((F.unix_date(d).cast("long") * 86_400_000).cast("string"))
    calls = F.when(k % 3 != 2, F.col("o_custkey").cast("string")).otherwise("many")
    attributes = F.create_map(F.lit("portid"), F.when(k % 7 != 0, k.cast("string")), F.lit("date"), date, F.lit("portcalls"), calls)
    raw = v.table(spark, sf, "orders").groupBy(F.floor(k / PAYLOAD_ROWS)).agg(F.to_json(F.struct(F.collect_list(F.struct(attributes.alias("attributes"))).alias("features"))).alias("value"))
    return ps.arcgis_features(raw, {"port_id": ("portid", "bigint"), "activity_date": ("date", "date"), "portcalls": ("portcalls", "int")}, ["port_id", "activity_date"])


@query("parse_census_matrix", "SELECT s_suppkey AS code, CASE WHEN s_suppkey % 4 <> 0 THEN s_acctbal END AS value, NULL::DOUBLE AS absent FROM supplier")
def parse_census_matrix(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    row = F.array(k.cast("string"), F.when(k % 4 == 0, F.lit("-")).otherwise(F.col("s_acctbal").cast("string")), F.lit("again"))
    rows = v.table(spark, sf, "supplier").groupBy(F.floor(k / PAYLOAD_ROWS)).agg(F.collect_list(row).alias("r"))
    raw = rows.select(F.to_json(F.concat(F.array(F.array(F.lit("code"), F.lit("value"), F.lit("value"))), "r")).alias("value"))
    return ps.census_matrix(raw, {"code": "bigint", "value": "double", "absent": "double"})


@query("decode_jsonstat", "SELECT 'N' || CAST(n_nationkey AS VARCHAR) AS geo, CASE WHEN n_nationkey % 2 = 0 THEN 'in' ELSE 'out' END AS direction, CAST(n_regionkey AS DOUBLE) AS obs FROM nation")
def decode_jsonstat(spark: SparkSession, sf: str) -> DataFrame:
    n = v.table(spark, sf, "nation")
    k = F.col("n_nationkey")
    cells = F.map_from_entries(F.collect_list(F.struct((F.col("at") * 2 + k % 2).cast("string"), F.col("n_regionkey").cast("double"))))
    each = n.groupBy(F.pmod(k, F.lit(4)).alias("g")).agg(F.array_sort(F.collect_list(k)).alias("keys"))
    at = n.withColumn("g", F.pmod(k, F.lit(4))).join(each, "g").withColumn("at", F.array_position("keys", k) - 1)
    raw = at.groupBy("g").agg(cells.alias("value"), F.first("keys").alias("keys"))
    codes = F.array(F.transform("keys", lambda x: F.concat(F.lit("N"), x.cast("string"))), F.array(F.lit("in"), F.lit("out")))
    raw = raw.select(F.to_json(F.struct(F.array(F.lit("geo"), F.lit("direction")).alias("id"), F.array(F.size("keys"), F.lit(2)).alias("size"), "value", codes.alias("codes"))).alias("value"))
    return ps.jsonstat(raw).select(F.col("codes.geo").alias("geo"), F.col("codes.direction").alias("direction"), "obs")


@query("last_vintage_wide", "SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN c_acctbal WHEN 1 THEN 2.5 WHEN 2 THEN 1.5 END AS value FROM customer")
def last_vintage_wide(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey") % 4
    raw = v.table(spark, sf, "customer").select("c_custkey", F.when(k < 3, "1.5").otherwise(" ").alias("v1"), F.when(k < 2, "2.5").otherwise("#N/A").alias("v2"), F.when(k == 0, F.col("c_acctbal").cast("string")).otherwise("").alias("v3"))
    return raw.select("c_custkey", ps.last_vintage(raw, ["v1", "v2", "v3"]).alias("value"))


@query("zip_hourly_arrays", "SELECT date_trunc('day', ts) AS timestamp, NULL::DOUBLE AS v, count(*) AS n FROM events GROUP BY 1")
def zip_hourly_arrays(spark: SparkSession, sf: str) -> DataFrame:
    e = v.table(spark, sf, "events").withColumn("block", F.floor(F.col("event_id") / PAYLOAD_ROWS))
    hourly = e.groupBy("block", F.date_trunc("day", "ts")).agg(F.collect_list(stamp("ts")).alias("time"), F.slice(F.collect_list("value"), 1, 0).alias("v"))
    rows = ps.zip_hours(hourly.select(F.to_json(F.struct(F.struct("time", "v").alias("hourly"))).alias("value")), ["v"])
    return rows.groupBy(F.date_trunc("day", "timestamp").cast("timestamp_ntz").alias("timestamp")).agg(F.max("v").alias("v"), F.count("*").alias("n"))


@query("union_trade_flows", "SELECT l_orderkey, l_linenumber, 'M' AS flow_code, NULL AS export_origin FROM lineitem WHERE l_linestatus = 'F' UNION ALL SELECT l_orderkey, l_linenumber, 'X', CASE WHEN l_returnflag = 'N' THEN 'domestic' ELSE 'foreign' END FROM lineitem WHERE l_linestatus = 'O'")
def union_trade_flows(spark: SparkSession, sf: str) -> DataFrame:
    lines = v.table(spark, sf, "lineitem")
    imports = lines.where("l_linestatus = 'F'").select("l_orderkey", "l_linenumber", F.lit("M").alias("flow_code"))
    exports = lambda c, name: lines.where(f"l_linestatus = 'O' AND {c}").select("l_orderkey", "l_linenumber", F.lit("X").alias("flow_code"), F.lit(name).alias("export_origin"))
    return imports.unionByName(exports("l_returnflag = 'N'", "domestic"), allowMissingColumns=True).unionByName(exports("l_returnflag <> 'N'", "foreign"))


@query("filter_country_partners", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS code FROM customer WHERE c_custkey BETWEEN 1000 AND 9999")
def filter_country_partners(spark: SparkSession, sf: str) -> DataFrame:
    return ps.country_partners(v.table(spark, sf, "customer").select("c_custkey", ps.padded(F.col("c_custkey").cast("string"), 4).alias("code")), "code")


@query("page_cells")
def page_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Cells of the pages; nested and broken markup has no SQL form, so a small fixture tests it."""
    return ps.html_cells(v.table(spark, sf, "pages").select("page_id", "html"), "html")
