"""Feeds and files parsed from payload to table: Spark makes the payloads from the tables, and the parsers read them again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import feeds as fe
from . import views as v
from .views import POSITIONS, VESSELS, with_views

QUERIES, ORACLE_SQL, query = v.catalogue()


def ntz(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


def iso(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def payload(**cells: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in cells.items()]))


@query("parse_positions_with_meta", with_views("SELECT p.mmsi, r.vessel_name AS ship_name, p.latitude, p.longitude, p.draught, CASE p.event_id % 3 WHEN 0 THEN 'Under way' WHEN 1 THEN 'At anchor' END AS nav_status, date_trunc('millisecond', p.timestamp) AS timestamp FROM v_positions p LEFT JOIN ves1 r ON r.mmsi = p.mmsi AND r.mmsi % 4 <> 0", POSITIONS, VESSELS))
def parse_positions_with_meta(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    raw = v.positions(spark, sf).select(payload(mmsi=F.col("mmsi"), geometry=F.struct(F.array("longitude", "latitude").alias("coordinates")), properties=F.struct(F.when(e % 3 == 0, 0).when(e % 3 == 1, 1).otherwise(99).alias("navStat"), F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestampExternal"), F.round(F.col("draught") * 10).alias("draught"))).alias("value"))
    ships = v.vessels(spark, sf).where("ingest_seq = 1 AND mmsi % 4 <> 0").select(payload(mmsi=F.col("mmsi"), name=F.col("vessel_name")).alias("value"))
    return ntz(fe.positions_with_meta(raw, ships), "timestamp")


@query("parse_vessel_feed", with_views("SELECT CASE WHEN mmsi % 6 <> 0 THEN imo END AS imo, mmsi, vessel_name, vessel_type, year_built, CAST(mmsi % 300 AS DOUBLE) AS length_m, CASE WHEN mmsi % 5 <> 0 THEN CAST(mmsi % 40 AS DOUBLE) END AS beam_m FROM ves1 WHERE mmsi % 7 <> 0", VESSELS))
def parse_vessel_feed(spark: SparkSession, sf: str) -> DataFrame:
    k, ships = F.col("mmsi"), v.vessels(spark, sf).where("ingest_seq = 1")
    dims = F.struct((k % 300).cast("string").alias("loa_m"), F.when(k % 5 == 0, F.lit("wide")).otherwise((k % 40).cast("string")).alias("beam_m"))
    data = F.struct(F.when(k % 6 == 0, F.lit("0")).otherwise(F.col("imo").cast("string")).alias("imo"), k.cast("string").alias("mmsi"), F.when(k % 2 == 0, F.col("vessel_name")).alias("vesselName"), F.col("vessel_name").alias("name"), F.col("vessel_type").alias("type"), F.col("year_built").cast("string").alias("built"), dims.alias("dimensions"))
    return fe.vessel_feed(ships.select(payload(success=k % 7 != 0, data=data).alias("value")))


@query("parse_port_calls", with_views("SELECT mmsi, vessel_name, destination AS port_unlocode, CASE WHEN sog < 100 THEN 'arrival' ELSE 'departure' END AS event_type, CASE WHEN event_id % 9 <> 0 THEN timestamp END AS event_timestamp FROM v_positions WHERE destination IS NOT NULL", POSITIONS))
def parse_port_calls(spark: SparkSession, sf: str) -> DataFrame:
    e, p = F.col("event_id"), v.positions(spark, sf)
    time = F.when(e % 9 == 0, F.lit("soon")).otherwise(iso("timestamp"))
    raw = p.select(payload(vessel=F.struct("mmsi", F.col("vessel_name").alias("name")), port_unlocode=F.when(e % 2 == 0, F.col("destination")), port=F.when(e % 2 == 1, F.col("destination")), event=F.when(F.col("sog") < 100, "ARRIVAL").otherwise("DEPARTURE"), timestamp=F.when(e % 4 < 2, time), event_time=F.when(e % 4 >= 2, time)).alias("value"))
    return ntz(fe.port_calls(raw), "event_timestamp")


@query("parse_tanker_positions", with_views("SELECT CASE WHEN event_id % 5 <> 0 THEN imo END AS imo, mmsi, vessel_name, latitude, longitude, sog FROM v_positions", POSITIONS))
def parse_tanker_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Bare arrays and objects with `vessels` or `data`; a bounded number of ships in each."""
    e, p = F.col("event_id"), v.positions(spark, sf)
    ship = F.struct(F.when(e % 5 == 0, F.lit("unknown")).otherwise(F.col("imo").cast("string")).alias("imo"), F.col("mmsi").cast("string").alias("mmsi"), F.when(e % 2 == 0, F.col("vessel_name")).alias("name"), F.when(e % 2 == 1, F.col("vessel_name")).alias("shipname"), F.when(e % 3 == 0, F.col("latitude")).alias("lat"), F.when(e % 3 != 0, F.col("latitude")).alias("latitude"), F.when(e % 3 == 0, F.col("longitude")).alias("lon"), F.when(e % 3 == 1, F.col("longitude")).alias("lng"), F.when(e % 3 == 2, F.col("longitude")).alias("longitude"), F.col("sog").alias("speed"))
    packs = p.groupBy((e / 100).cast("long").alias("k")).agg(F.collect_list(ship).alias("s"))
    k = F.col("k")
    return fe.tanker_positions(packs.select(F.when(k % 3 == 0, F.to_json("s")).when(k % 3 == 1, F.to_json(F.struct(F.col("s").alias("vessels")))).otherwise(F.to_json(F.struct(F.col("s").alias("data")))).alias("value")))


@query("parse_ports_ref", "SELECT 'n' || CAST(s_suppkey AS VARCHAR) AS unlocode, s_name AS port_name, 'N' || substr(CAST(s_suppkey AS VARCHAR), 1, 1) AS country_code, CAST(s_suppkey % 80 AS DOUBLE) AS latitude, CAST(s_suppkey % 170 AS DOUBLE) AS longitude FROM supplier WHERE s_suppkey % 5 <> 0 AND s_suppkey % 7 <> 0")
def parse_ports_ref(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("s_suppkey")
    raw = v.table(spark, sf, "supplier").select(payload(locode=F.when(k % 5 != 0, F.concat(F.lit("n"), k.cast("string"))), geometry=F.when(k % 7 != 0, F.struct(F.array((k % 170).cast("double"), (k % 80).cast("double")).alias("coordinates"))), properties=F.struct(F.col("s_name").alias("locationName"))).alias("value"))
    return fe.ports_ref(raw)


@query("parse_activity_csv", "SELECT CAST(l_shipdate AS DATE) AS activity_date, CAST(extract(year FROM l_shipdate) AS INT) AS year, 'port' || CAST(l_suppkey AS VARCHAR) AS port_id, CAST(count(*) AS INT) AS portcalls, sum(l_quantity) AS import_total FROM lineitem GROUP BY ALL")
def parse_activity_csv(spark: SparkSession, sf: str) -> DataFrame:
    """All-string lines of a bulk CSV with a byte-order mark before its header, and written by year."""
    from .streams import shared

    daily = v.table(spark, sf, "lineitem").groupBy(F.to_date("l_shipdate").alias("d"), "l_suppkey").agg(F.count("*").alias("n"), F.sum("l_quantity").alias("q"))
    path = shared(spark)
    daily.select(F.date_format("d", "yyyy/MM/dd").alias("﻿date"), F.concat(F.lit("port"), F.col("l_suppkey").cast("string")).alias("portid"), F.col("n").cast("string").alias("portcalls"), F.col("q").cast("string").alias("import")).write.option("header", True).csv(f"{path}/raw")
    out = fe.activity_csv(spark.read.option("header", True).csv(f"{path}/raw"))
    out.write.partitionBy("year").parquet(f"{path}/table")
    return spark.read.parquet(f"{path}/table").select("activity_date", "year", "port_id", "portcalls", "import_total")


@query("parse_hazard_events", "SELECT o_orderkey AS event_id, CASE WHEN o_orderkey % 2 = 0 THEN 'RED' ELSE 'GREEN' END AS alert_level, 'Storm ' || CAST(o_custkey AS VARCHAR) AS event_name, CAST(o_custkey AS DOUBLE) AS severity, CAST(o_orderdate AS DATE) AS from_date, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'many' END AS affected_population FROM orders")
def parse_hazard_events(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    o = v.table(spark, sf, "orders")
    name = F.concat(F.lit("<b>Storm</b> &nbsp;"), F.col("o_custkey").cast("string"))
    severity = F.to_json(F.struct(F.struct(F.col("o_custkey").cast("string").alias("severity")).alias("severitydata")))
    old = o.where(k % 2 == 0).select(payload(attributes=F.struct(k.alias("eventid"), F.lit("Red").alias("alertlevel"), name.alias("name"), severity.alias("severitydata"), (F.unix_date(F.to_date("o_orderdate")).cast("long") * 86_400_000).alias("fromdate"), F.when(k % 3 == 0, F.lit("")).otherwise("many").alias("affectedpopulation"))).alias("value"))
    new = o.where(k % 2 == 1).select(payload(attributes=F.struct(k.alias("eventid"), F.lit("green").alias("alertlevel"), name.alias("name"), severity.alias("severitydata"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("fromdate"), F.when(k % 3 == 0, F.lit(" ")).otherwise("many").alias("affectedpopulation"))).alias("value"))
    return fe.hazard_events(old.union(new))


@query("parse_us_ports", "SELECT lpad(CAST(s_suppkey AS VARCHAR), 4, '0') AS port_code, s_name AS port_name, 2023 AS data_year, s_acctbal AS tonnage FROM supplier")
def parse_us_ports(spark: SparkSession, sf: str) -> DataFrame:
    raw = v.table(spark, sf, "supplier").select(payload(attributes=F.struct(F.col("s_suppkey").cast("double").alias("PORT"), F.col("s_name").alias("PORT_NAME"), F.col("s_acctbal").alias("TOTAL"))).alias("value"))
    return fe.us_ports(raw, "Tonnage of principal ports, calendar year 2023 (final)")


@query("parse_stocks_json", "SELECT report_date, product, area, CASE WHEN name <> 'Ending Stocks' THEN 'excluding_spr' WHEN bool_or(name <> 'Ending Stocks') OVER (PARTITION BY report_date, product, area) THEN 'total' ELSE 'commercial' END AS stock_type, value FROM (SELECT CAST(o_orderdate AS DATE) AS report_date, o_orderstatus AS product, o_orderpriority AS area, 'Ending Stocks' AS name, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2, 3 UNION ALL SELECT CAST(o_orderdate AS DATE), o_orderstatus, o_orderpriority, 'Ending Stocks Excluding SPR', count(*) FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 1, 2, 3)")
def parse_stocks_json(spark: SparkSession, sf: str) -> DataFrame:
    o = v.table(spark, sf, "orders").withColumn("d", F.to_date("o_orderdate"))
    keys = ["d", "o_orderstatus", "o_orderpriority"]
    a = o.groupBy(*keys).agg(F.sum("o_totalprice").alias("x")).withColumn("name", F.lit("Ending Stocks"))
    b = o.where("o_orderkey % 2 = 0").groupBy(*keys).agg(F.count("*").cast("double").alias("x")).withColumn("name", F.lit("Ending Stocks Excluding SPR"))
    return fe.stocks(a.unionByName(b).select(payload(period=F.date_format("d", "yyyy-MM-dd"), product=F.col("o_orderstatus"), area=F.col("o_orderpriority"), process=F.col("name"), value=F.col("x").cast("string")).alias("value")))


@query("parse_sdmx_xml", "SELECT 'N' || CAST(c_nationkey AS VARCHAR) AS reporter, CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'X' END AS flow, CAST(c_custkey AS VARCHAR) AS period, c_acctbal AS value_eur FROM customer")
def parse_sdmx_xml(spark: SparkSession, sf: str) -> DataFrame:
    """One series of one observation per payload; series of many are the same path."""
    flow = F.when(F.col("c_custkey") % 2 == 0, "1").otherwise("2")
    text = F.concat(F.lit('<DataSet><Series><SeriesKey><Value id="REPORTER" value="N'), F.col("c_nationkey").cast("string"), F.lit('"/><Value id="FLOW" value="'), flow, F.lit('"/></SeriesKey><Obs><ObsDimension value="'), F.col("c_custkey").cast("string"), F.lit('"/><ObsValue value="'), F.col("c_acctbal").cast("string"), F.lit('"/></Obs></Series></DataSet>'))
    return fe.sdmx(v.table(spark, sf, "customer").select(text.alias("value")))


@query("parse_wide_prices", "SELECT CAST(o_orderdate AS DATE) AS price_date, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END) AS brent_usd, sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END) AS wti_usd FROM orders GROUP BY 1 HAVING count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) > 0")
def parse_wide_prices(spark: SparkSession, sf: str) -> DataFrame:
    of = lambda s, gap: F.coalesce(F.sum(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice"))).cast("string"), F.lit(gap))
    raw = v.table(spark, sf, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("observation_date")).agg(of("F", ".").alias("DCOILBRENTEU"), of("O", "").alias("DCOILWTICO"), F.lit("1").alias("OTHER"))
    return fe.wide_prices(raw, "observation_date", {"brent_usd": "DCOILBRENTEU", "wti_usd": "DCOILWTICO"})


@query("parse_export_sales", "SELECT CAST(o_orderdate AS DATE) AS week_ending, o_orderpriority AS country, o_totalprice AS weekly_exports, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_custkey AS DOUBLE) END AS net_sales FROM orders WHERE o_orderkey % 11 <> 0")
def parse_export_sales(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    date = F.when(k % 11 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00"))
    return fe.export_sales(v.table(spark, sf, "orders").select(payload(weekEndingDate=date, country=F.col("o_orderpriority"), weeklyExports=F.col("o_totalprice").cast("string"), currentMYNetSales=F.when(k % 4 == 0, F.lit("n/a")).otherwise(F.col("o_custkey").cast("string"))).alias("value")))


@query("flatten_report_xml", "SELECT c_mktsegment AS commodity, 'N' || CAST(c_nationkey AS VARCHAR) AS region, CAST(2000 + c_custkey % 20 AS VARCHAR) || '/' || lpad(CAST((c_custkey % 20 + 1) % 100 AS VARCHAR), 2, '0') AS market_year, CASE c_custkey % 3 WHEN 0 THEN 'Proj.' WHEN 1 THEN 'Est.' END AS flag, c_acctbal AS value FROM customer")
def flatten_report_xml(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    year = F.concat((2000 + k % 20).cast("string"), F.lit("/"), F.lpad(((k % 20 + 1) % 100).cast("string"), 2, "0"), F.when(k % 3 == 0, " Proj.").when(k % 3 == 1, " Est.").otherwise(""))
    text = F.concat(F.lit('<Report><Matrix commodity="'), F.col("c_mktsegment"), F.lit(' 1/"><Region region="N'), F.col("c_nationkey").cast("string"), F.lit('"><Year year="'), year, F.lit('"><Month name="previous"><Cell value="-1"/></Month><Month name="current"><Cell value="'), F.col("c_acctbal").cast("string"), F.lit('"/></Month></Year></Region></Matrix></Report>'))
    return fe.report_xml(v.table(spark, sf, "customer").select(text.alias("value")))


@query("parse_event_entries", with_views("SELECT event_id, mmsi, vessel_name, CASE WHEN event_id % 4 <> 0 THEN destination END AS port_name, CASE WHEN event_id % 6 <> 0 THEN timestamp END AS start_time FROM v_positions", POSITIONS))
def parse_event_entries(spark: SparkSession, sf: str) -> DataFrame:
    e, p = F.col("event_id"), v.positions(spark, sf)
    ship = F.struct(F.col("mmsi").cast("string").alias("ssvid"), F.col("vessel_name").alias("shipname"))
    entry = F.struct(e.cast("string").alias("id"), F.when(e % 6 == 0, F.lit("?")).otherwise(iso("timestamp")).alias("start"), F.struct(F.array(ship, F.struct(F.lit("0").alias("ssvid"), F.lit("older").alias("shipname"))).alias("registryInfo")).alias("vessel"), F.struct(F.when(e % 4 != 0, F.col("destination")).alias("name")).alias("port"))
    packs = p.groupBy((e / 100).cast("long")).agg(F.to_json(F.struct(F.collect_list(entry).alias("entries"))).alias("value"))
    return ntz(fe.event_entries(packs), "start_time")


@query("parse_grid_csv", with_views("SELECT timestamp, latitude, longitude, sog AS wave_height FROM v_positions WHERE event_id % 8 <> 0 AND event_id % 9 <> 0", POSITIONS))
def parse_grid_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The units row under the header, blanks and NaN go; aware times become UTC."""
    e = F.col("event_id")
    rows = v.positions(spark, sf).select(F.concat(iso("timestamp"), F.lit("Z")).alias("time"), F.col("latitude").cast("string").alias("latitude"), F.col("longitude").cast("string").alias("longitude"), F.when(e % 8 == 0, "NaN").when(e % 9 == 0, "").otherwise(F.col("sog").cast("string")).alias("wave"))
    units = spark.createDataFrame([("UTC", "degrees_north", "degrees_east", "m")], rows.schema)
    return ntz(fe.grid_csv(units.union(rows), "wave", "wave_height"), "timestamp")


@query("parse_air_cargo_csv", "SELECT CAST(1 + l_linenumber % 12 AS INT) AS month, trim(l_returnflag) AS carrier, CASE WHEN l_orderkey % 5 <> 0 THEN l_quantity END AS freight, NULL::DOUBLE AS mail FROM lineitem WHERE l_orderkey % 7 <> 0")
def parse_air_cargo_csv(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("l_orderkey")
    raw = v.table(spark, sf, "lineitem").select(F.when(k % 7 == 0, F.lit(" ")).otherwise((1 + F.col("l_linenumber") % 12).cast("string")).alias("MONTH"), F.concat(F.lit(" "), F.col("l_returnflag"), F.lit("  ")).alias("UNIQUE_CARRIER"), F.when(k % 5 == 0, "x").otherwise(F.col("l_quantity").cast("string")).alias("FREIGHT"))
    return fe.string_table(raw, {"month": ("MONTH", "int"), "carrier": ("UNIQUE_CARRIER", "string"), "freight": ("FREIGHT", "double"), "mail": ("MAIL", "double")}, ["month"])


@query("load_tracks_pruned", with_views("SELECT mmsi, timestamp AS start_time, CAST(date_trunc('month', timestamp) AS DATE) AS track_month FROM v_positions", POSITIONS))
def load_tracks_pruned(spark: SparkSession, sf: str) -> DataFrame:
    """A month's file is read without its geometry; nanoseconds become microseconds."""
    from .streams import shared

    path = shared(spark)
    v.positions(spark, sf).select("mmsi", (F.unix_micros(F.col("timestamp").cast("timestamp")) * 1000).alias("start_ns"), F.repeat(F.lit("0"), 50).alias("geometry")).write.parquet(path)
    return ntz(fe.tracks(spark.read.parquet(path)), "start_time")


@query("parse_status_snapshots", "SELECT CAST(ts AS DATE) AS snapshot_date, event_type AS chokepoint_id, count(*) AS vessels, CAST(0 AS BIGINT) AS waiting FROM events GROUP BY 1, 2")
def parse_status_snapshots(spark: SparkSession, sf: str) -> DataFrame:
    by = v.table(spark, sf, "events").groupBy(F.to_date("ts").alias("d"), "event_type").agg(F.count("*").alias("n"))
    packs = by.groupBy("d").agg(F.collect_list(F.struct(F.col("event_type").alias("id"), F.col("n").alias("vessels"))).alias("chokepoints"))
    return fe.status_snapshots(packs.select(payload(timestamp=F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T12:00:00Z")), chokepoints=F.col("chokepoints")).alias("value")))


@query("parse_trade_records", "SELECT CAST(extract(year FROM o_orderdate) AS INT) AS year, o_orderstatus AS flow_code, lpad(CAST(o_custkey AS VARCHAR), 6, '0') AS commodity_code, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS value_usd FROM orders")
def parse_trade_records(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("o_orderkey")
    record = payload(refYear=F.year("o_orderdate"), flowCode=F.col("o_orderstatus"), cmdCode=F.lpad(F.col("o_custkey").cast("string"), 6, "0"), primaryValue=F.when(k % 4 == 0, F.lit("-")).otherwise(F.col("o_totalprice").cast("string")), grossWgt=F.lit("5"))
    return fe.trade_records(v.table(spark, sf, "orders").select(record.alias("value")))
