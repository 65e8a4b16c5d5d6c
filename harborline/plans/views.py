"""Domain tables made of the test tables, as DataFrames and as SQL for the oracle.

Production jobs read landed tables of the same columns instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


_KEPT: ContextVar[dict | None] = ContextVar("kept", default=None)


@contextmanager
def kept() -> Iterator[None]:
    """While a query is put together, what `once` marks is made once, stored, and read by all steps that need it."""
    token = _KEPT.set({}) if _KEPT.get() is None else None
    try:
        yield
    finally:
        if token is not None:
            _KEPT.reset(token)


def once(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def get(spark: SparkSession, sf_dir: str) -> DataFrame:
        have = _KEPT.get()
        if have is None:
            return f(spark, sf_dir)
        key = (f.__module__, f.__name__, sf_dir)
        if key not in have:
            have[key] = stored(f(spark, sf_dir))
        return have[key]

    return get


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@once
def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily port activity: a row for every port and day between the first day and the last."""
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", F.to_date("l_shipdate").alias("activity_date"), "l_returnflag", "l_linestatus", "l_quantity")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    flag = lambda c, v: F.count(F.when(F.col(c) == v, 1))
    moved = lambda v: F.sum(F.when(F.col("l_linestatus") == v, F.col("l_quantity")).otherwise(0.0))
    daily = (
        lines.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "activity_date")
        .agg(F.count("*").alias("portcalls"), flag("l_returnflag", "A").alias("portcalls_tanker"), flag("l_returnflag", "N").alias("portcalls_container"), flag("l_returnflag", "R").alias("portcalls_dry_bulk"), moved("F").alias("import_total"), moved("O").alias("export_total"))
    )
    ends = lines.agg(F.min("activity_date").alias("a"), F.max("activity_date").alias("b"))
    days = ends.select(F.explode(F.sequence("a", "b")).alias("activity_date"))
    ports = nations.select(F.col("n_nationkey").cast("long").alias("port_id"), F.col("n_name").alias("port_name"), F.col("r_name").alias("country"), F.upper(F.substring("n_name", 1, 3)).alias("iso3"))
    grid = ports.crossJoin(days)
    out = grid.join(daily.withColumnRenamed("s_nationkey", "port_id"), ["port_id", "activity_date"], "left")
    return out.select("port_id", "port_name", "country", "iso3", "activity_date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("portcalls", "portcalls_tanker", "portcalls_container", "portcalls_dry_bulk")], *[F.coalesce(c, F.lit(0.0)).alias(c) for c in ("import_total", "export_total")])


ACTIVITY = """
act0 AS (
  SELECT s_nationkey AS k, CAST(l_shipdate AS DATE) AS activity_date, count(*) AS portcalls,
    count(*) FILTER (WHERE l_returnflag = 'A') AS portcalls_tanker, count(*) FILTER (WHERE l_returnflag = 'N') AS portcalls_container,
    count(*) FILTER (WHERE l_returnflag = 'R') AS portcalls_dry_bulk,
    sum(CASE WHEN l_linestatus = 'F' THEN l_quantity ELSE 0 END) AS import_total,
    sum(CASE WHEN l_linestatus = 'O' THEN l_quantity ELSE 0 END) AS export_total
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2),
days AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS activity_date
  FROM (SELECT CAST(min(l_shipdate) AS DATE) AS a, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem)),
v_activity AS (
  SELECT CAST(n_nationkey AS BIGINT) AS port_id, n_name AS port_name, r_name AS country, upper(substr(n_name, 1, 3)) AS iso3, d.activity_date,
    coalesce(portcalls, 0) AS portcalls, coalesce(portcalls_tanker, 0) AS portcalls_tanker, coalesce(portcalls_container, 0) AS portcalls_container,
    coalesce(portcalls_dry_bulk, 0) AS portcalls_dry_bulk, coalesce(import_total, 0.0) AS import_total, coalesce(export_total, 0.0) AS export_total
  FROM nation JOIN region ON n_regionkey = r_regionkey CROSS JOIN days d LEFT JOIN act0 ON k = n_nationkey AND act0.activity_date = d.activity_date)"""


@once
def transits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily strait transits by order priority, zero-filled."""
    orders = table(spark, sf_dir, "orders").withColumn("transit_date", F.to_date("o_orderdate"))
    status = lambda v: F.count(F.when(F.col("o_orderstatus") == v, 1))
    daily = orders.groupBy(F.col("o_orderpriority").alias("chokepoint_id"), "transit_date").agg(F.count("*").alias("n_total"), status("F").alias("n_tanker"), status("O").alias("n_container"), status("P").alias("n_dry_bulk"), F.floor(F.sum("o_totalprice") + 0.005).cast("double").alias("capacity"))
    days = orders.agg(F.min("transit_date").alias("a"), F.max("transit_date").alias("b")).select(F.explode(F.sequence("a", "b")).alias("transit_date"))
    grid = orders.select(F.col("o_orderpriority").alias("chokepoint_id")).distinct().crossJoin(days)
    out = grid.join(daily, ["chokepoint_id", "transit_date"], "left")
    return out.select("chokepoint_id", "transit_date", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_total", "n_tanker", "n_container", "n_dry_bulk")], F.coalesce("capacity", F.lit(0.0)).alias("capacity"))


TRANSITS = """
tr0 AS (SELECT o_orderpriority AS chokepoint_id, CAST(o_orderdate AS DATE) AS transit_date, count(*) AS n_total,
    count(*) FILTER (WHERE o_orderstatus = 'F') AS n_tanker, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_container,
    count(*) FILTER (WHERE o_orderstatus = 'P') AS n_dry_bulk, CAST(floor(sum(o_totalprice) + 0.005) AS DOUBLE) AS capacity FROM orders GROUP BY 1, 2),
tdays AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS transit_date
  FROM (SELECT CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b FROM orders)),
v_transits AS (SELECT c.chokepoint_id, d.transit_date, coalesce(n_total, 0) AS n_total, coalesce(n_tanker, 0) AS n_tanker,
    coalesce(n_container, 0) AS n_container, coalesce(n_dry_bulk, 0) AS n_dry_bulk, coalesce(capacity, 0.0) AS capacity
  FROM (SELECT DISTINCT o_orderpriority AS chokepoint_id FROM orders) c CROSS JOIN tdays d
  LEFT JOIN tr0 ON tr0.chokepoint_id = c.chokepoint_id AND tr0.transit_date = d.transit_date)"""


@once
def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Port profiles: place and fleet of each port."""
    nations = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    fleet = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.count("*").alias("vessel_count_total"), F.count(F.when(F.col("c_mktsegment") == "MACHINERY", 1)).alias("vessel_count_tanker"), F.count(F.when(F.col("c_mktsegment") == "BUILDING", 1)).alias("vessel_count_container"))
    k = F.col("n_nationkey").cast("long")
    out = nations.join(fleet, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return out.select(k.alias("port_id"), F.col("n_name").alias("port_name"), F.col("r_name").alias("continent"), (F.pmod(k * 37, F.lit(140)) - 70).cast("double").alias("latitude"), (F.pmod(k * 73, F.lit(360)) - 180).cast("double").alias("longitude"), *[F.coalesce(f"vessel_count_{c}", F.lit(0)).alias(f"vessel_count_{c}") for c in ("total", "tanker", "container")])


PROFILES = """
v_profiles AS (SELECT CAST(n_nationkey AS BIGINT) AS port_id, n_name AS port_name, r_name AS continent,
    CAST((CAST(n_nationkey AS BIGINT) * 37) % 140 - 70 AS DOUBLE) AS latitude, CAST((CAST(n_nationkey AS BIGINT) * 73) % 360 - 180 AS DOUBLE) AS longitude,
    coalesce(t, 0) AS vessel_count_total, coalesce(m, 0) AS vessel_count_tanker, coalesce(b, 0) AS vessel_count_container
  FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN (
    SELECT c_nationkey, count(*) AS t, count(*) FILTER (WHERE c_mktsegment = 'MACHINERY') AS m, count(*) FILTER (WHERE c_mktsegment = 'BUILDING') AS b
    FROM customer GROUP BY 1) f ON c_nationkey = n_nationkey)"""


def hazards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hazard events, one for each order, with place, alert level and dates."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    kind = F.element_at(F.array(*map(F.lit, ("TC", "FL", "EQ", "DR"))), (F.pmod(c, F.lit(4)) + 1).cast("int"))
    alert = F.when(F.pmod(k, F.lit(7)) == 0, "RED").when(F.pmod(k, F.lit(3)) == 0, "ORANGE").otherwise("GREEN")
    return table(spark, sf_dir, "orders").select(k.alias("event_id"), kind.alias("event_type"), alert.alias("alert_level"), F.to_date("o_orderdate").alias("from_date"), F.date_add(F.to_date("o_orderdate"), F.pmod(c, F.lit(10)).cast("int")).alias("to_date"), (F.pmod(c * 29, F.lit(140)) - 70).cast("double").alias("latitude"), (F.pmod(c * 53, F.lit(360)) - 180).cast("double").alias("longitude"), F.pmod(c, F.lit(25)).alias("listed_port"))


HAZARDS = """
v_events AS (SELECT o_orderkey AS event_id, ['TC', 'FL', 'EQ', 'DR'][CAST(o_custkey % 4 AS INT) + 1] AS event_type,
    CASE WHEN o_orderkey % 7 = 0 THEN 'RED' WHEN o_orderkey % 3 = 0 THEN 'ORANGE' ELSE 'GREEN' END AS alert_level,
    CAST(o_orderdate AS DATE) AS from_date, CAST(o_orderdate AS DATE) + CAST(o_custkey % 10 AS INT) AS to_date,
    CAST((o_custkey * 29) % 140 - 70 AS DOUBLE) AS latitude, CAST((o_custkey * 53) % 360 - 180 AS DOUBLE) AS longitude, o_custkey % 25 AS listed_port
  FROM orders)"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vessel positions of the event stream, with sentinel values among them."""
    e, u = F.col("event_id"), F.col("user_id")
    k = F.get_json_object("props", "$.k").cast("double")
    return table(spark, sf_dir, "events").select(
        e.alias("event_id"),
        u.alias("mmsi"),
        F.when(F.pmod(u, F.lit(7)) != 0, u + 9_000_000).alias("imo"),
        F.concat(F.lit("SHIP "), u.cast("string")).alias("vessel_name"),
        F.col("ts").alias("timestamp"),
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("destination"),
        F.col("value").alias("sog"),
        F.pmod(e * 17, F.lit(400)).cast("double").alias("cog"),
        F.pmod(e * 11, F.lit(520)).cast("double").alias("heading"),
        (k / 10).alias("draught"),
        (F.pmod(e * 7, F.lit(190)) - 92).cast("double").alias("latitude"),
        (F.pmod(e * 13, F.lit(370)) - 182).cast("double").alias("longitude"),
        F.element_at(F.array(*map(F.lit, ("alpha", "beta", "gamma"))), (F.pmod(e, F.lit(3)) + 1).cast("int")).alias("source"),
        F.to_date("ts").alias("partition_date"),
    )


POSITIONS = """
v_positions AS (SELECT event_id, user_id AS mmsi, CASE WHEN user_id % 7 <> 0 THEN user_id + 9000000 END AS imo,
    'SHIP ' || CAST(user_id AS VARCHAR) AS vessel_name, ts AS timestamp, CASE WHEN event_type <> 'error' THEN event_type END AS destination,
    value AS sog, CAST((event_id * 17) % 400 AS DOUBLE) AS cog, CAST((event_id * 11) % 520 AS DOUBLE) AS heading,
    CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS draught, CAST((event_id * 7) % 190 - 92 AS DOUBLE) AS latitude,
    CAST((event_id * 13) % 370 - 182 AS DOUBLE) AS longitude, ['alpha', 'beta', 'gamma'][CAST(event_id % 3 AS INT) + 1] AS source,
    CAST(ts AS DATE) AS partition_date FROM events)"""


def vessels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vessel register with a second, later row for every fifth ship."""
    k = F.col("c_custkey")
    one = table(spark, sf_dir, "customer").select((k + 9_000_000).alias("imo"), k.alias("mmsi"), F.col("c_name").alias("vessel_name"), F.col("c_mktsegment").alias("vessel_type"), (1980 + F.pmod(k, F.lit(40))).cast("int").alias("year_built"), F.col("c_acctbal").alias("gross_tonnage"), F.lit(1).alias("ingest_seq"))
    two = one.where("mmsi % 5 = 0").withColumns({"vessel_name": F.concat("vessel_name", F.lit(" II")), "ingest_seq": F.lit(2)})
    return one.unionByName(two)


VESSELS = """
ves1 AS (SELECT c_custkey + 9000000 AS imo, c_custkey AS mmsi, c_name AS vessel_name, c_mktsegment AS vessel_type,
    CAST(1980 + c_custkey % 40 AS INT) AS year_built, c_acctbal AS gross_tonnage, 1 AS ingest_seq FROM customer),
v_vessels AS (SELECT * FROM ves1 UNION ALL SELECT imo, mmsi, vessel_name || ' II', vessel_type, year_built, gross_tonnage, 2 FROM ves1 WHERE mmsi % 5 = 0)"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Collector runs: source, time, rows, duration and status of each."""
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, sf_dir, "events").select(F.col("event_id").alias("run_id"), F.col("event_type").alias("source"), F.col("ts").alias("collection_ts"), k.alias("rows_written"), F.col("value").alias("duration_ms"), F.when(F.pmod("event_id", F.lit(11)) == 0, "error").otherwise("success").alias("status"))


RUNS = """
v_runs AS (SELECT event_id AS run_id, event_type AS source, ts AS collection_ts, CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_written,
    value AS duration_ms, CASE WHEN event_id % 11 = 0 THEN 'error' ELSE 'success' END AS status FROM events)"""


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily closes of two benchmarks; days on which either was not traded are missing."""
    price = lambda s: F.sum(F.when(F.col("l_returnflag").isin(*s), F.col("l_extendedprice"))) / F.sum(F.when(F.col("l_returnflag").isin(*s), F.col("l_quantity")))
    out = table(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("price_date")).agg(price("NR").alias("brent_usd"), price("A").alias("wti_usd"))
    return out.where("brent_usd IS NOT NULL AND wti_usd IS NOT NULL")


PRICES = """
v_prices AS (SELECT * FROM (SELECT CAST(l_shipdate AS DATE) AS price_date,
    sum(l_extendedprice) FILTER (WHERE l_returnflag IN ('N', 'R')) / sum(l_quantity) FILTER (WHERE l_returnflag IN ('N', 'R')) AS brent_usd,
    sum(l_extendedprice) FILTER (WHERE l_returnflag = 'A') / sum(l_quantity) FILTER (WHERE l_returnflag = 'A') AS wti_usd
  FROM lineitem GROUP BY 1) WHERE brent_usd IS NOT NULL AND wti_usd IS NOT NULL)"""


def with_views(body: str, *views: str) -> str:
    return "WITH " + ",\n".join(v.strip() for v in views) + body


def stored(df: DataFrame) -> DataFrame:
    """A small result that several later steps read, written to the shared folder and read back."""
    from .streams import shared

    path = shared(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def catalogue():  # noqa: ANN201
    """(queries, SQL, decorator): an empty catalogue of a module and the decorator that fills it."""
    queries, sql_of = {}, {}

    def query(name: str, sql: str | None = None):  # noqa: ANN202
        def add(f):  # noqa: ANN001, ANN202
            queries[name] = f
            if sql is not None:
                sql_of[name] = sql
            return f

        return add

    return queries, sql_of, query


def as_cte(name: str, sql: str, start: str) -> str:
    """A query's SQL, from where its own SELECT starts, as a named subquery."""
    return f"{name} AS ({sql[sql.index(start):]})"
