"""Whole landed files, written from the test tables and parsed again, with the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import files as fi
from . import views as v
from .streams import shared

QUERIES, ORACLE_SQL, query = v.catalogue()


def landed_csv(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """The rows as CSV files, read again as text; quotes and line breaks are inside quotes."""
    path = shared(df.sparkSession)
    df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.options(header=columns is None, quoteAll=True, escape='"').csv(path)
    return fi.read_csv(df.sparkSession, path, columns)


def two(c: Column, n: int = 2) -> Column:
    return F.lpad(c.cast("string"), n, "0")


@query("parse_locode", """SELECT upper(code) AS unlocode, port_name, upper(country) AS country_code, CASE WHEN sane THEN lat END AS latitude, CASE WHEN sane THEN lon END AS longitude, function_class, status FROM (
  SELECT *, country || location AS code, coalesce(abs(lat) <= 90, true) AND coalesce(abs(lon) <= 180, true) AS sane, row_number() OVER (PARTITION BY country, location ORDER BY p_partkey) AS r FROM (
    SELECT p_partkey, chr(CAST(97 + p_partkey % 13 AS INT)) || 'X' AS country, 'L' || lpad(CAST(p_partkey % 140 AS VARCHAR), 2, '0') AS location, CASE WHEN p_partkey % 9 <> 0 THEN p_name END AS port_name,
      (p_partkey % 95 + p_partkey % 63 / 60.0) * CASE WHEN p_partkey % 2 = 0 THEN -1 ELSE 1 END AS lat, CASE WHEN p_partkey % 4 <> 0 THEN (p_partkey * 7 % 190 + p_partkey % 61 / 60.0) * CASE WHEN p_partkey % 3 = 0 THEN -1 ELSE 1 END END AS lon,
      '1--' || CAST(p_size AS VARCHAR) AS function_class, CASE WHEN p_partkey % 5 <> 0 THEN 'AI' END AS status FROM part WHERE p_partkey % 11 <> 0)) WHERE r = 1 AND port_name IS NOT NULL""")
def parse_locode(spark: SparkSession, sf: str) -> DataFrame:
    """Places with header rows of countries, repeated codes, nameless rows and impossible positions among them."""
    k = F.col("p_partkey")
    lat = F.concat(two(k % 95), two(k % 63), F.when(k % 2 == 0, "S").otherwise("N"))
    lon = F.concat(two(k * 7 % 190, 3), two(k % 61), F.when(k % 3 == 0, "W").otherwise("E"))
    cells = {
        "change": F.lit("+"),
        "country": F.concat(F.char(97 + k % 13), F.lit("X")),
        "location": F.when(k % 11 == 0, " ").otherwise(F.concat(F.lit("L"), F.lpad((k % 140).cast("string"), 2, "0"))),
        "name": F.when(k % 9 == 0, "").otherwise(F.concat(F.lit(" "), "p_name")),
        "name_wo_diacritics": F.lit('a "b"\nc'),
        "subdiv": F.lit(""),
        "function": F.concat(F.lit("1--"), F.col("p_size").cast("string")),
        "status": F.when(k % 5 == 0, "").otherwise("AI"),
        "entry_date": F.lit("0601"),
        "iata": F.lit(""),
        "coordinates": F.when(k % 4 == 0, lat).otherwise(F.concat_ws(" ", lat, lon)),
        "remarks": F.lit("x, y"),
    }
    rows = v.table(spark, sf, "part").coalesce(1).sortWithinPartitions("p_partkey")  # one file, as it is released
    return fi.code_list(landed_csv(rows.select(*[c.alias(n) for n, c in cells.items()]), fi.CODE_LIST))


@query("parse_oil_trade_csv", """SELECT strftime(l_shipdate, '%Y-%m') AS period, 'C' || CAST(l_suppkey % 30 AS VARCHAR) AS reporting_country, CASE WHEN l_linenumber % 2 = 0 THEN 'WORLD' END AS partner_country,
  CASE l_partkey % 3 WHEN 0 THEN 'Crude oil' WHEN 1 THEN 'Gas/diesel oil' ELSE 'PEAT' END AS product, CASE l_partkey % 3 WHEN 0 THEN 'CRUDEOIL' WHEN 1 THEN 'GASDIES' ELSE 'PEAT' END AS product_code,
  CASE l_returnflag WHEN 'A' THEN 'Imports' WHEN 'N' THEN 'Exports' ELSE 'OTHER' END AS flow, CASE l_suppkey % 4 WHEN 0 THEN 'KTONS' WHEN 1 THEN 'KBBL' ELSE 'CONVBBL' END AS unit,
  CASE WHEN l_suppkey % 4 = 0 THEN l_extendedprice END AS quantity_ktonnes, CASE WHEN l_suppkey % 4 IN (1, 2) THEN l_extendedprice END AS quantity_barrels FROM lineitem WHERE l_suppkey % 4 <> 3 AND l_linenumber <> 3""")
def parse_oil_trade_csv(spark: SparkSession, sf: str) -> DataFrame:
    """A file under the old column names and one under the new."""
    lines, part, supp = v.table(spark, sf, "lineitem"), F.col("l_partkey"), F.col("l_suppkey")
    value = F.when(F.col("l_linenumber") == 3, F.when(supp % 2 == 0, "x").otherwise("-")).otherwise(F.format_number("l_extendedprice", 2))
    code = F.when(part % 3 == 0, "CRUDEOIL").when(part % 3 == 1, "GASDIES").otherwise("PEAT")
    flow = F.when(F.col("l_returnflag") == "A", "TOTIMPSB").when(F.col("l_returnflag") == "N", "TOTEXPSB").otherwise("OTHER")
    unit = F.when(supp % 4 == 0, "KTONS").when(supp % 4 == 1, "KBBL").when(supp % 4 == 2, "CONVBBL").otherwise("KBD")
    shared_cells = {"TIME_PERIOD": F.date_format("l_shipdate", "yyyy-MM"), "PARTNER_COUNTRY": F.when(F.col("l_linenumber") % 2 == 0, "WORLD"), "FLOW_BREAKDOWN": flow}
    old = {"REPORTING_COUNTRY": "country", "PRODUCT": "code", "UNIT": "unit", "DATAVALUE": "value"}
    new = {"REF_AREA": "country", "ENERGY_PRODUCT": "code", "UNIT_MEASURE": "unit", "OBS_VALUE": "value"}
    cells = {"country": F.concat(F.lit("C"), (supp % 30).cast("string")), "code": code, "unit": unit, "value": value}
    file = lambda names, half: landed_csv(lines.where(F.col("l_orderkey") % 2 == half).select(*[c.alias(n) for n, c in shared_cells.items()], *[cells[c].alias(n) for n, c in names.items()]))
    return fi.oil_trade(file(old, 0)).unionByName(fi.oil_trade(file(new, 1)))


WHEN = "(TIMESTAMP '1960-01-01' + INTERVAL 1 DAY * (c_custkey * 37 % 40000) + INTERVAL 1 SECOND * (c_custkey * 101 % 86400))"


@query("parse_storm_csv", f"""SELECT CAST(c_custkey AS VARCHAR) AS event_id, c_mktsegment AS event_type, CASE WHEN extract(year FROM b) < 1970 THEN b + INTERVAL 100 YEAR ELSE b END AS begin_date, NULL::TIMESTAMP AS end_date, CASE WHEN c_custkey % 4 <> 0 THEN 'S ' || CAST(c_nationkey AS VARCHAR) END AS state, c_name AS county,
  CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 90 / 2.0 END AS latitude, 1.5 * (c_custkey % 90) - 170 AS longitude, c_custkey % 7 AS injuries_direct, NULL::BIGINT AS injuries_indirect, 1000 + c_custkey % 3 AS deaths_direct, CASE WHEN c_custkey % 2 = 0 THEN 0 END AS deaths_indirect,
  CASE c_custkey % 4 WHEN 0 THEN c_custkey % 90 * 0.001 WHEN 1 THEN c_custkey % 90 * 1.0 WHEN 2 THEN c_custkey % 90 * 1000.0 ELSE c_custkey % 90 * 0.000001 END AS damage_property_millions, CASE WHEN c_custkey % 3 = 0 THEN 1234.5 * 0.001 END AS damage_crops_millions FROM (SELECT *, {WHEN} AS b FROM customer)""")
def parse_storm_csv(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    begin = F.expr("timestamp_ntz'1960-01-01 00:00:00' + make_dt_interval(CAST(c_custkey * 37 % 40000 AS INT), 0, 0, CAST(c_custkey * 101 % 86400 AS INT))")
    cells = {
        "EVENT_ID": k,
        "EVENT_TYPE": F.concat("c_mktsegment", F.lit(" ")),
        "BEGIN_DATE_TIME": F.upper(F.date_format(begin, "dd-MMM-yy HH:mm:ss")),
        "END_DATE_TIME": F.when(k % 2 == 0, "31-FEB-99 10:00:00").otherwise("soon"),
        "STATE": F.when(k % 4 == 0, " ").otherwise(F.concat(F.lit("S "), F.col("c_nationkey").cast("string"))),
        "CZ_NAME": F.col("c_name"),
        "EPISODE_NARRATIVE": F.lit('It said "run",\nand 1,000 did.'),
        "BEGIN_LAT": F.when(k % 5 == 0, "").otherwise((k % 90 / 2).cast("string")),
        "BEGIN_LON": (k % 90 * 1.5 - 170).cast("string"),
        "INJURIES_DIRECT": (k % 7).cast("string"),
        "INJURIES_INDIRECT": F.lit("nan"),
        "DEATHS_DIRECT": F.concat(F.lit("1,00"), (k % 3).cast("string")),
        "DEATHS_INDIRECT": F.when(k % 2 == 0, "0").otherwise("none"),
        "DAMAGE_PROPERTY": F.concat((k % 90).cast("string"), F.when(k % 4 == 0, ".00K").when(k % 4 == 1, "m").when(k % 4 == 2, ".0B").otherwise("")),
        "DAMAGE_CROPS": F.when(k % 3 == 0, "1,234.5K").when(k % 3 == 1, "5T").otherwise(""),
    }
    out = fi.storms(landed_csv(v.table(spark, sf, "customer").select(*[c.alias(n) for n, c in cells.items()])))
    return out.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("begin_date", "end_date")})


CHECKED = "(9 * 7 + n // 100000 % 10 * 6 + n // 10000 % 10 * 5 + n // 1000 % 10 * 4 + n // 100 % 10 * 3 + n // 10 % 10 * 2) % 10 = n % 10"


@query("parse_sanctions_csv", f"""SELECT CAST(c_custkey AS VARCHAR) AS entity_id, c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN 'vessel' END AS entity_type, 'SDGT' AS programs, NULL::VARCHAR AS title, CASE WHEN c_custkey % 5 <> 0 THEN 'CS' || CAST(c_custkey AS VARCHAR) END AS call_sign, c_mktsegment AS vessel_type, CAST(c_custkey % 900 AS VARCHAR) AS vessel_tonnage,
  NULL::VARCHAR AS gross_registered_tonnage, 'N' || CAST(c_nationkey AS VARCHAR) AS vessel_flag, NULL::VARCHAR AS country, remarks, CASE WHEN c_custkey % 3 <> 0 AND {CHECKED} THEN n END AS imo_number
  FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'Identification Number IMO ' ELSE 'Secondary; Vessel Registration Identification IMO  ' END || CAST(n AS VARCHAR) || '; a "note"' AS remarks FROM (SELECT *, 9000000 + c_custkey * 13 AS n FROM customer)) WHERE c_custkey % 17 <> 0""")
def parse_sanctions_csv(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("c_custkey")
    label = F.when(k % 3 == 0, "Identification Number IMO ").otherwise("Secondary; Vessel Registration Identification IMO  ")
    none = F.lit("-0- ")
    cells = [F.when(k % 17 == 0, F.when(k % 2 == 0, "ent_num").otherwise(" ")).otherwise(k.cast("string")), F.col("c_name"), F.when(k % 2 == 0, "vessel").otherwise("-0-"), F.lit("SDGT"), none, F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("CS"), k.cast("string"))), F.col("c_mktsegment"), (k % 900).cast("string"), none, F.concat(F.lit("N"), F.col("c_nationkey").cast("string")), none, F.concat(label, (9_000_000 + k * 13).cast("string"), F.lit('; a "note"'))]
    rows = v.table(spark, sf, "customer").select(*[c.alias(n) for c, n in zip(cells, fi.SANCTIONS, strict=True)])
    return fi.sanctions(landed_csv(rows, fi.SANCTIONS))


BLOCK = 500
FREIGHT = f"""fr0 AS (SELECT *, o_orderkey // {BLOCK} AS b, CASE WHEN o_orderkey % 4 <> 0 THEN 'Lane ' || CAST(o_custkey % 7 AS VARCHAR) || '!' END AS nm, CASE WHEN o_orderkey % 5 <> 0 THEN 'L' || CAST(o_custkey % 7 AS VARCHAR) END AS cd FROM orders),
fr1 AS (SELECT *, coalesce(nm, cd) AS name, CASE b % 3 WHEN 0 THEN CAST(2000 + b % 5 AS VARCHAR) || '-' || lpad(CAST(b % 54 AS VARCHAR), 2, '0') END AS frame, CAST(date_trunc('week', make_date(CAST(2000 + b % 5 AS INT), 1, 4)) AS DATE) + CAST(7 * (b % 54 - 1) AS INT) AS monday FROM fr0)"""


@query("parse_freight_index", v.with_views("""SELECT coalesce(cd, 'Lane_' || CAST(o_custkey % 7 AS VARCHAR)) AS route_code, name || coalesce(' (' || frame || ')', '') AS route_name, CASE o_orderkey % 3 WHEN 0 THEN 'Shanghai' WHEN 1 THEN 'Los Angeles' END AS origin, CASE o_orderkey % 3 WHEN 0 THEN 'New York' END AS destination, o_orderpriority AS container_type, o_totalprice AS rate_usd,
  CASE WHEN frame IS NOT NULL AND b % 54 > 0 AND extract(isoyear FROM monday) = 2000 + b % 5 THEN monday WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate AS DATE) WHEN b % 2 = 0 THEN DATE '2010-05-06' ELSE DATE '2001-01-01' END AS rate_date FROM fr1 WHERE name IS NOT NULL AND o_orderkey % 11 <> 0""", FREIGHT))
def parse_freight_index(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads, flat and wrapped, with and without a week; some weeks do not exist."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    b = F.floor(k / BLOCK)
    lane = F.when(k % 3 == 0, "Shanghai – New York").when(k % 3 == 1, "Los Angeles").otherwise(" ")
    reading = F.struct(
        F.when(k % 4 == 0, "").otherwise(F.concat(F.lit("Lane "), (c % 7).cast("string"), F.lit("!"))).alias("name"),
        F.when(k % 5 != 0, F.concat(F.lit("L"), (c % 7).cast("string"))).alias("code"),
        F.when(k % 11 != 0, F.col("o_totalprice")).alias("value"),
        lane.alias("lane"),
        F.col("o_orderpriority").alias("containerType"),
        F.when(k % 7 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm")).alias("date"),
    )
    frame = F.when(b % 3 == 0, F.concat((2000 + b % 5).cast("string"), F.lit("-"), two(b % 54)))
    groups = v.table(spark, sf, "orders").groupBy(b.alias("b")).agg(F.collect_list(reading).alias("indices"), F.first(frame).alias("timeframe"))
    day = F.when(F.col("b") % 2 == 0, "2010-05-06")
    flat = F.to_json(F.struct("timeframe", day.alias("publishDate"), "indices"))
    wrapped = F.to_json(F.struct(F.struct("timeframe", day.alias("publish_date"), "indices").alias("data")))
    return fi.freight_indices(groups.select(F.when(F.col("b") % 4 < 2, flat).otherwise(wrapped).alias("value")), "2001-01-01")


LAST = ", ".join(f"arg_max(o_totalprice, (o_orderkey // {BLOCK}, o_orderkey % 50 = 0, o_orderkey)) FILTER (WHERE o_orderstatus = '{s}') AS {c}" for s, c in (("F", "brent_usd"), ("O", "wti_usd")))


@query("pivot_price_codes", f"SELECT CASE WHEN o_orderkey % 29 = 0 THEN DATE '2001-01-01' ELSE CAST(o_orderdate AS DATE) END AS price_date, {LAST}, NULL::DOUBLE AS dubai_usd FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderstatus <> 'P' GROUP BY 1")
def pivot_price_codes(spark: SparkSession, sf: str) -> DataFrame:
    """Payloads of lists, and single prices that come after the list of their block."""
    k = F.col("o_orderkey")
    code = F.when(F.col("o_orderstatus") == "F", "BRENT_CRUDE_USD").when(F.col("o_orderstatus") == "O", "WTI_USD").otherwise("COPPER")
    price = F.struct(code.alias("code"), F.when(k % 13 != 0, F.col("o_totalprice")).alias("price"), F.when(k % 29 == 0, "never").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("updated_at"))
    orders, block = v.table(spark, sf, "orders"), F.floor(k / BLOCK)
    lists = orders.where(k % 50 != 0).groupBy(block.alias("b")).agg(F.transform(F.array_sort(F.collect_list(F.struct(k.alias("k"), price.alias("p")))), lambda x: x["p"]).alias("prices"))
    lists = lists.select(F.struct("b", F.lit(0).cast("long").alias("k")).alias("seq"), F.to_json(F.struct(F.struct("prices").alias("data"))).alias("value"))
    single = orders.where(k % 50 == 0).select(F.struct(block.alias("b"), (k + 1).alias("k")).alias("seq"), F.to_json(F.struct(price.alias("data"))).alias("value"))
    return fi.benchmark_prices(lists.unionByName(single), "2001-01-01")


TEU = """teu AS (SELECT extract(year FROM l_shipdate) AS y, extract(month FROM l_shipdate) AS m, sum(l_quantity) FILTER (WHERE l_linestatus = 'F' AND l_returnflag = 'A') AS a, sum(l_quantity) FILTER (WHERE l_linestatus = 'F' AND l_returnflag <> 'A') AS b,
  sum(l_quantity) FILTER (WHERE l_linestatus = 'F') AS ab, sum(l_quantity) FILTER (WHERE l_linestatus = 'O' AND l_returnflag = 'A') AS c, sum(l_quantity) FILTER (WHERE l_linestatus = 'O' AND l_returnflag <> 'A') AS d, sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS cd, sum(l_quantity) AS t FROM lineitem GROUP BY 1, 2)"""


@query("parse_html_tables", v.with_views("SELECT format('{:04d}-{:02d}', y, m) AS period, make_date(y, m, 1) AS period_date, a AS loaded_imports_teu, b AS empty_imports_teu, ab AS total_imports_teu, c AS loaded_exports_teu, d AS empty_exports_teu, cd AS total_exports_teu, CASE WHEN m % 4 = 0 THEN ab + cd ELSE t END AS total_teu, CASE WHEN m % 3 <> 0 THEN m / 4.0 - 1 END AS prior_year_change_pct FROM teu WHERE CASE WHEN m % 4 = 0 THEN ab + cd ELSE t END IS NOT NULL", TEU))
def parse_html_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Yearly pages of monthly volumes, with markup in cells, rows of other kinds and missing totals."""
    f, a, q = F.col("l_linestatus") == "F", F.col("l_returnflag") == "A", F.col("l_quantity")
    of = lambda c: F.sum(F.when(c, q))
    sums = v.table(spark, sf, "lineitem").groupBy(F.year("l_shipdate").alias("year"), F.month("l_shipdate").alias("m")).agg(of(f & a).alias("c1"), of(f & ~a).alias("c2"), of(f).alias("c3"), of(~f & a).alias("c4"), of(~f & ~a).alias("c5"), of(~f).alias("c6"), F.sum(q).alias("c7"))
    cell = lambda c: F.concat(F.lit("<td class=x>"), F.coalesce(c, F.lit("&nbsp;")), F.lit("</TD>"))
    name = F.get(F.array(*[F.lit(m.title()) for m in fi.MONTHS]), F.col("m") - 1)
    change = F.when(F.col("m") % 3 != 0, F.concat(F.when(F.col("m") > 4, "+").otherwise(""), (F.col("m") / 4 - 1).cast("string"), F.lit("%"))).otherwise("n/a")
    cells = [F.concat(F.lit("<b>"), name, F.lit("</b>")), *[F.format_number(f"c{i}", 2) for i in range(1, 7)], F.when(F.col("m") % 4 == 0, "-").otherwise(F.format_number("c7", 2)), change]
    row = F.concat(F.lit("<tr>\n"), *[cell(c) for c in cells], F.lit("</tr>"))
    pages = sums.groupBy("year").agg(F.concat(F.lit("<html><table border=1><tr><th>Month</th><th>x</th></tr>"), F.array_join(F.array_sort(F.collect_list(row)), "\n"), F.lit("<tr><td>Total</td></tr></table><table></table></html>")).alias("html"))  # twelve rows each
    return fi.port_volumes(pages)


@query("unify_metrics", """SELECT CAST(extract(year FROM o_orderdate) AS VARCHAR) AS metric_period, CAST(extract(year FROM o_orderdate) AS INT) AS metric_year, 'vessel_calls' AS metric_name, CASE WHEN o_orderstatus = 'P' THEN 'ALL' ELSE o_orderstatus END AS category, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2, 4
 UNION ALL SELECT CAST(extract(year FROM o_orderdate) AS VARCHAR), CAST(extract(year FROM o_orderdate) AS INT), 'vessel_arrivals', 'ALL', 1000.0 + count(*) % 1000 FROM orders WHERE extract(year FROM o_orderdate) % 2 = 0 GROUP BY 1, 2
 UNION ALL SELECT strftime(l_shipdate, '%Y-%m'), CAST(extract(year FROM l_shipdate) AS INT), 'registered_vessels', 'ALL', count(*) / 4.0 FROM lineitem GROUP BY 1, 2""")
def unify_metrics(spark: SparkSession, sf: str) -> DataFrame:
    orders = v.table(spark, sf, "orders")
    year = F.year("o_orderdate").cast("string").alias("year")
    kind = F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus"))
    calls = orders.groupBy(year, kind.alias("purpose_type")).agg(F.count("*").cast("string").alias("number_of_vessel_calls"))
    odd = F.when(F.year("o_orderdate") % 2 == 1, F.concat(F.lit("y"), F.year("o_orderdate").cast("string"))).otherwise(F.year("o_orderdate").cast("string"))
    arrivals = orders.groupBy(odd.alias("year")).agg(F.format_number(1000 + F.count("*") % 1000, 0).alias("number_of_vessels"))
    months = v.table(spark, sf, "lineitem").groupBy(F.date_format("l_shipdate", "yyyy-MM").alias("month")).agg((F.count("*") / 4).cast("string").alias("number_of_vessels"))
    return fi.port_metrics({"vessel_calls": (calls, "number_of_vessel_calls", "purpose_type"), "vessel_arrivals": (arrivals, "number_of_vessels", None), "registered_vessels": (months, "number_of_vessels", None)})
