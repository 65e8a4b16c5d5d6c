"""Whole landed files to typed rows: code lists, oil trade, storms, sanctions, freight indices, prices, port volumes, metrics.

CSV files are read as text columns (quoted fields may hold line breaks) and
typed here; JSON and HTML payloads come one to a row.  What cannot be read is
null, rows without their key go, and no parser looks at the clock: a day to fall
back on is a parameter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.keyed import keep_one
from .parse import blank_to_null, imo_number, lenient

#: Columns of headerless files, names of codes, units of mass and volume, columns of price codes, months.
CODE_LIST = ["change", "country", "location", "name", "name_wo_diacritics", "subdiv", "function", "status", "entry_date", "iata", "coordinates", "remarks"]
SANCTIONS = ["ent_num", "sdn_name", "sdn_type", "program", "title", "call_sign", "vessel_type", "tonnage", "grt", "vessel_flag", "vessel_owner", "remarks"]
PRODUCTS = {
    "CRUDEOIL": "Crude oil",
    "NGL": "NGL",
    "OTHERCRUDE": "Other (refinery feedstocks + additives)",
    "TOTCRUDE": "Total primary",
    "LPG": "LPG",
    "NAPHTHA": "Naphtha",
    "GASOLINE": "Motor/aviation gasoline",
    "KEROSENE": "Kerosenes",
    "JETKERO": "Kerosene type jet fuel",
    "GASDIES": "Gas/diesel oil",
    "RESFUEL": "Fuel oil",
    "ONONSPEC": "Other oil products",
    "TOTPRODS": "Total oil products",
}
FLOWS = {
    "INDPROD": "Production",
    "TOTIMPSB": "Imports",
    "TOTEXPSB": "Exports",
    "REFINOBS": "Refinery intake",
    "REFGROUT": "Refinery output",
    "CLOSTLV": "Closing stocks",
    "TOTDEMO": "Demand",
    "STOCKCH": "Stock change",
}
MASS, VOLUME = ("KTONS",), ("KBBL", "KB", "CONVBBL")
BENCHMARKS = {"BRENT_CRUDE_USD": "brent_usd", "WTI_USD": "wti_usd", "DUBAI_CRUDE_USD": "dubai_usd"}
MONTHS = ["january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december"]


def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV file as text columns, with ``seq`` in the order of the file; without columns the first row names them."""
    reader = spark.read.options(multiLine=True, escape='"', header=columns is None, ignoreLeadingWhiteSpace=False)
    if columns is not None:
        reader = reader.schema(", ".join(f"{c} string" for c in columns))
    # a multi-line file is read by one task, whose rows are numbered as they come
    return reader.csv(path).withColumn("seq", F.struct(F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("row")))


def named(code: Column, names: dict[str, str]) -> Column:
    """The name of a code; a code without one is its own name."""
    table = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.coalesce(F.try_element_at(table, code), code)


def number(c: Column) -> Column:
    """A number with or without commas between thousands."""
    return lenient(F.replace(F.trim(c), F.lit(","), F.lit("")), "double")


def coordinate(token: Column) -> Column:
    """`DDMM` or `DDDMM` with a hemisphere, in degrees."""
    part = lambda i: F.regexp_extract(token, r"(?i)^(\d{2,3})(\d{2})([NSEW])$", i)
    degrees = lenient(part(1), "double") + lenient(part(2), "double") / 60
    return F.when(F.upper(part(3)).isin("S", "W"), -degrees).otherwise(degrees)


def code_list(rows: DataFrame) -> DataFrame:
    """Places of a code list: header rows of countries go, a code's first row counts, and places need a name.

    If either half of a position is impossible neither can be trusted.
    """
    trimmed = rows.select(*[F.trim(F.coalesce(c, F.lit(""))).alias(c) for c in CODE_LIST], "seq").where("location != ''")
    first = keep_one(trimmed.withColumn("_code", F.concat("country", "location")), ["_code"], [F.col("seq").asc()]).where("name != ''")
    tokens = F.split("coordinates", r"\s+")
    lat, lon = coordinate(F.get(tokens, F.lit(0))), coordinate(F.get(tokens, F.lit(1)))
    sane = ~F.coalesce(F.abs(lat) > 90, F.lit(False)) & ~F.coalesce(F.abs(lon) > 180, F.lit(False))
    none = lambda c: blank_to_null(F.col(c)).alias(c)
    return first.select(F.upper("_code").alias("unlocode"), F.col("name").alias("port_name"), F.upper("country").alias("country_code"), F.when(sane, lat).alias("latitude"), F.when(sane, lon).alias("longitude"), none("function").alias("function_class"), none("status"))


def oil_trade(rows: DataFrame) -> DataFrame:
    """Quantities by country, product and flow, under old or new column names.

    Placeholders for values are no zeros: their rows go, as do units that are
    neither mass nor volume.  Codes without a name keep the code.
    """
    have = set(rows.columns)
    either = lambda *names: F.coalesce(*[F.when(F.col(n) != "", F.col(n)) for n in names if n in have], F.lit(None).cast("string"))
    unit, code, flow = F.coalesce(either("UNIT_MEASURE", "UNIT"), F.lit("KTONS")), either("ENERGY_PRODUCT", "PRODUCT"), either("FLOW_BREAKDOWN")
    out = rows.select(either("TIME_PERIOD").alias("period"), either("REF_AREA", "REPORTING_COUNTRY").alias("reporting_country"), either("PARTNER_COUNTRY").alias("partner_country"), named(code, PRODUCTS).alias("product"), code.alias("product_code"), named(flow, FLOWS).alias("flow"), unit.alias("unit"), number(either("OBS_VALUE", "DATAVALUE")).alias("_q"))
    out = out.where(F.col("_q").isNotNull() & ~F.isnan("_q") & F.col("unit").isin(*MASS, *VOLUME))
    return out.withColumns({"quantity_ktonnes": F.when(F.col("unit").isin(*MASS), F.col("_q")), "quantity_barrels": F.when(F.col("unit").isin(*VOLUME), F.col("_q"))}).drop("_q")


def short_time(c: Column) -> Column:
    """`14-APR-26 19:10:00`; years from 70 on are of the last century."""
    shape = r"(?i)^\s*(\d{1,2})-([A-Z]{3})-(\d{2}) (\d{2}):(\d{2}):(\d{2})\s*$"
    part = lambda i: F.regexp_extract(c, shape, i)
    year = lenient(part(3), "int") + F.when(lenient(part(3), "int") < 70, 2000).otherwise(1900)
    month = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.lower(part(2))).cast("int")
    text = F.format_string("%04d-%02d-%02d %s:%s:%s", year, month, lenient(part(1), "int"), part(4), part(5), part(6))
    return F.when(c.rlike(shape) & (month > 0), F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss")))


def damage(c: Column) -> Column:
    """`10.00K`, `5M`, `1.0B` or plain dollars, in millions."""
    shape = r"(?i)^\s*([\d.,]+)([KMB])?\s*$"
    unit = F.upper(F.regexp_extract(c, shape, 2))
    factor = F.when(unit == "K", 1e-3).when(unit == "M", 1.0).when(unit == "B", 1e3).otherwise(1e-6)
    return F.when(c.rlike(shape), number(F.regexp_extract(c, shape, 1)) * factor)


def storms(rows: DataFrame) -> DataFrame:
    """Storm events with their times, place, casualties and damage."""
    text = lambda c: blank_to_null(F.col(c), "nan")
    whole = lambda c: F.floor(number(text(c))).cast("long")
    columns = {"event_id": text("EVENT_ID"), "event_type": text("EVENT_TYPE"), "begin_date": short_time(F.col("BEGIN_DATE_TIME")), "end_date": short_time(F.col("END_DATE_TIME")), "state": text("STATE"), "county": text("CZ_NAME"), "latitude": number(text("BEGIN_LAT")), "longitude": number(text("BEGIN_LON"))}
    columns |= {c.lower(): whole(c) for c in ("INJURIES_DIRECT", "INJURIES_INDIRECT", "DEATHS_DIRECT", "DEATHS_INDIRECT")}
    columns |= {"damage_property_millions": damage(F.col("DAMAGE_PROPERTY")), "damage_crops_millions": damage(F.col("DAMAGE_CROPS"))}
    return rows.select(*[c.alias(n) for n, c in columns.items()])


def sanctions(rows: DataFrame) -> DataFrame:
    """Listed entities; `-0-` is nothing.  A vessel's number is the one under the vessel label whose check digit is right."""
    text = lambda c: blank_to_null(F.col(c), "-0-")
    rows = rows.where(F.coalesce(F.trim("ent_num"), F.lit("")).rlike("(?i)^(?!ent_num$).+"))
    label = F.regexp_extract(text("remarks"), r"Vessel Registration Identification (IMO\s+\d{7})\b", 1)
    names = {"name": "sdn_name", "entity_type": "sdn_type", "programs": "program", "title": "title", "call_sign": "call_sign", "vessel_type": "vessel_type", "vessel_tonnage": "tonnage", "gross_registered_tonnage": "grt", "vessel_flag": "vessel_flag", "country": "vessel_owner", "remarks": "remarks"}
    return rows.select(F.col("ent_num").alias("entity_id"), *[text(c).alias(n) for n, c in names.items()], imo_number(label).alias("imo_number"))


INDEX = "struct<name: string, code: string, value: double, lane: string, containerType: string, date: string, publishedAt: string>"
PAYLOAD = f"timeframe: string, publishDate: string, publish_date: string, indices: array<{INDEX}>"


def iso_monday(c: Column) -> Column:
    """The Monday of `YYYY-WW`, `YYYY-Www` or `YYYYWW`; null for a week that the year does not have."""
    shape = r"^(\d{4})-?W?(\d{1,2})$"
    year, week = (lenient(F.regexp_extract(c, shape, i), "int") for i in (1, 2))
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    monday = F.date_add(first, (week - 1) * 7)
    return F.when(week.between(1, 53) & (F.year(F.date_add(monday, 3)) == year), monday)


def freight_indices(raw: DataFrame, fallback: str, text: str = "value") -> DataFrame:
    """Index readings of flat or wrapped payloads: the payload's week, else a reading's own day, else the fallback.

    A reading without a name goes by its code; a code is made of the name where
    it is missing.  Lanes read `origin - destination`.
    """
    p = raw.select(F.from_json(text, f"struct<{PAYLOAD}, data: struct<{PAYLOAD}>>").alias("p"))
    inner = F.col("p.data").isNotNull()
    of = lambda n: F.when(inner, F.col(f"p.data.{n}")).otherwise(F.col(f"p.{n}"))
    p = p.select(of("timeframe").alias("frame"), F.coalesce(of("publishDate"), of("publish_date")).alias("published"), F.explode(of("indices")).alias("x"))
    name = F.coalesce(F.when(F.col("x.name") != "", F.col("x.name")), F.col("x.code"))
    day = lambda c: F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd")
    lane = F.split(F.trim("x.lane"), r"\s+[-–>]+\s+")
    slug = F.regexp_replace(F.regexp_replace(name, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    out = p.where(F.col("x").isNotNull() & (name != "") & F.col("x.value").isNotNull())
    return out.select(
        F.coalesce(F.when(F.col("x.code") != "", F.col("x.code")), slug).alias("route_code"),
        F.when(F.col("frame") != "", F.concat(name, F.lit(" ("), F.col("frame"), F.lit(")"))).otherwise(name).alias("route_name"),
        blank_to_null(F.get(lane, F.lit(0))).alias("origin"),
        blank_to_null(F.get(lane, F.lit(1))).alias("destination"),
        F.col("x.containerType").alias("container_type"),
        F.col("x.value").alias("rate_usd"),
        F.coalesce(iso_monday(F.col("frame")), day(F.col("x.date")), day(F.col("x.publishedAt")), day(F.col("published")), F.lit(fallback).cast("date")).alias("rate_date"),
    )


PRICE = "code: string, price: double, updated_at: string, updatedAt: string"


def benchmark_prices(raw: DataFrame, fallback: str, order: str = "seq", text: str = "value") -> DataFrame:
    """A row per day with a column for each benchmark: the last reading of a code counts.

    Payloads hold one price or a list of them; other codes are left out.
    """
    p = raw.select(order, F.from_json(text, f"struct<data: struct<{PRICE}, prices: array<struct<{PRICE}>>>>")["data"].alias("d"))
    one = F.array(F.struct(*[F.col(f"d.{c}").alias(c) for c in ("code", "price", "updated_at", "updatedAt")]))
    each = p.select(order, F.posexplode(F.when(F.col("d.code").isNotNull(), one).otherwise(F.col("d.prices"))).alias("at", "x"))
    day = F.coalesce(F.try_to_date(F.substring(F.coalesce("x.updated_at", "x.updatedAt"), 1, 10), "yyyy-MM-dd"), F.lit(fallback).cast("date"))
    known = each.where(F.col("x.code").isin(*BENCHMARKS) & F.col("x.price").isNotNull())
    last = lambda code: F.max_by(F.when(F.col("x.code") == code, F.col("x.price")), F.when(F.col("x.code") == code, F.struct(order, "at")))
    return known.groupBy(day.alias("price_date")).agg(*[last(code).alias(column) for code, column in BENCHMARKS.items()])


def port_volumes(pages: DataFrame, text: str = "html", year: str = "year") -> DataFrame:
    """Monthly container volumes of yearly pages: table rows of nine cells or more whose first is a month.

    The total is the eighth cell, or else imports and exports together; a row
    without either goes.
    """
    tables = F.regexp_extract_all(F.col(text), F.lit(r"(?is)<table[^>]*>.*?</table>"), F.lit(0))
    rows = F.flatten(F.transform(tables, lambda t: F.regexp_extract_all(t, F.lit(r"(?is)<tr[^>]*>(.*?)</tr>"), F.lit(1))))
    each = pages.select(F.col(year).alias("_year"), F.explode(rows).alias("row"))
    plain = lambda c: F.trim(F.replace(F.replace(F.replace(F.regexp_replace(c, "<[^>]+>", ""), F.lit("&nbsp;"), F.lit(" ")), F.lit("&amp;"), F.lit("&")), F.lit(" "), F.lit(" ")))
    cells = F.transform(F.regexp_extract_all("row", F.lit(r"(?is)<t[dh][^>]*>(.*?)</t[dh]>"), F.lit(1)), plain)
    each = each.select("_year", cells.alias("c")).withColumn("month", F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(F.get("c", F.lit(0)))).cast("int")).where((F.size("c") >= 9) & (F.col("month") > 0))
    cell = lambda i: number(F.get("c", F.lit(i)))
    names = ["loaded_imports_teu", "empty_imports_teu", "total_imports_teu", "loaded_exports_teu", "empty_exports_teu", "total_exports_teu"]
    change = number(F.replace(F.replace(F.get("c", F.lit(8)), F.lit("%"), F.lit("")), F.lit("+"), F.lit("")))
    out = each.select(F.format_string("%04d-%02d", F.col("_year").cast("int"), "month").alias("period"), F.make_date(F.col("_year").cast("int"), "month", F.lit(1)).alias("period_date"), *[cell(i).alias(n) for i, n in enumerate(names, 1)], F.coalesce(cell(7), cell(3) + cell(6)).alias("total_teu"), change.alias("prior_year_change_pct"))
    return out.where("total_teu IS NOT NULL")


def port_metrics(resources: dict[str, tuple[DataFrame, str, str | None]]) -> DataFrame:
    """One long table of several resources: metric -> (rows, value column, category column or none).

    A period starts with its year, or the row goes; a blank category is ALL.
    """
    out = None
    for metric, (rows, value, category) in resources.items():
        have = set(rows.columns)
        period = F.trim(F.coalesce(*[F.col(c).cast("string") for c in ("month", "year") if c in have], F.lit("")))
        kind = F.coalesce(blank_to_null(F.col(category).cast("string")), F.lit("ALL")) if category else F.lit("ALL")
        one = rows.select(period.alias("metric_period"), lenient(F.regexp_extract(period, r"^(\d{4})", 1), "int").alias("metric_year"), F.lit(metric).alias("metric_name"), kind.alias("category"), number(F.col(value).cast("string")).alias("value"))
        one = one.where("metric_year IS NOT NULL AND value IS NOT NULL")
        out = one if out is None else out.unionByName(one)
    return out
