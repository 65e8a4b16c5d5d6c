"""Landed raw files to typed rows.

Each parser takes a frame of raw text (one payload a row, as ``spark.read.text``
with ``wholetext`` gives it, or all-string CSV columns) and uses column
functions only.  What cannot be read becomes null; rows without their key go.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def lenient(c: Column | str, kind: str) -> Column:
    """The value as `kind`, null if it is not one."""
    return (F.col(c) if isinstance(c, str) else c).try_cast(kind)


def blank_to_null(c: Column, *marks: str) -> Column:
    """Trimmed text; empty text and the given marks become null."""
    t = F.trim(c)
    return F.when(~t.isin("", *marks), t)


def padded(c: Column, n: int) -> Column:
    """A code with zeros before it up to n characters; longer codes stay whole."""
    return F.when(F.length(c) < n, F.lpad(c, n, "0")).otherwise(c)


def country_partners(rows: DataFrame, code: str) -> DataFrame:
    """Rows of single countries: codes of four digits that do not start with 0; totals and groups go."""
    return rows.where(F.col(code).rlike("^[1-9][0-9]{3}$"))


def tag(df: DataFrame, source: str, day: str) -> DataFrame:
    return df.withColumns({"source": F.lit(source), "partition_date": F.lit(day).cast("date")})


def geojson_positions(raw: DataFrame, text: str = "value") -> DataFrame:
    """Feature collections to positions: longitude first, numbers and times lenient."""
    schema = "features array<struct<geometry: struct<coordinates: array<double>>, properties: struct<mmsi: string, imo: string, name: string, timestamp: string>>>"
    f = raw.select(F.explode(F.from_json(text, schema)["features"]).alias("f"))
    p = F.col("f.properties")
    return f.select(lenient(p["mmsi"], "bigint").alias("mmsi"), lenient(p["imo"], "bigint").alias("imo"), p["name"].alias("vessel_name"), F.get(F.col("f.geometry.coordinates"), F.lit(1)).alias("latitude"), F.get(F.col("f.geometry.coordinates"), F.lit(0)).alias("longitude"), F.try_to_timestamp(p["timestamp"]).alias("timestamp"))


AIS = "MessageType string, MetaData struct<MMSI: bigint, ShipName: string, time_utc: string>, Message struct<PositionReport: struct<Latitude: double, Longitude: double, Sog: double>, ShipStaticData: struct<ImoNumber: bigint, Dimension: struct<A: double, B: double, C: double, D: double>>>"


def ais_messages(raw: DataFrame, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Message envelopes to (positions, vessel data); zero means unknown in dimensions and numbers."""
    m = raw.select(F.from_json(text, AIS).alias("m")).select("m.*")
    time = F.try_to_timestamp(F.regexp_extract("MetaData.time_utc", r"^(\d{4}-\d\d-\d\d \d\d:\d\d:\d\d(?:\.\d{1,6})?)", 1))
    key = [F.col("MetaData.MMSI").alias("mmsi"), F.trim("MetaData.ShipName").alias("vessel_name"), time.alias("timestamp")]
    r, s = F.col("Message.PositionReport"), F.col("Message.ShipStaticData")
    size = lambda a, b: F.when(s["Dimension"][a] + s["Dimension"][b] != 0, s["Dimension"][a] + s["Dimension"][b])
    positions = m.where("MessageType = 'PositionReport'").select(*key, r["Latitude"].alias("latitude"), r["Longitude"].alias("longitude"), r["Sog"].alias("sog"))
    vessels = m.where("MessageType = 'ShipStaticData'").select(*key, F.when(s["ImoNumber"] != 0, s["ImoNumber"]).alias("imo"), size("A", "B").alias("length_m"), size("C", "D").alias("beam_m"))
    return positions, vessels


def locode_point(text: Column) -> tuple[Column, Column]:
    """`DDMM[NS] DDDMM[EW]` as degrees; both null if either part is impossible."""
    part = lambda i: F.regexp_extract(text, r"^\s*(\d{2})(\d{2})([NS])\s+(\d{3})(\d{2})([EW])\s*$", i)
    degrees = lambda d, m, s, minus: (lenient(part(d), "double") + lenient(part(m), "double") / 60) * F.when(part(s) == minus, -1.0).otherwise(1.0)
    lat, lon = degrees(1, 2, 3, "S"), degrees(4, 5, 6, "W")
    ok = (F.abs(lat) <= 90) & (F.abs(lon) <= 180) & (lenient(part(2), "int") < 60) & (lenient(part(5), "int") < 60)
    return F.when(ok, lat), F.when(ok, lon)


def millis_text(c: Column) -> Column:
    """Whether a text reads as a whole number, as casts read it."""
    return c.rlike(r"^[\x00-\x20]*[+-]?\d+[\x00-\x20]*$")


def any_date(c: Column) -> Column:
    """A day from epoch milliseconds, `YYYY-MM-DD` or `YYYY/MM/DD`.

    A text that fails to parse costs an exception, so only digits meet the cast, and only texts with its own separator a pattern.
    """
    millis = F.when(millis_text(c), lenient(c, "bigint"))
    at = lambda sep: F.when(c.contains(sep), F.try_to_date(c, f"yyyy{sep}MM{sep}dd"))
    return F.coalesce(F.to_date(F.timestamp_millis(millis)), at("-"), at("/"))


def arcgis_features(raw: DataFrame, fields: dict[str, tuple[str, str]], keys: list[str], text: str = "value") -> DataFrame:
    """Feature attributes by a map target -> (source name, type); `date` reads any of the date shapes; null keys go."""
    f = raw.select(F.explode(F.from_json(text, "features array<struct<attributes: map<string, string>>>")["features"]).alias("f"))
    cell = lambda name, kind: any_date(F.col("f.attributes")[name]) if kind == "date" else lenient(F.col("f.attributes")[name], kind)
    out = f.select(*[cell(n, k).alias(target) for target, (n, k) in fields.items()])
    return out.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))


def census_matrix(raw: DataFrame, columns: dict[str, str], text: str = "value") -> DataFrame:
    """A list of lists whose first row names the columns; the first of equal names counts; `-` is null."""
    rows = raw.select(F.from_json(text, "array<array<string>>").alias("r")).select(F.get("r", F.lit(0)).alias("head"), F.explode(F.slice("r", 2, 10_000_000)).alias("row"))
    at = lambda name: F.get(F.col("row"), (F.array_position("head", name) - 1).cast("int"))
    cell = lambda name, kind: F.when(F.array_contains("head", name), lenient(blank_to_null(at(name), "-"), kind))
    return rows.select(*[cell(n, k).alias(n) for n, k in columns.items()])


def route_units(df: DataFrame, value: str = "value", unit: str = "unit") -> DataFrame:
    """Placeholders go; thousand tonnes and thousand barrels get a column each; other units go."""
    number = lenient(blank_to_null(F.col(value), "x", "-", "na"), "double")
    out = df.withColumn("_n", number).where(F.col("_n").isNotNull() & F.col(unit).isin("KTONS", "KBBL"))
    return out.withColumns({"quantity_ktonnes": F.when(F.col(unit) == "KTONS", F.col("_n")), "quantity_barrels": F.when(F.col(unit) == "KBBL", F.col("_n") * 1000)}).drop("_n")


def jsonstat(raw: DataFrame, text: str = "value") -> DataFrame:
    """Sparse value maps with a mixed-radix index to one row per observation: one code per dimension."""
    schema = "id array<string>, size array<int>, value map<string, double>, codes array<array<string>>"
    j = raw.select(F.from_json(text, schema).alias("j")).select("j.*")
    each = j.select("id", "size", "codes", F.explode("value").alias("k", "obs")).withColumn("k", lenient("k", "bigint"))
    after = lambda i: F.aggregate(F.slice("size", i + 2, F.size("size")), F.lit(1).cast("bigint"), lambda a, x: a * x)
    code = F.transform("id", lambda name, i: F.get(F.get("codes", i), (F.pmod(F.floor(F.col("k") / after(i)), F.get("size", i))).cast("int")))
    return each.select(F.map_from_arrays("id", code).alias("codes"), "obs")


def last_vintage(df: DataFrame, vintages: list[str]) -> Column:
    """The right-most numeric cell of a row."""
    cells = F.array(*[lenient(blank_to_null(F.col(c), "#N/A"), "double") for c in vintages])
    known = F.filter(cells, lambda x: x.isNotNull())
    return F.try_element_at(known, F.lit(-1))


def damage_musd(c: Column) -> Column:
    """`10.00K`, `5M`, `1.0B` in millions of dollars."""
    unit = F.upper(F.regexp_extract(c, r"([KMBkmb])\s*$", 1))
    return lenient(F.regexp_extract(c, r"^\s*([\d.]+)", 1), "double") * F.when(unit == "K", 0.001).when(unit == "M", 1.0).when(unit == "B", 1000.0).otherwise(0.000001)


def imo_number(text: Column) -> Column:
    """The seven-digit IMO number in a text if its check digit is right."""
    digits = F.regexp_extract(text, r"(?i)IMO\s*:?\s*(\d{7})", 1)
    total = F.aggregate(F.sequence(F.lit(1), F.lit(6)), F.lit(0), lambda a, i: a + F.substring(digits, i, F.lit(1)).try_cast("int") * (8 - i))
    return F.when((digits != "") & (total % 10 == F.substring(digits, 7, 1).try_cast("int")), digits.try_cast("bigint"))


def iso_week_monday(c: Column) -> Column:
    """The Monday of an ISO week written `YYYY-WW`."""
    year, week = (lenient(F.regexp_extract(c, r"^(\d{4})-W?(\d{1,2})$", i), "int") for i in (1, 2))
    return F.date_add(F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week"), (week - 1) * 7)


def zip_hours(raw: DataFrame, series: list[str], text: str = "value") -> DataFrame:
    """Parallel hourly arrays to one row per hour; short arrays leave nulls."""
    h = raw.select(F.from_json(text, "hourly struct<time: array<string>, " + ", ".join(f"{s}: array<double>" for s in series) + ">")["hourly"].alias("h"))
    z = h.select(F.explode(F.arrays_zip(F.col("h.time").alias("time"), *[F.col(f"h.{s}").alias(s) for s in series])).alias("z"))
    return z.select(F.try_to_timestamp("z.time").alias("timestamp"), *[f"z.{s}" for s in series])


def html_cells(raw: DataFrame, text: str) -> DataFrame:
    """(row, cell, tag, text): every heading, paragraph, link and table cell of a page, without its own markup."""
    body = F.regexp_replace(F.col(text), r"(?is)<(script|style)\b.*?</\1\s*>", " ")
    parts = F.regexp_extract_all(body, F.lit(r"(?is)<(h[1-6]|p|td|th|a)\b[^>]*>.*?</\1\s*>"), F.lit(0))
    each = raw.select("*", F.posexplode(parts).alias("cell", "part"))
    clean = F.trim(F.regexp_replace(F.regexp_replace("part", r"(?s)<[^>]*>", " "), r"\s+", " "))
    return each.withColumns({"tag": F.lower(F.regexp_extract("part", r"^<(\w+)", 1)), "cell_text": clean}).drop("part", text)
