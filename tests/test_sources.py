"""Parsers on odd payloads."""

import datetime as dt

from pyspark.sql import functions as F

from harborline.sources import feeds as fe
from harborline.sources import parse as ps


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "value string").select(column.alias("x")).head()["x"]


def test_scalars(spark):
    v = F.col("value")
    assert one(spark, "2026-01", ps.iso_week_monday(v)) == dt.date(2025, 12, 29)
    assert one(spark, "2026-W33", ps.iso_week_monday(v)) == dt.date(2026, 8, 10)
    assert one(spark, "soon", ps.iso_week_monday(v)) is None
    assert one(spark, "vessel IMO 9074729; x", ps.imo_number(v)) == 9074729
    assert one(spark, "vessel IMO 9074728; x", ps.imo_number(v)) is None
    assert [one(spark, t, ps.damage_musd(v)) for t in ("10.00K", "5M", "1.0B", "")] == [0.01, 5.0, 1000.0, None]
    assert one(spark, "1704067200000", ps.any_date(v)) == one(spark, "2024/01/01", ps.any_date(v)) == dt.date(2024, 1, 1)
    assert one(spark, " -0- ", ps.blank_to_null(v, "-0-")) is None
    lat, lon = ps.locode_point(v)
    assert (one(spark, "5155N 00430E", lat), one(spark, "5155N 00430E", lon)) == (51 + 55 / 60, 4.5)
    assert one(spark, "9100N 00430E", lat) is None and one(spark, "9100N 00430E", lon) is None


def test_broken_payloads_give_no_rows(spark):
    raw = spark.createDataFrame([("{",), ("",), (None,), ("[]",)], "value string")
    assert ps.geojson_positions(raw).count() == 0
    assert ps.arcgis_features(raw, {"k": ("k", "bigint")}, ["k"]).count() == 0
    assert ps.census_matrix(raw, {"k": "bigint"}).count() == 0
    assert all(f.count() == 0 for f in ps.ais_messages(raw))
    assert ps.zip_hours(raw, ["v"]).count() == 0


def test_html_cells(spark):
    page = "<html><script>var t='<p>no</p>';</script><H1 class=x>Port <b>One</b></H1><table><tr><td> 1,5 </td><td></td></tr></table><p>open"
    got = ps.html_cells(spark.createDataFrame([(1, page), (2, None), (3, "")], "page_id long, html string"), "html").collect()
    assert [(r.page_id, r.tag, r.cell_text) for r in sorted(got, key=lambda r: r.cell)] == [(1, "h1", "Port One"), (1, "td", "1,5"), (1, "td", "")]


def test_matrix_takes_the_first_of_equal_names(spark):
    raw = spark.createDataFrame([('[["a","b","a"],["1","-","9"],["x","2.5","9"]]',)], "value string")
    rows = ps.census_matrix(raw, {"a": "bigint", "b": "double", "c": "double"}).collect()
    assert [tuple(r) for r in rows] == [(1, None, None), (None, 2.5, None)]


def test_partner_codes_stay_whole(spark):
    raw = spark.createDataFrame([("28",), ("1234",), ("12345",), ("0003",), ("-",), (None,)], "c string").select(ps.padded(F.col("c"), 4).alias("code"))
    assert [r.code for r in raw.collect()] == ["0028", "1234", "12345", "0003", "000-", None]
    assert [r.code for r in ps.country_partners(raw, "code").collect()] == ["1234"]


def test_report_rows_repeat_in_other_reports_only(spark):
    cell = lambda year, value: f'<Year year="{year}"><Month name="previous"><Cell value="-1"/></Month><Month name="current"><Cell value="{value}"/></Month></Year>'
    report = lambda *years: f'<Report><Matrix commodity="Corn 1/"><Region region="World">{"".join(years)}</Region><Region region="None"/></Matrix><Matrix commodity="Empty"/></Report>'
    texts = [report(cell("2024/25 Est.", 5), cell("2024/25", 6), cell("2025/26 Proj.", 7)), report(cell("2024/25 Est.", 5)), "<Report/>", None]
    got = fe.report_xml(spark.createDataFrame([(t,) for t in texts], "value string")).collect()
    assert sorted(tuple(r) for r in got) == [("Corn", "World", "2024/25", "Est.", 5.0)] * 2 + [("Corn", "World", "2025/26", "Proj.", 7.0)]


def test_dates_of_any_shape_do_not_fail_by_the_way(spark):
    texts = {"1704067200000": (2024, 1, 1), " -86400000 ": (1969, 12, 31), "+0": (1970, 1, 1), "2024-01-02": (2024, 1, 2), "2024/01/03": (2024, 1, 3), "2024/13/03": None, "2024-1/2": None, "soon": None, "": None, "99999999999999999999": None}
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "value string").select("value", ps.any_date(F.col("value")).alias("day"), ps.millis_text(F.col("value")).alias("whole")).collect()
    assert {r.value: r.day for r in rows} == {t: dt.date(*d) if d else None for t, d in texts.items()} | {None: None}
    # a cast that fails costs an exception for each row: only whole numbers get to it
    assert {r.value for r in rows if r.whole} == {"1704067200000", " -86400000 ", "+0", "99999999999999999999"}
