"""Whole files as they land: odd rows, odd values, line breaks, several shapes of payloads."""

import datetime as dt
import json

from pyspark.sql import functions as F

from harborline.sources import files as fi


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "v string").select(column.alias("x")).head().x


def test_single_values(spark):
    v = F.col("v")
    assert [one(spark, t, fi.coordinate(v)) for t in ("4230N", "00131W", "--", "", "42N", None)] == [42.5, -(1 + 31 / 60), None, None, None, None]
    assert one(spark, "14-APR-26 19:10:00", fi.short_time(v)) == dt.datetime(2026, 4, 14, 19, 10)
    assert one(spark, "1-jan-70 00:00:01", fi.short_time(v)) == dt.datetime(1970, 1, 1, 0, 0, 1)
    assert [one(spark, t, fi.short_time(v)) for t in ("31-FEB-99 10:00:00", "14-XXX-26 19:10:00", "soon", None)] == [None] * 4
    assert [one(spark, t, fi.damage(v)) for t in ("10.00K", "5m", "1.0B", "250000", "1,500", "5T", "", None)] == [0.01, 5.0, 1000.0, 0.25, 0.0015, None, None, None]
    assert [one(spark, t, fi.iso_monday(v)) for t in ("2026-33", "2026W01", "202053", "2021-53", "2021-00", "x")] == [dt.date(2026, 8, 10), dt.date(2025, 12, 29), dt.date(2020, 12, 28), None, None, None]


def test_csv_files_with_line_breaks(spark, tmp_path):
    path = tmp_path / "list.csv"
    path.write_text('" ","AD","","ANDORRA"\n"+","AD","ALV","Andorra, la ""Vella""\nold town","Andorra","","--34-6--","AI","0601","","4230N 00131E",""\n"","AD","ALV","Second","","","","","","","",""\n"","ua","MRV","Mironovka","","","1-------"," ","","","4938N 38148E",""\n"","XX","AAA","","","","","","","","",""\n')
    out = {r.unlocode: r for r in fi.code_list(fi.read_csv(spark, str(path), fi.CODE_LIST)).collect()}
    assert set(out) == {"ADALV", "UAMRV"}
    assert out["ADALV"].port_name == 'Andorra, la "Vella"\nold town' and out["ADALV"].latitude == 42.5 and out["ADALV"].function_class == "--34-6--"
    assert (out["UAMRV"].latitude, out["UAMRV"].longitude, out["UAMRV"].status) == (None, None, None)


def test_sanctions(spark, tmp_path):
    path = tmp_path / "sdn.csv"
    remark = "Vessel Registration Identification IMO  9074729; Linked To: X."
    path.write_text(f'306,"A SHIP",vessel,SDGT,-0- ,CALL,Tanker,1000,-0- ,Panama,-0- ,"{remark}"\n307,"A FIRM",-0- ,IRAN,-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,-0- ,"Identification Number IMO 9074729"\n308,"WRONG",vessel,X,,,,,,,,"Vessel Registration Identification IMO 9074728"\n,empty\n')
    out = {r.entity_id: r for r in fi.sanctions(fi.read_csv(spark, str(path), fi.SANCTIONS)).collect()}
    assert set(out) == {"306", "307", "308"} and [out[k].imo_number for k in ("306", "307", "308")] == [9074729, None, None]
    assert out["306"].title is None and out["307"].entity_type is None and out["306"].vessel_flag == "Panama"


def test_freight_payloads(spark):
    flat = {"timeframe": None, "publishDate": "2026-03-04T10:00", "indices": [{"name": "Main!", "value": 5.0, "lane": "A – B"}, {"code": "C2", "value": 1.0, "date": "bad", "publishedAt": "2026-01-02"}, {"name": "no value"}, {"value": 3.0}, None]}
    wrapped = {"data": {"timeframe": "2026-10", "indices": [{"name": "N", "code": "N1", "value": 2.0, "containerType": "40HC", "lane": " "}]}}
    raw = spark.createDataFrame([(json.dumps(x),) for x in (flat, wrapped, {"data": {}}, {"indices": "none"})] + [(None,), ("broken",)], "value string")
    out = {r.route_code: r for r in fi.freight_indices(raw, "2000-01-01").collect()}
    assert set(out) == {"Main", "C2", "N1"}
    assert (out["Main"].origin, out["Main"].destination, out["Main"].rate_date) == ("A", "B", dt.date(2026, 3, 4))
    assert out["C2"].route_name == "C2" and out["C2"].rate_date == dt.date(2026, 1, 2)
    assert out["N1"].route_name == "N (2026-10)" and out["N1"].rate_date == dt.date(2026, 3, 2) and out["N1"].origin is None


def test_prices_last_reading_counts(spark):
    rows = [(1, {"data": {"prices": [{"code": "WTI_USD", "price": 70.0, "updated_at": "2026-01-02T08:00"}, {"code": "WTI_USD", "price": 71.0, "updated_at": "2026-01-02T09:00"}, {"code": "GOLD", "price": 1.0, "updated_at": "2026-01-02"}]}}), (2, {"data": {"code": "BRENT_CRUDE_USD", "price": 80.0, "updatedAt": "2026-01-02"}}), (3, {"data": {"code": "WTI_USD", "price": None}}), (4, {"data": {"code": "DUBAI_CRUDE_USD", "price": 75.0}})]
    out = {r.price_date: (r.brent_usd, r.wti_usd, r.dubai_usd) for r in fi.benchmark_prices(spark.createDataFrame([(s, json.dumps(x)) for s, x in rows], "seq int, value string"), "2000-01-01").collect()}
    assert out == {dt.date(2026, 1, 2): (80.0, 71.0, None), dt.date(2000, 1, 1): (None, None, 75.0)}


def test_port_volume_pages(spark):
    row = lambda *c: "<tr>" + "".join(f"<td><span>{x}</span></td>" for x in c) + "</tr>"
    page = "<TABLE class=a>" + row("Month", *"abcdefgh") + row("January", "1,000.5", "2", "1,002.5", "3", "4", "7", "1,009.5", "+2.5%") + row("March", "1", "2", "3", "4", "5", "9", "&nbsp;", "-1%") + row("April", "1", "2", "", "4", "5", "9", "-", "n/a") + row("May", "1") + "</TABLE>"
    out = {r.period: r for r in fi.port_volumes(spark.createDataFrame([(2024, page), (2023, "no table"), (2022, None)], "year int, html string")).collect()}
    assert set(out) == {"2024-01", "2024-03"} and out["2024-01"].total_teu == 1009.5 and out["2024-01"].prior_year_change_pct == 2.5
    assert (out["2024-03"].total_teu, out["2024-03"].period_date, out["2024-03"].loaded_imports_teu) == (12.0, dt.date(2024, 3, 1), 1.0)


def test_oil_trade_names_and_metrics(spark):
    old = spark.createDataFrame([("2020-01", "SA", "CRUDEOIL", "TOTEXPSB", "1,200", "KBBL"), ("2020-01", "SA", "X", "Y", "-", "KBBL"), ("2020-01", "SA", "X", "Y", "5", "KBD")], "TIME_PERIOD string, REPORTING_COUNTRY string, PRODUCT string, FLOW_BREAKDOWN string, DATAVALUE string, UNIT string")
    r = fi.oil_trade(old).collect()
    assert len(r) == 1 and (r[0].product, r[0].flow, r[0].quantity_barrels, r[0].quantity_ktonnes, r[0].partner_country) == ("Crude oil", "Exports", 1200.0, None, None)
    a = spark.createDataFrame([("2020", " ", "1,000"), ("total", "x", "5"), ("2021", "Cargo", "n/a")], "year string, kind string, n string")
    assert [tuple(x) for x in fi.port_metrics({"m": (a, "n", "kind")}).collect()] == [("2020", 2020, "m", "ALL", 1000.0)]
