"""Registered queries that SQL cannot check, against plain versions over the same tables or what must hold of them."""

import glob
import os

import numpy as np
import pandas as pd
import pytest

from harborline.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES = registry.queries()


def read(name):
    return pd.read_parquet(f"{SF}/{name}.parquet")


def run(spark, name):
    return QUERIES[name](spark, SF).toPandas()


def test_every_query_without_sql_is_tested_somewhere():
    tested = "".join(open(f).read() for f in glob.glob(os.path.dirname(__file__) + "/test_*.py"))
    assert [n for n in sorted(set(QUERIES) - set(registry.oracle_sql())) if n not in tested] == []


def test_list_sources(spark):
    out, events = run(spark, "list_sources").set_index("source"), read("events")
    assert out["rows"].to_dict() == events.groupby("event_type").size().to_dict()
    newest = pd.Timestamp(os.path.getmtime(f"{SF}/events.parquet"), unit="s")
    assert all(abs((t - newest).total_seconds()) < 2 for t in out["newest_file"])


def test_export_snapshot_and_inventory(spark):
    out = run(spark, "export_snapshot").set_index("table_name")
    assert out["rows"].to_dict() == {t: len(read(t)) for t in ("orders", "customer", "events", "region")} and (out["bytes"] > 0).all()
    files = run(spark, "table_inventory").set_index("table_name")
    for t in ("orders", "lineitem", "events"):
        assert (files.loc[t, "rows"], files.loc[t, "bytes"], files.loc[t, "n_columns"]) == (len(read(t)), os.path.getsize(f"{SF}/{t}.parquet"), read(t).shape[1])


def test_sample_describe(spark):
    out = run(spark, "sample_describe").set_index("summary").astype(float)
    lines = read("lineitem")
    n = out.loc["count"].iloc[0]
    assert 0.05 * len(lines) < n < 0.15 * len(lines)
    for c in ("l_quantity", "l_extendedprice", "l_discount"):
        assert lines[c].min() <= out.loc["min", c] <= out.loc["25%", c] <= out.loc["50%", c] <= out.loc["75%", c] <= out.loc["max", c] <= lines[c].max()
        assert abs(out.loc["mean", c] - lines[c].mean()) < 5 * lines[c].std() / n**0.5


def test_runs_of_steps(spark):
    out = run(spark, "curation_run").set_index("step")
    for step, name in (("dedup", "dedup_last"), ("clean", "clean_sentinels"), ("validate", "validation_report"), ("enrich_positions", "curated_positions"), ("enrich_vessels", "curated_vessels")):
        assert out.loc[step, "rows"] == QUERIES[name](spark, SF).count() and out.loc[step, "error"] is None
    assert np.isnan(out.loc["broken", "rows"]) and out.loc["broken", "error"] == "AnalysisException"
    built = run(spark, "rebuild_available")
    rows = dict(zip(built.iloc[:, 0], built.iloc[:, 1], strict=True))
    for name in ("port_weekly", "chokepoint_7d", "trade_monthly", "export_pace"):
        assert rows[name] == QUERIES[name](spark, SF).count()


def test_walk_forward_forecast(spark):
    out = run(spark, "walk_forward_forecast")
    assert len(out) and (out["week_start"] >= out["cutoff"]).all() and (out["forecast"] >= 0).all()
    nexts = {"1999-01-01": "2000-01-01", "2000-01-01": "2001-01-01", "2001-01-01": "2100-01-01"}
    assert all(str(w) < nexts[str(c)] for w, c in zip(out["week_start"], out["cutoff"], strict=True))
    assert not out.duplicated(["port_id", "week_start"]).any()
    grid = QUERIES["weekly_grid"](spark, SF).toPandas()
    truth = {(p, w): y for p, w, y in zip(grid["port_id"], grid["week_start"], grid["y"], strict=True)}
    assert all(truth[p, t] == a for p, t, a in zip(out["port_id"], out["target_week"], out["actual"], strict=True))


def test_walk_forward_classifier_and_its_calibration(spark):
    out = run(spark, "walk_forward_classifier")
    assert (out["origin_week"] >= out["cutoff"]).all() and out["chance"].between(0, 1).all()
    rows = QUERIES["warning_rows"](spark, SF).toPandas().set_index(["port_id", "origin_week", "horizon"])["y"]
    assert all(rows[k] == y for k, y in zip(zip(out["port_id"], out["origin_week"], out["horizon"], strict=True), out["y"], strict=True))
    last = run(spark, "platt_calibration")
    assert len(last) == (out["cutoff"].astype(str) == "2001-01-01").sum() and last["calibrated"].between(0, 1).all()
    # a logistic curve over log-odds keeps the order, or turns all of it round
    order = np.sign(np.diff(last.sort_values("chance")["calibrated"].round(12)))
    assert (order >= 0).all() or (order <= 0).all()


def test_nnls_nowcast_against_every_support(spark):
    import itertools

    out = run(spark, "nnls_nowcast")
    panel = QUERIES["monthly_panel"](spark, SF).toPandas().sort_values(["series", "month"])
    coasts = ["gulf", "east", "west", "other"]
    got = out[out["model"] == "coasts"].set_index(["entity", "month"])
    checked = 0
    for series, own in panel.groupby("series"):
        own = own.reset_index(drop=True)
        for i in range(24, len(own), 7):
            past = own.iloc[i - 24 : i].dropna(subset=["official", *coasts])
            if len(past) < 12 or own.loc[i, coasts].isna().any():
                continue
            x, y = past[coasts].to_numpy(float), past["official"].to_numpy(float)
            best = (float(y @ y), np.zeros(4))
            for k in range(1, 5):
                for at in itertools.combinations(range(4), k):
                    b = np.zeros(4)
                    b[list(at)] = np.linalg.lstsq(x[:, at], y, rcond=None)[0]
                    if (b >= 0).all():
                        best = min(best, (float(((y - x @ b) ** 2).sum()), b), key=lambda t: t[0])
            row = got.loc[(series, own.loc[i, "month"])]
            assert row["n"] == len(past) and np.isclose(row["nowcast"], own.loc[i, coasts].to_numpy(float) @ best[1], rtol=1e-6)
            checked += 1
    assert checked > 20


def test_ridge_scores_and_boosted_folds(spark):
    f = run(spark, "ridge_walk_forward")
    scores = run(spark, "ridge_scores").set_index(["model", "horizon"])
    for (m, h), own in f.groupby(["model", "horizon"]):
        row = scores.loc[(m, h)]
        row = row[row["year"].isna()].iloc[0]
        y, p = own["y"], own["prediction"]
        assert row["n"] == len(own) and np.isclose(row["r2"], 1 - ((y - p) ** 2).sum() / (y**2).sum())
        assert (m == "no_change") == np.isnan(row["t"])
    trees = run(spark, "boosted_walk_forward")
    assert (trees["origin"] >= trees["cutoff"]).all() and (trees["trees"] >= 1).all() and set(trees["horizon"]) == {1, 2, 4} and not trees.duplicated(["origin", "horizon"]).any()


@pytest.mark.parametrize("name", ["live_warnings", "driver_groups"])
def test_live_queries(spark, name):
    out = run(spark, name)
    newest = max(QUERIES["label_drops"](spark, SF).where("is_drop IS NOT NULL").toPandas()["week_start"])
    assert len(out) and set(out["origin_week"]) == {newest}
    if name == "live_warnings":
        assert out["chance"].between(0, 1).all() and out.groupby("horizon")["flagged"].sum().min() >= 1
        assert np.allclose(out["lift"], out["chance"] / out["base_rate"])
    else:
        assert out.groupby(["port_id", "horizon"]).size().eq(7).all()
        assert ((out["push"] > 0.04) | ~out["is_reason"]).all() and out.groupby(["port_id", "horizon"])["is_reason"].sum().max() <= 2


def test_page_cells(spark):
    cells, pages = run(spark, "page_cells"), read("pages")
    assert set(cells["page_id"]) <= set(pages["page_id"]) and cells["tag"].isin(["p", "a", "td", "th", *[f"h{i}" for i in range(1, 7)]]).all() and not cells["cell_text"].str.contains("<").any()
