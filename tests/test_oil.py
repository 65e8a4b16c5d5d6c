"""Nowcasts, weekly features and ridge folds against plain versions and planted data."""

import itertools
import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from harborline.operators import nowcast as nc
from harborline.operators import regression as rg
from harborline.operators import weekly as wk


def month(i):
    return date(2000 + i // 12, i % 12 + 1, 1)


def best_support(x, y):
    """Non-negative least squares by trying every set of variables."""
    best = (float(y @ y), np.zeros(x.shape[1]))
    for k in range(1, x.shape[1] + 1):
        for at in itertools.combinations(range(x.shape[1]), k):
            b = np.zeros(x.shape[1])
            b[list(at)] = np.linalg.lstsq(x[:, at], y, rcond=None)[0]
            if (b >= 0).all():
                best = min(best, (float(((y - x @ b) ** 2).sum()), b), key=lambda t: t[0])
    return best[1]


def test_nonnegative_fit_on_planted_months(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for s, true in (("a", (2.0, 0.0, 0.5)), ("b", (0.0, 0.0, 0.0)), ("c", (1.0, -3.0, 2.0))):
        for i in range(40):
            x = rnd.uniform(0, 10, 3)
            y = float(x @ true) + (rnd.normal() if s != "a" else 0)
            rows.append((s, month(i), None if i in (30, 39) else y, *[None if (i, k) == (20, 1) else float(v) for k, v in enumerate(x)]))
    df = spark.createDataFrame(rows, "series string, month date, official double, x double, y double, z double")
    got = {(r.series, r.month): r for r in nc.nonnegative_fit(df, "series", "official", ["x", "y", "z"], -24, -1, 12).collect()}
    for s in "abc":
        own = [r for r in rows if r[0] == s]
        for i in range(40):
            g = got[s, month(i)]
            known = [r for r in own[max(i - 24, 0) : i] if None not in r]
            if i < 24:
                assert g.weights is None and g.guess is None
                continue
            x, y = np.array([r[3:] for r in known]), np.array([r[2] for r in known])
            assert g.n == len(known) and np.allclose(g.weights, best_support(x, y), atol=1e-7)
            assert s != "a" or np.allclose(g.weights, (2, 0, 0.5), atol=1e-7)


def test_panel_keeps_gaps_and_live_months(spark):
    act = [("gulf", "X", month(i), 10.0 + i) for i in range(20) if i != 7] + [("east", "X", month(3), 5.0), ("gulf", "M", month(0), 1.0)]
    official = spark.createDataFrame([("exports", month(i), 2.0 * (10 + i)) for i in range(18)], "series string, month date, value double")
    panel = nc.monthly_panel(official, spark.createDataFrame(act, "region string, flow string, month date, tonnes double"), {"exports": "X"}, ("gulf", "east"))
    got = {r.month: r for r in panel.collect()}
    assert len(got) == 20 and got[month(7)].gulf is None and got[month(7)].activity is None and got[month(7)].official == 34.0
    assert (got[month(3)].gulf, got[month(3)].east, got[month(4)].east) == (13.0, 5.0, 0.0)
    out = {r.month: r for r in nc.published_nowcast(nc.nowcast_guesses(panel), official, "series", "ratio12", "2000-01-01", 2001).collect()}
    assert sorted(out) == [month(i) for i in range(12, 20)]
    assert [out[month(i)].is_live for i in (17, 18, 19)] == [False, True, True] and out[month(19)].error_pct is None
    assert out[month(19)].official_through == month(17) and out[month(12)].typical_then_pct is None
    errors = sorted(abs(out[month(i)].error_pct) for i in range(12, 18))
    assert math.isclose(out[month(12)].p90_error_pct, errors[round(0.9 * 5 + 1e-9)]) and math.isclose(out[month(12)].typical_error_pct, (errors[2] + errors[3]) / 2)
    none = nc.published_nowcast(nc.nowcast_guesses(panel.limit(0)), official, "series", "ratio12", "2000-01-01", 2001)
    assert none.count() == 0


def test_terminals_are_named_or_offshore_and_ports_ranked_early(spark):
    rows = [("A", p, n, month(i), t) for i in range(4) for p, n, t in ((1, "Bonny", 5.0), (2, "Tin Can", 50.0 if i < 2 else 0.0), (3, "X - Offshore Oil Terminal 2", 7.0), (4, "New", 500.0 if i > 1 else 0.0))]
    df = spark.createDataFrame(rows, "country string, port int, name string, month date, tonnes double")
    got = nc.terminal_panel(df.where("month != '2000-02-01'"), "country", "port", "name", "tonnes", {"A": ("Bonny",)}, "Offshore Oil Terminal", "2000-03-01", 2).orderBy("month").collect()
    assert [r.terminals for r in got] == [12.0, None, 12.0, 12.0] and [r.total for r in got] == [62.0, None, 512.0, 512.0]
    assert (got[0].port_1, got[0].port_2, got[3].port_1) == (50.0, 7.0, 0.0)


FRIDAYS = [date(2020, 1, 3) + timedelta(weeks=k) for k in range(60)]


def test_stock_weeks_survive_gaps_and_week_53(spark):
    weeks = [date(2014, 1, 3) + timedelta(weeks=k) for k in range(330)]
    rows = [("s", d, 100.0 + k) for k, d in enumerate(weeks) if k not in (328, 329 - 52)]
    got = {r.week_end: r for r in wk.stock_features(wk.week_grid(spark.createDataFrame(rows, "series string, week_end date, value double"), None)).collect()}
    assert len(got) == 330 and got[weeks[328]].value is None and got[weeks[329]].chg1 is None
    known = [100.0 + 329 - 52 * k for k in (2, 3, 4, 5)]  # a year ago is missing
    assert math.isclose(got[weeks[329]].dev5y, 429.0 / (sum(known) / 4) - 1)


def test_part_weeks_and_overlapping_groups(spark):
    daily = [(date(2020, 1, 4) + timedelta(days=k), c, 1.0, 2.0) for k in range(10) for c in ("USA", "BRA", "CHN") if not (k == 9 and c == "CHN")]
    flows = wk.group_flows(spark.createDataFrame(daily, "day date, iso3 string, x double, m double"), "day", "iso3", "x", "m", {"usa": ["USA"], "americas": ["USA", "BRA"]}, {"usa": ["USA"], "china": ["CHN"]})
    got = {(r.week_end, r.series): (r.value, r.days) for r in flows.collect()}
    first, second = date(2020, 1, 10), date(2020, 1, 17)
    assert got[first, "exp_world"] == (21.0, 7) and got[first, "exp_americas"] == (14.0, 7) and got[first, "exp_usa"] == (7.0, 7) and got[first, "imp_china"] == (14.0, 7)
    assert got[second, "exp_world"] == (8.0, 3) and got[second, "imp_china"] == (4.0, 2)
    grid = {(r.week_end, r.series): r.value for r in wk.week_grid(flows).collect()}
    assert grid[first, "exp_usa"] == 7.0 and grid[second, "exp_usa"] is None


def test_a_later_release_changes_only_that_origin(spark):
    origins = spark.createDataFrame([(d,) for d in FRIDAYS], "origin date")
    weekly = spark.createDataFrame([(d, float(k)) for k, d in enumerate(FRIDAYS)], "week_end date, x double")
    usual = weekly.withColumn("published", F.date_add("week_end", 4))
    late = usual.withColumn("published", F.when(F.col("week_end") == FRIDAYS[30], F.date_add("week_end", 8)).otherwise(F.col("published")))
    a, b = ({r.origin: r.x for r in wk.known_by(origins, w, 1).collect()} for w in (usual, late))
    assert [a[d] for d in FRIDAYS[1:]] == [float(k) for k in range(59)] and a[FRIDAYS[0]] is None
    assert {d for d in a if a[d] != b[d]} == {FRIDAYS[31]} and b[FRIDAYS[31]] is None


def test_targets_wait_for_their_day(spark):
    days = [(FRIDAYS[0] + timedelta(days=k), 100.0 + k, 90.0) for k in range(0, 58) if k % 7 not in (1, 2)]
    prices = spark.createDataFrame(days, "price_date date, brent_usd double, wti_usd double")
    got = {r.origin: r for r in wk.price_targets(prices, wk.fridays(prices, "price_date", "origin"), (1, 4)).collect()}
    assert math.isclose(got[FRIDAYS[0]].y1, math.log(107 / 100)) and math.isclose(got[FRIDAYS[4]].y4, math.log(156 / 128))
    assert got[FRIDAYS[5]].y4 is None and got[FRIDAYS[7]].y1 is not None and got[FRIDAYS[8]].y1 is None
    fx = {r.origin: r for r in wk.origin_prices(prices, wk.fridays(prices, "price_date", "origin")).collect()}
    assert math.isclose(fx[FRIDAYS[5]].r4, math.log(135 / 107)) and fx[FRIDAYS[5]].spread_chg4 == 28.0 and fx[FRIDAYS[5]].r13 is None and fx[FRIDAYS[7]].dd52 is None


class PlainRidge:
    """Ridge on standardised, capped inputs, in NumPy."""

    def __init__(self, x, y, strength):
        with np.errstate(all="ignore"):
            self.mean, sd = np.nan_to_num(np.nanmean(x, 0)), np.nanstd(x, 0)
        self.scale = np.where(np.isnan(sd) | (sd < 1e-12), 1.0, sd)
        y = np.clip(y, *np.quantile(y, [0.02, 0.98]))
        z = self.z(x)
        self.base = y.mean()
        self.b = np.linalg.solve(z.T @ z + strength * np.eye(z.shape[1]), z.T @ (y - self.base))

    def z(self, x):
        return np.nan_to_num(np.clip((x - self.mean) / self.scale, -5, 5))

    def __call__(self, x):
        return self.base + self.z(x) @ self.b


@pytest.mark.filterwarnings("ignore")
def test_ridge_folds_equal_numpy(spark):
    rnd = np.random.default_rng(8)
    origins = [date(2019, 1, 4) + timedelta(weeks=k) for k in range(160)]
    x = rnd.normal(size=(160, 3)) * (1, 5, 0.1)
    x[40, 0] = 80.0
    x[rnd.random((160, 3)) < 0.1] = np.nan
    y = {h: np.nan_to_num(x[:, 0]) * h + rnd.normal(size=160) for h in (1, 4)}
    rows = [(d, h, float(y[h][i]), *[None if np.isnan(v) else float(v) for v in x[i]]) for i, d in enumerate(origins) for h in (1, 4)]
    df = spark.createDataFrame(rows, "origin date, horizon int, y double, a double, b double, c double").repartition(3)
    cuts = [origins[100], origins[130]]
    sets, strengths = {"one": ["a"], "all": ["a", "b", "c"]}, (1.0, 10.0, 1000.0)
    folded = rg.folds_of(df, spark.createDataFrame([(c,) for c in cuts], "cutoff date"), "origin", 30)
    fits = rg.fit_ridges(folded, ["a", "b", "c"], sets, "y", strengths)
    tests = df.crossJoin(spark.createDataFrame([(c,) for c in cuts], "cutoff date")).where("origin >= cutoff")
    got = {(r.origin, r.horizon, r.cutoff, r.model): (r.prediction, r.strength, r.valid_r2) for r in rg.predict_ridges(tests, fits, ["a", "b", "c"]).collect()}
    assert len(got) == (60 + 30) * 2 * 2
    for c in cuts:
        for h in (1, 4):
            due = [d + timedelta(weeks=h) for d in origins]
            known = np.array([t <= c for t in due])
            start = c - timedelta(weeks=30)
            inner, valid = np.array([t <= start for t in due]), known & np.array([d >= start for d in origins])
            for name, own in sets.items():
                at = ["abc".index(k) for k in own]
                sse = {s: float(((y[h][valid] - PlainRidge(x[inner][:, at], y[h][inner], s)(x[valid][:, at])) ** 2).sum()) for s in strengths}
                best = min(strengths, key=lambda s: (sse[s], s))
                model = PlainRidge(x[known][:, at], y[h][known], best)
                for i, d in enumerate(origins):
                    if d >= c:
                        p, s, r2 = got[d, h, c, name]
                        assert s == best and math.isclose(p, model(x[i : i + 1][:, at])[0], rel_tol=1e-8, abs_tol=1e-9)
                        assert math.isclose(r2, 1 - sse[best] / float((y[h][valid] ** 2).sum()), rel_tol=1e-8)


def test_clark_west_and_the_normal_tail(spark):
    t = [-9.0, -3.3, -1.0, 0.0, 0.4, 1.96, 5.0, 7.5, 12.0]
    got = spark.createDataFrame([(v,) for v in t], "t double").select("t", rg.upper_tail(F.col("t")).alias("p")).collect()
    for r in got:
        assert math.isclose(r.p, math.erfc(r.t / math.sqrt(2)) / 2, rel_tol=1e-8)
    rnd = random.Random(2)
    rows = [(m, date(2020, 1, 3) + timedelta(weeks=i), y, y * 0.5 + rnd.gauss(0, 0.4)) for m, n in (("long", 60), ("short", 9)) for i in range(n) for y in [rnd.gauss(0, 1)]]
    df = spark.createDataFrame(rows, "model string, origin date, y double, p double")
    out = {r.model: r for r in rg.clark_west(df, ["model"], "origin", "y", "p", F.lit(3), 3).collect()}
    y, p = (np.array([r[k] for r in rows if r[0] == "long"]) for k in (2, 3))
    f = y**2 - ((y - p) ** 2 - p**2)
    d = f - f.mean()
    var = d @ d / 60 + sum(2 * (1 - k / 4) * (d[k:] @ d[:-k]) / 60 for k in (1, 2, 3))
    assert out["long"].n == 60 and math.isclose(out["long"].t, f.mean() / math.sqrt(var / 60)) and out["long"].p < 0.05
    assert out["short"].n == 9 and out["short"].t is None and out["short"].p is None


def test_registered_ridges_see_nothing_later(spark):
    from harborline.plans import prices

    sf = "/root/testdata/sf0.001"
    out = prices.ridge_walk_forward(spark, sf)
    assert out.where("origin < cutoff").count() == 0 and {r.model for r in out.select("model").distinct().collect()} == {"ridge_price", "ridge_price_stocks", "ridge_full", "drift", "no_change"}
    assert out.where("prediction IS NULL").count() == 0 and out.groupBy("origin", "horizon", "model").count().where("count > 1").count() == 0
    latest = prices.latest_price_forecast(spark, sf).collect()
    assert len(latest) == 15 and len({r.origin for r in latest}) == 1 and all(r.target == r.origin + timedelta(weeks=r.horizon) for r in latest)
