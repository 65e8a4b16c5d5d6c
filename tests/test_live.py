"""Live warnings: the saved model scores as the fresh one, nothing is refitted, drivers name what was planted."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from harborline.operators import events as ev
from harborline.operators import live as lv
from harborline.plans import disruption

NAMES = ["calls", "storm", "luck"]
WEEKS = [date(2020, 1, 6) + timedelta(weeks=k) for k in range(120)]
KEYS = ["origin_week", "horizon", "port_id"]


@pytest.fixture(scope="module")
def rows(spark):
    """A drop comes exactly where calls fell far; storms matter a little, luck does not."""
    rnd = random.Random(5)
    out = []
    for w in WEEKS:
        for port in range(12):
            calls, storm = rnd.gauss(0, 1), float(rnd.random() < 0.2)
            y = int(calls < -1.2 or (storm and rnd.random() < 0.3))
            out.append((w, w + timedelta(weeks=2), 2, port, 0.2, calls, storm if port else None, rnd.random(), y))
    return spark.createDataFrame(out, "origin_week date, target_week date, horizon int, port_id int, base_rate double, calls double, storm double, luck double, y int")


@pytest.fixture(scope="module")
def model(rows):
    return lv.train_warnings(rows, NAMES, "y", "target_week", "origin_week", WEEKS[-3], calibration_weeks=40)


def test_saved_model_scores_as_the_fresh_one(spark, rows, model, tmp_path_factory, monkeypatch):
    path = str(tmp_path_factory.mktemp("model")) + "/m"
    model.save(path)
    newest = rows.where(F.col("origin_week") >= F.lit(WEEKS[-6]))
    fresh = sorted((r.origin_week, r.port_id, r.chance) for r in model.score(newest).collect())
    from pyspark.ml.base import Estimator

    monkeypatch.setattr(Estimator, "fit", lambda *_: pytest.fail("scoring must not fit"))
    kept = lv.WarningModel.load(spark, path)
    assert sorted((r.origin_week, r.port_id, r.chance) for r in kept.score(newest).collect()) == fresh
    assert kept.through == WEEKS[-3] and kept.names == NAMES and kept.calibration is not None
    why = {(r.origin_week, r.port_id): r for r in lv.driver_groups(kept, newest, KEYS, {"falling": ["calls"], "storm": ["storm"], "other": ["luck"]}).collect()}
    fell = {(r.origin_week, r.port_id) for r in newest.where("calls < -1.4").collect()}
    assert fell and all(why[p].reasons[0] == "falling" for p in fell)
    assert all(len(r.reasons) <= 2 and len(r.drivers) == 3 for r in why.values())


def test_training_sees_only_what_was_known(rows, model):
    changed = rows.withColumn("y", F.when(F.col("target_week") > F.lit(WEEKS[-3]), 1 - F.col("y")).otherwise(F.col("y")))
    again = lv.train_warnings(changed, NAMES, "y", "target_week", "origin_week", WEEKS[-3], calibration_weeks=40)
    a, b = ({(r.origin_week, r.port_id): r.chance for r in m.score(rows).collect()} for m in (model, again))
    assert a == b


def test_calibration_needs_positives(rows):
    few = rows.where("y = 0").withColumn("chance", F.lit(0.5))
    assert lv.fit_calibration(few, "y", 1) is None
    none = lv.train_warnings(rows.withColumn("y", F.when(F.col("port_id") == 3, F.col("y")).otherwise(0)), NAMES, "y", "target_week", "origin_week", WEEKS[-3], 40, least=1000)
    assert none.calibration is None and none.score(rows.limit(3)).where("chance BETWEEN 0 AND 1").count() == 3


def test_stale_data_are_refused():
    lv.check_fresh(date(2024, 5, 1), date(2024, 5, 8))
    with pytest.raises(lv.StaleRelease):
        lv.check_fresh(date(2024, 5, 1), date(2024, 5, 9))


def test_record_joins_known_outcomes_and_keeps_the_best(spark):
    w = WEEKS
    history = spark.createDataFrame([(w[0], w[1], 1, 1, 0.5, True), (w[0], w[2], 2, 1, 0.6, True), (w[1], w[2], 1, 1, 0.6, True), (w[1], w[2], 1, 2, 0.1, False), (w[2], w[9], 3, 1, 0.9, True)], "origin_week date, target_week date, horizon int, port_id int, chance double, flagged boolean")
    labels = spark.createDataFrame([(1, w[1], False, 0.0), (1, w[2], True, 0.7), (2, w[2], None, None)], "port_id int, week_start date, is_drop boolean, drop_pct double")
    record = lv.track_record(history, labels, "port_id", "week_start")
    assert record.count() == 3
    recent = {r.target_week: r for r in lv.recent_record(record, "port_id", 2).collect()}
    assert set(recent) == {w[1], w[2]} and (recent[w[2]].horizon, recent[w[2]].happened, recent[w[2]].drop_pct) == (1, True, 0.7)
    assert {r.target_week for r in lv.recent_record(record, "port_id", 1).collect()} == {w[2]}


def test_daily_exposure_sums_event_exposure(spark):
    rnd = random.Random(4)
    ports = spark.createDataFrame([(i, rnd.uniform(-60, 60), rnd.uniform(-180, 180)) for i in range(12)], "port_id long, latitude double, longitude double")
    day = lambda: date(2020, 1, 1) + timedelta(days=rnd.randrange(40))
    place = lambda: (None, 1.0) if rnd.random() < 0.1 else (rnd.uniform(-60, 60), rnd.uniform(-180, 180))
    rows = [(rnd.randrange(150), rnd.choice(["TC", "FL", "DR"]), rnd.choice(["RED", "green"]), day(), *place(), rnd.randrange(14)) for _ in range(200)]
    events = spark.createDataFrame(rows, "event_id long, event_type string, alert_level string, from_date date, latitude double, longitude double, listed_port long")
    kinds = events.select("event_id", "event_type").distinct()
    each = ev.event_exposure(ev.prepare_events(events), ports, 3000.0).join(kinds, "event_id")
    want = each.groupBy("port_id", "week_start", "from_date").agg(F.count("*").alias("n"), F.count_if("is_red").alias("n_red"), F.min(F.when(F.col("is_red"), F.col("km"))).alias("red_km"), F.min(F.struct(F.coalesce("km", F.lit(1e9)).alias("km"), "event_id", "event_type")).alias("nearest"))
    got = ev.daily_exposure(events, ports, 3000.0, task_rows=50).withColumn("week_start", F.explode(ev.hit_weeks("from_date"))).select(want.columns)
    rows_of = lambda df: sorted(map(repr, df.collect()))
    assert rows_of(got) == rows_of(want) and got.count() > 100


def test_features_read_the_large_tables_once(spark):
    plan = disruption.disruption_features(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not any(f"{t}.parquet" in plan for t in ("lineitem", "orders"))  # both are summed and stored first
