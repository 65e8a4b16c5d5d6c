"""Hand-made cases: re-runs, nulls, ties, partial weeks, islands, far places."""

import math
import random

import pytest
from pyspark.sql import functions as F

from harborline.functions.expr import haversine_km
from harborline.operators import keyed, monitoring, panels, scoring, spatial, temporal


def test_upsert_is_idempotent_and_null_safe(spark):
    stored = spark.createDataFrame([(1, None, "old"), (2, "a", "old")], "k long, p string, v string")
    batch = spark.createDataFrame([(1, None, "x", 1), (1, None, "new", 2), (3, "c", "new", 1)], "k long, p string, v string, seq long")
    once = keyed.upsert(stored, batch, ["k", "p"], "seq").drop("seq")
    twice = keyed.upsert(once, batch, ["k", "p"], "seq").drop("seq")
    want = {(1, None, "new"), (2, "a", "old"), (3, "c", "new")}
    assert {tuple(r) for r in once.collect()} == {tuple(r) for r in twice.collect()} == want


def test_asof_takes_equal_times_and_skips_null(spark):
    left = spark.createDataFrame([(1, 10), (2, 5), (3, 4), (4, None)], "id long, t long").withColumn("k", F.lit("a"))
    right = spark.createDataFrame([(5, 1.0), (10, 2.0), (None, 9.0)], "t long, v double").withColumn("k", F.lit("a"))
    got = temporal.asof_backward(left, right, "t", "t", ["k"], ["v"])
    assert {(r.id, r.v) for r in got.collect()} == {(1, 2.0), (2, 1.0), (3, None), (4, None)}


@pytest.mark.parametrize("radius", [30.0, 500.0, 2500.0])
def test_spatial_join_against_all_pairs(spark, radius):
    rnd = random.Random(9)
    points = lambda n: [(i, rnd.choice([rnd.uniform(-90, 90), rnd.uniform(85, 90), rnd.uniform(-2, 2)]), rnd.choice([rnd.uniform(-180, 180), rnd.choice([-180.0, 180.0, 179.9, -179.95])])) for i in range(n)]
    a, b = points(150), points(150)
    da, db = (spark.createDataFrame(p, f"{n} long, latitude double, longitude double") for p, n in ((a, "x"), (b, "y")))
    got = {(r.x, r.y) for r in spatial.spatial_join(da, db, radius, "x", "y").collect()}
    pairs = da.crossJoin(db.select("y", F.col("latitude").alias("la"), F.col("longitude").alias("lo")))
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("la"), F.col("lo"))
    assert got == {(r.x, r.y) for r in pairs.where(km <= radius).select("x", "y").collect()}


def test_drop_rules(spark):
    def labels(values, **kw):
        df = spark.createDataFrame([("p", i, None if y is None else float(y)) for i, y in enumerate(values)], "port string, week long, y double")
        return {r.week: r for r in panels.label_drops(df, "port", "week", **kw).collect()}

    fall = labels([50 + i % 3 for i in range(20)] + [5, 5] + [51] * 5)
    assert fall[20].is_drop and fall[20].base == 51 and fall[20].drop_pct > 0.9
    assert not labels([20] * 20 + [13])[20].is_drop  # within the noise of counts
    assert not labels([30, 70] * 10 + [15])[20].is_drop  # a jumpy port
    partial = labels([50] * 20 + [None])
    assert partial[20].is_drop is None and partial[5].is_drop is None
    assert math.isclose(labels([50] * 20 + [10])[20].spread, math.sqrt(50))


def test_islands(spark):
    df = spark.createDataFrame([("a", i, s) for i, s in enumerate([1, 1, None, None, 2, 1])], "k string, t long, s long")
    got = [r.island for r in keyed.islands(df, ["k"], ["t"], F.col("s")).orderBy("t").collect()]
    assert got == [1, 1, 2, 2, 3, 4]


def test_pr_curve_without_positives(spark):
    df = spark.createDataFrame([(i / 10, 0) for i in range(10)], "score double, y int")
    got = scoring.pr_curve(df, "score").collect()
    assert {(r.precision, r.recall) for r in got} == {(0.0, None)} and max(r.k for r in got) == 10


def test_volume_thresholds_are_exact(spark):
    # z is -3 and -1.6 to the last digit; means and roots in floating point pass either
    at_3 = [55] * 4 + [54] * 6 + [73] * 6 + [82] * 6 + [77] * 6 + [10] * 2
    at_alert = [29] * 3 + [84] * 6 + [98] * 6 + [75] * 6 + [50] * 6 + [27] * 3
    df = spark.createDataFrame([(s, i, x) for s, xs in (("a", at_3), ("b", at_alert), ("c", [7] * 30), ("d", [1] * 29 + [9])) for i, x in enumerate(xs)], "source string, i long, n_rows long")
    got = {(r.source, r.i): (r.severity, r.z) for r in monitoring.volume_anomalies(df, "source", ["i"], "n_rows", alert=1.6).collect()}
    assert got["a", 29][0] == "medium" and math.isclose(got["a", 29][1], -3)
    assert ("b", 29) not in got and got["d", 29][0] == "high"
    assert not any(s == "c" for s, _ in got)
