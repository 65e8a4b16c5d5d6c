"""Walk-forward folds never see later rows, and learn what is there."""

import random

from pyspark.sql import functions as F

from harborline.operators import models as mo


def frame(spark):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        x = rnd.uniform(-1, 1)
        rows.append((f"{2000 + i // 100}-01-{1 + i % 28:02d}", f"{2000 + i // 100}-02-{1 + i % 28:02d}", x, None if i % 9 == 0 else rnd.random(), 2 * x + rnd.gauss(0, 0.05), float(x > 0)))
    df = spark.createDataFrame(rows, "origin string, target string, x double, noise double, y double, label double")
    return mo.prepared(df.withColumns({c: F.col(c).cast("date") for c in ("origin", "target")}), ["x", "noise"])


def test_folds_are_out_of_sample(spark):
    df, seen = frame(spark), []
    fit, score = mo.ridge("y", 0.0)

    def spy(train):
        seen.append(train.agg(F.max("target")).head()[0].isoformat())
        return fit(train)

    out = mo.walk_forward(df, "target", "origin", ["2001-06-01", "2002-06-01"], spy, score)
    assert seen[0] <= "2001-06-01" and seen[1] <= "2002-06-01"
    assert out.where("origin < cutoff").count() == 0
    assert out.agg(F.max(F.abs(F.col("prediction") - 2 * F.col("x")))).head()[0] < 0.3


def test_classifier_and_calibration(spark):
    fit, score = mo.boosted_classifier("label", iterations=3, depth=2)
    out = mo.walk_forward(frame(spark), "target", "origin", ["2001-06-01"], fit, score)
    assert out.where((F.col("chance") > 0.5) != (F.col("label") == 1.0)).count() <= out.count() * 0.1
    again = mo.platt(out, "chance", "label", out)
    assert again.where("calibrated IS NULL OR calibrated < 0 OR calibrated > 1").count() == 0
