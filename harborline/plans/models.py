"""Walk-forward forecasts and warnings on the weekly panel; model fits have no SQL form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import models as mo
from ..operators import panels as pa
from . import panels as pl

QUERIES, ORACLE_SQL = {}, {}
CUTOFFS = ["1999-01-01", "2000-01-01", "2001-01-01"]
LAGS = ["lag_0", "lag_1", "lag_2", "lag_3", "mean_4", "mean_8", "mean_13", "mean_52", "cv_13", "trend", "vs_year_ago"]


def forecast_rows(spark: SparkSession, sf: str) -> DataFrame:
    """One row per port and origin week with the change of the next week against the usual."""
    w = Window.partitionBy("port_id").orderBy("week_start")
    f = pl.history_features(spark, sf)
    f = f.withColumns({"target_week": F.lead("week_start").over(w), "actual": F.lead("y").over(w)})
    f = f.where("actual IS NOT NULL AND mean_4 IS NOT NULL")
    f = f.withColumns({"target": F.log1p("actual") - F.log1p("mean_4"), "weight": F.col("mean_4") + 1, "week_no": F.weekofyear("target_week")})
    return mo.prepared(f, [*LAGS, "week_no"]).select("port_id", "week_start", "target_week", "actual", "mean_4", "target", "weight", "features")


def walk_forward_forecast(spark: SparkSession, sf: str) -> DataFrame:
    rows = forecast_rows(spark, sf)
    fit, score = mo.boosted_regression("target", "weight")
    out = mo.walk_forward(rows, "target_week", "week_start", CUTOFFS, fit, score)
    forecast = F.greatest(F.expm1(F.col("prediction") + F.log1p("mean_4")), F.lit(0.0))
    return out.select("port_id", "week_start", "target_week", "cutoff", "actual", forecast.alias("forecast"))


def warning_features(spark: SparkSession, sf: str) -> DataFrame:
    from .explore import drop_state

    state = drop_state(spark, sf).withColumnRenamed("week_start", "origin_week")
    rows = pa.rule_scores(pl.warning_rows(spark, sf)).join(state, ["port_id", "origin_week"])
    names = ["horizon", "base_rate", "origin_z", "last_drop", "z_1", "min_z_4", "weeks_since", "drops_52", "rel_spread"]
    # half as much weight for every two years of age
    age = F.datediff(F.lit(CUTOFFS[-1]).cast("date"), "origin_week") / 7
    rows = rows.withColumns({"weight": F.pow(F.lit(0.5), age / 104), "y": F.col("y").cast("double")})
    return mo.prepared(rows, names).select("port_id", "origin_week", "target_week", "horizon", "y", "weight", "features")


def walk_forward_classifier(spark: SparkSession, sf: str) -> DataFrame:
    fit, score = mo.boosted_classifier("y", "weight")
    out = mo.walk_forward(warning_features(spark, sf), "target_week", "origin_week", CUTOFFS, fit, score)
    return out.select("port_id", "origin_week", "target_week", "horizon", "cutoff", "y", "chance")


def platt_calibration(spark: SparkSession, sf: str) -> DataFrame:
    """The last year's chances, recalibrated on the model's own predictions before it."""
    p = walk_forward_classifier(spark, sf)
    return mo.platt(p.where(F.col("cutoff") < CUTOFFS[-1]), "chance", "y", p.where(F.col("cutoff") == CUTOFFS[-1]))


for _f in (walk_forward_forecast, walk_forward_classifier, platt_calibration):
    QUERIES[_f.__name__] = _f
