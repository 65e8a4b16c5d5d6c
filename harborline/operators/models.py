"""Walk-forward models with MLlib: folds by cutoff, training rows never later than it."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Estimator
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def prepared(df: DataFrame, features: list[str]) -> DataFrame:
    """A ``features`` vector: nulls become 0 with a flag of their own."""
    cells = df.withColumns({f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features} | {f"_{c}_null": F.col(c).isNull().cast("double") for c in features})
    names = [f"_{c}" for c in features] + [f"_{c}_null" for c in features]
    return VectorAssembler(inputCols=names, outputCol="features").transform(cells).drop(*names)


def walk_forward(df: DataFrame, target_day: str, origin_day: str, cutoffs: list[str], fit: Callable[[DataFrame], DataFrame | Estimator], score: Callable[[object, DataFrame], DataFrame]) -> DataFrame:
    """For each cutoff: fits on rows whose target is known by then, scores origins up to the next cutoff."""
    out = []
    for i, cut in enumerate(cutoffs):
        test = df.where(F.col(origin_day) >= cut)
        if i + 1 < len(cutoffs):
            test = test.where(F.col(origin_day) < cutoffs[i + 1])
        model = fit(df.where(F.col(target_day) <= cut))
        out.append(score(model, test).withColumn("cutoff", F.lit(cut).cast("date")))
    return reduce(DataFrame.unionByName, out)


def boosted_regression(label: str, weight: str | None = None, iterations: int = 12, depth: int = 4):  # noqa: ANN201
    """(fit, score) of boosted trees under absolute loss."""
    est = GBTRegressor(labelCol=label, featuresCol="features", lossType="absolute", maxIter=iterations, maxDepth=depth, seed=1, **({"weightCol": weight} if weight else {}))
    return est.fit, lambda m, df: m.transform(df)


def boosted_classifier(label: str, weight: str | None = None, iterations: int = 12, depth: int = 4):  # noqa: ANN201
    """(fit, score) of boosted trees; ``chance`` is the probability of the positive class."""
    est = GBTClassifier(labelCol=label, featuresCol="features", maxIter=iterations, maxDepth=depth, seed=1, **({"weightCol": weight} if weight else {}))
    return est.fit, lambda m, df: m.transform(df).withColumn("chance", vector_to_array("probability")[1])


def ridge(label: str, strength: float = 1.0):  # noqa: ANN201
    est = LinearRegression(labelCol=label, featuresCol="features", regParam=strength, elasticNetParam=0.0, standardization=True)
    return est.fit, lambda m, df: m.transform(df)


def platt(df: DataFrame, chance: str, label: str, at: DataFrame) -> DataFrame:
    """Chances of ``at`` recalibrated by a logistic curve over the logits of df's own predictions."""
    p = F.least(F.greatest(F.col(chance), F.lit(1e-6)), F.lit(1 - 1e-6))
    logit = lambda d: VectorAssembler(inputCols=["_logit"], outputCol="_x").transform(d.withColumn("_logit", F.log(p / (1 - p))))
    model = LogisticRegression(labelCol=label, featuresCol="_x", regParam=0.0, probabilityCol="_p", rawPredictionCol="_r", predictionCol="_c").fit(logit(df))
    return model.transform(logit(at)).withColumn("calibrated", vector_to_array("_p")[1]).drop("_logit", "_x", "_p", "_r", "_c")


def boosted_folds(rows: DataFrame, origin: str, horizon: str, label: str, horizons: tuple[int, ...], cutoffs: list[str], valid_weeks: int, winsor: float, iterations: int = 20, depth: int = 3, step: float = 0.1) -> DataFrame:
    """Boosted trees under absolute loss for each horizon and cutoff, forecasting origins up to the next cutoff.

    The number of trees is the best on the valid_weeks before the cutoff; then all
    rows whose outcome was known are fitted again.  Training labels are clipped
    to their winsor quantiles.  A fold without rows of either part is left out.
    """
    out = []
    for i, cut in enumerate(cutoffs):
        for h in horizons:
            own, end = rows.where(F.col(horizon) == h), F.to_date(F.lit(cut))
            known = own.where(F.date_add(origin, 7 * h) <= end)
            start = F.date_sub(end, 7 * valid_weeks)
            known = known.withColumn("_valid", F.col(origin) >= start).where(F.col("_valid") | (F.date_add(origin, 7 * h) <= start))
            known = known.cache()
            ends = known.agg(F.percentile(label, F.array(F.lit(winsor), F.lit(1 - winsor))).alias("q"), F.count_if("_valid").alias("v"), F.count_if(~F.col("_valid")).alias("n")).head()
            if not (ends.v and ends.n):
                continue
            clipped = F.least(F.greatest(F.col(label), F.lit(ends.q[0])), F.lit(ends.q[1]))
            known = known.withColumn("_y", F.when(F.col("_valid"), F.col(label)).otherwise(clipped))
            est = GBTRegressor(labelCol="_y", featuresCol="features", lossType="absolute", maxIter=iterations, maxDepth=depth, stepSize=step, seed=1, validationIndicatorCol="_valid")
            best = est.fit(known).getNumTrees
            final = GBTRegressor(labelCol="_y", featuresCol="features", lossType="absolute", maxIter=best, maxDepth=depth, stepSize=step, seed=1).fit(known.withColumn("_y", clipped))
            test = own.where(F.col(origin) >= end)
            if i + 1 < len(cutoffs):
                test = test.where(F.col(origin) < cutoffs[i + 1])
            out.append(final.transform(test).select(origin, horizon, end.alias("cutoff"), F.col(label), "prediction", F.lit(best).alias("trees")))
            known.unpersist()
    return reduce(DataFrame.unionByName, out)
