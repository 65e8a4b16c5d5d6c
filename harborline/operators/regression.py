"""Ridge regressions of many folds from sufficient statistics, and tests of their forecasts.

A fold fits on rows whose outcome was known at its cutoff.  All folds, horizons
and nested feature sets come from three aggregations: means and quantiles, sums
of products by fold, and sums of products of the validation rows.  What is solved
afterwards are matrices as wide as the features, one row of a table each, so no
fold's rows are ever gathered.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip, safe_ratio

#: Standardised inputs are capped at so many standard deviations.
CAP = 5.0
KEYS = ["cutoff", "horizon"]


def folds_of(rows: DataFrame, cutoffs: DataFrame, origin: str, valid_weeks: int) -> DataFrame:
    """Every row once for each fold and part that it belongs to.

    A row with horizon h is ``known`` at a cutoff if origin + h weeks is not after
    it, and ``inner`` if it was known valid_weeks earlier; ``valid`` are known
    rows whose origin lies in those weeks.  cutoffs is a calendar.
    """
    due = F.date_add(origin, 7 * F.col("horizon"))
    start = F.date_sub("cutoff", 7 * valid_weeks)
    parts = F.array_compact(F.array(F.when(due <= F.col("cutoff"), "known"), F.when(due <= start, "inner"), F.when((due <= F.col("cutoff")) & (F.col(origin) >= start), "valid")))
    return rows.crossJoin(F.broadcast(cutoffs)).where(due <= F.col("cutoff")).withColumn("part", F.explode(parts))


def scaling(folded: DataFrame, features: list[str], target: str, winsor: float) -> DataFrame:
    """Per fold and part: arrays of means and deviations of the features (null left out), and the target's limits."""
    mean = F.array(*[F.coalesce(F.avg(c), F.lit(0.0)) for c in features])
    sd = lambda c: F.stddev_pop(c)
    scale = F.array(*[F.when(sd(c) >= 1e-12, sd(c)).otherwise(1.0) for c in features])
    ends = F.percentile(target, F.array(F.lit(winsor), F.lit(1 - winsor)))
    return folded.groupBy(*KEYS, "part").agg(mean.alias("mean"), scale.alias("scale"), ends.alias("ends"))


def standardised(features: list[str]) -> Column:
    """Array of the features by the arrays mean and scale of the row; a null becomes 0, the average."""
    z = lambda i, c: F.when(F.col(c).isNotNull(), clip((F.col(c) - F.col("mean")[i]) / F.col("scale")[i], -CAP, CAP)).otherwise(0.0)
    return F.array(*[z(i, c) for i, c in enumerate(features)])


def product_sums(df: DataFrame, keys: list[str], width: int) -> DataFrame:
    """keys and g: sums over the rows of the products of all pairs of 1, z and y, as a flat matrix.

    Arrow batches are summed by key in Python; batches' sums are added up by Spark.
    """
    n = width + 2

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for key, own in frame.groupby(keys, sort=False):
                x = np.column_stack([np.ones(len(own)), np.array(own["z"].tolist()), own["y"]])
                out.append((*key, (x.T @ x).ravel()))
            yield pd.DataFrame(out, columns=[*keys, "g"])

    types = dict(df.dtypes)
    partial = df.select(*keys, "z", "y").mapInPandas(add, ", ".join(f"{k} {types[k]}" for k in keys) + ", g array<double>")
    cells = partial.select(*keys, F.posexplode("g").alias("i", "v")).groupBy(*keys, "i").agg(F.sum("v").alias("v"))
    whole = cells.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("g"))  # n * n numbers
    return whole.where(F.size("g") == n * n).withColumn("g", F.transform("g", lambda c: c["v"]))


def solve(g: np.ndarray, at: list[int], strength: float) -> tuple[float, np.ndarray]:
    """(intercept, weights) of the features numbered ``at``; the intercept is the mean of y."""
    i = np.array(at) + 1
    mean = g[0, -1] / g[0, 0]
    return mean, np.linalg.solve(g[np.ix_(i, i)] + strength * np.eye(len(i)), g[i, -1] - mean * g[0, i])


def squared_error(g: np.ndarray, at: list[int], intercept: float, weights: np.ndarray) -> float:
    """Sum of (y - prediction)**2 over the rows that g was made of."""
    c = np.zeros(len(g))
    c[0], c[-1] = intercept, -1
    c[np.array(at) + 1] = weights
    return float(c @ g @ c)


def fit_ridges(folded: DataFrame, features: list[str], sets: dict[str, list[str]], target: str, strengths: tuple[float, ...], winsor: float = 0.02) -> DataFrame:
    """Per fold, horizon and feature set: strength, validation R2 against no change, intercept, weights by feature, and the scaling.

    The strength with the least squared error on the validation rows (the smaller
    of equals) is refitted on all known rows.  Training targets are clipped to
    their winsor quantiles, inputs capped at CAP deviations.  A fold without
    inner rows has no strength and no fit.
    """
    limits = scaling(folded.where("part != 'valid'"), features, target, winsor)
    trained = folded.where("part != 'valid'").join(limits, [*KEYS, "part"])
    trained = trained.select(*KEYS, "part", standardised(features).alias("z"), clip(F.col(target), F.col("ends")[0], F.col("ends")[1]).alias("y"))
    inner_scale = limits.where("part = 'inner'").select(*KEYS, "mean", "scale")
    valid = folded.where("part = 'valid'").join(inner_scale, KEYS).select(*KEYS, "part", standardised(features).alias("z"), F.col(target).alias("y"))
    sums = product_sums(trained.unionByName(valid), [*KEYS, "part"], len(features))
    g = lambda p: F.max(F.when(F.col("part") == p, F.col("g"))).alias(p)
    each = sums.groupBy(*KEYS).agg(g("inner"), g("valid"), g("known")).where("inner IS NOT NULL AND valid IS NOT NULL AND known IS NOT NULL")
    places = {name: [features.index(c) for c in own] for name, own in sets.items()}
    n = len(features) + 2

    def choose(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out = []
            for row in frame.itertuples(index=False):
                inner, valid, known = (np.array(x).reshape(n, n) for x in (row.inner, row.valid, row.known))
                for name, at in places.items():
                    error, strength = min((squared_error(valid, at, *solve(inner, at, s)), s) for s in strengths)
                    intercept, weights = solve(known, at, strength)
                    full = np.zeros(n - 2)
                    full[at] = weights
                    out.append((row.cutoff, row.horizon, name, strength, 1 - error / max(valid[-1, -1], 1e-12), intercept, full))
            yield pd.DataFrame(out, columns=["cutoff", "horizon", "model", "strength", "valid_r2", "intercept", "weights"])

    fits = each.mapInPandas(choose, "cutoff date, horizon int, model string, strength double, valid_r2 double, intercept double, weights array<double>")
    return fits.join(limits.where("part = 'known'").select(*KEYS, "mean", "scale", "ends"), KEYS)


def predict_ridges(tests: DataFrame, fits: DataFrame, features: list[str]) -> DataFrame:
    """tests (with cutoff and horizon) once for each model of their fold, with the prediction."""
    out = tests.join(fits, KEYS)
    terms = F.zip_with(standardised(features), F.col("weights"), lambda z, w: z * w)
    return out.withColumn("prediction", F.aggregate(terms, F.col("intercept"), lambda a, b: a + b)).drop("mean", "scale", "ends", "weights", "intercept")


def drift(folded: DataFrame, target: str, winsor: float = 0.02) -> DataFrame:
    """Per fold and horizon: the mean of the clipped known targets."""
    known = folded.where("part = 'known'")
    ends = known.groupBy(*KEYS).agg(F.percentile(target, F.array(F.lit(winsor), F.lit(1 - winsor))).alias("ends"))
    return known.join(ends, KEYS).groupBy(*KEYS).agg(F.avg(clip(F.col(target), F.col("ends")[0], F.col("ends")[1])).alias("drift"))


#: Numerator and denominator, highest power first, of a rational form of the normal distribution's tail (Hart 1968, number 5666).
TAIL_ABOVE = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383, 112.079291497871, 221.213596169931, 220.206867912376)
TAIL_BELOW = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461, 296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)


def upper_tail(t: Column) -> Column:
    """1 - Phi(t), the chance of a standard normal value above t, to 14 digits or so."""
    x = F.abs(t)
    poly = lambda cs: sum_powers(cs, x)
    small = poly(TAIL_ABOVE) / poly(TAIL_BELOW)
    far = 1 / (x + 1 / (x + 2 / (x + 3 / (x + 4 / (x + 0.65))))) / 2.506628274631
    tail = F.exp(-x * x / 2) * F.when(x < 7.07106781186547, small).otherwise(far)
    return F.when(t >= 0, tail).otherwise(1 - tail)


def sum_powers(cs: tuple[float, ...], x: Column) -> Column:
    out = F.lit(cs[0])
    for c in cs[1:]:
        out = out * x + c
    return out


def clark_west(forecasts: DataFrame, by: list[str], order: str, actual: str, prediction: str, lags: Column, most_lags: int, least: int = 10) -> DataFrame:
    """Per group: n, whether forecasts beat no change by more than luck (t), and the one-sided p.

    f = y^2 - ((y - p)^2 - p^2); its variance takes in ``lags`` autocovariances
    with falling weights (Newey and West).  t and p are null for fewer than
    ``least`` rows or a variance that is not positive.
    """
    y, p = F.col(actual), F.col(prediction)
    w = Window.partitionBy(*by)
    f = forecasts.select(*by, order, lags.alias("_lag"), (y * y - ((y - p) * (y - p) - p * p)).alias("f")).where("f IS NOT NULL")
    d = f.withColumn("d", F.col("f") - F.avg("f").over(w))
    d = d.withColumns({f"d{k}": F.lag("d", k).over(w.orderBy(order)) for k in range(1, most_lags + 1)})
    weight = lambda k: F.greatest(1 - F.lit(float(k)) / (F.max("_lag") + 1), F.lit(0.0))
    spread = F.sum(F.col("d") * F.col("d"))
    for k in range(1, most_lags + 1):
        spread = spread + 2 * weight(k) * F.coalesce(F.sum(F.col("d") * F.col(f"d{k}")), F.lit(0.0))
    out = d.groupBy(*by).agg(F.count("*").alias("n"), F.avg("f").alias("_m"), spread.alias("_s"))
    var = F.col("_s") / F.col("n")
    out = out.withColumn("t", F.when((F.col("n") >= least) & (var > 0), F.col("_m") / F.sqrt(var / F.col("n"))))
    return out.withColumn("p", upper_tail(F.col("t"))).drop("_m", "_s")


def r2_and_hits(forecasts: DataFrame, by: list[str], actual: str, prediction: str) -> DataFrame:
    """Per group: n, R2 against no change, and how often the sign is right where the forecast has one."""
    y, p = F.col(actual), F.col(prediction)
    hit = F.avg(F.when(p != 0, (F.signum(p) == F.signum(y)).cast("double")))
    return forecasts.groupBy(*by).agg(F.count("*").alias("n"), (1 - safe_ratio(F.sum((y - p) * (y - p)), F.sum(y * y))).alias("r2"), hit.alias("hit_rate"))
