"""Season totals forecast from the pace of sales: anchors, fitted weights, ranges, backtest.

Fits and ranges look at earlier seasons only; a week's neighbours come by
exploding weeks and joining by equality.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .temporal import asof_backward

KEYS = ["commodity", "season", "my_week", "anchor"]


def season_frame(pace: DataFrame, projections: DataFrame, days: int = 7) -> DataFrame:
    """Estimates and outcome of each week, with the newest projection released by the day its sales are published."""
    totals = pace.groupBy("commodity", "season").agg(F.max("final_shipped_mt").alias("final_mt"))
    totals = totals.withColumn("last_season_mt", F.lag("final_mt").over(Window.partitionBy("commodity").orderBy("season")))
    out = pace.select("commodity", "season", "my_week", "week_ending", "commitments_mt", "pace_projection_mt").join(totals, ["commodity", "season"])
    out = out.where("pace_projection_mt > 0 AND last_season_mt > 0").withColumn("published", F.date_add("week_ending", days))
    p = projections.withColumn("usda_release_date", F.col("release_date"))
    return asof_backward(out, p, "published", "release_date", ["commodity", "season"], ["usda_mt", "usda_release_date"]).drop("published")


def anchored(frame: DataFrame) -> DataFrame:
    """The projection if there is one, else last season's total."""
    has = F.coalesce(F.col("usda_mt") > 0, F.lit(False))
    return frame.withColumns({"anchor": F.when(has, "usda").otherwise("last_season"), "anchor_mt": F.when(has, F.col("usda_mt")).otherwise(F.col("last_season_mt"))})


def earlier(rows: DataFrame, history: DataFrame, near: int) -> DataFrame:
    """(rows' keys, history columns) of earlier seasons, at most `near` weeks away, under the same anchor."""
    h = history.withColumn("my_week", F.explode(F.sequence(F.col("my_week") - near, F.col("my_week") + near))).withColumnRenamed("season", "past")
    return rows.select(*KEYS).join(h, ["commodity", "anchor", "my_week"]).where("past < season")


def fit_pace_weight(frame: DataFrame, least: dict[str, int], near: int, fixed: dict[tuple[str, str], float], steps: int = 20) -> DataFrame:
    """Weight on the grid 0, 1/steps .. 1 of least squared error of y ~ level + a x, from sums alone; the level is fitted for projections."""
    x, y = F.log(F.col("pace_projection_mt") / F.col("anchor_mt")), F.log(F.col("final_mt") / F.col("anchor_mt"))
    history = frame.where("final_mt > 0").select("commodity", "season", "my_week", "anchor", x.alias("x"), y.alias("y"))
    sums = {"n": F.count("*"), "n_train_seasons": F.count_distinct("past"), "sx": F.sum("x"), "sy": F.sum("y"), "sxx": F.sum(F.col("x") * F.col("x")), "sxy": F.sum(F.col("x") * F.col("y")), "syy": F.sum(F.col("y") * F.col("y"))}
    s = earlier(frame, history, near).groupBy(*KEYS).agg(*[e.alias(n) for n, e in sums.items()])
    need = F.lit(max(least.values()))
    for anchor, k in least.items():
        need = F.when(F.col("anchor") == anchor, k).otherwise(need)
    s = s.where(F.col("n_train_seasons") >= need)
    grid = F.transform(F.sequence(F.lit(0), F.lit(steps)), lambda i: i / steps)
    for (commodity, anchor), w in fixed.items():
        grid = F.when((F.col("commodity") == commodity) & (F.col("anchor") == anchor), F.array(F.lit(w))).otherwise(grid)
    fitted = F.col("anchor") == "usda"
    level = lambda a: F.when(fitted, (F.col("sy") - a * F.col("sx")) / F.col("n")).otherwise(0.0)
    error = lambda a: F.round(F.col("syy") - 2 * a * F.col("sxy") + a * a * F.col("sxx") - F.when(fitted, F.col("n") * level(a) * level(a)).otherwise(0.0), 9)
    best = F.array_min(F.transform(grid, lambda a: F.struct(error(a).alias("e"), a.alias("a"))))
    return s.withColumn("pace_weight", best["a"]).select(*KEYS, "n_train_seasons", "pace_weight", level(F.col("pace_weight")).alias("level_adjust"))


def season_forecast(frame: DataFrame, fit: DataFrame) -> DataFrame:
    f = F.col("anchor_mt") * F.exp(F.col("level_adjust") + F.col("pace_weight") * F.log(F.col("pace_projection_mt") / F.col("anchor_mt")))
    return frame.join(fit, KEYS).withColumn("forecast_mt", f)


def forecast_range(forecasts: DataFrame, least: int, near: int) -> DataFrame:
    """Quantiles 0.1 and 0.9 of the log misses of earlier, finished seasons' forecasts."""
    misses = forecasts.where("final_mt > 0").select("commodity", "season", "my_week", "anchor", F.log(F.col("final_mt") / F.col("forecast_mt")).alias("miss"))
    r = earlier(forecasts, misses, near).groupBy(*KEYS).agg(F.count_distinct("past").alias("n_range_seasons"), F.percentile("miss", F.lit(0.1)).alias("low"), F.percentile("miss", F.lit(0.9)).alias("high"))
    out = forecasts.join(r, KEYS, "left").withColumn("n_range_seasons", F.coalesce("n_range_seasons", F.lit(0)))
    at = lambda c: F.when(F.col("n_range_seasons") >= least, F.col("forecast_mt") * F.exp(F.col(c)))
    return out.withColumns({"forecast_low_mt": at("low"), "forecast_high_mt": at("high")}).drop("low", "high")


def stage_of(week: Column, stages: list[tuple[int, int]]) -> Column:
    out = F.lit(None).cast("string")
    for a, b in stages:
        out = F.when(week.between(a, b), f"weeks {a}-{b}").otherwise(out)
    return out


def forecast_backtest(forecasts: DataFrame, stages: list[tuple[int, int]], estimates: dict[str, str]) -> DataFrame:
    """Median absolute miss in percent of each estimate, and how often the total lay inside the range."""
    done = forecasts.where("final_mt IS NOT NULL").withColumn("stage", stage_of(F.col("my_week"), stages))
    inside = F.when(F.col("forecast_low_mt").isNotNull(), F.col("final_mt").between(F.col("forecast_low_mt"), F.col("forecast_high_mt")).cast("int"))
    miss = [F.percentile(F.abs(F.col(c) / F.col("final_mt") - 1) * 100, F.lit(0.5)).alias(f"miss_{n}") for n, c in estimates.items()]
    return done.groupBy("commodity", "anchor", "stage").agg(F.count_distinct("season").alias("seasons"), *miss, (100 * F.avg(inside)).alias("in_range_pct"))


def stage_months(backtest: DataFrame, season_start: str) -> DataFrame:
    part = lambda i: F.regexp_extract("stage", r"(\d+)-(\d+)", i).cast("int")
    start = F.lit(season_start).cast("date")
    month = lambda n: F.date_format(F.date_add(start, n), "MMM")
    first, last = (part(1) - 1) * 7 + 6, F.least(part(2) * 7, F.lit(365)) - 1
    return backtest.withColumn("months", F.when(F.col("stage").isNotNull(), F.concat(month(first), F.lit("-"), month(last))))
