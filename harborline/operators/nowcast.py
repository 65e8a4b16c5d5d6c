"""Monthly nowcasts: official figures that come out late, told from port activity that is known at once.

Panels have a row per entity and calendar month, so a window over an entity is
as long as the calendar.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_ratio
from .temporal import full_mean


def series_totals(trade: DataFrame, series: dict[str, tuple[str, tuple[str, ...]]], month: str, flow: str, code: str, value: str) -> DataFrame:
    """(series, month, value): a row counts for every series whose flow and codes it has, in one scan."""
    names = F.array_compact(F.array(*[F.when((F.col(flow) == f) & F.col(code).isin(*codes), F.lit(name)) for name, (f, codes) in series.items()]))
    each = trade.select(F.explode(names).alias("series"), F.col(month).alias("month"), F.col(value).alias("value"))
    return each.groupBy("series", "month").agg(F.sum("value").alias("value"))


def complete_months(daily: DataFrame, keys: list[str], day: str, sums: dict[str, str], extra: list[Column] | None = None) -> DataFrame:
    """Sums by key and month of the months that have a row on every day; sums names the result columns."""
    month = F.trunc(F.col(day), "month").alias("month")
    out = daily.groupBy(*keys, month).agg(*[F.sum(c).alias(n) for n, c in sums.items()], *(extra or []), F.count_distinct(F.col(day)).alias("_days"))
    return out.where(F.col("_days") == F.day(F.last_day("month"))).drop("_days")


def month_grid(df: DataFrame, entity: str) -> DataFrame:
    """(entity, month) for every calendar month between an entity's first and its last."""
    ends = df.groupBy(entity).agg(F.min("month").alias("a"), F.max("month").alias("b"))
    return ends.select(entity, F.explode(F.expr("sequence(a, b, interval 1 month)")).alias("month"))


def monthly_panel(official: DataFrame, activity: DataFrame, flows: dict[str, str], regions: tuple[str, ...]) -> DataFrame:
    """(series, month, official, a column per region, activity) on a calendar grid.

    activity is long: region, flow, month, tonnes, complete months only.  A month
    that no region has is null throughout; a region without a row in another
    month counts as 0.  official is null where it is not out.
    """
    wide = activity.groupBy("flow", "month").agg(*[F.coalesce(F.sum(F.when(F.col("region") == r, F.col("tonnes"))), F.lit(0.0)).alias(r) for r in regions])
    wanted = F.explode(F.array_compact(F.array(*[F.when(F.col("flow") == f, F.lit(s)) for s, f in flows.items()])))
    wide = wide.withColumn("series", wanted).drop("flow")
    out = month_grid(wide, "series").join(wide, ["series", "month"], "left").join(official.select("series", "month", F.col("value").alias("official")), ["series", "month"], "left")
    return out.select("series", "month", "official", *regions, sum((F.col(r) for r in regions[1:]), F.col(regions[0])).alias("activity"))


def median_ratio(entity: str, actual: str, current: str, first: int, last: int, least: int) -> Column:
    """The median of actual / current over the frame of whole months [first, last], given ``least`` of them, times this month's current."""
    w = Window.partitionBy(entity).orderBy("month")
    frame = w.rowsBetween(first, last)
    ratio = safe_ratio(F.col(actual), F.col(current))
    enough = (F.row_number().over(w) > -first) & (F.count(ratio).over(frame) >= least)
    return F.when(enough, F.percentile(ratio, F.lit(0.5)).over(frame)) * F.col(current)


def nowcast_guesses(panel: DataFrame, entity: str = "series", actual: str = "official", current: str = "activity") -> DataFrame:
    """What simple models say of each month from official figures before it and activity up to it."""
    w = Window.partitionBy(entity).orderBy("month")
    y, x = F.col(actual), F.col(current)
    out = panel.withColumns({
        "last": F.lag(y, 1).over(w),
        "avg3": full_mean(y, w.rowsBetween(-3, -1), 3),
        "ratio12": median_ratio(entity, actual, current, -12, -1, 7),
        "ratio3": median_ratio(entity, actual, current, -3, -1, 2),
        "change": safe_ratio(F.lag(y, 1).over(w) * x, F.lag(x, 1).over(w)),
    })
    return out.withColumn("blend", (F.col("ratio12") + F.col("avg3")) / 2)


def nonnegative_weights(g: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The x >= 0 that minimises x'gx - 2c'x: variables enter where the gradient asks for it and leave where they would turn negative."""
    x, inside = np.zeros(len(c)), np.zeros(len(c), bool)
    tiny = 1e-12 * max(float(np.abs(c).max(initial=0.0)), 1e-300)
    for _ in range(8 * len(c) + 8):
        slope = np.where(inside, -np.inf, c - g @ x)
        k = int(slope.argmax())
        if slope[k] <= tiny:
            break
        inside[k] = True
        while True:
            at = np.flatnonzero(inside)
            best = np.zeros(len(c))
            best[at] = np.linalg.lstsq(g[np.ix_(at, at)], c[at], rcond=None)[0]
            low = at[best[at] <= 0]
            if not len(low):
                x = best
                break
            step = (x[low] / (x[low] - best[low])).min()
            x = x + step * (best - x)
            inside[low[x[low] <= 1e-14 * max(1.0, x.max())]] = False
            x[~inside] = 0
            if not inside.any():
                break
    return x


def nonnegative_fit(panel: DataFrame, entity: str, actual: str, inputs: list[str], first: int, last: int, least: int) -> DataFrame:
    """Adds n, weights and guess: non-negative least squares of actual on the inputs over the frame [first, last].

    A month's products are summed over the frame by windows, so each row carries
    a matrix of the inputs' number; only that is solved in Python.  Rows with a
    null in actual or an input do not count; null without ``least`` of them, or
    where the frame starts before the series.
    """
    w = Window.partitionBy(entity).orderBy("month")
    frame = w.rowsBetween(first, last)
    known = F.col(actual).isNotNull()
    for c in inputs:
        known = known & F.col(c).isNotNull()
    total = lambda x: F.coalesce(F.sum(F.when(known, x)).over(frame), F.lit(0.0))
    k = len(inputs)
    cells = {(i, j): total(F.col(inputs[i]) * F.col(inputs[j])) for i in range(k) for j in range(i, k)}
    square = F.array(*[cells[min(i, j), max(i, j)] for i in range(k) for j in range(k)])

    @F.pandas_udf("array<double>")
    def solve(g: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([None if a is None else nonnegative_weights(np.array(a, float).reshape(k, k), np.array(b, float)) for a, b in zip(g, c, strict=True)])

    enough = (F.row_number().over(w) > -first) & (F.count(F.when(known, 1)).over(frame) >= least)
    out = panel.withColumns({"n": F.count(F.when(known, 1)).over(frame), "_g": F.when(enough, square), "_c": F.when(enough, F.array(*[total(F.col(actual) * F.col(c)) for c in inputs]))})
    out = out.withColumn("weights", solve("_g", "_c")).drop("_g", "_c")
    return out.withColumn("guess", sum((F.col("weights")[i] * F.col(c) for i, c in enumerate(inputs[1:], 1)), F.col("weights")[0] * F.col(inputs[0])))


def terminal_panel(monthly: DataFrame, country: str, port: str, name: str, tonnes: str, terminals: dict[str, tuple[str, ...]], offshore: str, early: str, top: int) -> DataFrame:
    """(country, month, total, terminals, port_1 ... port_top) on a calendar grid of each country.

    monthly has complete months of single ports.  terminals are the named ports
    of a country and all whose name contains ``offshore``.  port_i is the i-th
    port of the country by tonnes before ``early``, 0 where it has no row or does
    not exist.  A month that no port has is null throughout.
    """
    named = F.lit(False)
    for c, names in terminals.items():
        named = named | ((F.col(country) == c) & F.col(name).isin(*names))
    named = F.coalesce(named | F.contains(F.col(name), F.lit(offshore)), F.lit(False))
    big = monthly.where(F.col("month") < early).groupBy(country, port).agg(F.sum(tonnes).alias("_t"))
    rank = F.row_number().over(Window.partitionBy(country).orderBy(F.desc("_t"), port))  # a row per port
    big = big.withColumn("_r", rank).where(F.col("_r") <= top).select(country, port, "_r")
    rows = monthly.withColumn("_named", named).join(big, [country, port], "left")
    of = lambda c: F.coalesce(F.sum(F.when(c, F.col(tonnes))), F.lit(0.0))
    wide = rows.groupBy(country, "month").agg(F.sum(tonnes).alias("total"), of(F.col("_named")).alias("terminals"), *[of(F.col("_r") == i).alias(f"port_{i}") for i in range(1, top + 1)])
    return month_grid(wide, country).join(wide, [country, "month"], "left")


def lagged_guesses(panel: DataFrame, entity: str, actual: str = "reported", lag: int = 2) -> DataFrame:
    """Models for figures that come ``lag`` months late: last known, ratios over the 12 newest known months, change of the terminals."""
    w = Window.partitionBy(entity).orderBy("month")
    positive = panel.withColumn("_y", F.when(F.col(actual) > 0, F.col(actual)))
    y = F.lag(actual, lag).over(w)
    out = positive.withColumns({
        "last": y,
        "country_ratio": median_ratio(entity, "_y", "total", -lag - 11, -lag, 6),
        "terminal_ratio": median_ratio(entity, "_y", "terminals", -lag - 11, -lag, 6),
        "terminal_change": safe_ratio(y * F.col("terminals"), F.lag("terminals", lag).over(w)),
    })
    return out.drop("_y")


def nearest_quantile(values: Column, q: float) -> Column:
    """The value of a sorted array that is nearest to the quantile; null of an empty one."""
    at = F.round(q * (F.size(values) - 1)).cast("int")
    return F.when(F.size(values) > 0, F.get(values, at))


def published_nowcast(guesses: DataFrame, official: DataFrame, entity: str, model: str, first: str, test_from: int) -> DataFrame:
    """The table that is published: a row for each month from ``first`` that activity is complete in.

    error_pct is null for live months, whose figure is not out.  typical and p90
    are the median and the nearest 90th percentile of the absolute error over
    all tested months; typical_then and p90_then take only months before the
    row's own.  official_through is the newest month with a figure.
    """
    rows = guesses.where((F.col("month") >= first) & F.col("activity").isNotNull() & F.col(model).isNotNull())
    error = F.when(F.col("official") != 0, 100 * (F.col(model) / F.col("official") - 1))
    rows = rows.select(entity, "month", F.col(model).alias("nowcast"), "official", error.alias("error_pct"), "activity", F.col("official").isNull().alias("is_live"), F.lit(model).alias("model"))
    tested = F.when(F.year("month") >= test_from, F.abs("error_pct"))
    everything = Window.partitionBy(entity)
    before = everything.orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    errors: Callable = lambda w: F.array_sort(F.collect_list(tested).over(w))
    through = official.where("value IS NOT NULL").groupBy(entity).agg(F.max("month").alias("official_through"))
    out = rows.withColumns({"_all": errors(everything), "_then": errors(before), "typical_error_pct": F.percentile(tested, F.lit(0.5)).over(everything), "typical_then_pct": F.percentile(tested, F.lit(0.5)).over(before)})
    out = out.withColumns({"p90_error_pct": nearest_quantile(F.col("_all"), 0.9), "p90_then_pct": nearest_quantile(F.col("_then"), 0.9)}).drop("_all", "_then")
    return out.join(through, entity, "left")
