"""Weekly series on Friday grids and what was known on each Friday.

Features are made long, a row per series and week, with windows over one series
at a time; they go wide only where a model wants columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_ratio
from .temporal import asof_backward


def friday(day: Column) -> Column:
    """The Friday that ends the day's week from Saturday on."""
    return F.date_add(day, F.pmod(4 - F.weekday(day), F.lit(7)))


def fridays(df: DataFrame, day: str, name: str) -> DataFrame:
    """Every Friday between the first day of a table and the last."""
    ends = df.agg(F.min(friday(F.col(day))).alias("a"), F.max(day).alias("b")).where("a <= b")
    return ends.select(F.explode(F.expr("sequence(a, b, interval 7 days)")).alias(name))


def group_flows(daily: DataFrame, day: str, country: str, exports: str, imports: str, exporters: dict[str, list[str]], importers: dict[str, list[str]]) -> DataFrame:
    """(week_end, series, value, days): tonnes of the world's exports and of groups of countries, which may overlap, in one scan.

    days counts the days with a row, so that part weeks can be told.
    """
    cells = [F.struct(F.lit("exp_world").alias("series"), F.col(exports).alias("value"))]
    for prefix, column, groups in (("exp_", exports, exporters), ("imp_", imports, importers)):
        cells += [F.when(F.col(country).isin(*members), F.struct(F.lit(prefix + name).alias("series"), F.col(column).alias("value"))) for name, members in groups.items()]
    each = daily.select(F.col(day).alias("day"), F.explode(F.array_compact(F.array(*cells))).alias("c")).select("day", "c.*")
    by_day = each.groupBy("day", "series").agg(F.sum("value").alias("value"))
    return by_day.groupBy(friday(F.col("day")).alias("week_end"), "series").agg(F.sum("value").alias("value"), F.count("*").alias("days"))


def named_series(df: DataFrame, names: dict[str, Column], keep: list[str]) -> DataFrame:
    """Rows that one of the conditions names, with the name as ``series``."""
    name = F.coalesce(*[F.when(c, F.lit(n)) for n, c in names.items()])
    return df.withColumn("series", name).where("series IS NOT NULL").select("series", *keep)


def week_grid(weekly: DataFrame, full_days: int | None = 7) -> DataFrame:
    """(series, week_end, value) of every series on every Friday between the table's first and last; part weeks are null.

    The calendar and the names of the series are small whatever the table is.
    """
    if full_days is not None:
        weekly = weekly.withColumn("value", F.when(F.col("days") >= full_days, F.col("value")))
    ends = weekly.agg(F.min("week_end").alias("a"), F.max("week_end").alias("b"))
    weeks = ends.select(F.explode(F.expr("sequence(a, b, interval 7 days)")).alias("week_end"))
    grid = weekly.select("series").distinct().crossJoin(F.broadcast(weeks))
    return grid.join(weekly.select("series", "week_end", "value"), ["series", "week_end"], "left")


def wide(grid: DataFrame, series: list[str], values: list[str], index: str = "week_end") -> DataFrame:
    """A column for each series and value; a single value has the series' own name."""
    name = lambda s, x: s if len(values) == 1 else f"{s}_{x}"
    return grid.groupBy(index).agg(*[F.max(F.when(F.col("series") == s, F.col(x))).alias(name(s, x)) for s in series for x in values])


def log_ratio(a: Column, b: Column) -> Column:
    """ln(a / b), null where it is not finite."""
    r = safe_ratio(a, b)
    return F.when(r > 0, F.log(r))


def flow_features(grid: DataFrame) -> DataFrame:
    """Adds w4, a week against the known weeks among the 4 before, and yoy, the last 4 against the same 4 a year earlier."""
    w = Window.partitionBy("series").orderBy("week_end")
    mean = lambda a, b: F.avg("value").over(w.rowsBetween(a, b))
    return grid.withColumns({"w4": log_ratio(F.col("value"), mean(-4, -1)), "yoy": log_ratio(mean(-3, 0), mean(-55, -52))})


def stock_features(grid: DataFrame, years: int = 5) -> DataFrame:
    """Adds chg1 and chg4, changes over 1 and 4 weeks, and dev5y, the gap to the mean of the known same weeks of earlier years.

    The grid has every week, so 52 rows are a year of weeks whatever weeks the
    source leaves out or numbers 53.
    """
    w = Window.partitionBy("series").orderBy("week_end")
    x = F.col("value")
    same = F.array_compact(F.array(*[F.lag(x, 52 * k).over(w) for k in range(1, years + 1)]))
    mean = F.when(F.size(same) > 0, F.aggregate(same, F.lit(0.0), lambda a, b: a + b) / F.size(same))
    return grid.withColumns({"chg1": safe_ratio(x, F.lag(x, 1).over(w)) - 1, "chg4": safe_ratio(x, F.lag(x, 4).over(w)) - 1, "dev5y": safe_ratio(x, mean) - 1})


def at_or_before(days: DataFrame, day: Column, prices: DataFrame, values: dict[str, str]) -> DataFrame:
    """days with each value, under a new name, of the last price row at or before ``day``; one market, so calendar-sized."""
    one = lambda df: df.withColumn("_market", F.lit(1))
    right = one(prices.select(F.col("price_date").alias("_at"), *[F.col(c).alias(n) for c, n in values.items()]))
    return asof_backward(one(days.withColumn("_day", day)), right, "_day", "_at", ["_market"], list(values.values())).drop("_day", "_market")


def origin_prices(prices: DataFrame, origins: DataFrame) -> DataFrame:
    """What each origin's last close tells: log changes over 1, 4, 13 and 52 weeks, volatility, spread and its change, distance to the high.

    Volatility is of 20 daily changes, annualised; the high is that of 260 closes, given 200 of them.
    """
    w = Window.partitionBy("_market").orderBy("price_date")
    daily = prices.withColumn("_market", F.lit(1)).withColumn("_r", F.log(F.col("brent_usd") / F.lag("brent_usd").over(w)))
    w20, w260 = w.rowsBetween(-19, 0), w.rowsBetween(-259, 0)
    vol = F.when(F.count("_r").over(w20) == 20, F.stddev_samp("_r").over(w20) * F.sqrt(F.lit(252.0)))
    high = F.when(F.count("brent_usd").over(w260) >= 200, F.max("brent_usd").over(w260))
    daily = daily.withColumns({"vol4": vol, "spread": F.col("brent_usd") - F.col("wti_usd"), "high52": high})
    out = at_or_before(origins, F.col("origin"), daily, {c: c for c in ("brent_usd", "vol4", "spread", "high52")})
    for weeks in (1, 4, 13, 52):
        back = {"brent_usd": f"_b{weeks}"} | ({"spread": "_s4"} if weeks == 4 else {})
        out = at_or_before(out, F.date_sub("origin", 7 * weeks), daily, back)
    changes = {f"r{k}": F.log(F.col("brent_usd") / F.col(f"_b{k}")) for k in (1, 4, 13, 52)}
    out = out.withColumns(changes | {"spread_chg4": F.col("spread") - F.col("_s4"), "dd52": F.log(F.col("brent_usd") / F.col("high52"))})
    return out.drop("high52", "_s4", *[f"_b{k}" for k in (1, 4, 13, 52)])


def price_targets(prices: DataFrame, origins: DataFrame, horizons: tuple[int, ...]) -> DataFrame:
    """origin and y_h, the log change of the close h weeks later; null until that day has come."""
    newest = prices.agg(F.max("price_date").alias("_newest"))
    out = at_or_before(origins, F.col("origin"), prices, {"brent_usd": "_now"}).crossJoin(F.broadcast(newest))
    for h in horizons:
        later = F.date_add("origin", 7 * h)
        out = at_or_before(out, later, prices, {"brent_usd": "_later"})
        out = out.withColumn(f"y{h}", F.when(later <= F.col("_newest"), F.log(F.col("_later") / F.col("_now")))).drop("_later")
    return out.drop("_now", "_newest")


def known_by(origins: DataFrame, weekly: DataFrame, lag_weeks: int) -> DataFrame:
    """Joins the newest week of a wide table that was published by each origin.

    weekly has ``published``, the day from which its row may be used.  A week that
    ended more than ``lag_weeks`` before the origin is too old: its columns are null.
    """
    columns = [c for c in weekly.columns if c not in ("week_end", "published")]
    row = weekly.select(F.col("published").alias("price_date"), F.struct("week_end", *columns).alias("_week"))
    out = at_or_before(origins, F.col("origin"), row, {"_week": "_week"})
    fresh = F.col("_week.week_end") >= F.date_sub("origin", 7 * lag_weeks)
    return out.select(*origins.columns, *[F.when(fresh, F.col(f"_week.`{c}`")).alias(c) for c in columns])
