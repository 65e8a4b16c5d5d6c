"""Event studies of route shifts: changes after an episode's start against placebo starts, and what returns.

Series are gap-free weekly grids, a row per entity, ship type and week; what is
exploded here (starts by weeks after them) is calendar-sized, whatever the
number of ship positions behind it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_ratio
from .temporal import rows

PRE, GAP, AFTER, SETTLED_FROM, LATEST, YEAR = 8, 2, 26, 13, 3, 52
SERIES = ["chokepoint_id", "ship_type"]


@dataclass(frozen=True)
class Episode:
    name: str
    start: str
    end: str
    route: tuple[str, ...]
    alternatives: tuple[str, ...]


def episode_rows(spark: SparkSession, episodes: list[Episode], lead: int = 4) -> DataFrame:
    """(episode, chokepoint_id, role, start_week, from_day, to_day): the first route comes first; a list of a few rows."""
    out = [(e.name, c, role, i, e.start, e.end) for e in episodes for role, cs in (("route", e.route), ("alternative", e.alternatives)) for i, c in enumerate(cs)]
    df = spark.createDataFrame(out, "episode string, chokepoint_id string, role string, place int, start string, end string")
    return df.select("episode", "chokepoint_id", "role", "place", F.to_date("start").alias("start_week"), F.date_sub(F.to_date("start"), 7 * lead).alias("from_day"), F.to_date("end").alias("to_day"))


def weekly_transits(daily: DataFrame, types: list[str]) -> DataFrame:
    """Mean of each ship type over whole Monday weeks, long."""
    w = daily.withColumn("week_start", F.trunc("transit_date", "week")).groupBy("chokepoint_id", "week_start")
    w = w.agg(F.count("*").alias("days"), *[F.avg(F.col(f"n_{t}").cast("double")).alias(t) for t in types]).where("days = 7")
    return w.unpivot(["chokepoint_id", "week_start"], types, "ship_type", "transits")


def series_grid(weekly: DataFrame) -> DataFrame:
    """Every series on all weeks from the first to the last; y is null where it is missing."""
    ends = weekly.agg(F.min("week_start").alias("a"), F.max("week_start").alias("b"))
    weeks = ends.select(F.explode(F.expr("sequence(a, b, interval 7 days)")).alias("week_start"))
    grid = weekly.select(*SERIES).distinct().crossJoin(F.broadcast(weeks))  # calendar-sized
    return grid.join(weekly.withColumnRenamed("transits", "y"), [*SERIES, "week_start"], "left")


def placebo_starts(grid: DataFrame, episodes: DataFrame) -> DataFrame:
    """(chokepoint_id, method, start_week): weeks whose measured span no episode at that place touches."""
    w = Window.partitionBy("chokepoint_id").orderBy("week_start")
    weeks = grid.select("chokepoint_id", "week_start").distinct()
    spans = weeks.withColumn("hi", F.lead("week_start", AFTER).over(w))
    each = F.array(*[F.struct(F.lit(m).alias("method"), F.lag("week_start", PRE + GAP + k).over(w).alias("lo")) for m, k in (("raw", 0), ("seasonal", YEAR))])
    spans = spans.withColumn("s", each).withColumn("s", F.explode("s")).select("chokepoint_id", "s.method", F.col("week_start").alias("start_week"), "s.lo", "hi").where("lo IS NOT NULL AND hi IS NOT NULL")
    e = episodes.select(F.col("chokepoint_id").alias("at"), "from_day", "to_day")
    touched = (F.col("chokepoint_id") == F.col("at")) & (F.col("hi") >= F.col("from_day")) & (F.col("lo") <= F.col("to_day"))
    return spans.join(e, touched, "left_anti").select("chokepoint_id", "method", "start_week")


def baselines(grid: DataFrame) -> DataFrame:
    """Adds the mean of PRE weeks ending GAP before each week, and both a year earlier."""
    before = rows(SERIES, "week_start", -PRE - GAP, -GAP - 1)
    out = grid.withColumn("base", F.when(F.count("y").over(before) >= PRE // 2, F.avg("y").over(before)))
    o = Window.partitionBy(*SERIES).orderBy("week_start")
    return out.withColumns({"base_year_ago": F.lag("base", YEAR).over(o), "y_change": F.col("y") - F.lag("y", YEAR).over(o)})


def paths(based: DataFrame, starts: DataFrame) -> DataFrame:
    """Change against the baseline in each week after each start; starts have chokepoint_id, method, start_week."""
    at = based.select(*SERIES, F.col("week_start").alias("start_week"), "base", "base_year_ago")
    each = starts.join(at, ["chokepoint_id", "start_week"]).withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(AFTER))))
    each = each.withColumn("week_start", F.expr("date_add(start_week, offset * 7)"))
    seen = based.select(*SERIES, "week_start", "y", "y_change")
    change = F.when(F.col("method") == "raw", F.col("y") - F.col("base")).otherwise(F.col("y_change") - (F.col("base") - F.col("base_year_ago")))
    return each.join(seen, [*SERIES, "week_start"], "left").withColumn("change", change).drop("y", "y_change", "week_start")


def enough_mean(n: Column) -> Column:
    """Mean change, null unless half of n weeks are known; rounded, so that no change is zero in any order of summing."""
    return F.when(F.count("change") >= F.greatest(F.lit(1), F.floor(n / 2)), F.round(F.avg("change"), 12))


def noise(path: DataFrame, keys: list[str], first: Column, last: Column) -> DataFrame:
    """Root mean square of the averaged change over placebo starts."""
    n = last - first + 1
    each = path.where(F.col("offset").between(first, last)).groupBy(*keys, "start_week", n.alias("_n")).agg(enough_mean(F.col("_n")).alias("m"))
    return each.groupBy(*keys).agg(F.sqrt(F.avg(F.col("m") * F.col("m"))).alias("noise"))


def smoothed(keys: list[str]) -> Column:
    """Mean of the known among three weeks of a path."""
    return F.avg("change").over(Window.partitionBy(*keys).orderBy("offset").rowsBetween(-1, 1))


def measure_episodes(grid: DataFrame, episodes: DataFrame, significant: float = 2.0) -> DataFrame:
    """Per episode, place and ship type: the settled change, its noise among placebos, and how fast it came."""
    based, placebo = baselines(grid), placebo_starts(grid, episodes)
    fake = paths(based, placebo)
    settled = noise(fake, [*SERIES, "method"], F.lit(SETTLED_FROM), F.lit(AFTER))
    counts = placebo.groupBy("chokepoint_id", "method").agg(F.count("*").alias("placebos"))
    method = grid.select(*SERIES).distinct().join(settled, SERIES, "left").groupBy(*SERIES)
    # the quieter method; raw at a tie and where neither is known
    method = method.agg(F.coalesce(F.min(F.when(F.col("noise").isNotNull(), F.struct("noise", "method")))["method"], F.lit("raw")).alias("method"))
    starts = episodes.select("episode", "role", "chokepoint_id", "start_week").join(method, "chokepoint_id")
    keys = ["episode", "role", *SERIES]
    real = paths(based, starts.select("episode", "role", "chokepoint_id", "method", "start_week").distinct()).join(method, [*SERIES, "method"], "left_semi")
    whole = Window.partitionBy(*keys)
    real = real.withColumn("weeks_seen", F.coalesce(F.max(F.when(F.col("change").isNotNull(), F.col("offset"))).over(whole) + 1, F.lit(0)))
    is_settled = F.col("weeks_seen") > SETTLED_FROM
    real = real.withColumns({"settled": is_settled, "first": F.when(is_settled, SETTLED_FROM).otherwise(F.greatest(F.lit(0), F.col("weeks_seen") - LATEST)), "last": F.when(is_settled, AFTER).otherwise(F.col("weeks_seen") - 1), "smooth": smoothed(keys)})
    inside = real.where("offset BETWEEN first AND last").groupBy(*keys).agg(enough_mean(F.first("last") - F.first("first") + 1).alias("change"))
    one = real.where("offset = 0").select(*keys, "method", "weeks_seen", "settled", F.col("base").alias("before"), "first", "last")
    one = one.join(inside, keys, "left").join(counts, ["chokepoint_id", "method"], "left").withColumn("placebos", F.coalesce("placebos", F.lit(0)))
    # the noise of the very window that this episode is measured over
    windows = one.select(*SERIES, "method", "first", "last").distinct()
    own = noise(fake.join(windows, [*SERIES, "method"]), [*SERIES, "method", "first", "last"], F.col("first"), F.col("last"))
    one = one.join(own, [*SERIES, "method", "first", "last"], "left").withColumn("z", F.when(F.col("noise") > 0, F.col("change") / F.col("noise")))
    reach = real.select(*keys, "offset", "smooth").join(one.where(F.abs("z") >= significant).select(*keys, F.col("change").alias("target")), keys)
    hit = lambda f: F.min(F.when(F.signum("target") * F.col("smooth") >= f * F.abs("target"), F.col("offset")))
    reach = reach.groupBy(*keys).agg(hit(0.5).alias("half_weeks"), hit(0.9).alias("most_weeks"))
    return one.join(reach, keys, "left").drop("first", "last")


def route_transfers(measured: DataFrame, episodes: DataFrame, significant: float = 2.0) -> DataFrame:
    """The alternatives' gain per ship lost from the first route, with its noise; only where the loss is clear."""
    first = episodes.where("role = 'route' AND place = 0").select("episode", "chokepoint_id", "role")
    lost = measured.join(first, ["episode", "chokepoint_id", "role"]).select("episode", "ship_type", F.col("change").alias("route_change"), F.col("noise").alias("nb"))
    alt = measured.where("role = 'alternative'").groupBy("episode", "ship_type").agg(F.sum("change").alias("alt_change"), F.sqrt(F.sum(F.col("noise") * F.col("noise"))).alias("na"))
    out = lost.join(alt, ["episode", "ship_type"])
    clear = F.abs("route_change") >= significant * F.col("nb")
    out = out.withColumn("ratio", F.when(clear, safe_ratio(-F.col("alt_change"), F.col("route_change"))))
    spread = safe_ratio(F.sqrt(F.col("na") * F.col("na") + F.pow(F.col("ratio") * F.col("nb"), 2)), F.abs("route_change"))
    return out.withColumn("ratio_noise", F.when(clear, spread)).drop("na", "nb")


def lag_curve(grid: DataFrame, measured: DataFrame, episode: str, place: str, start: str) -> DataFrame:
    """(ship_type, offset, share): part of the settled change reached by each week, never falling, within 0 and 1."""
    m = measured.where((F.col("episode") == episode) & (F.col("chokepoint_id") == place)).select("ship_type", "method", F.col("change").alias("target"))
    starts = m.select(F.lit(place).alias("chokepoint_id"), "method", F.to_date(F.lit(start)).alias("start_week")).distinct()
    path = paths(baselines(grid), starts).join(m, ["ship_type", "method"])
    share = F.coalesce(F.greatest(safe_ratio(smoothed(["ship_type"]), F.col("target")), F.lit(0.0)), F.lit(0.0))
    up = Window.partitionBy("ship_type").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    path = path.withColumn("s", share)
    return path.select("ship_type", "offset", F.least(F.max("s").over(up), F.lit(1.0)).alias("share"))


def fit_return(measured: DataFrame, onset: str, back: str, suez: str, cape: str, lead_type: str) -> DataFrame:
    """Per ship type the Cape's gain and what it has lost since; and one share that is back, of the leading type."""
    at = lambda e, c: F.max(F.when((F.col("episode") == e) & (F.col("chokepoint_id") == c), F.col("change")))
    by = measured.groupBy("ship_type").agg(at(onset, cape).alias("gain"), at(back, cape).alias("now"), at(onset, suez).alias("s0"), at(back, suez).alias("s1"))
    one = by.where(F.col("ship_type") == lead_type).select(safe_ratio(F.col("s1"), -F.col("s0")).alias("suez_part"), safe_ratio(-F.col("now"), F.col("gain")).alias("cape_part"))
    one = one.withColumn("share_back", F.least(F.greatest((F.col("suez_part") + F.col("cape_part")) / 2, F.lit(0.0)), F.lit(1.0)))
    return by.select("ship_type", "gain", "now").crossJoin(F.broadcast(one))  # one row


def newest(grid: DataFrame, place: str, recent: int = 3) -> DataFrame:
    """(ship_type, last_week, level): the newest known week of a place and the mean of its last weeks."""
    g = grid.where(F.col("chokepoint_id") == place)
    last = g.where("y IS NOT NULL").groupBy("ship_type").agg(F.max("week_start").alias("last_week"))
    near = g.join(last, "ship_type").where(F.col("week_start").between(F.date_sub("last_week", 7 * (recent - 1)), F.col("last_week")))
    return near.groupBy("ship_type", "last_week").agg(F.avg("y").alias("level"))


def seasonal_step(grid: DataFrame, episodes: DataFrame, place: str, horizon: int = 8, recent: int = 3) -> DataFrame:
    """(ship_type, step, season): the usual change from the last weeks to each target week, over earlier years that no episode touched."""
    g = grid.where(F.col("chokepoint_id") == place).select("ship_type", "week_start", "y")
    first = g.agg(F.min("week_start").alias("first_week"))
    years = newest(grid, place, recent).select("ship_type", "last_week").crossJoin(F.broadcast(first))
    years = years.withColumn("n", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.floor(F.datediff("last_week", "first_week") / 7 / YEAR).cast("int")))))
    years = years.withColumns({"lo": F.expr(f"date_sub(last_week, cast(n * {YEAR * 7} + {7 * (recent - 1)} AS int))"), "hi": F.expr(f"date_add(last_week, cast({7 * horizon} - n * {YEAR * 7} AS int))")}).where("lo >= first_week")
    spans = episodes.where(F.col("chokepoint_id") == place).select("from_day", "to_day").distinct()
    years = years.join(F.broadcast(spans), (F.col("hi") >= F.col("from_day")) & (F.col("lo") <= F.col("to_day")), "left_anti")
    before = years.join(g, "ship_type").where(F.col("week_start").between(F.col("lo"), F.expr(f"date_add(lo, {7 * (recent - 1)})"))).groupBy("ship_type", "n", "last_week").agg(F.avg("y").alias("usual"))
    each = before.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon)))).withColumn("week_start", F.expr(f"date_add(last_week, cast(7 * step - n * {YEAR * 7} AS int))"))
    out = each.join(g, ["ship_type", "week_start"], "left").groupBy("ship_type", "step").agg(F.avg(F.col("y") - F.col("usual")).alias("season"))
    return out.withColumn("season", F.coalesce("season", F.lit(0.0)))


def mirror_forecast(grid: DataFrame, measured: DataFrame, episodes: DataFrame, onset: Episode, back: Episode, suez: str, cape: str, followers: list[str], lead_type: str, horizon: int = 8) -> DataFrame:
    """The next weeks' transits if nothing changes, if the return mirrors the shift, and if all is back at once."""
    curve = lag_curve(grid, measured, onset.name, cape, onset.start)
    fit = fit_return(measured, onset.name, back.name, suez, cape, lead_type)
    method = measured.where((F.col("episode") == onset.name) & (F.col("chokepoint_id") == cape)).select("ship_type", "method")
    base = newest(grid, cape).join(fit, "ship_type").join(method, "ship_type").withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    since = (F.datediff("last_week", F.to_date(F.lit(back.start))) / 7).cast("int") + F.col("step")
    base = base.withColumn("weeks_since_return", since).withColumn("offset", F.least(F.col("weeks_since_return"), F.lit(AFTER)))
    out = base.join(curve, ["ship_type", "offset"], "left").join(seasonal_step(grid, episodes, cape, horizon), ["ship_type", "step"], "left")
    season = F.when(F.col("method") == "seasonal", F.coalesce("season", F.lit(0.0))).otherwise(0.0)
    no_change = F.col("level") + season
    mirror = F.when(F.col("ship_type").isin(*followers), -F.col("share_back") * F.col("gain") * F.col("share") - F.col("now")).otherwise(0.0)
    return out.select(F.expr("date_add(last_week, 7 * step)").alias("week_start"), "ship_type", "weeks_since_return", no_change.alias("no_change"), (no_change + mirror).alias("model"), (no_change - (F.col("gain") + F.col("now"))).alias("all_back"))


FORECASTS = ["model", "no_change", "all_back"]


def forecast_mae(frozen: DataFrame, weekly: DataFrame, place: str) -> DataFrame:
    """Mean absolute error of each forecast by type and overall."""
    actual = weekly.where(F.col("chokepoint_id") == place).select("week_start", "ship_type", F.col("transits").alias("actual"))
    err = [F.avg(F.abs(F.col(c) - F.col("actual"))).alias(c) for c in FORECASTS]
    out = frozen.join(actual, ["week_start", "ship_type"]).groupingSets([("ship_type",), ()], "ship_type").agg(F.grouping("ship_type").alias("g"), F.count("*").alias("weeks"), *err)
    return out.select(F.when(F.col("g") == 1, "all").otherwise(F.col("ship_type")).alias("ship_type"), "weeks", *FORECASTS)
