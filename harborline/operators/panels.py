"""Daily and weekly panels: rolling means, comparisons with a year ago, weekly sums, drop labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import clip, pct_change, safe_ratio, week_start
from .spatial import spatial_join
from .temporal import calendar_days, full_mean, rows, weekly_grid


def rolling_days(df: DataFrame, entity: str, day: str, values: list[str]) -> DataFrame:
    """Means of 7 days and of the 28 before them; null until a frame holds 7 and 28 rows."""
    week, prior = calendar_days([entity], day, -6, 0), calendar_days([entity], day, -34, -7)
    return df.withColumns({f"{v}_7d": full_mean(F.col(v), week, 7) for v in values} | {f"{v}_prior_28d": full_mean(F.col(v), prior, 28) for v in values})


def year_ago(df: DataFrame, entity: str, day: str, values: list[str]) -> DataFrame:
    """Each value 364 days earlier, the same weekday, and the change in percent."""
    before = df.select(entity, F.date_add(day, 364).alias(day), *[F.col(v).alias(f"{v}_year_ago") for v in values])
    out = df.join(before, [entity, day], "left")
    return out.withColumns({f"{v}_vs_year_ago_pct": pct_change(F.col(v), F.col(f"{v}_year_ago")) for v in values})


def hazards_near(days: DataFrame, places: DataFrame, events: DataFrame, entity: str, day: str, radius_km: float) -> DataFrame:
    """Events in force within the radius of each entity on each day: how many, their kinds, the worst alert.

    Events meet places first, by place; a pair then lasts for its days.
    """
    near = spatial_join(places, events, radius_km, entity, "event_id").drop("km")
    pairs = near.join(events.select("event_id", "event_type", "alert_level", "from_date", "to_date"), "event_id")
    each = pairs.withColumn(day, F.explode(F.sequence("from_date", "to_date")))
    worst = F.max(F.when(F.col("alert_level") == "RED", 3).when(F.col("alert_level") == "ORANGE", 2).otherwise(1))
    found = each.groupBy(entity, day).agg(F.count_distinct("event_id").alias("nearby_events"), F.array_join(F.array_sort(F.collect_set("event_type")), "; ").alias("nearby_types"), worst.alias("nearby_max_alert"))
    return days.select(entity, day).join(found, [entity, day], "left").withColumn("nearby_events", F.coalesce("nearby_events", F.lit(0)))


def port_weekly(activity: DataFrame, sums: list[str]) -> DataFrame:
    """Monday weeks per port: days reported, whether all seven are, sums, and the latest name."""
    df = activity.withColumn("week_start", week_start(F.col("activity_date")))
    out = df.groupBy("week_start", "port_id").agg(F.max_by("port_name", "activity_date").alias("port_name"), F.max_by("country", "activity_date").alias("country"), F.count_distinct("activity_date").alias("days_reported"), *[F.sum(c).alias(c) for c in sums])
    return out.withColumn("is_complete_week", F.col("days_reported") == 7)


def trailing(df: DataFrame, entity: str, order: str, value: str, sizes: list[int]) -> DataFrame:
    """Means of the known values among the last n rows, for each n."""
    return df.withColumns({f"mean_{n}": F.avg(value).over(rows(entity, order, 1 - n, 0)) for n in sizes})


def label_drops(grid: DataFrame, entity: str, week: str, base_weeks: int = 13, min_known: int = 10, min_base: float = 10.0, min_drop: float = 0.30, min_z: float = 2.5) -> DataFrame:
    """Marks weeks far below the weeks before them; a week is never in its own baseline."""
    w = rows(entity, week, -base_weeks, -1)
    known = F.count("y").over(w) >= min_known
    quantile = lambda q: F.when(known, F.percentile("y", F.lit(q)).over(w))
    out = grid.withColumns({"base": quantile(0.5), "q1": quantile(0.25), "q3": quantile(0.75)})
    out = out.withColumn("spread", F.greatest((F.col("q3") - F.col("q1")) / 1.349, F.sqrt("base")))
    ok = F.coalesce(F.col("y").isNotNull() & (F.col("base") >= min_base), F.lit(False))
    out = out.withColumns({"eligible": ok, "z": F.when(ok, (F.col("y") - F.col("base")) / F.col("spread")), "drop_pct": F.when(ok, 1 - F.col("y") / F.col("base"))})
    return out.withColumn("is_drop", F.when(ok, (F.col("drop_pct") >= min_drop) & (F.col("z") <= -min_z))).drop("q1", "q3")


def seasonal_flags(labels: DataFrame, entity: str, week: str) -> DataFrame:
    """A drop within a week of the same week last year makes a drop seasonal."""
    w = Window.partitionBy(entity).orderBy(week)
    past = [F.lag("is_drop", k).over(w) for k in (51, 52, 53)]
    seen = F.coalesce(*past).isNotNull()
    any_drop = F.coalesce(past[0], F.lit(False)) | F.coalesce(past[1], F.lit(False)) | F.coalesce(past[2], F.lit(False))
    return labels.withColumns({"is_seasonal": F.when(seen, F.col("is_drop") & any_drop), "is_disruption": F.when(seen, F.col("is_drop") & ~any_drop)})


def drop_episodes(labels: DataFrame, entity: str, week: str) -> DataFrame:
    """Runs of drop weeks among eligible rows."""
    w = Window.partitionBy(entity).orderBy(week)
    rows_ = labels.where("eligible").withColumn("change", F.when(F.lag("is_drop").over(w).eqNullSafe(F.col("is_drop")), 0).otherwise(1))
    rows_ = rows_.withColumn("run", F.sum("change").over(w)).where("is_drop")
    out = rows_.groupBy(entity, "run").agg(F.min(week).alias("start_week"), F.count("*").alias("weeks"), F.max("drop_pct").alias("deepest"), F.min_by("base", week).alias("base"))
    return out.drop("run")


def base_rate(labels: DataFrame, entity: str, week: str, shrink: float = 26.0) -> DataFrame:
    """Cumulative drop rate of each entity, drawn to the pooled rate up to the same week."""
    w = Window.partitionBy(entity).orderBy(week).rowsBetween(Window.unboundedPreceding, 0)
    hit = F.coalesce(F.col("is_drop").cast("int"), F.lit(0))
    known = F.col("is_drop").isNotNull().cast("int")
    own = labels.withColumns({"hits": F.sum(hit).over(w), "known": F.sum(known).over(w)})
    # pooled counts are calendar-sized: one row per week before the running sum
    weekly = labels.groupBy(week).agg(F.sum(hit).alias("h"), F.sum(known).alias("k"))
    run = Window.orderBy(week).rowsBetween(Window.unboundedPreceding, 0)
    pooled = weekly.select(week, safe_ratio(F.sum("h").over(run), F.sum("k").over(run)).alias("pooled"))
    out = own.join(pooled, week)
    return out.withColumn("base_rate", (F.col("hits") + shrink * F.coalesce("pooled", F.lit(0.0))) / (F.col("known") + shrink))


def warning_rows(rated: DataFrame, entity: str, week: str, horizons: int = 3) -> DataFrame:
    """One row per origin week, entity and horizon with the outcome in the target week."""
    w = Window.partitionBy(entity).orderBy(week)
    out = F.array(*[F.struct(F.lit(h).alias("horizon"), F.lead(week, h).over(w).alias("target_week"), F.lead("is_drop", h).over(w).cast("int").alias("y"), F.lead("drop_pct", h).over(w).alias("target_drop")) for h in range(1, horizons + 1)])
    each = rated.withColumn("h", out).withColumn("h", F.explode("h"))
    big = F.when(F.col("h.y").isNotNull(), (F.col("h.y") == 1) & (F.col("h.target_drop") >= 0.5))
    return each.select(F.col(week).alias("origin_week"), "h.target_week", "h.horizon", entity, "h.y", big.alias("big"), "base_rate", F.col("z").alias("origin_z"), F.col("is_drop").alias("origin_drop")).where("y IS NOT NULL")


def rule_scores(df: DataFrame) -> DataFrame:
    """Simple rules as scores: the last z, and the drop flag with the base rate to break ties."""
    return df.withColumns({"last_z": F.coalesce(-F.col("origin_z"), F.lit(0.0)), "last_drop": F.coalesce(F.col("origin_drop").cast("double"), F.lit(0.0)) + F.col("base_rate") / 2})


def top_budget_alerts(df: DataFrame, group: list[str], score: str, tie: str, share: float) -> DataFrame:
    """Flags the top ceil(share * n) rows of each group."""
    n = F.count("*").over(Window.partitionBy(*group))
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col(score).desc(), tie))
    return df.withColumn("rank", rank).withColumn("flagged", F.col("rank") <= F.ceil(n * share))


def average_precision(df: DataFrame, group: list[str], score: str, label: str) -> DataFrame:
    """AP per group, rows of equal score as one block; null without positives."""
    blocks = df.groupBy(*group, score).agg(F.sum(label).alias("tp"), F.count("*").alias("n"))
    w = Window.partitionBy(*group).orderBy(F.col(score).desc()).rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.withColumns({"ctp": F.sum("tp").over(w), "cn": F.sum("n").over(w)})
    out = blocks.groupBy(*group).agg(F.sum(F.col("tp") * F.col("ctp") / F.col("cn")).alias("s"), F.sum("tp").alias("positives"), F.sum("n").alias("n"))
    return out.select(*group, "n", "positives", safe_ratio(F.col("s"), F.col("positives")).alias("average_precision"))


def history_features(df: DataFrame, entity: str, order: str) -> DataFrame:
    """Lags, means, variation, trend and comparison with a year ago of a gap-free series y."""
    w = Window.partitionBy(entity).orderBy(order)
    mean = lambda n: F.avg("y").over(rows(entity, order, 1 - n, 0))
    sq = F.avg(F.col("y") * F.col("y")).over(rows(entity, order, -12, 0))
    out = df.withColumns({f"lag_{k}": F.lag("y", k).over(w) for k in range(4)} | {f"mean_{n}": mean(n) for n in (4, 8, 13, 52)})
    out = out.withColumns({"cv_13": safe_ratio(F.sqrt(F.greatest(sq - F.col("mean_13") * F.col("mean_13"), F.lit(0.0))), F.col("mean_13")), "trend": safe_ratio(F.col("mean_4"), F.col("mean_13")), "mean_4_year_ago": F.lag("mean_4", 52).over(w)})
    return out.withColumn("vs_year_ago", safe_ratio(F.col("mean_4"), F.col("mean_4_year_ago")))


def baseline_forecasts(grid: DataFrame, entity: str, week: str, horizons: int = 4, year: int = 52) -> DataFrame:
    """Simple forecasts of each target week from each origin; rows without an actual go."""
    w = Window.partitionBy(entity).orderBy(week)
    m8, m4 = F.avg("y").over(rows(entity, week, -7, 0)), F.avg("y").over(rows(entity, week, -3, 0))
    df = grid.withColumns({"m8": m8, "last_4": m4})
    df = df.withColumn("before", F.lag("m8", year).over(w))
    ratio = F.when(F.col("before") == 0, F.lit(5.0)).otherwise(clip(F.col("m8") / F.col("before"), 0.2, 5.0))
    df = df.withColumn("ratio", F.coalesce(F.when(F.col("m8").isNotNull() & F.col("before").isNotNull(), ratio), F.lit(1.0)))

    def at(h: int):  # noqa: ANN202
        past = [F.lag("y", year * k - h).over(w) for k in (1, 2, 3)]
        known = F.filter(F.array(*past), lambda x: x.isNotNull())
        mean = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known))
        return F.struct(F.lit(h).alias("horizon"), F.lead("y", h).over(w).alias("actual"), past[0].alias("last_year"), (past[0] * F.col("ratio")).alias("last_year_scaled"), mean.alias("seasonal_avg"))

    each = df.withColumn("f", F.array(*[at(h) for h in range(1, horizons + 1)])).withColumn("f", F.explode("f"))
    return each.select(entity, F.col(week).alias("origin_week"), "f.horizon", "f.actual", "f.last_year", "f.last_year_scaled", "last_4", "f.seasonal_avg").where("actual IS NOT NULL")


def score_wape(forecasts: DataFrame, group: list[str], models: list[str], reference: str) -> DataFrame:
    """Weighted absolute error of each model over rows that all models have, by group, and against a reference."""
    known = forecasts.where(" AND ".join(f"{m} IS NOT NULL" for m in models))
    err = lambda m: F.sum(F.abs(F.col(m) - F.col("actual")))
    out = known.groupBy(*group).agg(F.count("*").alias("n"), F.sum("actual").alias("total"), *[err(m).alias(f"e_{m}") for m in models])
    return out.select(*group, "n", "total", *[safe_ratio(F.col(f"e_{m}"), F.col("total")).alias(f"wape_{m}") for m in models], *[safe_ratio(F.col(f"e_{m}"), F.col(f"e_{reference}")).alias(f"rel_{m}") for m in models])
