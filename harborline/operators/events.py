"""Hazard events around ports, event studies, and the warning record."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import haversine_km
from .spatial import spatial_join
from .temporal import rows


def prepare_events(events: DataFrame) -> DataFrame:
    """One row per event: droughts out, red if any copy is, first day, first known place, listed ports."""
    known = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull(), F.struct("from_date", "latitude", "longitude"))
    out = events.where("event_type <> 'DR'").groupBy("event_id")
    out = out.agg(F.max((F.upper("alert_level") == "RED").cast("int")).cast("boolean").alias("is_red"), F.min("from_date").alias("from_date"), F.min(known).alias("p"), F.collect_set("listed_port").alias("ports"))
    return out.select("event_id", "is_red", "from_date", "p.latitude", "p.longitude", "ports")


def event_exposure(events: DataFrame, ports: DataFrame, radius_km: float = 800.0, weeks: int = 3) -> DataFrame:
    """(port, event, week): ports within the radius or listed, in the starting week and those after it."""
    near = spatial_join(ports, events, radius_km, "port_id", "event_id")
    listed = events.select("event_id", F.explode("ports").alias("port_id"), F.lit(True).alias("listed"))
    both = near.join(listed, ["port_id", "event_id"], "full").join(events.select("event_id", "is_red", "from_date"), "event_id")
    both = both.withColumn("week_start", F.explode(hit_weeks("from_date", weeks)))
    return both.select("port_id", "event_id", "week_start", "km", F.coalesce("listed", F.lit(False)).alias("listed"), "is_red", "from_date")


def daily_exposure(events: DataFrame, ports: DataFrame, radius_km: float = 800.0, task_rows: int = 500_000) -> DataFrame:
    """What event_exposure holds, summed by port and first day of the events: (port_id, from_date, n, n_red, red_km, nearest).

    An event counts once for each of its kinds; nearest is the least (km, event_id,
    event_type), an unknown distance last.  Events are dealt to tasks of
    task_rows rows or so and meet ports, which are few, where they are; what
    leaves a task is a row per port and day.
    """
    parts = max(1, math.ceil(events.count() / task_rows))
    dealt = events.repartition(parts, "event_id")
    kind = F.struct("event_type")
    some = F.col("event_type") != "DR"
    known = F.when(F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & some, F.struct("from_date", "latitude", "longitude"))
    each = dealt.groupBy("event_id").agg(F.count_if(some).alias("rows"), F.max(F.when(some, (F.upper("alert_level") == "RED").cast("int"))).cast("boolean").alias("is_red"), F.min(F.when(some, F.col("from_date"))).alias("from_date"), F.min(known).alias("p"), F.collect_set(F.when(some, F.col("listed_port"))).alias("ports"), F.collect_set(kind).alias("kinds"))
    each = each.where("rows > 0").select(F.struct("event_id", "is_red", "from_date", "ports", "kinds").alias("e"), "p.latitude", "p.longitude")
    near = spatial_join(each, ports, radius_km, "e", "port_id").select("port_id", "e", "km")
    # listed ports that the radius has not found
    place = F.broadcast(ports.select("port_id", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon")))
    listed = each.withColumn("port_id", F.explode("e.ports")).join(place, "port_id", "left")
    km = haversine_km(F.col("latitude"), F.col("longitude"), F.col("_lat"), F.col("_lon"))
    listed = listed.where(F.coalesce(km > radius_km, F.lit(True))).select("port_id", "e", F.lit(None).cast("double").alias("km"))
    both = near.unionByName(listed)
    n, red = F.size("e.kinds"), F.col("e.is_red")
    nearest = F.struct(F.coalesce("km", F.lit(1e9)).alias("km"), F.col("e.event_id").alias("event_id"), F.array_min("e.kinds")["event_type"].alias("event_type"))
    return both.groupBy("port_id", F.col("e.from_date").alias("from_date")).agg(F.sum(n).alias("n"), F.sum(F.when(red, n).otherwise(0)).alias("n_red"), F.min(F.when(red, F.col("km"))).alias("red_km"), F.min(nearest).alias("nearest"))


def hit_weeks(from_date: str, weeks: int = 3):  # noqa: ANN201
    """The starting week of a day and those after it."""
    return F.transform(F.sequence(F.lit(0), F.lit(weeks - 1)), lambda k: F.date_add(F.trunc(from_date, "week"), k * 7))


def attach_events(warnings: DataFrame, exposure: DataFrame, release_days: int = 15) -> DataFrame:
    """Nearest and listed events of the target week that were known when the origin was released."""
    e = exposure.withColumnRenamed("week_start", "target_week")
    known = warnings.join(e, ["port_id", "target_week"]).where(F.col("from_date") <= F.date_add("origin_week", release_days))
    best = known.groupBy("origin_week", "target_week", "horizon", "port_id").agg(F.min("km").alias("event_km"), F.max("listed").alias("event_listed"))
    out = warnings.join(best, ["origin_week", "target_week", "horizon", "port_id"], "left")
    return out.withColumn("event_listed", F.coalesce("event_listed", F.lit(False)))


def region_features(labels: DataFrame, ports: DataFrame, radius_km: float = 500.0) -> DataFrame:
    """Neighbours' share of drops and mean z per port and week, and the world's share."""
    other = ports.withColumnRenamed("port_id", "other_id")
    pairs = spatial_join(ports, other, radius_km, "port_id", "other_id").where("port_id <> other_id")
    near = labels.where("eligible").select(F.col("port_id").alias("other_id"), "week_start", "is_drop", "z")
    drop = F.avg(F.col("is_drop").cast("double"))
    out = pairs.join(near, "other_id").groupBy("port_id", "week_start").agg(F.count("*").alias("neighbours"), drop.alias("neighbour_drops"), F.avg("z").alias("neighbour_z"))
    world = labels.where("eligible").groupBy("week_start").agg(drop.alias("world_drops"))
    return labels.select("port_id", "week_start").join(out, ["port_id", "week_start"], "left").join(world, "week_start", "left")


def alternatives(scores: DataFrame, ports: DataFrame, radius_km: float, calm: float, k: int = 3) -> DataFrame:
    """For each flagged row the k nearest ports that are calm in the same week."""
    other = ports.withColumnRenamed("port_id", "other_id")
    pairs = spatial_join(ports, other, radius_km, "port_id", "other_id").where("port_id <> other_id")
    quiet = scores.where(F.col("score") <= calm).select("origin_week", "horizon", F.col("port_id").alias("other_id"), F.col("score").alias("other_score"))
    found = scores.where("flagged").join(pairs, "port_id").join(quiet, ["origin_week", "horizon", "other_id"])
    w = Window.partitionBy("origin_week", "horizon", "port_id").orderBy("km", "other_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("origin_week", "horizon", "port_id", "other_id", "km", "rank")


def merge_history(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """History with all rows of the new weeks replaced."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def episode_changes(grid: DataFrame, episodes: DataFrame, entity: str, week: str, last: int = 26) -> DataFrame:
    """Change at each week after a start against the mean of the eight weeks ending two before it."""
    w = rows(entity, week, -10, -3)
    base = grid.withColumn("base", F.when(F.count("y").over(w) >= 4, F.avg("y").over(w)))
    start = episodes.join(base.select(entity, F.col(week).alias("start_week"), "base"), [entity, "start_week"])
    each = start.withColumn("offset", F.explode(F.sequence(F.lit(0), F.lit(last)))).withColumn(week, F.expr("date_add(start_week, offset * 7)"))
    out = each.join(grid.select(entity, week, "y"), [entity, week])
    return out.select("episode_id", entity, "start_week", "offset", "base", "y", F.when(F.col("base") > 0, F.col("y") / F.col("base") - 1).alias("change"))


def placebo_noise(changes: DataFrame, least: int = 14) -> DataFrame:
    """Root mean square over placebo starts of the averaged change."""
    each = changes.groupBy("port_id", "start_week").agg(F.avg("change").alias("m"), F.count("change").alias("n")).where(F.col("n") >= least)
    return each.groupBy("port_id").agg(F.sqrt(F.avg(F.col("m") * F.col("m"))).alias("noise"), F.count("*").alias("placebos"))
