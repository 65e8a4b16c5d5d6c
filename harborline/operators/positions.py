"""Measures of vessel positions: ports, waiting ships, tracks and segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import bearing_degrees, haversine_km
from .keyed import islands


def seconds(a: Column, b: Column) -> Column:
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return (micros(b) - micros(a)) / 1e6


def by_destination(df: DataFrame, vessel: str) -> DataFrame:
    """Ships, reports, times and means per destination; a ship without a number counts as one more."""
    ships = F.count_distinct(vessel) + F.max(F.col(vessel).isNull().cast("int"))
    out = df.where("destination IS NOT NULL").groupBy("destination")
    out = out.agg(ships.alias("vessels"), F.count("timestamp").alias("reports"), F.min("timestamp").alias("first_seen"), F.max("timestamp").alias("last_seen"), F.avg("sog").alias("avg_sog"), F.avg("draught").alias("avg_draught"))
    return out.withColumn("observed_seconds", seconds(F.col("first_seen"), F.col("last_seen")))


def congestion_ratio(df: DataFrame, vessel: str, slow_below: float = 1.0) -> DataFrame:
    """Slow ships per destination and their share of ships with a speed, in one aggregation."""
    slow = F.col("sog") < slow_below
    pick = lambda c: F.when(slow, F.col(c))
    out = df.where("sog IS NOT NULL AND destination IS NOT NULL").groupBy("destination")
    out = out.agg(F.count_distinct(pick(vessel)).alias("slow_vessels"), F.count_distinct(vessel).alias("vessels"), F.avg(pick("sog")).alias("avg_slow_sog"), F.min(pick("timestamp")).alias("first_slow"), F.max(pick("timestamp")).alias("last_slow"))
    return out.where("slow_vessels > 0").withColumn("congestion_ratio", F.col("slow_vessels") / F.col("vessels"))


def dwell_times(df: DataFrame, vessel: str, slow_below: float = 1.0) -> DataFrame:
    """First to last slow report of each ship that has at least two."""
    slow = df.where((F.col("sog") < slow_below) & F.col(vessel).isNotNull())
    first = F.min_by(F.struct("vessel_name", "destination"), F.struct("timestamp", "event_id"))
    out = slow.groupBy(vessel).agg(first.alias("first"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.count("*").alias("reports"), F.avg("sog").alias("avg_sog")).where("reports >= 2")
    return out.select(vessel, "first.vessel_name", "first.destination", "start", "end", "reports", "avg_sog", seconds(F.col("start"), F.col("end")).alias("dwell_seconds"))


def dwell_visits(df: DataFrame, vessel: str, slow_below: float = 1.0) -> DataFrame:
    """One row per uninterrupted run of slow reports."""
    known = df.where(F.col(vessel).isNotNull() & F.col("sog").isNotNull())
    runs = islands(known, [vessel], ["timestamp", "event_id"], F.col("sog") < slow_below).where(F.col("sog") < slow_below)
    out = runs.groupBy(vessel, "island").agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.count("*").alias("reports"))
    return out.drop("island").withColumn("dwell_seconds", seconds(F.col("start"), F.col("end")))


def vessel_tracks(df: DataFrame, vessel: str) -> DataFrame:
    """Start, end and speeds of each ship's reports in time order."""
    at = F.struct("timestamp", "event_id")
    end = F.struct("latitude", "longitude", "destination")
    known = df.where(F.col(vessel).isNotNull() & F.col("timestamp").isNotNull())
    out = known.groupBy(vessel).agg(F.min_by("vessel_name", at).alias("vessel_name"), F.min_by(end, at).alias("a"), F.max_by(end, at).alias("b"), F.min("timestamp").alias("start_time"), F.max("timestamp").alias("end_time"), F.avg("sog").alias("avg_sog"), F.max("sog").alias("max_sog"), F.count("*").alias("positions"))
    out = out.withColumn("duration_seconds", seconds(F.col("start_time"), F.col("end_time")))
    return out.select(vessel, "vessel_name", F.col("a.latitude").alias("start_lat"), F.col("a.longitude").alias("start_lon"), F.col("b.latitude").alias("end_lat"), F.col("b.longitude").alias("end_lon"), "start_time", "end_time", "avg_sog", "max_sog", "positions", F.col("b.destination").alias("last_destination"), "duration_seconds")


def route_segments(df: DataFrame, vessel: str, min_positions: int = 2) -> DataFrame:
    """Consecutive reports with coordinates at both ends."""
    w = Window.partitionBy(vessel).orderBy("timestamp", "event_id")
    known = df.where(F.col(vessel).isNotNull() & F.col("timestamp").isNotNull())
    nxt = {f"to_{c}": F.lead(c).over(w) for c in ("latitude", "longitude", "timestamp")}
    out = known.withColumns(nxt | {"_n": F.count("*").over(Window.partitionBy(vessel))})
    out = out.where((F.col("_n") >= min_positions) & F.col("latitude").isNotNull() & F.col("longitude").isNotNull() & F.col("to_latitude").isNotNull() & F.col("to_longitude").isNotNull())
    return out.select(vessel, "event_id", "latitude", "longitude", "to_latitude", "to_longitude", "sog", "cog", "timestamp", "to_timestamp")


def segment_metrics(segments: DataFrame) -> DataFrame:
    p = [F.col(c) for c in ("latitude", "longitude", "to_latitude", "to_longitude")]
    return segments.withColumns({"km": haversine_km(*p), "bearing": bearing_degrees(*p), "hours": seconds(F.col("timestamp"), F.col("to_timestamp")) / 3600})


def port_pairs(df: DataFrame, vessel: str) -> DataFrame:
    """Ships per pair of destinations that follow each other by first visit."""
    seen = df.where(F.col(vessel).isNotNull() & F.col("destination").isNotNull()).groupBy(vessel, "destination").agg(F.min(F.struct("timestamp", "event_id")).alias("at"))
    nxt = F.lead("destination").over(Window.partitionBy(vessel).orderBy("at"))
    pairs = seen.withColumn("next", nxt).where("next IS NOT NULL")
    return pairs.groupBy(F.col("destination").alias("origin"), F.col("next").alias("to_port")).agg(F.count_distinct(vessel).alias("vessels"))


def types_by_destination(df: DataFrame, register: DataFrame, vessel: str) -> DataFrame:
    out = df.where(F.col("destination").isNotNull() & F.col(vessel).isNotNull()).join(register.select(vessel, "vessel_type"), vessel, "left")
    return out.groupBy("destination", "vessel_type").agg(F.count_distinct(vessel).alias("vessels"))
