"""Pairs of points within a distance, without a cross join."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import haversine_km

KM_PER_DEGREE = 111.0


def spatial_join(a: DataFrame, b: DataFrame, radius_km: float, a_id: str, b_id: str) -> DataFrame:
    """(a_id, b_id, km) of all pairs within the radius; both sides have latitude and longitude.

    Cells are bands of latitude as high as the radius.  A band is cut into as
    many columns as its own width allows, and a point of `b` is sent to all
    columns that its circle can reach in its band and in the two beside it.
    """
    band = max(radius_km / KM_PER_DEGREE * 1.01, 0.05)
    bands = math.ceil(180 / band)
    lat = lambda p: F.least(F.floor((F.col(f"{p}lat") + 90) / band), F.lit(bands - 1)).cast("long")
    # columns of a band: wide enough for the circle at the band's edge nearest a pole
    edge = lambda row: F.least(F.greatest(F.abs(row * band - 90), F.abs((row + 1) * band - 90)), F.lit(89.9))
    columns = lambda row: F.greatest(F.floor(360 * F.cos(F.radians(F.least(edge(row) + band, F.lit(89.9)))) / band), F.lit(1)).cast("long")
    column = lambda p, row: F.pmod(F.floor((F.col(f"{p}lon") + 180) / 360 * columns(row)), columns(row)).cast("long")
    left = a.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(F.col(a_id).alias("a_id"), F.col("latitude").alias("a_lat"), F.col("longitude").alias("a_lon"))
    left = left.withColumn("row", lat("a_")).withColumn("col", column("a_", F.col("row")))
    right = b.where("latitude IS NOT NULL AND longitude IS NOT NULL").select(F.col(b_id).alias("b_id"), F.col("latitude").alias("b_lat"), F.col("longitude").alias("b_lon"))
    right = right.withColumn("row", F.explode(F.array(lat("b_") - 1, lat("b_"), lat("b_") + 1))).where(F.col("row").between(0, bands - 1))
    near = F.array_distinct(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: F.pmod(column("b_", F.col("row")) + d, columns(F.col("row")))))
    right = right.withColumn("col", F.explode(near))
    km = haversine_km(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon"))
    out = left.join(right, ["row", "col"]).withColumn("km", km).where(F.col("km") <= radius_km)
    return out.select(F.col("a_id").alias(a_id), F.col("b_id").alias(b_id), "km")


def nearest_k(pairs: DataFrame, entity: str, other: str, k: int) -> DataFrame:
    """The k nearest of each entity with their rank; ties by id."""
    w = Window.partitionBy(entity).orderBy("km", other)
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
