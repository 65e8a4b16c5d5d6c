"""Cleaning, validation and enrichment of positions, vessels and ports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Values outside these mean "not available"; a course of 360 does too.
VALID = {"latitude": (-90.0, 90.0), "longitude": (-180.0, 180.0), "sog": (0.0, 102.2), "cog": (0.0, 360.0), "heading": (0.0, 359.0)}


def is_valid(column: str) -> Column:
    low, high = VALID[column]
    c = F.col(column)
    return (c >= low) & ((c < high) if column == "cog" else (c <= high))


def clean_sentinels(df: DataFrame) -> DataFrame:
    """Values that stand for "not available" become null."""
    return df.withColumns({c: F.when(is_valid(c), F.col(c)) for c in VALID if c in df.columns})


def drop_unkeyed(df: DataFrame, exempt: list[str]) -> DataFrame:
    """Rows without ship or time go, unless their source is exempt or unknown."""
    return df.where(F.col("source").isNull() | F.col("source").isin(exempt) | (F.col("mmsi").isNotNull() & F.col("timestamp").isNotNull()))


def count_changes(df: DataFrame, exempt: list[str]) -> DataFrame:
    """One row: values that cleaning makes null by column, and rows that it drops."""
    nulled = [F.sum(F.when(F.col(c).isNotNull() & ~is_valid(c), 1).otherwise(0)).alias(f"{c}_nulled") for c in VALID]
    drop = F.col("source").isNotNull() & ~F.col("source").isin(exempt) & (F.col("mmsi").isNull() | F.col("timestamp").isNull())
    return df.agg(*nulled, F.sum(drop.cast("int")).alias("rows_dropped"))


def clean_pairs(df: DataFrame) -> DataFrame:
    """Both coordinates become null if either is out of range."""
    ok = reduce(lambda a, b: a & b, [F.coalesce(is_valid(c), F.lit(True)) for c in ("latitude", "longitude")])
    return df.withColumns({c: F.when(ok, F.col(c)) for c in ("latitude", "longitude")})


def check(name: str, bad: Column) -> Column:
    return F.struct(F.lit(name).alias("check"), F.sum(F.when(bad, 1).otherwise(0)).alias("failed"))


def validation_report(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check, failed, total, passed): all checks of a table in one scan; a null condition passes."""
    agg = df.agg(F.array(*[check(n, c) for n, c in checks.items()]).alias("c"), F.count("*").alias("total"))
    out = agg.select(F.explode("c").alias("c"), "total")
    return out.select("c.check", "c.failed", "total", (F.col("c.failed") == 0).alias("passed"))


def best_by_source(df: DataFrame, key: str, rank: Column, columns: list[str], pair: tuple[str, str] | None = None) -> DataFrame:
    """One row per key: each column from the best-ranked source that has it, a pair of columns together."""
    best = [F.min(F.when(F.col(c).isNotNull(), F.struct(rank.alias("r"), F.col(c).alias("v"))))["v"].alias(c) for c in columns]
    if pair:
        a, b = pair
        both = F.min(F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.struct(rank.alias("r"), F.col(a).alias("a"), F.col(b).alias("b"))))
        best += [both["a"].alias(a), both["b"].alias(b)]
    return df.groupBy(key).agg(*best)


def congestion_proxy(activity: DataFrame, entity: str, day: str, calls: str, recent: int = 7, baseline: int = 90) -> DataFrame:
    """Recent and usual daily calls of each port at its own latest day."""
    latest = activity.groupBy(entity).agg(F.max(day).alias("as_of"))
    back = F.datediff("as_of", day)
    joined = activity.join(latest, entity).where(back < baseline)
    mean = lambda n: F.avg(F.when(back < n, F.col(calls)))
    out = joined.groupBy(entity, "as_of").agg(mean(recent).alias("recent_avg"), mean(baseline).alias("baseline_avg"), F.count(calls).alias("baseline_days"))
    return out.withColumn("ratio_vs_baseline", F.when(F.col("baseline_avg") != 0, F.col("recent_avg") / F.col("baseline_avg")))
