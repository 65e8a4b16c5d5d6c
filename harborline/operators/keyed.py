"""Tables with natural keys: upsert, first and last row per key, projection, runs.

A null key part equals another null, as in a stored table's key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def keep_one(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; rows of a key with a null count as one key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def keep_first(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return keep_one(df, keys, [F.col(seq).asc()])


def keep_last(df: DataFrame, keys: list[str], seq: str) -> DataFrame:
    return keep_one(df, keys, [F.col(seq).desc()])


def same_key(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(lambda x, y: x & y, [a[k].eqNullSafe(b[k]) for k in keys])


def upsert(stored: DataFrame, batch: DataFrame, keys: list[str], seq: str | None = None) -> DataFrame:
    """Stored rows whose key the batch does not have, and the batch's last row per key."""
    if seq is not None:
        batch = keep_last(batch, keys, seq)
    kept = stored.join(batch.select(*keys), same_key(stored, batch, keys), "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


def touched_partitions(merged: DataFrame, batch: DataFrame, parts: list[str]) -> DataFrame:
    """The merged rows of partitions that the batch has rows of."""
    touched = batch.select(*parts).distinct()
    return merged.join(touched, same_key(merged, touched, parts), "left_semi")


def rewrite_partitions(merged: DataFrame, batch: DataFrame, parts: list[str], path: str) -> None:
    """Overwrites just the partitions that the batch touched."""
    out = touched_partitions(merged, batch, parts).write.mode("overwrite").partitionBy(*parts)
    out.option("partitionOverwriteMode", "dynamic").parquet(path)


def project_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The schema's columns, cast leniently, with nulls for those that are absent."""
    have = {c.lower(): c for c in df.columns}
    if not any(f.name.lower() in have for f in schema):
        raise ValueError("the batch has no column of the table")
    cell = lambda f: F.expr(f"try_cast(`{have[f.name.lower()]}` AS {f.dataType.simpleString()})") if f.name.lower() in have else F.lit(None).cast(f.dataType)
    return df.select(*[cell(f).alias(f.name) for f in schema])


def islands(df: DataFrame, entity: list[str], order: list[str], state: Column) -> DataFrame:
    """Adds ``island``: the number of the run of equal states that a row is in, per entity."""
    w = Window.partitionBy(*entity).orderBy(*order)
    df = df.withColumn("_state", state)
    change = F.when(F.lag("_state").over(w).eqNullSafe(F.col("_state")) & (F.row_number().over(w) > 1), 0).otherwise(1)
    df = df.withColumn("_change", change)
    return df.withColumn("island", F.sum("_change").over(w)).drop("_state", "_change")


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def month_runs(months: DataFrame, month: str, longest: int) -> DataFrame:
    """(first, last, n): runs of consecutive months, cut into chunks of at most `longest`.

    The list of missing periods is calendar-sized, so one ordered pass will do.
    """
    number = (F.year(month) * 12 + F.month(month)).alias("number")
    each = months.select(F.col(month).alias("m"), number).distinct()
    each = each.withColumn("run", F.col("number") - F.row_number().over(Window.orderBy("number")))
    each = each.withColumn("chunk", F.floor((F.row_number().over(Window.partitionBy("run").orderBy("number")) - 1) / longest))
    return each.groupBy("run", "chunk").agg(F.min("m").alias("first_month"), F.max("m").alias("last_month"), F.count("*").alias("n_months")).drop("run", "chunk")
