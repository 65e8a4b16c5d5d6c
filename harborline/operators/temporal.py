"""As-of and interval joins, gap-free grids, rolling measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_backward(left: DataFrame, right: DataFrame, left_time: str, right_time: str, by: list[str], values: list[str]) -> DataFrame:
    """left with each value of the newest right row at or before its time, within `by`.

    Both sides are stacked and the last value is carried forward: one shuffle
    by key, no pairs.  At equal times the right row counts.
    """
    packed = F.struct(*[F.col(v) for v in values])
    names = left.columns
    a = left.select(F.struct(*names).alias("_row"), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), F.lit(None).alias("_value"), *by)
    b = right.where(F.col(right_time).isNotNull()).select(F.lit(None).alias("_row"), F.col(right_time).alias("_t"), F.lit(0).alias("_side"), packed.alias("_value"), *by)
    w = Window.partitionBy(*by).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, 0)
    both = a.select("_row", "_t", "_side", *by, F.lit(None).cast(b.schema["_value"].dataType).alias("_value")).unionByName(b.select(F.lit(None).cast(a.schema["_row"].dataType).alias("_row"), "_t", "_side", *by, "_value"))
    out = both.withColumn("_carried", F.last("_value", ignorenulls=True).over(w)).where("_side = 1")
    return out.select("_row.*", *[F.when(F.col("_t").isNotNull(), F.col(f"_carried.{v}")).alias(v) for v in values])


def interval_join(days: DataFrame, spans: DataFrame, day: str, start: str, end: str, how: str = "inner") -> DataFrame:
    """day BETWEEN start AND end, as an equality on every day of a span."""
    each = spans.where(F.col(end) >= F.col(start)).withColumn(day, F.explode(F.sequence(start, end)))
    return days.join(each, day, how)


def weekly_grid(df: DataFrame, entity: str, week: str, value: str, complete: str) -> DataFrame:
    """(entity, week, y) for every entity and week between the first and the last; y is null for partial weeks."""
    ends = df.agg(F.min(week).alias("a"), F.max(week).alias("b"))
    weeks = ends.select(F.explode(F.expr("sequence(a, b, interval 7 days)")).alias(week))
    grid = df.select(entity).distinct().crossJoin(F.broadcast(weeks))  # calendar-sized: a row per week
    y = F.when(F.col(complete), F.col(value)).cast("double").alias("y")
    return grid.join(df.select(entity, week, y), [entity, week], "left")


def rows(entity: str | list[str], order: str, first: int, last: int):  # noqa: ANN201
    keys = [entity] if isinstance(entity, str) else entity
    return Window.partitionBy(*keys).orderBy(order).rowsBetween(first, last)


def full_mean(value: Column, window, n: int) -> Column:  # noqa: ANN001
    """Mean over a window, null until it holds n rows."""
    return F.when(F.count(value).over(window) == n, F.avg(value).over(window))


def calendar_days(entity: list[str], day: str, first: int, last: int):  # noqa: ANN201
    """A frame of calendar days, whatever rows there are."""
    return Window.partitionBy(*entity).orderBy(F.unix_date(F.col(day))).rangeBetween(first, last)
