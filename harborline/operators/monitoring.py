"""Quality, freshness and volume checks over tables and runs.

Every check takes the time it judges at as a parameter; none reads the clock.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_rates(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """(column_name, total_rows, null_rate) of columns that have nulls, in one scan."""
    columns = [c for c in df.columns if c not in skip]
    cells = [F.struct(F.lit(c).alias("column_name"), F.count(F.when(F.col(c).isNull(), 1)).alias("nulls")) for c in columns]
    one = df.agg(F.array(*cells).alias("cells"), F.count("*").alias("total_rows")).select(F.explode("cells").alias("c"), "total_rows")
    return one.where("c.nulls > 0").select("c.column_name", "total_rows", (F.col("c.nulls") / F.col("total_rows")).alias("null_rate"))


def hours_between(a: Column, b: Column) -> Column:
    return (F.unix_seconds(b.cast("timestamp")) - F.unix_seconds(a.cast("timestamp"))) / 3600


def stale_sources(df: DataFrame, source: str, time: str, as_of: Column, limits: dict[str, float], default: float) -> DataFrame:
    """Sources whose newest row is older than their own limit, or than the default."""
    limit = F.lit(default)
    for name, hours in limits.items():
        limit = F.when(F.col(source) == name, F.lit(hours)).otherwise(limit)
    out = df.groupBy(source).agg(F.max(time).alias("newest")).withColumns({"hours_old": hours_between(F.col("newest"), as_of), "limit_hours": limit})
    return out.where("hours_old > limit_hours")


def freshness_sla(df: DataFrame, slas: DataFrame, source: str, time: str, as_of: Column) -> DataFrame:
    """Overdue sources with a severity; a source that was never collected is critical."""
    newest = df.groupBy(source).agg(F.max(time).alias("newest"))
    out = slas.join(newest, source, "left").withColumn("hours_old", hours_between(F.col("newest"), as_of))
    over = F.col("hours_old") / F.col("sla_hours")
    severity = F.when(F.col("newest").isNull() | (over > 2), "critical").when(over > 1.5, "high").otherwise("medium")
    out = out.withColumns({"pct_over": F.when(F.col("newest").isNotNull(), 100 * (over - 1)), "severity": severity})
    return out.where(F.col("newest").isNull() | (F.col("hours_old") > F.col("sla_hours")))


def volume_anomalies(runs: DataFrame, source: str, order: list[str], value: str, window: int = 30, least: int = 5, alert: float = 2.0, high: float = 3.0) -> DataFrame:
    """z of each count against the last `window` counts, its own among them.

    Counts are whole numbers, so n times the distance from the mean and n times
    the deviation are compared with the thresholds exactly: a z of just `alert`
    or `high` is not above it, however a mean or a root is rounded.
    """
    w = Window.partitionBy(source).orderBy(*order).rowsBetween(1 - window, 0)
    x = F.col(value).cast("decimal(18,0)")
    n = F.count(value).over(w)
    out = runs.withColumns({"n": n, "_s": F.sum(x).over(w), "_q": F.sum(x * x).over(w)})
    out = out.withColumns({"_d": (F.col("n") * x - F.col("_s")).cast("decimal(38,0)"), "_v": (F.col("n") * F.col("_q") - F.col("_s") * F.col("_s")).cast("decimal(38,0)")})
    out = out.withColumn("z", F.when((F.col("n") >= least) & (F.col("_v") > 0), F.col("_d").cast("double") / F.sqrt(F.col("_v").cast("double"))))

    def above(limit: float) -> Column:
        p, q = Fraction(str(limit)).as_integer_ratio()
        return F.col("_d") * F.col("_d") * F.lit(q * q) > F.col("_v") * F.lit(p * p)

    out = out.where(F.col("z").isNotNull() & above(alert)).withColumn("severity", F.when(above(high), "high").otherwise("medium"))
    return out.drop("_s", "_q", "_d", "_v")


def duration_anomalies(runs: DataFrame, source: str, order: list[str], value: str) -> DataFrame:
    """Runs that took more than two deviations longer than all runs so far."""
    w = Window.partitionBy(source).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    z = (F.col(value) - F.avg(value).over(w)) / F.stddev_pop(value).over(w)
    return runs.withColumn("z", F.when(F.stddev_pop(value).over(w) > 0, z)).where("z > 2")


def null_spikes(df: DataFrame, source: str, is_new: Column, columns: list[str], rise: float = 0.25, least: int = 50) -> DataFrame:
    """(source, column_name, old_rate, new_rate) where nulls rose by `rise` among new rows."""
    fresh = F.count(F.when(is_new, 1))
    old = F.count(F.when(~is_new, 1))
    cells = [F.struct(F.lit(c).alias("column_name"), F.count(F.when(is_new & F.col(c).isNull(), 1)).alias("n"), F.count(F.when(~is_new & F.col(c).isNull(), 1)).alias("o")) for c in columns]
    out = df.groupBy(source).agg(fresh.alias("new_rows"), old.alias("old_rows"), F.array(*cells).alias("cells")).withColumn("c", F.explode("cells"))
    out = out.where((F.col("new_rows") >= least) & (F.col("old_rows") >= least))
    out = out.select(source, "c.column_name", (F.col("c.o") / F.col("old_rows")).alias("old_rate"), (F.col("c.n") / F.col("new_rows")).alias("new_rate"))
    return out.where(F.col("new_rate") - F.col("old_rate") >= rise)


def schema_drift(df: DataFrame, expected: list[str]) -> DataFrame:
    """(column_name, problem, filled): unexpected columns with the rows that fill them, and missing ones."""
    new, gone = sorted(set(df.columns) - set(expected)), sorted(set(expected) - set(df.columns))
    cells = [F.struct(F.lit(c).alias("column_name"), F.lit("unexpected").alias("problem"), F.count(c).alias("filled")) for c in new]
    cells += [F.struct(F.lit(c).alias("column_name"), F.lit("missing").alias("problem"), F.lit(0).cast("long").alias("filled")) for c in gone]
    return df.agg(F.array(*cells).alias("c")).select(F.inline("c")) if cells else df.limit(0).select(F.lit("").alias("column_name"), F.lit("").alias("problem"), F.lit(0).cast("long").alias("filled"))


def row_drops(counts: DataFrame, baseline: DataFrame, key: str, share: float = 0.01) -> DataFrame:
    out = counts.join(baseline.withColumnRenamed("rows", "rows_before"), key)
    return out.where(F.col("rows") < F.col("rows_before") * (1 - share)).withColumn("lost_share", 1 - F.col("rows") / F.col("rows_before"))


def source_status(runs: DataFrame, source: str, time: str) -> DataFrame:
    ok = F.col("status") == "success"
    return runs.groupBy(source).agg(F.max(time).alias("last_run"), F.max(F.when(ok, F.col(time))).alias("last_success"), F.count(F.when(ok, 1)).alias("successes"), F.count(F.when(~ok, 1)).alias("errors"))
