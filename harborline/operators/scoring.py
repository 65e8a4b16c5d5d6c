"""Scores of several models: precision, recall, average precision, curves; features as single scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import safe_ratio
from .panels import average_precision, top_budget_alerts


def score_models(scores: DataFrame, group: list[str], budget: list[str], tie: str, share: float) -> DataFrame:
    """Rows, rate, average precision, and precision, recall and recall of big drops within the alert budget.

    scores is long: model, score, y, big; the budget is a share of each `budget` group.
    """
    keys = ["model", *group]
    ap = average_precision(scores, keys, "score", "y")
    flagged = top_budget_alerts(scores, [*keys, *[b for b in budget if b not in group]], "score", tie, share)
    f, y, big = F.col("flagged"), F.col("y") == 1, F.coalesce("big", F.lit(False))
    count = lambda c: F.count(F.when(c, 1))
    hits = flagged.groupBy(*keys).agg(F.avg("y").alias("rate"), count(f & y).alias("hit"), count(f).alias("alerts"), count(y).alias("pos"), count(f & big).alias("big_hit"), count(big).alias("big_all"))
    out = ap.join(hits, keys)
    return out.select(*keys, "n", "rate", "average_precision", safe_ratio(F.col("hit"), F.col("alerts")).alias("precision"), safe_ratio(F.col("hit"), F.col("pos")).alias("recall"), safe_ratio(F.col("big_hit"), F.col("big_all")).alias("big_recall"))


def in_groups(df: DataFrame, groups: dict[str, Column]) -> DataFrame:
    """Every row once for each grouping: columns grouping and value."""
    cells = [F.struct(F.lit(name).alias("grouping"), c.cast("string").alias("value")) for name, c in groups.items()]
    return df.withColumn("_g", F.explode(F.array(*cells))).select("*", "_g.grouping", "_g.value").drop("_g")


def single_feature_ap(df: DataFrame, features: list[str], day: str, split: str) -> DataFrame:
    """Each feature as a score: its sign is picked before the split and scored after it, nulls last."""
    long = df.unpivot([day, "y"], [F.col(f).cast("double").alias(f) for f in features], "feature", "x")
    long = long.withColumn("sign", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumn("late", F.col(day) >= split)
    long = long.withColumn("score", F.coalesce(F.round("x", 9) * F.col("sign"), F.lit(-1e300)))  # rounded: ties must not hang on the order of a sum
    ap = average_precision(long, ["feature", "sign", "late"], "score", "y")
    early, late = (ap.where(c).select("feature", "sign", F.coalesce("average_precision", F.lit(0.0)).alias(n)) for c, n in (("NOT late", "ap_before"), ("late", "ap_after")))
    best = early.groupBy("feature").agg(F.max(F.struct("ap_before", "sign")).alias("b")).select("feature", "b.sign", "b.ap_before")
    return best.join(late, ["feature", "sign"])


def describe_features(df: DataFrame, features: list[str]) -> DataFrame:
    """Filled share and medians by outcome."""
    long = df.unpivot(["y"], [F.col(f).cast("double").alias(f) for f in features], "feature", "x")
    of = lambda k: F.percentile(F.when(F.col("y") == k, F.col("x")), F.lit(0.5))
    return long.groupBy("feature").agg((F.count("x") / F.count("*")).alias("filled"), of(1).alias("median_drop"), of(0).alias("median_calm"))


def modes(df: DataFrame, column: str, outcome: str) -> DataFrame:
    """The most frequent value of each outcome, the smaller at a tie."""
    n = df.groupBy(outcome, column).count()
    w = Window.partitionBy(outcome).orderBy(F.desc("count"), column)
    return n.withColumn("r", F.row_number().over(w)).where("r = 1").select(outcome, F.col(column).alias("mode"), "count")


def pr_curve(df: DataFrame, score: str, points: int = 60, step: float = 0.001) -> DataFrame:
    """Precision and recall at log-spaced numbers of alerts; scores in steps, so blocks are few however many rows there are.

    Without positives there is no recall: it is null.
    """
    block = F.round(F.col(score) / step).cast("long").alias("block")
    blocks = df.groupBy(block).agg(F.count("*").alias("n"), F.sum("y").alias("tp"))
    run = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, 0)
    blocks = blocks.select("block", F.sum("n").over(run).alias("n"), F.sum("tp").over(run).alias("tp"), (F.sum("n").over(run) - F.col("n")).alias("before"))
    total = blocks.agg(F.max("n").alias("all_n"), F.max("tp").alias("all_tp"))
    ladder = total.select("all_tp", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(points - 1)), lambda i: F.round(F.pow(F.lit(10.0), i * F.log10("all_n") / (points - 1))).cast("long")))).alias("k"))
    out = ladder.join(F.broadcast(blocks), (F.col("k") > F.col("before")) & (F.col("k") <= F.col("n")))
    return out.select("k", "n", (F.col("tp") / F.col("n")).alias("precision"), safe_ratio(F.col("tp"), F.col("all_tp")).alias("recall"))
