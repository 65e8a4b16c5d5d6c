"""Warnings for the newest week from a stored model: fit, keep, load, score, and say why.

A kept model is a folder: a fitted pipeline that takes named columns (nulls and
all) to a chance, a calibration curve if there was enough history for one, the
training medians of its inputs, and what it was trained on.  Scoring only loads.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.expr import safe_ratio
from .panels import top_budget_alerts

#: Chances are kept this far from 0 and 1 before they become log-odds.
EDGE = 1e-6


class StaleRelease(ValueError):
    """The newest data are not this week's."""


def check_fresh(release: date, today: date, most_days: int = 7) -> None:
    """Raises if the newest release is more than most_days old: its warnings are out already."""
    age = (today - release).days
    if age > most_days:
        raise StaleRelease(f"the newest release is of {release}, {age} days ago")


def inputs(names: list[str]) -> list:
    """Pipeline stages that make ``features`` of columns: nulls become 0 with a flag of their own."""
    cells = ", ".join(f"coalesce(CAST(`{c}` AS DOUBLE), 0D) AS `in_{c}`, CAST(`{c}` IS NULL AS DOUBLE) AS `no_{c}`" for c in names)
    return [SQLTransformer(statement=f"SELECT *, {cells} FROM __THIS__"), VectorAssembler(inputCols=[f"{p}_{c}" for c in names for p in ("in", "no")], outputCol="features")]


def fit_chances(rows: DataFrame, names: list[str], label: str, iterations: int = 12, depth: int = 4) -> PipelineModel:
    rows = rows.withColumn("_y", F.col(label).cast("double"))
    return Pipeline(stages=[*inputs(names), GBTClassifier(labelCol="_y", featuresCol="features", maxIter=iterations, maxDepth=depth, seed=1)]).fit(rows)


def chances(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with the model's ``chance``."""
    return model.transform(rows).withColumn("chance", vector_to_array("probability")[1]).select(*rows.columns, "chance")


def log_odds(chance: Column) -> Column:
    p = F.least(F.greatest(chance, F.lit(EDGE)), F.lit(1 - EDGE))
    return F.log(p / (1 - p))


def fit_calibration(past: DataFrame, label: str, least: int) -> PipelineModel | None:
    """A logistic curve over the log-odds of chances that were given before their outcome; none with under ``least`` positives."""
    if past.where(F.col(label) == 1).limit(least).count() < least:
        return None
    rows = past.select(F.col("chance").alias("said"), F.col(label).cast("double").alias("_y"))
    odds = SQLTransformer(statement=f"SELECT *, ln(least(greatest(said, {EDGE}D), 1 - {EDGE}D) / (1 - least(greatest(said, {EDGE}D), 1 - {EDGE}D))) AS odds FROM __THIS__")
    curve = LogisticRegression(labelCol="_y", featuresCol="odds_vector", probabilityCol="curve", rawPredictionCol="curve_raw", predictionCol="curve_class")
    return Pipeline(stages=[odds, VectorAssembler(inputCols=["odds"], outputCol="odds_vector"), curve]).fit(rows)


@dataclass
class WarningModel:
    model: PipelineModel
    calibration: PipelineModel | None
    medians: DataFrame
    names: list[str]
    through: date

    def save(self, path: str) -> None:
        """Writes the folder; the note with the names comes last, so that a folder with one is whole."""
        spark = self.medians.sparkSession
        self.model.write().overwrite().save(f"{path}/model")
        if self.calibration is not None:
            self.calibration.write().overwrite().save(f"{path}/calibration")
        self.medians.coalesce(1).write.mode("overwrite").parquet(f"{path}/medians")
        note = [(self.names, self.through, self.calibration is not None)]
        spark.createDataFrame(note, "names array<string>, through date, calibrated boolean").coalesce(1).write.mode("overwrite").parquet(f"{path}/note")

    @staticmethod
    def load(spark: SparkSession, path: str) -> WarningModel:
        note = spark.read.parquet(f"{path}/note").head()
        calibration = PipelineModel.load(f"{path}/calibration") if note.calibrated else None
        return WarningModel(PipelineModel.load(f"{path}/model"), calibration, spark.read.parquet(f"{path}/medians"), list(note.names), note.through)

    def score(self, rows: DataFrame) -> DataFrame:
        """rows with ``chance``, calibrated where the model has a curve."""
        out = chances(self.model, rows)
        if self.calibration is None:
            return out
        said = self.calibration.transform(out.withColumnRenamed("chance", "said"))
        return said.withColumn("chance", vector_to_array("curve")[1]).select(*rows.columns, "chance")


def train_warnings(rows: DataFrame, names: list[str], label: str, target_day: str, origin_day: str, through: date, calibration_weeks: int = 52, least: int = 30) -> WarningModel:
    """A model of all rows whose outcome was known by ``through``.

    The calibration comes from the last calibration_weeks: a model of what was
    known before them gives chances for their origins.
    """
    known = rows.where((F.col(target_day) <= F.lit(through)) & F.col(label).isNotNull())
    start = F.date_sub(F.lit(through).cast("date"), 7 * calibration_weeks)
    early, late = known.where(F.col(target_day) <= start), known.where(F.col(origin_day) >= start)
    calibration = None
    if not early.where(F.col(label) == 1).isEmpty():
        calibration = fit_calibration(chances(fit_chances(early, names, label), late), label, least)
    medians = known.agg(*[F.percentile(F.col(c).cast("double"), F.lit(0.5)).alias(c) for c in names])
    return WarningModel(fit_chances(known, names, label), calibration, medians, names, through)


def live_rows(rated: DataFrame, entity: str, week: str, origin: date, horizons: int = 3) -> DataFrame:
    """Rows of the newest origin, one per entity with a label and horizon, whose outcomes are still to come."""
    now = rated.where((F.col(week) == F.lit(origin)) & F.col("is_drop").isNotNull())
    each = now.withColumn("horizon", F.explode(F.sequence(F.lit(1), F.lit(horizons))))
    return each.select(F.col(week).alias("origin_week"), F.expr(f"date_add({week}, 7 * horizon)").alias("target_week"), "horizon", entity, F.lit(None).cast("int").alias("y"), F.lit(None).cast("boolean").alias("big"), "base_rate", F.col("z").alias("origin_z"), F.col("is_drop").alias("origin_drop"))


def driver_groups(model: WarningModel, rows: DataFrame, keys: list[str], groups: dict[str, list[str]], top: int = 2, least: float = 0.05) -> DataFrame:
    """keys, drivers and reasons: how much each group of inputs pushes a row's log-odds.

    A push is the fall of the log-odds when all inputs of the group are set to
    their training medians; an approximation by occlusion, since inputs that act
    together count in each group.  reasons are the ``top`` groups whose push is
    above ``least``, the largest first.  All copies of a row are scored in one pass.
    """
    of = {c: g for g, names in groups.items() for c in names}
    medians = model.medians.select(*[F.col(c).alias(f"_m_{c}") for c in of])
    copies = rows.select(*keys, *model.names, F.explode(F.array(F.lit(""), *map(F.lit, groups))).alias("_group")).crossJoin(F.broadcast(medians))  # one row of medians
    copies = copies.withColumns({c: F.when(F.col("_group") == g, F.col(f"_m_{c}")).otherwise(F.col(c).cast("double")) for c, g in of.items()})
    odds = chances(model.model, copies).select(*keys, "_group", log_odds(F.col("chance")).alias("o"))
    whole = F.max(F.when(F.col("_group") == "", F.col("o")))
    out = odds.groupBy(*keys).agg(F.array(*[F.struct((whole - F.max(F.when(F.col("_group") == g, F.col("o")))).alias("push"), F.lit(g).alias("name")) for g in groups]).alias("_d"))
    strong = F.slice(F.sort_array(F.filter("_d", lambda d: d["push"] > least), asc=False), 1, top)
    return out.select(*keys, F.transform("_d", lambda d: F.round(d["push"], 2)).alias("drivers"), F.transform(strong, lambda d: d["name"]).alias("reasons"))


def warn(scored: DataFrame, share: float) -> DataFrame:
    """Adds lift over the base rate, and flags the top share of each origin and horizon."""
    out = scored.withColumn("lift", safe_ratio(F.col("chance"), F.col("base_rate")))
    return top_budget_alerts(out, ["origin_week", "horizon"], "chance", "port_id", share)


def track_record(history: DataFrame, labels: DataFrame, entity: str, week: str) -> DataFrame:
    """Past warnings with what happened, for target weeks that have a label by now."""
    outcome = labels.where("is_drop IS NOT NULL").select(F.col(week).alias("target_week"), entity, F.col("is_drop").alias("happened"), "drop_pct")
    return history.join(outcome, ["target_week", entity])


def recent_record(record: DataFrame, entity: str, origins: int = 6) -> DataFrame:
    """Flagged rows of the last origins, the one of best chance for each target week and entity, the shorter horizon at a tie."""
    newest = record.select("origin_week").distinct().orderBy(F.desc("origin_week")).limit(origins)
    best = F.max_by(F.struct("horizon", "chance", "happened", "drop_pct"), F.struct("chance", -F.col("horizon")))
    rows = record.where("flagged").join(F.broadcast(newest), "origin_week", "left_semi")
    return rows.groupBy("target_week", entity).agg(best.alias("_b")).select("target_week", entity, "_b.*")
