"""Live drop warnings of the newest origin, and what drives them; model fits have no SQL form."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import events as ev
from ..operators import live as lv
from . import disruption as d
from . import panels as pl
from . import views as v
from .streams import shared

QUERIES, ORACLE_SQL, query = v.catalogue()

#: Days from an origin week to its release, and the groups of inputs that reasons are told by.
RELEASE_DAYS = 15
GROUPS = {
    "calls already falling": ["last_z", "last_drop", "z_1", "min_z_4", "trend", "vs_year_ago"],
    "drops often at this port": ["base_rate", "weeks_since", "drops_52", "rel_spread", "cv_13", "mean_4", "mean_13", "mean_52"],
    "storm or disaster alert nearby": ["event_n", "event_n_red"],
    "chokepoint traffic shift": d.CHOKE,
    "nearby ports dropping": ["neighbours", "neighbour_drops", "neighbour_z"],
    "time of year": ["world_drops"],
    "port type and location": ["tanker_pct", "container_pct", "latitude", "longitude"],
}
RADIUS_KM, CALM = 6000.0, 0.2
KEYS = ["origin_week", "target_week", "horizon", "port_id"]


def newest_origin(spark: SparkSession, sf: str) -> date:
    """The newest week with a label."""
    return pl.label_drops(spark, sf).where("is_drop IS NOT NULL").agg(F.max("week_start")).head()[0]


def train(spark: SparkSession, sf: str, path: str) -> None:
    """Fits on every known outcome and keeps the model in path."""
    rows = v.stored(d.disruption_features(spark, sf))
    lv.train_warnings(rows, d.NUMERIC, "y", "target_week", "origin_week", newest_origin(spark, sf)).save(path)


def newest_rows(spark: SparkSession, sf: str) -> DataFrame:
    return v.stored(d.with_inputs(lv.live_rows(pl.rated(spark, sf), "port_id", "week_start", newest_origin(spark, sf)), spark, sf))


def warnings_from(spark: SparkSession, sf: str, path: str, today: date) -> DataFrame:
    """Warnings of the newest origin by the model kept in path; refuses data that are not fresh."""
    origin = newest_origin(spark, sf)
    lv.check_fresh(origin + timedelta(days=RELEASE_DAYS), today)
    model, rows = lv.WarningModel.load(spark, path), newest_rows(spark, sf)
    scored = model.score(rows).select(*KEYS, "size_band", "base_rate", "chance")
    why = lv.driver_groups(model, rows, KEYS, GROUPS)
    state = pl.label_drops(spark, sf).where(F.col("week_start") == F.lit(origin)).select("port_id", F.col("y").alias("last_calls"), F.col("base").alias("normal_calls"), F.col("drop_pct").alias("last_drop_pct"))
    profile = v.profiles(spark, sf)
    out = lv.warn(scored, d.SHARE).join(why, KEYS).join(state, "port_id", "left")
    near = ev.alternatives(out.withColumn("score", F.col("chance")), profile.select("port_id", "latitude", "longitude"), RADIUS_KM, CALM)
    near = near.groupBy("horizon", "port_id").agg(F.array_sort(F.collect_list(F.struct("rank", "other_id", F.round("km").alias("km")))).alias("alternatives"))  # three at most
    return out.drop("rank").join(profile, "port_id", "left").join(near, ["horizon", "port_id"], "left")


def trained_path(spark: SparkSession, sf: str) -> str:
    path = shared(spark)
    train(spark, sf, path)
    return path


@query("live_warnings")
def live_warnings(spark: SparkSession, sf: str) -> DataFrame:
    """The newest origin's warnings on the day after its release; lists as text."""
    with v.kept():
        today = newest_origin(spark, sf) + timedelta(days=RELEASE_DAYS + 1)
        out = warnings_from(spark, sf, trained_path(spark, sf), today)
    text = lambda c: F.concat_ws("; ", c)
    return out.withColumns({"drivers": text(F.transform("drivers", lambda x: x.cast("string"))), "reasons": text(F.col("reasons")), "alternatives": text(F.transform("alternatives", lambda a: F.concat_ws(" ", a["other_id"].cast("string"), a["km"].cast("string"))))})


@query("driver_groups")
def driver_groups(spark: SparkSession, sf: str) -> DataFrame:
    """The push of every group of inputs on each live row, long, and whether it is a reason."""
    with v.kept():
        model = lv.WarningModel.load(spark, trained_path(spark, sf))
        out = lv.driver_groups(model, newest_rows(spark, sf), KEYS, GROUPS)
    names = F.array(*map(F.lit, GROUPS))
    each = out.select(*KEYS, "reasons", F.explode(F.arrays_zip(names.alias("name"), F.col("drivers").alias("push"))).alias("d"))
    return each.select(*KEYS, F.col("d.name").alias("driver"), F.col("d.push").alias("push"), F.array_contains("reasons", F.col("d.name")).alias("is_reason"))
