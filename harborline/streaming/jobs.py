"""The batch operators as streams over landed position files.

Every job takes a streaming (or batch) frame of positions and returns a frame;
the caller starts it.  State is bounded by watermarks, and sinks upsert by key,
so a batch that is run again leaves the same table.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators import keyed


def read_events(spark: SparkSession, path: str, files_per_trigger: int = 100) -> DataFrame:
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def deduplicated(events: DataFrame, keys: list[str], time: str, late: str = "1 hour") -> DataFrame:
    """The first report of each key within the watermark."""
    return events.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)


def windowed_counts(events: DataFrame, entity: str, time: str, length: str = "1 day", slide: str | None = None, late: str = "2 days") -> DataFrame:
    """Reports per entity and tumbling (or sliding) window."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    out = events.withWatermark(time, late).groupBy(w.alias("w"), entity).agg(F.count("*").alias("n"))
    return out.select(F.col("w.start").alias("window_start"), entity, "n")


def dwell_sessions(events: DataFrame, vessel: str, time: str, speed: str, slow_below: float, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Visits: slow reports of a ship with no longer gap than `gap` between them."""
    slow = events.where(F.col(speed) < slow_below).withWatermark(time, late)
    out = slow.groupBy(F.session_window(time, gap).alias("w"), vessel).agg(F.count("*").alias("reports"))
    return out.select(vessel, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "reports")


def enriched(events: DataFrame, vessels: DataFrame, key: str) -> DataFrame:
    return events.join(vessels, key, "left")


#: Hash parts that a kept table starts with, and rows of a part above which their number doubles.
PARTS, PART_ROWS = 16, 5_000_000
MANIFEST = "part int, version long, rows long, parts int, batch long"


def manifest(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest list of a kept table's parts: a row each; None before the first batch."""
    try:
        every = spark.read.schema(MANIFEST).parquet(f"{path}/manifests")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    newest = every.agg(F.max("batch").alias("b")).head()[0]
    return None if newest is None else every.where(F.col("batch") == newest)


def read_parts(spark: SparkSession, path: str, listed: list) -> DataFrame:
    """The rows of the parts listed; their folders are named, so no other file is looked at."""
    folders = [f"{path}/data/version={r.version}/part={r.part}" for r in listed if r.rows]
    if not folders:
        return spark.read.parquet(f"{path}/data/version={listed[0].version}").limit(0)
    return spark.read.option("basePath", f"{path}/data").parquet(*folders)


def current_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table that `keep_in` keeps; None before the first batch."""
    newest = manifest(spark, path)
    return None if newest is None else read_parts(spark, path, newest.collect())  # a row for each part


def keep_in(path: str, keys: list[str], merge: Callable[[DataFrame | None, DataFrame], DataFrame], first_parts: int = PARTS, part_rows: int = PART_ROWS):  # noqa: ANN201
    """A foreachBatch sink that keeps a table in `path`, with each batch merged into it.

    merge takes the stored rows (None at first) and the batch's, of whole hash
    parts of `keys`, and returns what they become.  Only the parts that a batch
    touches are read and written, as new versions; when parts grow beyond
    part_rows on average their number doubles, and all are written once.  A
    manifest that lists every part is written last and makes the batch count: one
    that fails before leaves the table as it was, and one that is run again gives
    the same table.  Versions and manifests that the newest two do not name are
    deleted.  Batches are numbered by one query's checkpoint.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        newest = manifest(spark, path)
        listed = [] if newest is None else newest.collect()  # a row for each part
        if listed and listed[0].batch >= batch_id:
            return  # a replay of a batch that was done
        had = listed[0].parts if listed else first_parts
        parts = had * 2 if sum(r.rows for r in listed) > had * part_rows else had
        part = F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("int")
        batch = batch.withColumn("part", part).persist()
        touched = set(range(parts)) if parts != had else {r.part for r in batch.select("part").distinct().collect()}
        old = [r for r in listed if parts != had or r.part in touched]
        stored = read_parts(spark, path, old).drop("version").withColumn("part", part) if old else None
        merged = merge(stored, batch).withColumn("part", part)
        merged.write.mode("overwrite").partitionBy("part").parquet(f"{path}/data/version={batch_id}")
        batch.unpersist()
        rows = {} if merged.isEmpty() else {r.part: r.n for r in spark.read.parquet(f"{path}/data/version={batch_id}").groupBy("part").agg(F.count("*").alias("n")).collect()}
        new = [(p, batch_id, rows.get(p, 0), parts) for p in sorted(touched)] + [(r.part, r.version, r.rows, parts) for r in listed if parts == had and r.part not in touched]
        spark.createDataFrame(new, "part int, version long, rows long, parts int").coalesce(1).write.mode("overwrite").parquet(f"{path}/manifests/batch={batch_id}")
        clear(spark, path, batch_id, {r.version for r in listed} | {r[1] for r in new})

    return write


def clear(spark: SparkSession, path: str, batch_id: int, named: set[int]) -> None:
    """Deletes versions that are not named, and all but the newest two manifests."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for folder, keep in (("data", lambda k: k in named or k > batch_id), ("manifests", None)):
        found = {int(str(f.getPath().getName()).split("=")[1]): f.getPath() for f in store.listStatus(jvm.org.apache.hadoop.fs.Path(root, folder)) if "=" in f.getPath().getName()}
        newest = sorted(found)[-2:]
        for k, at in found.items():
            if not (keep(k) if keep else k in newest):
                store.delete(at, True)


def upsert_to(path: str, keys: list[str], order: str):  # noqa: ANN201
    """A sink that keeps each key's last row by `order`, the one that came later at a tie."""

    def merge(stored: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch.withColumn("_new", F.lit(1))
        if stored is not None:
            rows = stored.select(*batch.columns).withColumn("_new", F.lit(0)).unionByName(rows)
        return keyed.keep_one(rows, keys, [F.col(order).desc(), F.col("_new").desc()]).drop("_new")

    return keep_in(path, keys, merge)


def counts_to(path: str, keys: list[str], count: str = "n"):  # noqa: ANN201
    """A sink that adds up counts by key: a batch's windows, open or long past, correct those of the table."""

    def merge(stored: DataFrame | None, batch: DataFrame) -> DataFrame:
        rows = batch if stored is None else stored.unionByName(batch)
        return rows.groupBy(*keys).agg(F.sum(count).alias(count))

    return keep_in(path, keys, merge)


def joined_sessions(rows: DataFrame, entity: str) -> DataFrame:
    """Sessions (entity, start, end, reports) that meet or overlap, as one; a report is a session of its own."""
    w = Window.partitionBy(entity).orderBy("start", "end")
    before = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    each = rows.withColumn("_new", (before.isNull() | (F.col("start") > before)).cast("int"))
    each = each.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return each.groupBy(entity, "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("reports").alias("reports")).drop("_run")


def sessions_to(path: str, entity: str):  # noqa: ANN201
    """A sink of visits: a batch's sessions grow, join or precede those of the table, whatever order they come in."""

    def merge(stored: DataFrame | None, batch: DataFrame) -> DataFrame:
        own = batch.select(entity, "start", "end", "reports")
        return joined_sessions(own if stored is None else stored.select(*own.columns).unionByName(own), entity)

    return keep_in(path, [entity], merge)


def window_counts(events: DataFrame, entity: str, time: str, length: str = "1 day", slide: str | None = None) -> DataFrame:
    """One row of count 1 for each report and window, for `counts_to`."""
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return events.select(w.alias("w"), entity).select(F.col("w.start").alias("window_start"), entity, F.lit(1).cast("long").alias("n"))


def slow_reports(events: DataFrame, vessel: str, time: str, speed: str, slow_below: float, gap: str = "30 minutes") -> DataFrame:
    """Sessions of single slow reports, which last until a gap after them, for `sessions_to`."""
    slow = events.where(F.col(speed) < slow_below)
    return slow.select(vessel, F.col(time).alias("start"), (F.col(time) + F.expr(f"INTERVAL {gap}")).alias("end"), F.lit(1).cast("long").alias("reports"))


def positions_and_vessels(decode, positions_path: str, vessels_path: str):  # noqa: ANN001, ANN201
    """A foreachBatch sink that writes both outputs of the message decoder."""

    def write(batch: DataFrame, batch_id: int) -> None:
        for frame, path in zip(decode(batch), (positions_path, vessels_path), strict=True):
            frame.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


class Cooldown(StatefulProcessor):
    """Passes an alert unless one of its key passed less than `seconds` before."""

    def __init__(self, seconds: float):
        self.seconds = seconds

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", "at double")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        frame = pd.concat(list(rows)).sort_values(["at", "alert_id"])
        last = self.last.get()[0] if self.last.exists() else None
        keep = []
        for at in frame["at"]:
            fire = last is None or at - last >= self.seconds
            keep.append(fire)
            last = at if fire else last
        if last is not None:
            self.last.update((float(last),))
        yield frame[keep]

    def close(self) -> None:
        pass


def cooled_down(alerts: DataFrame, key: str, seconds: float) -> DataFrame:
    """alerts have key, at (seconds) and alert_id."""
    schema = f"{key} string, at double, alert_id long"
    return alerts.select(key, "at", "alert_id").groupBy(key).transformWithStateInPandas(Cooldown(seconds), outputStructType=schema, outputMode="Append", timeMode="None")


class VolumeScore(StatefulProcessor):
    """z of each count against the last `window` counts of its source, its own among them."""

    def __init__(self, window: int = 30, least: int = 5):
        self.window, self.least = window, least

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.kept = handle.getValueState("kept", "counts string")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: ANN001, N802, N803
        frame = pd.concat(list(rows)).sort_values(["at", "run_id"])
        kept = json.loads(self.kept.get()[0]) if self.kept.exists() else []
        z = []
        for n in frame["n"].tolist():
            kept = [*kept, n][-self.window :]
            mean = sum(kept) / len(kept)
            sd = (sum((x - mean) ** 2 for x in kept) / len(kept)) ** 0.5
            z.append((n - mean) / sd if len(kept) >= self.least and sd > 0 else None)
        self.kept.update((json.dumps(kept),))
        yield frame.assign(z=pd.array(z, "Float64").to_numpy(dtype=float, na_value=float("nan")))

    def close(self) -> None:
        pass


def scored_volumes(runs: DataFrame, source: str) -> DataFrame:
    """runs have source, at (seconds), run_id and n."""
    schema = f"{source} string, at double, run_id long, n long, z double"
    return runs.select(source, "at", "run_id", "n").groupBy(source).transformWithStateInPandas(VolumeScore(), outputStructType=schema, outputMode="Append", timeMode="None")
