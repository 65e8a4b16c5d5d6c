"""Queries that run the streaming jobs to the end of what has landed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import parse
from ..streaming import jobs
from . import ingest, monitoring, vessels
from . import views as v

QUERIES, ORACLE_SQL = {}, {}


def shared(spark: SparkSession) -> str:
    """A new folder that driver and executors share; only in local mode one below the warehouse."""
    import uuid

    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_streams"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def run_to_end(spark: SparkSession, stream: DataFrame, mode: str = "append") -> DataFrame:
    """Everything that the stream emits for the files there are."""
    path = shared(spark)
    q = stream.writeStream.outputMode(mode).format("parquet").option("path", f"{path}/out").option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out")


def events(spark: SparkSession, sf: str) -> DataFrame:
    """The event files as a stream; times as instants, which watermarks need."""
    return jobs.read_events(spark, f"{sf}/events.parquet*").withColumn("ts", F.col("ts").cast("timestamp"))


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Reports of which every third has landed twice."""
    e = v.table(spark, sf, "events")
    path = shared(spark)
    e.unionByName(e.where("event_id % 3 = 0")).write.parquet(path)
    landed = jobs.read_events(spark, path).withColumn("ts", F.col("ts").cast("timestamp"))
    return run_to_end(spark, jobs.deduplicated(landed, ["event_id"], "ts", "40 days").select("event_id", "user_id", "ts"))


QUERIES["stream_dedup"] = stream_dedup


def kept(spark: SparkSession, rows: DataFrame, sink, path: str) -> DataFrame:  # noqa: ANN001
    """The table that a sink keeps once all that has landed went through it."""
    q = rows.writeStream.foreachBatch(sink).option("checkpointLocation", f"{path}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    return jobs.current_table(spark, f"{path}/table").drop("part", "version")


def scattered(spark: SparkSession, sf: str) -> DataFrame:
    """The events landed in files that are in no order of time, a few to a batch."""
    path = shared(spark)
    v.table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp")).repartition(FILES, F.xxhash64("event_id")).write.parquet(path)
    return jobs.read_events(spark, path, 2)


FILES = 6
NTZ = "timestamp_ntz"


def stream_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    """Reports per user and day; every window is there, the newest too, and late reports count."""
    path = shared(spark)
    out = kept(spark, jobs.window_counts(scattered(spark, sf), "user_id", "ts"), jobs.counts_to(f"{path}/table", ["user_id", "window_start"]), path)
    return out.withColumn("window_start", F.col("window_start").cast(NTZ))


def stream_sliding(spark: SparkSession, sf: str) -> DataFrame:
    """Reports per kind in weeks that start every day."""
    path = shared(spark)
    out = kept(spark, jobs.window_counts(scattered(spark, sf), "event_type", "ts", "7 days", "1 day"), jobs.counts_to(f"{path}/table", ["event_type", "window_start"]), path)
    return out.withColumn("window_start", F.col("window_start").cast(NTZ))


def stream_dwell_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Visits: slow reports with no longer gap than six hours; end is six hours after the last."""
    path = shared(spark)
    out = kept(spark, jobs.slow_reports(scattered(spark, sf), "user_id", "ts", "value", 20.0, "6 hours"), jobs.sessions_to(f"{path}/table", "user_id"), path)
    return out.withColumns({"start": F.col("start").cast(NTZ), "end": F.col("end").cast(NTZ)})


for _f in (stream_tumbling, stream_sliding, stream_dwell_sessions):
    QUERIES[_f.__name__] = _f
ORACLE_SQL["stream_tumbling"] = "SELECT user_id, date_trunc('day', ts) AS window_start, count(*) AS n FROM events GROUP BY 1, 2"
ORACLE_SQL["stream_sliding"] = "SELECT event_type, date_trunc('day', ts) - INTERVAL 1 DAY * k AS window_start, count(*) AS n FROM events CROSS JOIN generate_series(0, 6) g(k) GROUP BY 1, 2"
ORACLE_SQL["stream_dwell_sessions"] = """SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 6 HOUR AS "end", count(*) AS reports FROM (SELECT *, sum(gone) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS run FROM (
  SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS gone FROM events WHERE value < 20.0)) GROUP BY user_id, run"""


def stream_enrich(spark: SparkSession, sf: str) -> DataFrame:
    register = vessels.register(spark, sf).select(F.col("mmsi").alias("user_id"), "vessel_type", "year_built")
    return run_to_end(spark, jobs.enriched(events(spark, sf).select("event_id", "user_id", "ts"), register, "user_id"))


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The last report of each vessel, by repeated upserts."""
    path = shared(spark)
    latest = scattered(spark, sf).select("user_id", "event_id", "ts", "value")
    out = kept(spark, latest, jobs.upsert_to(f"{path}/table", ["user_id"], "event_id"), path)
    return out.withColumn("ts", F.col("ts").cast(NTZ))


QUERIES["stream_enrich"] = stream_enrich
ORACLE_SQL["stream_enrich"] = v.with_views("SELECT e.event_id, e.user_id, e.ts, r.vessel_type, r.year_built FROM events e LEFT JOIN reg r ON r.mmsi = e.user_id", v.VESSELS, vessels.REGISTER)
QUERIES["stream_upsert"] = stream_upsert
ORACLE_SQL["stream_upsert"] = "SELECT user_id, max(event_id) AS event_id, arg_max(ts, event_id) AS ts, arg_max(value, event_id) AS value FROM events GROUP BY 1"
ORACLE_SQL["stream_dedup"] = "SELECT event_id, user_id, ts FROM events"


def stream_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Message envelopes decoded as they land, into a table of positions and one of vessel data."""
    raw, out = shared(spark), shared(spark)
    ingest.envelopes(spark, sf).write.parquet(raw)
    sink = jobs.positions_and_vessels(parse.ais_messages, f"{out}/positions", f"{out}/vessels")
    q = jobs.read_events(spark, raw).writeStream.foreachBatch(sink).option("checkpointLocation", f"{out}/log").trigger(availableNow=True).start()
    q.awaitTermination()
    both = [spark.read.parquet(f"{out}/{n}").drop("batch") for n in ("positions", "vessels")]
    return both[0].unionByName(both[1], allowMissingColumns=True).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


QUERIES["stream_positions"] = stream_positions
ORACLE_SQL["stream_positions"] = ingest.ORACLE_SQL["parse_ais_messages"]


def landed(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows as a stream of files, with state kept in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    path = shared(spark)
    rows.write.parquet(path)
    return jobs.read_events(spark, path)


def stream_alert_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    """Alerts about slow runs, at most one a day for each source."""
    slow = monitoring.duration_anomaly(spark, sf).join(v.runs(spark, sf).select("run_id", "collection_ts"), "run_id")
    alerts = slow.select("source", (F.unix_micros(F.col("collection_ts").cast("timestamp")) / 1e6).alias("at"), F.col("run_id").alias("alert_id"))
    return run_to_end(spark, jobs.cooled_down(landed(spark, alerts), "source", 86_400.0))


QUERIES["stream_alert_cooldown"] = stream_alert_cooldown
ORACLE_SQL["stream_alert_cooldown"] = v.with_views(" SELECT source, epoch_us(collection_ts) / 1e6 AS at, run_id AS alert_id FROM slow JOIN fired USING (source, i)", v.RUNS, monitoring.SLOW).replace("WITH", "WITH RECURSIVE", 1)


def stream_volume_anomaly(spark: SparkSession, sf: str) -> DataFrame:
    """Every run's rows against the last runs of its source."""
    runs = v.runs(spark, sf).select("source", (F.unix_micros(F.col("collection_ts").cast("timestamp")) / 1e6).alias("at"), "run_id", F.col("rows_written").alias("n"))
    return run_to_end(spark, jobs.scored_volumes(landed(spark, runs), "source")).select("source", "run_id", "n", F.nanvl("z", F.lit(None).cast("double")).alias("z"))


QUERIES["stream_volume_anomaly"] = stream_volume_anomaly
ORACLE_SQL["stream_volume_anomaly"] = v.with_views("SELECT source, run_id, rows_written AS n, CASE WHEN count(rows_written) OVER w >= 5 AND stddev_pop(rows_written) OVER w > 0 THEN (rows_written - avg(rows_written) OVER w) / stddev_pop(rows_written) OVER w END AS z FROM v_runs WINDOW w AS (PARTITION BY source ORDER BY collection_ts, run_id ROWS 29 PRECEDING)", v.RUNS)
