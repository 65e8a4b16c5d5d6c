"""Streams over the same files as their batch twins."""

import datetime as dt

from pyspark.sql import functions as F

from harborline.plans import streams
from harborline.streaming import jobs


def landed(spark, tmp_path, rows, schema):
    for i in range(0, len(rows), max(1, len(rows) // 3)):
        spark.createDataFrame(rows[i : i + max(1, len(rows) // 3)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return jobs.read_events(spark, str(tmp_path / "in"), 1)


START = dt.datetime(2024, 1, 1)


def test_windows_match_batch_once_closed(spark, tmp_path):
    rows = [(i % 3, START + dt.timedelta(hours=5 * i)) for i in range(60)]
    got = streams.run_to_end(spark, jobs.windowed_counts(landed(spark, tmp_path, rows, "k long, ts timestamp"), "k", "ts", late="1 day"))
    batch = jobs.windowed_counts(spark.createDataFrame(rows, "k long, ts timestamp"), "k", "ts").collect()
    emitted = {tuple(r) for r in got.collect()}
    assert emitted and emitted <= {tuple(r) for r in batch}
    last = max(r[1] for r in rows) - dt.timedelta(days=3)
    assert {tuple(r) for r in batch if r.window_start < last} <= emitted


def test_dedup_and_sessions(spark, tmp_path):
    rows = [(1, START + dt.timedelta(minutes=m), 0.5, i) for i, m in enumerate([0, 10, 20, 200, 210, 3000, 3000])] + [(1, START, 0.5, 0)]
    stream = landed(spark, tmp_path, rows, "ship long, ts timestamp, sog double, id long")
    assert streams.run_to_end(spark, jobs.deduplicated(stream, ["id"], "ts", "90 days")).count() == 7
    visits = streams.run_to_end(spark, jobs.dwell_sessions(stream, "ship", "ts", "sog", 1.0))
    assert {(r.start - START, r.reports) for r in visits.collect()} >= {(dt.timedelta(minutes=200), 2)}


def test_upsert_keeps_the_newest(spark, tmp_path):
    rows = [(i % 4, i, float(i)) for i in range(30)]
    stream = landed(spark, tmp_path, rows, "k long, seq long, x double")
    path = str(tmp_path / "table")
    stream.writeStream.foreachBatch(jobs.upsert_to(path, ["k"], "seq")).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()
    assert {(r.k, r.seq) for r in jobs.current_table(spark, path).collect()} == {(0, 28), (1, 29), (2, 26), (3, 27)}


def test_upsert_survives_a_crash_between_its_writes(spark, tmp_path):
    path, frame = str(tmp_path / "table"), lambda rows: spark.createDataFrame(rows, "k long, seq long")
    state = lambda: {(r.k, r.seq) for r in jobs.current_table(spark, path).collect()}
    write = jobs.upsert_to(path, ["k"], "seq")
    write(frame([(k, 1) for k in range(40)]), 0)
    before = state()
    batch = frame([(k, 2) for k in range(0, 40, 3)])
    # the second batch's files are there, but no pointer to them
    batch.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(jobs.PARTS)).cast("int")).write.partitionBy("part").parquet(f"{path}/data/version=1")
    assert state() == before == {(k, 1) for k in range(40)}
    for _ in range(2):  # and a replay of a batch that was done changes nothing
        write(batch, 1)
        assert state() == {(k, 2 if k % 3 == 0 else 1) for k in range(40)}


def test_stateful_alerts_and_volumes(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = [("a", float(t), i) for i, t in enumerate([0, 50, 120, 130, 260])]
    out = streams.run_to_end(spark, jobs.cooled_down(landed(spark, tmp_path, rows, "k string, at double, alert_id long"), "k", 100.0))
    assert sorted(r.at for r in out.collect()) == [0.0, 120.0, 260.0]
    runs = [("s", float(i), i, n) for i, n in enumerate([10, 10, 11, 10, 10, 90])]
    z = streams.run_to_end(spark, jobs.scored_volumes(landed(spark, tmp_path / "b", runs, "source string, at double, run_id long, n long"), "source"))
    scores = {r.run_id: r.z for r in z.collect()}
    assert scores[5] > 2 and z.where(F.col("run_id") < 4).where("z IS NOT NULL AND NOT isnan(z)").count() == 0


def spoiled(rows, n):
    """rows in n files, newest first."""
    return [rows[i::n] for i in range(n)][::-1]


def run_kept(spark, tmp_path, files, schema, shape, sink):
    for own in files:
        spark.createDataFrame(own, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    rows = shape(jobs.read_events(spark, str(tmp_path / "in"), 1))
    rows.writeStream.foreachBatch(sink).option("checkpointLocation", str(tmp_path / "log")).trigger(availableNow=True).start().awaitTermination()


def test_open_windows_and_late_rows_are_in_the_table(spark, tmp_path):
    rows = [(i % 3, START + dt.timedelta(hours=7 * i)) for i in range(60)]
    batch = spark.createDataFrame(rows, "k long, ts timestamp")
    for name, files in (("a", spoiled(rows, 4)), ("b", [rows[40:], rows[:5], rows[5:40]])):
        path = str(tmp_path / name / "table")
        (tmp_path / name).mkdir()
        run_kept(spark, tmp_path / name, files, "k long, ts timestamp", lambda e: jobs.window_counts(e, "k", "ts", "3 days", "1 day"), jobs.counts_to(path, ["k", "window_start"]))
        want = jobs.windowed_counts(batch, "k", "ts", "3 days", "1 day")
        assert sorted(map(tuple, jobs.current_table(spark, path).select("window_start", "k", "n").collect())) == sorted(map(tuple, want.collect()))


def test_sessions_grow_join_and_precede(spark, tmp_path):
    minutes = [0, 20, 45, 100, 130, 155, 400, 430, 900, 931]
    rows = [(s, START + dt.timedelta(minutes=m + s), 0.5) for m in minutes for s in (1, 2)] + [(1, START + dt.timedelta(minutes=70), 9.0)]
    path = str(tmp_path / "table")
    files = [[r for r in rows if r[1].minute % 3 == k] for k in (1, 0, 2)]
    run_kept(spark, tmp_path, files, "ship long, ts timestamp, sog double", lambda e: jobs.slow_reports(e, "ship", "ts", "sog", 1.0), jobs.sessions_to(path, "ship"))
    got = sorted((r.ship, (r.start - START).seconds // 60 - r.ship, (r.end - START).seconds // 60 - r.ship, r.reports) for r in jobs.current_table(spark, path).collect())
    visits = [(0, 75, 3), (100, 185, 3), (400, 460, 2), (900, 930, 1), (931, 961, 1)]
    assert got == [(s, *x) for s in (1, 2) for x in visits]


def test_parts_double_replays_do_nothing_and_old_versions_go(spark, tmp_path):
    path = str(tmp_path / "table")
    write = jobs.keep_in(path, ["k"], lambda old, new: new if old is None else old.unionByName(new).groupBy("k").agg(F.sum("n").alias("n")), first_parts=2, part_rows=20)
    for b in range(6):
        batch = spark.createDataFrame([(k, 1) for k in range(30 * b, 30 * b + 60)], "k long, n long").groupBy("k").agg(F.sum("n").alias("n"))
        for _ in range(2):
            write(batch, b)
    out = {r.k: r.n for r in jobs.current_table(spark, path).collect()}
    assert out == {k: 1 if k < 30 or k >= 180 else 2 for k in range(210)}
    assert jobs.manifest(spark, path).head().parts == 16
    assert len(list((tmp_path / "table" / "manifests").glob("batch=*"))) == 2 and len(list((tmp_path / "table" / "data").glob("version=*"))) <= 3
