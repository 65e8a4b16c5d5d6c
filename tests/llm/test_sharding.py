from collections import Counter

import pytest

from harborline.llm import sharding


def frame(spark, n):
    return spark.createDataFrame([(i if i % 50 else None, None if i % 17 == 0 else "é" * (i % 90), "s", i) for i in range(n)], "doc_id long, text string, slot string, _mark long")


@pytest.mark.parametrize("bucket", [8 << 20, 900])
def test_counts_and_slots(spark, monkeypatch, bucket):
    monkeypatch.setattr(sharding, "BLOCK", 4)
    docs = frame(spark, 1003).union(frame(spark, 40))
    out = sharding.deal(sharding.external_shuffle(docs, bucket_bytes=bucket), 8)
    rows = out.collect()
    assert out.columns[:4] == docs.columns
    counts = Counter(r._shard for r in rows)
    assert len(rows) == 1043 and set(counts) == set(range(8)) and max(counts.values()) - min(counts.values()) <= 1
    for s, n in counts.items():
        assert sorted(r._slot for r in rows if r._shard == s) == list(range(n))
    assert Counter((r.doc_id, r._mark) for r in rows) == Counter((r.doc_id, r._mark) for r in docs.collect())


def test_order_depends_on_seed_and_rows_alone(spark):
    docs = frame(spark, 300)
    order = lambda d, **k: [r._mark for r in sharding.external_shuffle(d, bucket_bytes=2000, **k).orderBy("_position").collect()]
    a = order(docs)
    assert a == order(docs.repartition(7)) != order(docs, seed=1)
    assert a != sorted(a)
    assert sum(abs(x - y) == 1 for x, y in zip(a, a[1:], strict=False)) < 15


def test_empty_table_and_files(spark, tmp_path):
    assert sharding.external_shuffle(frame(spark, 300).limit(0)).count() == 0
    sharding.write_shards(frame(spark, 100), str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 100 and back.select("_shard").distinct().count() == 8


def test_rows_that_are_equal_in_every_column_are_split(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(sharding, "ALIKE", 50)
    spark.createDataFrame([(7, "same text")] * 700 + [(i, f"text {i}") for i in range(300)], "doc_id long, text string").write.parquet(str(tmp_path / "in"))
    docs = spark.read.parquet(str(tmp_path / "in"))
    per_bucket = sharding.scattered(docs, 16, 42).groupBy("_bucket").count().collect()
    assert max(r["count"] for r in per_bucket) < 250
    rows = sharding.external_shuffle(docs, bucket_bytes=600).collect()
    assert sorted(r._position for r in rows) == list(range(1000)) and Counter(r.doc_id for r in rows)[7] == 701
