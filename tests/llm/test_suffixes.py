import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from harborline.llm import suffixes


def brute(docs, n=400):
    raw = [(i, (t or "").encode()) for i, t in docs]
    count = Counter(x[p : p + n] for _, x in raw for p in range(len(x) - n + 1))
    out = {}
    for i, x in raw:
        gone = np.zeros(len(x), bool)
        for p in range(len(x) - n + 1):
            if count[x[p : p + n]] > 1:
                gone[p : p + n] = True
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(x) else 0
        kept = bytes(b for b, g in zip(x, gone, strict=True) if not g)
        out[i] = (len(x), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("bucket", [4 << 20, 6_000])
def test_planted_passages(spark, monkeypatch, bucket):
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 60_000)
    monkeypatch.setattr(suffixes, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(suffixes, "RANGE_BYTES", bucket)
    rnd = random.Random(6)
    text = lambda n: "".join(rnd.choice("abcdé fgh\n") for _ in range(n))
    passages = [text(n) for n in (360, 398, 401, 500, 900, 1500)]
    docs = []
    for i in range(90):
        t = text(rnd.randrange(0, 300))
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p)) if rnd.random() < 0.4 else 0
            t += p[a : a + rnd.randrange(300, 1400)] + text(rnd.randrange(0, 60))
        docs.append((rnd.randrange(10**6) * 100 + i, t))
    docs += [(10**9 + i, docs[5][1]) for i in range(3)] + [(1, None), (2, ""), (3, "ab" * 1000), (4, "x" * 399), (5, "y" * 400), (6, "z" * 401)]
    docs += [(10**10 + i, passages[4][: 700 + i] + str(i)) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect()}
    want = brute(docs)
    assert got == want, [(k, got.get(k), want[k]) for k in want if got.get(k) != want[k]][:4]


def test_small_tables(spark):
    assert suffixes.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    t = "".join(chr(97 + i * i % 23) + str(i) for i in range(200))
    docs = spark.createDataFrame([(1, t, "x"), (None, t + t, "y"), (2, t[:450] + "z", "y")], "doc_id long, text string, spans string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in suffixes.remove_repeats(docs).collect()) == [(0, 0), (1, 450), (2, 450)]


def test_multikey_order():
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (500, 24)).astype(np.uint8)
    rows[100:200, 8:] = rows[100, 8:]
    order = suffixes.multikey_order(rows)
    assert [rows[i].tobytes() for i in order] == sorted(r.tobytes() for r in rows)


def test_rows_that_repeat_an_id_are_texts_of_their_own(spark, monkeypatch):
    """Same id with other text, same id and text, null ids, against brute force over rows."""
    monkeypatch.setattr(suffixes, "SHARD_BYTES", 5_000)
    rnd = random.Random(9)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    a, b, c, common = text(944), text(800), text(2500), text(450)
    rows = [(3, a), (5, a), (5, b), (5, c), (1, c[600:1200]), (7, b[:100] + common), (7, common + "x"), (8, "short"), (8, text(1300)), (9, c), (9, c), (5, None)]
    df = spark.createDataFrame([*rows, (None, a), (None, text(900))], "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect() if r.doc_id is not None)
    want = Counter()
    for k, x in brute(list(enumerate(t for _, t in rows))).items():
        want[rows[k][0], *x] += 1
    assert got == want
    assert all(r.n_removed == 0 for r in suffixes.remove_repeats(df).where("doc_id IS NULL").collect())


def test_one_passage_in_every_document_at_tiny_sizes(spark, monkeypatch):
    for name, n in (("SHARD_BYTES", 2_000), ("PART_BYTES", 700), ("BUCKET_BYTES", 3_000), ("RANGE_BYTES", 5_000)):
        monkeypatch.setattr(suffixes, name, n)
    rnd = random.Random(10)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = text(520)
    docs = [(i, text(rnd.randrange(200)) + passage + text(rnd.randrange(200))) for i in range(150)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(7)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffixes.remove_repeats(df).collect()}
    assert got == brute(docs)
    plan = suffixes.remove_repeats(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Window [" not in plan


def test_neighbours_in_key_order():
    import pyarrow as pa

    keys = [1, 2, 2, 3, 4, 4, 4, 5, 6]
    known = [False] * 8 + [True]
    whole = pa.RecordBatch.from_arrays([pa.array(keys), pa.array(known)], ["key", "known"])
    for cut in (1, 2, 3, 5, 9):
        batches = [whole.slice(i, cut) for i in range(0, 9, cut)]
        assert [k for b in suffixes.shared_keys(iter(batches)) for k in b.column("key").to_pylist()] == [2, 2, 4, 4, 4, 6]


def test_no_task_gets_a_large_group_of_copies(spark):
    """3,000 copies of a text, some of them twice under one id: marks as counted by hand, and no task reads most of the group."""
    ids = [*range(10, 3010), *range(10, 60)]
    df = spark.createDataFrame([*[(i, "a" * 500) for i in ids], (1, "b" * 500), (2, None), (None, "a" * 500), (3, "c"), (3, "d")], "doc_id long, text string").repartition(4)
    sc = spark.sparkContext
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    sc.setJobGroup("copies", "")
    try:
        got = Counter((r.doc_id, r.twin, r.copy) for r in suffixes.twins(df).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert got == Counter((i, True, True if i > 10 else None) for i in set(ids))
    most = sc._gateway.new_array(sc._jvm.double, 1)
    most[0] = 1.0
    stages = {s for j in sc.statusTracker().getJobIdsForGroup("copies") for s in sc.statusTracker().getJobInfo(j).stageIds}
    summaries = [sc._jsc.sc().statusStore().taskSummary(s, 0, most) for s in stages]
    read = [x.get().shuffleReadMetrics().readRecords().head() for x in summaries if x.isDefined()]
    assert 0 < max(read) < 1500, read
