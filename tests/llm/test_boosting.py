import zlib

import numpy as np

from harborline.llm import boosting

SF = "/root/testdata/sf0.01"


def out_of(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


def auc(score, label):
    pos, neg = score[label == 1], score[label == 0]
    return np.mean(pos[:, None] > neg) + np.mean(pos[:, None] == neg) / 2


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = boosting.op13_quality_classifier(spark, SF).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == out_of(r.doc_id) for r in rows)
    test = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.doc_id in labels and r.held_out]
    score, predicted, label = (np.array(c) for c in zip(*test, strict=True))
    assert len(test) > 60 and auc(score, label) > 0.97 and np.mean(predicted == label) > 0.95


def test_held_out_labels_are_not_learned_from(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "IF(crc32(CAST(doc_id AS STRING)) % 4 = 2, 1 - quality, quality) AS quality")
    a, b = ({r.doc_id: r.score for r in boosting.classify_quality(docs, x).collect()} for x in (labels, turned))
    assert a == b


def test_statistics_of_odd_texts():
    import pyarrow as pa

    x = boosting.statistics(pa.array(["", None, " \n\t", "A b, b!", "x" * 300_000, "é 日本\x00"]))
    at = {c: i for i, c in enumerate(boosting.STATISTICS)}
    assert np.isfinite(x).all() and (x[0] == 0).all() and (x[1] == 0).all()
    one = x[3]
    assert one[at["log_words"]] == np.log1p(3) and one[at["upper"]] == 1 / 3 and one[at["stops"]] == 1 / 3 and one[at["marks"]] == 2 / 7 and one[at["distinct_words"]] == 1
    assert x[4][at["entropy"]] == 0 and x[5][at["controls"]] == 1 / 5
    alone = [boosting.statistics(pa.array([t]))[0] for t in ("A b, b!", "é 日本\x00")]
    assert np.allclose(alone, x[[3, 5]])


def test_trees_split_like_a_plain_search():
    rnd = np.random.default_rng(5)
    x = rnd.integers(0, 12, (300, 3)).astype(float)
    y = ((x[:, 1] > 6) ^ (x[:, 0] > 3)).astype(float)
    how = boosting.Boosting(trees=1, depth=1, rate=1.0)
    tree = how.fit(x, y)
    p = (y.sum() + 1) / 302
    g, h = p - y, np.full(300, p * (1 - p))
    gain = lambda s: sum(g[k].sum() ** 2 / (h[k].sum() + 1) for k in (s, ~s))
    best = max(gain(x[:, f] <= c) for f in range(3) for c in range(11))
    assert np.isclose(gain(x[:, tree.feature[0, 0]] <= tree.threshold[0, 0]), best)
    deep = boosting.Boosting(trees=30).fit(x, y)
    assert np.mean((deep.chances(x) > 0.5) == y) > 0.98


def plain_chance(trees, row):
    total = trees.base
    for f, c, v in zip(trees.feature, trees.threshold, trees.values, strict=True):
        i = 0
        while i < len(f):
            i = 2 * i + 1 + int(row[f[i]] > c[i])
        total += v[i - len(f)]
    return 1 / (1 + np.exp(-total))


def test_flat_traversal_is_tree_by_tree():
    rnd = np.random.default_rng(6)
    x = rnd.normal(size=(200, 5))
    trees = boosting.Boosting(trees=12, depth=3).fit(x, (x[:, 0] * x[:, 1] > 0).astype(float))
    assert np.allclose(trees.chances(x), [plain_chance(trees, r) for r in x])


def test_defined_results(spark):
    docs = spark.createDataFrame([(i, f"word{i} " * (i % 5 + 1), "x") for i in range(40)] + [(None, "a text", "y"), (3, "another", "z"), (41, None, None)], "doc_id long, text string, label string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in boosting.classify_quality(docs, none).collect()} == {0.5}
    odd = spark.createDataFrame([(0, 1), (1, 1), (1, 0), (4, None), (5, 7), (None, 1), (3, 1), (3, 1)], "doc_id long, quality int")
    used = boosting.training_rows(docs.select("doc_id", "text"), odd).collect()
    assert sorted(r.doc_id for r in used) == [i for i in (0, 3, 3) if not out_of(i)]
    assert boosting.training_rows(docs.select("doc_id", "text"), odd, most=1).count() == 1
    out = boosting.classify_quality(docs, odd).collect()
    assert len(out) == 43 and len({r.score for r in out}) == 1 and not next(r for r in out if r.doc_id is None).held_out
    assert boosting.classify_quality(docs.limit(0), odd).count() == 0
