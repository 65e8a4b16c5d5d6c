"""Operator 13, a quality classifier: histogram gradient-boosted trees over document statistics.

Statistics of whole texts come from numpy, a batch of texts at once.  Labelled
texts that are not held out give the rows to learn from, at most SAMPLE_ROWS of
them by a hash of the id; their statistics are put into bins once, and each node
of a tree splits where sums of gradients and curvatures by bin gain most.  All
trees have the same depth and lie in three arrays, so scoring is a few gathers
per level for a whole batch.  Scoring is a map over the scan of all documents.

Defined results: a null or empty text has statistics like any other (all zero)
and gets a score; repeated rows get equal scores; labels other than 0 and 1 are
not learned from, nor are ids that have both; a null id is no held-out one and
has no label.  Without rows to learn from the score is 0.5, and with labels of
one kind it is their share, one of either kind added.  Other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, id_and_text, per_row, table, text_bytes, text_parts
from .quality import measure

#: The bound of the sample that the trees are fitted on.
SAMPLE_ROWS = 20_000
PART_BYTES = 2 << 20
#: Ids with this remainder of their hash are held out.
FOLDS, HELD_OUT = 4, 2
KEEP = 0.7
RESULT = "doc_id long, held_out boolean, score double, predicted int"

STATISTICS = [
    "log_words", "log_chars", "log_lines", "word_length", "longest_word", "words_per_line", "symbols", "bars", "exclamations", "stops",
    "upper", "digits", "marks", "blanks", "beyond_ascii", "controls", "capitalised", "shouted", "wordless", "short_words",
    "distinct_words", "commonest_word", "same_as_before", "repeat_words", "dup_chars_6", "dup_lines", "entropy",
]


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(texts: pa.Array) -> np.ndarray:
    """A row of STATISTICS for each text."""
    texts = texts.fill_null("")
    data, off = text_bytes(texts)
    w, m, rows = Words(data, off), measure(texts), len(off) - 1
    kind = np.zeros(256, np.uint8)  # of a byte: 1 lower, 2 upper, 3 digit, 4 mark, 5 blank, 6 beyond ASCII, 7 control
    for k, (a, b) in enumerate(((97, 123), (65, 91), (48, 58), (33, 48), (32, 33), (128, 256), (0, 32)), 1):
        kind[a:b] = k
    kind[58:65] = kind[91:97] = kind[123:127] = 4
    kind[9:14] = 5
    of = kind[data]
    size = np.diff(off)
    count = lambda flags: per_row(flags, off)
    letters = count((of == 1) | (of == 2) | (of == 6))
    chars = count((data & 0xC0) != 0x80)
    first, last = (data[at] for at in (w.start, w.end - 1)) if len(w.doc) else (data[:0], data[:0])
    sums = {}
    for name, flags in (("upper", of == 2), ("letter", (of == 1) | (of == 2) | (of == 6))):
        c = np.concatenate([[0], np.cumsum(flags)])
        sums[name] = c[w.end] - c[w.start]
    length = w.end - w.start
    ids, _ = w.encoded()
    of_words = lambda flags: per_row(flags, w.first)
    pair, times = np.unique(w.doc * (len(ids) + 1) + ids, return_counts=True)
    owner = pair // (len(ids) + 1)
    most = np.zeros(rows, np.int64)
    np.maximum.at(most, owner, times)
    again = np.zeros(len(ids), bool)
    again[1:] = (ids[1:] == ids[:-1]) & (w.doc[1:] == w.doc[:-1])
    histogram = np.bincount(np.repeat(np.arange(rows), size) * 256 + data, minlength=256 * rows).reshape(rows, 256) / np.maximum(size, 1)[:, None]
    n = m["n_words"]
    columns = {
        "log_words": np.log1p(n),
        "log_chars": np.log1p(chars),
        "log_lines": np.log1p(m["n_lines"]),
        "word_length": share(m["word_chars"], n),
        "longest_word": np.log1p(_largest(length, w.doc, rows)),
        "words_per_line": share(n, m["n_lines"]),
        "symbols": share(m["n_symbols"], n),
        "bars": share(count(data == 124), n),
        "exclamations": share(count(data == 33), n),
        "stops": share(of_words((last == 46) | (last == 33) | (last == 63)), n),
        "upper": share(count(of == 2), letters),
        "digits": share(count(of == 3), chars),
        "marks": share(count(of == 4), chars),
        "blanks": share(count(of == 5), chars),
        "beyond_ascii": share(count(of == 6), size),
        "controls": share(count(of == 7), chars),
        "capitalised": share(of_words(kind[first] == 2), n),
        "shouted": share(of_words((sums["letter"] > 1) & (sums["upper"] == sums["letter"])), n),
        "wordless": share(of_words(sums["letter"] == 0), n),
        "short_words": share(of_words(length <= 2), n),
        "distinct_words": share(np.bincount(owner, minlength=rows), n),
        "commonest_word": share(most, n),
        "same_as_before": share(of_words(again), n),
        "repeat_words": share(m["n_repeat_words"], n),
        "dup_chars_6": share(m["dup_chars_6"], m["word_chars"]),
        "dup_lines": share(m["n_dup_lines"], m["n_lines"]),
        "entropy": -np.sum(histogram * np.log2(np.where(histogram > 0, histogram, 1)), axis=1),
    }
    return np.stack([columns[c].astype(np.float64) for c in STATISTICS], 1)


def _largest(values: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    out = np.zeros(rows, np.int64)
    np.maximum.at(out, owner, values)
    return out


@dataclass
class Trees:
    """Boosted trees of one depth: node i has the children 2i+1 and 2i+2; values hold the leaves of each tree."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    values: np.ndarray

    def chances(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, values in zip(self.feature, self.threshold, self.values, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:  # all rows are on one level
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += values[node - inner]
        return 1 / (1 + np.exp(-total))


@dataclass
class Boosting:
    """How the trees are grown."""

    trees: int = 80
    depth: int = 4
    rate: float = 0.1
    bins: int = 64
    ridge: float = 1.0
    least_curvature: float = 1.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        inner = 2**self.depth - 1
        positive = (y.sum() + 1) / (len(y) + 2) if len(y) else 0.5
        base = float(np.log(positive / (1 - positive)))
        n_trees = self.trees if 0 < y.sum() < len(y) else 0
        out = Trees(base, np.zeros((n_trees, inner), np.int64), np.full((n_trees, inner), np.inf), np.zeros((n_trees, inner + 1)))
        if not n_trees:
            return out
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        codes = np.stack([np.searchsorted(c, v) for c, v in zip(cuts, x.T, strict=True)], 1)  # code <= k exactly where value <= cuts[k]
        score = np.full(len(y), base)
        for t in range(n_trees):
            p = 1 / (1 + np.exp(-score))
            node = self.grow(codes, cuts, p - y, p * (1 - p), out.feature[t], out.threshold[t])
            g, h = (np.bincount(node - inner, weights=v, minlength=inner + 1) for v in (p - y, p * (1 - p)))
            out.values[t] = -self.rate * g / (h + self.ridge)
            score += out.values[t][node - inner]
        return out

    def grow(self, codes: np.ndarray, cuts: list[np.ndarray], g: np.ndarray, h: np.ndarray, feature: np.ndarray, threshold: np.ndarray) -> np.ndarray:
        """Fills feature and threshold level by level; returns the leaf of each row. A node without a gain sends all rows left."""
        node = np.zeros(len(g), np.int64)
        for level in range(self.depth):
            first, width = 2**level - 1, 2**level
            at = node - first
            best = np.zeros(width)
            code = np.full(width, self.bins)
            for f, c in enumerate(cuts):
                if not len(c):
                    continue
                cell = at * self.bins + codes[:, f]
                left_g, left_h = (np.bincount(cell, weights=v, minlength=width * self.bins).reshape(width, self.bins).cumsum(1) for v in (g, h))
                right_g, right_h = left_g[:, -1:] - left_g, left_h[:, -1:] - left_h
                gain = left_g**2 / (left_h + self.ridge) + right_g**2 / (right_h + self.ridge) - left_g[:, -1:] ** 2 / (left_h[:, -1:] + self.ridge)
                gain[(left_h < self.least_curvature) | (right_h < self.least_curvature)] = 0
                gain = gain[:, : len(c)]
                k = gain.argmax(1)
                top = gain[np.arange(width), k]
                better = top > best + 1e-9
                best = np.where(better, top, best)
                code = np.where(better, k, code)
                nodes = first + np.flatnonzero(better)
                feature[nodes], threshold[nodes] = f, c[k[better]]
            node = 2 * node + 1 + (codes[np.arange(len(g)), feature[node]] > code[at])
        return node


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def with_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, label and STATISTICS of doc_id, label and text."""
    schema = "doc_id long, label int, " + ", ".join(f"{c} double" for c in STATISTICS)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, PART_BYTES):
            x = statistics(part.column("text"))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("label"), *(pa.array(c) for c in x.T)], ["doc_id", "label", *STATISTICS])

    return docs.mapInArrow(add, schema)


def training_rows(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """Statistics and labels of at most ``most`` labelled texts that are not held out."""
    labels = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    clear = labels.where("doc_id IS NOT NULL AND label IN (0, 1)").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other")).where("label = other")
    chosen = clear.select("doc_id", "label").orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = with_statistics(docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id", *STATISTICS).limit(most)  # an id may come with many texts


def fit_quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS, boosting: Boosting | None = None) -> Trees:
    rows = training_rows(id_and_text(docs), labels, most).toPandas()
    return (boosting or Boosting()).fit(rows[STATISTICS].to_numpy(float), rows["label"].to_numpy(float))


def score_quality(docs: DataFrame, trees: Trees, keep: float = KEEP) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in text_parts(batches, PART_BYTES):
            p = trees.chances(statistics(part.column("text")))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([i is not None and zlib.crc32(b"%d" % i) % FOLDS == HELD_OUT for i in part.column("doc_id").to_pylist()], pa.bool_()), pa.array(p), pa.array((p >= keep).astype(np.int32))], ["doc_id", "held_out", "score", "predicted"])

    return id_and_text(docs).mapInArrow(score, RESULT)


def classify_quality(docs: DataFrame, labels: DataFrame, most: int = SAMPLE_ROWS) -> DataFrame:
    """Learns from the labels and scores every document."""
    return score_quality(docs, fit_quality(docs, labels, most))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op13_quality_classifier": op13_quality_classifier}
ORACLE_SQL: dict[str, str] = {}
