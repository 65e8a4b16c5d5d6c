"""Operator 12, whitening of embeddings by spectrum slicing.

Entries become whole numbers, so all sums over the table are exact, whatever
order they are added in.  Spark takes the distinct vectors, their sums, and the
sums of products of the centred vectors; what reaches the driver is a matrix as
wide as the vectors, however many there are.  There, the signs of the pivots of
an LDL' factorisation of the covariance minus a shift count the eigenvalues above
the shift.  Bisection on those counts isolates each leading eigenvalue, Rayleigh
quotient iteration finds its vector, and two more counts, just below and above
the value found, certify that it has the number it is given.  Eigenvalues too
close to be told apart get orthogonal vectors of their common space.

Defined results: vectors that are null, or hold a null, NaN or infinite entry,
are dropped.  Vectors of different lengths cannot be whitened together: the
length that most distinct vectors have (the smaller of equals) is kept.  Entries
of 2**23 and more in size count as that.  Repeated rows, also of one id, each
get their rows; a null id stays null.  A component whose eigenvalue is no more
than rounding cannot be scaled and is left out, so equal vectors only, or an
empty table, give no rows.  deviation is null where it passes a long.  Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

COMPONENTS = 4
SCALE = 256
#: The largest size of a whole-number entry.
MOST = 2**31 - 1
#: Vectors whose products are added up at once.
ROWS = 4096
RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
#: Pivots of one row are taken while they are at least this share of the largest entry beside them (Bunch and Parlett).
PIVOT = (1 + 17**0.5) / 8


def usable(vectors: pa.Array) -> np.ndarray:
    """Which rows hold a vector of finite entries."""
    given = vectors.is_valid().to_numpy(zero_copy_only=False)
    flat = vectors.flatten()
    entries = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry reads as NaN
    lengths = np.where(given, vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False), 0)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(entries))])
    ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return given & (bad[ends[1:]] == bad[ends[:-1]])


def whole(entries: np.ndarray) -> np.ndarray:
    return np.clip(np.floor(SCALE * entries.astype(np.float64)), -MOST, MOST).astype(np.int64)


def as_matrices(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, their whole-number vectors) for each length of usable vectors."""
    vectors = batch.column("embedding")
    rows = np.flatnonzero(usable(vectors))
    lengths = vectors.take(pa.array(rows)).value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths).tolist():
        these = rows[lengths == d]
        yield these, whole(vectors.take(pa.array(these)).flatten().to_numpy(zero_copy_only=False)).reshape(len(these), d)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as bytes: two for an entry where all entries of the vector allow it, else four."""
    for batch in batches:
        for _, x in as_matrices(batch):
            small = np.abs(x).max(1, initial=0) < 1 << 15
            for which, kind in ((small, "<i2"), (~small, "<i4")):
                part = np.ascontiguousarray(x[which].astype(kind))
                if not len(part):
                    continue
                off = np.arange(len(part) + 1, dtype=np.int32) * (part.shape[1] * part.itemsize)
                raw = pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(off), pa.py_buffer(part)])
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), x.shape[1], np.int32)), raw], ["d", "x"])


def unpacked(column: pa.Array, d: int) -> np.ndarray:
    """The rows of packed vectors of one length, as one matrix."""
    out = np.zeros((len(column), d), np.int64)
    raw = column.to_pylist()
    for kind in ("<i2", "<i4"):
        rows = [i for i, x in enumerate(raw) if len(x) == d * np.dtype(kind).itemsize]
        out[rows] = np.frombuffer(b"".join([raw[i] for i in rows]), kind).reshape(-1, d)
    return out


def fit_list(vectors: DataFrame) -> DataFrame:
    """(d, x): each distinct vector once; copies meet before and after the exchange."""
    return vectors.select("embedding").mapInArrow(_packed, "d int, x binary").distinct()


def exact_sums(df: DataFrame, of) -> dict[int, int]:  # noqa: ANN001
    """Whole numbers that ``of`` makes of a matrix of vectors, summed by place over all rows; df has packed vectors of one length."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = of(batch.column("x").slice(at, ROWS))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array([Decimal(int(v)) for v in total], pa.decimal128(38, 0))], ["i", "v"])

    return {r.i: int(r.v) for r in df.mapInArrow(add, "i int, v decimal(38,0)").groupBy("i").agg(F.sum("v").alias("v")).collect()}


def products(y: np.ndarray) -> np.ndarray:
    """y'y exactly: in doubles where every sum stays below 2**53, else in Python's integers."""
    size = int(np.abs(y).max(initial=0))
    if size * size * len(y) < 2**53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T @ o


def covariance(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """(n, S, V): vectors are centred at the whole number next to the mean before they are multiplied.

    What is left of the mean comes off the exact sums, so that V is rounded only once.
    """
    sums = exact_sums(fit, lambda c: np.append(unpacked(c, d).astype(object).sum(0), len(c)))
    n, s = sums[d], [sums[i] for i in range(d)]
    centre = np.array([(2 * v + n) // (2 * n) for v in s], np.int64)
    upper = np.triu_indices(d)
    cells = exact_sums(fit, lambda c: products(unpacked(c, d) - centre)[upper])
    rest = [v - n * int(c) for v, c in zip(s, centre, strict=True)]
    v = np.zeros((d, d))
    for k, (i, j) in enumerate(zip(*upper, strict=True)):
        v[i, j] = v[j, i] = (n * cells[k] - rest[i] * rest[j]) / (n * n)
    return n, s, v


def eigenvalues_above(v: np.ndarray, shift: float) -> int:
    """How many eigenvalues of v exceed the shift: the positive pivots of LDL' of v minus it."""
    m = v - shift * np.eye(len(v))
    positive = 0
    while len(m):
        diagonal, beside = np.abs(np.diag(m)), np.abs(m - np.diag(np.diag(m)))
        k, wide = int(diagonal.argmax()), beside.max(initial=0.0)
        if diagonal[k] == 0 and wide == 0:
            break
        if diagonal[k] >= PIVOT * wide:
            positive += m[k, k] > 0
            keep = np.delete(np.arange(len(m)), k)
            c = m[keep, k]
            m = m[np.ix_(keep, keep)] - np.outer(c, c / m[k, k])
        else:  # a pivot of two rows has one eigenvalue of either sign
            positive += 1
            pair = list(np.unravel_index(beside.argmax(), beside.shape))
            keep = np.delete(np.arange(len(m)), pair)
            c = m[np.ix_(keep, pair)]
            m = m[np.ix_(keep, keep)] - c @ np.linalg.solve(m[np.ix_(pair, pair)], c.T)
        m = (m + m.T) / 2
    return positive


def without(x: np.ndarray, found: list[np.ndarray]) -> np.ndarray:
    """x less its share of the vectors found, twice over, and of length one."""
    for _ in range(2):
        for q in found:
            x = x - (q @ x) * q
    return x / np.linalg.norm(x)


def rayleigh(v: np.ndarray, shift: float, found: list[np.ndarray], start: np.ndarray) -> tuple[float, np.ndarray]:
    """Inverse iteration at the shift, then Rayleigh quotient iteration, beside the vectors found."""
    x, tiny = without(start, found), np.finfo(float).eps * np.abs(v).max()

    def step(x: np.ndarray, at: float) -> np.ndarray:
        m = v - at * np.eye(len(v))
        try:
            y = np.linalg.solve(m, x)
        except np.linalg.LinAlgError:
            y = np.linalg.solve(m + tiny * np.eye(len(v)), x)
        return without(y, found)

    for _ in range(3):
        x = step(x, shift)
    value = float(x @ v @ x)
    for _ in range(20):
        x = step(x, value)
        before, value = value, float(x @ v @ x)
        if abs(value - before) <= tiny:
            break
    return value, x


def leading_components(v: np.ndarray, most: int = COMPONENTS) -> list[tuple[float, np.ndarray]]:
    """The largest eigenvalues that are more than rounding, falling, each with its unit vector.

    Raises if the counts beside a value found do not give it its number.
    """
    size = float(np.abs(v).sum(1).max(initial=0.0))  # no eigenvalue is larger
    noise = 8 * len(v) * np.finfo(float).eps * size
    wanted = min(most, eigenvalues_above(v, noise)) if size else 0
    rnd, found = np.random.default_rng(12), []
    for k in range(1, wanted + 1):
        lo, hi, above_lo, above_hi = noise, size * (1 + 1e-9), len(v), 0
        while True:
            apart = above_lo == k and above_hi == k - 1
            near = hi - lo <= noise  # several eigenvalues that no count can part
            if near or (apart and hi - lo <= 0.05 * hi):
                value, x = rayleigh(v, (lo + hi) / 2, [q for _, q in found], rnd.standard_normal(len(v)))
                if near or lo <= value <= hi:
                    break
            shift = (lo + hi) / 2
            count = eigenvalues_above(v, shift)
            if count >= k:
                lo, above_lo = shift, count
            else:
                hi, above_hi = shift, count
        margin = noise + 2 * float(np.linalg.norm(v @ x - value * x))
        if eigenvalues_above(v, value - margin) < k or eigenvalues_above(v, value + margin) >= k:
            raise ArithmeticError(f"eigenvalue {k} is not certified")
        found.append((value, x))
    return found


def identity_error(fit: DataFrame, d: int, n: int, mean: np.ndarray, weights: np.ndarray) -> float:
    """The largest entry of the whitened fit list's covariance minus the identity."""
    k = weights.shape[1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, k))
        for batch in batches:
            z = (unpacked(batch.column("x"), d) - mean) @ weights
            total += z.T @ z
        yield pa.RecordBatch.from_arrays([pa.array(range(k * k), pa.int32()), pa.array(total.ravel())], ["i", "v"])

    sums = {r.i: r.v for r in fit.mapInArrow(add, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return float(np.abs(np.array([sums[i] for i in range(k * k)]).reshape(k, k) / n - np.eye(k)).max())


def deviations(x: np.ndarray, n: int, s: list[int]) -> pa.Array:
    """Sum over the dimensions of (n x - S)**2, exactly; null beyond a long."""
    reach = n * int(np.abs(x).max(initial=0)) + max(map(abs, s))
    if reach * reach * len(s) < 2**63:
        y = n * x - np.array(s, np.int64)
        return pa.array((y * y).sum(1))
    y = n * x.astype(object) - np.array(s, object)
    return pa.array([v if v < 2**63 else None for v in (y * y).sum(1)], pa.int64())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each usable vector and leading component."""
    spark = vectors.sparkSession
    vectors = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("embedding"))
    fit = materialise(fit_list(vectors))
    common = fit.where("d > 0").groupBy("d").count().orderBy(F.desc("count"), "d").head()
    if common is None:
        return spark.createDataFrame([], RESULT)
    d = common.d
    fit = fit.where(F.col("d") == d)
    n, s, v = covariance(fit, d)
    found = leading_components(v, components)
    if not found:
        return spark.createDataFrame([], RESULT)
    mean = np.array([x / n for x in s])
    weights = np.stack([x / value**0.5 for value, x in found], 1)
    explained, error = np.array([value for value, _ in found]) / np.trace(v), identity_error(fit, d, n, mean, weights)
    k = len(found)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in as_matrices(batch):
                if x.shape[1] != d:
                    continue
                each = np.repeat(np.arange(len(rows)), k)
                z = ((x - mean) @ weights).ravel()
                m = len(each)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(rows[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(m, n)), deviations(x, n, s).take(pa.array(each)), pa.array(z), pa.array(np.tile(explained, len(rows))), pa.array(np.full(m, error))],
                    [c.split()[0] for c in RESULT.split(", ")],
                )

    return vectors.mapInArrow(project, RESULT)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op12_whitening": op12_whitening}
ORACLE_SQL: dict[str, str] = {}
