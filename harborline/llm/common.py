"""What several operators share: reading columns, word boundaries, hashing.

Texts are handled as Arrow batches: the UTF-8 bytes of all texts of a batch lie
in one numpy array, and words, lines and windows are index ranges in it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: An odd multiplier: rolling hashes are polynomials in it, modulo 2**64.
BASE = 0x9E3779B97F4A7C15
MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just the two columns that most operators need, under fixed names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only in local mode (a laptop, the tests) may that be unset: a folder below
    the warehouse is used instead.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = spark.conf.get("spark.sql.warehouse.dir") + "/_stages"
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = shared_dir(spark)
    # zstd: smaller files, and no direct buffers that grow with the pages as with the default codec
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def total_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return int(docs.select(F.sum(F.octet_length(text_col).cast("long"))).head()[0] or 0)


def text_parts(batches: Iterator[pa.RecordBatch], max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that each part has at most max_bytes of text (or a single longer row)."""
    for batch in batches:
        offsets = text_offsets(batch.column("text"))
        at, n = 0, batch.num_rows
        while at < n:
            end = int(np.searchsorted(offsets, offsets[at] + max_bytes, "right")) - 1
            end = min(max(end, at + 1), n)
            yield batch.slice(at, end - at)
            at = end


def text_offsets(texts: pa.Array) -> np.ndarray:
    if pa.types.is_large_string(texts.type):
        off = np.frombuffer(texts.buffers()[1], np.int64)
    else:
        off = np.frombuffer(texts.buffers()[1], np.int32)
    return off[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes, offsets of the texts in them); a null text has no bytes."""
    texts = texts.fill_null("")
    off = text_offsets(texts)
    buf = texts.buffers()[2]
    data = np.frombuffer(buf, np.uint8)[off[0] : off[-1]] if buf is not None else np.zeros(0, np.uint8)
    return data, off - off[0]


class Words:
    """The words (runs of bytes other than 0x20 and 0x09-0x0D) of the texts of a batch.

    start, end: where each word lies in data; doc: the row it belongs to;
    first: for each row the index of its first word, with the total at the end.
    """

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        inside = ~((data == 0x20) | ((data >= 9) & (data <= 13)))
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        cuts = off[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        opens[cuts] = inside[cuts]
        closes[cuts - 1] = inside[cuts - 1]
        self.inside = inside
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.first = np.searchsorted(self.start, off)
        self.counts = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.counts)

    def encoded(self, lower: bool = False) -> tuple[np.ndarray, pa.Array]:
        """(a number per word, the distinct words): equal words have equal numbers."""
        data = self.data[self.inside]
        if lower:
            data = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
        lens = self.end - self.start
        off = np.zeros(len(lens) + 1, np.int64)
        np.cumsum(lens, out=off[1:])
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data))])
        coded = words.dictionary_encode()
        return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def word_hashes(distinct: pa.Array) -> np.ndarray:
    """XXH64 of each distinct word, unsigned."""
    import xxhash

    f = xxhash.xxh64_intdigest
    return np.fromiter(map(f, distinct.to_pylist()), np.uint64, len(distinct))


def rolling(values: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every n consecutive values, by doubling; len(values) - n + 1 of them."""
    if len(values) < n:
        return np.zeros(0, np.uint64)
    out, have = None, 0
    block, size = values.astype(np.uint64, copy=False), 1
    while True:
        if n & size:
            if out is None:
                out, have = block, size
            else:  # what is held covers the first `have` values, block the next `size`
                m = len(values) - have - size + 1
                out = out[:m] * np.uint64(pow(BASE, size, 1 << 64)) + block[have : have + m]
                have += size
        if have == n:
            return out[: len(values) - n + 1]
        m = len(values) - 2 * size + 1
        block = block[:m] * np.uint64(pow(BASE, size, 1 << 64)) + block[size : size + m]
        size *= 2


def sliding_argmin(keys: np.ndarray, w: int) -> np.ndarray:
    """Index of the leftmost smallest key in every w consecutive keys; len(keys) - w + 1 of them.

    A key keeps its leading bits and carries its index in the others, so ties
    go to the left.  Minima come from prefix and suffix minima of blocks of w:
    linear in len(keys), whatever w is.
    """
    n = len(keys)
    if n < w:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(20, int(n).bit_length()))
    k = (keys >> bits << bits) | np.arange(n, dtype=np.uint64)
    k = np.concatenate([k, np.full(-n % w, MASK, np.uint64)]).reshape(-1, w)
    pre = np.minimum.accumulate(k, axis=1).ravel()
    suf = np.minimum.accumulate(k[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(suf[: n - w + 1], pre[w - 1 : n])
    return (low & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)


def repeated(keys: np.ndarray) -> np.ndarray:
    """Which of the keys occur more than once."""
    s = np.sort(keys)
    twice = s[1:][s[1:] == s[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def covered(starts: np.ndarray, n: int, total: int) -> np.ndarray:
    """Which of `total` places lie in one of the runs of n that begin at starts."""
    d = np.zeros(total + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, starts + n, -1)
    return np.cumsum(d[:-1]) > 0


def per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of flags between consecutive offsets."""
    c = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=c[1:])
    return c[off[1:]] - c[off[:-1]]
