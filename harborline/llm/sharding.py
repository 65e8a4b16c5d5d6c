"""Operator 6, sharding by a two-pass external shuffle (DataFrame operations only).

Pass 1 scatters the records into buckets that fit in memory, by a seeded hash
of the record: one exchange, in which the bucket number is the partition.
Pass 2 Fisher-Yates-shuffles each bucket (``shuffle`` with a seed; the bucket
is put into a fixed order first, so the outcome depends on the seed and the
rows alone and a lost executor's bucket comes out the same again).  The buckets
one after the other are the global order; dealing it out in turn gives shards
whose row counts differ by one at most (law ``rows``), and slots without gaps.

Buckets are counted before texts move, by a scan of their own, so the texts are
exchanged and sorted once.  Only these counts are summed across buckets: a
prefix sum in two levels, over blocks of BLOCK buckets and then over the blocks.

Rows that are equal in every column are interchangeable.  Where there are more
than ALIKE of them, they are dealt over as many buckets as they fill, by their
place in the scan; docs must therefore be a scan (files, a written table), whose
partitions come out the same again when a task is repeated.

Defined results: a null text has size 1 and crc32 0; a null id is a record as
any other; very long texts are rows as any other; an empty table gives an empty
result.  Columns of the input whose
names clash with the result's are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table, total_bytes

BUCKET_BYTES = 8 << 20
BLOCK = 1024
#: So many rows that are equal in every column share a bucket at most.
ALIKE = 100_000
#: So many buckets' starting positions (16 bytes each) are broadcast at most; beyond, they are joined by a shuffle.
BROADCAST_BUCKETS = 200_000


def scattered(docs: DataFrame, buckets: int, seed: int) -> DataFrame:
    """Every row as a struct ``_row``, its seeded hash ``_mix`` and its bucket ``_bucket``."""
    mixed = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith("map")])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), mixed.alias("_mix"))
    alike = rows.groupBy("_mix").count().where(F.col("count") > ALIKE)
    alike = alike.select("_mix", F.ceil(F.col("count") / ALIKE).alias("_parts"))
    if buckets <= BROADCAST_BUCKETS:  # and so alike has few rows, too: each stands for ALIKE
        alike = F.broadcast(alike)
    rows = rows.withColumn("_at", F.monotonically_increasing_id()).join(alike, "_mix", "left")
    salt = F.when(F.col("_parts").isNotNull(), F.pmod(F.xxhash64("_at"), F.col("_parts"))).otherwise(0)
    mix = F.when(salt == 0, F.col("_mix")).otherwise(F.xxhash64("_mix", salt))
    return rows.select("_row", "_mix", F.pmod(F.shiftrightunsigned(mix, 20), F.lit(buckets)).cast("int").alias("_bucket"))


def external_shuffle(docs: DataFrame, bucket_bytes: int = BUCKET_BYTES, seed: int = 42, text_col: str = "text", columns: list[str] | None = None) -> DataFrame:
    """docs in a uniformly random order: its columns and ``_position``, gapless from 0."""
    buckets = max(1, math.ceil(total_bytes(docs, text_col) / bucket_bytes))
    if columns is not None:
        docs = docs.select(*columns)
    rows = scattered(docs, buckets, seed)
    # pass 1: one exchange, partition by partition a bucket; pass 2 needs no other
    packed = rows.repartitionById(buckets, "_bucket").groupBy("_bucket").agg(F.collect_list(F.struct("_mix", "_row")).alias("_rows"))
    packed = packed.withColumn("_rows", F.shuffle(F.array_sort("_rows"), seed))
    counts = rows.groupBy("_bucket").agg(F.count("*").alias("_n")).withColumn("_block", F.expr(f"_bucket div {BLOCK}"))
    blocks = counts.groupBy("_block").agg(F.sum("_n").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("_block", F.coalesce(before, F.lit(0)).alias("_base"))
    within = F.sum("_n").over(Window.partitionBy("_block").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_block", "_bucket", F.coalesce(within, F.lit(0)).alias("_within")).join(blocks, "_block")
    starts = starts.select("_bucket", (F.col("_base") + F.col("_within")).alias("_start"))
    if buckets <= BROADCAST_BUCKETS:  # else the packed rows would be shuffled again
        starts = F.broadcast(starts)
    out = packed.join(starts, "_bucket").select("_start", F.posexplode("_rows").alias("_at", "_each"))
    return out.select("_each._row.*", (F.col("_start") + F.col("_at")).alias("_position"))


def deal(shuffled: DataFrame, shards: int) -> DataFrame:
    """Adds ``_shard`` and ``_slot``: the global order dealt out in turn."""
    p: Column = F.col("_position")
    return shuffled.withColumns({"_shard": F.pmod(p, F.lit(shards)).cast("int"), "_slot": F.floor(p / shards).cast("long")})


def write_shards(docs: DataFrame, path: str, shards: int = 8, seed: int = 42, text_col: str = "text") -> None:
    """The operator's files: one folder per shard, rows in slot order."""
    out = deal(external_shuffle(docs, seed=seed, text_col=text_col), shards)
    out.repartition(shards, "_shard").sortWithinPartitions("_shard", "_slot").write.mode("overwrite").partitionBy("_shard").parquet(path)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = deal(external_shuffle(docs.select("doc_id", "text")), 8)
    text = F.coalesce("text", F.lit(""))
    return out.select(
        "doc_id",
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("_shard").alias("shard"),
        F.col("_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


QUERIES = {"op6_sharding": op6_sharding}
ORACLE_SQL: dict[str, str] = {}
