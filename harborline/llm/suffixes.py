"""Operator 10, substring dedup on a sparse suffix array.

A byte goes if some WINDOW-byte string that covers it starts anywhere else too.

1.  Anchors.  Of every window the GRAM-byte string with the smallest hash is
    its anchor; equal windows have equal anchors at equal offsets.  Anchors
    whose gram occurs once are dropped, and with them their windows.
2.  Suffixes.  What is sorted is the suffix at each remaining anchor, as far as
    its windows reach, with the bytes before it as its reversed prefix.  Spark's
    sampled splitters range-partition the suffixes into MOST_RANGES ranges at
    most, so that the sample at the driver is bounded.  A range is sorted by Spark and read in buckets of BUCKET_BYTES, however large
    it is; a bucket sorts its suffixes and its prefixes by multikey quicksort and
    takes the common lengths of neighbours.  A window at offset o before its
    anchor has an equal if another anchor shares W - o bytes of suffix and o
    bytes of prefix: classes of both orders, met.
3.  Boundaries.  A class that touches the edge of a bucket may go on in the
    next.  Its windows without an equal, and one witness of those with, are dealt
    anew by their prefixes, where classes are small that were large; what touches
    an edge there as well is compared window by window over a hash.

Equal contexts inside one scan part are settled there and send one witness,
and buckets are bounded whatever a range holds: no passage is too frequent for
a task.

Defined results: null and empty texts have no bytes; texts shorter than WINDOW
stay whole; very long texts are read to their end; a text that another row holds
too goes as a whole; rows without an id lose nothing and count for nothing; rows
that repeat an id are texts of their own, known by their id and a hash of the
text (rows equal in both are each other's copies); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, materialise, mix, repeated, rolling, sliding_argmin, table, text_bytes, text_parts, total_bytes

WINDOW, GRAM = 400, 48
SHARD_BYTES, PART_BYTES = 12 << 20, 1 << 20
#: Bytes of context that a range is meant to have, and that a bucket gets: what a task holds at a time.
RANGE_BYTES, BUCKET_BYTES = 4 << 20, 2 << 20
#: Ranges at most, for each of which the driver sees 100 sampled keys of WINDOW bytes or less: 80 MB.
MOST_RANGES = 2048
#: Parts that a group of equal texts is dealt in.
COPY_PARTS = 256
#: Sets of strings up to this size are sorted whole.
SMALL = 48

SIGNS = mix(np.arange(1, 257))


#: What a row is known by: its id and a hash of its text.
ROW = ["doc_id", "h"]


def dealt_by_row(docs: DataFrame) -> DataFrame:
    """(doc_id, h, text) hash-partitioned by row into partitions of SHARD_BYTES."""
    return docs.select("doc_id", F.xxhash64("text").alias("h"), "text").repartition(max(1, math.ceil(total_bytes(docs) / SHARD_BYTES)), *ROW)


def attach(docs: DataFrame, other: DataFrame) -> DataFrame:
    """Left join by row that builds on the small side, so texts need no sort."""
    return docs.join(other.hint("shuffle_hash"), ROW, "left")


def usable(part: pa.RecordBatch) -> pa.RecordBatch:
    """Rows with an id that are no later copies."""
    keep = part.column("doc_id").is_valid()
    if "copy" in part.schema.names:
        keep = pa.compute.and_(keep, part.column("copy").is_null())
    return part.filter(keep)


def witness_rows(keys: np.ndarray, known: np.ndarray, salt: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys, known): rows already settled get a key of their own that meets no other."""
    return np.where(known, mix(salt ^ np.uint64(0xA5A5A5A5A5A5A5A5)), keys), known


def twins(docs: DataFrame) -> DataFrame:
    """(doc_id, h, twin, copy): rows whose whole text another row has; copy is null for the smallest id.

    A group of equal texts is counted and joined in COPY_PARTS parts by its ids,
    so that no task gets more of a large group than a part, or a row for each part.
    """
    keyed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("h"), F.unhex(F.sha2("text", 256)).alias("sha"))
    rows = keyed.groupBy(*ROW, "sha").agg(F.count("*").alias("n")).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.lit(COPY_PARTS)))
    parts = rows.groupBy("sha", "part").agg(F.min("doc_id").alias("first_id"), F.sum("n").alias("n"))
    groups = parts.groupBy("sha").agg(F.min("first_id").alias("first_id"), F.sum("n").alias("n")).where("n > 1").drop("n")
    of = parts.select("sha", "part").join(groups, "sha")
    return rows.join(of, ["sha", "part"]).select(*ROW, F.lit(True).alias("twin"), F.when(F.col("doc_id") > F.col("first_id"), True).alias("copy"))


def anchors(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, anchor) of every window inside a text, and the hashes of all grams."""
    h = mix(rolling(SIGNS[data], GRAM))
    low = sliding_argmin(h, WINDOW - GRAM + 1)
    inside = np.zeros(len(low) + 1, np.int32)
    lens = np.diff(off)
    long = np.flatnonzero(lens >= WINDOW)
    inside[off[long]] += 1
    np.add.at(inside, off[long] + lens[long] - WINDOW + 1, -1)
    starts = np.flatnonzero(np.cumsum(inside[:-1]))
    return starts, low[starts], h


def settled_anchors(found: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Anchors of a shard: those whose gram the shard has twice are known and keep to themselves, but send one witness of it."""
    keys, ids, marks, positions = (np.concatenate(c) for c in zip(*found, strict=True))
    known = repeated(keys)
    _, witness = np.unique(keys, return_index=True)
    witness = witness[known[witness]]
    salted, flags = witness_rows(keys, known, mix(ids.astype(np.uint64)) ^ positions.astype(np.uint64))
    none, zero = np.repeat([False, True], [len(ids), len(witness)]), np.zeros(len(witness), np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.concatenate([salted, keys[witness]]).view(np.int64)), *(pa.array(np.concatenate([x, zero]), mask=none) for x in (ids, marks)), pa.array(np.concatenate([positions, zero])), pa.array(np.concatenate([flags, np.zeros(len(witness), bool)]))],
        ["key", *ROW, "position", "known"],
    )


def find_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found, size = [], 0
    for whole in text_parts(batches, PART_BYTES):
        part = usable(whole)
        data, off = text_bytes(part.column("text"))
        _, at, h = anchors(data, off)
        at = np.unique(at)
        row = np.searchsorted(off, at, "right") - 1
        found.append((h[at], *(part.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[row] for c in ROW), at - off[row]))
        size += len(data)
        if size >= SHARD_BYTES:
            yield settled_anchors(found)
            found, size = [], 0
    if found:
        yield settled_anchors(found)


def shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows in the order of their keys, those whose key a neighbour has too, or that are known; one row is held back at a time."""
    held, like = None, False
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = batch if held is None else pa.concat_batches([held, batch])
        key = rows.column("key").to_numpy()
        same = key[1:] == key[:-1]
        before = np.concatenate([[like], same])
        keep = (before | np.append(same, False))[:-1] | rows.column("known").to_numpy(zero_copy_only=False)[:-1]
        yield rows.slice(0, len(key) - 1).filter(pa.array(keep))
        held, like = rows.slice(len(key) - 1), bool(before[-1])
    if held is not None:
        yield held.filter(pa.compute.or_(held.column("known"), pa.scalar(like)))


def recurring_anchors(docs: DataFrame) -> DataFrame:
    """(doc_id, h, positions): anchors whose gram occurs twice or more.

    A shard sends a gram once, however often it has it, and rows pass one by one
    in the order of their grams: no group of equal ones is held, and the most
    frequent gram is a row for each shard.
    """
    found = docs.mapInArrow(find_anchors, schema := "key long, doc_id long, h long, position long, known boolean")
    there = found.repartition("key").sortWithinPartitions("key").mapInArrow(shared_keys, schema).where("doc_id IS NOT NULL")
    return there.groupBy(*ROW).agg(F.collect_list("position").alias("positions"))


#: kind 0: windows settled as repeated, at offsets o_from..o_to before the position.  kind 1: a context to look into.
CONTEXT = "kind int, doc_id long, h long, position long, o_from int, o_to int, many boolean, prefix binary, suffix binary"
NAMES = [x.split()[0] for x in CONTEXT.split(", ")]


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.binary(), pa.binary()]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(types)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], NAMES)


def find_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in text_parts(batches, PART_BYTES):
        part = usable(whole)
        part = part.filter(part.column("positions").is_valid())
        data, off = text_bytes(part.column("text"))
        starts, at, _ = anchors(data, off)
        wanted = np.concatenate([np.zeros(0, np.int64), *[off[i] + np.array(p) for i, p in enumerate(part.column("positions").to_pylist())]])
        edge = np.concatenate([[True], (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)]) if len(at) else np.zeros(0, bool)
        first = np.flatnonzero(edge)
        last = np.append(first[1:], len(at)) - 1
        use = np.isin(at[first], wanted)
        first, last = first[use], last[use]
        row = np.searchsorted(off, at[first], "right") - 1
        who = list(zip(*(part.column(c).to_pylist() for c in ROW), strict=True))
        raw, seen = data.tobytes(), {}
        for r, a, lo, hi in zip(row.tolist(), at[first].tolist(), starts[first].tolist(), starts[last].tolist(), strict=True):
            seen.setdefault((raw[lo:a][::-1], raw[a : hi + WINDOW]), []).append((who[r], a - int(off[r]), a - hi, a - lo))
        rows = []
        for (prefix, suffix), own in seen.items():
            if len(own) > 1:
                rows += [(0, *i, p, o1, o2, False, None, None) for i, p, o1, o2 in own]
            i, p, o1, o2 = own[0]
            rows.append((1, *((None, None) if len(own) > 1 else i), p, o1, o2, len(own) > 1, prefix, suffix))
        yield _batch(rows)


def matrix(strings: list[bytes], width: int) -> np.ndarray:
    """Strings as rows of bytes, filled up with zeros."""
    return np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]), np.uint8).reshape(-1, width)


def multikey_order(rows: np.ndarray) -> np.ndarray:
    """Order of equally long byte strings, by multikey quicksort: eight bytes are a character.

    A set is parted three ways by one character of a pivot; what is equal there
    goes on with the next character.
    """
    chars = np.ascontiguousarray(rows).view(">u8").astype(np.uint64)
    width, done, stack = chars.shape[1], [], [(np.arange(len(rows)), 0)]
    while stack:
        at, depth = stack.pop()
        if len(at) <= SMALL or depth == width:
            done.append(at[np.lexsort(chars[at, depth:].T[::-1])] if depth < width else at)
            continue
        c = chars[at, depth]
        pivot = np.partition(c, len(c) // 2)[len(c) // 2]
        parts = (at[c > pivot], depth), (at[c == pivot], depth + 1), (at[c < pivot], depth)
        stack += [p for p in parts if len(p[0])]
    return np.concatenate(done) if done else np.zeros(0, np.int64)


def neighbours(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Common prefix lengths of neighbours in sorted order."""
    out = np.zeros(max(len(order) - 1, 0), np.int32)
    for i in range(0, len(out), 4096):
        differ = rows[order[i : i + 4096][: len(out) - i]] != rows[order[i + 1 : i + 4097]]
        out[i : i + 4096] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


def edge_depth(order: np.ndarray, common: np.ndarray) -> np.ndarray:
    """How many first bytes each string shares with the first or the last in sorted order."""
    whole = np.array([1 << 30], np.int64)
    first = np.minimum.accumulate(np.concatenate([whole, common]))
    last = np.minimum.accumulate(np.concatenate([whole, common[::-1]]))[::-1]
    out = np.empty(len(order), np.int64)
    out[order] = np.maximum(first, last)
    return out


def in_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows in the order they come, cut into buckets."""
    rows, size = [], 0
    for batch in batches:
        for row in zip(*[batch.column(n).to_pylist() for n in NAMES], strict=True):
            rows.append(row)
            size += len(row[7]) + len(row[8])
            if size >= BUCKET_BYTES:
                yield rows
                rows, size = [], 0
    if rows:
        yield rows


def resolve(by_suffix: bool, last: bool = False) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The map over sorted ranges of suffixes (or of prefixes)."""

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in in_buckets(batches):
            yield from settle_bucket(rows)

    def settle_bucket(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        m = len(rows)
        wide = -(-WINDOW // 8) * 8
        prefixes, suffixes = matrix([r[7] for r in rows], wide), matrix([r[8] for r in rows], wide)
        sides = []
        for side in (prefixes, suffixes):
            order = multikey_order(side)
            sides.append((order, neighbours(side, order)))
        depth = edge_depth(*sides[1 if by_suffix else 0])
        o_from, o_to = np.array([r[4] for r in rows]), np.array([r[5] for r in rows])
        weight = np.array([2 if r[6] else 1 for r in rows])
        out: list[tuple] = []
        hits, opens = [], []
        for o in range(int(o_from.min()), int(o_to.max()) + 1):
            active = np.flatnonzero((o_from <= o) & (o <= o_to))
            if not len(active):
                continue
            classes = []
            for (order, common), need in zip(sides, (o, WINDOW - o), strict=True):
                c = np.concatenate([[0], np.cumsum(common < need)])
                of = np.empty(m, np.int64)
                of[order] = c
                classes.append(of)
            key = classes[0][active] * m + classes[1][active]
            s = np.argsort(key, kind="stable")
            cut = np.flatnonzero(np.concatenate([[True], key[s][1:] != key[s][:-1]]))
            total = np.add.reduceat(weight[active][s], cut)
            dup = np.zeros(len(active), bool)
            dup[s] = np.repeat(total > 1, np.diff(np.append(cut, len(s))))
            at_edge = depth[active] >= (WINDOW - o if by_suffix else o)
            witness = np.zeros(len(active), bool)
            witness[s[cut]] = True
            hits.append((active[dup], o))
            opens.append((active[at_edge & (~dup | witness)], o, dup[at_edge & (~dup | witness)]))
        found: dict[int, list[int]] = {}
        for at, o in hits:
            for i in at.tolist():
                if rows[i][1] is not None:
                    found.setdefault(i, []).append(o)
        for i, os in found.items():
            runs = np.split(np.array(os), np.flatnonzero(np.diff(os) > 1) + 1)
            out += [(0, *rows[i][1:4], int(r[0]), int(r[-1]), False, None, None) for r in runs]
        pending: dict[int, tuple[int, int, bool]] = {}
        for at, o, dup in opens:
            for i, d in zip(at.tolist(), dup.tolist(), strict=True):
                if last:  # one row per window: its text is what is compared
                    window = rows[i][7][:o][::-1] + rows[i][8][: WINDOW - o]
                    settled = d or rows[i][6]
                    out.append((2, *((None, None) if settled else rows[i][1:3]), rows[i][3], o, o, settled, hashlib.md5(window).digest(), None))
                else:
                    a, b, all_dup = pending.get(i, (o, o, True))
                    pending[i] = (min(a, o), max(b, o), all_dup and d)
        out += [(1, *rows[i][1:4], a, b, *rows[i][6:]) for i, (a, b, _) in pending.items()]
        for i in range(0, len(out), 20_000):
            yield _batch(out[i : i + 20_000])

    return settle


def ranges(contexts: DataFrame, side: str) -> DataFrame:
    """contexts in order of one side; ties, which may be many, by id."""
    size = contexts.select(F.sum(F.length("prefix") + F.length("suffix"))).head()[0] or 0
    n = min(max(1, math.ceil(size / RANGE_BYTES)), MOST_RANGES)
    return contexts.repartitionByRange(n, side, *ROW, "position").sortWithinPartitions(side)


def repeated_windows(docs: DataFrame) -> DataFrame:
    """(doc_id, h, spans): runs of window starts, both ends included, that recur."""
    contexts = materialise(attach(docs, recurring_anchors(docs)).mapInArrow(find_contexts, CONTEXT))
    by_suffix = materialise(ranges(contexts.where("kind = 1"), "suffix").mapInArrow(resolve(True), CONTEXT))
    by_prefix = materialise(ranges(by_suffix.where("kind = 1"), "prefix").mapInArrow(resolve(False, last=True), CONTEXT))
    edges = by_prefix.where("kind = 2")
    twice = edges.groupBy("prefix").agg(F.sum(F.when(F.col("many"), 2).otherwise(1)).alias("n")).where("n > 1").select("prefix")
    edges = edges.where("doc_id IS NOT NULL").join(twice, "prefix", "left_semi")
    done = [x.where("kind = 0") for x in (contexts, by_suffix, by_prefix)] + [edges]
    spans = [x.where("doc_id IS NOT NULL").select(*ROW, F.struct((F.col("position") - F.col("o_to")).alias("from"), (F.col("position") - F.col("o_from")).alias("to")).alias("span")) for x in done]
    every = spans[0].union(spans[1]).union(spans[2]).union(spans[3])
    return every.groupBy(*ROW).agg(F.collect_set("span").alias("spans"))


def cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        spans, alike = batch.column("spans"), batch.column("twin")
        for i, text in enumerate(batch.column("text").to_pylist()):
            raw = (text or "").encode()
            gone = np.zeros(len(raw) + 1, np.int32)
            if alike[i].is_valid:
                if len(raw) >= WINDOW:
                    gone[0], gone[-1] = 1, -1
            elif spans[i].is_valid:
                own = spans[i].values
                np.add.at(gone, own.field("from").to_numpy(), 1)
                np.add.at(gone, own.field("to").to_numpy() + WINDOW, -1)
            mask = np.cumsum(gone[:-1]) > 0
            runs = int(np.count_nonzero(mask & ~np.concatenate([[False], mask[:-1]])))
            kept = np.frombuffer(raw, np.uint8)[~mask].tobytes()
            out.append((len(raw), int(mask.sum()), runs, hashlib.sha256(kept).hexdigest(), kept))
        columns = list(zip(*out, strict=True)) if out else [()] * 5
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept): texts without their repeated byte strings."""
    docs = id_and_text(docs, id_col, text_col)
    dealt = attach(dealt_by_row(docs), materialise(twins(docs)))
    out = attach(dealt, repeated_windows(dealt))
    return out.mapInArrow(cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op10_suffixes": op10_suffixes}
ORACLE_SQL: dict[str, str] = {}
