"""Operator 3, near-duplicates by SimHash and vantage-point trees.

Every document becomes a 64-bit fingerprint.  Equal fingerprints are collapsed
first.  The distinct ones are dealt to shards by a vantage-point tree whose
vantage points are seeded and whose radii come from a sample of fingerprints,
PER_SHARD of them for every shard that is wanted, MOST_SAMPLED at most: within a radius goes left, beyond it right, and what lies within
`radius` of the boundary goes to both sides, so that by the triangle inequality
any two fingerprints that may be linked meet in some shard.  A shard prunes
branches by the same bound in a tree of its own down to small leaves, where
distances are computed exactly.  A leaf yields a spanning star per local
component instead of all pairs; stars of all shards meet in a distributed
connected-components search.

Search cost: a split at the median leaves about 1.2 times the points in both
halves together for radius 2, so work grows as the number of distinct
fingerprints to the power of about 1.36.

Defined results: a null or wordless text has fingerprint 0 and is linked like
any other; a text shorter than a shingle is one shingle; rows with equal ids
and texts come out as often as they go in; an empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, materialise, mix, table, text_bytes, text_parts
from .components import connected_components

PART_BYTES = 2 << 20
#: Fingerprints that a shard is meant to get; leaves of its own tree.
SHARD, LEAF = 12_000, 256
#: Sampled fingerprints per shard wanted, and at least and at most: 32 MB, which is 10**10 distinct fingerprints of shards of this size.
PER_SHARD, LEAST_SAMPLED, MOST_SAMPLED = 400, 20_000, 4_000_000


def shingles(raw: bytes, size: int) -> list[bytes]:
    """Runs of `size` words of lower-cased text, joined by spaces; the whole if it is shorter."""
    words = raw.lower().split()
    if len(words) <= size:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    return [joined[a:b] for a, b in zip(starts[: len(words) - size + 1].tolist(), ends[size - 1 :].tolist(), strict=True)]


def majority(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Fingerprints of consecutive groups of hashes: a bit is set if it is in over half of them."""
    out = np.zeros(len(counts), np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8)).reshape(-1, 64)
        starts = (np.cumsum(counts) - counts)[full]
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * sums > counts[full, None], axis=1).view(">u8").ravel()
    return out


def fingerprints(docs: DataFrame, size: int = 3) -> DataFrame:
    """(doc_id, fp): fingerprints of all documents, as signed numbers."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in text_parts(batches, PART_BYTES):
            data, off = text_bytes(part.column("text"))
            raw, counts, hashes = data.tobytes(), [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                own = shingles(raw[a:b], size)
                counts.append(len(own))
                hashes += map(xxhash.xxh64_intdigest, own, repeat(42))
            fp = majority(np.array(hashes, np.uint64), np.array(counts, np.int64))
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp.view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(find, "doc_id long, fp long")


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


class VantageTree:
    """The upper tree: routes fingerprints to shards; neighbours within `radius` share one."""

    def __init__(self, sample: np.ndarray, total: int, radius: int, shard: int = SHARD):
        self.radius, self.nodes, self.shards = radius, [], 0
        self.shard, self.weight = shard, max(total, 1) / max(len(sample), 1)
        self._grow(sample, 1)

    def _grow(self, sample: np.ndarray, path: int) -> int:
        at = len(self.nodes)
        self.nodes.append(None)
        if len(sample) * self.weight > self.shard and len(sample) >= 32:
            best = None
            for k in range(6):
                vantage = mix(np.array([path * 64 + k], np.uint64))[0]
                d = distance(sample, vantage)
                mu = int(np.median(d)) - (np.median(d) == d.max())
                left, right = (d <= mu).sum(), (d > mu - self.radius).sum()
                if best is None or max(left, right) < best[0]:
                    best = max(left, right), vantage, mu, d
            size, vantage, mu, d = best
            if size < 0.9 * len(sample):
                self.nodes[at] = (vantage, mu, self._grow(sample[d <= mu], 2 * path), self._grow(sample[d > mu - self.radius], 2 * path + 1))
                return at
        self.nodes[at] = self.shards
        self.shards += 1
        return at

    def route(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index into fps, shard) of every place that a fingerprint goes to."""
        index, shard, stack = [], [], [(0, np.arange(len(fps)))]
        while stack:
            at, rows = stack.pop()
            node = self.nodes[at]
            if isinstance(node, int):
                index.append(rows)
                shard.append(np.full(len(rows), node))
                continue
            vantage, mu, left, right = node
            d = distance(fps[rows], vantage)
            stack += [(left, rows[d <= mu]), (right, rows[d > mu - self.radius])]
        return np.concatenate(index), np.concatenate(shard)


def leaf_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (member, smallest member's place) for each component of a few fingerprints."""
    near = distance(fps[:, None], fps[None, :]) <= radius
    label = np.arange(len(fps))
    while True:
        new = np.where(near, label[None, :], len(fps)).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(len(fps)))
    return member, label[member]


def blocked_links(fps: np.ndarray, radius: int, block: int = 1024) -> tuple[np.ndarray, np.ndarray]:
    """Links whose components are those of fingerprints that no vantage point parts.

    Block by block the smaller label wins, and a link joins it to the label it
    replaces: a few links per fingerprint, however many are near each other.
    """
    n = len(fps)
    label, a, b = np.arange(n), [], []

    def take(at: slice, new: np.ndarray) -> bool:
        lower = new < label[at]
        a.append(label[at][lower])
        b.append(new[lower])
        label[at] = np.where(lower, new, label[at])
        return bool(lower.any())

    for i in range(0, n, block):
        for j in range(i, n, block):
            x, y = slice(i, i + block), slice(j, j + block)
            near = distance(fps[x, None], fps[None, y]) <= radius
            while take(y, np.where(near, label[x][:, None], n).min(axis=0)) | take(x, np.where(near, label[y][None, :], n).min(axis=1)):
                pass
    return np.concatenate(a), np.concatenate(b)


def near_links(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (place, place) whose components are those of all pairs within radius."""
    a, b, stack, step = [], [], [np.arange(len(fps))], 0
    while stack:
        rows = stack.pop()
        if len(rows) < 2:
            continue
        if len(rows) <= LEAF:
            x, y = leaf_links(fps[rows], radius)
        else:
            for _ in range(8):
                step += 1
                # a random point parts spread-out sets, a member parts a tight one
                vantage = mix(np.array([step], np.uint64))[0] if step % 2 else fps[rows[step % len(rows)]]
                d = distance(fps[rows], vantage)
                mu = int(np.median(d))
                left, right = rows[d <= mu], rows[d > mu - radius]
                if max(len(left), len(right)) <= 0.85 * len(rows):
                    break
            else:
                x, y = blocked_links(fps[rows], radius)
                a.append(rows[x])
                b.append(rows[y])
                continue
            stack += [left, right]
            continue
        a.append(rows[x])
        b.append(rows[y])
    return (np.concatenate(a), np.concatenate(b)) if a else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def spanning(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place in each place's component."""
    root = list(range(n))
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
    for i in range(n):
        root[i] = root[root[i]]
    return np.array(root, np.int64)


def fingerprint_roots(distinct: DataFrame, radius: int, shard: int = SHARD) -> DataFrame:
    """(fp, root) for fingerprints that have a neighbour within radius; distinct has one column fp."""
    total = distinct.count()
    wanted = min(max(LEAST_SAMPLED, PER_SHARD * total // shard), MOST_SAMPLED)
    share = min(1.0, wanted / max(total, 1))
    taken = distinct.where(F.pmod(F.xxhash64("fp"), F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = taken.toPandas()["fp"].to_numpy().astype(np.int64).view(np.uint64)
    tree = VantageTree(sample, total, radius, shard)

    def route(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            fps = frame["fp"].to_numpy()
            index, where = tree.route(fps.view(np.uint64))
            yield pd.DataFrame({"shard": where.astype(np.int64), "fp": fps[index]})

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        fps = np.sort(frame["fp"].to_numpy())
        a, b = near_links(fps.view(np.uint64), radius)
        root = spanning(len(fps), a, b)
        linked = np.flatnonzero(root != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked], "b": fps[root[linked]]})

    routed = distinct.mapInPandas(route, "shard long, fp long")
    stars = routed.groupBy("shard").applyInPandas(search, "a long, b long")
    return connected_components(stars).select(F.col("node").alias("fp"), "root")


def components(prints: DataFrame, radius: int = 2, shard: int = SHARD) -> DataFrame:
    """(doc_id, fp, component_id) from (doc_id, fp)."""
    prints = materialise(prints)
    nodes = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = fingerprint_roots(nodes.select("fp"), radius, shard)
    nodes = nodes.join(roots, "fp", "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = nodes.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints.join(nodes.join(least, "root").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2, shard: int = SHARD) -> DataFrame:
    """(doc_id, fingerprint, component_id) of all documents."""
    out = components(fingerprints(id_and_text(docs, id_col, text_col), size), radius, shard)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


BANDS, TAKEN = 10, 3


def band_prints(docs: DataFrame, size: int = 5, bands: int = BANDS, taken: int = TAKEN) -> DataFrame:
    """(doc_id, sha, prints): SimHashes of small agreeing selections of each document's shingles.

    A fingerprint of a whole text moves by many bits while the texts are still
    very alike.  Band by band, the `taken` shingles that come first in that
    band's seeded order are fingerprinted by themselves: texts of Jaccard
    similarity s select the same ones with probability s ** taken.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        import xxhash

        for part in text_parts(batches, PART_BYTES):
            data, off = text_bytes(part.column("text"))
            raw, sha, prints = data.tobytes(), [], []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                own = set(shingles(raw[a:b], size))
                h = np.fromiter(map(xxhash.xxh64_intdigest, own, repeat(42)), np.uint64, len(own))
                sha.append(hashlib.sha256(raw[a:b]).digest())
                for k in range(bands):
                    salt = mix(np.array([k + 1], np.uint64))[0]
                    order = mix(h ^ salt)
                    first = np.sort(order)[:taken] if len(h) <= 64 else np.sort(np.partition(order, taken)[:taken])
                    prints.append(majority(first, np.array([len(first)]))[0] ^ salt)
            flat = pa.array(np.array(prints, np.uint64).view(np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * bands), flat)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sha, pa.binary()), lists], ["doc_id", "sha", "prints"])

    return docs.mapInArrow(find, "doc_id long, sha binary, prints array<long>")


def shingle_sets(docs: DataFrame, size: int) -> DataFrame:
    """(doc_id, shingles): the distinct shingles of each text as sorted 32-bit hashes."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for part in text_parts(batches, PART_BYTES):
            data, off = text_bytes(part.column("text"))
            raw, out = data.tobytes(), []
            for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                own = set(shingles(raw[a:b], size))
                out.append(np.unique(np.fromiter(map(xxhash.xxh32_intdigest, own), np.uint32, len(own))).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.binary())], ["doc_id", "shingles"])

    return docs.mapInArrow(find, "doc_id long, shingles binary")


def _similar(least: float):  # noqa: ANN202
    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                u, v = np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32)
                both = len(np.intersect1d(u, v, assume_unique=True))
                keep.append(both >= least * (len(u) + len(v) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return test


def prefixes(sets: DataFrame, similarity: float, common: np.ndarray) -> DataFrame:
    """(doc_id, comp, n, place, short, shingle): the shingles by which similar sets must meet.

    Sets are put in one order: shingles outside `common` by their hash, then
    those in it, the most frequent last.  If the smaller of two sets has n
    shingles and the Jaccard similarity is s or more, one of its first
    n - 2s/(1+s) n + 1 (`short`) is among the first m - sm + 1 of the larger.
    Any order gives all pairs; this one keeps frequent shingles out of the way.
    """
    sought = np.sort(common)
    rank = np.argsort(common)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, place, short, n, values = [], [], [], [], []
            for i, raw in enumerate(batch.column("shingles").to_pylist()):
                own = np.frombuffer(raw, np.uint32)
                if not len(own):
                    continue
                late = np.zeros(len(own), np.int64)
                if len(sought):
                    k = np.minimum(np.searchsorted(sought, own), len(sought) - 1)
                    late = np.where(sought[k] == own, len(sought) - rank[k], 0)
                take = len(own) - int(np.ceil(similarity * len(own) - 1e-9)) + 1
                less = len(own) - int(np.ceil(2 * similarity / (1 + similarity) * len(own) - 1e-9)) + 1
                values.append(own[np.lexsort((own, late))[:take]].astype(np.int64))
                rows.append(np.full(len(values[-1]), i))
                place.append(np.arange(len(values[-1])))
                short.append(place[-1] < less)
                n.append(np.full(len(values[-1]), len(own)))
            if rows:
                ids = batch.select(["doc_id", "comp"]).take(pa.array(np.concatenate(rows)))
                columns = [np.concatenate(n).astype(np.int32), np.concatenate(place).astype(np.int32), np.concatenate(short), np.concatenate(values)]
                yield pa.RecordBatch.from_arrays([*ids.columns, *map(pa.array, columns)], ["doc_id", "comp", "n", "place", "short", "shingle"])

    return sets.select("doc_id", "comp", "shingles").mapInArrow(find, "doc_id long, comp long, n int, place int, short boolean, shingle long")


def common_shingles(sets: DataFrame, least: int = 16, limit: int = 200_000) -> np.ndarray:
    """The most frequent shingles of the sets, the most frequent first: 0.8 MB at most."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("shingles").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.uint32).astype(np.int64))], ["shingle"])

    counts = sets.select("shingles").mapInArrow(find, "shingle long").groupBy("shingle").count().where(F.col("count") >= least)
    return counts.orderBy(F.desc("count"), "shingle").limit(limit).toPandas()["shingle"].to_numpy().astype(np.uint32)


def near_duplicate_roots(docs: DataFrame, size: int = 5, similarity: float = 0.8, radius: int = 2) -> DataFrame:
    """(doc_id, root) of documents that are not the smallest id of their group.

    Groups are the connected components over pairs of Jaccard similarity
    `similarity` or more on word shingles, the exact sets deciding.  Documents
    meet by the vantage search over band fingerprints.  Each member of a set of
    linked fingerprints is first compared with three of its members.  Sets that
    this leaves in several components (a shared passage, a chain of drifting
    copies) are open: all pairs among their members are found by a prefix join
    over the shingles, again leaders first, then every pair that is still apart.
    """
    docs = id_and_text(docs).where("doc_id IS NOT NULL")
    prints = materialise(band_prints(docs, size))
    first = prints.groupBy("sha").agg(F.min("doc_id").alias("first_id"))
    copies = prints.join(first, "sha").where("doc_id > first_id").select(F.col("doc_id").alias("a"), F.col("first_id").alias("b"))
    each = materialise(prints.join(first.select(F.col("first_id").alias("doc_id")), "doc_id", "left_semi").select("doc_id", F.explode("prints").alias("fp")))
    roots = fingerprint_roots(each.select("fp").distinct(), radius)
    each = materialise(each.join(roots, "fp", "left").select("doc_id", F.coalesce("root", "fp").alias("root")))
    leaders = each.groupBy("root").agg(F.min("doc_id").alias("l1"), F.max("doc_id").alias("l2"), F.min_by("doc_id", F.xxhash64("doc_id", "root")).alias("l3")).where("l1 < l2")
    pairs = each.join(leaders, "root").select("doc_id", F.explode(F.array("l1", "l2", "l3")).alias("b")).where("doc_id != b")
    pairs = materialise(pairs.select(F.least("doc_id", "b").alias("a"), F.greatest("doc_id", "b").alias("b")).distinct())
    ids = pairs.select(F.col("a").alias("doc_id")).union(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = materialise(shingle_sets(docs.join(ids.hint("shuffle_hash"), "doc_id", "left_semi"), size).dropDuplicates(["doc_id"]))

    def similar(pairs: DataFrame) -> DataFrame:
        x, y = (sets.select(F.col("doc_id").alias(i), F.col("shingles").alias(s)) for i, s in (("a", "x"), ("b", "y")))
        return pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_similar(similarity), "a long, b long")

    def labelled(rows: DataFrame, nodes: DataFrame) -> DataFrame:
        return rows.join(nodes.select(F.col("node").alias("doc_id"), F.col("root").alias("comp")), "doc_id", "left").withColumn("comp", F.coalesce("comp", "doc_id"))

    def several(rows: DataFrame, key: str) -> DataFrame:
        return rows.groupBy(key).agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where("c1 < c2").select(key)

    links = materialise(similar(pairs).union(copies))
    nodes = connected_components(links)
    members = labelled(each, nodes)
    apart = members.join(several(members, "root"), "root", "left_semi").select("doc_id").distinct()
    left = materialise(labelled(sets.join(apart, "doc_id", "left_semi"), nodes))
    if not left.isEmpty():
        rows = materialise(prefixes(left, similarity, common_shingles(left)))
        rows = materialise(rows.join(several(rows, "shingle"), "shingle", "left_semi"))
        heads = rows.groupBy("shingle").agg(*(F.min_by(F.struct("doc_id", "comp", "n"), F.xxhash64("doc_id", F.lit(k))).alias(f"h{k}") for k in range(2)))
        near = rows.join(heads, "shingle").select("doc_id", "comp", "n", F.explode(F.array("h0", "h1")).alias("h")).where("comp != h.comp")
        near = near.where(F.least("n", "h.n") >= similarity * F.greatest("n", "h.n") - 1e-9)
        near = near.select(F.least("doc_id", "h.doc_id").alias("a"), F.greatest("doc_id", "h.doc_id").alias("b")).distinct()
        links = materialise(links.union(similar(near)))
        nodes = connected_components(links)
        rows = labelled(rows.drop("comp"), nodes)
        rows = materialise(rows.join(several(rows, "shingle"), "shingle", "left_semi"))
        p, q = rows.where("short").alias("p"), rows.alias("q")
        reach = F.least(F.col("p.n") - F.col("p.place"), F.col("q.n") - F.col("q.place"))
        meet = (F.col("p.comp") != F.col("q.comp")) & (F.struct("p.n", "p.doc_id") < F.struct("q.n", "q.doc_id")) & (F.col("p.n") >= similarity * F.col("q.n") - 1e-9)
        # both are in one order: from the first shared shingle on no more than `reach` can be shared
        enough = reach >= similarity / (1 + similarity) * (F.col("p.n") + F.col("q.n")) - 1e-9
        rest = p.join(q, (F.col("p.shingle") == F.col("q.shingle")) & meet & enough)
        rest = rest.select(F.least("p.doc_id", "q.doc_id").alias("a"), F.greatest("p.doc_id", "q.doc_id").alias("b")).distinct()
        nodes = connected_components(links.union(similar(rest)))
    return nodes.where("node != root").select(F.col("node").alias("doc_id"), "root")


def drop_near_duplicates(docs: DataFrame, size: int = 5, similarity: float = 0.8) -> DataFrame:
    """docs without all but one document (the smallest id) of each group; rows without an id stay."""
    return docs.join(near_duplicate_roots(docs, size, similarity).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op3_simhash": op3_simhash}
ORACLE_SQL: dict[str, str] = {}
