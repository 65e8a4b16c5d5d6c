"""Operator 7, scoring texts with a hierarchical Pitman-Yor language model.

A restaurant for every preceding word, whose customers are the words that
follow it; their parent is the root restaurant, where every table of a word in
any context is a customer of that word, and whose base is uniform over the
training words and one unknown word.

1.  Pairs.  Each part of the corpus counts its distinct (word, preceding word)
    pairs and packs them into one row for every bucket that its words fall into:
    as many rows at most as it has distinct words.  Numbers and texts are sent
    compressed.  A bucket has all pairs of its
    words.  Words that are frequent in a bounded sample (which decides nothing
    but where rows lie) are spread over several buckets by their contexts.
2.  Totals.  What a bucket cannot know alone, the tables and customers of whole
    restaurants and of spread words, is summed in homes, buckets of words like
    the others, and sent back to whoever asked.
3.  Seating.  Gibbs sampling in blocks: a sweep lets all customers of a dish,
    however many, get up and sit down together.  The model needs to know how many
    tables they have, and that number is drawn from its exact distribution given
    all other dishes: by generalised Stirling numbers up to WHOLE customers,
    beyond by a contour integral for the same numbers.  Dishes move side by side
    in GROUPS groups, with restaurants' totals as they stand after each group,
    those of other buckets as they stood at the last exchange.  Totals are
    exchanged again after the first sweep; predictive probabilities are averaged
    over the sweeps after that.

Discounts come from the counts of ones and twos of their level.  Seeds are
fixed and all arrays are in order, so a lost bucket comes out the same again.
Only the list of frequent words is seen by the driver.

Defined results: a null or empty text is its end token; very long texts are
scored whole; rows without an id are scored as any other; rows that repeat an id
are scored and counted each; an empty table gives no rows; without training rows
all scores are base scores of an empty model; other columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, id_and_text, mix, table, text_bytes, text_parts, total_bytes, word_hashes

PART_BYTES, BUCKET_BYTES, CHUNK_BYTES = 10 << 20, 12 << 20, 256 << 10
#: Text that frequent words are looked for in; a word in so many of its tokens may be spread.
SAMPLE_BYTES, LEAST_SEEN = 8 << 20, 50
SWEEPS = 2
#: Customers up to which numbers of ways come from their recursion; groups in which dishes move.
WHOLE, GROUPS = 512, 4
#: Points of a contour integral, and of a polynomial between values of it.
NODES, FITTED = 64, 16
#: Of restaurants at all levels; of 0.1, 1, 3 and 8 the best on held-out texts of sf0.01.
STRENGTH = 0.1
END, START = b" ", b""  # no word is a space, or empty


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def _hash(word: bytes) -> np.uint64:
    return word_hashes(pa.array([word], pa.binary()))[0]


class Grid:
    """Where pairs and words lie: buckets by ranges of a word's hash; spread words by their contexts as well."""

    def __init__(self, buckets: int, spread: dict[int, int]):
        self.buckets = buckets
        self.words = np.array(sorted(spread), np.uint64)
        self.splits = np.array([spread[int(w)] for w in self.words], np.uint64)
        self.edges = np.array([(b << 64) // buckets for b in range(buckets)], np.uint64)

    def of_words(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, words, "right") - 1

    def spread(self, words: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.words, words), max(len(self.words) - 1, 0))
        return self.words[at] == words if len(self.words) else np.zeros(len(words), bool)

    def of_pairs(self, words: np.ndarray, contexts: np.ndarray) -> np.ndarray:
        out, hot = self.of_words(words).astype(np.int32), self.spread(words)
        w, v = words[hot], contexts[hot]
        k = mix(v) % self.splits[np.searchsorted(self.words, w)] if len(w) else w
        out[hot] = self.of_words(mix(w + mix(k + np.uint64(1))))
        return out


def frequent_words(docs: DataFrame, size: int, buckets: int) -> dict[int, int]:
    """The words that fill more than a quarter of a bucket, and over how many to spread them."""
    texts = docs.sample(min(1.0, SAMPLE_BYTES / max(size, 1)), seed=7).select(F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz").alias("t"))
    words = texts.select(F.explode(F.concat(F.filter(F.split("t", r"[\x20\x09-\x0D]+"), lambda w: w != ""), F.array(F.lit(END.decode())))).alias("w"))
    seen = words.groupBy("w").count()
    rows = seen.withColumn("share", F.col("count") / F.sum("count").over(_whole())).where((F.col("count") >= LEAST_SEEN) & (F.col("share") * 4 * buckets > 1)).collect()
    return {int(_hash(r["w"].encode())): math.ceil(r["share"] * 4 * buckets) for r in rows}


def _whole():  # noqa: ANN202
    from pyspark.sql import Window

    return Window.partitionBy()  # over the sample's distinct words


class Part:
    """Tokens of the texts of one part, and its distinct (word, context) pairs in the order of their buckets."""

    def __init__(self, ids: list, texts: pa.Array, grid: Grid):
        w = Words(*text_bytes(texts))
        which, distinct = w.encoded(lower=True)
        hashes = np.concatenate([word_hashes(distinct), [_hash(END), _hash(START)]])
        n, order = len(hashes), np.argsort(hashes)
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        hashes = hashes[order]
        rows = len(w.off) - 1
        first = w.first + np.arange(rows + 1)
        self.n_tokens = np.diff(first)
        self.doc = np.repeat(np.arange(rows), self.n_tokens)
        token = np.insert(rank[which], w.first[1:], rank[n - 2])
        before = np.concatenate([[0], token[:-1]])[: len(token)]
        before[first[:-1]] = rank[n - 1]
        self.held_out = np.array([held_out(i) for i in ids], bool)
        # pairs in the order of their hashes, then by bucket
        codes, pair = np.unique(token * n + before, return_inverse=True)
        count = np.bincount(pair, weights=~self.held_out[self.doc], minlength=len(codes)).astype(np.uint32)
        word, context = hashes[codes // n], hashes[codes % n]
        bucket = grid.of_pairs(word, context)
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        self.pair = place[pair]
        self.word, self.context, self.bucket, self.count = word[order], context[order], bucket[order], count[order]

    def runs(self) -> np.ndarray:
        """Where each (bucket, word) begins among the pairs."""
        if not len(self.word):
            return np.zeros(0, np.int64)
        return np.flatnonzero(np.concatenate([[True], (self.word[1:] != self.word[:-1]) | (self.bucket[1:] != self.bucket[:-1])]))


ASK = "bucket int, part int, words binary, per_word binary, contexts binary, at binary, counts binary"


def ask(grid: Grid):  # noqa: ANN201
    """Packed pairs of a part, a row per bucket."""

    def pack(key: tuple, docs: pa.Table) -> pa.Table:
        p = Part(docs["doc_id"].to_pylist(), _one(docs["text"]), grid)
        runs, rows = p.runs(), []
        per = np.diff(np.append(runs, len(p.word)))
        cut = np.flatnonzero(np.concatenate([[True], p.bucket[1:] != p.bucket[:-1]])) if len(p.word) else np.zeros(0, np.int64)
        for a, b in zip(cut.tolist(), np.append(cut[1:], len(p.word)).tolist(), strict=True):
            i, j = np.searchsorted(runs, [a, b])
            contexts, at = np.unique(p.context[a:b], return_inverse=True)
            at = at.astype("<u2" if len(contexts) < 65536 else "<u4")
            rows.append((int(p.bucket[a]), key[0].as_py(), ascending(p.word[runs[i:j]]), squeezed(per[i:j].astype("<u4")), ascending(contexts), squeezed(at), squeezed(p.count[a:b])))
        return _rows(rows, ASK)

    return pack


def _rows(rows: list[tuple], schema: str) -> pa.Table:
    types = {"int": pa.int32(), "binary": pa.binary(), "double": pa.float64(), "long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    fields = [x.split(" ") for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.table([pa.array(c, types[t]) for c, (_, t) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())


def squeezed(values: np.ndarray) -> bytes:
    """Numbers, compressed: first bytes lie together, then second bytes, and so on."""
    raw = np.ascontiguousarray(values).reshape(-1, 1).view(np.uint8).T.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def ascending(values: np.ndarray) -> bytes:
    """The same for numbers in order, of which the differences are kept."""
    return squeezed(np.diff(values, prepend=np.uint64(0)))


def _number(blob: bytes, kind: type | str) -> np.ndarray:
    raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


def _numbers(blobs: list[bytes], kind: type | str) -> list[np.ndarray]:
    return [_number(b, kind) for b in blobs]


def _ordered(blobs: list[bytes]) -> list[np.ndarray]:
    return [np.cumsum(x, dtype=np.uint64) for x in _numbers(blobs, np.uint64)]


def pack_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task in compressed chunks of CHUNK_BYTES of text."""
    for chunk in text_parts(batches, CHUNK_BYTES):
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, chunk.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(chunk)
        yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["docs"])


def unpack_texts(packed: pa.Table) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(x).read_all() for x in packed["docs"].to_pylist()])


def _sum(at: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(at, weights=values, minlength=n)


class Tables:
    """Customers c and tables t of frequent dishes; a dish's tables are a run of slots."""

    def __init__(self, customers: np.ndarray, tables: np.ndarray):
        self.c, self.t = customers, tables
        self.cap, self.start = tables, np.cumsum(tables) - tables

    @property
    def size(self) -> np.ndarray:
        """A seating of so many tables, of which the model needs no more: one large table, all others of one customer."""
        out = np.ones(int(self.t.sum()), np.int64)
        out[self.start[self.t > 0]] = (self.c - self.t + 1)[self.t > 0]
        return out


def opening_ratios(customers: int, discount: float) -> np.ndarray:
    """[c, t]: log of S(c, t + 1) / S(c, t), where S sums the ways in which c customers fill t tables (generalised Stirling numbers)."""
    s, out = np.full(customers + 2, -np.inf), np.full((customers + 1, customers + 1), -np.inf)
    s[1] = 0
    for c in range(1, customers):
        longer = np.full(customers + 2, -np.inf)
        longer[1 : c + 1] = s[1 : c + 1] + np.log(c - discount * np.arange(1, c + 1))
        s = np.logaddexp(longer, np.concatenate([[-np.inf], s[:-1]]))
        out[c + 1, 1 : c + 1] = s[2 : c + 2] - s[1 : c + 1]
    return out


def _chance_per_table(s: np.ndarray, d: float) -> tuple[np.ndarray, np.ndarray]:
    """(log(1 - exp(-s)), 1 - (1 - exp(-s))**d)"""
    log_b, far = np.log(-np.expm1(-s)), np.abs(s) >= 1
    log_b[far] = np.log1p(-np.exp(-s[far]))
    return log_b, -np.expm1(d * log_b)


def log_ways(c: int, t: np.ndarray, d: float) -> np.ndarray:
    """log(S(c, t) * t! * d**t / c!), where S is as in opening_ratios.

    That is the coefficient of z**c in (1 - (1 - z)**d)**t, an integral over a
    contour in s = -log z.  It leads through the saddle point (not nearer to zero
    than 1 / c) and, where that is near the branch cut, bends around it.
    """
    s = np.exp(np.linspace(-math.log(c), math.log(40), 600))
    log_b, g = _chance_per_table(s, d)
    at = np.exp(np.interp(np.log(t), np.log(c * g) - (math.log(d) + (d - 1) * log_b - s), np.log(s)))
    log_b, g = _chance_per_table(at, d)
    e, b = np.exp(-at), np.exp(log_b)
    first, second = d * b ** (d - 1) * e, d * b ** (d - 2) * e * ((1 - d) * e + b)
    width = 1 / (at * np.sqrt(np.maximum(t * (second / g - (first / g) ** 2), 1e-300)))
    bent = at < 0.05
    end = np.minimum(10 * width, np.where(bent, np.arcsinh(np.minimum(150, math.pi / at)), math.pi / at))
    u = (np.arange(NODES) + 0.5) / NODES * end[:, None]
    s = at[:, None] * np.where(bent[:, None], 1 - (np.cosh(u) - 1) / 2 + 1j * np.sinh(u), 1 + 1j * u)
    step = at[:, None] * np.where(bent[:, None], -np.sinh(u) / 2 + 1j * np.cosh(u), 1j)
    top = t * np.log(g) + c * at
    g = _chance_per_table(s, d)[1]
    return top + np.log((np.exp(t[:, None] * np.log(g) + c * s - top[:, None]) * step).imag.sum(axis=1) * end / (NODES * math.pi))


def draw_frequent(c: int, others: float, p: float, d: float, rng: np.random.Generator) -> int:
    """draw_tables for one dish, however many customers it has."""
    # the peak of the weights, nearly, from saddle points
    s = np.exp(np.linspace(math.log(d / c) / (1 - d), math.log(40), 400))
    log_b, g = _chance_per_table(s, d)
    t = np.clip(c * g / (d * np.exp((d - 1) * log_b - s)), 1, c)
    rise = np.log((STRENGTH + d * (others + t)) * p / (d * (t + 1))) + np.log(g)
    k = min(max(int(np.searchsorted(-rise, 0)), 1), len(t) - 2)
    spread = math.sqrt(max(t[k + 1] - t[k - 1], 1e-9) / max(rise[k - 1] - rise[k + 1], 1e-9))
    low, high = max(1, int(t[k] - 9 * spread - 12)), min(c, int(t[k] + 9 * spread + 12))
    t = np.arange(low, high + 1).astype(np.float64)
    ways = log_ways(c, t, d) if len(t) <= FITTED else np.polynomial.Chebyshev.interpolate(lambda x: log_ways(c, x, d), FITTED - 1, [low, high])(t)
    level = ways + np.concatenate([[0.0], np.cumsum(np.log((STRENGTH + d * (others + t[:-1])) * p / (d * (t[:-1] + 1))))])
    share = np.cumsum(np.exp(level - level.max()))
    return low + int(np.searchsorted(share, rng.random() * share[-1], "right"))


def draw_tables(c: np.ndarray, others: np.ndarray, p: np.ndarray, discount: float, ratios: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes of c customers, from their exact distribution given the tables of the restaurant's other dishes.

    Each number of tables gets its log weight and Gumbel noise, and the largest
    is taken.  Weights rise to one peak; numbers past it whose weight is below
    e**-40 of it are not looked at, they are less than a double can tell.
    """
    t, at = np.minimum(c, 1), np.flatnonzero((c > 1) & (c < len(ratios)))
    level, peak, best, k = np.zeros(len(at)), np.zeros(len(at)), -np.log(rng.standard_exponential(len(at))), 1
    while len(at):
        level = level + np.log((STRENGTH + discount * (others[at] + k)) * p[at]) + ratios[c[at], k]
        noisy = level - np.log(rng.standard_exponential(len(at)))
        k += 1
        t[at[noisy > best]] = k
        best, peak = np.maximum(best, noisy), np.maximum(peak, level)
        go = (c[at] > k) & (level > peak - 40)
        at, level, peak, best = at[go], level[go], peak[go], best[go]
    for i in np.flatnonzero(c >= max(len(ratios), 2)).tolist():
        t[i] = draw_frequent(int(c[i]), float(others[i]), float(p[i]), discount, rng)
    return t


class Bucket:
    """All pairs of a bucket, summed over the parts, and their seating."""

    def __init__(self, asked: pa.Table, grid: Grid):
        asked = asked.sort_by("part")
        cell = {n: asked[n].to_pylist() for n in asked.column_names}
        words, contexts = _ordered(cell["words"]), _ordered(cell["contexts"])
        per = _numbers(cell["per_word"], "<u4")
        self.words, word_at = np.unique(np.concatenate(words), return_inverse=True)
        self.contexts, context_at = np.unique(np.concatenate(contexts), return_inverse=True)
        at, ends = [], np.cumsum([len(x) for x in contexts])
        for blob, x, end in zip(cell["at"], contexts, ends.tolist(), strict=True):
            at.append(context_at[end - len(x) : end][_number(blob, "<u2" if len(x) < 65536 else "<u4")])
        code = np.repeat(word_at, np.concatenate(per)) * len(self.contexts) + np.concatenate(at)
        codes, self.where = np.unique(code, return_inverse=True)
        counts = _numbers(cell["counts"], "<u4")
        self.parts, self.sizes = cell["part"], [len(x) for x in counts]
        self.word_at, self.word_sizes = word_at, [len(x) for x in words]
        self.w, self.v = codes // len(self.contexts), codes % len(self.contexts)
        self.c = _sum(self.where, np.concatenate(counts), len(codes)).astype(np.int64)
        self.t = np.minimum(self.c, 1)
        self.seen = _sum(self.w, self.c, len(self.words))
        self.known = self.seen  # with what other buckets have of the word
        self.hot = grid.spread(self.words)
        self.root_c = _sum(self.w, self.t, len(self.words)).astype(np.int64)
        self.root_t = np.minimum(self.root_c, 1)
        self.customers, self.tables = _sum(self.v, self.c, len(self.contexts)), _sum(self.v, self.t, len(self.contexts))
        self.far_c = self.far_t = np.zeros(len(self.words))  # of the words' root customers and tables elsewhere
        # totals are asked for words in order, which is the order of their homes
        self.wanted = np.union1d(self.contexts, self.words[self.hot])
        self.wanted_v = np.searchsorted(self.wanted, self.contexts)
        self.wanted_w = np.searchsorted(self.wanted, self.words[self.hot])
        self.home = grid.of_words(self.wanted)

    def tell(self) -> np.ndarray:
        """This bucket's part of the totals of every wanted word: tables, customers, then root customers, root tables and tokens of spread words."""
        out = np.zeros((5, len(self.wanted)), "<u4")
        out[0, self.wanted_v], out[1, self.wanted_v] = _sum(self.v, self.t, len(self.contexts)), _sum(self.v, self.c, len(self.contexts))
        out[2, self.wanted_w], out[3, self.wanted_w], out[4, self.wanted_w] = self.root_c[self.hot], self.root_t[self.hot], self.seen[self.hot]
        return out

    def sums(self) -> list[float]:
        """Tokens, types that are not spread, ones and twos of both levels, root customers and tables."""
        few = lambda c: [float((c == 1).sum()), float((c == 2).sum())]
        return [float(self.seen.sum()), float(((self.seen > 0) & ~self.hot).sum()), *few(self.c), *few(self.root_c), float(self.root_c.sum()), float(self.root_t.sum())]

    def learn(self, total: np.ndarray, sums: list[float]) -> None:
        """Takes over the totals of all buckets."""
        mine = self.tell().astype(np.float64)
        self.tables, self.customers = total[0, self.wanted_v].astype(np.float64), total[1, self.wanted_v].astype(np.float64)
        far = total[:, self.wanted_w] - mine[:, self.wanted_w]
        self.far_c, self.far_t, self.known = np.zeros(len(self.words)), np.zeros(len(self.words)), self.seen.copy()
        self.far_c[self.hot], self.far_t[self.hot] = far[2], far[3]
        self.known[self.hot] += far[4]
        self.types = sums[1] + sums[8]
        self.d, self.root_d = _discount(sums[2], sums[3]), _discount(sums[4], sums[5])
        self.all_c, self.all_t = sums[6], sums[7]

    def root(self) -> np.ndarray:
        """The root's predictive probability of each word."""
        held = np.maximum(self.root_c + self.far_c - self.root_d * (self.root_t + self.far_t), 0)
        return (held + (STRENGTH + self.root_d * self.all_t) / (self.types + 1)) / (STRENGTH + self.all_c)

    def seat(self, rng: np.random.Generator) -> None:
        """The first tables of all dishes, and of the root's."""
        self.many = np.flatnonzero(self.c > WHOLE)
        self.sweep(rng)

    def sweep(self, rng: np.random.Generator) -> None:
        """All customers get up and sit down again, dish by dish."""
        p, n = self.root(), len(self.contexts)
        some = np.flatnonzero(self.c > 1)
        ratios = opening_ratios(min(int(self.c.max(initial=1)), WHOLE), self.d)
        group = rng.integers(0, GROUPS, len(some))
        for at in [some[group == g] for g in range(GROUPS)]:
            v = self.v[at]
            t = draw_tables(self.c[at], self.tables[v] - self.t[at], p[self.w[at]], self.d, ratios, rng)
            self.tables += _sum(v, t - self.t[at], n)
            self.t[at] = t
        self.seats = Tables(self.c[self.many], self.t[self.many])
        # a table more or less is a customer more or less at the root
        before, self.root_c = self.root_c, _sum(self.w, self.t, len(self.words)).astype(np.int64)
        self.all_c += float((self.root_c - before).sum())
        some = np.flatnonzero(self.root_c > 0)
        ratios = opening_ratios(min(int(self.root_c.max(initial=1)), WHOLE), self.root_d)
        group = rng.integers(0, GROUPS, len(some))
        for at in [some[group == g] for g in range(GROUPS)]:
            t = draw_tables(self.root_c[at], self.all_t - self.root_t[at], np.full(len(at), 1 / (self.types + 1)), self.root_d, ratios, rng)
            self.all_t += float((t - self.root_t[at]).sum())
            self.root_t[at] = t

    def predictive(self) -> np.ndarray:
        """The model's probability of each pair's word after its context."""
        held = np.maximum(self.c - self.d * self.t, 0)
        return (held + (STRENGTH + self.d * self.tables[self.v]) * self.root()[self.w]) / (STRENGTH + self.customers[self.v])


def _discount(ones: float, twos: float) -> float:
    return float(np.clip(ones / max(ones + 2 * twos, 1), 0.05, 0.95))


TOLD = "home int, bucket int, words binary, totals binary, sums binary, spread array<long>"
REPLY = "bucket int, home int, turn int, totals binary"


def tell(grid: Grid, sweeps: int):  # noqa: ANN201
    """What a bucket has to tell, before the first exchange (no replies) or after the sweeps that follow it."""

    def say(key: tuple, asked: pa.Table, replies: pa.Table) -> pa.Table:
        b = Bucket(asked, grid)
        turn = _play(b, replies, sweeps, key[0].as_py())[0]
        totals, rows = b.tell(), []
        sums = np.array([b.sums()]).tobytes()
        known = b.words[b.hot & (b.seen > 0)].view(np.int64).tolist()
        cut = np.flatnonzero(np.concatenate([[True], b.home[1:] != b.home[:-1]])) if len(b.home) else np.zeros(0, np.int64)
        for i, (a, z) in enumerate(zip(cut.tolist(), np.append(cut[1:], len(b.home)).tolist(), strict=True)):
            # words once: homes know them when the second totals come
            rows.append((int(b.home[a]), key[0].as_py(), None if turn else ascending(b.wanted[a:z]), squeezed(totals[:, a:z]), None if i else sums, None if i else known))
        return _rows(rows, TOLD)

    return say


def add_up(turn: int):  # noqa: ANN201
    """A home: totals of all buckets per word, for each bucket the words that it asked for."""

    def reply(key: tuple, told: pa.Table, later: pa.Table) -> pa.Table:
        told = told.sort_by("bucket")
        buckets, words = told["bucket"].to_pylist(), _ordered(told["words"].to_pylist())
        new = dict(zip(later["bucket"].to_pylist(), later["totals"].to_pylist(), strict=True)) if turn else {}
        raw = [new[b] for b in buckets] if turn else told["totals"].to_pylist()
        values = np.concatenate([x.reshape(5, -1) for x in _numbers(raw, "<u4")], axis=1)
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.stack([_sum(at, row, len(distinct)) for row in values])[:, at].astype("<u4")
        ends = np.cumsum([len(x) for x in words])
        return _rows([(b, key[0].as_py(), turn, squeezed(total[:, e - len(x) : e])) for b, x, e in zip(buckets, words, ends.tolist(), strict=True)], REPLY)

    return reply


def _play(b: Bucket, replies: pa.Table, sweeps: int, number: int) -> tuple[int, np.ndarray | None]:
    """(replies heard, mean predictive probabilities of the sweeps after the last): everything that follows from them."""
    replies = replies.sort_by([("turn", "ascending"), ("home", "ascending")])
    turns, raw, sums = (replies[n].to_pylist() for n in ("turn", "totals", "sums"))
    heard, mean = sorted(set(turns)), None
    for turn in heard:
        own = [i for i, t in enumerate(turns) if t == turn]
        b.learn(np.concatenate([_number(raw[i], "<u4").reshape(5, -1) for i in own], axis=1), sums[own[0]])
        if turn == 0:
            b.seat(np.random.default_rng([number, 99]))
        mean = np.zeros(len(b.c))
        many = sweeps if turn else 1
        for s in range(many):
            b.sweep(np.random.default_rng([number, turn, s]))
            mean += b.predictive() / many
    return len(heard), mean


#: Log10 probabilities are sent in whole steps, about as fine as those of 4-byte floats.
LOG_STEP = 2.0**-20
ANSWER = "part int, bucket int, log_p binary, counts binary, tokens double, types double"


def answer(grid: Grid, sweeps: int):  # noqa: ANN201
    """Mean log10 probabilities and word counts, in the order in which the parts asked."""

    def give(key: tuple, asked: pa.Table, replies: pa.Table) -> pa.Table:
        b = Bucket(asked, grid)
        sums = replies["sums"][0].as_py()
        mean = _play(b, replies, sweeps, key[0].as_py())[1]
        log_p, known = np.rint(-np.log10(mean) / LOG_STEP).astype("<u4")[b.where], b.known[b.word_at].astype("<u4")
        ends, word_ends = np.cumsum(b.sizes).tolist(), np.cumsum(b.word_sizes).tolist()
        return _rows([(p, key[0].as_py(), squeezed(log_p[e - k : e]), squeezed(known[f - m : f]), sums[0], sums[1] + sums[8]) for p, e, k, f, m in zip(b.parts, ends, b.sizes, word_ends, b.word_sizes, strict=True)], ANSWER)

    return give


RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, perplexity double"


def add_scores(grid: Grid):  # noqa: ANN201
    def score(key: tuple, docs: pa.Table, told: pa.Table) -> pa.Table:
        told = told.sort_by("bucket")
        p = Part(docs["doc_id"].to_pylist(), _one(docs["text"]), grid)
        log_p = np.concatenate(_numbers(told["log_p"].to_pylist(), "<u4")) * -LOG_STEP
        counts = np.concatenate(_numbers(told["counts"].to_pylist(), "<u4")).astype(np.float64)
        runs = p.runs()
        counts = np.repeat(counts, np.diff(np.append(runs, len(p.word))))[p.pair]
        n, v = told["tokens"][0].as_py(), told["types"][0].as_py()
        rows = len(docs)
        total = np.bincount(p.doc, weights=log_p[p.pair], minlength=rows)
        base = np.bincount(p.doc, weights=np.log10((counts + 1) / (n + 1 * (v + 1))), minlength=rows)
        known = np.bincount(p.doc, weights=counts > 0, minlength=rows).astype(np.int64)
        return pa.table({"doc_id": docs["doc_id"], "held_out": p.held_out, "n_tokens": p.n_tokens, "n_known": known, "train_tokens": np.full(rows, int(n)), "base_score": base, "score": total, "perplexity": np.exp(np.minimum(-total / p.n_tokens * math.log(10), 700))})

    return score


def _all_sums(told: DataFrame) -> DataFrame:
    """One row: the sums of all buckets, and how many spread words have been seen in training.

    All columns go into the map, so that it reads the exchange that homes read,
    and no bucket is built for its sums alone.
    """

    def add(batches):  # noqa: ANN001, ANN202
        for batch in batches:
            rows = np.array([np.frombuffer(x, np.float64) for x in batch.column("sums").drop_null().to_pylist()]).reshape(-1, 8)
            words = [w for own in batch.column("spread").drop_null().to_pylist() for w in own]
            yield pa.RecordBatch.from_arrays([pa.array([rows.sum(axis=0).tolist()], pa.list_(pa.float64())), pa.array([words], pa.list_(pa.int64()))], ["s", "words"])

    partial = told.mapInArrow(add, "s array<double>, words array<long>")
    whole = partial.agg(*[F.coalesce(F.sum(F.get("s", F.lit(i))), F.lit(0.0)).alias(f"s{i}") for i in range(8)])
    words = partial.select(F.explode("words").alias("w")).agg(F.count_distinct("w").cast("double").alias("s8"))
    return whole.crossJoin(F.broadcast(words)).select(F.array(*[f"s{i}" for i in range(9)]).alias("sums"))  # a row and a row


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_bytes: int = PART_BYTES, bucket_bytes: int = BUCKET_BYTES, sweeps: int = SWEEPS) -> DataFrame:
    """One row per document: counts, base score and the model's log10 probability of its text."""
    docs = id_and_text(docs, id_col, text_col)
    size = total_bytes(docs)
    parts, buckets = max(1, math.ceil(size / part_bytes)), max(1, math.ceil(size / bucket_bytes))
    grid = Grid(buckets, frequent_words(docs, size, buckets) if buckets > 1 else {})
    packed = docs.mapInArrow(pack_texts, "docs binary")
    dealt = packed.withColumn("part", F.pmod(F.xxhash64("docs"), F.lit(parts)).cast("int")).repartition(parts, "part")
    pack, score = ask(grid), add_scores(grid)
    asked = dealt.groupBy("part").applyInArrow(lambda key, texts: pack(key, unpack_texts(texts)), ASK)
    asked = asked.repartition(buckets, "bucket")
    with_sums = lambda replies, told: replies.crossJoin(F.broadcast(_all_sums(told)))  # noqa: E731  # one row
    spark = docs.sparkSession
    none = spark.createDataFrame([], REPLY + ", sums array<double>")
    told = asked.groupBy("bucket").cogroup(none.groupBy("bucket")).applyInArrow(tell(grid, sweeps), TOLD).repartition(buckets, "home")
    nothing = spark.createDataFrame([], TOLD)
    replies = with_sums(told.groupBy("home").cogroup(nothing.groupBy("home")).applyInArrow(add_up(0), REPLY), told)
    later = asked.groupBy("bucket").cogroup(replies.groupBy("bucket")).applyInArrow(tell(grid, sweeps), TOLD).repartition(buckets, "home")
    again = with_sums(told.groupBy("home").cogroup(later.groupBy("home")).applyInArrow(add_up(1), REPLY), later)
    both = replies.unionByName(again)
    told_parts = asked.groupBy("bucket").cogroup(both.groupBy("bucket")).applyInArrow(answer(grid, sweeps), ANSWER)
    return dealt.groupBy("part").cogroup(told_parts.groupBy("part")).applyInArrow(lambda key, texts, told: score(key, unpack_texts(texts), told), RESULT)


def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op7_language_model": op7_language_model}
ORACLE_SQL: dict[str, str] = {}
