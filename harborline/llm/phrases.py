"""Operator 5, substring dedup with repeated-phrase automata.

A word goes if a run of WINDOW words that covers it also starts earlier, in a
document of smaller id or further up in the same one.

1.  Phrases.  Of every window the phrase (PHRASE words) with the smallest hash
    is chosen: wherever a window recurs, the same phrase is chosen again.  Every
    part of the corpus (SHARD_BYTES of documents) names its distinct chosen
    phrases once; a count over all parts confirms those that recur.
2.  Automata.  The confirmed phrases that a part named are its shard: they are
    compiled into one Aho-Corasick automaton over words (a word of the shard is
    one character), and all documents of the part are streamed through it.  No
    other phrase can occur in them as a chosen one, so every document meets all
    phrases that it can match, and the work stays in proportion to the text.
    What the automaton finds are the only places that are looked at: windows
    whose chosen phrase begins at an occurrence are candidates.
3.  Resolution.  Candidate windows meet by two 64-bit hashes of all their words,
    polynomials over different values of a word; all but the earliest are removed.

A window that recurs inside a part is settled there, and one witness goes on: a
passage in a third of all documents is a few rows per part, not one per
occurrence.  Exact copies of a text take no part in the search: all but the
first lose every word if they are a window long.  Texts are shuffled once, and
that exchange serves the three passes over them.

Defined results: a null or empty text has no words, and the digest of nothing;
texts shorter than a window stay whole; very long texts are read to their end, in
one part; rows without an id lose nothing and count for nothing; rows that repeat
id and text get the same result each; rows that repeat an id with other text are
documents of their own, in the order of a hash of their texts; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Words, id_and_text, mix, rolling, sliding_argmin, table, text_bytes, text_parts, total_bytes, word_hashes

WINDOW, PHRASE = 20, 6
SHARD_BYTES, PART_BYTES = 12 << 20, 3 << 20


#: What a row is known by: its id and a hash of its text.
ROW = ["doc_id", "h"]


def later_copies(docs: DataFrame) -> DataFrame:
    """(doc_id, h) of rows whose whole text a smaller id has too."""
    keyed = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select(*ROW, F.sha2("text", 256).alias("sha"))
    first = keyed.groupBy("sha").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id")
    return keyed.join(first, "sha").where("doc_id > first_id").select(*ROW).distinct()


def hashed(texts: pa.Array) -> tuple[Words, np.ndarray, list[bytes], np.ndarray]:
    """(words, their numbers, the distinct ones, the hash of each word)."""
    w = Words(*text_bytes(texts))
    which, distinct = w.encoded()
    return w, which, distinct.to_pylist(), word_hashes(distinct)[which] if len(which) else np.zeros(0, np.uint64)


def chosen(w: Words, phrase: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, place of its chosen phrase) of every window inside a text."""
    low = sliding_argmin(phrase, WINDOW - PHRASE + 1)
    starts = np.flatnonzero(w.doc[: len(low)] == w.doc[WINDOW - 1 :]) if len(low) else np.zeros(0, np.int64)
    return starts, low[starts]


def slices(part: pa.Table, side: pa.Table) -> Iterator[pa.RecordBatch]:
    """The documents of a part that take part in the search, a few MB at a time."""
    copies = copied_rows(side)
    part = part.filter(pa.array([row not in copies for row in rows_of(part)], pa.bool_()))
    yield from text_parts(iter(part.select([*ROW, "text"]).to_batches()), PART_BYTES)


def rows_of(part: pa.Table) -> list[tuple[int, int]]:
    return list(zip(*(part[c].to_pylist() for c in ROW), strict=True))


def copied_rows(side: pa.Table) -> set[tuple[int, int]]:
    return {(x["doc_id"], x["h"]) for own in side["copies"].to_pylist() for x in own or ()}


def find_phrases(key: tuple, part: pa.Table, side: pa.Table) -> pa.Table:
    """The distinct chosen phrases of a part, and whether they are chosen twice in it."""
    found: dict[int, tuple[bytes, int]] = {}
    for batch in slices(part, side):
        w, _, _, values = hashed(batch.column("text"))
        phrase = mix(rolling(values, PHRASE))
        at = np.unique(chosen(w, phrase)[1])
        keys, first, n = np.unique(phrase[at], return_index=True, return_counts=True)
        raw, at = w.data.tobytes(), at[first]
        for k, a, b, m in zip(keys.view(np.int64).tolist(), w.start[at].tolist(), w.end[at + PHRASE - 1].tolist(), n.tolist(), strict=True):
            old = found.get(k)
            found[k] = (b" ".join(raw[a:b].split()), m) if old is None else (old[0], old[1] + m)
    texts, n = zip(*found.values(), strict=True) if found else ((), ())
    own = pa.array([key[0].as_py()] * len(found), pa.int32())
    return pa.table({"key": pa.array(list(found), pa.int64()), "part": own, "phrase": pa.array(texts, pa.binary()), "twice": pa.array([m > 1 for m in n], pa.bool_())})


def confirmed_phrases(dealt: DataFrame, copies: DataFrame) -> DataFrame:
    """(part, phrases): for every part the phrases it named that recur anywhere."""
    found = dealt.groupBy("part").cogroup(copies.groupBy("part")).applyInArrow(find_phrases, "key long, part int, phrase binary, twice boolean")
    n = F.count("*").over(Window.partitionBy("key"))
    return found.withColumn("n", n).where("twice OR n > 1").groupBy("part").agg(F.collect_list("phrase").alias("phrases"))


def as_characters(code: np.ndarray) -> str:
    """Numbers from 0 as one character each, past the surrogates."""
    code = code + 1
    code = code + 2048 * (code >= 0xD800)
    return code.astype("<u4").tobytes().decode("utf-32-le")


class Automaton:
    """An Aho-Corasick automaton over the words of some phrases; other words are one number that fits nowhere.

    A word is three characters, the digits of its number, each place with an
    alphabet of its own: nodes have few edges however many words there are, and a
    match can only begin where a word does.
    """

    def __init__(self, phrases: list[bytes]):
        import ahocorasick

        self.machine, self.numbers = ahocorasick.Automaton(), {}
        codes = [self.numbers.setdefault(x, len(self.numbers) + 1) for phrase in phrases for x in phrase.split(b" ")]
        self.base = max(2, math.ceil((len(self.numbers) + 1) ** (1 / 3) + 1e-9))
        signs, width = self._signs(np.array(codes, np.int64)), 3 * PHRASE
        for i in range(0, len(signs), width):
            self.machine.add_word(signs[i : i + width], 1)
        self.machine.make_automaton()

    def _signs(self, number: np.ndarray) -> str:
        b = self.base
        digits = np.stack([number // (b * b), b + number // b % b, 2 * b + number % b], 1)
        return as_characters(digits.ravel())

    def occurrences(self, w: Words, which: np.ndarray, distinct: list[bytes]) -> np.ndarray:
        """The words at which a phrase begins, marked, for all texts of a batch."""
        marks = np.zeros(len(which), bool)
        if len(self.machine) and len(which):
            get, ends = self.numbers.get, []
            number = np.array([get(x, 0) for x in distinct], np.int64)
            signs, first = self._signs(number[which]), w.first.tolist()
            for a, b in zip(first[:-1], first[1:], strict=True):
                if b - a >= WINDOW:
                    ends += [3 * a + end for end, _ in self.machine.iter(signs[3 * a : 3 * b])]
            marks[np.array(ends, np.int64) // 3 - PHRASE + 1] = True
        return marks


RUNS = "key long, part int, doc_id long, h long, start int, length int, hashes array<long>, checks array<long>"


def find_windows(key: tuple, part: pa.Table, side: pa.Table) -> pa.Table:
    """Runs of windows: those still open with their hashes, by the phrase that they share; settled ones by length."""
    automaton = Automaton([p for own in side["phrases"].to_pylist() for p in own or ()])
    out = [open_runs(batch, automaton) for batch in slices(part, side)]
    keys, ids, marks, starts, length, offsets, hashes, checks, done = (np.concatenate(x) for x in zip(*out, strict=True)) if out else [np.zeros(0, np.int64)] * 9
    ends = np.concatenate([[0], np.cumsum(offsets)]).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.view(np.int64)), mask=pa.array(done.astype(bool))) for x in (hashes, checks)]
    own = pa.array([key[0].as_py()] * len(keys), pa.int32())
    return pa.table({"key": pa.array(keys.view(np.int64)), "part": own, "doc_id": pa.array(ids), "h": pa.array(marks), "start": pa.array(starts.astype(np.int32)), "length": pa.array(length.astype(np.int32)), "hashes": lists[0], "checks": lists[1]})


def open_runs(batch: pa.RecordBatch, automaton: Automaton) -> tuple[np.ndarray, ...]:
    """(key, doc_id, h, start, length, open windows, their hashes, their second hashes, is settled) of a batch's runs of candidates."""
    w, which, distinct, values = hashed(batch.column("text"))
    phrase = mix(rolling(values, PHRASE))
    starts, place = chosen(w, phrase)
    hit = automaton.occurrences(w, which, distinct)[place]
    starts, place = starts[hit], place[hit]
    key, row = phrase[place], w.doc[starts]
    h, check = (mix(rolling(x, WINDOW)[starts]) if len(starts) else key for x in (values, mix(values)))
    ids, marks = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)[row] for c in ROW)
    start = starts - w.first[row]
    # all but the earliest of the windows that are equal inside the batch are settled
    order = np.lexsort((start, marks, ids, check, h))
    later = np.zeros(len(h), bool)
    a, b = order[1:], order[:-1]
    later[a] = (h[a] == h[b]) & (check[a] == check[b])
    # rows that repeat id and text hold the same windows, none of them earlier
    twin = later[a] & (ids[a] == ids[b]) & (marks[a] == marks[b]) & (start[a] == start[b])
    for i in np.flatnonzero(twin):
        later[a[i]] = later[b[i]]
    new = np.concatenate([[True], (row[1:] != row[:-1]) | (start[1:] != start[:-1] + 1) | (later[1:] != later[:-1]) | (~later[1:] & (key[1:] != key[:-1]))]) if len(h) else later
    cut = np.flatnonzero(new)
    length = np.diff(np.append(cut, len(h)))
    done = later[cut]
    keys = np.where(done, mix(mix(ids[cut].astype(np.uint64) ^ mix(marks[cut].astype(np.uint64))) ^ start[cut].astype(np.uint64)), key[cut])
    return keys, ids[cut], marks[cut], start[cut], length, np.where(done, 0, length), h[~later], check[~later], done


def removed_runs(dealt: DataFrame, copies: DataFrame) -> DataFrame:
    """(part, runs): runs of windows that also start earlier."""
    phrases = confirmed_phrases(dealt, copies)
    side = copies.withColumn("phrases", F.lit(None).cast("array<binary>")).unionByName(phrases.withColumn("copies", F.lit(None).cast(copies.schema["copies"].dataType)))
    found = dealt.groupBy("part").cogroup(side.groupBy("part")).applyInArrow(find_windows, RUNS)
    # equal windows share their phrase, so partitions by phrase hold all that the window below compares
    found = found.repartition("key")
    each = found.select("key", "part", *ROW, "start", "length", F.posexplode_outer(F.arrays_zip("hashes", "checks")).alias("at", "hash"))
    each = each.withColumn("start", F.col("start") + F.coalesce("at", F.lit(0))).withColumn("length", F.when(F.col("at").isNull(), F.col("length")).otherwise(1))
    place = F.struct(*ROW, "start")
    each = each.withColumn("earliest", F.min(place).over(Window.partitionBy("key", "hash")))
    out = each.where(F.col("at").isNull() | (place > F.col("earliest")))
    return out.groupBy("part").agg(F.collect_list(F.struct(*ROW, "start", "length")).alias("runs"))


KEPT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _kept(words: list[bytes], gone: np.ndarray | None) -> tuple[int, int, str, str]:
    kept = words if gone is None else list(compress(words, (~gone).tolist()))
    joined = b" ".join(kept)
    return len(words), len(words) - len(kept), hashlib.sha256(joined).hexdigest(), joined.decode()


def _table(ids: pa.Array, out: list[tuple]) -> pa.Table:
    columns = list(zip(*out, strict=True)) if out else [()] * 4
    types = [pa.int64(), pa.int64(), pa.string(), pa.string()]
    names = [x.split()[0] for x in KEPT.split(", ")]
    return pa.table([ids, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names)


def cut_out(key: tuple, part: pa.Table, side: pa.Table) -> pa.Table:
    """The documents of a part without their removed runs."""
    copies = copied_rows(side)
    runs = side["runs"].combine_chunks().flatten() if part.num_rows else None
    by_row: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
    if runs is not None and len(runs):
        ids, marks, starts, lengths = (runs.field(n).to_numpy(zero_copy_only=False) for n in (*ROW, "start", "length"))
        order = np.lexsort((marks, ids))
        ids, marks = ids[order], marks[order]
        cut = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1])]))
        for i, h, own in zip(ids[cut].tolist(), marks[cut].tolist(), np.split(order, cut[1:]), strict=True):
            by_row[i, h] = starts[own], lengths[own]
    out = []
    for i, text in zip(rows_of(part), part["text"].to_pylist(), strict=True):
        words, gone = (text or "").encode().split(), None
        if i in copies and len(words) >= WINDOW:
            gone = np.ones(len(words), bool)
        elif i not in copies and i in by_row:
            marks = np.zeros(len(words) + 1, np.int32)
            at, length = by_row[i]
            np.add.at(marks, at, 1)
            np.add.at(marks, at + length + WINDOW - 1, -1)
            gone = np.cumsum(marks[:-1]) > 0
        out.append(_kept(words, gone))
    return _table(part["doc_id"], out)


def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows without an id, whole."""
    for batch in batches:
        out = [_kept((text or "").encode().split(), None) for text in batch.column("text").to_pylist()]
        yield from _table(batch.column("doc_id"), out).to_batches()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): documents without their repeated passages."""
    docs = id_and_text(docs, id_col, text_col)
    parts = max(1, math.ceil(total_bytes(docs) / SHARD_BYTES))
    docs = docs.withColumn("h", F.xxhash64("text"))
    part = F.pmod(F.xxhash64("doc_id"), F.lit(parts)).cast("int").alias("part")
    dealt = docs.where("doc_id IS NOT NULL").select(*ROW, "text", part).repartition(parts, "part")
    copies = later_copies(docs).groupBy(part).agg(F.collect_list(F.struct(*ROW)).alias("copies"))
    runs = removed_runs(dealt, copies)
    side = copies.withColumn("runs", F.lit(None).cast(runs.schema["runs"].dataType)).unionByName(runs.withColumn("copies", F.lit(None).cast(copies.schema["copies"].dataType)))
    out = dealt.groupBy("part").cogroup(side.groupBy("part")).applyInArrow(cut_out, KEPT)
    return out.unionByName(docs.where("doc_id IS NULL").select("doc_id", "text").mapInArrow(untouched, KEPT))


def op5_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


QUERIES = {"op5_substrings": op5_substrings}
ORACLE_SQL: dict[str, str] = {}
