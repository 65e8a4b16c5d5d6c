"""Operator 2, benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question that was
given other values keeps its template.  Windows of template tokens of documents
and of benchmark items are hash-joined; windows that join at one displacement
are one occurrence.  Its windows with unchanged slots count; those with other
values must be consistent, each item value standing for the document value that
it mostly has in this occurrence (two may become one).  A document is
contaminated by an item if half of the item's windows are covered, or 13 of its
tokens in a row in one occurrence.  Windows are built twice, with and without the
placeholder for names, since a leak may have lost its capital letters.

The item's windows are few as a rule: up to ``FILTER_LIMIT`` of them, their
hashes are sent along so that only windows that will join leave the tokenizing
tasks.  Beyond that number all windows go to the join, which is the same.

Defined results: null and empty texts have no windows and are clean; an item
shorter than a window is one window of its own length; windows with too few
plain words count only if the item has no others, and then word for word, values
included; repeated rows of documents (same doc_id) count as one document; empty tables give no rows;
other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Words, id_and_text, materialise, mix, rolling, table, text_bytes, text_parts, word_hashes

WINDOW = 8
MIN_PLAIN = 4
MIN_COVERED = 0.5
#: So many tokens of an item in a row are a leak, whatever part of the item they are.
MIN_RUN = 13
#: So many item windows are sent to the tasks at most: 8 MB of hashes.
FILTER_LIMIT = 1_000_000
PART_BYTES = 4 << 20
#: Words read as units of measure.
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds ton tons tonne tonnes ml l litre litres liter liters gallon gallons second seconds minute minutes hour hours day days week weeks month months year years cent cents dollar dollars euro euros percent degree degrees watt watts volt volts".split())
NUMBER = re.compile(r"[+-]?[\d][\d.,:/]*%?")
EDGE = re.compile(r"^[\W_]+|[\W_]+$")
NAME = re.compile(r"[^\W\d_][^\W\d_]*[a-zß-öø-ÿ]['’\w-]*")
#: The variant without placeholders, beside 0 and 1 without and with those for names.
LITERAL = 2
PLAIN, SLOT_NUMBER, SLOT_UNIT, SLOT_NAME = 0, 1, 2, 3


def _canonical(word: str) -> tuple[str, int, bool, bool]:
    """(token, its type, is written as a name, ends a sentence)."""
    bare = EDGE.sub("", word)
    low = bare.lower()
    kind = SLOT_NUMBER if NUMBER.fullmatch(bare) else SLOT_UNIT if low in UNITS else PLAIN
    return low, kind, kind == PLAIN and bare[:1].isupper() and bool(NAME.fullmatch(bare)), word.rstrip("\"'”’)]")[-1:] in (".", "!", "?", ":")


def template_windows(texts: pa.Array, sizes: list[int], literal: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray, int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]]:
    """Per variant and size: rows, positions, variant, size, hashes, first tokens, types of tokens, tokens per row, and the tokens.

    Variant LITERAL, for the sizes in `literal`, has no slots and all windows.
    """
    data, off = text_bytes(texts)
    w = Words(data, off)
    which, distinct = w.encoded()
    forms = [_canonical(x.decode("utf-8", "replace")) for x in distinct.to_pylist()]
    kept = np.array([bool(f[0]) for f in forms], bool)
    kind = np.array([f[1] for f in forms], np.int8)
    proper = np.array([f[2] for f in forms], bool)
    closing = np.array([f[3] for f in forms], bool)
    tokens: dict[str, int] = {}
    token = np.array([tokens.setdefault(f[0], len(tokens)) for f in forms], np.int64)
    names = list(tokens)
    hashes = word_hashes(pa.array([x.encode() for x in names], pa.binary())) if names else np.zeros(0, np.uint64)
    if not len(which):
        return
    first = np.zeros(len(which), bool)
    first[w.first[:-1][w.counts > 0]] = True
    opens = first | np.concatenate([[True], closing[which[:-1]]])
    stay = kept[which]
    which, doc, opens = which[stay], w.doc[stay], opens[stay]
    start = np.searchsorted(doc, np.arange(len(off)))
    position = np.arange(len(doc)) - start[doc]
    counts = np.bincount(doc, minlength=len(off) - 1)
    for variant, lengths in ((0, sizes), (1, sizes), (LITERAL, literal)):
        types = kind[which].copy() if variant != LITERAL else np.full(len(which), PLAIN, np.int8)
        if variant == 1:
            types[(types == PLAIN) & proper[which] & ~opens] = SLOT_NAME
        values = np.where(types == PLAIN, hashes[token[which]], mix(types.astype(np.uint64) + np.uint64(7)))
        plain = np.concatenate([[0], np.cumsum(types == PLAIN)])
        for size in lengths:
            h = rolling(values, size)
            at = np.flatnonzero(doc[: len(h)] == doc[size - 1 :]) if len(h) else np.zeros(0, np.int64)
            if variant != LITERAL:
                at = at[plain[at + size] - plain[at] >= min(MIN_PLAIN, size)]
            yield doc[at], position[at], variant, size, mix(h[at] ^ np.uint64(size + (variant == LITERAL) * 64)), at, types, counts, [token[which], names]


def windows(table_: DataFrame, sizes: list[int], literal: list[int], wanted: np.ndarray | None, own: bool = False) -> DataFrame:
    """(doc_id, position, variant, size, hash, slots): template windows, only those wanted if a sorted array is given.

    own: each text gets windows of one size only, the largest that it has tokens
    for, and literal ones only if it has no others.
    """

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in text_parts(batches, PART_BYTES):
            part = whole.filter(whole.column("doc_id").is_valid())  # before numpy, which has no null long
            ids = part.column("doc_id").to_numpy(zero_copy_only=False)
            bare = np.ones(len(ids), bool)
            for doc, position, variant, size, h, at, types, counts, (token, names) in template_windows(part.column("text"), sizes, literal):
                use = np.flatnonzero(np.minimum(counts[doc], max(sizes)) == size) if own else np.arange(len(h))
                if own and variant == LITERAL:
                    use = use[bare[doc[use]]]
                bare[doc[use]] &= variant == LITERAL
                if wanted is not None:
                    k = np.minimum(np.searchsorted(wanted, h), max(len(wanted) - 1, 0))
                    use = use[wanted[k] == h] if len(wanted) else use[:0]
                slots = [[names[token[a + i]] for i in range(size) if types[a + i]] for a in at[use].tolist()]
                n = len(use)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[doc[use]], pa.int64()), pa.array(position[use], pa.int32()), pa.array(np.full(n, variant), pa.int32()), pa.array(np.full(n, size), pa.int32()), pa.array(h[use].view(np.int64)), pa.array(slots, pa.list_(pa.string()))],
                    ["doc_id", "position", "variant", "size", "hash", "slots"],
                )

    return table_.mapInArrow(find, "doc_id long, position int, variant int, size int, hash long, slots array<string>")


OCCURRENCE = "doc_id long, item_id long, variant int, at array<int>, changed int, run int"


def consistent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each occurrence the windows that count, their changed pairs of values and their longest run of tokens.

    Windows with the item's own values count.  Others count if each of their
    pairs is the most frequent one of its item value in this occurrence, the
    unchanged one at a tie.
    """
    for batch in batches:
        out = []
        for doc, item, variant, ws in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "item_id", "variant", "ws")), strict=True):
            votes = Counter(pair for w in ws for pair in zip(w["i"], w["d"], strict=True))
            best: dict[str, tuple[int, bool, str]] = {}
            for (i, d), n in votes.items():
                best[i] = max(best.get(i, (0, False, "")), (n, i == d, d))
            ws = sorted((w for w in ws if w["i"] == w["d"] or all(best[i][2] == d for i, d in zip(w["i"], w["d"], strict=True))), key=lambda w: w["item_position"])
            if not ws:
                continue
            changed = {pair for w in ws for pair in zip(w["i"], w["d"], strict=True) if pair[0] != pair[1]}
            run, since, end = 0, 0, -1
            for w in ws:
                since = w["item_position"] if w["item_position"] > end else since
                end = w["item_position"] + w["size"]
                run = max(run, end - since)
            out.append((doc, item, variant, sorted({w["item_position"] for w in ws}), len(changed), run))
        types = [pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int32(), pa.int32()]
        columns = zip(*out, strict=True) if out else [[]] * len(types)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)], ["doc_id", "item_id", "variant", "at", "changed", "run"])


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", filter_limit: int = FILTER_LIMIT) -> DataFrame:
    """One row per document and item that leaked into it: doc_id, item_id, n_covered, n_windows, coverage, changed_slots."""
    docs = id_and_text(docs, id_col, text_col)
    items = id_and_text(items, item_col, item_text).dropDuplicates()
    own = materialise(windows(items, every := list(range(1, WINDOW + 1)), every, None, own=True))
    kinds = own.select("size", (F.col("variant") == LITERAL).alias("literal")).distinct().orderBy("size").collect()
    sizes, literal = ([r["size"] for r in kinds if r["literal"] == flag] for flag in (False, True))
    own = own.select(F.col("doc_id").alias("item_id"), F.col("position").alias("item_position"), "variant", "hash", F.col("slots").alias("item_slots"))
    totals = own.groupBy("item_id", "variant").agg(F.count("*").alias("n_windows"))
    few = own.select("hash").distinct().limit(filter_limit + 1).toPandas()["hash"].to_numpy()
    wanted = np.sort(few.astype(np.int64).view(np.uint64)) if len(few) <= filter_limit else None
    found = windows(docs, sizes, literal, wanted).join(own, ["variant", "hash"])
    window = F.struct("item_position", F.col("item_slots").alias("i"), F.col("slots").alias("d"), "size")
    found = found.select("doc_id", "item_id", "variant", (F.col("position") - F.col("item_position")).alias("shift"), window.alias("w"))
    each = found.groupBy("doc_id", "item_id", "variant", "shift").agg(F.collect_set("w").alias("ws")).drop("shift").mapInArrow(consistent, OCCURRENCE)
    covered = F.size(F.array_distinct(F.flatten(F.collect_list("at")))).cast("long")
    whole = each.groupBy("doc_id", "item_id", "variant").agg(covered.alias("n_covered"), F.max("changed").cast("long").alias("changed_slots"), F.max("run").alias("run"))
    whole = whole.join(totals, ["item_id", "variant"]).withColumn("coverage", F.col("n_covered") / F.col("n_windows"))
    best = F.max(F.struct("coverage", "n_covered", "n_windows", "changed_slots"))
    out = whole.groupBy("doc_id", "item_id").agg(best.alias("b"), F.max("run").alias("run")).where((F.col("b.coverage") >= MIN_COVERED) | (F.col("run") >= MIN_RUN))
    return out.select("doc_id", "item_id", "b.n_covered", "b.n_windows", "b.coverage", "b.changed_slots")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontamination": op2_decontamination}
ORACLE_SQL: dict[str, str] = {}
