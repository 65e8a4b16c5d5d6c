"""Operator 9, quality rules: how much of a text lies in its own repetitions.

Rolling hashes of several n-gram lengths over the words of a text (numpy, a
batch of texts at once) tell which n-grams occur twice or more in the same
text; the measure is the share of the text's characters inside them, and the
share inside lines that repeat an earlier line.  No rows move: the operator is
a map over the partitions of the scan.

Defined results: a null or empty text has no words, all counts are 0 and it
fails; repeated rows are judged one by one; an empty table gives an empty one;
other columns of the input are left alone (``filter_documents``) or not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Words, covered, id_and_text, mix, per_row, repeated, rolling, table, text_bytes, text_parts

#: The largest share of a text's word characters inside repeated n-grams, by n.
MAX_NGRAM_COVERAGE = {4: 0.45, 6: 0.42, 8: 0.40, 10: 0.38}
#: The largest share of lines, and of word characters in lines, that repeat an earlier line.
MAX_DUP_LINES, MAX_DUP_LINE_CHARS = 0.30, 0.25
#: A line or two that comes again, a heading say, is no fault of a short text.
FEW_DUP_LINES = 2
#: The largest number of symbols per word.
MAX_SYMBOLS_PER_WORD = 0.25
MIN_WORDS = 50
PART_BYTES = 2 << 20

SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, n_lines long, dup_line_chars long, " + ", ".join(f"dup_chars_{n} long" for n in MAX_NGRAM_COVERAGE)


def _lines(data: np.ndarray, off: np.ndarray, words: Words, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: lines with a word; those that equal an earlier one; word characters in the latter."""
    rows = len(off) - 1
    breaks = np.flatnonzero(data == 10)
    starts = np.unique(np.concatenate([off[:-1], breaks + 1]))
    starts = starts[starts < len(data)]
    row = np.searchsorted(off, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(data)), off[row + 1])
    has = np.searchsorted(words.start, starts) < np.searchsorted(words.start, ends)
    starts, ends, row = starts[has], ends[has], row[has]
    keep = data != 10
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    # the bytes of wordless lines between two lines must not count: copy line by line through a mask
    inside = covered_ranges(starts, ends, len(data)) & keep
    lens = kept[ends] - kept[starts]
    loff = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=loff[1:])
    text = np.ascontiguousarray(data[inside])
    coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lens), [None, pa.py_buffer(loff), pa.py_buffer(text)]).dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    key = row * (len(coded.dictionary) + 1) + ids
    order = np.argsort(key, kind="stable")
    again = np.zeros(len(key), bool)
    again[order[1:]] = key[order[1:]] == key[order[:-1]]
    c = np.zeros(len(data) + 1, np.int64)
    np.cumsum(chars, out=c[1:])
    line_chars = c[ends] - c[starts]
    return np.bincount(row, minlength=rows), np.bincount(row[again], minlength=rows), np.bincount(row[again], weights=line_chars[again], minlength=rows).astype(np.int64)


def covered_ranges(starts: np.ndarray, ends: np.ndarray, total: int) -> np.ndarray:
    d = np.zeros(total + 1, np.int32)
    np.add.at(d, starts, 1)
    np.add.at(d, ends, -1)
    return np.cumsum(d[:-1]) > 0


def measure(texts: pa.Array) -> dict[str, np.ndarray]:
    """The counts of SCHEMA for each text of an Arrow array."""
    data, off = text_bytes(texts)
    w = Words(data, off)
    chars = w.inside & ((data & 0xC0) != 0x80)
    symbols = np.isin(data, np.frombuffer(b"#*$%&|<>", np.uint8))
    cc = np.zeros(len(data) + 1, np.int64)
    np.cumsum(chars, out=cc[1:])
    chars_of_word = cc[w.end] - cc[w.start]
    ids, _ = w.encoded()
    values = mix(ids + 1)
    salt = mix(np.arange(len(off) - 1) + 1)[w.doc] if len(w.doc) else np.zeros(0, np.uint64)
    out = {"n_words": w.counts, "word_chars": per_row(chars, off), "n_symbols": per_row(symbols, off)}
    for n in (3, *MAX_NGRAM_COVERAGE):
        h = rolling(values, n)
        at = np.flatnonzero(w.doc[: len(h)] == w.doc[n - 1 :]) if len(h) else np.zeros(0, np.int64)
        hit = at[repeated(mix(h[at]) ^ salt[at])]
        mask = covered(hit, n, len(w.doc))
        if n == 3:
            out["n_repeat_words"] = per_row(mask, w.first)
        else:
            out[f"dup_chars_{n}"] = per_row(np.where(mask, chars_of_word, 0), w.first)
    out["n_lines"], out["n_dup_lines"], out["dup_line_chars"] = _lines(data, off, w, chars)
    return out


def verdict(m: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(fails the base rules, is kept)."""
    n = m["n_words"]
    base = (n < MIN_WORDS) | (100 * m["n_repeat_words"] > 50 * n)
    bad = base.copy()
    for k, most in MAX_NGRAM_COVERAGE.items():
        bad |= m[f"dup_chars_{k}"] > most * m["word_chars"]
    lines = (m["n_dup_lines"] > MAX_DUP_LINES * m["n_lines"]) | (m["dup_line_chars"] > MAX_DUP_LINE_CHARS * m["word_chars"])
    bad |= lines & (m["n_dup_lines"] > FEW_DUP_LINES)
    bad |= m["n_symbols"] > MAX_SYMBOLS_PER_WORD * n
    return base, ~bad


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in text_parts(batches, PART_BYTES):
        m = measure(part.column("text"))
        m["base_failed"], m["kept"] = verdict(m)
        names = [x.split()[0] for x in SCHEMA.split(", ")[1:]]
        yield pa.RecordBatch.from_arrays([part.column("doc_id"), *(pa.array(m[k]) for k in names)], ["doc_id", *names])


def quality_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the measures and the verdict."""
    return id_and_text(docs, id_col, text_col).mapInArrow(_map, SCHEMA)


def filter_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text passes, with all their columns."""
    schema = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, masks = pa.record_batch([batch.column(text_col).cast(pa.string())], ["text"]), []
            for part in text_parts(iter([at]), PART_BYTES):
                masks.append(verdict(measure(part.column("text")))[1])
            yield batch.filter(pa.array(np.concatenate(masks) if masks else np.zeros(0, bool)))

    return docs.mapInArrow(keep, schema)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"))


QUERIES = {"op9_quality_rules": op9_quality_rules}
ORACLE_SQL: dict[str, str] = {}
