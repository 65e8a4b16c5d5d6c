"""Operator 1, packing by best-fit decreasing.

Documents become token ids, overlong ones are cut into full windows first, and
the pieces are packed into windows of ``window`` tokens: longest piece first,
each into the open window with the least room that still holds it.  A segment
tree over remaining capacities finds that window in a dozen steps.

Two maps around one exchange: the first tokenizes (each distinct word of a
batch once), the second packs.  Packing goes on in each partition by itself;
partitions are large (PACK_BYTES of text, some hundred windows), so the few
windows left open at the end of each are the only loss.  Pieces are dealt by
a hash of document and start, and sorted by Spark, which can spill; the packer
itself keeps one number per open window.

Defined results: a null or empty text is the single end token; a document whose
ids fill its windows exactly leaves no rest; repeated rows are packed
separately; an empty table gives no pieces; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import Words, id_and_text, table, text_bytes, text_parts, total_bytes

WINDOW = 4096
END_ID = 2
#: Bytes of text whose pieces one packing task gets.
PACK_BYTES = 16 << 20
PART_BYTES = 8 << 20
#: Distinct words that a Python worker keeps the ids of.
CACHE_WORDS = 400_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"

#: A word that normalisation only lower-cases, with at most one full stop or comma after it.
PLAIN = re.compile(rb"([A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+[.,]?")


def byte_alphabet() -> list[str]:
    """The printable character that byte-level BPE puts in place of each byte."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in shown else next(free)) for b in range(256)]


class WordTokenizer:
    """Ids of white-space separated words under a word BPE vocabulary file.

    No pattern of that vocabulary reaches over white space, so a text's ids are
    its words' ids one after the other.  Plain words go straight to the BPE
    model, after lower-casing; all others through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.bpe = self.whole.model
        self.signs = byte_alphabet()
        self.cache: dict[bytes, np.ndarray] = {}
        self.mark = {b: self._model(b) for b in (b".", b",")}

    def _model(self, word: bytes) -> list[int]:
        return [t.id for t in self.bpe.tokenize("".join([self.signs[b] for b in word]))]

    def word(self, w: bytes) -> list[int]:
        if PLAIN.fullmatch(w):
            tail = self.mark.get(w[-1:], [])
            return self._model((w[:-1] if tail else w).decode().lower().encode()) + tail
        return self.whole.encode(w.decode(), add_special_tokens=False).ids

    def words(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets) of the distinct words."""
        if len(self.cache) > CACHE_WORDS:
            self.cache.clear()
        get, out = self.cache.get, []
        for w in distinct.to_pylist():
            ids = get(w)
            if ids is None:
                ids = self.cache[w] = np.array(self.word(w), np.uint32)
            out.append(ids)
        off = np.zeros(len(out) + 1, np.int64)
        np.cumsum([len(x) for x in out], out=off[1:])
        return (np.concatenate(out) if out else np.zeros(0, np.uint32)), off


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def token_ids(texts: pa.Array, tok: WordTokenizer, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts with the end id after each, offsets by text)."""
    w = Words(*text_bytes(texts))
    which, distinct = w.encoded()
    flat, off = tok.words(distinct)
    lens = np.diff(off)[which] if len(which) else np.zeros(0, np.int64)
    ends = np.cumsum(lens)
    total = int(ends[-1]) if len(ends) else 0
    place = np.arange(total) - np.repeat(ends - lens, lens) + np.repeat(off[which], lens)
    ids = flat[place] if total else np.zeros(0, np.uint32)
    edge = np.concatenate([[0], ends])[w.first]
    return np.insert(ids, edge[1:], np.uint32(end_id)), edge + np.arange(len(edge))


def cut_documents(docs: DataFrame, vocabulary: str | None = None, window: int = WINDOW, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """One row per piece: full windows and the rest of each document; with_ids adds the ids themselves."""
    schema = PIECES + (", ids array<int>" if with_ids else "")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import public_tokenizers

        tok = tokenizer(vocabulary or public_tokenizers.path("word_bpe_49k.json"))
        for part in text_parts(batches, PART_BYTES):
            ids, off = token_ids(part.column("text"), tok, end_id)
            ids = ids.astype("<u4")
            total = np.diff(off)
            n = -(-total // window)
            row = np.repeat(np.arange(len(n)), n)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * window
            length = np.minimum(window, total[row] - start)
            at = off[row] + start
            raw = memoryview(ids.tobytes())
            crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist(), strict=True)]
            columns = [part.column("doc_id").take(pa.array(row)), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array(total[row], pa.int64())]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(ids.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(cut, schema)


class OpenWindows:
    """Open windows by remaining room, under a segment tree that finds the tightest fit."""

    def __init__(self, window: int):
        self.size = 1 << window.bit_length()
        self.any = bytearray(2 * self.size)  # a node is 1 if some window below it is open
        self.open: dict[int, list[tuple[int, int]]] = {}

    def add(self, room: int, sequence: int, offset: int) -> None:
        if room:
            self.open.setdefault(room, []).append((sequence, offset))
            node = room + self.size
            while node and not self.any[node]:
                self.any[node] = 1
                node >>= 1

    def tightest(self, need: int) -> tuple[int, int, int] | None:
        """Takes out the open window of least room >= need: (room, sequence, offset)."""
        node, held = need + self.size, self.any
        while not held[node]:
            while node & 1:  # a right child: its parent's right neighbour is next
                node >>= 1
            if not node:
                return None
            node += 1
            if not node & (node - 1):  # past the last node of its level
                return None
        while node < self.size:
            node = 2 * node if held[2 * node] else 2 * node + 1
        room = node - self.size
        found = self.open[room].pop()
        if not self.open[room]:
            held[node] = 0
            node >>= 1
            while node:
                held[node] = held[2 * node] | held[2 * node + 1]
                if held[node]:
                    break
                node >>= 1
        return room, *found


def best_fit(window: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    def pack(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        fresh = TaskContext.get().partitionId() << 36
        windows = OpenWindows(window)
        for frame in frames:
            sequences, offsets = [], []
            for n in frame["length"].tolist():
                fit = windows.tightest(n)
                room, sequence, offset = fit or (window, fresh, 0)
                fresh += fit is None
                sequences.append(sequence)
                offsets.append(offset)
                windows.add(room - n, sequence, offset + n)
            yield frame.assign(sequence_id=np.array(sequences, np.int64), offset=np.array(offsets, np.int64))

    return pack


def pack_pieces(pieces: DataFrame, partitions: int, window: int = WINDOW) -> DataFrame:
    """Adds sequence_id and offset to pieces of at most ``window`` tokens."""
    dealt = pieces.repartition(partitions, "doc_id", "start").sortWithinPartitions(pieces["length"].desc(), "doc_id", "start")
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes) + ", sequence_id long, offset long"
    return dealt.mapInPandas(best_fit(window), schema)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their place in the packed sequences."""
    docs = id_and_text(docs, id_col, text_col)
    partitions = max(1, math.ceil(total_bytes(docs) / PACK_BYTES))
    return pack_pieces(cut_documents(docs, vocabulary, window, with_ids=with_ids), partitions, window)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op1_packing": op1_packing}
ORACLE_SQL: dict[str, str] = {}
