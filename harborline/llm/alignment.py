"""Operator 11, alignment of two tokenizers by merge-path partitioning.

Each text is encoded twice, and the byte offsets at which the tokens end are
two sorted sequences.  Merging them shows which tokens overlap and where both
end.  The merge of a part of texts is cut along diagonals: a binary search on
each diagonal tells how many ends of either side lie before it, so every piece
has the same number of merge steps, whether the part is one text or thousands,
and can be merged without the others.  A piece gives its overlaps and the groups
that close in it; groups that run over an edge are stitched by running sums.

How often an id pair is linked in the whole corpus comes from sums per part,
added up by Spark.  A part then gets the counts of just its own pairs, so what
is exchanged is a row for each pair and part, not one for each link.

Defined results: a null or empty text, one that is no valid UTF-8, and one whose
joined token bytes differ from a space and the text (a text that holds U+2581,
say) have no tokens: zeros and an empty digest.  Repeated rows, also ones with
the same id, are separate texts, and each adds to the counts; a null id stays
null; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_and_text, materialise, table, text_parts

#: Text whose links are counted together.
PART_BYTES = 4 << 20
#: Texts are encoded in runs of about so many characters.
ENCODE_CHARS = 1 << 19
#: Merge steps of a piece.
PIECE = 1 << 16
#: An id pair is one number: A's id times this, plus B's.
SIDE = 1 << 20

COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long"
PARTS = f"part long, {COUNTS}, groups_sha256 string, links array<int>, pairs array<long>, n array<long>"
RESULT = f"{COUNTS}, n_best long, count_sum long, groups_sha256 string"


class ByteTokenizer:
    """Side A: byte-level BPE over a space and the text."""

    def __init__(self, vocabulary: str):
        import base64

        import public_tokenizers
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self.encoding.encode_ordinary(" " + t) for t in texts]


class PieceTokenizer:
    """Side B: pieces with byte fallback, which set a space before the text themselves."""

    def __init__(self, model: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.tokens = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@cache
def tokenizers(vocabulary_a: str | None, vocabulary_b: str | None) -> tuple[ByteTokenizer, PieceTokenizer]:
    import public_tokenizers

    a = ByteTokenizer(vocabulary_a or public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return a, PieceTokenizer(vocabulary_b or public_tokenizers.path("piece_bpe_32k.model"))


def decoded(texts: pa.Array) -> list[str]:
    """The texts as str; null and what is no UTF-8 become empty."""
    out = []
    for raw in texts.cast(pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()).to_pylist():
        try:
            out.append((raw or b"").decode())
        except UnicodeDecodeError:
            out.append("")
    return out


def encoded(texts: list[str], tok: ByteTokenizer | PieceTokenizer) -> list[np.ndarray]:
    """Ids of each text; none for a text that its tokens' bytes do not give back."""
    ids = tok.encode(texts)
    get = tok.tokens.__getitem__
    good = [bool(t) and b"".join(map(get, i)) == b" " + t.encode() for t, i in zip(texts, ids, strict=True)]
    return [np.array(i if g else [], np.int32) for i, g in zip(ids, good, strict=True)]


def runs_of(texts: list[str], chars: int) -> Iterator[list[str]]:
    run, size = [], 0
    for t in texts:
        run.append(t)
        size += len(t)
        if size >= chars:
            yield run
            run, size = [], 0
    if run:
        yield run


def split_merge(a: np.ndarray, b: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray]:
    """How many of the ends a and b lie before each diagonal; of equal ends a's comes first."""
    total = len(a) + len(b)
    d = np.append(np.arange(0, total, step), total)
    lo, hi = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        at = open_ & (a[np.minimum(mid, len(a) - 1)] <= b[np.clip(d - 1 - mid, 0, len(b) - 1)])
        lo = np.where(at, mid + 1, lo)
        hi = np.where(open_ & ~at, mid, hi)
    return lo, d - lo


def merge_piece(a: np.ndarray, b: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """One piece by itself; before is the a end just ahead of it.

    Returns for each a the number of b ends before it, which names the b that it
    meets; for each b the same of a; which b end where an a does; and for each a
    and b how many groups the piece closed before it.
    """
    of_a, of_b = np.searchsorted(b, a), np.searchsorted(a, b)
    common = np.zeros(len(b), bool)
    inner = of_b < len(a)
    common[inner] = a[of_b[inner]] == b[inner]
    if len(b):
        common[0] |= b[0] == before
    closed = np.concatenate([[0], np.cumsum(common)])
    return of_a, of_b, common, closed[of_a], closed[:-1]


def merge_ends(a: np.ndarray, b: np.ndarray, step: int = PIECE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(links as indices of a, links as indices of b, group of each a, group of each b).

    a and b hold increasing ends whose last are equal, so every token meets one.
    """
    if not len(a):
        none = np.zeros(0, np.int64)
        return none, none, none, none
    at_a, at_b = split_merge(a, b, step)
    link_a, link_b, group_a, group_b, groups = [], [], [], [], 0
    for i, i_end, j, j_end in zip(at_a[:-1], at_a[1:], at_b[:-1], at_b[1:], strict=True):
        of_a, of_b, common, closed_a, closed_b = merge_piece(a[i:i_end], b[j:j_end], a[i - 1] if i else -1)
        link_a += [np.arange(i, i_end), i + of_b[~common]]
        link_b += [j + of_a, np.arange(j, j_end)[~common]]
        group_a.append(groups + closed_a)
        group_b.append(groups + closed_b)
        groups += int(common.sum())
    return np.concatenate(link_a), np.concatenate(link_b), np.concatenate(group_a), np.concatenate(group_b)


@cache
def number_table(size: int) -> np.ndarray:
    """Row 0, 1, 2 and 3 of each id: its decimal digits with a comma, bar, semicolon or nothing after them."""
    return np.array([f"{i}{mark}" for i in range(size) for mark in (",", "|", ";", "")], "S12").view(np.uint8).reshape(-1, 12)


def group_digests(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, group_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, size: int) -> list[str]:
    """SHA-256 of each text's groups written out; the empty string for a text without tokens."""
    ids, group, side = np.concatenate([a, b]), np.concatenate([group_a, group_b]), np.repeat([0, 1], [len(a), len(b)])
    order = np.argsort(2 * group + side, kind="stable")
    ids, group, side = ids[order], group[order], side[order]
    last = np.append((group[1:] != group[:-1]) | (side[1:] != side[:-1]), True) if len(ids) else np.zeros(0, bool)
    mark = np.where(last, 1 + side, 0)
    ends = np.cumsum(n_a + n_b)
    mark[ends[(n_a + n_b) > 0] - 1] = 3
    cells = number_table(size)[ids * 4 + mark]
    used = cells != 0
    raw, off = memoryview(cells[used].tobytes()), np.concatenate([[0], np.cumsum(used.sum(1))])[np.concatenate([[0], ends])].tolist()
    return [hashlib.sha256(raw[s:e]).hexdigest() if e > s else "" for s, e in zip(off, off[1:], strict=False)]


def offsets(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)


def align_texts(texts: list[str], a_tok: ByteTokenizer, b_tok: PieceTokenizer, step: int = PIECE) -> dict[str, object]:
    """Token, group and link counts of each text, its digest, and its links as id pairs in the order of links_off."""
    a_ids, b_ids = [], []
    for run in runs_of(texts, ENCODE_CHARS):
        a, b = encoded(run, a_tok), encoded(run, b_tok)
        both = [len(x) and len(y) for x, y in zip(a, b, strict=True)]  # without one side's tokens there is no other
        a_ids += [x if w else x[:0] for x, w in zip(a, both, strict=True)]
        b_ids += [y if w else y[:0] for y, w in zip(b, both, strict=True)]
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_ids, b_ids))
    a, b = (np.concatenate([np.zeros(0, np.int32), *ids]).astype(np.int64) for ids in (a_ids, b_ids))
    lengths = [np.array([len(t) for t in tok.tokens], np.int64) for tok in (a_tok, b_tok)]
    link_a, link_b, group_a, group_b = merge_ends(np.cumsum(lengths[0][a]), np.cumsum(lengths[1][b]), step)
    doc = np.repeat(np.arange(len(texts)), n_a)[link_a]
    order = np.argsort(doc, kind="stable")
    starts = offsets(n_a)
    first = np.where(n_a > 0, group_a[np.minimum(starts[:-1], max(len(a) - 1, 0))] if len(a) else 0, 0)
    final = np.where(n_a > 0, group_a[np.maximum(starts[1:] - 1, 0)] if len(a) else -1, -1)
    return {
        "n_a": n_a,
        "n_b": n_b,
        "n_groups": np.where(n_a > 0, final - first + 1, 0),
        "n_links": np.bincount(doc, minlength=len(texts)),
        "groups_sha256": group_digests(a, b, group_a, group_b, n_a, n_b, max(len(a_tok.tokens), len(b_tok.tokens))),
        "pairs": (a[link_a] * SIDE + b[link_b])[order],
    }


def aligned_parts(docs: DataFrame, vocabulary_a: str | None = None, vocabulary_b: str | None = None, part_bytes: int = PART_BYTES, step: int = PIECE) -> DataFrame:
    """Rows of PARTS: one for each text, whose links are numbers of pairs, and one for each part (pairs not null) with its pairs and how often each is linked."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        toks = tokenizers(vocabulary_a, vocabulary_b)
        number = TaskContext.get().partitionId() << 32
        for part in text_parts(batches, part_bytes):
            out = align_texts(decoded(part.column("text")), *toks, step)
            coded = pa.array(out["pairs"]).dictionary_encode()
            codes = coded.indices.to_numpy(zero_copy_only=False)
            n = np.bincount(codes, minlength=len(coded.dictionary))
            rank = np.argsort(-n, kind="stable")  # frequent pairs have small numbers, which compress well
            place = np.empty(len(rank), np.int32)
            place[rank] = np.arange(len(rank), dtype=np.int32)
            rows = part.num_rows
            names = ["n_a", "n_b", "n_groups", "n_links"]
            counts = [pa.array(np.append(out[k], 0)) for k in names]
            links = pa.ListArray.from_arrays(pa.array(np.append(offsets(out["n_links"]), len(codes)).astype(np.int32)), pa.array(place[codes]))
            own = pa.array(np.repeat([0, len(n)], [rows + 1, 1]).astype(np.int32), mask=np.append(np.arange(rows + 1) < rows, False))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows + 1, number)), pa.concat_arrays([part.column("doc_id"), pa.nulls(1, pa.int64())]), *counts, pa.array([*out["groups_sha256"], ""]), links, pa.ListArray.from_arrays(own, coded.dictionary.take(pa.array(rank))), pa.ListArray.from_arrays(own, pa.array(n[rank]))],
                ["part", "doc_id", *names, "groups_sha256", "links", "pairs", "n"],
            )
            number += 1

    return docs.mapInArrow(align, PARTS)


def linked_pairs(parts: DataFrame) -> DataFrame:
    """(pair, links): how often each id pair is linked in the corpus, and best: whether no other pair of its B id is linked more often."""
    sums = parts.where("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "n")).alias("x")).groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.n").alias("links"))
    sums = materialise(sums)
    most = sums.groupBy(F.pmod("pair", F.lit(SIDE)).alias("b")).agg(F.max("links").alias("most"))
    return sums.withColumn("b", F.pmod("pair", F.lit(SIDE))).join(most, "b").select("pair", "links", (F.col("links") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary_a: str | None = None, vocabulary_b: str | None = None, part_bytes: int = PART_BYTES, step: int = PIECE) -> DataFrame:
    """One row per text: tokens of both sides, groups, links, and how common its links are in the corpus."""
    parts = materialise(aligned_parts(id_and_text(docs, id_col, text_col), vocabulary_a, vocabulary_b, part_bytes, step))
    own = parts.where("pairs IS NOT NULL").select("part", F.posexplode("pairs").alias("code", "pair"))
    known = own.join(linked_pairs(parts), "pair").select(F.col("part").alias("of_part"), "code", "links", "best")
    texts = parts.where("pairs IS NULL").drop("pairs", "n")

    def look_up(texts: pa.Table, known: pa.Table) -> pa.Table:
        links, best = np.zeros(known.num_rows, np.int64), np.zeros(known.num_rows, np.int64)
        code = known.column("code").to_numpy()
        links[code], best[code] = known.column("links").to_numpy(), known.column("best").to_numpy()
        each = texts.column("links").combine_chunks()
        codes, off = each.flatten().to_numpy(), offsets(texts.column("n_links").to_numpy())
        sums = {k: pa.array(np.diff(offsets(v[codes])[off])) for k, v in (("n_best", best), ("count_sum", links))}
        out = texts.drop_columns(["part", "links", "groups_sha256"])
        for k, v in sums.items():
            out = out.append_column(k, v)
        return out.append_column("groups_sha256", texts.column("groups_sha256"))

    return texts.groupBy("part").cogroup(known.groupBy("of_part")).applyInArrow(look_up, RESULT)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_documents(table(spark, sf_dir, "documents"))


QUERIES = {"op11_alignment": op11_alignment}
ORACLE_SQL: dict[str, str] = {}
