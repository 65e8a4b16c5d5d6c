import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from harborline.llm import alignment


@pytest.fixture(scope="module")
def sides():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def brute(texts, sides):
    """Per text (n_a, n_b, n_groups, n_links, n_best, count_sum, digest), by comparing all tokens of both sides byte by byte."""
    a_tok, b_tok = sides
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(x for x in range(256) if x not in shown)}
    docs, links = [], []
    for t in texts:
        a = [(i, bytes(byte_of[c] for c in a_tok.id_to_token(i))) for i in a_tok.encode(" " + t, add_special_tokens=False).ids] if t else []
        b = [(i, bytes([int(p[3:5], 16)]) if b_tok.is_byte(i) else p.replace("▁", " ").encode()) for i in b_tok.encode(t) for p in [b_tok.id_to_piece(i)]] if t else []
        if any(b"".join(x for _, x in side) != (" " + (t or "")).encode() for side in (a, b)):
            a, b = [], []
        ends = [list(np.cumsum([len(x) for _, x in side])) for side in (a, b)]
        of_byte = [[i for i, (_, x) in enumerate(side) for _ in x] for side in (a, b)]
        pairs = sorted(set(zip(*of_byte, strict=True)))
        links.append([(a[i][0], b[j][0]) for i, j in pairs])
        cuts = sorted(set(ends[0]) & set(ends[1]))
        groups = []
        for lo, hi in zip([0, *cuts], cuts, strict=False):
            groups.append("|".join(",".join(str(k) for (k, _), e in zip(side, end, strict=True) if lo < e <= hi) for side, end in zip((a, b), ends, strict=True)))
        docs.append([len(a), len(b), len(groups), len(pairs), hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""])
    count = Counter(x for d in links for x in d)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return [(*d[:4], sum(count[x] == most[x[1]] for x in own), sum(count[x] for x in own), d[4]) for d, own in zip(docs, links, strict=True)]


def rows(df):
    return sorted((r.doc_id, r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in df.collect())


def random_texts(n, seed):
    rnd = random.Random(seed)
    bits = ["the ", "harbour", "Straße", " \n\n", "   ", "42", "3.14", "日本", "🚢", "é", "<|endoftext|>", "<s>", "<unk>", "<0x0A>", "\t", " ", "antidisestablishment", "!!!", "'s", "\x00"]
    return ["".join(rnd.choice(bits) for _ in range(rnd.randrange(40))) for _ in range(n)]


@pytest.mark.parametrize(("part_bytes", "step"), [(4 << 20, 1 << 16), (500, 7), (1, 1)])
def test_equals_brute_force(spark, sides, part_bytes, step):
    texts = [*random_texts(120, 3), None, "", " ", "a▁b", "x" * 5000, "word " * 3000, "word " * 3000, "▁"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = rows(alignment.align_documents(df, part_bytes=part_bytes, step=step))
    assert got == [(i, *x) for i, x in enumerate(brute(texts, sides))]


def test_query_over_a_table(spark, sides):
    sf = "/root/testdata/sf0.001"
    docs = sorted(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    want = [(d.doc_id, *x) for d, x in zip(docs, brute([d.text for d in docs], sides), strict=True)]
    assert rows(alignment.op11_alignment(spark, sf)) == want


def test_defined_results(spark):
    nothing = (0, 0, 0, 0, 0, 0, "")
    docs = spark.createDataFrame([(1, "one text", "x"), (1, "one text", "y"), (None, "other", "z"), (2, None, None)], "doc_id long, text string, pairs string")
    out = sorted(alignment.align_documents(docs).collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    assert [r.doc_id for r in out] == [1, 1, 2, None] and out[0] == out[1] and tuple(out[2])[1:] == nothing
    assert out[0].count_sum == 2 * out[0].n_links
    broken = spark.sql("SELECT 7L doc_id, CAST(X'61FF62' AS STRING) text")
    assert tuple(alignment.align_documents(broken).head()) == (7, *nothing)
    assert alignment.align_documents(docs.limit(0)).count() == 0


def test_pieces_have_equal_work():
    rnd = np.random.default_rng(1)
    a, b = (np.append(np.unique(rnd.integers(1, 50_000, n)), 50_000) for n in (9000, 300))
    i, j = alignment.split_merge(a, b, 128)
    assert set(np.diff(i + j)[:-1].tolist()) == {128}
    for x, y in zip(i, j, strict=True):  # what lies before a diagonal comes before what lies after it
        assert x == 0 or y == len(b) or a[x - 1] <= b[y]
        assert y == 0 or x == len(a) or b[y - 1] < a[x]
