import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from harborline.llm import packing

TEXTS = ["", None, "Hello, World. naïve café ÉTÉ", "it's don't x.y,z  a,b. étude x y", "word " * 9000, "Ünïcode ß ÿ × ÷ ≠ 12345 !!! ...", "a." * 50, "\x01\x02 \x0b x \x85 y", "日本語 テスト", "same", "same"]


def expected(texts):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return [[*t.encode(x or "", add_special_tokens=False).ids, 2] for x in texts]


def test_pieces_cover_each_document(spark):
    docs = spark.createDataFrame([(i, x, "clash") for i, x in enumerate(TEXTS)], "doc_id long, text string, offset string")
    rows = packing.pack_documents(docs, with_ids=True).collect()
    want = expected(TEXTS)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert r.length == len(r.ids) and r.doc_tokens == len(want[r.doc_id])
    for i, ids in enumerate(want):
        own = sorted(by_doc[i], key=lambda r: r.start)
        assert [r.start for r in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert [x for r in own for x in r.ids] == ids
    for own in by_sequence.values():
        own.sort(key=lambda r: r.offset)
        assert [r.offset for r in own] == [sum(q.length for q in own[:k]) for k in range(len(own))]
        assert sum(r.length for r in own) <= 4096


def test_empty_table(spark):
    assert packing.pack_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=60))
def test_tightest_fit_is_the_smallest_room_that_holds(lengths):
    windows, rooms, fresh = packing.OpenWindows(40), [], 0
    for n in sorted(lengths, reverse=True):
        fit = windows.tightest(n)
        able = sorted(r for r in rooms if r >= n)
        assert (fit[0] if fit else None) == (able[0] if able else None)
        if fit:
            rooms.remove(fit[0])
        room = (fit[0] if fit else 40) - n
        windows.add(room, fresh, 0)
        fresh += 1
        rooms += [room] * (room > 0)


@settings(max_examples=40, deadline=None)
@given(st.text(max_size=60))
def test_words_give_the_whole_text_s_ids(text):
    import pyarrow as pa

    text = text.encode("utf-8", "ignore").decode()
    tok = packing.tokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ids, _ = packing.token_ids(pa.array([text]), tok, 2)
    if "<|" not in text:
        assert ids.tolist() == expected([text])[0]


@pytest.fixture(scope="module", autouse=True)
def _fresh():
    yield
    packing._TOKENIZERS.clear()
