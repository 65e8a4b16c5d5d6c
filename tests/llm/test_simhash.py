import random
import re

import numpy as np
import pytest
import xxhash

from harborline.llm import simhash
from harborline.llm.components import connected_components


def brute_print(text, k=3):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    s = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def brute_components(prints, radius=2):
    least = {i: i for i, _ in prints}
    changed = True
    while changed:
        changed = False
        for i, a in prints:
            for j, b in prints:
                if (a ^ b).bit_count() <= radius and least[j] < least[i]:
                    least[i] = least[j]
                    changed = True
    return least


def test_documents_against_brute_force(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice(["alpha", "beta", "Gamma", "delté", "the", "of"]) + str(rnd.randrange(50)) for _ in range(n)) for n in (1, 2, 3, 4, 40, 300)]
    texts = base * 3 + [b + " end" for b in base] + ["", None, " \n ", "x" * 5000, "A B", "a b", "a\xa0b c d"]
    docs = spark.createDataFrame([(1000 - i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, component_id string")
    rows = simhash.near_duplicates(docs).collect()
    want = {1000 - i: brute_print(t) for i, t in enumerate(texts)}
    assert {r.doc_id: int(r.fingerprint, 16) for r in rows} == want and all(len(r.fingerprint) == 16 for r in rows)
    least = brute_components(list(want.items()))
    assert {r.doc_id: r.component_id for r in rows} == least


@pytest.mark.parametrize("shard", [12_000, 60])
def test_links_against_brute_force(spark, shard):
    rng = np.random.default_rng(4)
    centres = rng.integers(0, 2**63, 300, dtype=np.uint64)
    flips = [c ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for c in centres[:40] for a, b in rng.integers(0, 64, (4, 2))]
    tight = [np.uint64(0xFFFF0000) ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(30) for b in range(30)]
    prints = [(i, int(x)) for i, x in enumerate([*centres, *flips, *tight])]
    signed = [(i, x - (1 << 64) if x >> 63 else x) for i, x in prints]
    got = simhash.components(spark.createDataFrame(signed, "doc_id long, fp long"), shard=shard).collect()
    assert {r.doc_id: r.component_id for r in got} == brute_components(prints)


def test_empty_and_chain(spark):
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    chain = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101)], "a long, b long")
    assert {(r.node, r.root) for r in connected_components(chain).collect()} == {(i, 0) for i in range(61)} | {(100, 100), (101, 100)}


def test_dense_ball_gives_few_links():
    ball = np.array([(1 << a) | (1 << b) for a in range(64) for b in range(a)], np.uint64)
    a, b = simhash.blocked_links(ball, 2, block=256)
    assert len(a) < 5 * len(ball)
    assert set(simhash.spanning(len(ball), a, b).tolist()) == {0}
    two = np.concatenate([ball, ~ball])
    assert len(set(simhash.spanning(len(two), *simhash.near_links(two, 2)).tolist())) == 2
