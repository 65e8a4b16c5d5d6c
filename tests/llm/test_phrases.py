import hashlib
import random
import re
from collections import Counter

from harborline.llm import phrases


def brute(docs, n=20):
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in docs}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - n + 1):
            first.setdefault(tuple(words[i][p : p + n]), (i, p))
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for p in range(len(w) - n + 1):
            if first[tuple(w[p : p + n])] < (i, p):
                gone[p : p + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check(spark, docs, parts=3):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(parts)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.remove_repeats(df).collect()}
    want = brute(docs)
    assert got == want, [(k, got.get(k), want[k]) for k in want if got.get(k) != want[k]][:4]
    return sum(x[1] for x in got.values())


def test_planted_passages(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 20_000)
    rnd = random.Random(2)
    word = lambda: rnd.choice("abcdefgh") + str(rnd.randrange(300))
    text = lambda n: [word() for _ in range(n)]
    passages = [text(n) for n in (19, 20, 21, 35, 60, 200)]
    docs = []
    for i in range(150):
        w = text(rnd.randrange(0, 60))
        for _ in range(rnd.randrange(4)):
            p = rnd.choice(passages)
            a = rnd.randrange(len(p))
            at = rnd.randrange(len(w) + 1)
            w[at:at] = p[a : a + rnd.randrange(1, 80)] if rnd.random() < 0.5 else p
        docs.append((rnd.randrange(10**6) * 1000 + i, rnd.choice([" ", "\n", " \t"]).join(w)))
    docs += [(10**10 + i, docs[3][1]) for i in range(5)] + [(5, docs[7][1])]
    docs += [(1, None), (2, ""), (3, "x " * 500), (4, "a b " * 100), (6, "\x1c\x85 é " * 40), (7, "same words " * 3)]
    assert check(spark, docs) > 1000


def test_small_tables(spark):
    assert phrases.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    t = " ".join(f"w{i}" for i in range(40))
    docs = spark.createDataFrame([(1, t, "x"), (1, t, "x"), (None, t, "y"), (2, t + " z", "y")], "doc_id long, text string, starts string")
    assert sorted((r.doc_id or 0, r.n_removed) for r in phrases.remove_repeats(docs).collect()) == [(0, 0), (1, 0), (1, 0), (2, 40)]


def test_the_automata_find_the_windows(spark, monkeypatch):
    rnd = random.Random(5)
    text = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    passage = text(40)
    docs = spark.createDataFrame([(i, f"{text(30)} {passage} {text(i)}") for i in range(6)], "doc_id long, text string")
    removed = lambda: sum(r.n_removed for r in phrases.remove_repeats(docs).collect())
    assert removed() == 200
    monkeypatch.setattr(phrases.Automaton, "occurrences", lambda self, w, which, distinct: __import__("numpy").zeros(len(which), bool))
    assert removed() == 0


def brute_rows(rows, n=20):
    """Over rows: documents of one id in the order of a hash of their texts; rows equal in both are one document."""
    import ctypes

    import xxhash

    order = lambda r: (r[0], ctypes.c_int64(xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42)).value)
    out, first = Counter(), {}
    words = {r: re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in set(rows)}
    for r in sorted(words, key=order):
        for p in range(len(words[r]) - n + 1):
            first.setdefault(tuple(words[r][p : p + n]), (order(r), p))
    for r in rows:
        w, gone = words[r], [False] * len(words[r])
        for p in range(len(w) - n + 1):
            if first[tuple(w[p : p + n])] < (order(r), p):
                gone[p : p + n] = [True] * n
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[r[0], len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_rows_that_repeat_an_id(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 1_500)
    rnd = random.Random(4)
    text = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    a, b, c, common = text(120), text(90), text(300), text(40)
    long = c + " " + common + " " + text(30)
    rows = [(3, a), (5, a), (5, b), (5, long), (1, " ".join(c.split()[60:160])), (7, b + " " + common), (7, common + " x"), (8, "short"), (8, text(70) + " " + common), (9, c), (9, c), (2, common), (11, long), (11, common + " " + c)]
    df = spark.createDataFrame([*rows, (None, a)], "doc_id long, text string").repartition(4)
    got = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in phrases.remove_repeats(df).collect() if r.doc_id is not None)
    assert got == brute_rows(rows)


def test_one_passage_in_every_document_at_tiny_sizes(spark, monkeypatch):
    monkeypatch.setattr(phrases, "SHARD_BYTES", 900)
    rnd = random.Random(5)
    text = lambda n: " ".join(f"w{rnd.randrange(5000)}" for _ in range(n))
    passage = text(45)
    assert check(spark, [(i, f"{text(rnd.randrange(30))} {passage} {text(rnd.randrange(30))}") for i in range(200)], 7) >= 199 * 45
