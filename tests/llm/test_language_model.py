import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from harborline.llm import language_model as lm


def brute(docs):
    toks = {}
    for i, t in docs:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        toks[i] = [*re.findall(r"[^\x20\x09-\x0D]+", low), None]
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in toks}
    c = Counter(w for i, ws in toks.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    return {i: (held[i], len(ws), sum(c[w] > 0 for w in ws), n, sum(math.log10((c[w] + 1) / (n + 1 * (v + 1))) for w in ws)) for i, ws in toks.items()}


def corpus(n=220):
    rnd = random.Random(8)
    kinds = [["the", "house", "and", "mouse", "since", "dance"], ["der", "hammer", "und", "sommer", "immer", "kind"]]
    docs = [(i, " ".join(rnd.choice(kinds[i % 2]) + rnd.choice(["", "", "", str(rnd.randrange(40))]) for _ in range(rnd.randrange(60)))) for i in range(n)]
    return [*docs, (1000, None), (1001, ""), (1002, "Ünseen WORDS only xyzzy"), (1003, "the " * 20_000)]


def scores(spark, docs, **sizes):
    df = spark.createDataFrame([(i, t, 1.0) for i, t in docs], "doc_id long, text string, score double").repartition(3)
    return {r.doc_id: r for r in lm.score_documents(df, **sizes).collect()}


@pytest.mark.parametrize("sizes", [{}, {"part_bytes": 20_000, "bucket_bytes": 9_000}])
def test_counts_and_held_out_gain(spark, sizes):
    docs = corpus()
    rows, want = scores(spark, docs, **sizes), brute(docs)
    assert set(rows) == set(want)
    for i, (held, n_tokens, n_known, n, base) in want.items():
        r = rows[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held, n_tokens, n_known, n)
        assert r.base_score == pytest.approx(base, rel=1e-9)
        assert r.score < 0
    held = [r for r in rows.values() if r.held_out and r.n_tokens > 5]
    assert sum(r.score for r in held) / sum(r.base_score for r in held) < 0.9


def test_frequent_words_are_spread_and_scores_hardly_change(spark):
    docs = corpus(400)
    one, many = scores(spark, docs), scores(spark, docs, bucket_bytes=7_000)
    spread = lm.frequent_words(spark.createDataFrame(docs, "doc_id long, text string"), 40_000, 6)
    assert spread and max(spread.values()) > 1
    n = sum(r.n_tokens for r in one.values())
    assert sum(abs(one[i].score - many[i].score) for i in one) / n < 0.02


def tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower()), lm.END]


def test_exact_where_nothing_is_left_to_chance(spark):
    """No pair and no word comes twice, so every table is known."""
    docs = [(i, " ".join(f"w{i}x{k}" for k in range(9))) for i in range(60)]
    rows = scores(spark, docs)
    train = [tokens(t) for i, t in docs if not lm.held_out(i)]
    pairs = Counter((a, b) for ws in train for a, b in zip([lm.START, *ws], ws, strict=False))
    assert set(pairs.values()) == {1}
    after, root = Counter(a for a, _ in pairs), Counter(b for _, b in pairs)
    d, s, v = 0.95, lm.STRENGTH, len(root)
    # the end token follows every last word: its customers at the root have one or few tables
    d0 = (v - 1) / (v - 1)
    d0 = min(d0, 0.95)
    got = []
    for tables in range(1, 6):
        total_c, total_t = sum(root.values()), v - 1 + tables

        def p(a, b, total_c=total_c, total_t=total_t, tables=tables):
            held = root[b] - d0 * (tables if b == lm.END else 1) if b in root else 0
            top = (held + (s + d0 * total_t) / (v + 1)) / (s + total_c)
            own = (1 - d if (a, b) in pairs else 0) + (s + d * after[a]) * top
            return own / (s + after[a])

        got.append({i: sum(math.log10(p(a, b)) for a, b in zip([lm.START, *tokens(t)], tokens(t), strict=False)) for i, t in docs})
    for i, r in rows.items():
        assert min(g[i] for g in got) - 0.02 < r.score < max(g[i] for g in got) + 0.02


def plain_sampler(train, d, d0, sweeps, rnd):
    """Chinese-restaurant seating by the book: one customer at a time gets up and sits down."""
    s, seats, root = lm.STRENGTH, {}, {}
    words = {w for ws in train for w in ws}
    base = 1 / (len(words) + 1)
    count = lambda tables, w: sum(tables.get(w, ()))
    total = lambda r: (sum(map(sum, r.values())), sum(map(len, r.values())))

    def prob(r, w, parent, d):
        c, t = total(r)
        return (max(count(r, w) - d * len(r.get(w, ())), 0) + (s + d * t) * parent) / (s + c)

    def sit(r, w, parent, d):
        _, t = total(r)
        weights = [x - d for x in r.setdefault(w, [])] + [(s + d * t) * parent]
        k = rnd.choices(range(len(weights)), weights)[0]
        if k == len(r[w]):
            r[w].append(1)
            return True
        r[w][k] += 1
        return False

    def rise(r, w):
        k = rnd.choices(range(len(r[w])), r[w])[0]
        r[w][k] -= 1
        if not r[w][k]:
            r[w].pop(k)
            return True
        return False

    pairs = [(a, b) for ws in train for a, b in zip([lm.START, *ws], ws, strict=False)]
    for a, b in pairs:
        if sit(seats.setdefault(a, {}), b, prob(root, b, base, d0), d):
            sit(root, b, base, d0)
    mean = Counter()
    every = {(a, b) for a in [*words, lm.START] for b in words}
    for k in range(sweeps):
        for a, b in pairs:
            if rise(seats[a], b):
                rise(root, b)
            if sit(seats[a], b, prob(root, b, base, d0), d):
                sit(root, b, base, d0)
        if k >= sweeps // 2:
            for a, b in every:
                mean[a, b] += prob(seats.get(a, {}), b, prob(root, b, base, d0), d) / (sweeps - sweeps // 2)
    return mean


def test_against_a_plain_sampler(spark):
    rnd = random.Random(11)
    lexicon = [f"w{k}" for k in range(14)]
    docs = [(i, " ".join(rnd.choices(lexicon, [1 / (k + 1) for k in range(14)])[0] for _ in range(rnd.randrange(3, 15)))) for i in range(40)]
    train = [tokens(t) for i, t in docs if not lm.held_out(i)]
    pairs = Counter((a, b) for ws in train for a, b in zip([lm.START, *ws], ws, strict=False))
    root = Counter(b for _, b in pairs)
    few = lambda c: lm._discount(sum(x == 1 for x in c.values()), sum(x == 2 for x in c.values()))
    mean = plain_sampler(train, few(pairs), few(root), 60, rnd)
    rows = scores(spark, docs, sweeps=12)
    known = [i for i, t in docs if set(tokens(t)) <= set(root)]
    want = {i: sum(math.log10(mean[a, b]) for a, b in zip([lm.START, *tokens(t)], tokens(t), strict=False)) for i, t in docs if i in known}
    gap = [(rows[i].score - want[i]) / rows[i].n_tokens for i in known]
    assert len(known) > 30 and max(map(abs, gap)) < 0.06 and abs(sum(gap) / len(gap)) < 0.02


def test_predictive_probabilities_sum_to_one():
    docs = pa.table({"doc_id": pa.array(range(200), pa.int64()), "text": [t for _, t in corpus(196)]})
    grid = lm.Grid(1, {})
    b = lm.Bucket(lm.ask(grid)((pa.scalar(0),), docs), grid)
    for turn in range(2):
        b.learn(b.tell(), [*b.sums(), 0.0])
        if not turn:
            b.seat(np.random.default_rng(0))
        for k in range(3):
            b.sweep(np.random.default_rng(k))
    assert (b.seats.t == [np.count_nonzero(b.seats.size[s : s + n]) for s, n in zip(b.seats.start, b.seats.cap, strict=True)]).all()
    assert (b.seats.c == b.c[b.many]).all() and b.root_c.sum() == b.t.sum() == b.tables.sum()
    root = b.root()
    unknown = (lm.STRENGTH + b.root_d * b.all_t) / (b.types + 1) / (lm.STRENGTH + b.all_c)
    assert root[b.seen > 0].sum() + unknown == pytest.approx(1, abs=1e-9)
    for v in range(0, len(b.contexts), 7):
        own = b.v == v
        back = (lm.STRENGTH + b.d * b.tables[v]) / (lm.STRENGTH + b.customers[v])
        seated = np.maximum(b.c - b.d * b.t, 0)[own].sum() / (lm.STRENGTH + b.customers[v])
        assert seated + back == pytest.approx(1, abs=1e-9)


def test_empty_table(spark):
    assert lm.score_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = lm.score_documents(spark.createDataFrame([(None, "a b"), (7, None), (7, None)], "doc_id long, text string")).collect()
    assert sorted(r.n_tokens for r in one) == [1, 1, 3]


def mean_tables(c, others, p, d):
    """Mean number of tables of c customers, summed over all ways to sit down one after another."""
    ways = np.full(c + 2, -np.inf)
    ways[1] = 0
    t = np.arange(c + 2)
    opening = np.log((lm.STRENGTH + d * (others + t)) * p)
    for k in range(1, c):
        stay = ways + np.log(np.maximum(k - d * t, 1e-300))
        ways = np.logaddexp(stay, np.concatenate([[-np.inf], (ways + opening)[:-1]]))
    share = np.exp(ways - ways.max())
    return (share * t).sum() / share.sum()


@pytest.mark.parametrize("whole", [2000, 512, 50])
def test_all_customers_of_a_frequent_dish_move(monkeypatch, whole):
    """Tables of a pair seen 900 times, after the first sweeps and later, have the mean that their exact distribution has."""
    monkeypatch.setattr(lm, "WHOLE", whole, raising=False)
    after, before = " ".join(f"a x{k}" for k in range(60)), " ".join(f"r{k} b" for k in range(400))
    docs = pa.table({"doc_id": pa.array([0, 3, 4], pa.int64()), "text": ["a b " * 900, after, before]})
    assert not any(map(lm.held_out, (0, 3, 4)))
    early, later, exact = [], [], []
    for seed in range(6):
        grid = lm.Grid(1, {})
        b = lm.Bucket(lm.ask(grid)((pa.scalar(0),), docs), grid)
        b.learn(b.tell(), [*b.sums(), 0.0])
        b.seat(np.random.default_rng([seed, 99]))
        at = [i for i in np.flatnonzero(b.c > 800) if b.contexts[b.v[i]] == lm._hash(b"a")][0]
        for k in range(8):
            b.sweep(np.random.default_rng([seed, k]))
            (early if k < 3 else later).append(b.t[at])
            exact.append(mean_tables(int(b.c[at]), b.tables[b.v[at]] - b.t[at], b.root()[b.w[at]], b.d))
    assert np.mean(early) == pytest.approx(np.mean(exact), rel=0.2)
    assert np.mean(later) == pytest.approx(np.mean(exact), rel=0.2)


@pytest.mark.parametrize(("c", "p"), [(2, 0.3), (9, 0.02), (300, 0.2)])
def test_tables_are_drawn_from_their_exact_distribution(c, p):
    n, d, others = 4000, 0.7, 30.0
    drawn = lm.draw_tables(np.full(n, c), np.full(n, others), np.full(n, p), d, lm.opening_ratios(c, d), np.random.default_rng(1))
    assert drawn.mean() == pytest.approx(mean_tables(c, others, p, d), rel=0.02)


@pytest.mark.parametrize(("c", "p", "d"), [(600, 0.001, 0.7), (600, 0.2, 0.7), (600, 0.9, 0.95), (3000, 0.5, 0.3)])
def test_tables_of_a_frequent_dish_are_drawn_from_their_exact_distribution(c, p, d):
    rng = np.random.default_rng(2)
    assert np.mean([lm.draw_frequent(c, 30.0, p, d, rng) for _ in range(1500)]) == pytest.approx(mean_tables(c, 30.0, p, d), rel=0.02)


@pytest.mark.parametrize("d", [0.05, 0.5, 0.83, 0.95])
@pytest.mark.parametrize("c", [513, 1500])
def test_contour_integrals_equal_the_recursion(c, d):
    ways, t = np.full(c + 2, -np.inf), np.arange(c + 2)
    ways[1] = 0
    for k in range(1, c):
        ways = np.logaddexp(ways + np.log(np.maximum(k - d * t, 1e-300)), np.concatenate([[-np.inf], ways[:-1]]))
    t = t[1 : c : max(1, c // 200)]
    got = math.lgamma(c + 1) - np.array([math.lgamma(x + 1) for x in t]) - t * math.log(d) + lm.log_ways(c, t.astype(float), d)
    assert np.abs(got - ways[t]).max() < 1e-3


def test_numbers_come_back_as_they_were_packed():
    for kind in ("<u2", "<u4", np.uint64):
        for n in (0, 1, 1000):
            x = np.random.default_rng(n).integers(0, np.iinfo(kind).max, n, kind, endpoint=True)
            assert (lm._number(lm.squeezed(x), kind) == x).all()
    x = np.sort(np.random.default_rng(0).integers(0, 2**64 - 1, 999, np.uint64, endpoint=True))
    assert (lm._ordered([lm.ascending(x)])[0] == x).all() and len(lm.ascending(x)) < 7.2 * len(x)
