import random

import pytest

import corpus_pipeline as cp
from harborline.llm import quality, simhash


def jaccard(a, b, k=5):
    s = [{tuple(t.lower().split()[i : i + k]) for i in range(max(1, len(t.split()) - k + 1))} for t in (a, b)]
    return len(s[0] & s[1]) / len(s[0] | s[1])


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(12)
    word = lambda: rnd.choice("bcdfgklm") + rnd.choice("aeiou") + rnd.choice("nrst") + str(rnd.randrange(90))
    base = [[word() for _ in range(rnd.randrange(60, 300))] for _ in range(40)]
    docs = []
    for i, w in enumerate(base):
        docs.append((10 * i + 9, " ".join(w)))
        for k in range(i % 4):
            v = list(w)
            for _ in range(1 + len(v) // 120):
                v[rnd.randrange(len(v))] = word()
            docs.append((10 * i + k, " ".join(v)))
    docs += [(1000 + i, docs[0][1]) for i in range(5)] + [(2000, ""), (2001, None), (2002, "too short"), (2003, "again and again " * 60), (2004, "### $$$ " * 80)]
    return docs


def test_near_duplicates_against_brute_force(spark, corpus):
    docs = [(i, t) for i, t in corpus if t and len(t.split()) >= 50 and i < 2000]
    group = {i: i for i, _ in docs}
    for _ in range(4):
        for i, t in docs:
            for j, u in docs:
                if (i // 10 == j // 10 or i >= 1000 or j >= 1000) and jaccard(t, u) >= 0.8:
                    group[i] = group[j] = min(group[i], group[j])
    df = spark.createDataFrame([(i, t, "en") for i, t in docs], "doc_id long, text string, root string")
    kept = simhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == set(group.values())
    assert simhash.drop_near_duplicates(df.limit(0)).count() == 0


def test_run(spark, corpus, tmp_path):
    item = " ".join(f"item{i}x" for i in range(20))
    docs = [*corpus, (3000, corpus[4][1] + " padding here " + item), (3001, corpus[8][1] + " write to a.b@c.example now")]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    steps = []
    for _, stage in cp.STAGES:
        frame = cp.materialise(stage(spark, frame, str(tmp_path)))
        steps.append(frame)
    for s in steps[:-1]:
        assert s.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    ids = [{r.doc_id for r in s.select("doc_id").distinct().collect()} for s in steps]
    assert not ids[0] & {2000, 2001, 2002, 2003, 2004} and {3000, 3001} <= ids[0]
    assert ids[2] == ids[1] - {3000} and ids[3] == ids[2] == ids[4]
    text = {r.doc_id: r for r in steps[3].collect()}
    if 3001 in text:
        assert "a.b@c.example" not in text[3001].text and text[3001].n_chars == len(text[3001].text)
    final = sorted((r.doc_id, r.start, r.ids_crc32) for r in steps[4].collect())
    assert final == sorted((r.doc_id, r.start, r.ids_crc32) for r in cp.run(spark, str(tmp_path)).collect())


def test_quality_on_odd_tables(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "a b c " * 9_000), (4, "x " * 49)], "doc_id long, text string")
    got = quality.quality_report(df).collect()
    assert [(r.doc_id, r.n_words, r.base_failed, r.kept) for r in sorted(got, key=lambda r: (r.doc_id, r.n_words))] == [(1, 0, True, False), (2, 0, True, False), (3, 0, True, False), (4, 49, True, False), (4, 27_000, True, False)]
    assert quality.quality_report(df.limit(0)).count() == 0


def test_near_duplicates_in_sets_of_many_against_brute_force(spark):
    rnd = random.Random(5)
    fresh = iter(range(10**6))
    word = lambda: f"w{next(fresh)}"
    passage = [word() for _ in range(150)]
    texts = []
    for _ in range(60):  # pairs of similarity 0.8 and more that share a passage with all others
        own = [word() for _ in range(62)]
        texts += [passage + own, passage + own[:-20] + [word() for _ in range(20)]]
    for _ in range(4):  # only neighbours are similar
        v = [word() for _ in range(200)]
        for step in range(30):
            texts.append(list(v))
            v[step * 6 % 200 : step * 6 % 200 + 10] = [word() for _ in range(10)]
    ids = rnd.sample(range(10_000), len(texts))
    docs = [(i, " ".join(t)) for i, t in zip(ids, texts, strict=True)]
    sets = {i: {tuple(t.split()[k : k + 5]) for k in range(len(t.split()) - 4)} for i, t in docs}
    pairs = [(i, j) for i in sets for j in sets if i < j and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    group = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(group[i], group[j])
            changed |= group[i] != low or group[j] != low
            group[i] = group[j] = low
    assert len(set(group.values())) < len(group) // 2 + 5
    got = simhash.near_duplicate_roots(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.root for r in got} == {i: r for i, r in group.items() if i != r}


def exact_pairs(docs, least):
    """All pairs of texts of similarity ``least`` or more, with it, over an index of all five-word shingles."""
    from collections import Counter, defaultdict

    sets = {i: set(simhash.shingles((t or "").encode(), 5)) for i, t in docs}
    where = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            where[x].append(i)
    for i, s in sets.items():
        met = Counter(j for x in s for j in where[x] if j > i)
        for j, n in met.items():
            if n / (len(s) + len(sets[j]) - n) >= least:
                yield i, j, n / (len(s) + len(sets[j]) - n)


def test_recall_on_a_table(spark):
    """Every pair of documents of sf0.01 at 0.8 or more ends in one group, and no group joins what no chain of such pairs joins."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    docs = [(r.doc_id, r.text) for r in table.collect()]
    root = {r.doc_id: r.root for r in simhash.near_duplicate_roots(table).collect()}
    pairs = list(exact_pairs(docs, 0.8))
    found = [root.get(i, i) == root.get(j, j) for i, j, _ in pairs]
    print(f"{sum(found)} of {len(pairs)} pairs at 0.8 and more, {sum(s < 1 for _, _, s in pairs)} of them between different sets")
    assert len(pairs) > 50 and all(found)
    group = {i: i for i, _ in docs}

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i, j, _ in pairs:
        a, b = sorted((top(i), top(j)))
        group[b] = a
    assert {i: r for i, r in root.items()} == {i: top(i) for i, _ in docs if top(i) != i}
