import random
import re
from collections import Counter

from harborline.llm import quality


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    count = Counter(zip(w, w[1:], w[2:], strict=False))
    cover = [any(count[tuple(w[k : k + 3])] > 1 for k in range(max(0, i - 2), min(i, len(w) - 3) + 1)) for i in range(len(w))]
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(w)
    return n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, sum(cover), n < 50 or 100 * sum(cover) > 50 * n


def test_base_counts_against_brute_force(spark):
    rnd = random.Random(1)
    words = ["a", "bé", "c|", "<d>", "日本", "e\x1ff", "g\x85h"]
    texts = ["", None, "\n", " \n\n a\n a\na \n", "x " * 60, "a b c a b c", "é\né\n é\n"]
    texts += ["".join(rnd.choice(words) + rnd.choice([" ", "\n", "  ", " \n", "\t", "\r\n", "\x0b"]) for _ in range(rnd.randrange(200))) for _ in range(120)]
    rows = quality.quality_report(spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)], "doc_id long, text string, kept boolean")).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute(texts[r.doc_id]), texts[r.doc_id]
        assert not (r.base_failed and r.kept)


def test_verdict(spark):
    rnd = random.Random(2)
    sentence = lambda n: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(n))
    heading = sentence(8)
    clean = f"{heading}\n{sentence(40)}\n{sentence(30)}\n{heading}"
    chorus = sentence(22)
    repeated = f"{sentence(60)} {chorus} {sentence(6)} {chorus}"
    symbols = " ".join(f"{w}%%%" for w in sentence(80).split())
    docs = spark.createDataFrame([(1, clean, "a"), (2, repeated, "b"), (3, symbols, "c")], "doc_id long, text string, lang string")
    kept = quality.filter_documents(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
