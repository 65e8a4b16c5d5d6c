import datetime
import hashlib
import re
import time

import pytest
import regex

from harborline.llm import pii

CASES = {
    "email": "mail und.34@mail7.example.com now",
    "ip": "at 97.51.17.173.",
    "date": "on 1999-02-28, 31/12/2001, 12/25/2001 or 29.02.2000",
    "ssn": "no 123-45-6789",
    "iban": "to DE89370400440532013000 x",
    "phone": "call +1 (017) 555-7713 or 555-123-4567",
    "card": "pay 4845168114407329 or 4111 1111 1111 1111",
    "secret": 'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"',
}
CLEAN = ["", "plain words 12 and 2024, v1.2.3", "4845168114407328 4845168114407320", "DE00370400440532013000", "2023-02-30", "999.1.1.1", "a@b", "x" * 100_000]


def luhn(s):
    d = [int(c) for c in re.sub(r"\D", "", s)][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


@pytest.fixture(scope="module")
def rows(spark):
    texts = [*CASES.values(), *CLEAN, None, *CASES.values()]
    docs = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "doc_id long, text string, n_found string")
    return pii.pseudonymise(docs, "k", counts=True).orderBy("doc_id").collect()


def test_values_change_and_keep_their_format(rows):
    for (kind, text), r in zip(CASES.items(), rows, strict=False):
        assert r[f"n_{kind}"] >= 1 and r.n_found == "kept", kind
        assert sum(r[f"n_{k}"] for k in pii.KINDS) == r[f"n_{kind}"], kind
        values = [m.group() for m in regex.finditer(pii.PATTERN, text)]
        assert values
        for v in values:
            assert v not in r.text, (kind, r.text)
        shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", s)))
        if kind not in ("ip", "secret"):
            assert shape(r.text) == shape(text)
    found = [m.group() for m in regex.finditer(pii.PATTERN, rows[6].text)]
    assert len(found) == 2 and all(map(luhn, found))


def test_clean_and_null_texts_stay(rows):
    for text, r in zip([*CLEAN, None], rows[len(CASES) :], strict=False):
        assert r.text == text and all(r[f"n_{k}"] == 0 for k in pii.KINDS)


def test_equal_values_stay_linked(rows):
    for a, b in zip(rows, rows[-len(CASES) :], strict=False):
        assert a.text == b.text


def test_permutations_are_one_to_one(spark):
    from pyspark.sql import functions as F

    df = spark.range(2000)
    d = F.date_format(F.date_add(F.lit("1990-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd")
    a = F.concat_ws(".", F.lit("10"), F.lit("0"), F.floor(F.col("id") / 256).cast("string"), (F.col("id") % 256).cast("string"))
    n = F.lpad(F.col("id").cast("string"), 4, "0")
    out = df.select(pii.date(d, "k").alias("d"), pii.ip(a, "k").alias("a"), pii.permute_characters(n, "k", "x").alias("n"))
    r = out.agg(*[F.count_distinct(c).alias(c) for c in out.columns], F.sum(F.length("n")).alias("len")).head()
    assert (r.d, r.a, r.n, r.len) == (2000, 2000, 2000, 8000)


def test_slashed_dates_are_one_to_one(spark):
    from pyspark.sql import functions as F

    days = spark.range(3000).select(F.date_add(F.lit("1998-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    forms = days.select(F.date_format("day", "dd/MM/yyyy").alias("m")).union(days.select(F.date_format("day", "MM/dd/yyyy"))).distinct()
    out = forms.select("m", pii.date(F.col("m"), "k").alias("d")).collect()
    assert len({r.d for r in out}) == len(out) > 4700
    for r in out:  # what only reads as month/day still does
        assert re.fullmatch(r"\d\d/\d\d/\d{4}", r.d)
        assert (int(r.m[3:5]) > 12) == (int(r.d[3:5]) > 12)


def test_clashing_columns_and_edges(spark):
    docs = spark.createDataFrame([(1, "born 0150-01-01 and 9999-12-31", "a", 5), (2, "born 03/04/1999", "b", 6), (3, ("plain words " * 20_000) + "a@b.org", "c", 7)], "doc_id long, text string, _found string, n_date long")
    plain = {r.doc_id: r for r in pii.pseudonymise(docs, "k").collect()}
    assert pii.pseudonymise(docs, "k").columns == docs.columns
    assert plain[1].text.endswith("9999-12-31") and [plain[i]._found for i in (1, 2, 3)] == ["a", "b", "c"] and plain[2].n_date == 6
    assert plain[2].text != "born 03/04/1999" and not plain[3].text.endswith("a@b.org") and plain[3].text.endswith(".org")
    counted = {r.doc_id: r for r in pii.pseudonymise(docs, "k", counts=True).collect()}
    assert [counted[i].n_date for i in (1, 2, 3)] == [0, 1, 0] and counted[2]._found == "b"


def digests(seed, n):
    d = hashlib.sha512(seed.encode()).hexdigest()
    return [d] + [hashlib.sha512(f"{d}|{b}".encode()).hexdigest() for b in range(1, (n - 1) // 10 + 1)]


def noise(half, n, key, kind, step):
    t = digests(f"{key}|{kind}|{step}|[{', '.join(map(str, half))}]", n)
    return [int(t[i // 10][i % 10 * 12 : i % 10 * 12 + 12], 16) for i in range(n)]


def network(a, b, ra, rb, key, kind, back=False):
    """The Feistel network in plain Python, either way."""
    for step in range(8, 0, -1) if back else range(1, 9):
        if back:  # (a, b) is (old b, moved old a)
            a, b, ra, rb = [(x - z) % r for x, z, r in zip(b, noise(a, len(b), key, kind, step), rb, strict=True)], a, rb, ra
        else:
            a, b, ra, rb = b, [(x + z) % r for x, z, r in zip(a, noise(b, len(a), key, kind, step), ra, strict=True)], rb, ra
    return a, b


def characters(s, key, kind, letters=26, back=False):
    base = [48 if c.isdigit() else 65 if c.isupper() else 97 for c in s]
    v, r, h = [ord(c) - o for c, o in zip(s, base, strict=True)], [10 if o == 48 else letters for o in base], len(s) // 2
    a, b = network(v[:h], v[h:], r[:h], r[h:], key, kind, back)
    return "".join(chr(x + o) for x, o in zip(a + b, base, strict=True))


def refilled(m, fresh):
    it = iter(fresh)
    return "".join(next(it) if c.isascii() and c.isalnum() else c for c in m)


def test_plain_feistel_agrees_and_turns_back(spark):
    from pyspark.sql import functions as F

    strings = ["1", "12", "123456789", "Az09", "q" * 19, "0123456789abcdefXYZ" * 7]
    out = spark.createDataFrame([(s,) for s in strings], "s string").select("s", pii.permute_characters(F.col("s"), "k", "x").alias("p")).collect()
    for r in out:
        assert r.p == characters(r.s, "k", "x") and characters(r.p, "k", "x", back=True) == r.s
    bare = lambda s: re.sub("[^0-9A-Za-z]", "", s)
    values = {"ssn": "123-45-6789", "phone": "+1 (017) 555-7713", "email": "mail_und.34@mail7.example.com", "secret": "xx_Zyx-98.76+ab=0123", "ip": "97.51.17.173", "date": "1999-02-28"}
    rows = spark.createDataFrame(list(values.items()), "kind string, m string")
    got = {r.kind: r.p for r in rows.select("kind", pii.pseudonym(F.col("m"), F.col("kind"), "k").alias("p")).collect()}
    for kind, head, tail in (("ssn", "", ""), ("phone", "+1", ""), ("email", "", ".com"), ("secret", "", "")):
        mid = lambda s: s[len(head) : len(s) - len(tail)]  # noqa: E731, B023
        assert got[kind] == head + refilled(mid(values[kind]), characters(bare(mid(values[kind])), "k", kind)) + tail
        assert head + refilled(mid(got[kind]), characters(bare(mid(got[kind])), "k", kind, back=True)) + tail == values[kind]
    halves = lambda s: [[a * 256 + b] for a, b in [tuple(map(int, s.split(".")[i : i + 2])) for i in (0, 2)]]
    assert network(*halves(got["ip"]), [65536], [65536], "k", "ip", back=True) == tuple(halves(values["ip"]))
    place = lambda s: (datetime.date.fromisoformat(s) - datetime.date(1970, 1, 1)).days + 62_091
    q = place(got["date"]) % 146_097
    a, b = network([q // 773], [q % 773], [189], [773], "k", "date", back=True)
    assert a[0] * 773 + b[0] == place(values["date"]) % 146_097
    card, iban = "4845168114407329", "DE89370400440532013000"
    p = spark.range(1).select(pii.card(F.lit(card), "k").alias("card"), pii.iban(F.lit(iban), "k").alias("iban")).head()
    assert characters(p.card[:-1], "k", "card", back=True) == card[:-1] and luhn(p.card)
    assert characters(p.iban[4:], "k", "iban", back=True) == iban[4:]


def test_long_and_odd_texts_take_little_time_and_stack(spark):
    units = ["a.", "a-", "7", "1-", "12 ", "(1", "+1 ", "1.1.", '"', "@", "a@a.", "AA00A", "%.", "é "]
    texts = [start + u * (n // len(u)) for n in (4_000, 40_000, 1_000_000) for u in units for start in ("", "a@")]
    secret = "Ab3_" * 75_000
    texts += [f'token = "{secret}"', "a@" + "bc." * 100 + "org", "a@" + "bc." * 2000 + "org"]
    began = time.time()
    rows = pii.pseudonymise(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4), "k").orderBy("doc_id").collect()
    assert time.time() - began < 100
    assert [len(r.text) for r in rows] == [len(t) for t in texts]
    assert all(r.text == t for r, t in zip(rows, texts, strict=False) if set(t) <= set("a.-@\"%é "))
    new = rows[-3].text.split('"')[1]
    assert new != secret and new == refilled(secret, characters(secret.replace("_", ""), "k", "secret"))
    assert rows[-2].text.endswith(".org") and rows[-2].text != texts[-2]
