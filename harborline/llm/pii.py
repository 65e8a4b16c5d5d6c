"""Operator 8, format-preserving pseudonyms (DataFrame expressions only).

One pattern finds candidates; numbers and dates among them are validated (Luhn
for cards, mod 97 for IBANs, octets, the calendar), and what is valid is
replaced by its image under a keyed permutation of its own format: a Feistel
network over the characters' alphabets, over pairs of 16-bit halves for
addresses, and over 189 x 773 = 146,097 days, the length of the calendar's
400-year cycle, for dates.  Slashed dates that only read as month/day are
permuted among themselves: the network is walked until it meets another of them.
Check digits are computed anew.  The permutation
depends on key, kind and value only, so equal values stay linked across
documents, and whoever holds the key can turn it round.

A map over the scan: no exchange, no Python.

Defined results: a null text stays null with counts 0; an empty text stays
empty; very long texts and values are read to their end, in time in proportion
to their length; a host name has at most 126 labels before its last one, of 63
characters each; numbers that fail their check,
and dates outside the years 200 to 9799, stay as they are; repeated rows are
treated alike; other columns pass through ``pseudonymise`` unchanged, except
that with counts a column that is called n_<kind> gives way to the count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

ROUNDS = 8
#: Places that one digest has numbers for.
PLACES = 10
#: For tests and the registered query; production passes a secret of its own.
DEMO_KEY = "not a secret"
KINDS = ("email", "ip", "date", "ssn", "iban", "phone", "card", "secret")

OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
PARTS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,255}@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,63}",
    "secret": r"(?<=(?:token|secret|password|api_key|apikey) = \")[^\"\s]{16,}(?=\")",
    "ip": rf"(?<![\d.])(?:{OCTET}\.){{3}}{OCTET}(?!\.?\d)",
    "date": r"(?<![\d/.-])(?:\d{4}-\d\d-\d\d|\d\d/\d\d/\d{4}|\d\d\.\d\d\.\d{4})(?![\d/-])",
    "ssn": r"(?<![\d-])\d{3}-\d\d-\d{4}(?![\d-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d\d[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "phone": r"(?<![\d+])(?:\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}([-.])\d{3}\1\d{4})(?!\d)",
    "card": r"(?<!\d)(?:\d{13,19}|\d{4}([ -])\d{4}\2\d{4}\2\d{4}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d)",
}
PATTERN = "|".join(f"(?:{p})" for p in PARTS.values())


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with value computed once."""
    return F.transform(F.array(value), use)[0]


def _noise(digests: Column, i: Column, radix: Column) -> Column:
    """A number below radix from the twelve hexadecimal digits of the place."""
    digits = F.substr(F.get(digests, F.floor(i / PLACES).cast("int")), (i % PLACES) * 12 + 1, F.lit(12))
    return F.pmod(F.conv(digits, 16, 10).cast("long"), radix)


def _digests(seed: Column, n: Column) -> Column:
    """Digests for n places: the seed's own, and for long values digests of it with a running number."""
    more = lambda d: F.transform(F.sequence(F.lit(0), F.floor((n - 1) / PLACES).cast("int")), lambda b: F.when(b == 0, d).otherwise(F.sha2(F.concat_ws("|", d, b.cast("string")), 512)))
    return let(F.sha2(seed, 512), lambda d: F.when(n <= PLACES, F.array(d)).otherwise(more(d)))


def feistel(left: Column, right: Column, left_radix: Column, right_radix: Column, key: str, kind: str) -> Column:
    """struct(a, b): both halves (arrays of long) permuted within their radices; ROUNDS is even."""
    first = F.struct(left.alias("a"), right.alias("b"), left_radix.alias("ra"), right_radix.alias("rb"))

    def one(s: Column, step: Column) -> Column:
        seed = F.concat_ws("|", F.lit(key), F.lit(kind), step.cast("string"), s["b"].cast("string"))
        moved = let(_digests(seed, F.size(s["a"])), lambda t: F.transform(s["a"], lambda x, i: let(F.get(s["ra"], i), lambda r: F.pmod(x + _noise(t, i, r), r))))
        return F.struct(s["b"].alias("a"), moved.alias("b"), s["rb"].alias("ra"), s["ra"].alias("rb"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), first, one)


def _code(c: Column, letters: int) -> Column:
    a = F.ascii(c).cast("long")
    return F.when(a < 58, a - 48).when(a < 91, a - 65).otherwise(a - 97)


def _radix(c: Column, letters: int) -> Column:
    return F.when(F.ascii(c) < 58, F.lit(10)).otherwise(F.lit(letters)).cast("long")


def permute_characters(s: Column, key: str, kind: str, letters: int = 26) -> Column:
    """A string of ASCII letters and digits, each permuted within digits, small or capital letters."""
    chars = F.split(s, "")
    n = F.length(s)
    h = F.floor(n / 2).cast("int")
    values, radices = F.transform(chars, lambda c: _code(c, letters)), F.transform(chars, lambda c: _radix(c, letters))
    half = lambda x, second: F.slice(x, h + 1, n - h) if second else F.slice(x, F.lit(1), h)
    done = feistel(half(values, False), half(values, True), half(radices, False), half(radices, True), key, kind)
    back = F.zip_with(let(done, lambda d: F.concat(d["a"], d["b"])), chars, lambda v, c: F.char(v + F.when(F.ascii(c) < 58, 48).when(F.ascii(c) < 91, 65).otherwise(97)))
    return F.when(n == 0, s).otherwise(F.array_join(back, ""))


def refill(match: Column, fresh: Column) -> Column:
    """match with its letters and digits replaced in turn by the characters of fresh."""
    placed = F.transform(F.split(match, ""), lambda c, i: F.struct(i.alias("i"), c.alias("c")))
    used = lambda x: x["c"].rlike("[0-9A-Za-z]")

    def merged(p: Column) -> Column:
        new = F.zip_with(F.filter(p, used), F.split(fresh, ""), lambda x, f: F.struct(x["i"].alias("i"), f.alias("c")))
        return F.array_join(F.transform(F.array_sort(F.concat(new, F.filter(p, lambda x: ~used(x)))), lambda x: x["c"]), "")

    return F.when(match.rlike("^[0-9A-Za-z]*$"), fresh).otherwise(let(placed, merged))


def _bare(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9A-Za-z]", "")


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of a digit string from the right, every place whose parity is `doubled` counted double."""

    def value(c: Column, i: Column) -> Column:
        d = c.cast("int")
        return F.when(i % 2 == doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), value), F.lit(0), lambda a, x: a + x)


def is_card(m: Column) -> Column:
    d = _bare(m)
    return (luhn_sum(d, 1) % 10 == 0) & ~d.rlike(r"^(\d)\1*$")


def card(m: Column, key: str) -> Column:
    d = _bare(m)
    body = permute_characters(F.substr(d, F.lit(1), F.length(d) - 1), key, "card")
    return refill(m, let(body, lambda b: F.concat(b, F.pmod(10 - luhn_sum(b, 0) % 10, F.lit(10)).cast("string"))))


def mod97(s: Column) -> Column:
    """Remainder of an IBAN in checking order, letters read as 10 to 35."""

    def one(a: Column, c: Column) -> Column:
        v = F.ascii(c).cast("int")
        return F.when(v < 58, (a * 10 + v - 48) % 97).otherwise((a * 100 + v - 55) % 97)

    return F.aggregate(F.split(s, ""), F.lit(0), one)


def is_iban(m: Column) -> Column:
    return mod97(F.concat(F.substring(m, 5, 40), F.substring(m, 1, 4))) == 1


def iban(m: Column, key: str) -> Column:
    body = permute_characters(F.substring(m, 5, 40), key, "iban")

    def whole(b: Column) -> Column:
        land = F.substring(m, 1, 2)
        return F.concat(land, F.lpad((98 - mod97(F.concat(b, land, F.lit("00")))).cast("string"), 2, "0"), b)

    return let(body, whole)


def ip(m: Column, key: str) -> Column:
    o = F.transform(F.split(m, r"\."), lambda x: x.cast("long"))
    wide = F.array(F.lit(65536).cast("long"))
    done = feistel(F.array(o[0] * 256 + o[1]), F.array(o[2] * 256 + o[3]), wide, wide, key, "ip")

    def text(d: Column) -> Column:
        a, b = d["a"][0], d["b"][0]
        return F.concat_ws(".", *[x.cast("string") for x in (F.floor(a / 256), a % 256, F.floor(b / 256), b % 256)])

    return let(done, text)


def _date(m: Column) -> Column:
    """The date, or null: year first, else day first, else month first; whole 400-year cycles only."""
    d = F.coalesce(*[F.try_to_date(m, f) for f in ("yyyy-MM-dd", "dd.MM.yyyy", "dd/MM/yyyy", "MM/dd/yyyy")])
    return F.when(F.year(d).between(200, 9799), d)


#: 1800-01-01 in days before 1970; the days of 400 years; their two factors.
EPOCH_SHIFT, CYCLE, FACTORS = 62_091, 146_097, (189, 773)
#: Steps of a walk, each of which ends it with a chance of 0.6.
WALK = 64


def _permuted_day(q: Column, key: str) -> Column:
    """A place in the cycle, permuted."""
    half = lambda x, n: (F.array(x.cast("long")), F.array(F.lit(n).cast("long")))
    (left, ra), (right, rb) = half(F.floor(q / FACTORS[1]), FACTORS[0]), half(q % FACTORS[1], FACTORS[1])
    return let(feistel(left, right, ra, rb, key, "date"), lambda d: d["a"][0] * FACTORS[1] + d["b"][0])


def date(m: Column, key: str) -> Column:
    n = F.unix_date(_date(m)).cast("long") + EPOCH_SHIFT
    q = F.pmod(n, F.lit(CYCLE))
    day = lambda x: F.date_from_unix_date((n - q + x - EPOCH_SHIFT).cast("int"))
    month_first = m.contains("/") & F.try_to_date(m, "dd/MM/yyyy").isNull()

    def step(s: Column, _: Column) -> Column:
        moved = let(_permuted_day(s["q"], key), lambda x: F.struct(x.alias("q"), (F.day(day(x)) > 12).alias("done")))
        return F.when(s["done"], s).otherwise(moved)

    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), F.struct(q.alias("q"), F.lit(False).alias("done")), step, lambda s: F.when(s["done"], s["q"]).otherwise(q))

    def text(x: Column) -> Column:
        moved = day(x)
        return F.when(m.contains("-"), F.date_format(moved, "yyyy-MM-dd")).when(m.contains("."), F.date_format(moved, "dd.MM.yyyy")).when(month_first, F.date_format(moved, "MM/dd/yyyy")).otherwise(F.date_format(moved, "dd/MM/yyyy"))

    return let(F.when(month_first, walked).otherwise(_permuted_day(q, key)), text)


def email(m: Column, key: str) -> Column:
    """Everything before the last label; dots, signs and the top-level domain stay."""
    top = F.regexp_extract(m, r"\.[A-Za-z]+$", 0)
    head = F.substr(m, F.lit(1), F.length(m) - F.length(top))
    return F.concat(refill(head, permute_characters(_bare(head), key, "email")), top)


def phone(m: Column, key: str) -> Column:
    """The country code after a plus stays."""
    code = F.regexp_extract(m, r"^\+\d{1,3}", 0)
    rest = F.substr(m, F.length(code) + 1)
    return F.concat(code, refill(rest, permute_characters(_bare(rest), key, "phone")))


def kind_of(m: Column) -> Column:
    """The kind of a candidate, null where its check fails."""
    return (
        F.when(m.contains("@"), "email")
        .when(m.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip")
        .when(m.rlike(r"^(\d{4}-\d\d-\d\d|\d\d([/.])\d\d\2\d{4})$"), F.when(_date(m).isNotNull(), "date"))
        .when(m.rlike(r"^\d{3}-\d\d-\d{4}$"), "ssn")
        .when(m.rlike(r"^[A-Z]{2}\d\d[A-Z0-9]{11,30}$"), F.when(is_iban(m), "iban"))
        .when(m.rlike(r"^\+|^\(|^\d{3}[-.]\d{3}[-.]\d{4}$"), "phone")
        .when(m.rlike(r"^\d[\d -]{11,22}\d$"), F.when(is_card(m), "card"))
        .otherwise("secret")
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    secret = F.when(m.rlike("^[0-9a-f]+$"), permute_characters(m, key, "secret", 6)).otherwise(refill(m, permute_characters(_bare(m), key, "secret")))
    out = F.when(kind == "email", email(m, key)).when(kind == "ip", ip(m, key)).when(kind == "date", date(m, key))
    out = out.when(kind == "ssn", refill(m, permute_characters(_bare(m), key, "ssn"))).when(kind == "iban", iban(m, key))
    out = out.when(kind == "phone", phone(m, key)).when(kind == "card", card(m, key)).when(kind == "secret", secret)
    return F.coalesce(out, m)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", counts: bool = False) -> DataFrame:
    """docs with private values replaced in text_col; with counts also n_<kind> for each kind."""
    name = "_found"
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    text, found = F.col(f"`{text_col}`"), F.col(name)
    matches = F.when(text.rlike(PATTERN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    out = docs.withColumn(name, F.transform(matches, lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind"))))
    # text = parts[0] + match[0] + parts[1] + match[1] + ...
    parts = F.split(text, PATTERN, -1)
    new = F.transform(found, lambda f: pseudonym(f["m"], f["kind"], key))
    pieces = F.zip_with(parts, F.concat(new, F.array(F.lit(""))), lambda p, m: F.concat(p, m))
    out = out.withColumn(text_col, F.when(found.isNull(), text).otherwise(F.array_join(pieces, "")))
    if counts:
        of_kind = lambda k: F.size(F.filter(found, lambda f: f["kind"] == k))
        out = out.withColumns({f"n_{k}": F.when(found.isNull(), F.lit(0)).otherwise(of_kind(k)).cast("long") for k in KINDS})
    return out.drop(name)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"), DEMO_KEY, counts=True)


QUERIES = {"op8_pii": op8_pii}
ORACLE_SQL: dict[str, str] = {}
