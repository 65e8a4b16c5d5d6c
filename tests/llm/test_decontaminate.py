import random
import re
from collections import Counter

from harborline.llm import decontaminate as d

ITEM = "A train from Bern to Basel with Anna Keller covers 120 km in 2 hours and then waits 15 minutes. How many km per hour did Anna travel?"
OTHER = "The quiet harbour opened its gates before sunrise and every vessel waited for the tide to turn again."


def run(spark, docs, items=((1, ITEM), (2, OTHER)), limit=1_000_000):
    docs = spark.createDataFrame(list(docs), "doc_id long, text string")
    return {(r.doc_id, r.item_id): r for r in d.contamination(docs, spark.createDataFrame(list(items), "item_id long, text string"), filter_limit=limit).collect()}


def test_copies_and_new_values_are_found_and_others_are_not(spark):
    moved = ITEM.replace("120", "250").replace("2 hours", "5 hours").replace("Anna", "Maria").replace("15", "40")
    torn = ITEM.replace("Anna Keller", "Maria Keller")  # the second Anna stays: one name stands for two
    docs = [(1, f"Some words before. {ITEM} Some words after."), (2, moved), (3, ITEM.lower()), (4, ITEM.upper()), (5, OTHER.replace(" ", "  \n")), (6, "nothing of the kind"), (7, ""), (8, None), (9, " ".join(OTHER.split()[:9])), (10, "12 km 13 km 14 km 15 km " * 50), (1, "repeated row"), (11, torn)]
    for limit in (1_000_000, 0):
        got = run(spark, docs, limit=limit)
        assert set(got) >= {(1, 1), (2, 1), (3, 1), (4, 1), (5, 2)}
        assert {k[0] for k in got} <= {1, 2, 3, 4, 5, 11}
        assert got[1, 1].coverage == 1 and got[1, 1].changed_slots == 0
        assert got[2, 1].changed_slots >= 4


def test_short_items_and_empty_tables(spark):
    assert set(run(spark, [(1, "well, so it goes on forever then")], [(5, "It goes on forever"), (6, None), (7, "...")])) == {(1, 5)}
    assert run(spark, []) == {} and run(spark, [(1, ITEM)], []) == {}


def test_items_in_other_scripts(spark):
    items = [(1, "Поезд из Москвы до Твери проходит путь за два часа и потом ждёт четверть часа на станции"), (2, "Πόσο διαρκεί το ταξίδι")]
    assert set(run(spark, [(1, "перед этим " + items[0][1] + " после"), (2, "σήμερα " + items[1][1]), (3, "иной текст")], items)) == {(1, 1), (2, 2)}


def test_items_of_numbers_and_units(spark):
    items = [(1, "What is 12 times 7 ?"), (2, "5 km + 3 km = 8 km"), (3, "10 km 20 km 30 km 40 km 50 km 60 km")]
    docs = [(1, "They ask: what is 12 times 7? Nobody knows."), (2, "so 5 km + 3 km = 8 km again"), (3, "what is 13 times 7 ?"), (4, "5 km + 4 km = 9 km"), (5, "12 km 13 km 14 km 15 km " * 50), (6, items[2][1])]
    for limit in (1_000_000, 0):
        assert set(run(spark, docs, items, limit)) == {(1, 1), (2, 2), (6, 3)}


def test_slots_window_by_window_and_long_excerpts(spark):
    used_twice = "A farmer sold 12 baskets of ripe apples to the first buyer on Monday and then another 12 baskets of green pears to the second buyer on Friday before closing the stall"
    differ = "The baker needs 3 cups of white flour for every loaf of bread and 4 cups of cold water for every tray of soft rolls"
    long = " ".join(f"word{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(59))
    items = [(1, used_twice), (2, differ), (3, long)]
    docs = [
        (1, used_twice.replace("another 12", "another 15")),
        (2, differ.replace("3", "5").replace("4", "5")),
        (3, "before " + " ".join(long.split()[10:35]) + " after"),
        (4, " ".join(long.split()[10:22]) + " after"),
        (5, used_twice.replace("sold 12", "sold 14").replace("another 12", "another 15")),
    ]
    got = run(spark, docs, items)
    assert set(got) == {(1, 1), (2, 2), (3, 3), (5, 1)}
    assert got[3, 3].n_covered == 18 and got[2, 2].changed_slots == 2 and got[2, 2].coverage == 1


def test_null_ids_and_large_ids(spark):
    big = 2**53 + 1
    docs = [(None, f"so {ITEM}"), (big, f"and {ITEM} again"), (4, OTHER), (None, None)]
    items = [(None, OTHER), (big, ITEM), (7, OTHER)]
    assert set(run(spark, docs, items)) == {(big, big), (4, 7)}


def brute(docs, items):
    """Covered item windows of every pair, by plain loops over lists of tokens."""

    def tokens(text, variant):
        out, opens = [], True
        for word in re.findall(r"[^\x20\x09-\x0D]+", text or ""):
            low, kind, proper, closing = d._canonical(word)
            if low:
                kind = d.SLOT_NAME if variant == 1 and kind == d.PLAIN and proper and not opens else kind
                out.append((low, d.PLAIN if variant == d.LITERAL else kind))
            opens = closing
        return out

    def windows(ts, size, variant):
        for p in range(len(ts) - size + 1):
            w = ts[p : p + size]
            if variant == d.LITERAL or sum(k == d.PLAIN for _, k in w) >= min(d.MIN_PLAIN, size):
                yield p, tuple(t if k == d.PLAIN else k for t, k in w), [t for t, k in w if k != d.PLAIN]

    out = {}
    for item, it in items:
        own = {}
        for variant in (0, 1, d.LITERAL):
            ts = tokens(it, variant)
            ws = list(windows(ts, min(len(ts), d.WINDOW), variant)) if ts else []
            if ws and (variant != d.LITERAL or not own):
                own[variant] = (min(len(ts), d.WINDOW), ws)
        for doc, text in docs:
            best, longest = (0, 0, 0, 0), 0
            for variant, (size, ws) in own.items():
                shifts = {}
                for q, form, slots in windows(tokens(text, variant), size, variant):
                    for p, mine, values in ws:
                        if mine == form:
                            shifts.setdefault(q - p, []).append((p, values, slots))
                at, changed = set(), 0
                for found in shifts.values():
                    votes = Counter(pair for _, i, s in found for pair in zip(i, s, strict=True))
                    top = {i: max((n, i == s, s) for (j, s), n in votes.items() if j == i)[2] for i, _ in votes}
                    good = sorted((p, i, s) for p, i, s in found if i == s or all(top[a] == b for a, b in zip(i, s, strict=True)))
                    covered = {p + k for p, _, _ in good for k in range(size)}
                    longest = max([longest, *(next(n for n in range(1, 10**6) if c + n not in covered) for c in covered)])
                    at |= {p for p, _, _ in good}
                    changed = max(changed, len({x for _, i, s in good for x in zip(i, s, strict=True) if x[0] != x[1]}))
                if at:
                    best = max(best, (len(at) / len(ws), len(at), len(ws), changed))
            if best[0] >= d.MIN_COVERED or longest >= d.MIN_RUN:
                out[doc, item] = best
    return out


def test_against_brute_force(spark):
    rnd = random.Random(12)
    plain = ["river", "opens", "slowly", "The", "market", "of", "Bern", "Anna", "sold", "under", "grey", "Basel.", "rain"]
    slots = ["12", "3", "km", "kg", "7.5", "hours", "120"]
    text = lambda n: " ".join(rnd.choice(slots if rnd.random() < 0.25 else plain) for _ in range(n))
    items = [(i, text(rnd.choice([3, 7, 12, 30, 45]))) for i in range(14)]
    docs = []
    for i in range(60):
        words = rnd.choice(items)[1].split()
        a = rnd.randrange(len(words))
        words = [rnd.choice(slots) if w in slots and rnd.random() < 0.3 else w for w in (words if rnd.random() < 0.5 else words[a:])]
        docs.append((i, " ".join([text(rnd.randrange(12)), *words, text(rnd.randrange(12))])))
    docs.append((100, text(4000) + " " + items[3][1]))
    want = brute(docs, items)
    got = {k: (r.coverage, r.n_covered, r.n_windows, r.changed_slots) for k, r in run(spark, docs, items).items()}
    assert len(want) > 20 and got == want, [(k, got.get(k), want.get(k)) for k in got.keys() | want.keys() if got.get(k) != want.get(k)][:5]
