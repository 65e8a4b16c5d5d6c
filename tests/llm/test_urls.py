import datetime as dt
import random
import re

from harborline.llm import urls


def brute(captures, entries):
    out = set()
    for i, url, day in captures:
        active = []
        if url and "://" in url:
            h = re.split("[/?#]", url.split("://")[1])[0].split("@")[-1].split(":")[0].lower().rstrip(".")
            seg = url.split("://")[1].partition("/")[2].split("/")[0].split("?")[0].split("#")[0]
            labels = h.split(".")
            pats = ([f"{h}/{seg}"] if seg else []) + [".".join(labels[k:]) for k in range(max(len(labels) - 1, 1))]
            for p in pats if h else []:
                state = False
                for day2 in sorted({d for q, d, _ in entries if q == p and d <= day}):
                    state = all(a != "remove" for q, d, a in entries if q == p and d == day2)
                if state:
                    active.append(p)
        out.add((i, bool(active), len(active), active[0] if active else None))
    return out


def test_against_brute_force(spark):
    rnd = random.Random(5)
    hosts = ["a.example.com", "b.a.example.com", "x.org", "example.com"]
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(12))
    entries = [(rnd.choice([*hosts, "x.org/en", "com"]), day(), rnd.choice(["add", "remove"])) for _ in range(60)]
    captures = [(i, f"http{rnd.choice(['', 's'])}://{rnd.choice(hosts)}{rnd.choice(['', ':80', '.'])}{rnd.choice(['', '/', '/en/1', '/de?x=1', '#t'])}", day()) for i in range(200)]
    captures += [(900, None, day()), (901, "", day()), (902, "not a url", day()), (903, "ftp://USER@X.ORG/en", day())]
    cap = spark.createDataFrame([(*c, "clash") for c in captures], "page_id long, url string, fetched_on date, pattern string")
    ent = spark.createDataFrame(entries, "pattern string, listed_on date, action string")
    got = {(r.page_id, r.blocked, r.n_active, r.pattern) for r in urls.evaluate(cap, ent).collect()}
    assert got == brute(captures, entries)
    assert urls.evaluate(cap, ent.limit(0)).where("blocked").count() == 0
    assert urls.evaluate(cap.limit(0), ent).count() == 0
