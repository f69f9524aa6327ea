import random
from datetime import date, timedelta

from tidemark.llm.urls import evaluate_captures

DAY0 = date(2023, 11, 1)


def brute(url, day, log):
    """Last word of each (list, pattern) up to the day, then the most specific."""
    import re

    m = re.match(r"[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)[^/?#]*(?:/([^/?#]+))?", (url or "").lower())
    host, segment = (m[1], m[2]) if m else ("", None)
    if not host or day is None:
        return host, False, None, None, 0
    labels = host.split(".")
    keys = {".".join(labels[i:]) for i in range(len(labels))} | ({f"{host}/{segment}"} if segment else set())
    active = []
    for name, pattern in {(e[0], e[1]) for e in log if e[1] in keys and None not in e}:
        past = [e for e in log if e[0] == name and e[1] == pattern and None not in e and e[4] <= day]
        if past:
            *_, action, op, since = max(past, key=lambda e: (e[4], 2 if e[3] == "remove" else e[2] == "block"))
            if op == "add":
                active.append((("/" in pattern), len(pattern), action == "block", since, pattern))
    if not active:
        return host, False, None, None, 0
    best = max(active)
    return host, best[2], best[4], best[3], len(active)


def test_against_brute_force(spark):
    rnd = random.Random(3)
    hosts = ["a.example.com", "b.example.com", "example.com", "x.org", "deep.a.example.com"]
    log = [(rnd.choice(["one", "two"]), rnd.choice([*hosts, "com", "x.org/news", "a.example.com/p"]), rnd.choice(["block", "allow"]), rnd.choice(["add", "remove", "add"]),
            DAY0 + timedelta(rnd.randint(0, 500))) for _ in range(60)]
    log += log[:3] + [(None, "x.org", "block", "add", DAY0), ("one", None, "block", "add", DAY0), ("one", "x.org", "block", "add", None)]
    urls = [f"http{s}://{u}{h.upper() if rnd.random() < 0.3 else h}{port}{path}" for s in ("", "s") for u in ("", "me:pw@") for h in hosts for port in ("", ":80")
            for path in ("", "/", "/news/1?x=/a", "/p#q", "?a")]
    rows = [(i, rnd.choice([*urls, None, "", "not a url", "http://"]), DAY0 + timedelta(rnd.randint(-20, 900)) if rnd.random() < 0.95 else None) for i in range(300)]
    rows += rows[:5]
    captures = spark.createDataFrame(rows, "id int, url string, day date").selectExpr("*", "'x' AS blocked", "'y' AS `__day`")
    entries = spark.createDataFrame(log, "list string, pattern string, action string, op string, day date")
    got = evaluate_captures(captures, entries)
    want = sorted(str((i, *brute(u, d, log))) for i, u, d in rows)
    assert sorted(str((r["id"], r["host"] or "", r["blocked"], r["decided_by"], r["listed_on"], r["n_active"])) for r in got.collect()) == want


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.com/x", DAY0)], "id int, url string, day date")
    entries = spark.createDataFrame([], "list string, pattern string, action string, op string, day date")
    row = evaluate_captures(captures, entries).first()
    assert (row["blocked"], row["n_active"]) == (False, 0)
    assert evaluate_captures(captures.limit(0), entries).collect() == []
