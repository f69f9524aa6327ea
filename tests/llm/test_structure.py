import itertools
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import catalog
from tidemark.llm.structure import ROWS, START, brute_force, closing, crossings, damaged, digests, gaps, last_state, joined, repair_structure, row_of, turns

COLUMNS = "conv_id long, turn long, role string, text string"
ROLES = ["user", "assistant", "system", "tool", " ", "", "using"]
TEXTS = ["Yes.", "No", "Why?", "", " \t", "end!\n", "日本。", "end ."]


def some_rows(seed, n):
    rnd = random.Random(seed)
    return [(rnd.choice(ROLES[:3] if rnd.random() < 0.8 else ROLES), rnd.choice(TEXTS)) for _ in range(n)]


def direct(rows):
    """The repair of (role, text) rows by this module's own functions, without Spark."""
    from tidemark.llm.structure import BLANK, CUT_OFF, DUPLICATE

    steps = []
    for i, (role, text) in enumerate(rows):
        shown = text.strip(" \t\n\x0b\x0c\r")
        steps.append(row_of(role, BLANK if not shown else DUPLICATE if (role, text) in rows[:i] else CUT_OFF if shown[-1] not in ".!?" else None))
    whole = steps[0]
    for m in steps[1:]:
        whole = joined(whole, m)
    end = last_state(whole)
    path = [START, *crossings(steps, START, end), end]
    audits = [m.audit[a][b] for m, a, b in zip(steps, path, path[1:])]
    audits[-1] += closing(end)
    return whole.cost[START][end] + 2 * len(closing(end)), "".join(audits)


def test_every_short_conversation():
    for n in (1, 2, 3, 4):
        for roles in itertools.product(["s", "user", "a", "x"], repeat=n):
            for ends in itertools.product([".", ""], repeat=min(n, 3)):
                rows = [(r, f"t{i}{ends[i % len(ends)]}") for i, r in enumerate(roles)]
                want = brute_force(rows)
                assert direct(rows) == (want["cost"], want["audit"])


def test_random_conversations():
    for seed in range(400):
        rows = some_rows(seed, 1 + seed % 23)
        want = brute_force(rows)
        assert direct(rows) == (want["cost"], want["audit"]), rows


def test_the_least_audit_of_all_edit_sequences():
    """All audits up to a length, without dynamic programming."""
    for seed in range(60):
        rows = some_rows(seed, 1 + seed % 3)
        found = []

        def go(i, state, cost, audit):
            if len(audit) > 9:
                return
            if i == len(rows) and state in ("", "a"):
                found.append((cost, audit))
            for name in "ua":
                if state + name in ("u", "su", "ua", "au"):
                    go(i, name, cost + 2, audit + "I")
            if i == len(rows):
                return
            role, text = rows[i]
            go(i + 1, state, cost + 3, audit + "D")
            shown = text.strip()
            if not shown or (role, text) in rows[:i]:
                return
            more = shown[-1] not in ".!?"
            if role[:1] and state + role[:1] in ("s", "u", "su", "ua", "au"):
                go(i + 1, role[0], cost + more, audit + "K")
            for name in "ua":
                if state + name in ("u", "su", "ua", "au"):
                    go(i + 1, name, cost + 2 + more, audit + "R")

        go(0, "", 0, "")
        want = brute_force(rows)
        assert min(found) == (want["cost"], want["audit"]), rows


def spark_results(spark, rows, **blocks):
    made = repair_structure(spark.createDataFrame(rows, COLUMNS).selectExpr("*", "1 AS block", "'x' AS audit", "2 AS rank"), **blocks)
    facts = {r["conversation"]: r.asDict() for r in made.conversations.collect()}
    for r in digests(made.rows).collect():
        facts[r["conversation"]] |= {"audit": r["audit"], "repaired_sha256": r["repaired_sha256"]}
    return {c: {k: v for k, v in f.items() if k != "conversation"} for c, f in facts.items()}, made


@pytest.mark.parametrize("block,fan", [(128, 512), (3, 2)])
def test_against_brute_force(spark, block, fan):
    rows = [(conv, t, *x) for conv in range(40) for t, x in enumerate(some_rows(conv, 1 + conv))]
    rows += [(None, t, *x) for t, x in enumerate(some_rows(77, 9))] + [(50, None, "user", None), (50, 0, None, "a."), (50, 0, None, "a."), (50, 1, "user", "b")]
    got, _ = spark_results(spark, rows, block_rows=block, fan=fan)
    by = defaultdict(list)
    for c, t, r, x in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        by[c].append((" " if r is None else r, " " if x is None else x))
    assert got == {c: brute_force(own) for c, own in by.items()}


def test_a_hot_conversation_is_cut(spark):
    rows = [(1, t, ("user", "assistant", "user", "system")[t % 4], f"{t % 50}.") for t in range(900)] + [(1, 5, "user", "same.")] * 300
    got, made = spark_results(spark, rows, block_rows=16, fan=4)
    own = sorted([r[1:] for r in rows], key=lambda r: r)
    assert got[1] == brute_force([r[1:] for r in own])
    assert made.rows.count() == len(rows)


def test_rows_tell_their_edits(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "Hi."), (1, 2, "user", "")]
    _, made = spark_results(spark, rows)
    got = sorted(made.rows.collect(), key=lambda r: r["rank"])
    assert [r["fault"] for r in got] == [None, "duplicate", "blank"]
    assert [t for r in got for t in turns(r["state"], r["audit"], r["role"], r["text"])] == [("user", ""), ("assistant", "Hi.")]


def test_damage(spark):
    rows = [(c, t, "system", "A. B? C!") for c in (0, -1, None) for t in (*range(40), None)]
    got = defaultdict(list)
    for r in damaged(spark.createDataFrame(rows, COLUMNS)).collect():
        got[r["conv_id"], r["turn"]].append((r["role"], r["text"]))
    for c, t, role, text in rows:
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        want = {0: [], 1: [(role, "")], 2: [(role, "A B C")], 3: [(role, text)] * 2, 4: [("user", text)]}.get(n, [(role, text)])
        assert got[c, t] == want


def test_gaps(spark):
    rows = [(1, 5), (1, 2), (1, 2), (1, None), (2, None), (None, 7), (3, -(2**63)), (3, 2**63 - 1)]
    got = {r["conversation"]: r["gaps"] for r in gaps(spark.createDataFrame(rows, "conv_id long, turn long")).collect()}
    assert got == {1: 2, 2: 0, None: 0, 3: None}


def test_query_returns_every_conversation(spark, tmp_path):
    rows = [(c, t, *x) for c in range(150) for t, x in enumerate(some_rows(c, 1 + c % 4))] + [(None, None, None, None), (None, 1, "user", "Hm.")]
    spark.createDataFrame(rows, COLUMNS).withColumn("audit", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r.asDict() for r in catalog.QUERIES["op11_structure"](spark, str(tmp_path)).collect()}
    left = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        n = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        made = [] if n == 0 else [("user" if n == 4 else role, "" if n == 1 else text.translate({46: None, 33: None, 63: None}) if n == 2 else text)] * (1 + (n == 3))
        left[c] += [(t, *m) for m in made]
    assert got.keys() == {r[0] for r in rows} and any(not v for v in left.values())
    for c, f in got.items():
        numbers = [t for t, *_ in left[c] if t is not None]
        assert f["gaps"] == (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0)
        want = brute_force([r[1:] for r in left[c]]) if left[c] else {"blank": 0, "cost": 0, "audit": "", "repaired_sha256": brute_force([(" ", "")])["repaired_sha256"]}
        assert {k: f[k] for k in want} == want


def test_empty_table(spark):
    got, made = spark_results(spark, [])
    assert got == {} and made.rows.count() == 0
    assert len(ROWS) == 16
