import random
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.llm.conftest import HARD
from tests.llm.test_lm import shuffle_files
from tidemark.llm import neardup
from tidemark.llm.common import shared_table
from tidemark.llm.neardup import components, keep_one, probability_jaccard, probminhash, shingles, with_classes


def weighted(text):
    """Shingles of a text as a counter of word tuples."""
    words = "".join(c if c.isascii() and c.isalnum() or ord(c) > 127 else " " for c in (text or "")).split(" ")
    words = ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in words if w]
    n = min(5, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else Counter()


def similarity(a, b):
    return sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())


def brute_classes(rows):
    """Class id of each row by comparing all pairs of texts."""
    texts = sorted({t for _, t in rows if t is not None})
    sets, parent = [weighted(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if find(i) != find(j) and similarity(sets[i], sets[j]) >= 0.8:
                parent[find(i)] = find(j)
    ids = {}
    for doc_id, t in rows:
        if t is not None and doc_id is not None:
            root = find(texts.index(t))
            ids[root] = min(ids.get(root, doc_id), doc_id)
    return sorted((str(d), str(d if t is None else ids.get(find(texts.index(t))))) for d, t in rows)


def family(rnd, start):
    """Near copies of one text, chained so that the ends are further apart than the threshold."""
    words = [f"w{rnd.randint(0, 500)}" for _ in range(120)]
    rows = []
    for i in range(8):
        rows.append((start + i, " ".join(words)))
        at = rnd.randrange(120)
        words = words[:at] + [f"n{rnd.randint(0, 500)}"] + words[at + 1 :]
    return rows


def test_weighted_similarity_and_its_estimate():
    rnd = random.Random(2)
    for _ in range(100):
        a, b = (Counter({rnd.randint(0, 12): rnd.randint(1, 4) for _ in range(8)}) for _ in range(2))
        arrays = [(np.array(sorted(x), np.uint64), np.array([x[k] for k in sorted(x)])) for x in (a, b)]
        assert abs(similarity(a, b) - probability_jaccard(*arrays[0], *arrays[1])) < 1e-9
    keys = np.random.default_rng(1).integers(1, 1 << 62, 400).astype(np.uint64)
    a, b = Counter({int(k): 1 + i % 3 for i, k in enumerate(keys[:360])}), Counter({int(k): 1 + i % 2 for i, k in enumerate(keys[40:])})
    row = np.repeat([0, 1], [len(a), len(b)])
    element = probminhash(row, np.array([*a, *b], np.uint64), np.array([*a.values(), *b.values()]), 2, 8192)
    assert abs((element[0] == element[1]).mean() - similarity(a, b)) < 0.025


def test_shingles_are_five_words_with_weights():
    texts = ["a b c d e a b c d e a b c d e", "A, b! c d", "", None, "x", "é b c d e f"]
    row, _, weight = shingles(pa.array(texts))
    for i, t in enumerate(texts):
        assert sorted(weight[row == i].tolist()) == sorted(weighted(t).values())


def test_classes_against_all_pairs(spark, docs):
    rnd = random.Random(6)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [r for k in range(5) for r in family(rnd, 100 * k + 50)]
    rows += [(700 + i, passage + " " + " ".join(f"w{rnd.randint(0, 500)}" for _ in range(20 + 2 * i))) for i in range(12)]  # a shared passage
    rows += [(800 + i, "the same text many times over and over") for i in range(30)] + HARD
    got = with_classes(docs(rows, clash=["class_id"])).collect()
    assert sorted((str(r["doc_id"]), str(r["class_id"])) for r in got) == brute_classes(rows)


def test_one_document_of_each_class_stays(docs, empty):
    rnd = random.Random(8)
    rows = family(rnd, 10) + family(rnd, 30) + [(5, "same"), (5, "same"), (3, "same"), (90, None), (91, None)]
    kept = keep_one(docs(rows, clash=["digest", "class"]))
    assert kept.columns == ["doc_id", "text", "digest", "class"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 10, 30, 90, 91]
    assert [r["doc_id"] for r in keep_one(docs([(5, "same"), (5, "same")])).collect()] == [5]
    assert keep_one(empty).collect() == [] and with_classes(empty).collect() == []


def test_components_of_chains(spark):
    edges = [(f"{i:03}", f"{i + 1:03}") for i in range(40)] + [("900", "905"), ("905", "901")]
    df = spark.createDataFrame([(bytearray(a.encode()), bytearray(b.encode())) for a, b in edges], "a binary, b binary")
    got = {bytes(r["node"]).decode(): bytes(r["label"]).decode() for r in components(df).collect()}
    assert got == {f"{i:03}": "000" for i in range(41)} | {"900": "900", "901": "900", "905": "900"}


def test_stored_tables_leave_no_shuffle_files(spark, docs, monkeypatch):
    stored, left = [], set()

    def store(df, name, **how):
        before = shuffle_files(spark)
        table = shared_table(df, name, **how)
        stored.append(name)
        left.update((name, f) for f in shuffle_files(spark) - before)
        return table

    monkeypatch.setattr(neardup, "shared_table", store)
    rnd = random.Random(9)
    kept = keep_one(docs([r for k in range(4) for r in family(rnd, 100 * k + 50)] + [(1, "same"), (2, "same")])).collect()
    assert sorted(r["doc_id"] for r in kept) == [1, 50, 150, 250, 350]
    assert {"signatures", "bucket-members", "shingles", "star-edges", "edges", "labels", "class-bests"} <= set(stored)
    assert not left
