import random
import zlib
from collections import defaultdict
from hashlib import md5
from itertools import accumulate

import pytest

from tests.llm.conftest import HARD
from tidemark.llm.sharding import giants, greedy_cuts, shard_documents, smallest_capacity


def best_capacity(sizes, shards):
    """Least largest part over all contiguous partitions, by dynamic programming."""
    ends = [0, *accumulate(sizes)]
    best = [0] + [float("inf")] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[j], ends[i] - ends[j]) for j in range(i + 1)) for i in range(len(ends))]
    return best[-1]


def test_smallest_capacity_is_the_best_of_all_partitions():
    rnd = random.Random(3)
    for _ in range(200):
        sizes = [rnd.randint(1, 30) for _ in range(rnd.randint(1, 14))]
        shards = rnd.randint(1, 5)
        ends, single = list(accumulate(sizes)), [True] * len(sizes)
        capacity = smallest_capacity(ends, single, shards)
        assert capacity == best_capacity(sizes, shards)
        cuts = greedy_cuts(ends, single, capacity, shards, True)
        assert len(cuts) == shards and cuts[-1] == ends[-1] and set(cuts) <= set(ends)
        assert max(b - a for a, b in zip([0, *cuts], cuts)) <= capacity


def brute_shards(rows, shards):
    """Shard of each row: giants last, the rest by exhaustive search for the capacity."""
    groups = defaultdict(int)
    for _, text in rows:
        groups[md5((text or "").encode()).hexdigest()] += len((text or "").encode()) + 1
    largest = sorted(groups.items(), key=lambda g: (-g[1], g[0]))
    alone = giants(largest, sum(groups.values()), shards)
    rest = sorted(g for g in groups if g not in alone)
    left = shards - len(alone)
    sizes = [groups[g] for g in rest]
    capacity, shard, filled, place = best_capacity(sizes, left), 0, 0, {}
    for g, size in zip(rest, sizes):
        if filled + size > capacity:
            shard, filled = shard + 1, 0
        place[g], filled = shard, filled + size
    place.update({g: left + i for i, g in enumerate(alone)})
    return [place[md5((t or "").encode()).hexdigest()] for _, t in rows]


@pytest.mark.parametrize("kind", ["small", "hot", "few", "hard"])
def test_documents_against_brute_force(spark, docs, kind):
    rnd = random.Random(7)
    rows = {
        "small": [(i, "w" * rnd.randint(0, 60) + str(i % 70)) for i in range(150)],
        "hot": [(i, "the same text" if i % 3 == 0 else f"text {i}") for i in range(120)],
        "few": [(1, "a"), (2, "b")],
        "hard": HARD,
    }[kind]
    got = shard_documents(docs(rows, clash=["shard", "SLOT", "lang"]), shards=4).collect()
    assert len(got) == len(rows)
    want = sorted((i if i is not None else -1, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), s)
                  for (i, t), s in zip(rows, brute_shards(rows, 4)))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["size"], r["text_crc32"], r["shard"]) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["lang"] == "kept"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_refined_prefixes_give_the_exact_capacity(spark, docs, monkeypatch):
    monkeypatch.setattr("tidemark.llm.sharding.FIRST_DIGITS", 1)
    monkeypatch.setattr("tidemark.llm.sharding.MORE_DIGITS", 1)
    rnd = random.Random(5)
    rows = [(i, "w" * rnd.randint(0, 200) + str(i)) for i in range(90)]
    got = {r["doc_id"]: r["shard"] for r in shard_documents(docs(rows), shards=4).collect()}
    assert [got[i] for i, _ in rows] == brute_shards(rows, 4)


def test_empty_table(empty):
    assert shard_documents(empty).collect() == []
