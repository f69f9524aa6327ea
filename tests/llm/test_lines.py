import random

import numpy as np
import pytest

from tests.llm.conftest import HARD
from tidemark.llm import lines
from tidemark.llm.lines import Cuckoo, Filters, brute_force, dedup_lines, delete, drop_lines, empty_index, insert


def some_rows(n, seed=1):
    rnd = random.Random(seed)
    pool = ["Menu", " menu\t", "MENU", "contact us", "Ä b", "ä b", "", "  ", "one\rtwo", "\x0bCookies\x0c"] + [f"line {i}" for i in range(40)]
    return [(i, "\n".join(rnd.choice(pool) for _ in range(rnd.randint(0, 12))) or None) for i in range(n)]


def result(df):
    return sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in df.collect()], key=repr)


def wanted(rows, min_docs, inserted=None):
    found = brute_force([t for _, t in rows], min_docs, None if inserted is None else [t for _, t in inserted])
    return sorted([(i, *f) for (i, _), f in zip(rows, found)], key=repr)


def test_dedup(docs):
    rows = some_rows(60) + HARD + [(99, "menu\n" * 1000), (99, "menu\n" * 1000)]
    df = docs(rows, ["N_lines", "dropped", "row", "c0", "shard", "key"])
    out = dedup_lines(df, 10)
    assert out.columns == ["doc_id", "text", "dropped", "row", "c0", "shard", "key", "n_lines", "n_dropped"]
    assert result(out) == wanted(rows, 10)
    assert out.where("dropped <> 'kept' OR row <> 'kept' OR c0 <> 'kept'").count() == 0


def test_the_shards_decide_alike(docs, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 4)
    rows = some_rows(80) + HARD
    df = docs(rows, ["dropped", "row"])
    index = insert(empty_index(df.sparkSession, 8), df)
    assert index.shards > 2 and index.filters.count() > 2
    assert result(drop_lines(df, index, broadcast_bytes=0)) == result(drop_lines(df, index, known=True)) == wanted(rows, 8)


def test_deletions_take_back(docs, monkeypatch):
    monkeypatch.setattr(lines, "SHARD_KEYS", 16)
    first, second, third = some_rows(40, 1), some_rows(50, 2), some_rows(30, 3)
    index = insert(empty_index(docs([]).sparkSession, 9), docs(first))
    both = insert(index, docs(second))
    assert result(drop_lines(docs(third), both)) == wanted(third, 9, first + second)
    back = delete(both, docs(second))
    assert sorted(map(tuple, back.counts.collect())) == sorted(map(tuple, index.counts.collect()))
    frequent = [bytes(r["key"]) for r in index.counts.where("docs >= 9").collect()]
    others = [bytes(r["key"]) for r in both.counts.where("docs >= 9").collect() if bytes(r["key"]) not in frequent]
    held = Filters([(r["shard"], bytes(r["filter"])) for r in back.filters.collect()], back.shards)
    assert held.holds(lines._words(frequent)).all() and others and not held.holds(lines._words(others)).any()
    assert result(drop_lines(docs(third), back)) == result(drop_lines(docs(third), index)) == wanted(third, 9, first)
    assert result(drop_lines(docs(first), delete(back, docs(first)))) == sorted([(i, (t or "").count("\n") + 1, 0, t or "") for i, t in first], key=repr)


def test_only_inserted_documents_can_go(docs):
    index = insert(empty_index(docs([]).sparkSession), docs([(1, "a")]))
    with pytest.raises(ValueError):
        delete(index, docs([(2, "b")]))


def test_what_a_filter_holds_by_mistake_stays(docs, monkeypatch):
    monkeypatch.setattr(lines.Filters, "holds", lambda self, words: np.ones(len(words), bool))
    rows = some_rows(40)
    index = insert(empty_index(docs([]).sparkSession, 8), docs(rows))
    assert result(drop_lines(docs(rows), index, known=True)) == wanted(rows, 8)
    assert result(drop_lines(docs(some_rows(20, 5)), index)) == wanted(some_rows(20, 5), 8, rows)


def test_cuckoo_filter():
    words = np.random.default_rng(5).integers(0, 1 << 63, (40_000, 2)).astype(np.uint64)
    mine, other = words[:20_000], words[20_000:]
    held = Cuckoo.for_keys(len(mine))
    assert held.add(mine) and held.holds(mine).all() and held.holds(other).mean() < 0.002
    assert (held.table != 0).sum() == len(mine)
    held.remove(mine[:15_000])
    assert held.holds(mine[15_000:]).all() and (held.table != 0).sum() == 5_000 and held.holds(mine[:15_000]).mean() < 0.002
    small = Cuckoo.for_keys(10)
    assert not small.add(mine[:100])


def test_a_full_filter_is_built_anew(docs):
    rows = [(i, f"a{i}\nb{i % 3}") for i in range(300)]
    spark = docs([]).sparkSession
    index = insert(empty_index(spark, 1), docs(rows[:20]))
    more = insert(index, docs(rows[20:]))
    sizes = [[len(r["filter"]) for r in i.filters.collect()] for i in (index, more)]
    assert sum(sizes[1]) > sum(sizes[0])
    assert result(drop_lines(docs(rows), more, known=True)) == wanted(rows, 1)


def test_empty_table(empty):
    assert dedup_lines(empty).collect() == []
