import random

from tests.llm.conftest import HARD
from tidemark.llm.decontamination import benchmark_hits, brute_force, decontaminate

ITEMS = [("1", "One two three four five six seven eight nine ten eleven twelve."), ("10", "short item"), ("2", None), ("3", "..."), ("1", "short item"),
         ("4", "one two three four five six seven eight nine ten"), ("5", "a a a a a a a a a a a a")]


def table(spark, items):
    return spark.createDataFrame(items, "item_id string, text string")


def test_against_brute_force(spark, docs):
    rnd = random.Random(1)
    vocabulary = "one two three four five six seven eight nine ten eleven twelve a short item É".split()
    rows = HARD + [(100 + i, rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 40)))) for i in range(40)]
    rows += [(200, "xx ONE two-three four, five six seven eight nine ten eleven é short;item y"), (201, "a " * 25), (202, "shortitem short  ITEM")]
    for block in (64 << 20, 120):  # one automaton, and several
        got = benchmark_hits(docs(rows, clash=["n_words", "items", "hits", "Hits_1", "c0", "c1"]), table(spark, ITEMS), max_block_bytes=block).collect()
        assert len(got) == len(rows)
        for r in got:
            n, hit, held = brute_force(r["text"], ITEMS)
            assert (r["n_words"], r["hit_words"], r["items"]) == (n, sorted(hit), sorted(held))


def test_long_items_in_overlapping_pieces(spark, docs, monkeypatch):
    from tidemark.llm import decontamination

    monkeypatch.setattr(decontamination, "PIECE_WORDS", 4)
    words = [f"w{i}" for i in range(60)]
    items = [("long", " ".join(words)), ("other", " ".join(words[30:41]))]
    rows = [(i, " ".join(["x", *words[i : i + 12]])) for i in range(0, 60, 3)]
    blocks = list(decontamination.item_blocks(table(spark, items), "item_id", "text", 10, 60))
    assert len(blocks) > 3 and sum(map(len, blocks)) == 14
    for r in benchmark_hits(docs(rows), table(spark, items), max_block_bytes=200).collect():
        n, hit, held = brute_force(r["text"], items)
        assert (r["n_words"], r["hit_words"], r["items"]) == (n, sorted(hit), sorted(held))


def test_offsets_point_into_the_original(spark, docs):
    text = "é日本 -- Short,\n ITEM é"
    row = benchmark_hits(docs([(1, text)]), table(spark, [("7", "short item")])).first()
    assert [text[a:b] for a, b in zip(row["hit_starts"], row["hit_ends"])] == ["Short", "ITEM"]


def test_stage_drops_only_contaminated(spark, docs, hard, empty):
    items = table(spark, ITEMS)
    kept = decontaminate(docs(HARD + [(50, "a short item")], clash=["n_words", "hits"]), items)
    assert kept.columns == ["doc_id", "text", "n_words", "hits"]
    assert kept.count() == len(HARD)
    assert decontaminate(hard, table(spark, [])).count() == len(HARD)
    assert benchmark_hits(empty, items).collect() == []
