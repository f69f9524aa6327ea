import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from tests.llm.conftest import HARD
from tidemark.llm import packing
from tidemark.llm.packing import Capacities, WordTokenizer, best_fit_plan, pack_documents

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["it's don't I'LL <|endoftext|> x<|startoftext|>y ½ ²³ ０１ İSTANBUL Σας ΣΑΣ", "a b \x1cq é ﬁ 'sABC 's 're_x __a a'b", "<|ENDOFTEXT|> <|endoftext|>", "hello😀world 1a2b3",
       "a\x0bb\x0cc\x85d", "é café", "日本語 १२ ß STRASSE µm ª×÷"]


TOKENIZER = Tokenizer.from_file(PATH)


def direct(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [0]


def test_word_by_word_ids_are_the_tokenizers():
    texts = [t for _, t in HARD] + ODD + pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:60]
    ids, offsets = WordTokenizer(open(PATH, encoding="utf-8").read()).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == direct(text)


def best_fit_one_by_one(lengths, size):
    bins = []
    for n in sorted(lengths, reverse=True):
        open_ = [(room, i) for i, room in enumerate(bins) if room >= n]
        if open_:
            bins[min(open_)[1]] -= n
        else:
            bins.append(size - n)
    return sorted(bins)


def test_plan_equals_best_fit_one_by_one():
    for seed in range(150):
        rnd = random.Random(seed)
        size = rnd.choice([10, 17, 64])
        lengths = [rnd.randint(1, size) for _ in range(rnd.randint(0, 150))] + [rnd.randint(1, 4)] * (40 * (seed % 3 == 0))
        used, room = set(), defaultdict(lambda: size)  # noqa: B023
        for n, a, b, first, per, base in best_fit_plan(Counter(lengths), size):
            for k in range(b - a):
                sequence, offset = first + k // per, base + k % per * n
                places = {(sequence, x) for x in range(offset, offset + n)}
                assert not places & used and offset + n <= size
                used |= places
                room[sequence] -= n
        assert sorted(room.values()) == best_fit_one_by_one(lengths, size)


def test_segment_tree_finds_the_tightest():
    rnd = random.Random(1)
    tree, present = Capacities(20), set()
    for _ in range(2000):
        c, on = rnd.randint(0, 20), rnd.random() < 0.4
        tree.put(c, on)
        present = present | {c} if on else present - {c}
        least = rnd.randint(0, 20)
        assert tree.tightest(least) == min((p for p in present if p >= least), default=None)


def test_round_trip_of_documents(docs, empty):
    rows = HARD + [(100 + i, " ".join(["word"] * i)) for i in range(40)]
    got = pack_documents(docs(rows, clash=["piece", "offset", "lang"]), PATH, size=64, with_ids=True).collect()
    by_doc = defaultdict(list)
    for r in got:
        by_doc[r["doc_id"]].append(r)
        assert r["length"] == len(r["ids"]) and r["lang"] == "kept"
        assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in r["ids"]))
    for doc_id, text in rows:
        pieces = sorted(by_doc[doc_id], key=lambda r: r["piece"])
        copies = sum(i == doc_id for i, _ in rows)
        starts = [r["start"] for r in pieces][::copies]
        assert starts == list(range(0, len(direct(text)), 64))
        if copies == 1:
            assert [i for r in pieces for i in r["ids"]] == direct(text)
    sequences = defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64
    assert len(sequences) == len(best_fit_one_by_one([r["length"] for r in got], 64))
    assert pack_documents(empty, PATH).collect() == []


def test_words_of_a_large_vocabulary_are_learnt_once(monkeypatch):
    """More words than were remembered before, and once again: nothing is left to learn."""
    import pyarrow as pa
    import public_tokenizers

    from tidemark.llm.packing import WordTokenizer

    tokenizer = WordTokenizer(open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8").read())
    learnt, learn = [], tokenizer._learn
    monkeypatch.setattr(tokenizer, "_learn", lambda words, hashes: learnt.append(len(words)) or learn(words, hashes))
    parts = [pa.array([" ".join(f"{i:x}" for i in range(a, a + 65_000))]) for a in range(0, 260_000, 65_000)]
    first = [tokenizer.encode(p) for p in parts]
    assert sum(learnt) == 260_000
    again = [tokenizer.encode(p) for p in parts]
    assert sum(learnt) == 260_000
    assert all((a[0] == b[0]).all() and (a[1] == b[1]).all() for a, b in zip(first, again))


def test_remembered_words_take_little_memory(monkeypatch):
    monkeypatch.setattr(packing, "MEMO_RUNS", 5_000, raising=False)
    rnd, tokenizer = random.Random(5), WordTokenizer(open(PATH, encoding="utf-8").read())
    words = [f"{''.join(rnd.choices('abcdefgh', k=7))}{i}," for i in range(60_000)]
    texts = [" ".join(words[i : i + 2_000]) for i in range(0, len(words), 2_000)]
    tokenizer.encode(pa.array(["imports and tables come first"]))
    tokenizer._clear()
    tracemalloc.start()
    try:
        for text in texts:
            tokenizer.encode(pa.array([text]))
        held = tracemalloc.get_traced_memory()[0]
    finally:
        tracemalloc.stop()
    assert len(tokenizer.words) == len(words)
    assert held / len(words) < 200  # 99; by a dictionary of words and one of all runs, 303
    ids, _ = tokenizer.encode(pa.array([texts[3]]))
    assert ids.tolist() == direct(texts[3])


def test_numbers_of_hashes_are_a_dictionarys():
    rnd, numbers, seen = np.random.default_rng(3), packing.Numbers(), {}
    for n in (0, 1, 700, 5_000, 40_000):
        some = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
        some[: n // 2] <<= np.uint64(20)  # many begin at one place
        some = np.setdiff1d(np.append(some, np.uint64(0)), np.array(list(seen), np.uint64))
        assert (numbers.of(some) == -1).all()
        numbers.add(some)
        seen |= {k: len(seen) + i for i, k in enumerate(some.tolist())}
        assert numbers.of(np.array(list(seen), np.uint64)).tolist() == list(seen.values()) and len(numbers) == len(seen)
