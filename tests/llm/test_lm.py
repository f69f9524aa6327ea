import math
import pickle
import random
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tests.llm.conftest import HARD
from tidemark.llm import lm
from tidemark.llm.common import CLEANUP, shared_table
from tidemark.llm.jvm import DAYS


def prose(seed, n):
    rnd = random.Random(seed)
    words = "the of and cat sat on mat with hat that was there when all others were gone away from home".split()
    return [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(5, 60)))) for i in range(n)]


def test_base_score_against_plain_python_and_held_out_accuracy(docs):
    rows = prose(1, 150) + [(1000 + i, t) for i, (_, t) in enumerate(HARD)] + [(2000, "Xylophone  zebra\tTHE")]
    table = docs(rows, clash=["score", "bytes", "lang"]).withColumn("held", lm.held_out(F.col("doc_id")))
    model = lm.fit(table.where("NOT held").select("text"))
    count = Counter()
    for i, t in rows:
        if zlib.crc32(str(i).encode()) % 7 != 2:
            count.update((t or "").encode().lower().split() + [None])
    total = sum(count.values())
    assert (model.tokens, model.types) == (total, len(count))
    got = {r["doc_id"]: r for r in lm.score_texts(table, model).collect()}
    assert len(got) == len(rows)
    better = 0
    for i, t in rows:
        tokens = (t or "").encode().lower().split() + [None]
        base = sum(math.log10((count[w] + 1) / (total + len(count) + 1)) for w in tokens)
        r = got[i]
        assert r["held"] == (zlib.crc32(str(i).encode()) % 7 == 2) and r["lang"] == "kept"
        assert (r["n_tokens"], r["n_known"]) == (len(tokens), sum(count[w] > 0 for w in tokens))
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["score"] < 0
        better += i < 150 and r["held"] and r["bits_per_byte"] < 4
    assert better == sum(i < 150 and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows)


def test_rare_words_are_joined(docs, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT_WORDS", 3)
    table = docs(prose(2, 60) + [(500 + i, "the " * 50 + "cat " * 20) for i in range(20)])
    model = lm.fit(table.select("text"))
    assert 0 < len(model.frequent[0]) <= 3
    assert all(r["n_known"] == r["n_tokens"] for r in lm.score_texts(table, model).collect())


class AnyTable:
    """Log-odds and how often seen for whatever key is asked."""

    def __init__(self, least=-60, most=60):
        self.least, self.spread = least, most - least + 1

    def values(self, keys):
        keys = lm.mix64(keys)
        odds = (self.least + (keys % np.uint64(self.spread)).astype(np.float32)) / np.float32(16)
        return odds.astype(np.float32), ((keys >> np.uint64(40)) % np.uint64(3)).astype(np.int8)


def test_scores_are_a_probability():
    """Over all continuations by one byte and the end, the chances add up to one."""
    pairs = np.random.default_rng(3).integers(0, 3, (256, 256))
    trees, table = lm.Trees(pairs), AnyTable()
    data = b"".join(b"\n" * lm.LEAD + b"ab" + bytes([x]) for x in range(256))
    offsets = np.arange(257) * (lm.LEAD + 3)
    three = lm.score([b""] * 256, np.frombuffer(data, np.uint8), offsets, trees, table)
    two = lm.score([b""], np.frombuffer(b"\n" * lm.LEAD + b"ab", np.uint8), np.array([0, lm.LEAD + 2]), trees, table)
    assert abs((10.0**three).sum() / 10.0 ** two[0] - 1) < 1e-4


def plain_score(raw, trees, table):
    """The mixer one decision after the other, in plain Python: predictions from the weights as
    they were at the last multiple of STEP bytes, updates summed up until the next."""
    data = np.frombuffer(bytes([lm.END]) * lm.LEAD + raw, np.uint8)
    places = np.arange(lm.LEAD, len(data))
    contexts = lm._contexts(data, places)
    weights = {g: [float(w) for w in lm.FIRST_WEIGHTS] for g in range(9)}
    scale = (lm.BUCKETS - 0.01) / (2 * float(lm.LIMIT))
    refine = [1 / (1 + math.exp(-((b + 0.5) / scale - float(lm.LIMIT)))) for b in range(lm.BUCKETS)]
    total = 0.0
    for begin in range(0, len(places), lm.STEP):
        more_w, more_r = [], []
        for i in range(begin, min(begin + lm.STEP, len(places))):
            pair = int(data[places[i] - 1]) * 256 + int(data[places[i]])
            for node in range(trees.begin[pair], trees.begin[pair + 1]):
                asked = [table.values(lm.mix64(np.array([c[i]]) ^ trees.spread[node])) for c in contexts]
                odds, seen = [float(o[0]) for o, _ in asked], [int(n[0]) for _, n in asked]
                gate, turn = seen[-1] * 3 + seen[0], int(trees.turns[node])
                x = max(-float(lm.LIMIT), min(float(lm.LIMIT), sum(w * o for w, o in zip(weights[gate], odds))))
                p, bucket = 1 / (1 + math.exp(-x)), int((x + float(lm.LIMIT)) * scale)
                chance = min(max(p + float(lm.MAP_SHARE) * (refine[bucket] - p), 1 / 4096), 1 - 1 / 4096)
                total += math.log10(chance if turn else 1 - chance)
                more_w += [(gate, k, lm.RATE * (turn - p) * o) for k, o in enumerate(odds)]
                more_r.append((bucket, float(lm.MAP_RATE) * (turn - refine[bucket])))
        for gate, k, d in more_w:
            weights[gate][k] += d
        for bucket, d in more_r:
            refine[bucket] += d
        refine = [min(max(r, 0), 1) for r in refine]
    return total


def test_against_a_plain_mixer():
    """The branch that the query runs, over learnt counts, beside a slow one."""
    texts = [t for _, t in prose(4, 12)] + ["", "É ß", None, "the cat " * 40]
    own, data, offsets = lm.streams(pa.array(texts))
    places = lm.coded_places(offsets)
    pairs = np.bincount(data[places - 1].astype(int) * 256 + data[places], minlength=1 << 16).reshape(256, 256)
    trees, counts = lm.Trees(pairs), lm.ShardCounts()
    counts.add(pa.array([t for _, t in prose(5, 60)]))
    table = counts.table(trees)
    got = lm.score(own, data, offsets, trees, table)
    assert np.allclose(got, [plain_score(raw, trees, table) for raw in own], rtol=2e-4)


def test_a_score_does_not_depend_on_the_company():
    texts = [t for _, t in prose(4, 30)] + [None, "", "word " * 5000]
    own, data, offsets = lm.streams(pa.array(texts))
    places = lm.coded_places(offsets)
    pairs = np.bincount(data[places - 1].astype(int) * 256 + data[places], minlength=1 << 16).reshape(256, 256)
    trees = lm.Trees(pairs)
    tables = AnyTable(12, 12)
    together = lm.score(own, data, offsets, trees, tables)
    alone = [lm.score(*lm.streams(pa.array([t])), trees, tables)[0] for t in texts]
    assert np.allclose(together, alone, rtol=1e-5)


def even_model(text):
    own, data, offsets = lm.streams(pa.array([text]))
    places = lm.coded_places(offsets)
    pairs = np.bincount(data[places - 1].astype(int) * 256 + data[places], minlength=1 << 16).reshape(256, 256)
    return lm.Trees(pairs), AnyTable(12, 12)


def test_what_a_text_teaches_is_kept_to_its_end():
    """Eight times a piece of 8192 bytes: what it teaches holds behind it."""
    trees, tables = even_model("a" * 1000)
    once, often = (lm.score(*lm.streams(pa.array(["a" * 8192 * n])), trees, tables)[0] for n in (1, 8))
    assert 2 * once < often < once
    assert lm.STEP <= 8


def test_no_chance_leaves_its_bounds(monkeypatch):
    """A map that learns too fast oversteps one; a chance doesn't."""
    monkeypatch.setattr(lm, "MAP_RATE", np.float32(3))
    text = "a" * 20_000
    trees, tables = even_model(text)
    own, data, offsets = lm.streams(pa.array([text]))
    taken = trees.begin[ord("a") * 256 + ord("a") + 1] - trees.begin[ord("a") * 256 + ord("a")]
    least = -math.log10(1 - 1 / 4096) * taken * 19_000
    assert -lm.score(own, data, offsets, trees, tables)[0] >= least


def test_shards_score_every_row_once(docs, monkeypatch):
    monkeypatch.setattr(lm, "SHARD_BYTES", 2000)
    rows = prose(6, 80) + [(1000 + i, t) for i, (_, t) in enumerate(HARD)] + [(7, "twice")] * 2
    table = docs(rows, ["shard", "trains", "kept"])
    model = lm.fit(table.where("doc_id % 3 <> 0 OR doc_id IS NULL"))
    assert model.shards > 5
    got = lm.score_texts(table, model).collect()
    assert sorted(r["doc_id"] or -1 for r in got) == sorted(i or -1 for i, _ in rows)
    assert all(r["score"] < 0 and r["shard"] == r["kept"] == "kept" for r in got)
    twice = {(r["score"], r["base_score"]) for r in got if r["doc_id"] == 7 and r["n_tokens"] == 2}
    assert len(twice) == 1


def test_empty_tables(docs, empty):
    model = lm.fit(empty.select("text"))
    assert lm.score_texts(empty, model).collect() == []
    got = lm.score_texts(docs(HARD), model).collect()
    assert len(got) == len(HARD) and all(r["n_known"] == 0 for r in got)


def test_every_context_is_counted_by_itself(monkeypatch):
    """Against counts by plain Python; words that end alike are told apart."""
    texts = [t for _, t in prose(7, 40)] + ["abcdefghij abcdefghijk xbcdefghij", "", None]
    monkeypatch.setattr(lm, "HELD_COUNTS", 300)
    own, data, offsets = lm.streams(pa.array(texts))
    places = lm.coded_places(offsets)
    trees, counts = lm.Trees(np.bincount(data[places - 1].astype(int) * 256 + data[places], minlength=1 << 16).reshape(256, 256)), Counter()
    learnt = lm.ShardCounts()
    for t in texts:
        learnt.add(pa.array([t], pa.string()))
    model = learnt.table(trees)
    for text in texts:
        data = b"\n" * lm.LEAD + b" ".join((text or "").encode().lower().split()) + b"\n"
        for at in range(lm.LEAD, len(data)):
            word = max(data.rfind(b" ", 0, at), data.rfind(b"\n", 0, at)) + 1
            pair = data[at - 1] * 256 + data[at]
            for step in range(trees.begin[pair], trees.begin[pair + 1]):
                for context in (data[at - 3 : at], data[at - 4 : at], (data[word:at], data[at - 1])):
                    counts[context, int(trees.spread[step]), int(trees.turns[step])] += 1
    nodes = {(context, node) for context, node, _ in counts}
    odds = sorted(math.log((counts[c, n, 1] + 0.4) / (counts[c, n, 0] + 0.4)) for c, n in nodes)
    assert np.allclose(np.sort(model.odds[:-1]), odds, atol=1e-5)
    levels = Counter(min(2, (counts[c, n, 0] + counts[c, n, 1] + 3) // 4) for c, n in nodes)
    assert Counter(model.level[:-1].tolist()) == levels
    keys = np.random.default_rng(1).integers(0, 1 << 63, 5000).astype(np.uint64)
    table = lm.ContextTable(keys, np.arange(5000, dtype=np.float32), np.ones(5000, np.int8))
    assert (table.values(keys)[0] == np.arange(5000)).all() and not table.values(keys + np.uint64(1))[1].any()


def test_a_text_is_scored_by_the_whole_corpus(docs, monkeypatch):
    """Copies of a text in other rows, and in any shard, tell the same of it; whether a context
    is held by every task or joined makes no difference."""
    rnd = random.Random(9)
    odd = " ".join("".join(rnd.choice("abcdefghijklmnop") for _ in range(9)) for _ in range(60))
    rows = prose(8, 200) + [(1000, odd)] + [(2000 + i, odd) for i in range(12)]
    table = docs(rows)
    found = []
    for shard_bytes, held in ((1 << 24, 1 << 20), (2000, 1 << 20), (2000, 300), (2000, 0)):
        monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)
        monkeypatch.setattr(lm, "HELD_CONTEXTS", held)
        model = lm.fit(table.where("doc_id <= 1000"))
        assert (model.shards == 1) == (shard_bytes > 2000)
        found.append({r["doc_id"]: r["score"] for r in lm.score_texts(table, model).collect()})
        assert len(found[-1]) == len(rows)
        assert all(math.isclose(found[-1][2000 + i], found[-1][1000], rel_tol=1e-4) for i in range(12))
        assert all(math.isclose(s, found[0][k], rel_tol=1e-4) for k, s in found[-1].items())
    unseen = {r["doc_id"]: r["score"] for r in lm.score_texts(table, lm.fit(table.where("doc_id < 1000"))).collect()}
    assert unseen[2000] < 2 * found[0][2000]


def test_a_table_is_the_same_after_it_was_sent():
    import pickle

    learnt = lm.ShardCounts()
    learnt.add(pa.array([t for _, t in prose(11, 300)]))
    table = learnt.table(lm.Trees(np.ones((256, 256), np.int64)))
    for t in (table, lm.ShardCounts().table(lm.Trees(np.ones((256, 256), np.int64)))):
        raw = pickle.dumps(t)
        sent = pickle.loads(raw)
        for name in ("first", "check", "odds", "level", "shift"):
            one, other = getattr(t, name), getattr(sent, name)
            assert one.dtype == other.dtype and (one == other).all()
    assert len(pickle.dumps(table)) < table.first.nbytes + table.check.nbytes + table.odds.nbytes


def traced_peak(do):
    tracemalloc.start()
    try:
        return do(), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_a_table_is_opened_and_merged_in_little_more_memory_than_it_takes():
    rnd = np.random.default_rng(2)
    keys = rnd.integers(0, 1 << 63, 600_000, dtype=np.uint64) * np.uint64(2) + rnd.integers(0, 2, 600_000, dtype=np.uint64)
    odds, level = rnd.normal(size=len(keys)).astype(np.float32), rnd.integers(1, 3, len(keys)).astype(np.int8)
    whole = lm.ContextTable(keys, odds, level)
    size = sum(a.nbytes for a in (whole.first, whole.check, whole.odds, whole.level))
    raw = pickle.dumps(whole)
    again, peak = traced_peak(lambda: pickle.loads(raw))
    assert peak < 1.8 * size  # 1.4; by sums of eight bytes each, 2.3
    parts = [lm._in_order(keys[a : a + 70_000], odds[a : a + 70_000], level[a : a + 70_000]) for a in range(0, len(keys), 70_000)]
    merged, peak = traced_peak(lambda: lm.ContextTable.of_parts(parts))
    assert peak < 2 * size
    asked = np.append(keys, rnd.integers(0, 1 << 63, 1000, dtype=np.uint64))
    for table in (whole, again, merged):
        assert (table.first == whole.first).all()
        got = table.values(asked)
        assert (got[0][: len(keys)] == odds).all() and (got[1][: len(keys)] == level).all()


def test_packs_hold_long_lists_and_large_counts():
    contexts = np.array([5, 1 << 62, 9], np.int64)
    sizes = np.array([1, 300, 2], np.int32)
    pairs, n = np.arange(303) * 200 % 65536, np.arange(303) ** 4 + 1
    n[[0, 301, 302]] = 254, 255, 256
    packs = pa.array([lm._pack(contexts, sizes, n * 65536 + pairs), lm._pack(contexts[:1], sizes[:1], np.array([7 * 65536 + 3]))], pa.binary())
    (got,) = lm._opened(packs)
    assert got[0].tolist() == np.repeat(contexts, sizes).tolist() + [5]
    assert got[1].tolist() == [*pairs.tolist(), 3] and got[2].tolist() == [*n.tolist(), 7]


def shuffle_files(spark):
    """Shuffle files on the session's disks, which are one machine's in tests."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {f for f in (files.apply(i).getName() for i in range(files.size())) if f.startswith("shuffle_")}


def test_stored_tables_leave_no_shuffle_files(spark, docs):
    table = docs(prose(3, 200))
    before = shuffle_files(spark), spark.conf.get(CLEANUP, None)
    counts = lm.corpus_counts(table.select("text"))
    lm.context_counts(counts)
    assert not shuffle_files(spark) - before[0]
    assert spark.conf.get(CLEANUP, None) == before[1]
    shared_table(table.repartition(3), "kept-shuffles")
    assert spark.conf.get(CLEANUP, None) == before[1]


def test_texts_and_answers_are_shuffled_small(docs):
    """In order, contexts take less than eight bytes each; texts are less than three fifths of themselves."""
    rnd = np.random.default_rng(5)
    contexts = np.sort(rnd.integers(-(1 << 63), (1 << 63) - 1, 20_000))
    pack = lm._pack(contexts, np.ones(20_000, np.int32), 65536 + rnd.integers(97, 123, 20_000))
    assert len(pack) < 8 * 20_000  # 12 bytes each uncompressed
    ((got, pairs, n),) = lm._opened(pa.array([pack], pa.binary()))
    assert (got.view(np.int64) == contexts).all() and (n == 1).all()
    rows = [*((i, " ".join(t for _, t in prose(20 + i, 60))) for i in range(20)), (500, None), (501, ""), (502, "É ß\n" * 40)]
    plain = docs(rows).select(F.lit(3).cast("long").alias("shard"), "text", F.struct("doc_id").alias("kept"))
    sent = lm._packed(plain).toArrow().combine_chunks().to_batches()[0]
    texts = lm._unpacked_texts(sent.column(1).to_numpy(), sent.column(2)).to_pylist()
    assert dict(zip((k["doc_id"] for k in sent.column(3).to_pylist()), texts)) == {i: (t or "").encode() for i, t in rows}
    assert sum(map(len, sent.column(2).to_pylist())) < 0.6 * sum(map(len, texts))


def test_runs_of_texts_come_to_the_limit():
    assert list(lm._runs(np.array([0, 0, 5, 5, 30, 1, 9]), 10)) == [(0, 4), (4, 5), (5, 7)]
    assert list(lm._runs(np.array([], np.int64), 10)) == []


def test_scoring_a_slice_takes_bounded_memory_per_byte():
    rnd = random.Random(4)
    words = ["".join(rnd.choices("etaoinshr", k=rnd.randint(2, 9))) for _ in range(4_000)]
    own, data, offsets = lm.streams(pa.array([" ".join(rnd.choices(words, k=300)) for _ in range(150)]))
    places = lm.coded_places(offsets)
    pairs = np.bincount(data[places - 1].astype(int) * 256 + data[places], minlength=1 << 16).reshape(256, 256)
    trees, empty = lm.Trees(pairs), lm.ContextTable(np.zeros(0, np.uint64), np.zeros(0, np.float32), np.zeros(0, np.int8))
    lm.score(own, data, offsets, trees, empty)
    _, peak = traced_peak(lambda: lm.score(own, data, offsets, trees, empty))
    assert peak / len(data) < 260  # 200; with all decisions' columns held twice, 391


def test_words_that_begin_alike_are_looked_up_once():
    _, data, offsets = lm.streams(pa.array(["stone stones stoned stone", "stones", "", None, "stony s"]))
    pairs, places = lm._pairs(data, lm.coded_places(offsets)), lm.coded_places(offsets)
    laid = lm.Decisions.__new__(lm.Decisions)
    contexts, own, which = laid._by_word(data, places, lm.Words(data, offsets))
    assert len(set(zip(contexts.tolist(), own.tolist()))) == len(contexts)
    assert (own.take(which) == pairs).all()
    assert (contexts.take(which) == lm._contexts(data, places)[lm.CONTEXTS.index(0)]).all()


def test_keys_of_one_bucket_are_found():
    """Buckets of many keys, keys that differ in what a bucket leaves out, an empty table."""
    rnd = np.random.default_rng(11)
    keys = np.unique(np.concatenate([rnd.integers(0, 1 << 63, 400), (1 << 62) + rnd.integers(0, 1 << 32, 400)]).astype(np.uint64))
    odds = rnd.normal(size=len(keys)).astype(np.float32)
    table = lm.ContextTable(keys, odds, np.ones(len(keys), np.int8))
    asked = np.concatenate([keys[::-1], keys + np.uint64(1)])
    want = {int(k): o for k, o in zip(keys, odds)}
    got, level = table.values(asked)
    assert got.tolist() == [float(want.get(int(k), 0)) for k in asked]
    assert level.tolist() == [int(int(k) in want) for k in asked]
    got, level = lm.ContextTable(keys[:0], odds[:0], np.zeros(0, np.int8)).values(asked)
    assert not got.any() and not level.any()


def test_shards_fill_whole_rounds_of_tasks(spark, docs, monkeypatch):
    cores = spark.sparkContext.defaultParallelism
    train = docs(prose(12, 90))
    size = int(lm.fit(train).shards)
    assert size == 1  # one shard stays one
    for least in (1, 2 * cores + 1):
        _, data, offsets = lm.streams(pa.array([t for _, t in prose(12, 90)]))
        total = len(lm.coded_places(offsets))
        monkeypatch.setattr(lm, "SHARD_BYTES", -(-total // (least + 1)))
        shards = lm.fit(train).shards
        assert shards > least and shards % cores == 0


def learnt(texts):
    """Trees and the table of counts of texts, by numpy in memory."""
    _, data, offsets = lm.streams(texts)
    pairs = np.bincount(lm._pairs(data, lm.coded_places(offsets)), minlength=1 << 16).reshape(256, 256)
    counts = lm.ShardCounts()
    counts.add(texts)
    trees = lm.Trees(pairs)
    return trees, counts.table(trees)


def test_the_query_scores_as_numpy_does(spark, monkeypatch):
    """Whatever is held or asked for; a context before all bytes, bytes that are no text, large counts."""
    texts = [t.encode() for _, t in prose(14, 150)] + [(t or "").encode() for _, t in HARD] + [b" ".join(b"ab" + bytes([x]) for x in range(256)), b"\xff\xfe  A\tB"]
    trees, table = learnt(pa.array(texts))
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, raw binary").select("doc_id", F.col("raw").cast("string").alias("text"))
    want = lm.score(*lm.streams(pa.array(texts)), trees, table)
    for shard_bytes, held in ((1 << 24, 1 << 21), (100_000, 500), (100_000, 0)):
        monkeypatch.setattr(lm, "SHARD_BYTES", shard_bytes)
        monkeypatch.setattr(lm, "HELD_CONTEXTS", held)
        got = {r["doc_id"]: r["score"] for r in lm.score_texts(rows, lm.fit(rows.select("text"))).collect()}
        assert all(math.isclose(got[i], x, rel_tol=1e-6) for i, x in enumerate(want))


def test_counts_of_a_table_against_plain_python(docs):
    """With a word longer than what is laid out at once."""
    rows = prose(15, 300) + [(1000 + i, t) for i, (_, t) in enumerate(HARD)] + [(2000, "".join(random.Random(13).choices("abcdefghijklmnopqrstuvwxyz", k=2_200_000)))]
    words, pairs, contexts = Counter(), Counter(), Counter()
    for _, t in rows:
        own = (t or "").encode().lower().split()
        words.update(own)
        data = b"\n" * lm.LEAD + b" ".join(own) + b"\n"
        array = np.frombuffer(data, np.uint8)
        places = np.arange(lm.LEAD, len(data))
        own_pairs = (array[places - 1].astype(int) << 8 | array[places]).tolist()
        pairs.update(own_pairs)
        for k, keys in enumerate(lm._contexts(array, places)):
            contexts.update(zip([3 if k == lm.CONTEXTS.index(0) else 2] * len(places), keys.view(np.int64).tolist(), own_pairs))
    got = lm.corpus_counts(docs(rows).select("text").repartition(3)).collect()
    assert {r["key"]: r["n"] for r in got if r["kind"] == 0} == dict(pairs)
    assert sorted(r["n"] for r in got if r["kind"] == 1) == sorted(words.values())
    assert {(r["kind"], r["key"], s & 0xFFFF): s >> 16 for r in got if r["kind"] > 1 for s in r["steps"]} == dict(contexts)
    assert all(r["n"] == sum(s >> 16 for s in r["steps"]) for r in got if r["kind"] > 1)
    assert len(got) == len({(r["kind"], r["key"]) for r in got})


def test_no_python_worker_goes_over_bytes(docs, monkeypatch):
    """Workers pack the held contexts and compress texts; counts, questions, answers and scores don't go through them."""
    made = []
    monkeypatch.setattr(lm, "map_arrow", lambda df, run, schema, run_there=lm.map_arrow: made.append(run.__qualname__.split(".")[0]) or run_there(df, run, schema))
    table = docs(prose(16, 50))
    assert len(lm.score_texts(table, lm.fit(table.select("text"))).collect()) == 50
    assert sorted(made) == ["_held_packs", "_packed"]


def test_columns_of_any_kind_are_kept(spark):
    kept = spark.sql("""SELECT id AS doc_id, concat('a text ', id) AS text, CAST('1582-10-10' AS date) + CAST(id AS int) AS day,
        TIMESTAMP '0099-03-01 00:00:00.000001' AS moment, TIMESTAMP_NTZ '1500-02-28 01:02:03.4' AS wall, CAST('123456789.123456789012345678' AS decimal(38, 18)) AS price,
        CAST(X'00FF' AS binary) AS raw, array(named_struct('a', id, 'b', NULL)) AS list, map('k', array(1.5D, NULL)) AS map, CAST(NULL AS int) AS none, id % 2 = 0 AS even,
        CAST(id AS tinyint) AS tiny, INTERVAL '1 02:03:04.000005' DAY TO SECOND AS span FROM range(7)""")
    names = [c for c in kept.columns if c != "text"]
    got = lm.score_texts(kept, lm.fit(kept.select("text"))).select(*names)
    assert got.schema.simpleString() == kept.select(*names).schema.simpleString()
    shown = [F.col(c).cast("string") for c in names]
    assert spark.conf.get(DAYS) == "false"
    assert sorted(map(tuple, got.select(*shown).collect())) == sorted(map(tuple, kept.select(*shown).collect()))
