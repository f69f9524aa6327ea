"""Near-duplicate documents by ProbMinHash over weighted word shingles.

An element (a run of five words) with weight w (how often it occurs) sends
arrivals of a Poisson process of rate w to random registers; a register keeps
the element whose arrival is first. Two texts agree in a register with a
probability that is their probability Jaccard similarity. Arrivals later than
the last register's first can change nothing, so an element ends there.

Registers are banded. Texts that share a band are compared exactly, first with
the bucket's centre (a star, so a bucket of n texts gives n-1 pairs); what is then
still unconnected within a bucket is compared with all its other texts, in blocks
that give one pair for two components at most. Connected components of the
verified pairs are the classes. Equal texts are one node throughout.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import ALNUM, SpanHash, flat, map_arrow, map_texts, mix64, quoted, shared_table, slices, windows, without, word_spans

SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: At similarity 0.8 a pair shares no band with probability 0.0017, at 0.85 with 0.00003.
BANDS, BAND_ROWS = 21, 6
REGISTERS = BANDS * BAND_ROWS
#: Most bits of the bitmap of digests (32 MB), and of a part of it.
MAP_BITS, PART_BITS = 28, 1 << 15
#: Members of a star that are compared with its centre in one block.
STAR_TEXTS = 1024
#: Shingles of a bucket's texts that are compared with as many others at once (about 128 texts of middling length).
BLOCK_SHINGLES = 1 << 15

SIGNATURE = T.StructType([T.StructField("bands", T.ArrayType(T.LongType(), False))])
SHINGLES = T.StructType([T.StructField("keys", T.ArrayType(T.LongType(), False)), T.StructField("weights", T.ArrayType(T.IntegerType(), False))])


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct shingles of each text: row, 64-bit key, weight; by row, then key.

    Words are letters, digits and all non-ASCII, A-Z lowered. A text of fewer
    than five words is one shingle, one of none has none."""
    data, offsets = flat(texts)
    starts, ends, rows = word_spans(data, offsets, ALNUM)
    words = SpanHash(data, fold=True).spans(starts, ends)
    counts = np.diff(rows)
    row_of_word = np.repeat(np.arange(len(counts)), counts)
    keys, owner = [], []
    for n in range(1, SHINGLE_WORDS + 1):
        window = windows(words, n)
        first = row_of_word[: len(window)]
        whole = first == row_of_word[n - 1 :] if len(window) else np.zeros(0, bool)
        if n < SHINGLE_WORDS:
            whole &= counts[first] == n
        keys.append(window[whole])
        owner.append(first[whole])
    key, row = np.concatenate(keys), np.concatenate(owner)
    order = np.lexsort((key, row))
    key, row = key[order], row[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    return row[at], key[at], np.diff(np.append(at, len(key)))


def probminhash(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """The element in each register, [row, register]; zeros for a row of no elements."""
    first = np.full(n_rows * registers, np.inf)
    element = np.zeros(n_rows * registers, np.uint64)
    row, rate, at = row.astype(np.int64), weight.astype(float), np.zeros(len(key))
    latest = np.full(n_rows, np.inf)
    arrival = 0
    while len(key):
        arrival += 1
        random = mix64(key + np.uint64((arrival * 0x9E3779B97F4A7C15) & (2**64 - 1)))
        at = at - np.log(((random >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / rate
        register = row * registers + (mix64(random ^ np.uint64(0xA0761D6478BD642F)) % np.uint64(registers)).astype(np.int64)
        sooner = at < first[register]
        place, time = register[sooner], at[sooner]
        np.minimum.at(first, place, time)
        won = time == first[place]
        element[place[won]] = key[sooner][won]
        latest = first.reshape(n_rows, registers).max(1)
        going = at < latest[row]
        row, key, rate, at = row[going], key[going], rate[going], at[going]
    return element.reshape(n_rows, registers)


def _signatures(texts: pa.Array) -> dict:
    row, key, weight = shingles(texts)
    element = probminhash(row, key, weight, len(texts))
    number = np.arange(BANDS, dtype=np.uint64)
    bands = np.zeros((len(texts), BANDS), np.uint64)
    for i in range(BAND_ROWS):
        bands = bands * np.uint64(0x9FB21C651E98DF25) + element[:, i * BANDS : (i + 1) * BANDS]
    bands = mix64(mix64(bands) + number)
    some = np.bincount(row, minlength=len(texts)) > 0
    ends = np.concatenate([[0], np.cumsum(some * BANDS)])
    return {"bands": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(bands[some].ravel().view(np.int64)))}


def _shingles_of(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``digest``, ``keys``, ``weights`` of the ``wanted`` digests. A bitmap of a part of their digests,
    of bounded size, keeps most other texts from being hashed and shuffled; the join
    drops those that only share a bit."""
    n = wanted.count()
    bits = 1 << min(MAP_BITS, max(20, (16 * n).bit_length()))
    place = F.conv(F.substring(F.hex("digest"), 1, 12), 16, 10).cast("long") % bits
    parts = (wanted.select(F.floor(place / PART_BITS).alias("part"), (place % PART_BITS).alias("bit"))
             .groupBy("part").agg(F.bitmap_construct_agg("bit").alias("bitmap")).collect())
    bitmap = np.zeros(bits // 8, np.uint8)
    for r in parts:
        bitmap[r["part"] * PART_BITS // 8 :][: PART_BITS // 8] = np.frombuffer(r["bitmap"], np.uint8)
    shared = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = shared.value
        for batch in batches:
            digest = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, 16)[:, :6].astype(np.int64)
            at = (digest << np.arange(40, -1, -8)).sum(1) % bits
            for part in slices(batch.filter(pa.array((bitmap[at >> 3] >> (at & 7)) & 1 == 1)), 1):
                got = _shingle_lists(part.column(1))
                yield pa.RecordBatch.from_arrays([part.column(0), got["keys"], got["weights"]], names=["digest", "keys", "weights"])

    schema = T.StructType([T.StructField("digest", T.BinaryType()), *SHINGLES.fields])
    found = map_arrow(texts.select("digest", "text"), run, schema)
    return found.groupBy("digest").agg(F.first("keys").alias("keys"), F.first("weights").alias("weights")).join(wanted, "digest", "left_semi")


def _shingle_lists(texts: pa.Array) -> dict:
    row, key, weight = shingles(texts)
    ends = pa.array(np.searchsorted(row, np.arange(len(texts) + 1)), pa.int32())
    return {"keys": pa.ListArray.from_arrays(ends, pa.array(key.view(np.int64))), "weights": pa.ListArray.from_arrays(ends, pa.array(weight, pa.int32()))}


def probability_jaccard(key_a: np.ndarray, weight_a: np.ndarray, key_b: np.ndarray, weight_b: np.ndarray) -> float:
    """Sum over common d of 1 / sum over all e of max(a_e / a_d, b_e / b_d)."""
    common, in_a, in_b = np.intersect1d(key_a, key_b, assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    a, b = weight_a[in_a].astype(float), weight_b[in_b].astype(float)
    only_a, only_b = weight_a.sum() - a.sum(), weight_b.sum() - b.sum()
    order = np.argsort(a / b)
    a, b = a[order], b[order]
    # e counts by a where a_e / b_e is at least a_d / b_d, which is from d on in this order
    from_a = np.cumsum(a[::-1])[::-1]
    before_b = np.cumsum(b) - b
    return float((1 / ((only_a + from_a) / a + (only_b + before_b) / b)).sum())


def _verified(threshold: float):
    """Of rows by (rep, block), a centre's own shingles first and then its members', the
    pairs of at least ``threshold`` similarity; a task holds one centre."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre = None
        for batch in batches:
            digest, rep = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keys, weights = batch.column(2), batch.column(3)
            similar = []
            for i, own in enumerate(digest):
                lists = keys[i].values.to_numpy(zero_copy_only=False), weights[i].values.to_numpy(zero_copy_only=False)
                if own is None:
                    centre = tuple(x.copy() for x in lists)
                similar.append(own is not None and probability_jaccard(*lists, *centre) >= threshold)
            chosen = [i for i, s in enumerate(similar) if s]
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for i in chosen], pa.binary()) for x in (digest, rep)], names=["digest", "rep"])

    return run


class _Texts:
    """One row's block of texts: digests, components, and their shingles end to end."""

    def __init__(self, texts: pa.StructArray):
        digest, label, keys, weights = texts.flatten()
        self.digest, self.label = digest.to_pylist(), label.to_pylist()
        ends = keys.offsets.to_numpy()
        self.ends = ends - ends[0]
        self.key = keys.values.to_numpy()[ends[0] : ends[-1]]
        ends = weights.offsets.to_numpy()
        self.weight = weights.values.to_numpy()[ends[0] : ends[-1]]
        self.row = np.repeat(np.arange(len(self.digest)), np.diff(self.ends))
        self.total = np.bincount(self.row, weights=self.weight, minlength=len(self.digest))
        self.plain = self.total == np.diff(self.ends)  # no shingle occurs twice

    def shingles(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.ends[i], self.ends[i + 1])
        return self.key[part], self.weight[part]

    def columns(self, vocabulary: np.ndarray, values: np.ndarray) -> np.ndarray:
        at = np.searchsorted(vocabulary, self.key)
        at[at == len(vocabulary)] = 0
        there = vocabulary[at] == self.key
        out = np.zeros((len(self.digest), len(vocabulary)), np.float32)
        out[self.row[there], at[there]] = values[there]
        return out


def _shared_weight(x: _Texts, y: _Texts, slab: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """For each pair, the weight of the common shingles in x's text and in y's."""
    common = np.intersect1d(x.key, y.key)
    of_x, of_y = (np.zeros((len(x.digest), len(y.digest)), np.float32) for _ in range(2))
    for begin in range(0, len(common), slab):
        some = common[begin : begin + slab]
        in_x, in_y = x.columns(some, x.weight), y.columns(some, y.weight)
        of_x += in_x @ (in_y > 0).T.astype(np.float32)
        of_y += (in_x > 0).astype(np.float32) @ in_y.T
    return of_x, of_y


def _linked(threshold: float):
    """For blocks of texts, one verified pair for each two components that have one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: set[tuple[bytes, bytes]] = set()
            for i in range(batch.num_rows):
                x, y = _Texts(batch.column(0)[i].values), _Texts(batch.column(1)[i].values)
                of_x, of_y = _shared_weight(x, y)
                # a common shingle adds at most its share of either text to the similarity
                near = (of_x >= threshold * x.total[:, None] - 1e-3) & (of_y >= threshold * y.total[None, :] - 1e-3)
                joined: set[tuple[bytes, bytes]] = set()
                for a, b in zip(*map(np.ndarray.tolist, np.nonzero(near))):
                    ends = (x.label[a], y.label[b])
                    if ends[0] == ends[1] or ends in joined:
                        continue
                    if x.plain[a] and y.plain[b]:
                        similar = of_x[a, b] / (x.total[a] + y.total[b] - of_x[a, b])
                    else:
                        similar = probability_jaccard(*x.shingles(a), *y.shingles(b))
                    if similar >= threshold:
                        joined.add(ends)
                        found.add((x.digest[a], y.digest[b]))
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in sorted(found)], pa.binary()) for k in (0, 1)], names=["a", "b"])

    return run


def _verify(stars: DataFrame, lists: DataFrame, threshold: float) -> DataFrame:
    """The pairs (digest, rep) of at least ``threshold`` similarity. Members of a centre
    are dealt to blocks of about ``STAR_TEXTS``, by ``n``, how many may share it; each block
    gets the centre's shingles once."""
    def blocks(n: Column) -> Column:
        return F.ceil(n / STAR_TEXTS).cast("long")

    members = stars.select("digest", "rep", F.pmod(F.xxhash64("digest"), blocks(F.col("n"))).alias("block")).join(lists, "digest")
    centres = (stars.groupBy("rep").agg(F.max("n").alias("n")).join(lists.withColumnRenamed("digest", "rep"), "rep")
               .select(F.lit(None).cast("binary").alias("digest"), "rep", F.explode(F.sequence(F.lit(0).cast("long"), blocks(F.col("n")) - 1)).alias("block"), "keys", "weights"))
    both = members.select("digest", "rep", "block", "keys", "weights").unionByName(centres)
    dealt = both.repartition("rep", "block").sortWithinPartitions("rep", "block", F.col("digest").asc_nulls_first())
    return map_arrow(dealt.select("digest", "rep", "keys", "weights"), _verified(threshold), "digest binary, rep binary")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``label``: the least node that each node of ``edges`` (a, b) is
    connected with. Labels spread along edges and along labels, so that long
    chains shorten by doubling; each round is stored."""
    edges = shared_table(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges", drop_shuffles=True)
    labels = shared_table(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near"))
                          .select("node", F.least("node", "near").alias("label"), F.lit(True).alias("changed")), "labels", drop_shuffles=True)
    while labels.where("changed").take(1):
        heard = (edges.join(labels.select(F.col("node").alias("b"), "label"), "b")
                 .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("heard")))
        step = labels.select("node", "label").join(heard, "node").select("node", "label", F.least("label", "heard").alias("near"))
        far = labels.select(F.col("node").alias("near"), F.col("label").alias("far"))
        labels = shared_table(step.join(far, "near").select("node", F.least("near", "far").alias("label"),
                                                            (F.least("near", "far") < F.col("label")).alias("changed")), "labels", drop_shuffles=True)
    return labels.select("node", "label")


def near_duplicate_classes(docs: DataFrame, text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """``digest`` (MD5 of a text), ``class_digest``: a row for each distinct text
    that is in a class with another text."""
    body = F.col(quoted(text)).cast("string")
    texts = docs.where(body.isNotNull()).select(F.unhex(F.md5(body.cast("binary"))).alias("digest"), body.alias("text"))
    marks = map_texts(texts, "text", ["digest"], SIGNATURE, lambda: _signatures)
    marks = marks.groupBy("digest").agg(*[F.first(c).alias(c) for c in SIGNATURE.names])
    spread = shared_table(marks.where(F.size("bands") > 0), "signatures", drop_shuffles=True).select("digest", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowd = shared_table(spread.join(shared, "bucket"), "bucket-crowds", drop_shuffles=True)
    # a bucket's star is centred on the text that meets most others over all its buckets: among
    # edited copies that is the one edited least, to which most others are similar
    weight = crowd.groupBy("digest").agg(F.sum("n").alias("met"))
    crowd = crowd.join(weight, "digest")
    centre = crowd.groupBy("bucket").agg(F.max(F.struct("met", "digest")).alias("top")).select("bucket", F.col("top.digest").alias("rep"))
    members = shared_table(crowd.join(centre, "bucket").select("bucket", "digest", "rep", "n"), "bucket-members", drop_shuffles=True)

    # shingles of the texts that share a bucket, one row for each distinct text
    lists = shared_table(_shingles_of(texts, members.select("digest").distinct()), "shingles", drop_shuffles=True)
    stars = members.where("digest <> rep").groupBy("digest", "rep").agg(F.max("n").alias("n"))
    near = shared_table(_verify(stars, lists, threshold), "star-edges", drop_shuffles=True).select(F.col("digest").alias("a"), F.col("rep").alias("b"))
    labels = components(near)

    # buckets that hold more than one component: all but the largest one's texts against all
    # others, in blocks; a bucket of two has been compared
    placed = shared_table(members.where("n > 2").join(labels.withColumnRenamed("node", "digest"), "digest", "left")
                          .withColumn("label", F.coalesce("label", "digest")), "bucket-components", drop_shuffles=True)
    largest = (placed.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"))
               .groupBy("bucket").agg(F.max_by("label", F.struct("n", "label")).alias("major"), F.count(F.lit(1)).alias("labels"))
               .where("labels > 1").select("bucket", "major"))
    mixed = placed.join(largest, "bucket").join(lists, "digest")
    # blocks of bounded size, but for a text that is longer by itself
    held = mixed.groupBy("bucket").agg(F.sum(F.size("keys")).alias("held"))
    mixed = mixed.join(held, "bucket")
    block = F.pmod(F.xxhash64("digest"), F.ceil(F.col("held") / BLOCK_SHINGLES).cast("long"))
    gathered = F.collect_list(F.struct("digest", "label", "keys", "weights"))
    rest = mixed.where("label <> major").groupBy("bucket", block.alias("r_block")).agg(gathered.alias("rest"))
    blocks = mixed.groupBy("bucket", block.alias("block")).agg(gathered.alias("texts"))
    found = map_arrow(rest.join(blocks, "bucket").select("rest", "texts"), _linked(threshold), "a binary, b binary")
    more = shared_table(found.distinct(), "more-edges", drop_shuffles=True)
    if more.take(1):
        labels = components(near.unionByName(more))
    return labels.select(F.col("node").alias("digest"), F.col("label").alias("class_digest"))


def with_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """Every row of ``docs`` with ``class_id``, the least id of its class.

    Texts of at least ``threshold`` similarity are linked, classes are connected
    texts; equal texts are always one class, also those without words. A null text
    is like no other and its class is its own id; null ids do not name a class of
    others. An input column named like a result column is replaced."""
    keep = without(docs, ["class_id", "digest", "class_digest"])
    marked = docs.select(*[F.col(quoted(c)) for c in keep], F.unhex(F.md5(F.col(quoted(text)).cast("string").cast("binary"))).alias("digest"))
    classes = near_duplicate_classes(docs, text, threshold)
    marked = marked.join(classes, "digest", "left").withColumn("class_digest", F.coalesce("class_digest", "digest"))
    ids = (docs.select(F.col(quoted(doc_id)).alias("id"), F.unhex(F.md5(F.col(quoted(text)).cast("string").cast("binary"))).alias("digest"))
           .where("digest IS NOT NULL").join(classes, "digest", "left").groupBy(F.coalesce("class_digest", "digest").alias("class_digest"))
           .agg(F.min("id").alias("class_id")))
    return marked.join(ids, "class_digest", "left").select(
        *[F.col(quoted(c)) for c in keep], F.when(F.col("class_digest").isNull(), F.col(quoted(doc_id))).otherwise(F.col("class_id")).alias("class_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = SIMILARITY) -> DataFrame:
    """One document of each class, that of the least id (null last) and then of
    the least digest; rows with null texts all stay."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    own_id, body = f"c{names.index(doc_id)}", f"c{names.index(text)}"
    digest = F.unhex(F.md5(F.col(body).cast("string").cast("binary")))
    classes = near_duplicate_classes(plain, body, threshold)
    marked = plain.select(F.col(own_id), digest.alias("digest")).join(classes, "digest", "left").withColumn("class", F.coalesce("class_digest", "digest"))
    best = (marked.where("digest IS NOT NULL").groupBy("class", own_id, "digest").agg(F.count(F.lit(1)).alias("n"))
            .groupBy("class").agg(F.min(F.struct(F.col(own_id).isNull().alias("none"), F.col(own_id).alias("id"), "digest", "n")).alias("best"))
            .select("best.*"))
    best = shared_table(best, "class-bests", drop_shuffles=True)
    rows = plain.withColumn("digest", digest)
    chosen = [(rows["digest"] == best["digest"]) & rows[own_id].eqNullSafe(best["id"])]
    single, several = (rows.join(best.where(n), chosen, "left_semi") for n in ("n = 1", "n > 1"))
    several = several.groupBy("digest", own_id).agg(F.first(F.struct(*plain.columns)).alias("row")).select("row.*")
    return single.select(*plain.columns).unionByName(several).unionByName(plain.where(F.col(body).isNull())).toDF(*names)
