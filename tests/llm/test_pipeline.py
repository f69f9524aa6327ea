"""The pipeline against the operators' own brute-force versions, stage by stage."""

from collections import defaultdict

import corpus_pipeline
from tests.llm import test_neardup, test_packing
from tidemark.llm import catalog, decontamination, quality, secrets
from tidemark.llm.common import read_table, shared_table

SF = "/root/testdata/sf0.001"


def rows(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_take_effect_and_keep_the_rest(spark):
    docs = read_table(spark, SF, "documents")
    done = {}
    for name, stage in corpus_pipeline.STAGES:
        out = shared_table(stage(spark, docs, SF), "test")
        done[name] = (docs, out)
        if name != "best_fit_packing":
            assert out.schema.simpleString() == docs.schema.simpleString()
        docs = out

    before, after = map(rows, done["quality_rules"])
    assert after.keys() < before.keys() and all(after[i] == before[i] for i in after)
    counts = {i: quality.brute_force(t) for i, t in before.items()}
    failed = {i for i, c in counts.items() if c["n_words"] < 20 or 100 * c["n_repeat_words"] > 30 * c["n_words"]}
    assert not failed & after.keys()
    label = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}
    assert all(i in after for i in before.keys() - failed if label.get(i) == 1)

    before, after = map(rows, done["near_dedup"])
    classes = test_neardup.brute_classes(sorted(before.items()))
    assert sorted(after) == sorted({int(c) for _, c in classes})

    before, after = map(rows, done["decontamination"])
    items = [(str(r["item_id"]), r["text"]) for r in read_table(spark, SF, "benchmark").collect()]
    assert after.keys() == {i for i, t in before.items() if not decontamination.brute_force(t, items)[1]}

    before, after = map(rows, done["secret_scan"])
    assert before.keys() == after.keys()
    for i, text in before.items():
        assert bool(secrets.brute_force(text)) <= ("[SECRET]" in after[i]) and not secrets.brute_force(after[i])
        assert text == after[i] or "[SECRET]" in after[i]
    assert done["secret_scan"][1].where("n_chars <> length(text)").count() == 0

    before, packed = rows(done["best_fit_packing"][0]), done["best_fit_packing"][1].collect()
    ids = {i: len(test_packing.direct(t)) for i, t in before.items()}
    total = defaultdict(int)
    for r in packed:
        total[r["doc_id"]] += r["length"]
    assert total == ids
    assert len({r["sequence_id"] for r in packed}) == len(test_packing.best_fit_one_by_one([r["length"] for r in packed], 2048))


def test_registered(spark):
    numbers = {int(k[2:].split("_")[0]) for k in catalog.QUERIES if k.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in catalog.QUERIES


CLASHES = ["hits", "n_words", "kept", "class_id", "digest", "spans", "length", "sequence_id"]


def test_each_stage_on_hard_rows(spark):
    """Nulls in all columns, empty and very long texts, repeated rows and ids, clashing column names."""
    plain = read_table(spark, SF, "documents").where("doc_id IS NOT NULL AND text IS NOT NULL")
    first = plain.orderBy("doc_id").first()
    extra = [(None,) * 5, (None,) * 5, (-1, "", None, None, 0), (-2, "word " * 30_000, "en", "x", None), (-3, "x" * 100_000, "en", "x", 1),
             (-4, "日本語 é ß İ x\x00y", None, "x", 7), tuple(first), tuple(first)]
    docs = plain.unionByName(spark.createDataFrame(extra, plain.schema))
    for name in CLASHES:
        docs = docs.selectExpr("*", f"'own' AS `{name}`")
    docs = shared_table(docs, "hard-pipeline")
    n = docs.count()
    stages = dict(corpus_pipeline.STAGES)
    out = {name: shared_table(stages[name](spark, docs, SF), "test") for name in stages}
    for name in list(stages)[:-1]:
        assert out[name].columns == docs.columns and out[name].count() <= n
        assert out[name].where(" OR ".join(f"{c} IS DISTINCT FROM 'own'" for c in CLASHES)).count() == 0
    rejected = {None, -1, -3, -4}  # fewer than 20 words
    assert not rejected & {r["doc_id"] for r in out["quality_rules"].select("doc_id").collect()}
    assert out["near_dedup"].where(f"doc_id = {first['doc_id']}").count() == 1
    assert out["near_dedup"].where("text IS NULL").count() == 2  # like no other text
    assert out["near_dedup"].where("text = ''").count() == 1
    assert out["decontamination"].where("text IS NULL").count() == 2
    assert out["secret_scan"].count() == n and out["secret_scan"].where("doc_id = -2").first()["text"] == "word " * 30_000
    pieces = out["best_fit_packing"].collect()
    starts = defaultdict(int)
    for r in pieces:
        starts[r["doc_id"]] += r["piece"] == 0
    assert starts[None] == 2 and starts[first["doc_id"]] == 3 and sum(starts.values()) == n
    held = defaultdict(list)
    for r in pieces:
        held[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in held.values():
        places.sort()
        assert all(a + length == b for (a, length), (b, _) in zip(places, places[1:])) and places[0][0] == 0 and sum(places[-1]) <= 2048


def test_each_stage_on_an_empty_table(spark):
    docs = read_table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0, name
