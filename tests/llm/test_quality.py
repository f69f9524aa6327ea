import itertools
import random

import numpy as np
import pyarrow as pa

from tests.llm.conftest import HARD
from tidemark.llm.quality import (
    ALL_CONTENT, FEATURES, Chains, LineModel, brute_force, fit_line_model, joined_stretches, keep_good, measure, quality_verdicts, stretches_of, train,
)

ODD = ["\n", "a\n", "a\na", "a\n\na\n \n", "  x  \n x", " a b c d e f g h a b c d e f g h", "é é é é é é é é é é", "#1 $2\n#1 $2\n<x|y>"]


def test_counts_against_brute_force():
    rnd = random.Random(2)
    texts = [t for _, t in HARD] + ODD + [" ".join(rnd.choice("ab cd\n ef".split(" ")) for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    got = measure(pa.array(texts))
    for i, t in enumerate(texts):
        assert {k: got[k][i] for k in brute_force(t)} == brute_force(t)
    assert got["line_words"].sum() == got["n_words"].sum()


def test_viterbi_is_the_best_labelling():
    rnd = random.Random(1)
    for _ in range(100):
        moves = tuple((rnd.gauss(0, 1), rnd.gauss(0, 1)) for _ in range(2))
        model, scores = LineModel((0.0,) * len(FEATURES), moves), [rnd.gauss(0, 1) for _ in range(rnd.randint(0, 7))]

        def total(y, moves=moves, scores=scores):
            return sum(a * b for a, b in zip(y, scores)) + sum(moves[a][b] for a, b in zip(y, y[1:]))

        best = max(map(total, itertools.product((0, 1), repeat=len(scores))))
        assert abs(total(model.viterbi(scores)) - best) < 1e-9


def test_training_separates_and_needs_both_classes():
    good, bad = [1, 1 | 16, 1], [1 | 32, 1 | 64, 1 | 32]
    model = train(joined_stretches([good] * 20, [bad] * 20))
    scores = model.scores
    assert model.viterbi(scores(np.array(good)).tolist()) == [0, 0, 0]
    assert model.viterbi(scores(np.array(bad)).tolist()) == [1, 1, 1]
    assert model.viterbi(scores(np.array(bad + good + bad)).tolist()) == [1, 1, 1, 0, 0, 0, 1, 1, 1]
    assert train([]) == train(joined_stretches([good], [])) == ALL_CONTENT


def test_likelihood_against_all_labellings_and_its_gradient():
    rnd = random.Random(8)
    sequences = [([rnd.randrange(1 << len(FEATURES)) for _ in range(n)], [rnd.randrange(2) for _ in range(n)]) for n in (1, 2, 5, 5, 3)]
    weights, moves = np.array([rnd.gauss(0, 0.3) for _ in FEATURES]), np.array([[rnd.gauss(0, 1) for _ in range(2)] for _ in range(2)])
    chains = Chains(sequences)

    def total(bits, y):
        emitted = sum(w for b, label in zip(bits, y) if label for k, w in enumerate(weights) if b >> k & 1)
        return emitted + sum(moves[a][b] for a, b in zip(y, y[1:]))

    wanted = sum((total(bits, y) - np.log(sum(np.exp(total(bits, z)) for z in itertools.product((0, 1), repeat=len(bits))))) / len(bits) for bits, y in sequences) / 5
    value, grad_w, grad_m = chains.gradient(weights, moves)
    assert abs(value - wanted) < 1e-9
    for grad, at in ((grad_w, weights), (grad_m, moves)):
        for place in np.ndindex(at.shape):
            at[place] += 1e-5
            above = chains.gradient(weights, moves)[0]
            at[place] -= 2e-5
            below = chains.gradient(weights, moves)[0]
            at[place] += 1e-5
            assert abs((above - below) / 2e-5 - grad[place]) < 1e-6


def test_lines_of_held_out_documents(spark):
    """Line by line on joined stretches of documents that the model hasn't seen."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_line_model(docs, labels.where("doc_id % 2 = 0"))
    right = lines = 0
    for bits, truth in joined_stretches(*stretches_of(docs, labels.where("doc_id % 2 = 1"))):
        found = model.viterbi(model.scores(np.array(bits)).tolist())
        right, lines = right + sum(a == b for a, b in zip(found, truth)), lines + len(truth)
    print(f"line accuracy {right / lines:.3f} of {lines}")
    assert right >= 0.9 * lines


def test_a_labelled_document_of_very_many_lines(spark, docs):
    long = "\n".join(f"menu {i % 7}" for i in range(300_000))
    rows = [(1, long), (2, "A sentence of some ordinary words that ends here.\n" * 30), (3, long)]
    labels = spark.createDataFrame([(1, 0), (2, 1), (3, 0)], "doc_id long, quality int")
    good, bad = stretches_of(docs(rows * 2), labels)
    assert len(good) <= 4 and len(bad) <= 8 and max(map(len, good + bad)) == 50
    verdicts = {r["doc_id"]: r["kept"] for r in quality_verdicts(docs(rows), fit_line_model(docs(rows), labels)).collect()}
    assert verdicts[1] is verdicts[3] is False


def test_held_out_documents_of_the_driver_table(spark):
    """Trained on one half of the labelled documents, judged on the other."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    model = fit_line_model(docs, labels.where("doc_id % 2 = 0"))
    rest = quality_verdicts(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r["kept"] for r in rest if r["quality"] == 1], [r["kept"] for r in rest if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_hard_rows_and_clashing_columns(spark, docs, empty):
    labels = spark.createDataFrame([(1, 0), (None, 1), (2, None), (10, 1), (10, 0)], "doc_id long, quality int")
    model = fit_line_model(docs(HARD), labels)
    got = quality_verdicts(docs(HARD, clash=["kept", "lang"]), model)
    assert got.columns[:3] == ["doc_id", "text", "lang"] and got.count() == len(HARD)
    assert got.where("text IS NULL").first()["base_failed"]
    assert got.where("doc_id = 5").first()["n_repeat_words"] == 30_000
    kept = keep_good(docs(HARD, clash=["kept"]), model)
    assert kept.columns == ["doc_id", "text", "kept"] and kept.count() == 0
    assert quality_verdicts(empty, model).collect() == [] and fit_line_model(empty, labels) == ALL_CONTENT
