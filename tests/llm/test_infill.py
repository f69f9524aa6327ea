import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import HARD
from tidemark.llm.infill import ExceptionIndex, brute_force, fill_in_middle, restored

MORE = [(20, "one\ntwo\nthree"), (21, "a <P> mark\nin it"), (22, "é\nß\n日本\n😀 end\n" * 40), (23, "\r\n\x0b\n"), (24, "😀"), (-3, "a\n\nb\n")]


def test_against_code_points(docs):
    rows = HARD + MORE
    got = sorted(fill_in_middle(docs(rows, ["n", "Form", "output"])).withColumn("back", restored(F.col("output"), F.col("form"))).collect(), key=repr)
    wanted = sorted(((i, *brute_force(i, t), t or "") for i, t in rows), key=repr)
    assert sorted([(r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"], r["back"]) for r in got], key=repr) == wanted
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}


def test_cut_by_characters_and_shares(docs):
    rows = [(i, "é😀xyz日" * 5) for i in range(200)]
    got = fill_in_middle(docs(rows), unit="character", percent=60, suffix_first_percent=20).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    forms = [r["form"] for r in got]
    assert all(r["back"] == rows[0][1] and r["n"] == 30 for r in got)
    assert 0.3 < forms.count("plain") / 200 < 0.5 and forms.count("psm") > 2 * forms.count("spm") > 0
    for r in got:
        if r["form"] == "psm":
            assert len(r["output"].split("<S>")[0]) - 3 == r["prefix_chars"] and len(r["output"].split("<S>")[0].encode()) - 3 == r["prefix_bytes"]


@pytest.mark.parametrize("alphabet", ["abc\n", "aé日😀\n", "日本"])
def test_index_converts_every_boundary(alphabet):
    rnd = random.Random(3)
    for _ in range(20):
        text = "".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 60)))
        index = ExceptionIndex(np.frombuffer(text.encode(), np.uint8))
        points = np.arange(len(text) + 1)
        places = np.array([len(text[:p].encode()) for p in points])
        assert (index.to_bytes(points) == places).all() and (index.to_points(places) == points).all()
        assert len(index.begin) == sum(ord(c) > 127 for c in text)


def test_empty_table(empty):
    assert fill_in_middle(empty).collect() == []
