"""The report kept by signed deltas equals a rebuild after every batch."""

import random
from dataclasses import replace
from datetime import date, datetime, timedelta

import pytest

from tidemark.config import ReportConfig
from tidemark.operators import mart_delta, marts
from tidemark.plans.jobs import stored_once
from tidemark.schemas import BRONZE_SCHEMAS

CFG = ReportConfig(as_of=date(2024, 2, 15))
NOW = datetime(2024, 2, 15, 6)


def random_batch(rnd, n, clock):
    """Versions of few keys, so that most rows are updates; some older than what is in force."""
    def stamp():
        at = datetime(2024, 1, 1) + timedelta(minutes=clock + rnd.randint(-30, 30))
        return {"update_date": at, "ingest_ts": NOW, "ingest_date": NOW.date(), "ingest_seq": rnd.randrange(10**6), "ingest_batch": "b"}

    def when():
        return datetime(2023, 11, 1) + timedelta(days=rnd.randrange(140), hours=rnd.randrange(24))

    def case():
        return rnd.choice([*range(12), 99])

    made = {
        "cases": [{"case_id": case(), "client_id": rnd.choice([101, 102, 103, 104]), "ref_number": "r", "debtor_id": 1, "original_capital": None,
                   "actual_capital": None, "case_statute_id": rnd.choice([0, 0, 1, None])} for _ in range(n)],
        "case_attributes": [{"case_id": case(), "case_attribute_type_id": rnd.choice([11, 12, 12]),
                             "case_attribute_value": rnd.choice(["10", "45", "400", "x", None])} for _ in range(n)],
        "dialer": [{"uniqueid": f"c{rnd.randrange(20)}", "case_id": rnd.choice([case(), None]), "client_id": rnd.choice([101, 102, 104]), "telecom_id": 1,
                    "phone_number": "p", "disposition_code": rnd.choice([201, 203, None]), "call_date": when()} for _ in range(n)],
        "contacts": [{"contact_id": rnd.randrange(20), "case_id": case(), "status_type_id": rnd.choice([1, 2, 3, None]), "target_type_id": rnd.choice([1, 2, 3]),
                      "contact_date": when(), "insert_user": rnd.choice(["auto_dialer", "op", "op", None])} for _ in range(n)],
    }
    return {t: [r | stamp() for r in rows] for t, rows in made.items()}


def frames(spark, rows):
    return {t: spark.createDataFrame([tuple(r[f] for f in BRONZE_SCHEMAS[t].names) for r in rs], BRONZE_SCHEMAS[t]) for t, rs in rows.items()}


def rebuilt(logs, cfg):
    return sorted(map(repr, marts.mart_penetration(logs["cases"], logs["case_attributes"], logs["dialer"], logs["contacts"], cfg).collect()))


@pytest.mark.parametrize("seed", [1])
def test_every_batch_equals_a_rebuild(spark, seed):
    rnd, clock, deltas, cfg = random.Random(seed), 0, None, CFG
    rows = {t: [] for t in BRONZE_SCHEMAS if t in mart_delta.KEYS}
    for step in range(4):
        new = random_batch(rnd, 25 if step != 2 else 0, clock)
        deltas = mart_delta.apply_batch(deltas, frames(spark, rows), frames(spark, new), cfg, stored_once)
        rows, clock = {t: rows[t] + new[t] for t in rows}, clock + 60
        logs = frames(spark, rows)
        assert sorted(map(repr, mart_delta.mart_from_deltas(deltas).collect())) == rebuilt(logs, cfg)
        if step == 1:
            later = replace(cfg, as_of=date(2024, 3, 20))
            deltas, cfg = mart_delta.move_window(deltas, logs, cfg, later, stored_once), later
            assert sorted(map(repr, mart_delta.mart_from_deltas(deltas).collect())) == rebuilt(logs, cfg)
            deltas = mart_delta.compacted(deltas, stored_once)


def test_a_batch_without_news_adds_no_segment_rows(spark):
    rows = random_batch(random.Random(5), 30, 0)
    empty = frames(spark, {t: [] for t in rows})
    deltas = mart_delta.apply_batch(None, empty, frames(spark, rows), CFG, stored_once)
    again = mart_delta.apply_batch(deltas, frames(spark, rows), frames(spark, rows), CFG, stored_once)
    assert again.segments.count() == deltas.segments.count() and again.cases.count() == deltas.cases.count()


def test_only_what_counts_goes_through_the_dedup(spark):
    rows = random_batch(random.Random(3), 25, 0)
    logs = frames(spark, rows)
    for t in ("dialer", "contacts"):
        counted = mart_delta._counted(logs[t], t, CFG, mart_delta.F.lit(1))
        assert counted.columns == [*mart_delta.KEYS[t], *CFG.version_order, "case_id", "hits"]
        assert counted.count() == len(rows[t])
        assert counted.where("hits = 0 AND case_id IS NOT NULL").isEmpty()
