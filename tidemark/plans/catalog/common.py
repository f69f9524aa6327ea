"""Shared pieces of the catalogue: the registry, configuration, fixture sources, staged inputs."""

from __future__ import annotations

import dataclasses
from datetime import date, datetime
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import ReportConfig, default_sources
from tidemark.functions.expressions import ntz
from tidemark.operators import marts, staging
from tidemark.sources import fixtures as fx
from tidemark.sources.jdbc import scope_filter

CFG = ReportConfig(as_of=date(2024, 2, 15))
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# ---- building blocks -------------------------------------------------------

def _stg_cases(spark, d):
    return staging.stg_cases(fx.cases_log(spark, d), CFG)


def _stg_attrs(spark, d):
    return staging.stg_case_attributes(fx.attributes_log(spark, d), CFG)


def _stg_dialer(spark, d):
    return staging.stg_dialer(fx.dialer_log(spark, d), CFG)


def _stg_contacts(spark, d):
    return staging.stg_contacts(fx.contacts_log(spark, d), CFG)


def _active(spark, d):
    return marts.active_cases(_stg_cases(spark, d), _stg_attrs(spark, d), CFG)


_SRC_CONTACT_COLS = ["contact_id", "case_id", "status_type_id", "target_type_id", "contact_date",
                     "insert_user", "update_date", "ingest_seq"]


SPECS = {s.table_name: dataclasses.replace(s, sequence_column="ingest_seq") for s in default_sources(CFG)}
PULL_WATERMARK = datetime(2024, 1, 29, 0, 0, 0)
AS_OF_TS = datetime(2024, 2, 15, 0, 0, 0)
_ATTR_COLS = ["case_id", "case_attribute_type_id", "case_attribute_value", "update_date", "ingest_seq"]


def _scope(name: str):
    """Source-side scope of each table (the same filter is applied to bronze)."""
    return scope_filter(SPECS[name])


_KEYS = {"cases": ("case_id",), "case_attributes": ("case_id", "case_attribute_type_id"),
         "dialer": ("uniqueid",), "contacts": ("contact_id",)}


INGEST_NOW = datetime(2024, 2, 15, 6, 0, 0)
FIRST_RUN_CUT = datetime(2024, 1, 29, 0, 0, 0)


def _sources(spark, d, upto: datetime | None = None):
    """The mapped tables as sources; ``ingest_seq`` stays as the source's version sequence."""
    out = {}
    for name, fn in fx.LOGS.items():
        src = fn(spark, d).drop("ingest_ts", "ingest_date")
        if upto is not None:
            src = src.filter(F.col("update_date") <= ntz(upto))
        out[name] = src
    return out
