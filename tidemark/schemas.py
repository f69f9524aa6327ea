"""Explicit schemas for the tables this library owns."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

CONTROL_SCHEMA = StructType([
    StructField("table_name", StringType(), False),
    StructField("last_watermark", TimestampNTZType(), True),
    StructField("rows_processed", LongType(), True),
    StructField("updated_at", TimestampNTZType(), True),
    StructField("run_status", StringType(), True),
])

RECONCILIATION_SCHEMA = StructType([
    StructField("table", StringType(), False),
    StructField("source_count", LongType(), True),
    StructField("bronze_count", LongType(), True),
    StructField("drift_pct", DoubleType(), True),
    StructField("flagged", IntegerType(), True),
    StructField("empty_source", IntegerType(), True),
    StructField("checked_at", TimestampNTZType(), True),
])

_ING = [
    StructField("ingest_ts", TimestampNTZType(), True),
    StructField("ingest_date", DateType(), True),
    StructField("ingest_seq", LongType(), True),
    # Id of the landing (one per append): a partition, so readers can leave whole landings out.
    StructField("ingest_batch", StringType(), True),
]

BRONZE_SCHEMAS: dict[str, StructType] = {
    "cases": StructType([
        StructField("case_id", LongType(), True),
        StructField("client_id", IntegerType(), True),
        StructField("ref_number", StringType(), True),
        StructField("debtor_id", LongType(), True),
        StructField("original_capital", DecimalType(18, 2), True),
        StructField("actual_capital", DecimalType(18, 2), True),
        StructField("case_statute_id", IntegerType(), True),
        StructField("update_date", TimestampNTZType(), True),
        *_ING,
    ]),
    "case_attributes": StructType([
        StructField("case_id", LongType(), True),
        StructField("case_attribute_type_id", IntegerType(), True),
        StructField("case_attribute_value", StringType(), True),
        StructField("update_date", TimestampNTZType(), True),
        *_ING,
    ]),
    "dialer": StructType([
        StructField("uniqueid", StringType(), True),
        StructField("case_id", LongType(), True),
        StructField("client_id", IntegerType(), True),
        StructField("telecom_id", IntegerType(), True),
        StructField("phone_number", StringType(), True),
        StructField("disposition_code", IntegerType(), True),
        StructField("call_date", TimestampNTZType(), True),
        StructField("update_date", TimestampNTZType(), True),
        *_ING,
    ]),
    "contacts": StructType([
        StructField("contact_id", LongType(), True),
        StructField("case_id", LongType(), True),
        StructField("status_type_id", IntegerType(), True),
        StructField("target_type_id", IntegerType(), True),
        StructField("contact_date", TimestampNTZType(), True),
        StructField("insert_user", StringType(), True),
        StructField("update_date", TimestampNTZType(), True),
        *_ING,
    ]),
}
