"""Driver tables mapped onto the four change logs the reports read.

``orders`` becomes the case log and the case-attribute log, ``events`` the
dialer log, ``lineitem`` the contact log. Each log has the bronze columns:
source columns plus ``ingest_ts``, ``ingest_date`` and ``ingest_seq`` (a
unique sequence that breaks ties between versions with the same
``update_date``). The mapping is plain column arithmetic on the scan, so
Catalyst prunes every column a query does not use.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import ntz

# The whole fixture set is stamped as landed on this day.
FIXTURE_INGEST_TS = datetime(2024, 2, 15, 6, 0, 0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame. The read (file listing and footer schema)
    is done once per session and path; only the plan object is kept, no data.
    The cache lives on the session object, so a new session starts empty."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    cache = spark.__dict__.setdefault("_tidemark_tables", {})
    df = cache.get(path)
    if df is None:
        df = cache[path] = spark.read.parquet(path)
    return df


def _stamp(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "ingest_ts": ntz(FIXTURE_INGEST_TS),
        "ingest_date": F.lit(date(2024, 2, 15)),
    })


def cases_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return _stamp(o.select(
        F.col("o_custkey").alias("case_id"),
        (F.lit(101) + F.col("o_custkey") % 4).cast("int").alias("client_id"),
        F.concat(F.lit("REF-"), F.col("o_custkey").cast("string")).alias("ref_number"),
        (F.col("o_custkey") * 7 % 250000).alias("debtor_id"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("original_capital"),
        (F.col("o_totalprice") * 0.75).cast("decimal(18,2)").alias("actual_capital"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).cast("int").alias("case_statute_id"),
        F.col("o_orderdate").alias("update_date"),
        F.col("o_orderkey").alias("ingest_seq"),
    ))


def attributes_log(spark: SparkSession, sf_dir: str, provider_type: int = 11, dpd_type: int = 12) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    common = [F.col("o_custkey").alias("case_id")]
    tail = [F.col("o_orderdate").alias("update_date"), F.col("o_orderkey").alias("ingest_seq")]
    provider = o.select(
        *common,
        F.lit(provider_type).cast("int").alias("case_attribute_type_id"),
        F.when(F.col("o_custkey") % 20 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("Provider "), F.substring("o_orderpriority", 1, 1)))
        .alias("case_attribute_value"),
        *tail,
    )
    dpd = o.select(
        *common,
        F.lit(dpd_type).cast("int").alias("case_attribute_type_id"),
        F.when(F.col("o_orderkey") % 33 == 0, F.lit(None).cast("string"))
        .when(F.col("o_orderkey") % 50 == 1, F.lit("n/a"))
        .otherwise(((F.col("o_orderkey") * 37) % 500 - 20).cast("string"))
        .alias("case_attribute_value"),
        *tail,
    )
    return _stamp(provider.unionByName(dpd))


_DISPOSITION = {"view": 201, "purchase": 201, "click": 202, "error": 203, "signup": 203}


def dialer_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    disp = None
    for etype, code in _DISPOSITION.items():
        cond = F.col("event_type") == etype
        disp = F.when(cond, code) if disp is None else disp.when(cond, code)
    back_days = ((F.col("event_id") % 6) * 30).cast("int")
    return _stamp(e.select(
        F.concat(F.lit("call-"), F.col("event_id").cast("string")).alias("uniqueid"),
        F.col("user_id").alias("case_id"),
        (F.lit(101) + F.col("user_id") % 4).cast("int").alias("client_id"),
        (F.col("event_id") % 4).cast("int").alias("telecom_id"),
        F.concat(F.lit("+5511"), F.lpad(F.col("user_id").cast("string"), 9, "0")).alias("phone_number"),
        disp.cast("int").alias("disposition_code"),
        (F.col("ts") - F.make_dt_interval(back_days)).alias("call_date"),
        F.col("ts").alias("update_date"),
        F.col("event_id").alias("ingest_seq"),
    ))


def contacts_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    back_days = ((F.col("l_orderkey") * 7 + F.col("l_partkey")) % 180).cast("int")
    return _stamp(li.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("contact_id"),
        F.col("l_partkey").alias("case_id"),
        (F.lit(1) + F.col("l_quantity").cast("bigint") % 6).cast("int").alias("status_type_id"),
        (F.lit(1) + F.col("l_linenumber") % 4).cast("int").alias("target_type_id"),
        (ntz(datetime(2024, 1, 31)) - F.make_dt_interval(back_days)).alias("contact_date"),
        F.when(F.col("l_returnflag") == "A", F.lit("auto_dialer"))
        .otherwise(F.concat(F.lit("operator_"), (F.col("l_suppkey") % 25).cast("string")))
        .alias("insert_user"),
        F.col("l_shipdate").alias("update_date"),
        (F.col("l_suppkey") * 1000000 + F.col("l_partkey")).alias("ingest_seq"),
    ))


LOGS = {
    "cases": cases_log,
    "case_attributes": attributes_log,
    "dialer": dialer_log,
    "contacts": contacts_log,
}
