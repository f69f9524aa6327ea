"""The corpus pipeline: from raw documents to packed training sequences.

``STAGES`` are (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next one's
docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table, shared_table
from tidemark.llm.decontamination import decontaminate
from tidemark.llm.neardup import keep_one
from tidemark.llm.packing import pack_documents
from tidemark.llm.quality import fit_line_model, keep_good
from tidemark.llm.secrets import fit_randomness, redact


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the text rules or are mostly boilerplate lines go."""
    return keep_good(docs, fit_line_model(docs, read_table(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that of the least id."""
    return keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; secrets in it are replaced by a mark, and ``n_chars`` follows."""
    shown = redact(docs, fit_randomness(docs))
    return shown.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' ids and their places in sequences of 2048 tokens."""
    packed = pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: Line labelling, MinHash and tokenisation have no SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
