"""Registered queries of this package: one per operator, and the corpus pipeline.

Each callable takes ``(spark, sf_dir)`` and runs its operator with production
parameters over the whole table that the operator is meant for.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.sharding import shard_documents

    out = shard_documents(read_table(spark, sf_dir, "documents"), shards=8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.decontamination import benchmark_hits, items_digest

    hits = benchmark_hits(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return hits.select("doc_id", "n_words", F.size("hit_words").cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                       items_digest("items").alias("items_sha256"), (F.size("hit_words") > 0).alias("contaminated"))


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from tidemark.llm.packing import pack_documents

    out = pack_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.quality import fit_line_model, quality_verdicts

    docs = read_table(spark, sf_dir, "documents")
    model = fit_line_model(docs, read_table(spark, sf_dir, "labels"))
    return quality_verdicts(docs, model).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share")


def _count(kind: str):
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


@query
def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.secrets import fit_randomness, secret_spans, spans_text

    docs = read_table(spark, sf_dir, "documents")
    found = secret_spans(docs.select("doc_id", "text"), fit_randomness(docs))
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    counts = [_count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex", "markov")]
    return found.select("doc_id", *counts, F.sha2(spans_text(base).cast("binary"), 256).alias("base_sha256"), spans_text(F.col("spans")).alias("spans"))


@query
def op8_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.neardup import with_classes

    return with_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query
def op1_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lm import fit, held_out, score_texts

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    model = fit(docs.where("NOT held_out").select("doc_id", "text"))
    return score_texts(docs, model).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                                           "base_score", "score", "bits_per_byte")


@query
def op3_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.urls import derived_log, evaluate_captures

    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    # the table has no fetch dates: a day of 2024 by the page's number
    captures = pages.withColumn("day", F.date_add(F.lit("2024-01-01").cast("date"), F.pmod("page_id", F.lit(366)).cast("int")))
    return evaluate_captures(captures, derived_log(pages)).select("page_id", "day", "host", "blocked", "decided_by", "listed_on", "n_active")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.licenses import scan_licenses

    found = scan_licenses(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "sentence_ids", F.array_join("rule_matches", ",").alias("rule_matches"), F.array_join("licenses", ",").alias("licenses"))


@query
def op10_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.chat import repair

    return repair(read_table(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


@query
def op11_structure(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.common import shared_table
    from tidemark.llm.structure import damaged, digests, gaps, repair_structure

    original = read_table(spark, sf_dir, "conversations")
    rows = shared_table(damaged(original), "structure-damaged")
    made = repair_structure(rows)
    out = original.select(F.col("conv_id").alias("conversation")).distinct()
    for part in (gaps(rows), made.conversations, digests(made.rows)):
        out = out.alias("l").join(part.alias("r"), F.col("l.conversation").eqNullSafe(F.col("r.conversation")), "left").select(
            "l.*", *[f"r.{c}" for c in part.columns if c != "conversation"])
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    # a conversation that lost all its rows has nothing to repair
    return out.select(F.col("conversation").alias("conv_id"),
                      *[F.when(F.col("audit").isNull(), F.lit(0).cast("long")).otherwise(F.col(n)).alias(n) for n in numbers],
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


@query
def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.lines import dedup_lines

    out = dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query
def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidemark.llm.infill import fill_in_middle, restored

    made = fill_in_middle(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")).cast("binary"), 256).alias("restored_sha256"))
