"""Compaction of small files only.

``compact`` in ``layout`` rewrites a whole table. Here the files that are large
enough stay where they are: small ones are packed first-fit, the largest first, into
new files of about the wanted size, never over the bounds of a partition (a day).
``read`` takes the large files, the small ones that were not merged and the merged
ones. Which small files went where is a stored table; large and small are told apart
by the size in the hidden ``_metadata`` column, which prunes files at the listing, so
no list of paths goes through the driver.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Files of one partition that are packed together; more are dealt to several packings.
FILES_TOGETHER = 2048


def table_files(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """A row per file with rows: ``by`` (its partition), ``file_path``, ``bytes``, ``rows``.
    Only footers are read."""
    at = df.select(*by, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_size").alias("bytes"))
    return at.groupBy(*by, "file_path", "bytes").agg(F.count(F.lit(1)).alias("rows"))


def _first_fit(sizes: Column, most: int) -> Column:
    """The bin (from 1) of each of ``sizes``: the first that has room, else a new one."""
    none = F.struct(F.array().cast("array<bigint>").alias("filled"), F.array().cast("array<int>").alias("bins"))

    def place(state: Column, size: Column) -> Column:
        fit = F.array_position(F.transform(state["filled"], lambda f: f + size <= most), True).cast("int")
        more = F.transform(state["filled"], lambda f, i: F.when(i == fit - 1, f + size).otherwise(f))
        filled = F.when(fit == 0, F.concat(state["filled"], F.array(size))).otherwise(more)
        chosen = F.when(fit == 0, F.size(state["filled"]) + 1).otherwise(fit)
        return F.struct(filled.alias("filled"), F.concat(state["bins"], F.array(chosen)).alias("bins"))

    return F.aggregate(sizes, none, place)["bins"]


def pack_files(files: DataFrame, target_bytes: int, small_bytes: int, by: Sequence[str] = ()) -> DataFrame:
    """``files`` (see :func:`table_files`) with ``merged_into``: a number from 0 for small files
    that go into one new file with others, null for those that stay. Files of
    ``small_bytes`` or more stay, and so does a small file that no other fits to."""
    if not 0 < small_bytes <= target_bytes:
        raise ValueError(f"small files are of 1 to {target_bytes} bytes, not {small_bytes}")
    dealt = (files.withColumn("_small", F.col("bytes") < small_bytes)
             .withColumn("_n", F.count(F.when(F.col("_small"), 1)).over(Window.partitionBy(*by, F.lit(0))))
             .withColumn("_part", F.pmod(F.xxhash64("file_path"), F.greatest(F.lit(1), F.ceil(F.col("_n") / FILES_TOGETHER)))))
    # Largest first; files of one size by path, so the packing depends on the files alone.
    listed = dealt.where("_small").groupBy(*by, "_part").agg(F.sort_array(F.collect_list(
        F.struct((-F.col("bytes")).alias("less"), "file_path", "rows"))).alias("_files"))
    placed = listed.withColumn("_bins", _first_fit(F.transform("_files", lambda f: -f["less"]), target_bytes))
    small = (placed.select(*by, "_part", F.explode(F.arrays_zip("_files", "_bins")).alias("_f"))
             .select(*by, "_part", "_f._files.file_path", (-F.col("_f._files.less")).alias("bytes"), "_f._files.rows", F.col("_f._bins").alias("_bin")))
    bins = (small.groupBy(*by, "_part", "_bin").agg(F.count(F.lit(1)).alias("_together"), F.min("file_path").alias("_first")).where("_together > 1")
            .select("*", (F.row_number().over(Window.orderBy("_first")) - 1).alias("merged_into")))
    same = [F.col(f"s.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "_part", "_bin"]]
    columns = [*by, "file_path", "bytes", "rows"]
    told = small.alias("s").join(bins.alias("b"), same, "left").select(*[f"s.{c}" for c in columns], "b.merged_into")
    return files.where(F.col("bytes") >= small_bytes).select(*columns, F.lit(None).cast("int").alias("merged_into")).unionByName(told)


def _merged(spark: SparkSession, out: str) -> tuple[DataFrame, int]:
    """Files merged into ``out`` (path and number) and the size from which files were left alone."""
    plan = spark.read.parquet(f"{out}/plan").where("merged_into IS NOT NULL")
    return plan.select(F.col("file_path").alias("_file"), F.col("merged_into").alias("_bin")), plan.agg(F.max("small_bytes")).collect()[0][0] or 0


def _with_file(df: DataFrame) -> DataFrame:
    return df.select("*", F.col("_metadata.file_path").alias("_file"))


def compact_small(spark: SparkSession, path: str, out: str, target_bytes: int = 256 << 20, small_bytes: int | None = None,
                  by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> dict:
    """Merge the small files of the table at ``path`` into files under the new folder ``out``,
    sorted by ``sort_by`` inside. ``by``: the table's partition columns. ``small_bytes`` is
    half of ``target_bytes`` unless given. Returns a report: files and bytes there were,
    files untouched, merged and written, bytes rewritten, rows before and after.
    Nothing at ``path`` changes; :func:`read` gives the compacted table."""
    small = target_bytes // 2 if small_bytes is None else small_bytes
    src = spark.read.parquet(path)
    pack_files(table_files(src, by), target_bytes, small, by).withColumn("small_bytes", F.lit(small).cast("long")).write.parquet(f"{out}/plan")
    merge = F.col("merged_into").isNotNull()
    facts = spark.read.parquet(f"{out}/plan").agg(
        F.count(F.lit(1)).alias("files_before"), F.sum("bytes").alias("bytes_before"), F.sum("rows").alias("rows_before"),
        F.count_if(merge).alias("files_merged"), F.sum(F.when(merge, F.col("bytes"))).alias("bytes_rewritten"),
        F.count_distinct("merged_into").alias("files_written")).collect()[0].asDict()
    facts = {k: int(v or 0) for k, v in facts.items()}
    if facts["files_written"]:
        merged, _ = _merged(spark, out)
        rows = _with_file(src.where(F.col("_metadata.file_size") < small)).join(merged, "_file").drop("_file")
        laid = rows.repartitionById(facts["files_written"], F.col("_bin")).sortWithinPartitions("_bin", *by, *sort_by).drop("_bin")
        w = laid.write.partitionBy(*by) if by else laid.write
        w.parquet(f"{out}/files")
    return facts | {"files_untouched": facts["files_before"] - facts["files_merged"], "rows_after": read(spark, path, out).count()}


def read(spark: SparkSession, path: str, out: str) -> DataFrame:
    """The table at ``path`` after :func:`compact_small` into ``out``. Files that came to ``path``
    since are read too."""
    src = spark.read.parquet(path)
    merged, small = _merged(spark, out)
    if not small:
        return src
    alone = _with_file(src.where(F.col("_metadata.file_size") < small)).join(merged, "_file", "left_anti").drop("_file")
    new = spark.read.schema(src.schema).parquet(f"{out}/files")
    return src.where(F.col("_metadata.file_size") >= small).unionByName(alone).unionByName(new)
