"""Source extracts as a Spark data source: incremental, partitioned reads and idempotent appends.

A source that no database connection serves arrives as a folder of Parquet extracts.
``tidemark_extract`` reads it the way the JDBC reader reads a table: the watermark and
the scope are DataFrame filters that Spark hands to the reader (``pushFilters``), the
projection is the schema, and the rows come back as Arrow batches in as many even
partitions as asked for. Row groups whose statistics rule them out are never opened.

Its writer appends a batch under an id. Every task writes a file of its own and tells
the driver its name; only the files of one successful attempt per task are listed in the
batch's commit, and readers follow commits. So a task that runs twice, or a batch that
is sent twice, leaves no repeated row.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset as ds
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as api
from pyspark.sql import types as T

from tidemark.config import SourceSpec
from tidemark.sources.jdbc import incremental_pull, pulled, scope_filter

FORMAT = "tidemark_extract"
COMMITS = "_commits"
#: Column types whose comparisons mean the same in Spark and in Arrow.
_PUSHED_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.BooleanType, T.DateType, T.TimestampNTZType, T.DecimalType)
BATCH_ROWS = 65_536


def _located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path, from a plain path or a URI."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), path


def committed_files(path: str) -> list[str]:
    """The files of an extract folder: those its commits list, or all of a folder without commits."""
    store, root = _located(path)
    found = store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True))
    commits = [f.path for f in found if f.path.startswith(f"{root.rstrip('/')}/{COMMITS}/") and f.path.endswith(".json")]
    if not commits:
        return sorted(f.path for f in found if f.path.endswith(".parquet") and f"/{COMMITS}" not in f.path)
    names = []
    for commit in commits:
        with store.open_input_stream(commit) as body:
            names += [f"{root.rstrip('/')}/{name}" for name in json.loads(body.read())["files"]]
    return sorted(names)


@dataclass
class Piece(api.InputPartition):
    """Row groups that one task reads: (file, numbers)."""

    groups: list[tuple[str, list[int]]]


class ExtractReader(api.DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        given = {k.lower(): v for k, v in options.items()}
        self.schema, self.path = schema, given["path"]
        self.pieces = int(given.get("numpartitions", 1)) if given.get("partitioncolumn") else 1
        self.filters: list[api.Filter] = []

    def pushFilters(self, filters: Iterable[api.Filter]) -> Iterator[api.Filter]:
        """Takes comparisons of plain columns; what it doesn't take, Spark applies."""
        for f in filters:
            if _expression(f, self.schema) is None:
                yield f
            else:
                self.filters.append(f)

    def _condition(self) -> pc.Expression | None:
        out = None
        for f in self.filters:
            e = _expression(f, self.schema)
            out = e if out is None else out & e
        return out

    def partitions(self) -> Sequence[api.InputPartition]:
        """Row groups in the order of the files, cut where their rows add up to even shares;
        one partition without a split column, or where nothing is left to read."""
        store, _ = _located(self.path)
        files, condition = committed_files(self.path), self._condition()
        groups: list[tuple[str, int, int]] = []
        if files:
            dataset = ds.dataset(files, format="parquet", filesystem=store)
            for fragment in dataset.get_fragments(filter=condition):
                for part in fragment.split_by_row_group(filter=condition):
                    groups += [(part.path, g.id, g.num_rows) for g in part.row_groups]
        total, seen, out = sum(n for *_, n in groups), 0, {}
        for path, number, rows in groups:
            share = min(self.pieces - 1, (2 * seen + rows) * self.pieces // (2 * max(1, total)))  # by its middle row
            out.setdefault(share, {}).setdefault(path, []).append(number)
            seen += rows
        return [Piece(list(files.items())) for _, files in sorted(out.items())] or [Piece([])]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        store, _ = _located(self.path)
        names, condition = self.schema.names, self._condition()
        arrow = to_arrow_schema(self.schema)
        for path, numbers in partition.groups:
            with store.open_input_file(path) as opened:
                for batch in pq.ParquetFile(opened).iter_batches(BATCH_ROWS, row_groups=numbers, columns=names):
                    table = pa.Table.from_batches([batch])
                    if condition is not None:
                        table = table.filter(condition)
                    yield from table.select(names).cast(arrow).to_batches()


def _expression(f: api.Filter, schema: T.StructType) -> pc.Expression | None:
    """The filter for Arrow, or None if it isn't one of those that the reader takes. A
    comparison with a null is null and drops the row, as in SQL."""
    if isinstance(f, api.Not):
        return None if not isinstance(f.child, api.EqualTo) or (e := _expression(f.child, schema)) is None else ~e
    if len(f.attribute) != 1 or f.attribute[0] not in schema.names:
        return None
    if not isinstance(schema[f.attribute[0]].dataType, _PUSHED_TYPES):
        return None
    column = pc.field(f.attribute[0])
    if isinstance(f, api.IsNotNull):
        return column.is_valid()
    if isinstance(f, api.In):
        return column.isin([v for v in f.value if v is not None])
    if getattr(f, "value", None) is None:
        return None
    make = {api.EqualTo: column.__eq__, api.GreaterThan: column.__gt__, api.GreaterThanOrEqual: column.__ge__,
            api.LessThan: column.__lt__, api.LessThanOrEqual: column.__le__}.get(type(f))
    return None if make is None else make(f.value)


@dataclass
class Written(api.WriterCommitMessage):
    file: str | None
    rows: int


class ExtractWriter(api.DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.path, self.batch = options["path"].rstrip("/"), options["batch"]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """One attempt of a task: a file that no other attempt writes."""
        store, root = _located(self.path)
        name, rows, out = f"part-{self.batch}-{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(root, recursive=True)
                out = pq.ParquetWriter(f"{root}/{name}", batch.schema, filesystem=store)
            out.write_batch(batch)
            rows += batch.num_rows
        if out is not None:
            out.close()
        return Written(name if rows else None, rows)

    def commit(self, messages: list[Written | None]) -> None:
        """List the files of the batch; a batch that is committed already stays as it is."""
        store, root = _located(self.path)
        done = f"{root}/{COMMITS}/{self.batch}.json"
        if store.get_file_info(done).type != fs.FileType.NotFound:
            self.abort(messages)
            return
        store.create_dir(f"{root}/{COMMITS}", recursive=True)
        body = {"batch": self.batch, "rows": sum(m.rows for m in messages if m), "files": [m.file for m in messages if m and m.file]}
        draft = f"{done}.{uuid.uuid4().hex}"
        with store.open_output_stream(draft) as out:
            out.write(json.dumps(body).encode())
        store.move(draft, done)

    def abort(self, messages: list[Written | None]) -> None:
        store, root = _located(self.path)
        for m in messages:
            if m and m.file:
                store.delete_file(f"{root}/{m.file}")


class ExtractSource(api.DataSource):
    """Options: ``path``; to read, ``columns`` (comma-joined, all by default) and, for a read in
    ``numPartitions`` parts, ``partitionColumn``; to write, ``batch``, the batch's id."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> T.StructType:
        from pyspark.sql.pandas.types import from_arrow_schema

        store, _ = _located(self.options["path"])
        files = committed_files(self.options["path"])
        if not files:
            raise FileNotFoundError(f"no extract under {self.options['path']}: give its schema")
        found = from_arrow_schema(pq.read_schema(files[0], filesystem=store), prefer_timestamp_ntz=True)
        wanted = self.options.get("columns")
        return T.StructType([found[c] for c in wanted.split(",")]) if wanted else found

    def reader(self, schema: T.StructType) -> ExtractReader:
        return ExtractReader(schema, dict(self.options))

    def writer(self, schema: T.StructType, overwrite: bool) -> ExtractWriter:
        if overwrite:
            raise ValueError("extracts are appended to, never overwritten")
        return ExtractWriter(dict(self.options))


def register(spark: SparkSession) -> None:
    """Make the format known to the session and let Spark hand filters to Python readers."""
    spark.dataSource.register(ExtractSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_extract(spark: SparkSession, path: str, columns: Sequence[str] = (), partition_column: str | None = None,
                 num_partitions: int = 8) -> DataFrame:
    register(spark)
    options = {"path": path} | ({"columns": ",".join(columns)} if columns else {})
    if partition_column:
        options |= {"partitionColumn": partition_column, "numPartitions": str(num_partitions)}
    return spark.read.format(FORMAT).options(**options).load()


def needed_columns(spec: SourceSpec) -> list[str]:
    """What a pull of the spec reads: its columns, and those of its filters."""
    extra = [spec.sequence_column, spec.watermark_column, spec.scope_column, pulled(spec).exclude_column]
    return list(dict.fromkeys([*spec.columns, *[c for c in extra if c]]))


def read_extract_incremental(spark: SparkSession, path: str, spec: SourceSpec, watermark: datetime) -> DataFrame:
    """The incremental pull of a source that is a folder of extracts: rows above the
    watermark and in scope, the spec's columns, in the spec's number of partitions (one
    without a split column)."""
    source = read_extract(spark, path, needed_columns(spec), spec.partition_column, spec.num_partitions)
    return incremental_pull(source, spec, watermark)


def extract_count(spark: SparkSession, path: str, spec: SourceSpec) -> int:
    """Rows of the extract in the spec's scope."""
    scope = scope_filter(spec)
    source = read_extract(spark, path, needed_columns(spec))
    return (source if scope is None else source.filter(scope)).count()


def append_extract(df: DataFrame, path: str, batch_id: str) -> None:
    """Append ``df`` as one batch; sending a batch again changes nothing."""
    register(df.sparkSession)
    df.write.format(FORMAT).mode("append").options(path=path, batch=batch_id).save()
