"""Tasks of lm.java, which run in Spark's JVM: loops over bytes that no array pass can take."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_compiled: dict[str, JavaObject] = {}


def _task_class(spark: SparkSession) -> JavaObject:
    """The class of tasks. The driver compiles it once per application with the compiler that
    Spark has for its own code; executors get it as a jar."""
    app = spark.sparkContext.applicationId
    if app not in _compiled:
        jvm = spark._jvm
        compiler = jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.cook(Path(__file__).with_name("lm.java").read_text())
        jar = Path(tempfile.mkdtemp(prefix="tidemark-code-")) / "tidemark-lm.jar"
        classes = compiler.getBytecodes()
        with zipfile.ZipFile(jar, "w") as out:
            for name in sorted(classes):
                out.writestr(f"{name.replace('.', '/')}.class", bytes(classes[name]))
        spark.sparkContext._jsc.addJar(str(jar))
        _compiled.clear()
        _compiled[app] = compiler.getClassLoader().loadClass("tidemark.LanguageTask")
    return _compiled[app]


def java_task(spark: SparkSession, kind: str, blob: bytes | None = None) -> JavaObject:
    """A task of a kind, with ``blob`` broadcast."""
    task = _task_class(spark).newInstance()
    if blob is None:
        return task.of(kind, spark.sparkContext._jsc, None, 0)
    with tempfile.NamedTemporaryFile(prefix="tidemark-blob-") as file:
        file.write(blob)
        file.flush()
        return task.of(kind, spark.sparkContext._jsc, file.name, uuid.uuid4().int >> 65)


#: Rows then hold days and moments as Spark does, not by the calendar of java.sql, which leaves out ten days.
DAYS = "spark.sql.datetime.java8API.enabled"


def map_java(df: DataFrame, task: JavaObject, schema: T.StructType | str) -> DataFrame:
    """The rows that ``task`` makes of each partition of ``df``."""
    spark = df.sparkSession
    kind = spark._jsparkSession.parseDataType((T._parse_datatype_string(schema) if isinstance(schema, str) else schema).json())
    before = spark.conf.get(DAYS, None)
    spark.conf.set(DAYS, "true")
    try:
        return DataFrame(df.select("*")._jdf.mapPartitions(task, spark._jvm.org.apache.spark.sql.Encoders.row(kind)), spark)
    finally:
        spark.conf.unset(DAYS) if before is None else spark.conf.set(DAYS, before)
