"""Session helpers.

The library never builds its own cluster session; it reads what the session
says. ``local_session`` is for tests and the bench only.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.parquet.inferTimestampNTZ.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shared_folder(configured: str | None, of_context: str | None, master: str) -> str | None:
    """The folder that is set, or None where a local one may be made: in local mode only.
    On a cluster a folder of one machine would split every intermediate table."""
    if configured or of_context:
        return configured or of_context
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir must name a shared folder on {master}")
    return None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and scratch tables.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (it cannot be changed at runtime). Only when neither it nor the
    context's checkpoint directory is set (local tests) is a local folder
    created and given to ``setCheckpointDir``.
    """
    d = shared_folder(spark.conf.get("spark.checkpoint.dir", None), spark.sparkContext.getCheckpointDir(),
                      spark.sparkContext.master)
    if not d:
        d = tempfile.mkdtemp(prefix="tidemark-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for an intermediate table."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"
