"""Intermediate tables on shared storage.

A staged frame has three uses: its lineage is cut by files that outlive any
executor, its size is known so Catalyst broadcasts it only below
``spark.sql.autoBroadcastJoinThreshold``, and a sort-merge join on it keeps the
plain scan-exchange-sort shape whose hot partitions adaptive execution can split.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_SESSION_ROOTS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder.  A folder of our own only where none is named."""
    configured = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set(CHECKPOINT_DIR, made)
    return made


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder, removed when the session ends."""
    context = spark.sparkContext
    root = _SESSION_ROOTS.get(context.applicationId)
    if root is None:
        root = f"{shared_dir(spark)}/tidemark-{uuid.uuid4().hex}"
        folder = context._jvm.org.apache.hadoop.fs.Path(root)
        files = folder.getFileSystem(context._jsc.hadoopConfiguration())
        files.mkdirs(folder)
        files.deleteOnExit(folder)
        _SESSION_ROOTS[context.applicationId] = root
    return f"{root}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Catalyst's size estimate of ``df`` is below the broadcast threshold.

    Only meaningful for scans of staged tables, whose estimate is their file size.
    """
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return 0 <= int(str(size)) <= limit
