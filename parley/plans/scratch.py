"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
_USED: set[str] = set()


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session, where driver and executors are one machine, may fall back to a
    temporary folder; on a cluster a missing setting is an error.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="parley-")
    return _LOCAL_ROOTS[app]


def _session_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/parley/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    folder = _session_folder(spark)
    if folder not in _USED:
        _USED.add(folder)
        atexit.register(_clear_at_exit, spark)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this session.

    Results that still read them have to be written first.  Called by itself when the program
    ends; a program that goes on for long calls it between its jobs.
    """
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def _clear_at_exit(spark: SparkSession) -> None:
    context = getattr(spark.sparkContext, "_jsc", None)
    if context is not None and not context.sc().isStopped():
        clear_scratch(spark)


def settle(df: DataFrame, label: str = "table") -> DataFrame:
    """Write ``df`` once and go on from the written copy.

    Fixes values that a recomputation could change (such as partition numbers), so that a lost
    executor cannot mix two versions; and ends the lineage.  Parquet rather than an RDD
    checkpoint: readers that need two columns read two columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
