"""Stage tables: Parquet in the shared folder the cluster names in spark.checkpoint.dir.

A stage table cuts lineage, survives the loss of executors and freezes values that
depend on how the data was partitioned (partition ids, generated sequence numbers).
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Written tables of whole texts: about two thirds of the bytes of Spark's default.
COMPACT = "zstd"
# Spark then drops the shuffle files of a statement when it ends, not some time after.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}
# Per thread the folder of the stage tables that are deleted when ``temporary_stages`` ends.
_temporary: dict[int, str] = {}


def stage_root(spark: SparkSession) -> str:
    """This application's folder below spark.checkpoint.dir.

    Only a local session without the setting (tests) gets a folder of its own; on a
    cluster the setting is required, since executors must all see the folder.
    """
    context = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if context.applicationId not in _local_roots:
            _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="run-")
        base = _local_roots[context.applicationId]
    return f"{base.rstrip('/')}/threadwarden/{context.applicationId}"


def new_stage_path(spark: SparkSession, name: str) -> str:
    return f"{_temporary.get(threading.get_ident()) or stage_root(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[None]:
    """Stage tables that this thread writes inside, and shuffle files, go when they have served.

    Nothing lazy that reads such a table may leave the block.
    """
    thread, outer = threading.get_ident(), _temporary.get(threading.get_ident())
    folder = new_stage_path(spark, "temporary")
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    _temporary[thread] = folder
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
        if outer is None:
            del _temporary[thread]
        else:
            _temporary[thread] = outer
        drop(spark, folder)


def write_stage(df: DataFrame, name: str, **measures: Column) -> tuple[str, dict]:
    """Write ``df`` once; returns the path and the measures, aggregates taken while writing."""
    path = new_stage_path(df.sparkSession, name)
    if not measures:
        df.write.parquet(path)
        return path, {}
    seen = Observation()
    df.observe(seen, *[m.alias(k) for k, m in measures.items()]).write.parquet(path)
    return path, seen.get


def read_stages(like: DataFrame, *paths: str) -> DataFrame:
    """Written tables of the same columns as one."""
    return like.sparkSession.read.schema(like.schema).parquet(*paths)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table."""
    path, _ = write_stage(df, name)
    return read_stages(df, path)


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete written tables, or single files of them, that nothing reads any more."""
    for path in paths:
        target, fs = _file_system(spark, path)
        fs.delete(target, True)


def drop_stages(spark: SparkSession) -> None:
    """Delete this application's stage tables, once the results built on them are saved."""
    drop(spark, stage_root(spark))


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    target, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def table_exists(spark: SparkSession, path: str) -> bool:
    """True for a completely written table: a failed job leaves no success marker."""
    return path_exists(spark, path.rstrip("/") + "/_SUCCESS")


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
