"""Stage tables: a DataFrame written once to the shared folder and read back.

Multi-pass work (iterations, statistics that are joined back, models) reads a stage table
instead of recomputing its input. A Parquet table on shared storage survives lost executors,
keeps column pruning and filter pushdown, and tells Catalyst its true size, so a later join
is broadcast only when the file is measured to be below spark.sql.autoBroadcastJoinThreshold.
"""

from __future__ import annotations

import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_root: str | None = None
_written: list[str] = []
_path_of: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()

#: The JVM never compiles a method beyond 8,000 bytes, and a wide table's generated loop is one method.
_METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only where it is unset."""
    global _local_root
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="vitrine-stages-")
    return _local_root


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Inside, a setting of the session has another value."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def compiled_methods(spark: SparkSession) -> AbstractContextManager[None]:
    """Inside, Spark splits generated code that the JVM would only interpret; the session's setting comes back after."""
    return setting(spark, *_METHOD_LIMIT)


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` to a new stage table and return the DataFrame that reads it."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    with compiled_methods(spark):
        df.write.parquet(path, compression="zstd")
    _written.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    _path_of[table] = path
    return table


def _delete(spark: SparkSession, path: str) -> None:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


def release(*tables: DataFrame | None) -> None:
    """Delete stage tables that nothing reads any more, such as those of the round before."""
    for table in tables:
        path = _path_of.pop(table, None) if table is not None else None
        if path in _written:
            _written.remove(path)
            _delete(table.sparkSession, path)


def release_stages(spark: SparkSession, since: int = 0) -> int:
    """Delete the stage tables this process wrote, but for the first ``since``; returns how many there were."""
    count = len(_written) - since
    while len(_written) > since:
        _delete(spark, _written.pop())
    return count


@contextmanager
def stage_scope(spark: SparkSession) -> Iterator[None]:
    """Stage tables written inside are deleted at the end: for steps whose results are written elsewhere."""
    since = len(_written)
    try:
        yield
    finally:
        release_stages(spark, since)


@contextmanager
def last_stage_only(spark: SparkSession) -> Iterator[None]:
    """Of the stage tables written inside, only the last one stays: for steps whose result is that table."""
    since = len(_written)
    try:
        yield
    finally:
        if len(_written) > since:
            last = _written.pop()
            release_stages(spark, since)
            _written.append(last)
