"""Intermediate tables in the shared folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_written: dict[str, list[str]] = {}
_local_bases: dict[str, str] = {}
_scopes = threading.local()


def scratch_base(spark: SparkSession) -> str:
    """The shared scratch folder; a temporary one only when Spark runs inside this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_bases:
        base = tempfile.mkdtemp(prefix="plantmetrics-")
        atexit.register(shutil.rmtree, base, ignore_errors=True)
        _local_bases[application] = base
    return _local_bases[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_base(spark)}/plantmetrics/{label}-{uuid.uuid4().hex}"
    open_scopes = getattr(_scopes, "open", None)
    mine = open_scopes[-1] if open_scopes else _written.setdefault(spark.sparkContext.applicationId, [])
    mine.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """What this thread stages inside is deleted at the end, whatever other threads stage meanwhile."""
    if not hasattr(_scopes, "open"):
        _scopes.open = []
    _scopes.open.append([])
    try:
        yield
    finally:
        _delete(spark, _scopes.open.pop())


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once and continue from the written table, so its rows can no longer change.

    A lost executor then costs a re-read, and values that depend on physical layout (partition
    numbers) become plain data.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written(spark: SparkSession) -> int:
    """How many scratch tables this application has and hasn't cleared."""
    return len(_written.get(spark.sparkContext.applicationId, []))


def clear_scratch(spark: SparkSession, keep: int = 0) -> int:
    """Delete the scratch tables this application wrote, but for the first ``keep``; call once their readers
    are done."""
    mine = _written.get(spark.sparkContext.applicationId, [])
    paths = mine[keep:]
    del mine[keep:]
    _delete(spark, paths)
    return len(paths)


def _delete(spark: SparkSession, paths: list[str]) -> None:
    jvm = spark.sparkContext._jvm
    hadoop_conf = spark.sparkContext._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(hadoop_conf).delete(target, True)
