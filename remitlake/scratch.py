"""Shared working storage: the folder named by ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder. Only a local master may fall back to a temporary one."""
    context = spark.sparkContext
    root = (
        spark.conf.get("spark.checkpoint.dir", None)
        or context.getConf().get("spark.checkpoint.dir")
        or context.getCheckpointDir()
    )
    if not root:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="remitlake-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


_HANDED_OUT: list[str] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is created yet."""
    _HANDED_OUT.append(f"{scratch_root(spark)}/remitlake-{label}-{uuid.uuid4().hex}")
    return _HANDED_OUT[-1]


def clean(spark: SparkSession) -> int:
    """Delete every path that this process was given, when no result that reads one is needed any
    more; returns their number."""
    paths, _HANDED_OUT[:] = list(_HANDED_OUT), []
    for path in paths:
        delete(spark, path)
    return len(paths)


@contextmanager
def materialized(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written once as Parquet in shared storage, for results that several jobs read.

    The shuffle behind them runs once, and a lost executor costs a re-read instead of a
    recomputation. The copy is deleted on leaving the block.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        delete(spark, path)


def _path(spark: SparkSession, path: str):
    """A path and the file system that it is on."""
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    target, files = _path(spark, path)
    return files.exists(target)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, without hidden ones; a missing folder has none."""
    target, files = _path(spark, path)
    if not files.exists(target):
        return []
    found = [(s.getPath().getName(), s.isDirectory()) for s in files.listStatus(target)]
    return sorted(name for name, folder in found if folder and name[0] not in "._")


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that a pattern with * finds."""
    target, files = _path(spark, pattern)
    return sorted(s.getPath().toString() for s in files.globStatus(target) or [])


def delete(spark: SparkSession, path: str) -> None:
    target, files = _path(spark, path)
    files.delete(target, True)
