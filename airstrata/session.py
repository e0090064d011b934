"""Session settings for local runs and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_OWN_SCRATCH: dict[str, str] = {}
_KEPT: set[str] = set()
_SCOPE: ContextVar[str] = ContextVar("scratch_scope", default="")


def local_session(cores: int | str = 8, name: str = "airstrata") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def scratch_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder: on a cluster such
    a folder would exist on one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _OWN_SCRATCH:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _OWN_SCRATCH[app] = tempfile.mkdtemp(prefix="airstrata-")
    return _OWN_SCRATCH[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the scratch folder."""
    folder = f"{scratch_root(spark)}/airstrata/{spark.sparkContext.applicationId}"
    if folder not in _KEPT:
        # one folder per application, which goes when the driver's JVM ends
        files, target = _file_system(spark, folder)
        files.mkdirs(target)
        files.deleteOnExit(target)
        _KEPT.add(folder)
    return f"{folder}{_SCOPE.get()}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, on whatever file system it is."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    files, target = _file_system(spark, path)
    return files.exists(target)


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, on whatever file system they are."""
    files, target = _file_system(spark, pattern)
    return [status.getPath().toString() for status in files.globStatus(target) or []]


def folder_state(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a folder, to tell if it has changed."""
    files, target = _file_system(spark, path)
    found = []
    for status in files.listStatus(target):
        inner = files.listStatus(status.getPath()) if status.isDirectory() else [status]
        found += [(x.getPath().toString(), x.getLen(), x.getModificationTime()) for x in inner]
    return tuple(sorted(found))


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete what is materialized inside, for jobs that end by writing tables."""
    name = f"/scope-{uuid.uuid4().hex}"
    outer = _SCOPE.set(name)
    try:
        yield
    finally:
        _SCOPE.reset(outer)
        folder = f"{scratch_root(spark)}/airstrata/{spark.sparkContext.applicationId}"
        delete_path(spark, folder + name)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write a result to the scratch folder and read it back.

    Used where a result feeds several branches. Unlike a cached result it
    survives the loss of executors without recomputing what led to it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
