"""Intermediate tables in the shared folder of the cluster.

A result that several steps need is written once and read back. This cuts the
lineage, keeps the raw scan from running twice and survives lost executors,
because the folder is shared storage.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

from daybook.session import wide_expressions

CHECKPOINT_SETTING = "spark.checkpoint.dir"

_local_folders: dict[str, str] = {}
_scopes = threading.local()


def workspace(spark: SparkSession) -> str:
    """The folder for intermediate tables of this application.

    It lies under ``spark.checkpoint.dir``. Only a local session without that
    setting gets a temporary folder, removed at exit; a cluster session
    without it is refused.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None)
    if base:
        app = spark.conf.get("spark.app.id", "application")
        return f"{base.rstrip('/')}/daybook/{app}"
    # Executors of a local cluster are processes of their own.
    if re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")) is None:
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    app = spark.conf.get("spark.app.id", "application")
    if app not in _local_folders:
        folder = tempfile.mkdtemp(prefix="daybook-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _local_folders[app] = folder
    return _local_folders[app]


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the workspace that no earlier step has used."""
    path = f"{workspace(spark)}/{label}-{uuid4().hex}"
    for paths in getattr(_scopes, "open", [])[-1:]:
        paths.append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its store; one that names it already stays."""
    if ":" in path.partition("/")[0]:
        return path
    store, target = _file_system(spark, path)
    return store.makeQualified(target).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    store, target = _file_system(spark, path)
    return store.exists(target)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    store, target = _file_system(spark, path)
    store.delete(target, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder; the folder above the target is made."""
    store, old = _file_system(spark, source)
    new = _file_system(spark, target)[1]
    store.mkdirs(new.getParent())
    if not store.rename(old, new):
        raise OSError(f"cannot move {source} to {target}")


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what lies in a folder; none without the folder."""
    store, target = _file_system(spark, folder)
    return [entry.getPath().getName() for entry in store.listStatus(target)] if store.exists(target) else []


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file; it must not be there yet."""
    store, target = _file_system(spark, path)
    out = store.create(target, False)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def read_small(spark: SparkSession, path: str) -> str:
    store, target = _file_system(spark, path)
    stream = store.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete, at the end, the intermediate tables that were made inside.

    For steps that write their result: nothing returned from inside may still
    read such a table.
    """
    scopes = _scopes.__dict__.setdefault("open", [])
    scopes.append([])
    try:
        yield
    finally:
        for path in scopes.pop():
            delete_path(spark, path)


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """For the length of a write: its shuffle files go when it ends.

    Otherwise they stay until the driver happens to collect its garbage, and
    those of all steps of a load lie on the disks at once. Affects no result.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as Parquet to the workspace and return a scan of it."""
    spark = df.sparkSession
    path = fresh_path(spark, label)
    with wide_expressions(spark), shuffles_deleted(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
