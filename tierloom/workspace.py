"""Where jobs keep checkpoints and intermediate files, when these are deleted, and the session settings jobs want."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from weakref import WeakKeyDictionary

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOTS: dict[str, str] = {}
# Folders that are still there, by the scope that owns them; the first scope is the application's.
_SCOPES: list[dict[str, SparkSession]] = [{}]
_FOLDERS: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``; on a local master else a temporary one, removed at the end."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        root = tempfile.mkdtemp(prefix="tierloom-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        _LOCAL_ROOTS[context.applicationId] = root
    return _LOCAL_ROOTS[context.applicationId]


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A folder name below the shared root that no earlier run has used, owned by the innermost ``scratch`` scope."""
    path = f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
    _SCOPES[-1][path] = spark
    return path


@contextmanager
def scratch() -> Iterator[dict[str, SparkSession]]:
    """Own every folder that is made inside the block, and delete them at its end, whether it fails or not.

    A result that is still to be computed has to be written inside the block. What is made outside of all blocks is
    deleted when the application ends.
    """
    scope: dict[str, SparkSession] = {}
    _SCOPES.append(scope)
    try:
        yield scope
    finally:
        # By identity: empty scopes are equal.
        del _SCOPES[next(i for i, other in enumerate(_SCOPES) if other is scope)]
        for path, spark in scope.items():
            remove_folder(spark, path)


def keep(table: DataFrame) -> DataFrame:
    """Hand the folder of a stored table over from the innermost scope to the one around it."""
    path = _FOLDERS.get(table)
    if path in _SCOPES[-1] and len(_SCOPES) > 1:
        _SCOPES[-2][path] = _SCOPES[-1].pop(path)
    return table


def _located(spark: SparkSession, path: str):
    """The file system and the path, of any kind that Spark writes to."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder; nothing happens if it is not there."""
    system, target = _located(spark, path)
    system.delete(target, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    system, target = _located(spark, path)
    return system.exists(target)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts the lineage, survives lost executors."""
    path = fresh_folder(df.sparkSession, label)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete the folders of stored tables that nothing will read again. Other tables are left alone."""
    for table in tables:
        path = _FOLDERS.pop(table, None)
        if path is not None:
            for scope in _SCOPES:
                scope.pop(path, None)
            remove_folder(table.sparkSession, path)


@atexit.register
def _end_of_application() -> None:
    for path, spark in _SCOPES[0].items():
        try:
            remove_folder(spark, path)
        except (Py4JError, OSError, AttributeError, AssertionError):
            # The session's process has ended before this one; nothing can be reached any more.
            return


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session values for the duration of a block, then put the former ones back."""
    former = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in former.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)

