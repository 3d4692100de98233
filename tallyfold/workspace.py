"""Where a job may put files that every executor has to see."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, else the checkpoint folder of the context.

    A machine-local folder is used only for a local master that names neither.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyfold-"))
    return context.getCheckpointDir()


_scopes: contextvars.ContextVar[list | None] = contextvars.ContextVar("scratch", default=None)


def run_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh sub-folder path for one run; nothing is created yet."""
    path = f"{shared_root(spark)}/{purpose}-{uuid.uuid4().hex}"
    if (scope := _scopes.get()) is not None:
        scope.append(path)
    return path


@contextmanager
def scratch(spark: SparkSession):
    """Intermediate folders made inside are deleted at the end: run the action that needs them inside as well."""
    made: list[str] = []
    token = _scopes.set(made)
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in made:
            remove_folder(spark, path)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def subfolders(spark: SparkSession, path: str, finished: bool = False) -> list[str]:
    """Names of the folders in a folder, through the session's own file systems; none where it does not exist.

    ``finished`` keeps those that a Spark write has completed.
    """
    store, place = _folder(spark, path)
    if not store.exists(place):
        return []
    names = [entry.getPath().getName() for entry in store.listStatus(place) if entry.isDirectory()]
    done = spark._jvm.org.apache.hadoop.fs.Path
    return sorted(n for n in names if not finished or store.exists(done(f"{path}/{n}/_SUCCESS")))


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library made."""
    store, place = _folder(spark, path)
    store.delete(place, True)


def move_folder(spark: SparkSession, folder: str, to: str) -> None:
    """Rename a folder that this library made; the parent of the new name is made too."""
    store, place = _folder(spark, folder)
    target = _folder(spark, to)[1]
    store.mkdirs(target.getParent())
    if not store.rename(place, target):
        raise OSError(f"{folder} could not be moved to {to}")
