"""Replace a directory as a whole: write next to it, then swap, so that a failed write leaves the old one readable."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

A = TypeVar("A")


class Refused(RuntimeError):
    """The new content is not to be put in place; ``result`` is what the writer returned."""

    def __init__(self, result: object):
        super().__init__("the new content was refused")
        self.result = result


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and a way to make its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsc.hadoopConfiguration()), make


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its storage and from its root, as Spark itself would read it."""
    files, make = file_system(spark, path)
    return files.makeQualified(make(path)).toString().rstrip("/")


def remove_directory(spark: SparkSession, path: str) -> None:
    files, make = file_system(spark, path)
    files.delete(make(path), True)


def replace_directory(
    spark: SparkSession, path: str, write: Callable[[str], A], accept: Callable[[A], bool] = lambda _: True
) -> A:
    """Let ``write`` fill a new sibling directory, then put it in the place of ``path`` and return its result.

    If the write fails, or ``accept`` refuses its result, the new directory is removed and ``path`` stays as it
    was. The swap is two renames of a directory on the same storage; between them, for a moment, there is no
    ``path``; where that matters, see ``sources.versions``. A process that dies there leaves the old content beside it,
    under ``.old-``. A relative path is one from the session's working directory, as Spark reads it.
    """
    path = qualified(spark, path)
    mark = uuid.uuid4().hex
    parent, _, name = path.rpartition("/")
    staged, old = f"{parent}/.new-{mark}-{name}", f"{parent}/.old-{mark}-{name}"
    try:
        result = write(staged)
        if not accept(result):
            raise Refused(result)
    except BaseException:
        remove_directory(spark, staged)
        raise
    files, make = file_system(spark, path)
    had_one = files.exists(make(path))
    if had_one and not files.rename(make(path), make(old)):
        raise OSError(f"cannot move {path} aside")
    if not files.rename(make(staged), make(path)):
        if had_one:
            files.rename(make(old), make(path))
        raise OSError(f"cannot move the new content to {path}")
    if had_one:
        files.delete(make(old), True)
    return result
