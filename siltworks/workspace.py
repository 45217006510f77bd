"""Helpers of the jobs: a folder for intermediate tables, and several tables' jobs at a time."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

A = TypeVar("A")
B = TypeVar("B")

_MADE: list[str] = []


def _scratch_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/siltworks"


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new, unused folder below the shared one that the cluster names in ``spark.checkpoint.dir``.

    A temporary local folder is used only by a local session without the setting.
    """
    folder = f"{_scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    _MADE.append(folder)
    return folder


def clear_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders that this process got for the session's storage; their tables must have been read."""
    folders = [folder for folder in _MADE if folder.startswith(f"{_scratch_root(spark)}/")]
    make = spark._jvm.org.apache.hadoop.fs.Path
    for folder in folders:
        path = make(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _MADE.remove(folder)
    return len(folders)


def session_like(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A session of its own with the caller's settings and some others, which leaves those of the caller alone."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    for name, value in settings.items():
        own.conf.set(name, value)
    return own


def error_class(error: Exception) -> str:
    """Spark's name for what went wrong, else the exception's."""
    condition = getattr(error, "getCondition", lambda: None)()
    if condition:
        return condition
    named = re.search(r"\[([A-Z][A-Z0-9_.]+)\]", str(error))
    return named.group(1) if named else type(error).__name__


def side_by_side(spark: SparkSession, job: Callable[[A], B], items: Iterable[A], at_once: int = 4) -> list[B]:
    """Submit independent jobs a few at a time, so that one table's last tasks do not leave the cluster idle.

    Results keep the order of the items. Every item is tried before an error is raised.
    """
    job = inheritable_thread_target(spark)(job)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        running = [pool.submit(job, item) for item in items]
    return [done.result() for done in running]
