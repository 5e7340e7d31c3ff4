"""Folders for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


class _Scopes(threading.local):
    """Open scopes of a thread, innermost last: layer runs write several tables at once."""

    def __init__(self) -> None:
        self.open: list[list[str]] = []


_scopes = _Scopes()


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder path for one run, in the shared folder the session names.

    The folder is the setting's, or the one given to ``setCheckpointDir``. Only a
    local-mode session that names none falls back to this machine's temporary
    folder; a cluster without a shared folder is an error.
    """
    base = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="run-")
    path = f"{base.rstrip('/')}/{label}-{uuid4().hex}"
    if _scopes.open:
        _scopes.open[-1].append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, in whatever file system holds it; none is no error."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[list[str]]:
    """Delete, at the end, the scratch folders that this thread made inside.

    For code that has written its result: a DataFrame that still reads such a folder
    must not leave the scope.
    """
    made: list[str] = []
    _scopes.open.append(made)
    try:
        yield made
    finally:
        _scopes.open.pop()
        for path in made:
            remove(spark, path)
