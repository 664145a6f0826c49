"""A commit log in a folder: what its readers go by.

Every version is one small JSON file under ``_commits``; the newest whole one
is the folder's state.  Data is written to folders of its own first, which no
state names yet, so a job that dies leaves nothing that is read, and readers of
an older state keep their files.  A version is created only if it is not there,
so of two writers that started from one state the second fails and can be run
again.  A file that a dying writer left incomplete is no JSON and counts as not
written."""

from __future__ import annotations

import json
import re

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

LOG = "_commits"


class CommitConflict(RuntimeError):
    """Another writer has committed in the meantime."""


def _hadoop(spark: SparkSession, path: str):
    """Hadoop path and its file system (any scheme)."""
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def _versions(spark: SparkSession, root: str) -> list[int]:
    p, fs = _hadoop(spark, f"{root.rstrip('/')}/{LOG}")
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if re.fullmatch(r"[0-9]+\.json", n))


def _path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/{LOG}/{version:012d}.json"


def read_state(spark: SparkSession, root: str) -> tuple[int, dict]:
    """The newest version's number and state; the number is that of the newest
    file even if it is incomplete, (0, {}) where nothing was committed."""
    versions = _versions(spark, root)
    for version in reversed(versions):
        p, fs = _hadoop(spark, _path(root, version))
        stream = fs.open(p)
        try:
            text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        try:
            return versions[-1], json.loads(text)
        except json.JSONDecodeError:
            continue
    return (versions[-1] if versions else 0), {}


def commit(spark: SparkSession, root: str, after: int, state: dict) -> int:
    """Make ``state`` the folder's state, if version ``after`` is still the newest."""
    p, fs = _hadoop(spark, _path(root, after + 1))
    if _versions(spark, root)[-1:] not in ([], [after]):
        raise CommitConflict(f"{root} has changed since version {after}")
    try:
        stream = fs.create(p, False)
    except Py4JJavaError as e:
        if fs.exists(p):
            raise CommitConflict(f"{root} has changed since version {after}") from e
        raise
    stream.write(bytearray(json.dumps(state, sort_keys=True).encode()))
    stream.close()
    return after + 1
