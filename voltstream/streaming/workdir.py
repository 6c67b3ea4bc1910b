"""Shared folders for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections import defaultdict

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}
_made: dict[str, list[str]] = defaultdict(list)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared folder the cluster names.

    Every call gives another one, so two runs never share a checkpoint. Only a
    single-machine session may go without the setting; it gets one temporary
    root of its own. Elsewhere the executors would not see such a folder.
    """
    folder = f"{_root(spark)}/{label}-{uuid.uuid4().hex}"
    _made[spark.conf.get("spark.app.id", "")].append(folder)
    return folder


def remove_made(spark: SparkSession) -> int:
    """Delete the folders that ``fresh_dir`` gave this application; how many there were.

    For a session that goes on after its results have been read. Frames that still
    read from those folders fail from then on.
    """
    return sum(_removed(spark, folder) for folder in _made.pop(spark.conf.get("spark.app.id", ""), []))


def remove_dir(spark: SparkSession, folder: str) -> None:
    """Delete one of the folders that ``fresh_dir`` gave this application."""
    made = _made[spark.conf.get("spark.app.id", "")]
    if folder in made:
        made.remove(folder)
        _removed(spark, folder)


def _removed(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))


def job_dir(spark: SparkSession, job: str) -> str:
    """The same folder name for a job at every start, so that it resumes."""
    return f"{_root(spark)}/jobs/{job}"


def _root(spark: SparkSession) -> str:
    return (spark.conf.get(SETTING, None) or _local_root(spark)).rstrip("/")


def _local_root(spark: SparkSession) -> str:
    context = spark.sparkContext
    # Not "local-cluster": its executors have folders of their own.
    if context.master != "local" and not context.master.startswith("local["):
        raise RuntimeError(f"set {SETTING} to a folder every executor can reach")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="voltstream-")
    return _local_roots[context.applicationId]
