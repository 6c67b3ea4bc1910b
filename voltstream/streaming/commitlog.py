"""What a stream has done, batch by batch, in its checkpoint's folder.

A micro-batch is replayed if the driver is lost before Spark notes that it ended. The
log tells such a replay which of its steps were done, so that a sink that can only
append is not given the same rows again. One step is a small file; writing it is the
last thing a step does, so a loss between the two still repeats that one step.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import SparkSession

# Entries of older batches are removed: a stream replays no batch before its last.
KEPT_BATCHES = 100


class CommitLog:
    """Facts by step and batch number. Any file system Spark knows will do."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm = spark._jvm
        self._folder = folder.rstrip("/")
        self._files = self._path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def get(self, step: str, batch_id: int) -> dict[str, object] | None:
        """What was noted for the step of the batch, or None if it was not done."""
        path = self._path(self._name(step, batch_id))
        if not self._files.exists(path):
            return None
        stream = self._files.open(path)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def has(self, step: str, batch_id: int | None) -> bool:
        return batch_id is not None and self.get(step, batch_id) is not None

    def add(self, step: str, batch_id: int | None, facts: Mapping[str, object] | None = None) -> None:
        """Note that the step of a batch is done. Seen by others whole or not at all."""
        if batch_id is None:
            return
        text = json.dumps(dict(facts or {})).encode()
        name = self._name(step, batch_id)
        draft = self._path(f".{name}.draft")
        stream = self._files.create(draft, True)
        stream.write(bytearray(text))
        stream.close()
        path = self._path(name)
        self._files.delete(path, False)
        if not self._files.rename(draft, path):
            raise OSError(f"cannot write {path}")
        self._files.delete(self._path(self._name(step, batch_id - KEPT_BATCHES)), False)

    def last(self, step: str, before: int) -> dict[str, object] | None:
        """The facts of the newest batch of a step below a number."""
        numbers = [n for s, n in self._entries() if s == _plain(step) and n < before]
        return self.get(step, max(numbers)) if numbers else None

    def _entries(self) -> list[tuple[str, int]]:
        if not self._files.exists(self._path("")):
            return []
        names = (status.getPath().getName() for status in self._files.listStatus(self._path("")))
        found = (re.fullmatch(r"(.+)-(\d+)\.json", name) for name in names)
        return [(m[1], int(m[2])) for m in found if m and not m[1].startswith(".")]

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self._folder}/{name}" if name else self._folder)

    @staticmethod
    def _name(step: str, batch_id: int) -> str:
        return f"{_plain(step)}-{batch_id}.json"


def _plain(step: str) -> str:
    return re.sub(r"[^\w.]+", "_", step)
