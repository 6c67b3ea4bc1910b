"""What a sink is, and writing one stream to several."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from voltstream.streaming.commitlog import CommitLog

log = logging.getLogger(__name__)

Write = Callable[[DataFrame, int | None], None]


# How lost or refused connections name themselves.
CONNECTION_ERRORS = (
    "SQLTransient",
    "SQLNonTransientConnection",
    "SQLRecoverable",
    "SocketException",
    "SocketTimeout",
    "ConnectException",
    "connection",
)


def lost_connection(error: Exception) -> bool:
    """Whether an error speaks of a connection, so that another attempt may succeed."""
    if isinstance(error, AnalysisException):
        return False
    said = f"{type(error).__name__} {error}".lower()
    return any(name.lower() in said for name in CONNECTION_ERRORS)


def unchanged(frame: DataFrame) -> DataFrame:
    return frame


@dataclass(frozen=True)
class Sink:
    """A target that takes batch frames and streams alike.

    ``prepare`` shapes the frame for the target. A ``native`` format has its own
    streaming writer; any other is written batch by batch, with ``retries`` more
    attempts if a write fails for a reason that ``passing`` takes for a passing one.
    ``parts`` are sinks that this one feeds, one after another.

    A replayed batch is written again, but not to parts that the stream's commit log
    knows as done. Files, keyed or numbered tables and keyed documents are the same
    after a replay; any other target may get a batch twice if the driver is lost
    between the write and its entry in the log.
    """

    format: str
    options: Mapping[str, str] = field(default_factory=dict)
    prepare: Callable[[DataFrame], DataFrame] = unchanged
    native: bool = True
    retries: int = 0
    pause: float = 1.0
    custom_write: Write | None = None
    passing: Callable[[Exception], bool] = lost_connection
    parts: tuple[Sink, ...] = ()

    def write(
        self, frame: DataFrame, batch_id: int | None = None, done: CommitLog | None = None
    ) -> None:
        """Append one bounded frame. Parts that ``done`` has for the batch are passed over."""
        for attempt in range(self.retries + 1):
            try:
                return self._write_once(frame, batch_id, done)
            except Exception as error:
                if attempt == self.retries or not self.passing(error):
                    raise
                log.warning("write %d to %s failed: %s", attempt + 1, self.format, error)
                time.sleep(self.pause * (attempt + 1))

    def attach(self, frame: DataFrame, log_folder: str | None = None) -> DataStreamWriter:
        """A writer of the stream ``frame`` to here, not yet started.

        ``log_folder`` keeps what each part of the sink has got.
        """
        if self.native:
            stream = self.prepare(frame).writeStream
            return stream.format(self.format).options(**self.options)
        if not self.parts or log_folder is None:
            return frame.writeStream.foreachBatch(self.write)
        done = CommitLog(frame.sparkSession, log_folder)
        return frame.writeStream.foreachBatch(lambda batch, number: self.write(batch, number, done))

    def fed(self, transform: Callable[[DataFrame], DataFrame]) -> Sink:
        """This sink behind a transform."""
        return replace(self, prepare=lambda frame: self.prepare(transform(frame)), native=False)

    def _write_once(
        self, frame: DataFrame, batch_id: int | None, done: CommitLog | None, path: str = ""
    ) -> None:
        if self.parts:
            return self._write_parts(self.prepare(frame), batch_id, done, path)
        if self.custom_write:
            return self.custom_write(self.prepare(frame), batch_id)
        out = self.prepare(frame).write.format(self.format)
        out.options(**self.options).mode("append").save()

    def _write_parts(
        self, frame: DataFrame, batch_id: int | None, done: CommitLog | None, path: str
    ) -> None:
        names = [f"{path}{n}.{part.format}" for n, part in enumerate(self.parts)]
        waiting = [
            (name, part)
            for name, part in zip(names, self.parts, strict=True)
            if done is None or not done.has(name, batch_id)
        ]
        if not waiting:
            return
        frame.persist()
        try:
            for name, part in waiting:
                if part.parts:
                    part._write_once(frame, batch_id, done, f"{name}.")
                else:
                    part.write(frame, batch_id)
                if done is not None:
                    done.add(name, batch_id)
        finally:
            frame.unpersist()


def fan_out(*sinks: Sink) -> Sink:
    """One sink that feeds several, computing each micro-batch once.

    The batch is kept on the executors (spilling to their disks) while the sinks
    read it. A partition lost with its executor is computed again from the source.
    In a stream, a batch that fails at one sink is not given again to those before it.
    """
    return Sink("fan-out", native=False, parts=sinks)
