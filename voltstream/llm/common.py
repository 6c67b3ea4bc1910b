"""What the operators of this folder share."""

from __future__ import annotations

import weakref

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.session import ship_package, use_utc
from voltstream.streaming.workdir import fresh_dir, remove_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
# Fixed value: Spark's own default.
DEFAULT_ROWS = "10000"

# Fixed value: the columns of the documents table.
DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")

_folders: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def prepared(spark: SparkSession) -> SparkSession:
    """The session, with this package on the executors and Arrow batches of 1,000 rows.

    A batch of the default 10,000 long texts would not fit beside the others. The setting
    lasts, as queries run when their results are read; a session with a number of its own
    keeps that.
    """
    if spark.conf.get(BATCH_ROWS, DEFAULT_ROWS) == DEFAULT_ROWS:
        spark.conf.set(BATCH_ROWS, "1000")
    return ship_package(use_utc(spark))


def settled(frame: DataFrame, label: str) -> DataFrame:
    """Write the frame to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a read, not the computation before it,
    and a table used twice is computed once. The shuffle files of the write go when it is
    over; otherwise they stay until the driver happens to collect its garbage.
    """
    spark = frame.sparkSession
    path = fresh_dir(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(frame.schema).parquet(path)
    _folders[table] = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete what ``settled`` wrote for these tables.

    Only once all that is made of them has itself been settled. Other frames are passed over.
    """
    for table in tables:
        if path := _folders.pop(table, None):
            remove_dir(table.sparkSession, path)


def text_or_empty(text: str | Column = "text") -> Column:
    """The text column, null as the empty text."""
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def identified(frame: DataFrame, key: str, text: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Only the id and the text, as ``id`` and ``text``, whatever else is there.

    Columns to keep follow as ``keep0``, ``keep1``, ... so that no names clash.
    """
    kept = (F.col(f"`{name}`").alias(f"keep{n}") for n, name in enumerate(keep))
    return frame.select(
        F.col(f"`{key}`").cast("bigint").alias("id"), text_or_empty(F.col(f"`{text}`")).alias("text"), *kept
    )


def kept_ddl(frame: DataFrame, keep: tuple[str, ...]) -> str:
    """The kept columns in a schema, each with a comma after it."""
    return "".join(f"keep{n} {frame.schema[name].dataType.simpleString()}, " for n, name in enumerate(keep))


def with_kept(batch: pa.RecordBatch, keep: tuple[str, ...], found: pa.RecordBatch) -> pa.RecordBatch:
    """The kept columns of a batch before the columns found for it."""
    names = [f"keep{n}" for n in range(len(keep))]
    return pa.record_batch(
        [*(batch.column(n) for n in names), *found.columns], names=[*names, *found.schema.names]
    )


def named(found: DataFrame, keep: tuple[str, ...], result: dict[str, object]) -> DataFrame:
    """The kept columns by their own names, then the results, which win over them."""
    kept = (F.col(f"keep{n}").alias(name) for n, name in enumerate(keep) if name not in result)
    return found.select(*kept, *(value.alias(name) for name, value in result.items()))


def record_batch(columns: dict[str, object], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    """An Arrow batch of the given columns in the order of ``types``."""
    arrays = [pa.array(columns[name], kind) for name, kind in types.items()]
    return pa.record_batch(arrays, names=list(types))
