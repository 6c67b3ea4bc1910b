"""Files and named tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from voltstream.sinks.files import CSV_READ, unescape_table


def csv_table(
    spark: SparkSession,
    path: str,
    schema: str,
    stream: bool = False,
    escape_breaks: bool = False,
    **options: str,
) -> DataFrame:
    """Headerless CSV with declared columns, as a table or as a stream of files.

    ``path`` is a folder, a pattern or one file. A field that does not fit its column
    fails the job, so that no reading turns into a null unseen; pass
    ``mode="PERMISSIVE"`` to get the nulls. An empty field is null, a quoted empty one
    is the empty text. ``escape_breaks`` reads what ``csv_sink`` wrote with it.
    ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound the batches of a stream.
    """
    reader = spark.readStream if stream else spark.read
    settings = {**CSV_READ, "mode": "FAILFAST", **options}
    table = reader.schema(schema).options(**settings).csv(_watched(path, stream))
    return unescape_table(table) if escape_breaks else table


def parquet_table(
    spark: SparkSession, path: str, schema: str, stream: bool = False, **options: str
) -> DataFrame:
    """Parquet with declared columns, as a table or as a stream of files.

    A file's plain timestamps may be declared TIMESTAMP; they are read as UTC.
    A stream takes the files in order of modification time. If that is also the order
    of event time, ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` bound its batches
    and so its state; otherwise leave them unset: one batch then holds all files
    present, and no row of theirs can be late.
    """
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(**options).parquet(_watched(path, stream))


def named_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by name; streaming views stay streams."""
    return spark.table(name)


def _watched(path: str, stream: bool) -> str:
    """A stream wants a folder or a pattern; this pattern also matches one file."""
    path = path.rstrip("/")
    if stream and not set(path) & set("*?[{"):
        return f"{path[:-1]}[{path[-1]}]"
    return path
