"""CSV, JSON and Parquet folders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltstream.sinks.base import Sink, Write, unchanged

BATCH_ID = "batch_id"

CSV_OPTIONS = {
    "header": "false",
    # RFC 4180: a quote inside a quoted field is doubled.
    "quote": '"',
    "escape": '"',
    # Spark's own format would cut a timestamp to milliseconds.
    "timestampFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
}
# Text keeps its blanks. A null is an empty field and an empty text a quoted one.
CSV_WRITE = {
    **CSV_OPTIONS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "",
    "emptyValue": '""',
}
# The reader compares fields with its null mark after unquoting them, so the mark must be
# something that no field is; an empty field without quotes is null all the same.
CSV_READ = {
    **CSV_OPTIONS,
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "nullValue": "\x00\x00null",
    "emptyValue": "",
}
# Fixed pairs: what stands for a character that would end a line, and for the escape.
BREAKS = (("\n", r"\n"), ("\r", r"\r"))
ESCAPE = ("\\", r"\b")


def csv_sink(path: str, native: bool = True, escape_breaks: bool = False) -> Sink:
    """A folder of headerless CSV files, one line per row.

    Text comes back as it was, blanks, quotes and empty text included. A line break
    inside a text would need readers that cannot split files; such a row fails the
    write, or with ``escape_breaks`` is written as ``\\n``, ``\\r`` and, for the
    backslash itself, ``\\b``: read it with the same flag.
    """
    change = escaped if escape_breaks else refused
    return _folder("csv", path, CSV_WRITE, native, lambda frame: _on_text(frame, change))


def json_folder(path: str, native: bool = True) -> Sink:
    """A folder of JSON lines, nulls written out."""
    return _folder("json", path, {"ignoreNullFields": "false"}, native)


def parquet_sink(path: str, native: bool = True) -> Sink:
    """A folder of Parquet files."""
    return _folder("parquet", path, {}, native)


def escaped(text: Column) -> Column:
    """Text without line breaks."""
    for plain, mark in (ESCAPE, *BREAKS):
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    """The text that ``escaped`` was given."""
    for plain, mark in (*BREAKS, ESCAPE):
        text = F.replace(text, F.lit(mark), F.lit(plain))
    return text


def refused(text: Column) -> Column:
    """The text, or an error if it has a line break."""
    problem = F.raise_error("line break in a CSV text: write it with escape_breaks")
    return F.when(text.rlike("[\n\r]"), problem.cast("string")).otherwise(text)


def unescape_table(frame: DataFrame) -> DataFrame:
    """``unescaped`` for every text column."""
    return _on_text(frame, unescaped)


def _on_text(frame: DataFrame, change: Callable[[Column], Column]) -> DataFrame:
    return frame.select(
        *(
            change(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in frame.schema.fields
        )
    )


def _folder(
    kind: str,
    path: str,
    options: dict[str, str],
    native: bool,
    prepare: Callable[[DataFrame], DataFrame] = unchanged,
) -> Sink:
    return Sink(
        kind,
        {**options, "path": path},
        prepare=prepare,
        native=native,
        custom_write=_batch_folders(kind, path, options),
    )


def _batch_folders(kind: str, path: str, options: dict[str, str]) -> Write:
    """Each micro-batch replaces its own sub-folder, so a replay leaves no copies."""

    def write(frame: DataFrame, batch_id: int | None) -> None:
        writer = frame.write.format(kind).options(**options)
        if batch_id is None:
            writer.mode("append").save(path)
        else:
            writer.mode("overwrite").save(f"{path}/{BATCH_ID}={batch_id}")

    return write
