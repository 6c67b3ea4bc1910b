"""JSON records: text to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
# The text a record was read from, and why it was not accepted.
TEXT = "_text"
REASON = "_reason"
# The reasons.
NOT_JSON = "not json"
NO_TIME = "no event time"
LATE = "late"


def read_record(
    values: DataFrame,
    schema: str,
    column: str = "value",
    strict: bool = False,
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """Replace a JSON text column by the record's fields; keep the other columns.

    ``fields`` names those of the schema that are wanted; the parser skips the rest.
    A field that is absent or of the wrong type is null. ``strict=True`` fails
    the job on text which is not JSON, for callers that prefer to stop.
    """
    options = {"mode": "FAILFAST"} if strict else {}
    declared = T.StructType.fromDDL(schema)
    if fields is not None:
        declared = T.StructType([declared[name] for name in fields])
    return _unpack(values, column, F.from_json(column, declared, options))


def read_record_checked(
    values: DataFrame, schema: str, column: str = "value"
) -> DataFrame:
    """As ``read_record``, plus ``_corrupt``: the text where it is not JSON.

    Keeps every input row, so nothing is lost: send the rows whose ``_corrupt``
    is set to a dead-letter sink and go on with the rest.
    """
    options = {"columnNameOfCorruptRecord": CORRUPT}
    record = F.from_json(column, f"{schema}, {CORRUPT} STRING", options)
    return _unpack(values, column, record)


def tagged_records(
    values: DataFrame,
    schema: str,
    column: str = "value",
    fields: tuple[str, ...] | None = None,
) -> DataFrame:
    """As ``read_record``, plus ``_text`` and ``_reason``, from one parse per text.

    ``_reason`` is null for a record and says why a text is none; a null text is none.
    ``accepted`` and ``rejected`` are the two halves: keep the tagged frame (``persist``,
    or a table) where both are wanted, and no text is parsed twice.

    With ``fields`` a record is judged by those fields alone: the parser skips the rest.
    """
    declared = T.StructType.fromDDL(schema)
    if fields is not None:
        declared = T.StructType([declared[name] for name in fields])
    declared = T.StructType([*declared.fields, T.StructField(CORRUPT, T.StringType())])
    text = F.col(_quoted(column))
    record = F.from_json(text, declared, {"columnNameOfCorruptRecord": CORRUPT})
    unpacked = _unpack(values.withColumn(TEXT, text), column, record)
    bad = F.col(CORRUPT).isNotNull() | F.col(TEXT).isNull()
    return unpacked.withColumn(REASON, F.when(bad, F.lit(NOT_JSON))).drop(CORRUPT)


def accepted(tagged: DataFrame) -> DataFrame:
    """The records of a tagged frame, without the tags."""
    return tagged.where(F.col(REASON).isNull()).drop(TEXT, REASON)


def rejected(tagged: DataFrame) -> DataFrame:
    """(value, reason) of all that is not accepted."""
    return tagged.where(F.col(REASON).isNotNull()).select(
        F.col(TEXT).alias("value"), F.col(REASON).alias("reason")
    )


def json_text(frame: DataFrame) -> Column:
    """All columns of ``frame`` as one JSON text, nulls written out.

    Timestamps are spelled ``yyyy-MM-dd HH:mm:ss``, with a fraction only where it
    is not zero.
    """
    fields = [
        F.col(_quoted(f.name)).cast("string").alias(f.name)
        if isinstance(f.dataType, T.TimestampType | T.TimestampNTZType)
        else F.col(_quoted(f.name))
        for f in frame.schema.fields
    ]
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def conform(frame: DataFrame, target: dict[str, str]) -> DataFrame:
    """Columns of ``target`` only, in its order, cast to its types."""
    return frame.select(
        *(F.col(_quoted(name)).cast(kind).alias(name) for name, kind in target.items())
    )


def _unpack(values: DataFrame, column: str, record: Column) -> DataFrame:
    # A later filter on the fields stays above this generator. On a plain
    # projection it would be pushed below, and parse the text again per condition.
    rest = [F.col(_quoted(name)) for name in values.columns if name != column]
    return values.select(*rest, F.inline(F.array(record)))


def _quoted(name: str) -> str:
    return f"`{name}`"
