"""Jobs on plant messages: alerts and raw ingest.

Each takes a ``value`` text frame, from a topic or anything else. Text that is not a
message goes to ``rejects``, a sink of (value, reason) rows; without one it fails the job,
so none vanishes. A text is parsed once, whatever becomes of it. Previews are printed on the driver beside the sink that takes all rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from voltstream.functions.records import accepted, read_record, rejected, tagged_records
from voltstream.operators.messages import (
    alert_messages,
    alert_rows,
    message_fields,
    raw_rows,
)
from voltstream.schemas import PLANT_MESSAGE, RAW_MESSAGE
from voltstream.sinks.base import Sink, fan_out
from voltstream.sinks.console import preview_sink
from voltstream.sinks.jdbc import FLUSH_EVERY
from voltstream.streaming.run import start


def alerts_to_console(
    values: DataFrame,
    console: Sink,
    checkpoint: str,
    name: str = "alerts-console",
    rejects: Sink | None = None,
    **run,
) -> StreamingQuery:
    """Give all alert messages to a sink that prints or keeps every one of them."""
    sink = _messages(_alert_messages, fan_out(console, preview_sink()), rejects, PLANT_MESSAGE)
    return start(values, sink, checkpoint, name, **run)


def alerts_to_topic(
    values: DataFrame,
    topic: Sink,
    checkpoint: str,
    name: str = "alerts-topic",
    rejects: Sink | None = None,
    **run,
) -> StreamingQuery:
    """Send the alert messages to a text sink."""
    sink = _messages(_alert_messages, fan_out(topic, preview_sink()), rejects, PLANT_MESSAGE)
    return start(values, sink, checkpoint, name, **run)


def alerts_to_table(
    values: DataFrame,
    table: Sink,
    checkpoint: str,
    name: str = "alerts-table",
    rejects: Sink | None = None,
    **run,
) -> StreamingQuery:
    """Insert the alerts as typed rows."""
    run.setdefault("every", FLUSH_EVERY)
    sink = _messages(_alert_rows, fan_out(table, preview_sink()), rejects, PLANT_MESSAGE)
    return start(values, sink, checkpoint, name, **run)


def raw_to_table(
    values: DataFrame,
    table: Sink,
    checkpoint: str,
    name: str = "raw-table",
    rejects: Sink | None = None,
    **run,
) -> StreamingQuery:
    """Insert every message in its raw normal form."""
    run.setdefault("every", FLUSH_EVERY)
    sink = _messages(raw_rows, fan_out(table, preview_sink()), rejects, RAW_MESSAGE)
    return start(values, sink, checkpoint, name, **run)


def _alert_messages(records: DataFrame) -> DataFrame:
    return alert_messages(message_fields(records))


def _alert_rows(records: DataFrame) -> DataFrame:
    return alert_rows(message_fields(records))


def _messages(
    transform: Callable[[DataFrame], DataFrame], sink: Sink, rejects: Sink | None, schema: str
) -> Sink:
    """A sink of message texts: what they give to ``sink``, what is no message to ``rejects``."""
    if rejects is None:
        return sink.fed(lambda values: transform(read_record(values, schema, strict=True)))
    both = fan_out(sink.fed(lambda tagged: transform(accepted(tagged))), rejects.fed(rejected))
    return both.fed(lambda values: tagged_records(values, schema))
