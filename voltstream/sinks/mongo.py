"""MongoDB collections. Needs the ``mongo-spark-connector`` package on the cluster."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.functions.records import conform, json_text
from voltstream.sinks.base import Sink
from voltstream.sinks.jdbc import RETRIES, ROW, numbered, one_per_key

ID = "_id"


def mongo_sink(
    uri: str,
    database: str,
    collection: str,
    target: dict[str, str],
    key: tuple[str, ...] = (),
    name: str = "",
) -> Sink:
    """One document per row of the target schema, replaced by its id.

    With ``key`` the id is made of those columns, so a collection has one document per
    key, the last. Without, it is made of the ``name`` of the stream, the batch, the row and its
    number among equal rows: a batch that is tried again or replayed gives the same
    documents. Streams that write to one collection need names of their own. A frame
    written outside of a stream has no batch number; there the connector makes the ids.
    """
    options = {
        "connection.uri": uri,
        "database": database,
        "collection": collection,
        "operationType": "replace",
        "idFieldList": ID,
        "upsertDocument": "true",
    }

    def put(frame: DataFrame, batch_id: int | None) -> None:
        columns = [F.col(f"`{c}`") for c in frame.columns]
        if key:
            rows = one_per_key(frame, key)
            documents = rows.select(document_id(rows, key).alias(ID), *columns)
        elif batch_id is not None:
            rows = numbered(frame)
            parts = (F.lit(name), F.lit(batch_id), F.sha2(json_text(frame), 256), F.col(ROW))
            documents = rows.select(F.concat_ws(":", *parts).alias(ID), *columns)
        else:
            documents = frame
        documents.write.format("mongodb").options(**options).mode("append").save()

    return Sink(
        "mongodb",
        options,
        prepare=lambda frame: conform(frame, target),
        native=False,
        retries=RETRIES,
        custom_write=put,
    )


def document_id(frame: DataFrame, key: tuple[str, ...]) -> Column:
    """The key columns as one text, in JSON, so that different keys never agree."""
    return json_text(frame.select(*(F.col(f"`{c}`") for c in key)))


def mongo_uri(host: str) -> str:
    """Connection text with the login from the environment."""
    user = os.environ["MONGO_INITDB_ROOT_USERNAME"]
    password = os.environ["MONGO_INITDB_ROOT_PASSWORD"]
    return f"mongodb://{user}:{password}@{host}"
