"""Web captures as WARC archives, and their globally ordered index.

Archives are written by Spark's text writer: a record is one text, and the record
separator ``CRLF CRLF`` is the line separator, so any file system Spark knows will do
and a failed task leaves nothing behind. Every archive is read back as one run of
index entries, sorted by URL key and time. Runs are then merged: the key space is cut
into ranges, and within each a loser tree merges the slices of all runs. Archives are
bounded by bytes and by records, ranges by rows, whatever the table's size.
"""

from __future__ import annotations

import gzip
import hashlib
from collections.abc import Iterable, Iterator
from datetime import datetime
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import record_batch, settled, text_or_empty
from voltstream.streaming.workdir import fresh_dir

# The record format.
VERSION = "WARC/1.1"
BREAK = "\r\n"
END = BREAK + BREAK

# Payloads below this size are always stored.
LEAST_BYTES = 100
# An archive is read back whole, one at a time: it ends with the record that passes either.
RECORDS_PER_FILE = 1000
BYTES_PER_FILE = 32 << 20
# Index entries that a task merges, on average.
RANGE_ROWS = 100_000
# Pages have no time of their own, so their ids stand for it, within a span of seconds.
FIRST_CAPTURE = 1_700_000_000
CAPTURE_SPAN = 1 << 28

INDEX = {
    "urlkey": pa.string(),
    "captured_at": pa.string(),
    "captured": pa.int64(),
    "page_id": pa.int64(),
    "url": pa.string(),
    "record_type": pa.string(),
    "payload_bytes": pa.int64(),
    "payload_digest": pa.string(),
    "refers_to": pa.int64(),
    "archive": pa.string(),
    "offset": pa.int64(),
    "length": pa.int64(),
}
INDEX_DDL = (
    "urlkey STRING, captured_at STRING, captured BIGINT, page_id BIGINT, url STRING, record_type STRING, "
    "payload_bytes BIGINT, payload_digest STRING, refers_to BIGINT, archive STRING, "
    "offset BIGINT, length BIGINT"
)
ORDER = ("urlkey", "captured", "page_id")


def capture_decisions(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """Add payload, its size and digest, and ``first``: the page whose payload it repeats.

    Of equal payloads of at least ``LEAST_BYTES`` the smallest page id is stored. Only
    digests that occur more than once are joined back, so the pages themselves are
    shuffled only if those are too many to send out.
    """
    payload = pages.select(
        F.col(f"`{key}`").cast("bigint").alias("page_id"),
        F.col("`url`").cast("string").alias("url"),
        text_or_empty(F.col(f"`{html}`")).alias("payload"),
    ).withColumns(
        {"payload_bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha2(F.encode("payload", "UTF-8"), 256)}
    )
    large = payload.where(F.col("payload_bytes") >= LEAST_BYTES)
    groups = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    repeated = settled(groups.where("copies > 1").drop("copies"), "repeated-payloads")
    return payload.join(repeated, "digest", "left").withColumn(
        "first", F.when(F.col("page_id") != F.col("first"), F.col("first"))
    )


def write_archives(pages: DataFrame, path: str) -> None:
    """Write one record per page: a response, or a revisit of an equal payload.

    Null html is the empty payload. A null page id is written as an empty field, and
    such a page is never a revisit; a null URL leaves the target out. Pages of one id
    and payload are all responses. Without pages there is no archive.

    The capture time is ``FIRST_CAPTURE`` and the id modulo ``CAPTURE_SPAN`` in seconds,
    so that ids of the whole BIGINT range give dates of four-digit years.
    """
    decided = capture_decisions(pages)
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{BREAK}Content-Type: text/html; charset=utf-8{BREAK}Content-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit(END),
    )
    block = F.concat(http, body)
    second = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(CAPTURE_SPAN))
    captured = F.timestamp_seconds(F.lit(FIRST_CAPTURE) + second)
    fields = F.concat(
        F.lit(f"{VERSION}{BREAK}WARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        _field("WARC-Record-ID", _record_id("page_id")),
        _field("WARC-Date", F.date_format(captured, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20]", "%20")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Refers-To", F.when(revisit, _record_id("first"))),
        _field("Page", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        _field("Refers-To-Page", F.col("first").cast("string")),
        _field("Content-Type", F.lit("application/http;msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit(END),
    )
    records_ = decided.select(F.concat(fields, block).alias("value"))
    (
        records_.mapInArrow(_dealt, "value STRING, part INT")
        .write.option("lineSep", END)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .partitionBy("part")
        .text(path)
    )


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of a task with the number of their archive, by the bytes before them."""
    before = 0
    for batch in batches:
        value = batch.column("value")
        sizes = pc.binary_length(value).to_numpy(zero_copy_only=False).astype(np.int64)
        ends = before + np.cumsum(sizes)
        part = ((ends - sizes) // BYTES_PER_FILE).astype(np.int32)
        before = int(ends[-1]) if len(ends) else before
        yield pa.record_batch([value, pa.array(part)], names=["value", "part"])


def read_runs(spark, path: str) -> DataFrame:
    """Read every archive back as a sorted run of index entries.

    Digests of stored payloads are computed anew and must agree with the record.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rows = sorted(records(gzip.decompress(content), name), key=_order)
                columns = zip(*rows) if rows else ((),) * len(INDEX)
                yield record_batch(dict(zip(INDEX, columns)), INDEX)

    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz")
    archives = reader.option("recursiveFileLookup", "true").load(path)
    return archives.select("path", "content").mapInArrow(parse, INDEX_DDL)


def merge_runs(runs: DataFrame) -> DataFrame:
    """All index entries in one order: by URL key, time and page.

    Partitions are ascending ranges of about ``RANGE_ROWS`` entries. A range holds whole
    keys only where they fit: the time is part of the range, so the captures of one
    URL may spread over several tasks. Entries alike in all three are in one.
    """
    partitions = int(runs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(partitions, -(-runs.count() // RANGE_ROWS))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = list(batches)
        if not tables:
            return
        whole = pa.Table.from_batches(tables)
        slices: dict[str, list[tuple]] = {}
        for row in zip(*(whole.column(n).to_pylist() for n in INDEX), strict=True):
            slices.setdefault(row[_ARCHIVE], []).append(row)
        merged = list(loser_tree(slices.values(), _order))
        yield record_batch(dict(zip(INDEX, zip(*merged))), INDEX)

    ranged = runs.repartitionByRange(ranges, *ORDER).sortWithinPartitions("archive", *ORDER)
    return ranged.mapInArrow(merge, INDEX_DDL)


def capture_index(pages: DataFrame) -> DataFrame:
    """Write the pages as archives, read them back, and merge their indexes.

    One row per page, ordered by URL key, capture time and page id; an empty table
    gives an empty index. Other columns of the pages are ignored.
    """
    spark = pages.sparkSession
    path = fresh_dir(spark, "archives")
    write_archives(pages, path)
    return merge_runs(settled(read_runs(spark, path), "runs"))


def records(data: bytes, archive: str) -> Iterator[tuple]:
    """The index entries of one archive, in its order."""
    at = 0
    while at < len(data):
        head_end = data.index(END.encode(), at)
        lines = data[at:head_end].decode().split(BREAK)
        fields = dict(line.split(": ", 1) for line in lines[1:])
        block = head_end + len(END)
        after = block + int(fields["Content-Length"])
        http_end = data.index(END.encode(), block) + len(END)
        http = dict(x.split(": ", 1) for x in data[block : http_end - len(END)].decode().split(BREAK)[1:])
        payload, digest = data[http_end:after], fields["WARC-Payload-Digest"].removeprefix("sha256:")
        kind = fields["WARC-Type"]
        if kind == "response" and hashlib.sha256(payload).hexdigest() != digest:
            raise ValueError(f"{archive}: damaged payload at {at}")
        url = fields.get("WARC-Target-URI")
        yield (
            url_key(url),
            fields["WARC-Date"],
            int(datetime.fromisoformat(fields["WARC-Date"]).timestamp()),
            int(fields["Page"]) if fields["Page"] else None,
            url,
            kind,
            int(http["Content-Length"]),
            digest,
            int(fields["Refers-To-Page"]) if "Refers-To-Page" in fields else None,
            archive,
            at,
            after - at,
        )
        at = after + len(END)


def url_key(url: str | None) -> str:
    """Host labels from the right, then path and query; no scheme, "www." or fragment."""
    try:
        parts = urlsplit((url or "").strip().lower())
        host, port = parts.hostname or "", f":{parts.port}" if parts.port else ""
    except ValueError:
        return (url or "").lower()
    labels = host.removeprefix("www.").split(".")
    query = f"?{parts.query}" if parts.query else ""
    return f"{','.join(reversed(labels))}{port}){parts.path or '/'}{query}"


def loser_tree(runs: Iterable[Iterable], key) -> Iterator:
    """Merge sorted runs. Inner nodes keep the loser of each match, so a new head
    plays one match per level."""
    sources = [iter(run) for run in runs]
    count = len(sources)
    if not count:
        return
    heads = [next(s, None) for s in sources]
    keys = [None if h is None else (key(h), n) for n, h in enumerate(heads)]

    def beats(a: int, b: int) -> bool:
        return keys[b] is None or (keys[a] is not None and keys[a] < keys[b])

    losers = [-1] * count
    winner = -1
    for player in range(count):
        at, winner = (player + count) // 2, player
        while at > 0:
            if losers[at] < 0:
                losers[at], winner = winner, -1
                break
            if beats(losers[at], winner):
                losers[at], winner = winner, losers[at]
            at //= 2
        if winner >= 0:
            losers[0] = winner
    winner = losers[0]
    while keys[winner] is not None:
        yield heads[winner]
        heads[winner] = next(sources[winner], None)
        keys[winner] = None if heads[winner] is None else (key(heads[winner]), winner)
        at = (winner + count) // 2
        while at > 0:
            if beats(losers[at], winner):
                losers[at], winner = winner, losers[at]
            at //= 2


_ARCHIVE = list(INDEX).index("archive")
_PAGE = list(INDEX).index("page_id")


def _order(row: tuple) -> tuple:
    # Null ids come first, as Spark has them.
    page = row[_PAGE]
    return row[0], row[_PAGE - 1], page is not None, page or 0, row[_ARCHIVE], row[_ARCHIVE + 1]


def _field(name: str, value: Column) -> Column:
    """A header line before this one's break, or nothing for null."""
    return F.coalesce(F.concat(F.lit(f"{BREAK}{name}: "), value), F.lit(""))


def _record_id(column: str) -> Column:
    digest = F.md5(F.concat(F.lit("page:"), F.coalesce(F.col(column).cast("string"), F.lit(""))))
    parts = (F.substring(digest, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))
