"""Packing token sequences by minimum bin slack.

A bin is filled with the combination of available lengths that leaves the least
slack, found by subset sums over a bitset, and that combination is removed. What
counts is only how many pieces of each length there are: the plan is made on that
histogram, of at most ``capacity`` entries however many documents there are, and one
combination serves as many bins as the counts allow. The pieces then look up their
places in the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voltstream.llm.common import identified, record_batch, settled
from voltstream.llm.tokens import encoder

CAPACITY = 2048
END = 0
PIECES = "id BIGINT, piece INT, start BIGINT, length BIGINT, ids_crc32 BIGINT"
# Pieces of one length are numbered in groups of about this size, 64 groups at least.
GROUP_ROWS = 100_000
GROUPS = 64


def fullest(counts: Mapping[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination: the longest piece, and lengths that fill what is left.

    Subset sums as the bits of one integer. A length that occurs n times goes in as
    1, 2, 4, ... copies, so that every multiple up to n can be reached.
    """
    longest = max(counts)
    room = capacity - longest
    sums, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in sorted(counts, reverse=True):
        copies, taken = counts[length] - (length == longest), 1
        while copies > 0 and length <= room:
            take = min(taken, copies)
            wider = (sums | sums << take * length) & mask
            if wider != sums:
                steps.append((sums, length, take))
                sums = wider
            copies, taken = copies - take, taken * 2
            if take * length > room:
                break
        if sums >> room & 1:
            break
    chosen, total = {longest: 1}, sums.bit_length() - 1
    for before, length, take in reversed(steps):
        if not before >> total & 1:
            chosen[length] = chosen.get(length, 0) + take
            total -= take * length
    return chosen


def plan_bins(counts: Mapping[int, int], capacity: int = CAPACITY) -> list[tuple[dict[int, int], int]]:
    """(combination, number of bins) until every piece has its bin."""
    left, bins = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[length] // copies for length, copies in chosen.items())
        bins.append((chosen, times))
        for length, copies in chosen.items():
            left[length] -= copies * times
            if not left[length]:
                del left[length]
    return bins


def cut_pieces(
    frame: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Encode every whole text, add the end id, and cut what is longer than a bin.

    Gives id, piece, start, length and ids_crc32 per piece. All pieces of a long text
    hold ``capacity`` ids, the first one what remains.
    """
    types = {
        "id": pa.int64(),
        "piece": pa.int32(),
        "start": pa.int64(),
        "length": pa.int64(),
        "ids_crc32": pa.int64(),
    }

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoder(path)
        for batch in batches:
            rows = []
            for key_, text_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.append(tokenizer.ids(text_), np.uint32(END)).astype("<u4")
                first = len(ids) % capacity or capacity
                edges = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (low, high) in enumerate(zip(edges, edges[1:])):
                    rows.append((key_, piece, low, high - low, zlib.crc32(ids[low:high].tobytes())))
            columns = zip(*rows) if rows else ((),) * len(types)
            yield record_batch(dict(zip(types, columns)), types)

    return identified(frame, key, text).mapInArrow(cut, PIECES)


def pack(
    frame: DataFrame,
    path: str,
    capacity: int = CAPACITY,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Every piece of every text with its place: sequence_id and offset.

    Null text is the empty text, one end id. A null key and repeated rows are packed
    like any others; an empty table gives no pieces; other columns are ignored. The
    histogram (at most ``capacity`` rows) is all that reaches the driver, the plan
    (as bounded) all that is sent out. Texts are read once and never shuffled.
    """
    pieces = settled(cut_pieces(frame, path, capacity, key, text), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan_bins(counts, capacity))
    groups = max(GROUPS, max(counts.values(), default=0) // GROUP_ROWS)
    schema = f"{PIECES}, sequence_id BIGINT, offset BIGINT"

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                first, base, copies, begin = slots[length]
                at = np.searchsorted(first, ranks[rows], "right") - 1
                within = ranks[rows] - first[at]
                sequence[rows] = base[at] + within // copies[at]
                offset[rows] = begin[at] + within % copies[at] * length
            kept = [batch.column(n) for n in ("id", "piece", "start", "length", "ids_crc32")]
            yield pa.record_batch(
                [*kept, pa.array(sequence), pa.array(offset)],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    packed = _ranked(pieces, groups).mapInArrow(place, schema)
    return packed.withColumnRenamed("id", key)


def _ranked(pieces: DataFrame, groups: int) -> DataFrame:
    """Number the pieces of each length from 0.

    A length may have a third of all pieces, so it is dealt to ``groups`` groups; a
    piece's number is its number in its group after the sizes of the groups before.
    """
    dealt = pieces.withColumn(
        "part", F.pmod(F.xxhash64("id", "piece", "start", "ids_crc32"), F.lit(groups))
    )
    order = Window.partitionBy("length", "part").orderBy("id", "piece", "start", "ids_crc32")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("length", "part").count()
    starts = sizes.select(
        "length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    numbered = dealt.withColumn("number", F.row_number().over(order) - 1)
    return numbered.join(starts, ["length", "part"]).select(
        "id", "piece", "start", "length", "ids_crc32",
        (F.col("before") + F.col("number")).alias("rank"),
    )


def _slots(bins: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank, first sequence, copies and offset of each combination."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    base = 0
    for chosen, times in bins:
        begin = 0
        for length, copies in chosen.items():
            rows.setdefault(length, []).append((used.get(length, 0), base, copies, begin))
            used[length] = used.get(length, 0) + copies * times
            begin += copies * length
        base += times
    return {n: tuple(np.array(c, np.int64) for c in zip(*r)) for n, r in rows.items()}
