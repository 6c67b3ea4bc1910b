"""Shards of near-equal bytes from indivisible groups, by Karmarkar-Karp differencing.

A partial partition is a vector of shard sizes, at first one group beside empty shards.
The two with the largest spread are combined, the largest shard of one with the smallest
of the other, until one partition is left; what they differ by shrinks at every step.

The groups of a corpus do not fit in one task. So smaller groups are first bundled: a few
thousand of them at a time are differenced into parcels of near-equal size, in parallel,
and again the parcels, until few enough items are left for one last differencing. A
group of more than an item's share of all bytes is never bundled, so however uneven the
groups are, the last step can balance them against the parcels.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltstream.llm.common import settled, text_or_empty

SHARDS = 40
# Bytes that a document costs beside its text.
OVERHEAD = 16
# The last differencing runs in the driver over at most twice so many items; larger
# tables are bundled until that holds.
ITEMS = 20_000
# Items that are bundled together, on average.
BUNDLE = 2_000
# Rows of a shard numbered in one task.
BLOCK_BITS = 16
LAW = "bytes"


def difference(sizes: np.ndarray, ways: int) -> np.ndarray:
    """The part, 0 to ``ways`` - 1, of every size, by largest differencing first.

    Ties go by the order of the sizes. Parts are numbered by falling size.
    """
    count = len(sizes)
    if not count:
        return np.zeros(0, np.int64)
    sums: dict[int, np.ndarray] = {}
    heap: list[tuple[int, int]] = []
    for node, size in enumerate(sizes.tolist()):
        heap.append((-size if ways > 1 else 0, node))
    heapq.heapify(heap)
    joined: list[tuple[int, int, np.ndarray, np.ndarray]] = []

    def vector(node: int) -> np.ndarray:
        if node >= count:
            return sums.pop(node)
        own = np.zeros(ways, np.int64)
        own[0] = sizes[node]
        return own

    # Vectors are kept in falling order; a place of the new one takes the place of the
    # same rank in one and of the opposite rank in the other.
    for node in range(count, 2 * count - 1):
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = vector(a) + vector(b)[::-1]
        order = np.argsort(-both, kind="stable")
        both = both[order]
        sums[node] = both - both[-1]
        joined.append((a, b, order, ways - 1 - order))
        heapq.heappush(heap, (int(both[-1] - both[0]), node))
    parts = np.zeros(count, np.int64)
    places = {2 * count - 2: np.arange(ways)}
    for node in range(2 * count - 2, count - 1, -1):
        a, b, left, right = joined[node - count]
        place = places.pop(node)
        for child, own in ((a, left), (b, right)):
            # The part of the child's place own[i] is that of this node's place i.
            at = np.empty(ways, np.int64)
            at[own] = place
            if child >= count:
                places[child] = at
            else:
                parts[child] = at[0]
    if count == 1:
        parts[0] = 0
    return parts


def bundle(items: DataFrame, share: int, level: int, size: int = BUNDLE, total_items: int = 0) -> DataFrame:
    """(id, size, parcel): items below a share of the bytes differenced into parcels.

    Parcels are of about the share; items of more stay alone, with a null parcel.
    """
    buckets = max(1, total_items // size)

    def parcels(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["size", "id"], ascending=[False, True], ignore_index=True)
        sizes = frame["size"].to_numpy(np.int64)
        ways = min(len(sizes), -(-int(sizes.sum()) // share))
        parts = difference(sizes, max(1, ways))
        name = f"{level}-{frame['bucket'].iloc[0]}-"
        return pd.DataFrame({"id": frame["id"], "size": sizes, "parcel": [f"{name}{p}" for p in parts]})

    bucket = F.pmod(F.xxhash64("id", F.lit(level)), F.lit(buckets))
    small = items.where(F.col("size") < share).withColumn("bucket", bucket)
    alone = items.where(F.col("size") >= share).withColumn("parcel", F.lit(None).cast("string"))
    made = small.groupBy("bucket").applyInPandas(parcels, "id STRING, size BIGINT, parcel STRING")
    return made.unionByName(alone)


def assign_groups(
    groups: DataFrame, shards: int = SHARDS, items: int = ITEMS, size: int = BUNDLE
) -> DataFrame:
    """(id, shard) of groups given as (id, size), ids being distinct texts.

    What reaches the driver is the last level, at most 2 * ``items`` rows of an id and a
    size, and what goes back is their shards.
    """
    spark = groups.sparkSession
    level_items = settled(groups.select("id", "size"), "groups")
    found = level_items.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first()
    share = max(1, -(-(found.bytes or 0) // items))
    levels: list[DataFrame] = []
    count = found.n
    while count > 2 * items:
        bundled = settled(bundle(level_items, share, len(levels), size, count), "bundled")
        levels.append(bundled)
        parcels = bundled.groupBy(F.coalesce("parcel", "id").alias("id")).agg(F.sum("size").alias("size"))
        level_items = settled(parcels, "parcels")
        count = level_items.count()
    last = level_items.orderBy(F.col("size").desc(), "id").toPandas()
    shard = difference(last["size"].to_numpy(np.int64), shards)
    placed = _placed(spark, last["id"], shard)
    for bundled in reversed(levels):
        inside = bundled.withColumn("parcel", F.coalesce("parcel", "id"))
        placed = inside.join(placed.withColumnRenamed("id", "parcel"), "parcel").select("id", "shard")
    return placed


def _placed(spark: SparkSession, ids: pd.Series, shard: np.ndarray) -> DataFrame:
    frame = pd.DataFrame({"id": ids.astype(object), "shard": shard.astype(np.int32)})
    return spark.createDataFrame(frame, "id STRING, shard INT")


def text_group(text: Column) -> Column:
    """The group of a text: equal texts, null being empty, have one."""
    return F.sha2(F.encode(text_or_empty(text), "UTF-8"), 256)


def document_size(text: Column) -> Column:
    """Bytes that a document takes in its shard."""
    return F.octet_length(text_or_empty(text)).cast("bigint") + F.lit(OVERHEAD)


def shard_documents(
    documents: DataFrame,
    shards: int = SHARDS,
    key: str = "doc_id",
    text: str = "text",
    items: int = ITEMS,
    size: int = BUNDLE,
) -> DataFrame:
    """The documents with ``shard`` and ``slot``, their number in it, gapless from 0.

    All columns stay; ones named like the two added are replaced. Equal texts are one
    group and stand in one shard, so a text with more than a shard's share of all bytes
    makes its shard that much larger; the others are equal. Null text is empty. Null
    and repeated ids and repeated rows are rows like any other. An empty table gives an
    empty one.

    Texts are shuffled once, to their groups' shards, and written; a group of any number
    of rows may be split on the way, since only its text's digest looks up the shard.
    Where the caller needs no texts, none are moved again to number the rows.
    """
    kept = [c for c in documents.columns if c not in ("shard", "slot")]
    content = F.col(f"`{text}`")
    sizes = documents.select(text_group(content).alias("id"), document_size(content).alias("size"))
    assigned = settled(
        assign_groups(sizes.groupBy("id").agg(F.sum("size").alias("size")), shards, items, size), "assigned"
    )
    own = [F.col(f"`{c}`").alias(f"keep{n}") for n, c in enumerate(kept)]
    placed = documents.select(*own, text_group(content).alias("id")).join(assigned, "id").drop("id")
    # Rows are numbered in blocks of the table as written, so that a shard's numbers
    # need no task that sees all of it.
    place = F.monotonically_increasing_id()
    block = F.shiftright(place, BLOCK_BITS)
    written = settled(placed.select("*", place.alias("place"), block.alias("block")), "sharded")
    counts = written.groupBy("shard", "block").agg(F.count("*").alias("rows"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "block", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("start"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("place")) - 1
    return (
        written.withColumn("within", within)
        .join(starts, ["shard", "block"])
        .select(
            *(F.col(f"keep{n}").alias(c) for n, c in enumerate(kept)),
            "shard",
            (F.col("start") + F.col("within")).alias("slot"),
        )
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """A folder ``shard=N`` per shard, in files of one task's rows by ascending slot."""
    part = F.shiftright("slot", BLOCK_BITS)
    dealt = sharded.repartition("shard", part).sortWithinPartitions("shard", "slot")
    dealt.write.partitionBy("shard").parquet(path)
