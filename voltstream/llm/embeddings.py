"""Near-duplicate embeddings by a forest of random-projection trees.

A tree splits by a random direction, at the best of some random places, and lets vectors
near the split fall to both sides, as far as similar vectors usually differ in one
direction. A dense cluster is not split: it would fall to both sides whole. Only
vectors that share a leaf in some tree are compared, exactly, and a pair counts in its
first common leaf alone, so links are counted without a table of pairs.

The trees begin on a bounded sample; every vector runs through them. A leaf that still
holds too many vectors of one label, as all do once a table is large enough, is split on,
by directions drawn from its number and places taken from its own vectors, level by level
and for all such leaves at once. What no direction splits is a dense cluster: its pairs
are links for the most part, and are compared in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import record_batch, settled
from voltstream.llm.components import components
from voltstream.llm.learning import Scores

THRESHOLD = 0.98
TREES = 5
# Vectors the trees are fitted on: so many, and no more than so many bytes.
SAMPLE_ROWS, SAMPLE_BYTES = 20_000, 64 << 20
LEAF = 256
# Share of the largest distance between similar vectors, in one of d directions.
SPILL = 0.5
DEPTH = 24
# Random directions and places tried per split, and how much a split may add by overlap.
DIRECTIONS, PLACES, GROWTH, LARGER = 3, 16, 1.3, 0.9
# The same for leaves that are split on: shares of the leaf's vectors at the places tried.
SHARES = (0.3, 0.4, 0.5, 0.6, 0.7)
# Vectors of one label that a leaf may hold, and a block of a dense one.
BLOCK = 512
_PARTS = 1 << 30
# What is compared together: vectors of a leaf with equal labels and sizes.
LEAF_KEY = ("leaf", "label", "size")


class Forest:
    """Random-projection trees over unit vectors of one dimension."""

    def __init__(self, sample: np.ndarray, leaf: int, threshold: float, trees: int = TREES, seed: int = 5):
        self.margin = SPILL * np.sqrt(max(2 - 2 * threshold, 0)) / np.sqrt(max(sample.shape[1], 1))
        self.leaves = 0
        self.leaf = max(leaf, 2)
        rng = np.random.default_rng(seed)
        self.roots = [self._grow(sample, rng, 0) for _ in range(trees)]

    def _grow(self, sample: np.ndarray, rng: np.random.Generator, depth: int):
        best = None
        if len(sample) > self.leaf and depth < DEPTH:
            for _ in range(DIRECTIONS):
                direction = rng.normal(size=sample.shape[1])
                direction /= np.linalg.norm(direction)
                along = np.sort(sample @ direction)
                places = rng.uniform(*np.quantile(along, [0.1, 0.9]), PLACES)
                left = np.searchsorted(along, places + self.margin)
                right = len(along) - np.searchsorted(along, places - self.margin)
                # Few on both sides, and neither side much the larger.
                cost = np.maximum(left, right) + 2 * (left + right - len(along))
                at = int(cost.argmin())
                if best is None or cost[at] < best[0]:
                    best = (cost[at], direction, places[at], max(left[at], right[at]), left[at] + right[at])
        if best and best[3] < LARGER * len(sample) and best[4] < GROWTH * len(sample):
            _, direction, split = best[:3]
            along = sample @ direction
            return (
                direction,
                split,
                self._grow(sample[along < split + self.margin], rng, depth + 1),
                self._grow(sample[along >= split - self.margin], rng, depth + 1),
            )
        self.leaves += 1
        return self.leaves - 1

    def route(self, vectors: np.ndarray) -> list[list[int]]:
        """The leaves of each vector, over all trees, in ascending order."""
        found: list[list[int]] = [[] for _ in vectors]
        waiting = [(root, np.arange(len(vectors))) for root in self.roots]
        while waiting:
            node, rows = waiting.pop()
            if not len(rows):
                continue
            if isinstance(node, int):
                for n in rows:
                    found[n].append(node)
                continue
            direction, split, left, right = node
            along = vectors[rows] @ direction
            waiting.append((left, rows[along < split + self.margin]))
            waiting.append((right, rows[along >= split - self.margin]))
        return [sorted(leaves) for leaves in found]


def near_duplicates(
    frame: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    trees: int = TREES,
) -> DataFrame:
    """key, n_links, component_id and kept of every vector.

    Vectors link if their labels are equal and not null, their sizes are equal and
    their cosine, in double precision, is at least ``threshold``. Vectors that are null,
    empty or zero, or hold null or non-finite components, link with nothing, nor do rows
    without a key, which have no component. Equal vectors are collapsed first, so any
    number of copies costs one comparison. Rows of one key are one node of the
    components, each with links of its own. An empty table gives an empty result; other
    columns are ignored. A pair is missed only if all trees separate it.
    """
    rows = settled(_checked(frame, key, vector, label), "vectors")
    classes = settled(
        rows.where("class IS NOT NULL")
        .groupBy("class")
        .agg(
            F.min("id").alias("rep"),
            F.count("*").alias("copies"),
            F.first("label").alias("label"),
            F.first("data").alias("data"),
        ),
        "classes",
    )
    leaves = split_on(_routed(classes, threshold, trees), threshold)
    found = settled(_links(_dealt(leaves), threshold), "links")
    linked = found.groupBy("class").agg(F.sum("links").alias("links"))
    counts = (
        classes.select("class", "rep", "copies")
        .join(linked, "class", "left")
        .select("class", "rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        .where("n_links > 0")
    )
    groups = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = settled(
        counts.join(groups, F.col("rep") == F.col("node"), "left").select(
            "class", "n_links", F.coalesce("component", "rep").alias("component_id")
        ),
        "known",
    )
    return (
        rows.select("id", "class")
        .join(known, "class", "left")
        .select(
            F.col("id").alias(key),
            F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col(key) == F.col("component_id"), F.lit(False)))
    )


def _checked(frame: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """id, label, the class of equal vectors (null if it may not link) and the components."""
    types = {"id": pa.int64(), "label": pa.string(), "class": pa.binary(), "data": pa.binary()}

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for id_, label_, values in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                class_ = data = None
                if id_ is not None and label_ is not None and values and None not in values:
                    numbers = np.array(values, np.float64) + 0.0
                    if np.isfinite(numbers).all() and numbers.any():
                        short = numbers.astype(np.float32)
                        data = (short if (short == numbers).all() else numbers).tobytes()
                        data = bytes([4 if len(data) == 4 * len(numbers) else 8]) + data
                        class_ = xxhash.xxh3_128_digest(label_.encode() + b"\0" + data)
                rows.append((id_, label_, class_, data))
            columns = zip(*rows) if rows else ((),) * len(types)
            yield record_batch(dict(zip(types, columns)), types)

    chosen = frame.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    return chosen.mapInArrow(check, "id BIGINT, label STRING, class BINARY, data BINARY")


def unit_vector(data: bytes) -> np.ndarray:
    """The components, in double precision and scaled to length 1."""
    numbers = np.frombuffer(data[1:], np.float32 if data[0] == 4 else np.float64).astype(np.float64)
    numbers = numbers / np.abs(numbers).max()
    return numbers / np.linalg.norm(numbers)


def _routed(classes: DataFrame, threshold: float, trees: int) -> DataFrame:
    """Every class once per leaf it falls into, with all its leaves."""
    spark = classes.sparkSession
    total, longest = classes.agg(F.count("*"), F.max(F.length("data"))).first()
    rows = min(SAMPLE_ROWS, SAMPLE_BYTES // (2 * (longest or 1)))
    share = F.pmod(F.xxhash64("class"), F.lit(_PARTS)) < int(_PARTS * min(1.0, rows / max(total, 1)))
    sample: dict[int, list[np.ndarray]] = {}
    for row in classes.where(share).orderBy("class").select("data").limit(2 * rows + 1).collect():
        unit = unit_vector(bytes(row["data"]))
        sample.setdefault(len(unit), []).append(unit)
    leaf = max(16, int(LEAF * min(1.0, rows / max(total, 1))))
    forests = {n: Forest(np.array(v), leaf, threshold, trees) for n, v in sample.items()}
    sent = spark.sparkContext.broadcast(forests)
    types = {"size": pa.int32(), "leaf": pa.int64(), "leaves": pa.list_(pa.int64())}
    own = {"class": pa.binary(), "rep": pa.int64(), "copies": pa.int64(), "label": pa.string(), "data": pa.binary()}

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = [unit_vector(d) for d in batch.column("data").to_pylist()]
            sizes = np.array([len(u) for u in units], np.int64)
            leaves: list[list[int]] = [[0]] * len(units)
            for size in np.unique(sizes):
                if size in sent.value:
                    at = np.flatnonzero(sizes == size)
                    for n, found in zip(at, sent.value[size].route(np.array([units[n] for n in at]))):
                        leaves[n] = found
            take = np.repeat(np.arange(len(units)), [len(x) for x in leaves])
            kept = {n: batch.column(n).take(pa.array(take)) for n in own}
            columns = kept | {
                "size": sizes[take],
                "leaf": [x for found in leaves for x in found],
                "leaves": [leaves[n] for n in take],
            }
            yield record_batch(columns, own | types)

    ddl = (
        "class BINARY, rep BIGINT, copies BIGINT, label STRING, data BINARY, "
        "size INT, leaf BIGINT, leaves ARRAY<BIGINT>"
    )
    return settled(classes.select(*own).mapInArrow(route, ddl), "leaves")


def split_on(routed: DataFrame, threshold: float) -> DataFrame:
    """Split every leaf of more than ``BLOCK`` vectors until it is small or dense.

    A level is a projection of the open leaves' vectors and three sums per leaf; no leaf
    is held by a task, and nothing but sums of its rows meets in one.
    """
    sizes = settled(routed.groupBy(*LEAF_KEY).agg(F.count("*").alias("n")), "leaf-sizes")
    large = sizes.where(F.col("n") > BLOCK)
    if large.isEmpty():
        return routed
    rows = routed.drop("leaves")
    done = [rows.join(large, list(LEAF_KEY), "left_anti")]
    waiting = settled(rows.join(large, list(LEAF_KEY), "left_semi"), "large-leaves")
    for _ in range(DEPTH):
        along = settled(_projected(waiting), "projected")
        splits = settled(_best_splits(along, threshold), "splits")
        done.append(waiting.join(splits, list(LEAF_KEY), "left_anti"))
        children = settled(_children(along.join(splits, list(LEAF_KEY)), threshold), "children")
        sizes = settled(children.groupBy(*LEAF_KEY).agg(F.count("*").alias("n")), "leaf-sizes")
        large = sizes.where(F.col("n") > BLOCK)
        done.append(children.join(large, list(LEAF_KEY), "left_anti"))
        if large.isEmpty():
            break
        waiting = settled(children.join(large, list(LEAF_KEY), "left_semi"), "large-leaves")
    else:
        done.append(waiting)
    found = settled(reduce(DataFrame.unionByName, done), "leaves")
    leaves = found.groupBy("class").agg(F.array_sort(F.collect_set("leaf")).alias("leaves"))
    return found.join(leaves, "class")


def directions_of(leaf: int, label: str, size: int) -> np.ndarray:
    """The directions that a leaf is split by, the same wherever they are drawn."""
    seed = xxhash.xxh3_64_intdigest(f"{leaf}|{size}|{label}")
    drawn = np.random.default_rng(seed).normal(size=(DIRECTIONS, size))
    return drawn / np.linalg.norm(drawn, axis=1, keepdims=True)


def _projected(waiting: DataFrame) -> DataFrame:
    """The vectors of open leaves with their places along the leaf's directions."""
    fields = [f.name for f in waiting.schema.fields]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn = Scores(lambda leaf: directions_of(*leaf), limit=1000)
        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in LEAF_KEY))
            data = batch.column("data").to_pylist()
            along = [drawn[key] @ unit_vector(d) for key, d in zip(keys, data)]
            columns = [batch.column(n) for n in fields]
            yield pa.record_batch([*columns, pa.array(along, pa.list_(pa.float64()))], names=[*fields, "along"])

    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in waiting.schema.fields)
    return waiting.mapInArrow(project, f"{ddl}, along ARRAY<DOUBLE>")


def _margin(threshold: float) -> Column:
    return F.lit(SPILL * float(np.sqrt(max(2 - 2 * threshold, 0)))) / F.sqrt("size")


def _best_splits(along: DataFrame, threshold: float) -> DataFrame:
    """(leaf, label, size, direction, place) of the leaves that some place splits well."""
    shares = F.array(*(F.lit(x) for x in SHARES))
    tried = along.groupBy(*LEAF_KEY).agg(
        F.count("*").alias("n"),
        *(F.percentile_approx(F.col("along")[d], shares, 1000).alias(f"places{d}") for d in range(DIRECTIONS)),
    )
    margin = _margin(threshold)
    sums, choices = [], []
    for d in range(DIRECTIONS):
        for k in range(len(SHARES)):
            place = F.col(f"places{d}")[k]
            left, right = f"left{d}_{k}", f"right{d}_{k}"
            sums.append(F.count_if(F.col("along")[d] < place + margin).alias(left))
            sums.append(F.count_if(F.col("along")[d] >= place - margin).alias(right))
            sums.append(F.first(place).alias(f"place{d}_{k}"))
            larger, both = F.greatest(left, right), F.col(left) + F.col(right)
            good = (larger < F.col("n") * LARGER) & (both < F.col("n") * GROWTH)
            cost = F.when(good, larger + 2 * (both - F.col("n")))
            choices.append(F.struct(cost.alias("cost"), F.lit(d).alias("direction"), F.col(f"place{d}_{k}").alias("place")))
    counted = along.join(tried, list(LEAF_KEY)).groupBy(*LEAF_KEY).agg(F.first("n").alias("n"), *sums)
    best = F.array_min(F.filter(F.array(*choices), lambda c: c["cost"].isNotNull()))
    return counted.select(*LEAF_KEY, best.alias("best")).where("best IS NOT NULL").select(*LEAF_KEY, "best.direction", "best.place")


def _children(split: DataFrame, threshold: float) -> DataFrame:
    """Every vector in the leaf of its side, or in both near the split."""
    here, margin = F.col("along")[F.col("direction")], _margin(threshold)
    sides = F.array_compact(
        F.array(F.when(here < F.col("place") + margin, F.lit(0)), F.when(here >= F.col("place") - margin, F.lit(1)))
    )
    # A new number that no other leaf has, and above those of the first trees.
    number = F.shiftrightunsigned(F.xxhash64("leaf", "side"), 1)
    return (
        split.withColumn("side", F.explode(sides))
        .withColumn("leaf", number)
        .drop("along", "direction", "place", "side")
    )


def _dealt(routed: DataFrame) -> DataFrame:
    """Leaves of too many vectors as pairs of blocks; each pair is a task."""
    group = LEAF_KEY
    sizes = routed.groupBy(*group).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    sized = routed.join(settled(sizes, "leaf-sizes"), list(group))
    own = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    return (
        sized.withColumn("block", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumns({"low": F.least("block", "other"), "high": F.greatest("block", "other")})
        .drop("other", "blocks")
    )


def _links(dealt: DataFrame, threshold: float) -> DataFrame:
    """Per class and task: how many vectors it links to, and a root of what it hangs on."""
    names = ("leaf", "label", "size", "low", "high")
    types = {"class": pa.binary(), "rep": pa.int64(), "links": pa.int64(), "root": pa.int64()}
    fields = (*names, "block", "class", "rep", "copies", "data", "leaves")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, rows = None, []
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in fields), strict=True):
                if row[:5] != task:
                    if len(rows) > 1:
                        yield record_batch(dict(zip(types, compare_leaf(task, rows, threshold))), types)
                    task, rows = row[:5], []
                rows.append(row[5:])
        if len(rows) > 1:
            yield record_batch(dict(zip(types, compare_leaf(task, rows, threshold))), types)

    spread = dealt.select(*fields).repartition(*names).sortWithinPartitions(*names)
    return spread.mapInArrow(compare, "class BINARY, rep BIGINT, links BIGINT, root BIGINT")


def compare_leaf(task: tuple, rows: list[tuple], threshold: float) -> tuple[list, ...]:
    """Compare (block, class, rep, copies, data, leaves) of one leaf or pair of blocks."""
    leaf, low, high = task[0], task[3], task[4]
    units = np.array([unit_vector(r[4]) for r in rows])
    block = np.array([r[0] for r in rows])
    copies, reps = np.array([r[2 + 1] for r in rows]), np.array([r[2] for r in rows])
    near = units @ units.T >= threshold
    near &= (block[:, None] != block[None, :]) if low != high else True
    one, two = np.nonzero(np.triu(near, 1))
    width = max(len(r[5]) for r in rows)
    leaves = np.array([r[5] + [-1] * (width - len(r[5])) for r in rows])
    first = np.zeros(len(one), bool)
    step = max(1, (8 << 20) // (width * width))
    for at in range(0, len(one), step):
        a, b = leaves[one[at : at + step]], leaves[two[at : at + step]]
        common = (a[:, :, None] == b[:, None, :]).any(axis=2) & (a >= 0)
        first[at : at + step] = np.where(common, a, np.iinfo(a.dtype).max).min(axis=1) == leaf
    one, two = one[first], two[first]
    links = np.bincount(one, copies[two], len(rows)) + np.bincount(two, copies[one], len(rows))
    root = np.arange(len(rows))
    while True:
        least = root.copy()
        np.minimum.at(least, one, root[two])
        np.minimum.at(least, two, root[one])
        least = least[least]
        if (least == root).all():
            break
        root = least
    linked = np.flatnonzero(links)
    return (
        [rows[n][1] for n in linked],
        reps[linked],
        links[linked].astype(np.int64),
        reps[root[linked]],
    )
