"""N-gram Jaccard join with signature trees.

Documents are sets of hashed word shingles. The join runs in steps:

1. Equal sets are collapsed; one document stands for each.
2. Candidates meet by prefix: two sets that overlap enough share an element among the
   first ``n - ceil(t n) + 1`` of each, in any common order. The order here puts a
   quarter of all elements first, the rarest of them foremost, so a passage that many
   documents share brings no two of them together unless they hold little else.
3. Connected candidates form clusters. One of more than a few documents, which mostly hang
   together by a few common elements each, is taken apart by prefixes of all its elements,
   in the order of their counts within the cluster. In what is still large every document
   is first held against a few pivots; what hangs together then is one class. Clusters are
   dealt to tasks in blocks, and pairs of blocks within a class are left out.
4. A task builds a signature tree over its documents: nodes hold the OR of their
   documents' token bitmaps and the range of their sizes. A dual traversal, which compares
   the children of several node pairs at a time, drops pairs whose largest possible overlap
   is too small, and documents already connected, and verifies the others on the exact sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import discard, identified, record_batch, settled
from voltstream.llm.components import components
from voltstream.llm.learning import Scores

WORDS = 4
PERCENT = 85
# One shingle in so many comes first in the order of prefixes.
SAMPLED = 4
# Clusters of more documents are taken apart by all elements.
FEW = 8
# Documents per block of a cluster, and pivots of a cluster that has several blocks.
BLOCK = 512
PIVOTS = 16
PIVOT_ROUNDS = 3
# The signature tree.
BITS = 4096
FANOUT = 8
# Pairs of nodes whose children are compared at once.
PAIRS = 8

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_MIX = np.uint64(0x9E3779B97F4A7C15)


class Shingler:
    """Distinct shingles of a text as sorted 64-bit hashes."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.hashed = Scores(xxhash.xxh3_64_intdigest)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "replace").translate(_LOWER).split()
        if not words:
            return np.zeros(0, np.uint64)
        codes = np.array([self.hashed[w] for w in words], np.uint64)
        width = min(self.words, len(codes))
        value = np.full(len(codes) - width + 1, width, np.uint64)
        for n in range(width):
            value = (value ^ codes[n : n + len(value)]) * _MIX
            value ^= value >> np.uint64(29)
        return np.unique(value)


def required(size: int, other: int, percent: int = PERCENT) -> int:
    """The least intersection at which sets of these sizes are linked."""
    return -(-percent * (size + other) // (100 + percent))


def jaccard_join(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """key, n_shingles and component_id of every document, over links of ``percent`` or more.

    Exact: no link between different sets is lost, up to collisions of 64-bit hashes. What
    is verified are links that span each component; pairs already connected are passed
    over, so the number of all links of a document is not known.
    Null or blank text has no shingles and no links, a text of fewer words is one
    shingle. Rows of one key are one document with the links of all its texts. A row
    without a key is linked with nothing and has no component. An empty table gives
    an empty result; other columns are ignored.
    """
    sets = settled(_sets(frame, key, text, words, percent), "sets")
    usable = sets.where(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    first = usable.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    repeated = settled(first.where("copies > 1").drop("copies"), "repeated-sets")
    copies = settled(
        usable.select("id", "digest").join(repeated, "digest").where("id > first").select("id", "digest", "first").distinct(),
        "copies",
    )
    # This side and others marked so grow with the documents, and are never sent out.
    known = copies.select("id", "digest").hint("merge")
    single = settled(usable.join(known, ["id", "digest"], "left_anti"), "distinct-sets")
    sizes = settled(sets.select("id", "n_shingles"), "sizes")
    discard(sets, repeated)
    prefixes = settled(_prefixes(single), "prefixes")
    discard(single)
    clusters = settled(components(_prefix_links(prefixes, "h")), "clusters")
    discard(prefixes)
    links = _verified(identified(frame, key, text), clusters, sizes, words, percent)
    linked = copies.select(F.col("id").alias("a"), F.col("first").alias("b")).unionByName(links)
    found = settled(components(linked), "components")
    return sizes.join(found.hint("merge"), F.col("id") == F.col("node"), "left").select(
        F.col("id").alias(key),
        "n_shingles",
        F.coalesce("component", "id").alias("component_id"),
    )


def _sets(frame: DataFrame, key: str, text: str, words: int, percent: int) -> DataFrame:
    """Per document: size and digest of its set, and the elements its prefix may need."""
    types = {
        "id": pa.int64(),
        "n_shingles": pa.int64(),
        "digest": pa.binary(),
        "prefix": pa.int64(),
        "sampled": pa.int64(),
        "elements": pa.list_(pa.int64()),
    }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in batches:
            rows = []
            for id_, text_ in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(text_)
                prefix = len(found) - -(-percent * len(found) // 100) + 1
                early = found % np.uint64(SAMPLED) == 0
                elements = found[early]
                if len(elements) < prefix:
                    elements = np.concatenate([elements, found[~early][: prefix - len(elements)]])
                rows.append(
                    (id_, len(found), xxhash.xxh3_128_digest(found.tobytes()), prefix, int(early.sum()), elements.view(np.int64))
                )
            columns = zip(*rows) if rows else ((),) * len(types)
            yield record_batch(dict(zip(types, columns)), types)

    ddl = (
        "id BIGINT, n_shingles BIGINT, digest BINARY, prefix BIGINT, sampled BIGINT, "
        "elements ARRAY<BIGINT>"
    )
    return identified(frame, key, text).mapInArrow(scan, ddl)


def _prefixes(sets: DataFrame) -> DataFrame:
    """The elements of each document's prefix that others share."""
    shared = _shared(sets.select("id", F.explode("elements").alias("h")), "h")
    by_document = shared.groupBy("id").agg(F.collect_list(F.struct("df", "h")).alias("shared"))
    # At most as long as a document has elements.
    early = F.array_sort(F.filter("shared", lambda e: _early(e["h"])))
    late = F.filter("shared", lambda e: ~_early(e["h"]))
    unique = F.col("sampled") - F.size("early")
    return (
        sets.select("id", "prefix", "sampled")
        .join(by_document.hint("merge"), "id")
        .withColumn("early", early)
        .withColumn("needed", F.greatest(F.lit(0), F.col("prefix") - unique).cast("int"))
        .select("id", F.explode(F.concat(F.slice("early", F.lit(1), F.col("needed")), late)).alias("e"))
        .select("id", F.col("e.h").alias("h"))
    )


def _shared(rows: DataFrame, *element: str) -> DataFrame:
    """The rows of elements that others share, each with its count."""
    counts = rows.groupBy(*element).agg(F.count("*").alias("df")).where("df > 1")
    return rows.join(settled(counts, "shared-elements").hint("shuffle_hash"), list(element))


def _prefix_links(prefixes: DataFrame, *element: str) -> DataFrame:
    """Links that connect all documents which share an element of their prefixes."""
    leaders = prefixes.groupBy(*element).agg(F.min("id").alias("b"), F.count("*").alias("n"))
    leaders = settled(leaders.where("n > 1").drop("n"), "leaders")
    return prefixes.join(leaders, list(element)).where("id > b").select(F.col("id").alias("a"), "b").distinct()


def _early(element: Column) -> Column:
    # The lowest bits, as the remainder of an unsigned number by a power of two.
    return element.bitwiseAND(F.lit(SAMPLED - 1)) == 0


def _verified(texts: DataFrame, clusters: DataFrame, sizes: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between candidates of one cluster that connect what is similar."""
    members = settled(_members(texts, clusters), "candidates")
    loose = settled(_large(clusters, FEW).select("component"), "loose-clusters")
    if not loose.isEmpty():
        clusters = _taken_apart(members, clusters, loose, sizes, words, percent)
        rest = settled(_members(members.select("id", "text"), clusters), "candidates")
        discard(members)
        members = rest
    large = settled(_large(clusters, BLOCK), "large-clusters")
    light = clusters.select("component", F.col("node").alias("id")).join(large.drop("parts"), "component")
    found = _pivot_links(members, large, light, words, percent)
    if found is None:
        dealt = members.withColumns({"low": F.lit(0), "high": F.lit(0), "class": F.col("id")})
        links = settled(_tree_links(dealt, words, percent), "links")
        discard(members)
        return links
    classes = components(found)
    classes = classes.withColumnRenamed("component", "class").hint("merge")
    placed = light.join(classes, F.col("id") == F.col("node"), "left").select(
        "component", "id", F.coalesce("class", "id").alias("class")
    )
    # Loose documents share blocks, a class of several has blocks of its own.
    class_sizes = placed.groupBy("component", "class").agg(F.count("*").alias("size"))
    grouped = placed.join(settled(class_sizes, "classes"), ["component", "class"]).withColumn(
        "pool", F.when(F.col("size") > 1, F.col("class")).otherwise(F.lit(-1))
    )
    pools = grouped.groupBy("component", "pool").agg(F.ceil(F.count("*") / BLOCK).alias("blocks"))
    blocks = pools.select("component", "pool", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"))
    number = F.xxhash64("component", "pool", "part")
    blocks = settled(blocks.withColumn("block", number), "blocks")
    other = blocks.select("component", F.col("pool").alias("pool2"), F.col("block").alias("block2"))
    same = (F.col("pool") == F.col("pool2")) & (F.col("pool") >= 0)
    pairs = blocks.join(other, "component").where((F.col("block") <= F.col("block2")) & ~same)
    pairs = settled(pairs.select("component", F.col("block").alias("low"), F.col("block2").alias("high")), "block-pairs")
    visits = pairs.select("component", F.col("low").alias("block"), "low", "high").unionByName(
        pairs.where("low <> high").select("component", F.col("high").alias("block"), "low", "high")
    )
    own_block = (
        grouped.join(pools, ["component", "pool"])
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("blocks")))
        .withColumn("block", number)
        .select("component", "id", "class", "block")
    )
    own_block = settled(own_block, "own-blocks")
    small = members.join(large.drop("parts"), "component", "left_anti").withColumns(
        {"class": F.col("id"), "low": F.lit(0).cast("bigint"), "high": F.lit(0).cast("bigint")}
    )
    trees = [found, settled(_tree_links(small, words, percent), "links")]
    # A text is dealt once for every pair its block is in. What is dealt at once is about as
    # much as all candidates, whatever the number of pairs.
    times = visits.groupBy("component", "block").agg(F.count("*").alias("times"))
    dealt = members.select("component", "id", "chars").join(own_block.join(times, ["component", "block"]), ["component", "id"])
    moved = dealt.agg(F.sum(F.col("chars") * F.col("times"))).first()[0] or 0
    turns = math.ceil(moved / (members.agg(F.sum("chars")).first()[0] or 1))
    for turn in range(turns):
        now = visits.where(F.pmod(F.xxhash64("low", "high"), F.lit(turns)) == turn)
        tasks = settled(own_block.join(now.hint("merge"), ["component", "block"]).drop("block"), "tasks")
        big = members.join(tasks.hint("merge"), ["component", "id"])
        trees.append(settled(_tree_links(big, words, percent), "links"))
        discard(tasks)
    discard(members)
    return reduce(DataFrame.unionByName, trees)


def _members(texts: DataFrame, clusters: DataFrame) -> DataFrame:
    return texts.join(clusters.hint("merge"), texts["id"] == clusters["node"]).select(
        "component", "id", "text", F.length("text").alias("chars")
    )


def _large(clusters: DataFrame, least: int) -> DataFrame:
    """Clusters of more documents than that, and how many blocks they are."""
    sizes = clusters.groupBy("component").agg(F.count("*").alias("n"))
    return sizes.where(F.col("n") > least).select("component", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))


def _taken_apart(members, clusters, loose, sizes, words: int, percent: int) -> DataFrame:
    """The clusters, those of many documents taken apart; no link is lost.

    Similar documents are in one cluster, so they meet by prefix in any order of that
    cluster's elements too. Here that is all elements, those that nobody shares first: a
    document of which enough is its own drops out.
    """
    light = settled(clusters.join(loose, "component", "left_semi"), "light")
    inside = members.join(loose, "component", "left_semi")
    # As much at once as the sample of all documents' elements at most.
    total = sizes.agg(F.sum("n_shingles")).first()[0]
    own = sizes.join(light.hint("merge"), F.col("id") == F.col("node")).agg(F.sum("n_shingles")).first()[0]
    slices = max(1, math.ceil(SAMPLED * own / total))
    parts, documents = [], None
    for n in range(slices):
        elements = settled(_slice_of_sets(inside, n, slices, words, percent), "elements")
        if documents is None:
            documents = settled(elements.select("id", "n_shingles", "prefix").distinct(), "documents")
        rows = elements.select("component", "id", F.explode("elements").alias("h"))
        parts.append(settled(_shared(rows, "component", "h"), "shared"))
        discard(elements)
    by_document = (
        reduce(DataFrame.unionByName, parts)
        .groupBy("component", "id")
        .agg(F.array_sort(F.collect_set(F.struct("df", "h"))).alias("shared"))
    )
    needed = F.col("prefix") - F.col("n_shingles") + F.size("shared")
    prefixes = (
        documents.join(by_document.hint("merge"), "id")
        .withColumn("needed", needed.cast("int"))
        .where("needed > 0")
        .select("component", "id", F.explode(F.slice("shared", F.lit(1), F.col("needed"))).alias("e"))
        .select("component", "id", F.col("e.h").alias("h"))
    )
    prefixes = settled(prefixes, "prefixes")
    discard(*parts, documents)
    found = components(_prefix_links(prefixes, "component", "h"))
    clusters = settled(clusters.join(loose, "component", "left_anti").unionByName(found.select("component", "node")), "clusters")
    discard(prefixes)
    return clusters


def _slice_of_sets(members: DataFrame, number: int, slices: int, words: int, percent: int) -> DataFrame:
    """Per document: size and prefix of its set, and those of its elements that are in a slice."""
    types = {
        "component": pa.int64(),
        "id": pa.int64(),
        "n_shingles": pa.int64(),
        "prefix": pa.int64(),
        "elements": pa.list_(pa.int64()),
    }

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        for batch in batches:
            rows = []
            for component, id_, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = shingles(text)
                prefix = len(found) - -(-percent * len(found) // 100) + 1
                own = found[found % np.uint64(slices) == number]
                rows.append((component, id_, len(found), prefix, own.view(np.int64)))
            columns = zip(*rows) if rows else ((),) * len(types)
            yield record_batch(dict(zip(types, columns)), types)

    ddl = "component BIGINT, id BIGINT, n_shingles BIGINT, prefix BIGINT, elements ARRAY<BIGINT>"
    return members.select("component", "id", "text").mapInArrow(scan, ddl)


def _pivot_links(members, large, light, words: int, percent: int) -> DataFrame | None:
    """Links of each large cluster's documents to a few of them, over some rounds.

    Pivots of the first round are spread over the cluster by hash; later ones are taken
    from what is not linked yet.
    """
    if large.isEmpty():
        return None
    found, loose = None, light
    for turn in range(PIVOT_ROUNDS):
        order = F.xxhash64(F.lit(turn), "id")
        least = loose.groupBy("component").agg(
            *(F.min(F.when(F.pmod(order, F.lit(PIVOTS)) == n, F.struct(order.alias("o"), "id"))).alias(f"p{n}") for n in range(PIVOTS))
        )
        ids = least.select("component", F.explode(F.array(*(F.col(f"p{n}.id") for n in range(PIVOTS)))).alias("id"))
        pivots = settled(
            members.join(ids.where("id IS NOT NULL"), ["component", "id"]).select(
                "component", F.col("id").alias("pivot"), F.col("text").alias("pivot_text")
            ),
            "pivots",
        )
        new = settled(_near_pivots(members, pivots, large, words, percent), "pivot-links")
        found = new if found is None else settled(found.unionByName(new), "pivot-links")
        ends = found.select(F.col("a").alias("id")).unionByName(found.select(F.col("b").alias("id"))).distinct()
        loose = settled(loose.join(ends, "id", "left_anti"), "loose")
        if loose.isEmpty():
            break
    return found


def _near_pivots(members: DataFrame, pivots: DataFrame, large: DataFrame, words: int, percent: int) -> DataFrame:
    """Links of documents to their cluster's pivots.

    A cluster is dealt to parts of about a block each. Every part gets the pivots, a few
    texts, first, and then the documents one by one.
    """
    names = ("component", "part", "late", "id", "text")
    own = members.join(large, "component").select(
        "component",
        F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"),
        F.lit(True).alias("late"),
        "id",
        "text",
    )
    everywhere = pivots.join(large, "component").select(
        "component",
        F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(False).alias("late"),
        F.col("pivot").alias("id"),
        F.col("pivot_text").alias("text"),
    )
    types = {"a": pa.int64(), "b": pa.int64()}

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, place, held = Shingler(words), None, []
        for batch in batches:
            links = []
            for component, part, late, id_, text in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
                if place != (component, part):
                    place, held = (component, part), []
                found = shingles(text)
                if not late:
                    held.append((id_, found))
                    continue
                links += [
                    (max(id_, pivot), min(id_, pivot))
                    for pivot, other in held
                    if pivot != id_ and _similar(found, other, percent)
                ]
            yield record_batch(dict(zip(types, zip(*links) if links else ((), ()))), types)

    spread = own.unionByName(everywhere).repartition("component", "part")
    return spread.sortWithinPartitions("component", "part", "late").mapInArrow(compare, "a BIGINT, b BIGINT")


def _tree_links(dealt: DataFrame, words: int, percent: int) -> DataFrame:
    """Links found by the signature tree of each (component, low, high)."""
    types = {"a": pa.int64(), "b": pa.int64()}

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingler(words)
        task, documents = None, []

        def done() -> pa.RecordBatch:
            links = tree_join(documents, percent)
            return record_batch(dict(zip(types, zip(*links) if links else ((), ()))), types)

        for batch in batches:
            columns = (batch.column(n).to_pylist() for n in ("component", "low", "high", "class", "id", "text"))
            for component, low, high, group, id_, text in zip(*columns, strict=True):
                if task != (component, low, high):
                    if len(documents) > 1:
                        yield done()
                    task, documents = (component, low, high), []
                documents.append((id_, group, shingles(text)))
        if len(documents) > 1:
            yield done()

    names = ("component", "low", "high")
    spread = dealt.repartition(*names).sortWithinPartitions(*names)
    return spread.mapInArrow(join, "a BIGINT, b BIGINT")


class Level:
    """The nodes of one level of a signature tree: bitmaps, sizes, and how far bitmaps undercount."""

    def __init__(self, bitmaps: np.ndarray, least: np.ndarray, most: np.ndarray, excess: np.ndarray):
        self.bitmaps, self.least, self.most, self.excess = bitmaps, least, most, excess

    def __len__(self) -> int:
        return len(self.least)

    @classmethod
    def of_sets(cls, sets: list[np.ndarray]) -> Level:
        """The lowest level: a node for each set."""
        bitmaps = np.zeros((len(sets), BITS // 64), np.uint64)
        for n, elements in enumerate(sets):
            bits = np.zeros(BITS, bool)
            bits[(elements >> np.uint64(20)) % np.uint64(BITS)] = True
            bitmaps[n] = np.packbits(bits).view(np.uint64)
        sizes = np.array([len(elements) for elements in sets], np.int64)
        return cls(bitmaps, sizes, sizes, sizes - np.bitwise_count(bitmaps).sum(axis=1, dtype=np.int64))

    def above(self) -> Level:
        """The next level: a node for every few of this one."""
        starts = np.arange(0, len(self), FANOUT)
        return Level(
            np.bitwise_or.reduceat(self.bitmaps, starts),
            np.minimum.reduceat(self.least, starts),
            np.maximum.reduceat(self.most, starts),
            np.maximum.reduceat(self.excess, starts),
        )

    def pairs_below(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of this level's nodes below pairs of the next level's, each once."""
        step = np.arange(FANOUT)
        left, right = np.broadcast_arrays((left[:, None] * FANOUT + step)[:, :, None], (right[:, None] * FANOUT + step)[:, None])
        kept = (left <= right) & (right < len(self))
        return left[kept], right[kept]

    def may_link(self, left: np.ndarray, right: np.ndarray, percent: int) -> np.ndarray:
        """Of which pairs the largest possible overlap suffices for any two documents.

        An intersection has at most the common bits, plus what shares a bit.
        """
        fits = 100 * self.most[left] >= percent * self.least[right]
        fits &= 100 * self.most[right] >= percent * self.least[left]
        left, right = left[fits], right[fits]
        common = self.bitmaps[left]
        common &= self.bitmaps[right]
        common = np.bitwise_count(common).sum(axis=1, dtype=np.int64)
        overlap = common + np.minimum(self.excess[left], self.excess[right])
        overlap = np.minimum(overlap, np.minimum(self.most[left], self.most[right]))
        fits[fits] = overlap >= required(self.least[left], self.least[right], percent)
        return fits


def tree_join(documents: list[tuple[int, int, np.ndarray]], percent: int) -> list[tuple[int, int]]:
    """Links (larger id, smaller id) that connect the similar among (id, class, set).

    Documents of one class are connected already.
    """
    documents = sorted(documents, key=lambda document: tuple(document[2][:3].tolist()))
    levels = [Level.of_sets([elements for _, _, elements in documents])]
    while len(levels[-1]) > FANOUT:
        levels.append(levels[-1].above())
    # What is connected so far has one number.
    numbers: dict[int, int] = {}
    connected = np.array([numbers.setdefault(group, len(numbers)) for _, group, _ in documents])
    links: list[tuple[int, int]] = []
    root = np.zeros(1, np.int64)
    waiting = [(len(levels) - 1, root, root)]
    while waiting:
        depth, left, right = waiting.pop()
        if len(left) > PAIRS:
            waiting.append((depth, left[PAIRS:], right[PAIRS:]))
        left, right = levels[depth].pairs_below(left[:PAIRS], right[:PAIRS])
        if depth == 0:
            loose = connected[left] != connected[right]
            left, right = left[loose], right[loose]
        near = levels[depth].may_link(left, right, percent)
        left, right = left[near], right[near]
        if depth > 0:
            waiting.append((depth - 1, left, right))
            continue
        for a, b in zip(left.tolist(), right.tolist(), strict=True):
            if connected[a] != connected[b] and _similar(documents[a][2], documents[b][2], percent):
                connected[connected == connected[b]] = connected[a]
                one, two = documents[a][0], documents[b][0]
                if one != two:
                    links.append((max(one, two), min(one, two)))
    return links


def _similar(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    if 100 * min(len(left), len(right)) < percent * max(len(left), len(right)):
        return False
    both = len(np.intersect1d(left, right, assume_unique=True))
    return both > 0 and both >= required(len(left), len(right), percent)
