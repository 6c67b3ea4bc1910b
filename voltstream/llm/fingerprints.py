"""Merkle fingerprints of documents, in SQL functions only.

A text is cut without loss into sections (at blank lines), paragraphs (at line ends)
and phrases (at words with certain last letters, so that an edit shifts no later
cut). The digest of a phrase is the SHA-256 of its text, that of every other node the
SHA-256 of its children's digests. Equal roots mean equal texts; where roots differ,
the branches that differ show where.

A fingerprint is ``root:phrases``, with six hexadecimal digits per phrase, "." between
paragraphs and "/" between sections.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltstream.llm.common import text_or_empty

SECTION = r"(?s).+?\n[ \t\r]*\n[ \t\r\n]*|.+"
PARAGRAPH = r"[^\n]*\n+|[^\n]+"
PHRASE = r"(?s).{1,48}?[.,;:!?dns][ \t\r\n]+|.{1,48}"
SHORT = 6
# Documents per block of the neighbour search, on average, and the most blocks there are.
BLOCK = 1024
MOST_BLOCKS = 4096
# Documents whose ids are looked at per block, to find the edges of blocks.
LOOKED_AT = 64


def merkle_tree(text: str | Column = "text") -> Column:
    """Phrase digests, by section and paragraph. Null gives the tree of the empty text."""
    return F.transform(
        _parts(text_or_empty(text), SECTION),
        lambda section: F.transform(
            _parts(section, PARAGRAPH),
            lambda paragraph: F.transform(_parts(paragraph, PHRASE), _digest),
        ),
    )


def root_of(tree: Column) -> Column:
    """The root digest: equal for equal texts only."""
    return _parent(F.transform(tree, section_digest))


def section_digest(section: Column) -> Column:
    return _parent(F.transform(section, _parent))


def fingerprint_of(tree: Column) -> Column:
    """The tree as text: the root in full, phrases in short."""
    sections = F.transform(
        tree,
        lambda section: F.array_join(
            F.transform(
                section,
                lambda paragraph: F.array_join(
                    F.transform(paragraph, lambda phrase: F.substring(phrase, 1, SHORT)), ""
                ),
            ),
            ".",
        ),
    )
    return F.concat(root_of(tree), F.lit(":"), F.array_join(sections, "/"))


def likeness(left: str | Column, right: str | Column) -> Column:
    """How much of two fingerprints' leaves is the same and in the same order, 0 to 1.

    The mean of two shares, each twice what is common over the sum of both: of distinct
    phrases, and of distinct neighbours, the text's two ends being neighbours too. 1 for
    equal roots only: texts that differ just in how often a neighbourhood recurs stay
    below it by a share of their leaves.
    """
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))

    def compared(leaves: Column) -> Column:
        most = 1 - 1 / (F.size(leaves["a"]) + F.size(leaves["b"]) + 1)
        sets = F.struct(
            F.array_distinct(leaves["a"]).alias("a"),
            F.array_distinct(leaves["b"]).alias("b"),
            F.array_distinct(_neighbours(leaves["a"])).alias("na"),
            F.array_distinct(_neighbours(leaves["b"])).alias("nb"),
        )
        shared = _once(sets, lambda x: (_share(x["a"], x["b"]) + _share(x["na"], x["nb"])) / 2)
        return F.least(shared, most)

    leaves = F.struct(_phrases(left).alias("a"), _phrases(right).alias("b"))
    return F.when(left == right, F.lit(1.0)).otherwise(_once(leaves, compared))


def changed_paragraphs(left: str | Column, right: str | Column) -> Column:
    """How many distinct paragraphs of a fingerprint the other lacks.

    Paragraphs of common sections are not looked into.
    """
    left, right = (F.col(c) if isinstance(c, str) else c for c in (left, right))
    a, b = (F.split(F.substring_index(c, ":", -1), "/") for c in (left, right))
    own, other = (F.flatten(F.transform(x, lambda s: F.split(s, "[.]"))) for x in (F.array_except(a, b), b))
    return F.size(F.array_except(own, other)).cast("bigint")


def edited_paragraphs(tree: str | Column, other: str | Column) -> Column:
    """Where a text differs from another: (section, paragraph) of each changed branch.

    Only branches of ``tree`` whose digest the other tree lacks are followed down.
    """
    tree, other = (F.col(c) if isinstance(c, str) else c for c in (tree, other))
    sections = F.transform(other, section_digest)
    paragraphs = F.transform(F.flatten(other), _parent)
    changed = F.transform(
        tree,
        lambda section, n: F.when(
            F.array_contains(sections, section_digest(section)), F.array().cast(_PLACES)
        ).otherwise(
            F.filter(
                F.transform(
                    section,
                    lambda paragraph, m: F.struct(
                        n.alias("section"),
                        F.when(
                            ~F.array_contains(paragraphs, _parent(paragraph)), m
                        ).alias("paragraph"),
                    ),
                ),
                lambda place: place["paragraph"].isNotNull(),
            )
        ),
    )
    return F.flatten(changed)


def fingerprints(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, root and fingerprint of every whole text.

    No shuffle. Null text is the empty text, whose fingerprint has no phrases; null
    keys and repeated rows stay; other columns are ignored.
    """
    trees = frame.select(F.col(f"`{key}`").alias(key), merkle_tree(F.col(f"`{text}`")).alias("tree"))
    return trees.select(key, root_of(F.col("tree")).alias("root"), fingerprint_of(F.col("tree")).alias("fingerprint"))


def compare_with_edit(frame: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text, and the text with its last third overwritten.

    The third comes from the start of the next text by descending key; after the last
    one the first is next. Gives key, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited and near_next.

    Also ``changed``: how many paragraphs of the text the edited one lacks.

    Texts are shuffled once, to blocks of neighbouring keys. Null text is empty; a null
    key is the lowest; equal keys are ordered by a hash of their text; a single row is
    next to itself; an empty table gives no rows.
    """
    trees = frame.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        text_or_empty(F.col(f"`{text}`")).alias("text"),
    ).withColumn("tree", merkle_tree("text"))
    rows = trees.select("id", "text", fingerprint_of(F.col("tree")).alias("fingerprint"), F.xxhash64("text").alias("h"))
    pairs = _with_next(rows)
    third = F.floor(F.length("text") / 3).cast("int")
    edited = pairs.withColumn(
        "edited",
        F.concat(
            F.col("text").substr(F.lit(1), F.length("text") - third),
            F.col("next_text").substr(F.lit(1), third),
        ),
    ).withColumn("tree", merkle_tree("edited"))
    done = edited.select(
        F.col("id").alias(key),
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint",
        fingerprint_of(F.col("tree")).alias("edited_fingerprint"),
        "next_fingerprint",
    )
    return done.select(
        key,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness("fingerprint", "edited_fingerprint").alias("near_edited"),
        likeness("fingerprint", "next_fingerprint").alias("near_next"),
        changed_paragraphs("fingerprint", "edited_fingerprint").alias("changed"),
    )


_PLACES = "array<struct<section: int, paragraph: int>>"


def _parts(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _digest(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def _parent(children: Column) -> Column:
    return _digest(F.array_join(children, ""))


def _phrases(fingerprint: Column) -> Column:
    """The leaves in order, as numbers."""
    short = F.substring_index(fingerprint, ":", -1)
    return F.transform(F.regexp_extract_all(short, F.lit(f"[0-9a-f]{{{SHORT}}}"), F.lit(0)), lambda x: F.xxhash64(x))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def _neighbours(phrases: Column) -> Column:
    """Every phrase after the one before it, from the beginning to the end."""
    ends = F.array(F.lit(0).cast("bigint"))
    return F.zip_with(F.concat(ends, phrases), F.concat(phrases, ends), lambda a, b: F.xxhash64(a, b))


def _share(a: Column, b: Column) -> Column:
    total = F.size(a) + F.size(b)
    return F.coalesce(2 * F.size(F.array_intersect(a, b)) / F.when(total > 0, total), F.lit(0.0))


def _with_next(rows: DataFrame) -> DataFrame:
    """Add text and fingerprint of the row with the next lower (id, hash of text).

    Blocks are ranges of that order which hold about as many rows each, wherever the ids
    lie and however many rows have one id or none; rows alike in id and text stand in one
    block. Inside a block the next row is the one before. The lowest row of a block
    takes the highest of the block below, of which there is one per block.
    """
    place = F.struct("id", "h")
    edges = _edges(rows)
    placed = rows.withColumn("block", _block_of(place, edges))
    order = Window.partitionBy("block").orderBy(F.asc_nulls_first("id"), "h", "text")
    # Two columns, not one of both: that would be made, and shuffled, beside them.
    linked = placed.withColumns(
        {"next_text": F.lag("text").over(order), "next_fingerprint": F.lag("fingerprint").over(order)}
    )
    # The highest places first, which are numbers, then the texts that stand there. One
    # row per block, so they may be sent out, and one task may find the block below each.
    highest = placed.groupBy("block").agg(F.max(F.struct("id", "h")).alias("top")).select("block", "top.*")
    at_top = (placed["block"] == highest["block"]) & (placed["h"] == highest["h"]) & placed["id"].eqNullSafe(highest["id"])
    texts = placed.join(F.broadcast(highest), at_top, "left_semi").groupBy("block").agg(F.max("text").alias("top"))
    below = Window.orderBy("block")
    every = below.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tops = texts.withColumn("top", F.coalesce(F.lag("top").over(below), F.last("top").over(every)))
    tops = tops.withColumn("tree", merkle_tree("top")).select(
        "block", "top", fingerprint_of(F.col("tree")).alias("top_fingerprint")
    )
    return linked.join(tops, "block").select(
        "id",
        "text",
        "fingerprint",
        F.coalesce("next_text", "top").alias("next_text"),
        F.coalesce("next_fingerprint", "top_fingerprint").alias("next_fingerprint"),
    )


def _edges(rows: DataFrame) -> list[tuple[int | None, int]]:
    """Where blocks begin, from a sample of about ``LOOKED_AT`` rows per block.

    At most ``MOST_BLOCKS`` edges and so many times that of two numbers reach the driver.
    """
    count = rows.count()
    blocks = min(MOST_BLOCKS, -(-count // BLOCK))
    if blocks < 2:
        return []
    share = int((1 << 30) * min(1.0, LOOKED_AT * blocks / count))
    # By a hash of both, so that the sample does not hang on how the table is stored.
    chosen = F.pmod(F.xxhash64("id", "h"), F.lit(1 << 30)) < share
    sample = rows.where(chosen).select("id", "h").groupBy("id", "h").count().collect()
    # A repeated row was drawn with all its copies, which count but cannot be parted.
    found = sorted(((r.id is not None, r.id or 0, r.h, r["count"]) for r in sample))
    total, passed, edges = sum(f[3] for f in found), 0, []
    for there, id_, h, copies in found:
        if passed >= (len(edges) + 1) * total / blocks:
            edges.append((id_ if there else None, h))
        passed += copies
    return edges


def _number(named: tuple[str, int | None]) -> str:
    name, value = named
    return f"{name}, CAST({'NULL' if value is None else repr(str(value))} AS BIGINT)"


def _block_of(place: Column, edges: list[tuple[int | None, int]]) -> Column:
    """How many edges are at or below a place, by two looks at about their root."""
    if not edges:
        return F.lit(0)
    step = math.isqrt(len(edges) - 1) + 1
    # Constants of the plan, so that no row computes them.
    every, tops = (
        F.expr(f"array({', '.join(f'named_struct({_number(i)}, {_number(h)})' for i, h in chosen)})")
        for chosen in (
            [(("'id'", i), ("'h'", h)) for i, h in edges],
            [(("'id'", i), ("'h'", h)) for i, h in edges[::step]],
        )
    )
    begin = F.greatest(F.size(F.filter(tops, lambda e: e <= place)) - 1, F.lit(0)) * step
    return begin + F.size(F.filter(F.slice(every, begin + 1, F.lit(step)), lambda e: e <= place))
