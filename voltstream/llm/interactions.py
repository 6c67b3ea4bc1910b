"""How filters of a corpus interact, for every order they may run in.

A document is summed up by the mask of the filters it fails. The filter that removes it
is the first of its mask in the order at hand, and in the lexicographic list of all orders
those that begin alike stand together. So a mask's removal at a step covers a few
intervals of ranks: its counts are added at the start of each interval, taken off at the
end, and a prefix sum over the ranks gives the totals of every order.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import settled, text_or_empty

LETTERS = "ABCDE"
COUNTS = ("documents", "good", "toxic")

LEAST_WORDS = 200
LEAST_DISTINCT_PERCENT = 50
MOST_CAPITALS_PERCENT = 3
# Words, and characters of markup.
WORD = r"[^ \t-\r]+"
MARKUP = "[#$%&*|]"

RESULT = (
    "part STRING, filter_order STRING, step INT, kept BIGINT, removed BIGINT, redundant BIGINT, "
    "unique_fails BIGINT, good_lost BIGINT, toxic_lost BIGINT, shapley BIGINT"
)


def lehmer_rank(order: tuple[int, ...], size: int) -> int:
    """Rank of the first order of ``size`` items that begins with ``order``."""
    rank = 0
    for at, item in enumerate(order):
        smaller = item - sum(x < item for x in order[:at])
        rank += smaller * factorial(size - 1 - at)
    return rank


def removal_intervals(mask: int, size: int) -> Iterator[tuple[int, int, int]]:
    """(step from 0, first rank, rank after the last) of all removals of a mask.

    Before its removal stand filters that the document passes; the next one it fails.
    """
    passed = [f for f in range(size) if not mask >> f & 1]
    failed = [f for f in range(size) if mask >> f & 1]
    for step in range(len(passed) + 1):
        for before in permutations(passed, step):
            for item in failed:
                rank = lehmer_rank((*before, item), size)
                yield step, rank, rank + factorial(size - 1 - step)


def removals(masks: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """What every order removes at every step: (order rank, step, count column).

    ``counts`` has a row for each mask. Exact in 64 bits.
    """
    steps = np.zeros((factorial(size) + 1, size, counts.shape[1]), np.int64)
    for mask, amount in zip(masks.tolist(), counts, strict=True):
        for step, first, after in removal_intervals(mask, size):
            steps[first, step] += amount
            steps[after, step] -= amount
    return np.cumsum(steps, axis=0)[:-1]


def document_filters(documents: DataFrame, text: str = "text") -> dict[str, Column]:
    """Which of the filters that look at one text alone it fails, by letter."""
    content = text_or_empty(F.col(f"`{text}`"))
    words = F.regexp_extract_all(content, F.lit(WORD), F.lit(0))
    capitals = F.length(F.regexp_replace(content, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * LEAST_DISTINCT_PERCENT,
        "C": capitals * 100 > F.length(content) * MOST_CAPITALS_PERCENT,
        "D": F.regexp_like(content, F.lit(MARKUP)),
    }


def failure_masks(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(part, mask, documents, good, toxic): how many documents fail which filters.

    Bit n of the mask is filter n of ``LETTERS``. The last one is the repetition of a
    smaller id's text anywhere in the table: a row without an id neither repeats nor is
    repeated, rows of one id and text are the first together. Null text is empty, a null
    part the empty text. A document is good or toxic if any label of its id says so.

    The text is read once and leaves as its digest. Rows alike in all but number are
    summed before every shuffle, so any share of the table may be copies of one text.
    """
    digest = F.unhex(F.sha2(F.encode(text_or_empty(F.col(f"`{text}`")), "UTF-8"), 256))
    own = sum(
        (F.when(fails, F.lit(1 << n)).otherwise(F.lit(0)) for n, fails in enumerate(document_filters(documents, text).values())),
        F.lit(0),
    )
    rows = documents.select(
        F.col(f"`{key}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        digest.alias("digest"),
        own.alias("own"),
    )
    marks = labels.groupBy(F.col("doc_id").cast("bigint").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    distinct = rows.groupBy("id", "digest", "part", "own").agg(F.count("*").alias("n"))
    marked = distinct.join(marks, "id", "left").fillna(False, ["good", "toxic"])
    kinds = ["digest", "part", "own", "good", "toxic"]
    # Per text and kind: the smallest id with its rows, all rows with an id, and the others.
    first = F.min(F.when(F.col("id").isNotNull(), F.struct("id", "n"))).alias("first")
    numbered = F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("numbered")
    nameless = F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless")
    copies = settled(marked.groupBy(*kinds).agg(first, numbered, nameless), "copies")
    least = copies.groupBy("digest").agg(F.min("first.id").alias("least"))
    own_first = F.when(F.col("first.id") == F.col("least"), F.col("first.n")).otherwise(0)
    last = 1 << len(LETTERS) - 1
    split = (
        copies.join(least, "digest")
        .withColumn("kept", own_first + F.col("nameless"))
        .select(
            "part", "good", "toxic",
            F.inline(
                F.array(
                    F.struct(F.col("own").alias("mask"), F.col("kept").alias("n")),
                    F.struct((F.col("own") + last).alias("mask"), (F.col("numbered") + F.col("nameless") - F.col("kept")).alias("n")),
                )
            ),
        )
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("documents"),
        F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit(masks: DataFrame, letters: str = LETTERS) -> DataFrame:
    """A row per part, order of the filters and step, from ``failure_masks``.

    Every order and step has a row, zeros included. A part has at most a row per mask
    here (32 for five filters), however many documents it has. No masks give no rows.
    """
    size = len(letters)
    orders = ["".join(p) for p in permutations(letters)]
    # Which filter stands where, by order and step.
    items = np.array(list(permutations(range(size))))

    def totals(frame: pd.DataFrame) -> pd.DataFrame:
        mask, counts = frame["mask"].to_numpy(), frame[list(COUNTS)].to_numpy(np.int64)
        gone = removals(mask, counts, size)
        removed = gone[:, :, 0]
        fails = np.array([counts[mask >> f & 1 == 1, 0].sum() for f in range(size)])
        alone = np.array([counts[mask == 1 << f, 0].sum() for f in range(size)])
        shapley = np.array([removed[items == f].sum() for f in range(size)])
        columns = {
            "kept": counts[:, 0].sum() - np.cumsum(removed, axis=1),
            "removed": removed,
            "redundant": fails[items] - removed,
            "unique_fails": alone[items],
            "good_lost": gone[:, :, 1],
            "toxic_lost": gone[:, :, 2],
            "shapley": shapley[items],
        }
        return pd.DataFrame(
            {
                "part": frame["part"].iloc[0],
                "filter_order": np.repeat(orders, size),
                "step": np.tile(np.arange(1, size + 1, dtype=np.int32), len(orders)),
                **{name: values.ravel() for name, values in columns.items()},
            }
        )

    return masks.groupBy("part").applyInPandas(totals, RESULT)


def interaction_audit(
    documents: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """The audit of the five filters over all documents, by part.

    See ``failure_masks`` for odd rows; an empty table gives an empty audit, and other
    columns are ignored.
    """
    return audit(failure_masks(documents, labels, key, text, part))
