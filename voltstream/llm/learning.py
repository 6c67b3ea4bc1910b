"""Labelled samples and folds for the classifiers."""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import text_or_empty

# About this many labelled texts are learnt from, none longer than this. Both bound what the
# task that learns holds.
SAMPLE_ROWS = 8000
SAMPLE_CHARS = 20_000
_PARTS = 1 << 30

Model = TypeVar("Model")


def in_fold(key: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the key as text, modulo ``folds``, is ``fold``; not for null keys."""
    return F.coalesce(F.crc32(F.col(f"`{key}`").cast("string")) % folds == fold, F.lit(False))


def labelled_sample(
    documents: DataFrame,
    labels: DataFrame,
    label: str,
    folds: int,
    held_out: int,
    rows: int = SAMPLE_ROWS,
    key: str = "doc_id",
    text: str = "text",
    chars: int = SAMPLE_CHARS,
) -> DataFrame:
    """Key, text and 0/1 label of a sample of about ``rows`` documents.

    Never from the held-out fold. A document is in the sample by the hash of its key, so
    the sample is the same however the tables are stored. Null labels, null keys and
    texts of more than ``chars`` characters are passed over; of repeated labels the largest holds.
    """
    known = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & ~in_fold(key, folds, held_out))
        .groupBy(key)
        .agg(F.max(label).alias("label"))
    )
    count = known.count()
    share = F.pmod(F.xxhash64(F.lit(label), key), F.lit(_PARTS)) < int(_PARTS * min(1.0, rows / max(count, 1)))
    chosen = known.where(share).select(F.col(key).alias("_key"), "label")
    # About ``rows`` pairs of two numbers, so a bounded broadcast.
    return (
        documents.select(F.col(f"`{key}`").alias("_key"), text_or_empty(F.col(f"`{text}`")).alias("text"))
        .join(F.broadcast(chosen), "_key")
        .where(F.length("text") <= chars)
        .dropDuplicates(["_key"])
        .select("_key", "text", "label")
    )


def learnt(train: Callable[[list[str], np.ndarray], Model], sample: DataFrame) -> Model:
    """What ``train`` makes of the texts and labels of a sample, in the order of their keys.

    It runs in one task, as the sample is bounded; the driver gets the model alone, and
    neither the sample nor the memory that learning takes.
    """

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = sorted(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True))
        model = train([text for _, text, _ in found], np.array([label for *_, label in found], np.float64))
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    # Spark may run no task for an empty sample.
    models = sample.repartition(1).mapInArrow(fit, "model BINARY").collect()
    return pickle.loads(models[0]["model"]) if models else train([], np.zeros(0))


def word_hash(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace"))


class Scores(dict):
    """A function of words, remembered. Emptied when it holds too many."""

    def __init__(self, function, limit: int = 1_000_000):
        super().__init__()
        self.function, self.limit = function, limit

    def __missing__(self, word: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[word] = self.function(word)
        return value


def fit_logistic(features: np.ndarray, labels: np.ndarray, steps: int = 60, ridge: float = 1e-2):
    """Weights (the last one the constant) of a logistic regression, by Newton's steps."""
    x = np.column_stack([features, np.ones(len(features))])
    weights = np.zeros(x.shape[1])
    for _ in range(steps):
        p = logistic(x @ weights)
        gradient = x.T @ (p - labels) + ridge * weights
        curve = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(x.shape[1])
        weights -= np.clip(np.linalg.solve(curve, gradient), -2, 2)
    return weights


def logistic(value):
    return 1 / (1 + np.exp(-np.clip(value, -50, 50)))
