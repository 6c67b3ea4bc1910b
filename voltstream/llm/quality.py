"""Document quality by a factorisation machine.

Inputs are the distinct words of a text, hashed, its structure (lengths, repeats, kinds
of characters; as numbers and as tenths of their range in the sample) and its
size. All pairs of inputs interact through vectors of low rank; by the identity
2 * sum of pairs = (sum of vectors)^2 - sum of squared vectors, a text is scored in time
linear in its inputs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import identified, kept_ddl, named, record_batch, with_kept
from voltstream.llm.learning import Scores, in_fold, labelled_sample, learnt, logistic, word_hash

BITS, RANK = 16, 8
FOLDS, HELD_OUT = 4, 2
THRESHOLD = 0.7
BUCKETS = 10
# A sample of any size is gone through, in a new order each time, for so many batches.
STEPS, BATCH, RATE, RIDGE = 80, 400, 0.08, 2e-4

# Kinds of bytes.
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_STOP = np.isin(np.arange(256), list(b".,;:?"))
_BLANK = np.isin(np.arange(256), list(b" \t\n\r\v\f"))
_SYMBOL = ~(_LETTER | _DIGIT | _STOP | _BLANK)
STATISTICS = 16


@dataclass
class Machine:
    constant: float
    weights: np.ndarray
    vectors: np.ndarray
    centre: np.ndarray
    spread: np.ndarray
    edges: np.ndarray  # [statistic, bucket edge]


def inspect(text: str) -> tuple[set[str], list[float]]:
    """The distinct words of a text and its structure."""
    data = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    words = text.lower().split()
    distinct, lines = set(words), [x for x in text.split("\n") if x]
    size, count = max(int(data.sum()), 1), max(len(words), 1)
    letters = max(int(data[_LETTER].sum()), 1)
    common = max(Counter(words).values(), default=0)
    return distinct, [
        np.log1p(size),
        np.log1p(len(words)),
        len("".join(words)) / count,
        np.log1p(max(map(len, distinct), default=0)),
        data[_UPPER].sum() / letters,
        data[_DIGIT].sum() / size,
        data[_SYMBOL].sum() / size,
        data[_STOP].sum() / count,
        data[_BLANK].sum() / size,
        data.max() / size,
        len(distinct) / count,
        common / count,
        sum(map(eq, words, words[1:])) / count,
        np.log1p(len(lines)),
        len(words) / max(len(lines), 1),
        1 - len(set(lines)) / max(len(lines), 1),
    ]


def encode(machine: Machine, found: list[tuple[set[str], list[float]]], hashed: Scores):
    """Input numbers, values and the row edges of a batch of texts."""
    numbers = np.array([f[1] for f in found]).reshape(-1, STATISTICS)
    scaled = np.clip((numbers - machine.centre) / machine.spread, -4, 4)
    words = 1 << BITS
    index, value = [], []
    for n, (distinct, _) in enumerate(found):
        bucket = (machine.edges <= numbers[n][:, None]).sum(axis=1)
        own = np.fromiter((hashed[w] for w in distinct), np.int64, len(distinct))
        index += [own, words + np.arange(STATISTICS), words + STATISTICS + np.arange(STATISTICS) * BUCKETS + bucket]
        value += [np.full(len(own), 1 / np.sqrt(len(own) or 1)), scaled[n] / 4, np.full(STATISTICS, 0.5)]
    sizes = np.array([len(f[0]) + 2 * STATISTICS for f in found], np.int64)
    return np.concatenate(index), np.concatenate(value), np.cumsum(sizes) - sizes


def evaluate(machine: Machine, index: np.ndarray, value: np.ndarray, edges: np.ndarray):
    """The machine's sums, and the vector sums that its gradient needs."""
    scaled = machine.vectors[index] * value[:, None]
    sums = np.add.reduceat(scaled, edges)
    squares = np.add.reduceat(scaled * scaled, edges)
    linear = np.add.reduceat(machine.weights[index] * value, edges)
    return machine.constant + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def train(texts: list[str], labels: np.ndarray, seed: int = 11) -> Machine | None:
    """Fit on a labelled sample, by batches with per-weight step sizes.

    None if the sample lacks either class.
    """
    if len(set(labels.tolist())) < 2:
        return None
    same: dict[str, str] = {}  # one object per word, however often it occurs
    found = [({same.setdefault(w, w) for w in words}, own) for words, own in map(inspect, texts)]
    numbers = np.array([f[1] for f in found])
    rng = np.random.default_rng(seed)
    size = (1 << BITS) + STATISTICS * (1 + BUCKETS)
    machine = Machine(
        float(np.log(labels.mean() / (1 - labels.mean()))),
        np.zeros(size),
        rng.normal(0, 0.02, (size, RANK)),
        numbers.mean(axis=0),
        numbers.std(axis=0) + 1e-9,
        np.quantile(numbers, np.arange(1, BUCKETS) / BUCKETS, axis=0).T,
    )
    hashed = Scores(lambda w: word_hash(w) & (1 << BITS) - 1)
    squares = [1e-6, np.full(size, 1e-6), np.full((size, RANK), 1e-6)]
    done = 0
    while done < STEPS:
        order = rng.permutation(len(found))
        for at in range(0, len(order), BATCH):
            done += 1
            rows = order[at : at + BATCH]
            index, value, edges = encode(machine, [found[n] for n in rows], hashed)
            output, sums = evaluate(machine, index, value, edges)
            error = (logistic(output) - labels[rows]) / len(rows)
            per = np.repeat(error, np.diff([*edges, len(index)])) * value
            used, place = np.unique(index, return_inverse=True)
            row = np.repeat(np.arange(len(rows)), np.diff([*edges, len(index)]))
            pull = per[:, None] * (sums[row] - machine.vectors[index] * value[:, None])
            steps = (
                error.sum(),
                np.bincount(place, per, len(used)) + RIDGE * machine.weights[used],
                np.column_stack([np.bincount(place, pull[:, k], len(used)) for k in range(RANK)])
                + RIDGE * machine.vectors[used],
            )
            squares[0] += steps[0] ** 2
            machine.constant -= RATE * steps[0] / np.sqrt(squares[0])
            for array, total, step in (
                (machine.weights, squares[1], steps[1]),
                (machine.vectors, squares[2], steps[2]),
            ):
                total[used] += step * step
                array[used] -= RATE * step / np.sqrt(total[used])
    return machine


def score_documents(
    documents: DataFrame,
    machine: Machine | None,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """key, score and predicted of every whole text.

    ``keep`` names columns to carry along; one named like a result gives way to it.

    No shuffle. Null text is empty; the empty text is scored by its structure; a null
    key and repeated rows stay; other columns are ignored. Without a machine every
    score is 1.
    """
    types = {"id": pa.int64(), "score": pa.float64()}
    sent = documents.sparkSession.sparkContext.broadcast(machine)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = sent.value
        hashed = Scores(lambda w: word_hash(w) & (1 << BITS) - 1)
        for batch in batches:
            found = [inspect(t) for t in batch.column("text").to_pylist()] if machine else []
            scores = [1.0] * batch.num_rows
            if found:
                scores = logistic(evaluate(machine, *encode(machine, found, hashed))[0])
            found = record_batch({"id": batch.column("id"), "score": scores}, types)
            yield with_kept(batch, keep, found)

    ddl = f"{kept_ddl(documents, keep)}id BIGINT, score DOUBLE"
    scored = identified(documents, key, text, keep).mapInArrow(score, ddl)
    result = {
        key: F.col("id"),
        "score": F.col("score"),
        "predicted": (F.col("score") >= THRESHOLD).cast("int"),
    }
    return named(scored, keep, result)


def quality(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold, score all.

    Adds ``held_out`` to the columns of ``score_documents``; a null doc_id is in no fold.
    """
    machine = learnt(train, labelled_sample(documents, labels, "quality", FOLDS, HELD_OUT))
    return score_documents(documents, machine).withColumn(
        "held_out", in_fold("doc_id", FOLDS, HELD_OUT)
    )
