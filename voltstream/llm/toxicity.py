"""Toxic spans by a linear-chain conditional random field.

Two states per word: clean and toxic. A word's features are itself and its first
letters, hashed. The labels are per document, so words are labelled first: toxic is a
word whose odds of standing in a toxic document are, by all that the sample can tell,
some times those of standing in a clean one, and every word of a clean document is
clean. The field is trained on those labelled
words; its forward-backward marginals give toxic spans with their offsets, and a
logistic curve over their maximum and sum gives the document's score.
"""

from __future__ import annotations

import logging
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import identified, kept_ddl, named, record_batch, with_kept
from voltstream.llm.learning import Scores, fit_logistic, in_fold, labelled_sample, learnt, logistic, word_hash

log = logging.getLogger(__name__)

WORD = re.compile(r"[^\W\d_]+")
BITS = 18
PREFIXES = (4, 5)
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.5
# A word is labelled toxic if the lower end of the one-sided 95 percent interval of its odds
# ratio, toxic documents over clean ones, is at least so much. The same at every size: the
# fewer documents there are, the wider the interval. Half a document smooths each count.
LEAST_RATIO, DEVIATIONS, SMOOTHED = 4.0, 1.645, 0.5
WINDOW, STEPS, RATE, RIDGE = 48, 50, 0.5, 1e-4
# Windows of clean documents that the field is trained on, beside all that hold a toxic word.
CLEAN_WINDOWS = 6000
# Long texts are tagged in segments of so many words, see ``marginals``.
SEGMENT = 512


@dataclass
class Field:
    """Emission weights by hashed feature, transition weights, and the document curve."""

    emission: np.ndarray
    bias: float
    transition: np.ndarray  # [from, to], log potentials
    curve: np.ndarray


def features(word: str) -> list[str]:
    """The word in lower case and its first letters."""
    word = word.lower()
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) >= n)]


def train(
    texts: list[str], labels: np.ndarray, seed: int = 7, clean_windows: int = CLEAN_WINDOWS
) -> Field | None:
    """Fit the field on two thirds of each class of the sample, the document curve on the rest.

    Words are labelled by all texts of the two thirds. The field then learns from every
    window of ``WINDOW`` words with a toxic one, and from ``clean_windows`` of those of
    clean documents, drawn at random: they bound the memory of the task. None if the sample
    lacks either class; of fewer than three documents of a class the curve sees
    those the field was trained on, with a warning.
    """
    if len(set(labels.tolist())) < 2:
        return None
    third = np.zeros(len(texts), bool)
    for label in (0, 1):
        third[np.flatnonzero(labels == label)[2::3]] = True
    curve = np.flatnonzero(third)
    if len(set(labels[curve].tolist())) < 2:
        log.warning("fewer than three labelled documents of a class: the curve is fitted on all")
        curve = np.arange(len(texts))
    same: dict[str, str] = {}  # one object per word, however often it occurs
    lower = [[same.setdefault(w, w) for w in WORD.findall(t)] for t in texts]
    fit = [n for n in range(len(texts)) if not third[n]]
    toxic_features = _labelled_features([lower[n] for n in fit], labels[fit])
    toxic_word = Scores(lambda w: any(f in toxic_features for f in features(w)))
    known = Scores(lambda w: [word_hash(f) & (1 << BITS) - 1 for f in features(w)])
    rng = np.random.default_rng(seed)
    windows, answers, clean = [], [], []
    for n in fit:
        words = lower[n]
        marks = [bool(labels[n]) and toxic_word[w] for w in words]
        for start in range(0, len(words), WINDOW):
            part = (words[start : start + WINDOW], marks[start : start + WINDOW])
            if any(part[1]):
                windows.append(part[0])
                answers.append(part[1])
            elif not labels[n]:
                clean.append(part[0])
    for at in rng.permutation(len(clean))[:clean_windows]:
        windows.append(clean[at])
        answers.append([False] * len(clean[at]))
    field = _fit_field([[known[w] for w in words] for words in windows], answers)
    emission = Scores(lambda w: field.bias + field.emission[known[w]].sum())
    values = [np.array([emission[w] for w in lower[n]]) for n in curve]
    field.curve = fit_logistic(_summaries(values, field.transition)[0], labels[curve])
    return field


def marginals(values: list[np.ndarray], transition: np.ndarray) -> list[np.ndarray]:
    """Log-odds of the toxic state at every word of every sequence, given all its words.

    A long sequence is cut into segments, each with so many words of context on both
    sides that what lies beyond them changes no odds by more than rounding does: every
    word shrinks that influence by the factor tanh(d / 4), d being the log-ratio of the
    products of transition weights.
    """
    ratio = abs(transition[0, 0] + transition[1, 1] - transition[0, 1] - transition[1, 0])
    context = int(np.ceil(45 / -np.log(np.tanh(max(ratio, 0.01) / 4) + 1e-300))) if ratio < 60 else 1 << 40
    pieces, owners = [], []
    for n, sequence in enumerate(values):
        for start in range(0, max(len(sequence), 1), SEGMENT):
            low = max(0, start - context)
            pieces.append(sequence[low : start + SEGMENT + context])
            owners.append((n, start - low, min(SEGMENT, len(sequence) - start)))
    result: list[list[np.ndarray]] = [[] for _ in values]
    for (n, skip, size), odds in zip(owners, _in_step(pieces, transition)):
        result[n].append(odds[skip : skip + size])
    return [r[0] if len(r) == 1 else np.concatenate(r) for r in result]


def _in_step(values: list[np.ndarray], transition: np.ndarray) -> list[np.ndarray]:
    """Forward and backward messages as odds, all sequences in step, the longest first."""
    order = sorted(range(len(values)), key=lambda n: -len(values[n]))
    lengths = np.array([len(values[n]) for n in order], np.int64)
    starts = np.cumsum(lengths) - lengths
    flat = np.exp(np.clip(np.concatenate([values[n] for n in order] or [np.zeros(0)]), -30, 30))
    (t00, t01), (t10, t11) = np.exp(transition)
    forward, backward = np.empty_like(flat), np.ones_like(flat)
    longest = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(longest), "left")  # longer than t
    for t in range(longest):
        at = starts[: active[t]] + t
        if t == 0:
            forward[at] = flat[at]
        else:
            odds = forward[at - 1]
            forward[at] = flat[at] * (t01 + odds * t11) / (t00 + odds * t10)
    for t in range(longest - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        odds = flat[at + 1] * backward[at + 1]
        backward[at] = (t10 + t11 * odds) / (t00 + t01 * odds)
    result = np.log(forward) + np.log(backward)
    split: list[np.ndarray] = [np.zeros(0)] * len(values)
    for n, start, length in zip(order, starts, lengths):
        split[n] = result[start : start + length]
    return split


def score_documents(
    documents: DataFrame,
    field: Field | None,
    key: str = "doc_id",
    text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """key, score, predicted, toxic_words and spans of every whole text.

    ``keep`` names columns to carry along; one named like a result gives way to it.

    ``spans`` holds (start, end, probability), offsets in characters, of each run of
    words that are more likely toxic than not. No shuffle. Null text is empty; the empty
    text is scored like any other and has no spans; a null key and repeated rows
    stay; other columns are ignored. Without a field every score is 0.
    """
    span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("probability", pa.float64())])
    types = {
        "id": pa.int64(),
        "score": pa.float64(),
        "toxic_words": pa.int64(),
        "spans": pa.list_(span),
    }
    ddl = (
        f"{kept_ddl(documents, keep)}id BIGINT, score DOUBLE, toxic_words BIGINT, "
        "spans ARRAY<STRUCT<start: BIGINT, end: BIGINT, probability: DOUBLE>>"
    )
    sent = documents.sparkSession.sparkContext.broadcast(field)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        mask = (1 << BITS) - 1

        def weight(word: str) -> float:
            return field.bias + sum(field.emission[word_hash(f) & mask] for f in features(word))

        emission = Scores(weight)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if field is None:
                columns = ([0.0] * len(texts), [0] * len(texts), [[]] * len(texts))
            else:
                values = [
                    np.array([emission[w] for w in WORD.findall(t)], np.float64) for t in texts
                ]
                summary, odds = _summaries(values, field.transition)
                scores = logistic(summary @ field.curve[:-1] + field.curve[-1])
                found = [_spans(t, o) for t, o in zip(texts, odds)]
                columns = (scores, [int((o > 0).sum()) for o in odds], found)
            found = record_batch(dict(zip(types, (batch.column("id"), *columns))), types)
            yield with_kept(batch, keep, found)

    scored = identified(documents, key, text, keep).mapInArrow(score, ddl)
    result = {
        key: F.col("id"),
        "score": F.col("score"),
        "predicted": (F.col("score") >= THRESHOLD).cast("int"),
        "toxic_words": F.col("toxic_words"),
        "spans": F.col("spans"),
    }
    return named(scored, keep, result)


def toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labelled documents outside the held-out fold, score all.

    Adds ``held_out`` to the columns of ``score_documents``; a null doc_id is in no fold.
    """
    field = learnt(train, labelled_sample(documents, labels, "toxic", FOLDS, HELD_OUT))
    return score_documents(documents, field).withColumn(
        "held_out", in_fold("doc_id", FOLDS, HELD_OUT)
    )


def _labelled_features(documents: list[list[str]], labels: np.ndarray) -> set[str]:
    toxic, clean = Counter(), Counter()
    for words, label in zip(documents, labels):
        seen = {f for w in set(words) for f in features(w)}
        (toxic if label else clean).update(seen)
    sizes = labels.sum(), len(labels) - labels.sum()

    def lowest_ratio(found: tuple[int, int]) -> float:
        there = [n + SMOOTHED for n in found]
        lacking = [size - n + SMOOTHED for size, n in zip(sizes, found)]
        ratio = np.log(there[0] / lacking[0]) - np.log(there[1] / lacking[1])
        return ratio - DEVIATIONS * np.sqrt(sum(1 / n for n in (*there, *lacking)))

    return {f for f, n in toxic.items() if lowest_ratio((n, clean[f])) >= np.log(LEAST_RATIO)}


def _fit_field(windows: list[list[list[int]]], answers: list[list[bool]]) -> Field:
    """Full-gradient ascent of the likelihood with per-weight step sizes."""
    lengths = np.array([len(w) for w in windows], np.int64)
    starts = np.cumsum(lengths) - lengths
    words = [f for window in windows for f in window]
    counts = np.array([len(f) for f in words], np.int64)
    index = np.fromiter((x for f in words for x in f), np.int64, int(counts.sum()))
    edges = np.cumsum(counts) - counts
    wanted = np.array([a for window in answers for a in window], np.float64)
    inner = np.ones(len(wanted), bool)
    inner[starts] = False
    after = np.flatnonzero(inner)
    emission, bias, transition = np.zeros(1 << BITS), -2.0, np.zeros((2, 2))
    squares = [np.full(1 << BITS, 1e-8), 1e-8, np.full((2, 2), 1e-8)]
    pairs = np.zeros((2, 2))
    np.add.at(pairs, (wanted[after - 1].astype(int), wanted[after].astype(int)), 1)
    for _ in range(STEPS):
        score = bias + np.add.reduceat(emission[index], edges)
        expected, joint = _expectations(score, starts, lengths, transition)
        error = wanted - expected
        steps = (
            np.bincount(index, np.repeat(error, counts), 1 << BITS) - RIDGE * emission * len(wanted) / 100,
            error.sum(),
            pairs - joint,
        )
        for n, step in enumerate(steps):
            squares[n] = squares[n] + step * step
        emission += RATE * steps[0] / np.sqrt(squares[0])
        bias += RATE * steps[1] / np.sqrt(squares[1])
        transition = transition + RATE * steps[2] / np.sqrt(squares[2])
    return Field(emission, float(bias), transition - transition[0, 0], np.zeros(3))


def _expectations(score, starts, lengths, transition):
    """Marginals of each word and summed marginals of each pair of neighbours."""
    values = np.split(score, starts[1:])
    odds = np.concatenate(marginals(values, transition))
    expected = logistic(odds)
    # P(next toxic | state) needs the backward message, which follows from both odds.
    weight = np.exp(transition)
    forward = np.exp(np.clip(score, -30, 30))
    longest = int(lengths.max())
    for t in range(1, longest):
        at = starts[lengths > t] + t
        before = forward[at - 1]
        forward[at] *= (weight[0, 1] + before * weight[1, 1]) / (weight[0, 0] + before * weight[1, 0])
    joint = np.zeros((2, 2))
    inner = np.ones(len(score), bool)
    inner[starts] = False
    after = np.flatnonzero(inner)
    ahead = np.exp(np.clip(score[after] + odds[after] - np.log(forward[after]), -60, 60))
    cells = [
        [np.full(len(after), weight[0, 0]), weight[0, 1] * ahead],
        [weight[1, 0] * forward[after - 1], weight[1, 1] * forward[after - 1] * ahead],
    ]
    total = sum(c for row in cells for c in row)
    for a in (0, 1):
        for b in (0, 1):
            joint[a, b] = (cells[a][b] / total).sum()
    return expected, joint


def _summaries(values: list[np.ndarray], transition: np.ndarray):
    """Per text: the largest log-odds and the log of the sum of probabilities."""
    odds = marginals(values, transition)
    summary = np.empty((len(values), 2))
    for n, o in enumerate(odds):
        summary[n] = (o.max(), np.log(logistic(o).sum() + 1e-4)) if len(o) else (-12.0, np.log(1e-4))
    return np.clip(summary, -12, 12), odds


def _spans(text: str, odds: np.ndarray) -> list[dict]:
    if not (odds > 0).any():
        return []
    places = [m.span() for m in WORD.finditer(text)]
    hit = np.concatenate([[False], odds > 0, [False]])
    edges = np.flatnonzero(hit[1:] != hit[:-1])
    return [
        {"start": places[a][0], "end": places[b - 1][1], "probability": float(logistic(odds[a:b].max()))}
        for a, b in zip(edges[::2], edges[1::2])
    ]
