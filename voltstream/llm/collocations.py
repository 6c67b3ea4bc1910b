"""Phrase collocations from depth-truncated suffix subtrees, one group of prefixes at a time.

Every word of a text starts a suffix, cut after ``depth`` words or at the end of its
piece. Vertical partitioning first finds prefixes that a task can hold: a word is a
prefix, and one that may occur more often than the memory budget is replaced by its
extensions by one word, again and again. No phrase occurs more often than any of its
words, so the words over budget tell which: a prefix is as many of them as stand in a
row, and the word after them. Prefixes are dealt to groups, a task each, and the subtree of
each prefix is built independently of all others. The count of a phrase is the sum of the
leaves below it.

Each map task combines the suffixes of a chunk of text before they are shuffled: a row
is one prefix in one chunk, with all its continuations. A word with a third of all
occurrences is thus a row per chunk, and beyond the budget is split by its next words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voltstream.llm.common import settled, text_or_empty

DEPTH = 4
LEAST = 30
TOP = 2000
# A candidate goes if a longer one has so many percent of its occurrences.
COVERED_PERCENT = 80
SCORE_SCALE = 2_000_000
NO_LANG = "und"

# Occurrences of a prefix that one task builds a subtree of, and so that small corpora are
# dealt alike, no more than this part of all.
BUDGET = 1_000_000
LEAST_PARTS = 128
# No more words than this are over budget, which rises where a corpus is so large that
# they would be more. It bounds what is sent to every task.
MOST_EXTENDED = 500_000
# Text that a map task combines at a time.
CHUNK_BYTES = 8 << 20
# Bits of the filter of frequent words, 8 MB. Words that share a bit are counted in
# vain, so a full filter costs time and changes no result.
FILTER_BITS = 1 << 26

# What ends a piece and what parts words.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
BLANKS = b" \t"

COUNTED = {"lang": pa.string(), "phrase": pa.string(), "n": pa.int64()}
COUNTED_DDL = "lang STRING, phrase STRING, n BIGINT"
ROWS = ("lang", "prefix", "leaves", "repeated")
ROWS_DDL = "lang STRING, prefix STRING, leaves STRING, repeated STRING"


def _byte_tables() -> tuple[bytes, np.ndarray]:
    lower = bytearray(range(256))
    for code in range(ord("A"), ord("Z") + 1):
        lower[code] = code + 32
    kinds = np.zeros(256, np.uint8)
    kinds[list(BLANKS)] = 1
    kinds[list(BREAKS)] = 2
    return bytes(lower), kinds


LOWER, KINDS = _byte_tables()


@dataclass(frozen=True)
class Chunk:
    """The words of some texts of one language, as numbers into ``words``.

    ``piece`` numbers the piece of every word, so that no phrase crosses its end.
    """

    lang: str
    words: pa.Array
    ids: np.ndarray
    piece: np.ndarray

    @classmethod
    def of(cls, lang: str, texts: list[bytes]) -> Chunk:
        data = np.frombuffer(b"\n".join(texts).translate(LOWER), np.uint8)
        kinds = KINDS[data]
        inside = np.concatenate(([False], kinds == 0, [False]))
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        offsets = np.zeros(len(starts) + 1, np.int32)
        np.cumsum(ends - starts, out=offsets[1:])
        letters = np.ascontiguousarray(data[kinds == 0])
        found = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
        coded = found.dictionary_encode()
        piece = np.cumsum(kinds == 2, dtype=np.int32)[starts]
        return cls(lang, coded.dictionary, coded.indices.to_numpy(), piece)

    def suffixes(self, depth: int, frequent: np.ndarray | None = None) -> np.ndarray:
        """A column per word: the numbers of it and its followers, -1 beyond the end.

        A word that is not ``frequent`` ends the suffixes before it and starts none.
        """
        ids = self.ids if frequent is None else np.where(frequent[self.ids], self.ids, -1)
        found = np.full((depth, len(ids)), -1, np.int32)
        found[0] = ids
        for k in range(1, min(depth, len(ids))):
            going = (found[k - 1, :-k] >= 0) & (self.piece[k:] == self.piece[:-k])
            found[k, :-k] = np.where(going, ids[k:], -1)
        return found

    def spelled(self, suffixes: np.ndarray) -> pa.Array:
        """The words of every suffix, joined by blanks."""
        found: pa.Array = pa.repeat(pa.scalar(""), suffixes.shape[1])
        for k, ids in enumerate(suffixes):
            there = pa.array(ids >= 0)
            words = pc.if_else(there, self.words.take(pa.array(np.maximum(ids, 0))), pa.scalar(""))
            found = pc.if_else(there, pc.binary_join_element_wise(found, words, " "), found) if k else words
        return found


def combined(suffixes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct suffixes in order, how often each occurs)."""
    if not suffixes.shape[1]:
        return suffixes, np.zeros(0, np.int64)
    keys = np.zeros((len(suffixes) + 1 >> 1, suffixes.shape[1]), np.int64)
    for k, ids in enumerate(suffixes):
        keys[k >> 1] *= width + 1
        keys[k >> 1] += ids + 1
    order = np.lexsort(keys[::-1])
    keys = keys[:, order]
    first = np.flatnonzero(np.concatenate(([True], (keys[:, 1:] != keys[:, :-1]).any(axis=0))))
    return suffixes[:, order[first]], np.diff(np.append(first, suffixes.shape[1]))


def chunks(batches: Iterable[pa.RecordBatch], size: int) -> Iterator[Chunk]:
    """The texts of a task as chunks of one language, of ``size`` bytes or one text."""
    waiting: dict[str, list[bytes]] = {}
    held: Counter[str] = Counter()
    for batch in batches:
        for lang, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            waiting.setdefault(lang, []).append(text)
            held[lang] += len(text)
            if held[lang] >= size or held.total() >= 2 * size:
                fullest = max(held, key=held.__getitem__)
                yield Chunk.of(fullest, waiting.pop(fullest))
                del held[fullest]
    for lang, texts in waiting.items():
        yield Chunk.of(lang, texts)


def count_words(texts: DataFrame, size: int = CHUNK_BYTES) -> DataFrame:
    """(lang, phrase, n) of all words."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in chunks(batches, size):
            counts = np.bincount(chunk.ids, minlength=len(chunk.words))
            lang = pa.repeat(pa.scalar(chunk.lang), len(counts))
            yield pa.record_batch([lang, chunk.words, pa.array(counts)], names=list(COUNTED))

    return texts.mapInArrow(count, COUNTED_DDL).groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


Word = tuple[str, str]


def prefix_lengths(suffixes: np.ndarray, over: np.ndarray) -> np.ndarray:
    """How many words of each suffix are its prefix: those over budget, and the next one.

    ``over`` tells for every number whether its word is over budget.
    """
    lengths = np.ones(suffixes.shape[1], np.int8)
    for k in range(len(suffixes) - 1):
        lengths += (lengths == k + 1) & (suffixes[k] >= 0) & over[suffixes[k]]
    return lengths


def prefix_rows(
    texts: DataFrame, over_budget: set[Word], frequent: bytes, depth: int = DEPTH, size: int = CHUNK_BYTES
) -> DataFrame:
    """(lang, prefix, leaves, repeated): the suffixes of a chunk by prefix.

    ``leaves`` has a line for every suffix that occurs once in the chunk, what follows
    the prefix; ``repeated`` one for every other, with a tab and its count. A prefix
    that was extended has a row with its own count and nothing below it. Suffixes of one
    word add nothing to the known counts of words and are left out.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(frequent, np.uint8)
        for chunk in chunks(batches, size):
            words = chunk.words.to_pylist()
            over = np.array([(chunk.lang, w) in over_budget for w in words], bool)
            suffixes = chunk.suffixes(depth, in_filter(bits, chunk.lang, words))
            suffixes, counts = combined(suffixes[:, suffixes[1] >= 0], len(words))
            lengths = prefix_lengths(suffixes, over)
            for length in range(1, depth + 1):
                own = np.flatnonzero((lengths == length) & (suffixes[length - 1] >= 0))
                if len(own):
                    yield _prefix_batch(chunk, suffixes[:, own], counts[own], length)
                # Longer than a word and extended: counted here.
                shorter = np.flatnonzero((lengths > length) & (length > 1))
                if len(shorter):
                    yield _count_batch(chunk, suffixes[:length, shorter], counts[shorter])

    return texts.mapInArrow(deal, ROWS_DDL)


def _starts(heads: np.ndarray) -> np.ndarray:
    """Where another head begins in suffixes that are in order."""
    return np.flatnonzero(np.concatenate(([True], (heads[:, 1:] != heads[:, :-1]).any(axis=0))))


def _prefix_batch(chunk: Chunk, suffixes: np.ndarray, counts: np.ndarray, length: int) -> pa.RecordBatch:
    first = _starts(suffixes[:length])
    tails = chunk.spelled(suffixes[length:])
    again = counts > 1
    columns = []
    for chosen, lines in (
        (~again, tails),
        (again, pc.binary_join_element_wise(tails, pa.array(counts).cast(pa.string()), "\t")),
    ):
        edges = np.append(0, np.cumsum(chosen))[np.append(first, len(counts))].astype(np.int32)
        columns.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(edges), lines.filter(pa.array(chosen))), "\n"))
        # No lines is null, one line of nothing is empty.
        columns[-1] = pc.if_else(pa.array(np.diff(edges) > 0), columns[-1], pa.scalar(None, pa.string()))
    lang = pa.repeat(pa.scalar(chunk.lang), len(first))
    return pa.record_batch([lang, chunk.spelled(suffixes[:length, first]), *columns], names=list(ROWS))


def _count_batch(chunk: Chunk, heads: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    first = _starts(heads)
    sums = np.add.reduceat(counts, first)
    lines = pc.binary_join_element_wise(pa.repeat(pa.scalar(""), len(sums)), pa.array(sums).cast(pa.string()), "\t")
    lang, none = pa.repeat(pa.scalar(chunk.lang), len(first)), pa.nulls(len(first), pa.string())
    return pa.record_batch([lang, chunk.spelled(heads[:, first]), none, lines], names=list(ROWS))


def subtree(leaves: list[str], repeated: dict[str, int], least: int) -> Iterator[tuple[str, int]]:
    """(phrase below the root, count) of all with ``least`` occurrences.

    ``leaves`` occur once each, ``repeated`` as often as they say. Branches are followed
    only as far as they are frequent enough.
    """
    heads = [line.partition(" ")[0] for line in leaves]
    branches = Counter(heads)
    for line, n in repeated.items():
        branches[line.partition(" ")[0]] += n
    inner: dict[str, tuple[list[str], dict[str, int]]] = {
        word: ([], {}) for word, n in branches.items() if word and n >= least
    }
    if not inner:
        return
    for line, head in zip(leaves, heads):
        if head in inner and len(line) > len(head):
            inner[head][0].append(line[len(head) + 1 :])
    for line, n in repeated.items():
        head, _, rest = line.partition(" ")
        if rest and head in inner:
            inner[head][1][rest] = n
    for word, (once, more) in inner.items():
        yield word, branches[word]
        if len(once) + len(more) and len(once) + sum(more.values()) >= least:
            for rest, n in subtree(once, more, least):
                yield f"{word} {rest}", n


def count_phrases(rows: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, n) from the subtrees of all prefixes.

    Rows of one prefix meet in one task, which holds one prefix at a time.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[str, str, int]] = []
        for (lang, prefix), leaves, repeated in _by_prefix(batches):
            total = len(leaves) + sum(repeated.values())
            if total < least:
                continue
            if " " in prefix:
                found.append((lang, prefix, total))
            found += ((lang, f"{prefix} {rest}", n) for rest, n in subtree(leaves, repeated, least))
            if len(found) >= 10_000:
                yield _counted(found)
                found = []
        yield _counted(found)

    return rows.repartition("lang", "prefix").sortWithinPartitions("lang", "prefix").mapInArrow(build, COUNTED_DDL)


def _by_prefix(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Word, list[str], Counter[str]]]:
    """Each prefix with its leaves and its repeated leaves, which the rows have in order."""
    now: Word | None = None
    leaves: list[str] = []
    repeated: Counter[str] = Counter()
    for batch in batches:
        for lang, prefix, once, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (lang, prefix) != now:
                if now is not None:
                    yield now, leaves, repeated
                now, leaves, repeated = (lang, prefix), [], Counter()
            if once is not None:
                leaves += once.split("\n")
            if more is not None:
                for line in more.split("\n"):
                    tail, _, times = line.partition("\t")
                    repeated[tail] += int(times)
    if now is not None:
        yield now, leaves, repeated


def _counted(rows: list[tuple[str, str, int]]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else ((),) * len(COUNTED)
    return pa.record_batch([pa.array(c, t) for c, t in zip(columns, COUNTED.values())], names=list(COUNTED))


def word_filter(words: DataFrame) -> bytes:
    """A bit for the hash of every (lang, phrase); ``FILTER_BITS`` whatever there is."""
    bit = F.pmod(F.xxhash64("lang", "phrase"), F.lit(FILTER_BITS))
    bits = words.select(bit.alias("bit")).groupBy((F.col("bit") / F.lit(1 << 15)).cast("int").alias("part"))
    parts = bits.agg(F.bitmap_construct_agg(F.pmod("bit", F.lit(1 << 15))).alias("bits")).collect()
    whole = bytearray(FILTER_BITS // 8)
    for row in parts:
        whole[row.part << 12 : (row.part + 1) << 12] = row.bits
    return bytes(whole)


def in_filter(bits: np.ndarray, lang: str, words: list[str]) -> np.ndarray:
    """Which words may be in the filter. Hashes as Spark's ``xxhash64(lang, phrase)``."""
    seed = xxhash.xxh64_intdigest(lang, seed=42)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed=seed) for w in words), np.uint64, len(words))
    at = hashes % np.uint64(FILTER_BITS)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def phrase_counts(
    documents: DataFrame,
    depth: int = DEPTH,
    least: int = LEAST,
    budget: int = BUDGET,
    size: int = CHUNK_BYTES,
    text: str = "text",
    lang: str = "lang",
) -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, n) of phrases of 1 to ``depth`` words with ``least`` occurrences, (lang, words) of all words).

    Both are written to the shared folder. Null texts are empty, a null language is
    ``und``; ids, other columns and the order of rows do not matter and repeated rows
    count each. Empty tables give empty results. A text is taken whole, at some twenty
    times its size in memory.
    """
    texts = documents.select(
        F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(NO_LANG)).alias("lang"),
        F.encode(text_or_empty(F.col(f"`{text}`")), "UTF-8").alias("text"),
    )
    words = settled(count_words(texts, size), "words")
    totals = settled(words.groupBy("lang").agg(F.sum("n").alias("words")), "word-totals")
    total = totals.agg(F.sum("words")).first()[0] or 0
    # At most the memory of a task, and a small share of the corpus where that is less.
    limit = max(min(budget, total // LEAST_PARTS + 1), total // MOST_EXTENDED)
    over = {(r.lang, r.phrase) for r in words.where(F.col("n") > limit).select("lang", "phrase").collect()}
    frequent = words.where(F.col("n") >= least)
    rows = prefix_rows(texts, over, word_filter(frequent), depth, size)
    return settled(count_phrases(rows, least).unionByName(frequent), "phrases"), totals


def collocations(
    documents: DataFrame,
    top: int = TOP,
    depth: int = DEPTH,
    least: int = LEAST,
    covered_percent: int = COVERED_PERCENT,
    budget: int = BUDGET,
    size: int = CHUNK_BYTES,
    text: str = "text",
    lang: str = "lang",
) -> DataFrame:
    """The best-bound phrases of every language: lang, rank, phrase, a, l, r, n, score.

    A phrase of 2 to ``depth`` words with a >= ``least`` occurrences is cut where its
    parts bind least, score = floor(2000000 a / (l + r)); phrases that lie inside a
    longer candidate with most of their occurrences go. See ``phrase_counts`` for odd
    rows. Ties go by a, then by the bytes of the phrase.
    """
    counts, totals = phrase_counts(documents, depth, least, budget, size, text, lang)
    candidates = counts.where(F.instr("phrase", " ") > 0).select(
        "lang", "phrase", F.split("phrase", " ").alias("words"), F.col("n").alias("a")
    )
    scored = settled(_scored(candidates, counts), "scored")
    inside = candidates.select("lang", F.col("a").alias("longer"), F.explode(_inner(F.col("words"))).alias("phrase"))
    covering = inside.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    kept = (
        scored.join(covering, ["lang", "phrase"], "left")
        .where(F.col("longer").isNull() | (exact("longer") * 100 < exact("a") * covered_percent))
        .drop("longer")
    )
    best = _top(kept, top)
    # One row per language.
    named = best.join(totals.select("lang", F.col("words").alias("n")), "lang")
    return named.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _scored(candidates: DataFrame, counts: DataFrame) -> DataFrame:
    """Candidates with l, r and score of their weakest cut.

    Both parts of every cut look up their counts in one join; Spark may split the rows
    of a word that begins or ends many phrases.
    """
    words = F.col("words")
    spell = lambda part: F.array_join(part, " ")
    cuts = F.flatten(
        F.transform(
            F.sequence(F.lit(1), F.size(words) - 1),
            lambda k: F.array(
                F.struct(k.alias("k"), F.lit(True).alias("left"), spell(F.slice(words, 1, k)).alias("part")),
                F.struct(
                    k.alias("k"), F.lit(False).alias("left"), spell(F.slice(words, k + 1, F.size(words) - k)).alias("part")
                ),
            ),
        )
    )
    parts = candidates.select("lang", "phrase", "a", F.inline(cuts))
    looked = parts.join(counts.select("lang", F.col("phrase").alias("part"), "n"), ["lang", "part"])
    sides = looked.groupBy("lang", "phrase", "a", "k").agg(
        F.max(F.when(F.col("left"), F.col("n"))).alias("l"), F.max(F.when(~F.col("left"), F.col("n"))).alias("r")
    )
    score = F.expr(
        f"CAST(a AS DECIMAL(20,0)) * CAST({SCORE_SCALE} AS DECIMAL(7,0)) "
        "div (CAST(l AS DECIMAL(20,0)) + CAST(r AS DECIMAL(20,0)))"
    )
    weakest = F.min(F.struct(score.alias("score"), F.col("k"), F.col("l"), F.col("r"))).alias("cut")
    return sides.groupBy("lang", "phrase", "a").agg(weakest).select(
        "lang", "phrase", "a", "cut.l", "cut.r", F.col("cut.score").cast("bigint").alias("score")
    )


def _inner(words: Column) -> Column:
    """The phrases of two words or more that lie inside a longer one, each once."""
    lengths = F.when(F.size(words) > 2, F.sequence(F.lit(2), F.size(words) - 1)).otherwise(F.array().cast("array<int>"))
    every = F.transform(
        lengths,
        lambda n: F.transform(
            F.sequence(F.lit(1), F.size(words) - n + 1), lambda at: F.array_join(F.slice(words, at, n), " ")
        ),
    )
    return F.array_distinct(F.flatten(every))


def _top(scored: DataFrame, top: int) -> DataFrame:
    """The first ``top`` per language with their ranks.

    A language may have any number of candidates: each of 1,024 parts of it keeps its
    first ones, then each of 32 parts of those, so no task ranks more than 32 * top rows
    in the end.
    """
    best = (F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    part = F.pmod(F.xxhash64("phrase"), F.lit(1024))
    left = scored.withColumn("part", part.cast("int"))
    for keys in (["lang", "part"], ["lang", "part"], ["lang"]):
        ranked = left.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*best)))
        left = ranked.where(F.col("rank") <= top).withColumn("part", F.pmod("part", F.lit(32)))
    return left.drop("part").withColumn("rank", F.col("rank").cast("bigint"))
