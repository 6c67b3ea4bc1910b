"""License notices in texts: exact phrases, and short notices with a few errors.

Words are joined by single spaces. A notice may differ from its standard wording by
``k`` edits, k being a share of its length. Split into k + 1 parts, at least one part
of it then stands unchanged (pigeonhole); an Aho-Corasick automaton finds all parts in
one pass. Around each hit the ``regex`` library's bounded-error matching decides, and
gives the span and the number of edits.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator, Mapping
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import identified, record_batch

# Fixed value: words are runs of ASCII letters and digits and of all that is not ASCII.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

# Phrases that count wherever their words stand side by side.
PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}
# Notices and their labels, found with errors.
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "licensed under cc by 4 0": "cc-by",
    "creative commons attribution": "cc-by",
    "redistribution and use in source and binary forms": "bsd",
    "mozilla public license version 2 0": "mpl-2.0",
    "all rights reserved": "reserved",
    "released into the public domain": "public-domain",
}
# Edits allowed per character of a notice.
ERRORS = 0.1


class Scanner:
    """Phrases and notices, ready to search."""

    def __init__(self, phrases: Mapping[str, str], notices: Mapping[str, str], errors: float):
        self.phrases = [(p, label, len(p)) for p, label in phrases.items()]
        self.seeds = ahocorasick.Automaton()
        self.notices = []
        parts: dict[str, list[tuple[int, int]]] = {}
        for number, (notice, label) in enumerate(notices.items()):
            edits = int(len(notice) * errors)
            pattern = f"({regex.escape(notice, literal_spaces=True)}){{e<={edits}}}"
            self.notices.append((label, len(notice), edits, regex.compile(pattern), regex.compile(f"(?b){pattern}")))
            edges = [len(notice) * n // (edits + 1) for n in range(edits + 2)]
            for low, high in zip(edges, edges[1:]):
                parts.setdefault(notice[low:high], []).append((number, low))
        for part, places in parts.items():
            self.seeds.add_word(part, (len(part), places))
        if parts:
            self.seeds.make_automaton()

    def exact(self, joined: str) -> list[tuple[int, str]]:
        """(character, label) of every place of every phrase; places may overlap."""
        found = []
        padded = f" {joined} "
        for phrase, label, _ in self.phrases:
            at = padded.find(f" {phrase} ")
            while at >= 0:
                found.append((at, label))
                at = padded.find(f" {phrase} ", at + 1)
        return found

    def fuzzy(self, joined: str) -> list[tuple[int, int, str, int]]:
        """(start, end, label, edits) of every notice within its edits, without overlaps.

        Windows around the seeds of one notice are joined where they overlap, so each
        stretch of text is searched once per notice, from left to right and never far
        ahead: the work grows with the stretch, also if it is one notice after another.
        """
        windows: dict[int, list[list[int]]] = {}
        if len(self.seeds):
            for last, (size, places) in self.seeds.iter(joined):
                start = last - size + 1
                for number, low in places:
                    _, length, edits, *_ = self.notices[number]
                    begin = max(0, start - low - edits)
                    end = min(len(joined), start - low + length + edits)
                    own = windows.setdefault(number, [])
                    if own and begin <= own[-1][1]:
                        own[-1][0], own[-1][1] = min(begin, own[-1][0]), max(end, own[-1][1])
                    else:
                        own.append([begin, end])
        found = []
        for number, spans in windows.items():
            label, length, edits, *patterns = self.notices[number]
            for begin, end in spans:
                for match in _matches(*patterns, length + edits, 2 * edits, joined, begin, end):
                    found.append((match.start(), match.end(), label, sum(match.fuzzy_counts)))
        # Of notices that overlap, the one with the fewest edits stands. Those that stand
        # lie apart, so only the next ones on both sides can overlap another.
        kept: list[tuple[int, int, str, int]] = []
        for one in sorted(found, key=lambda f: (f[3], f[0] - f[1], f)):
            at = bisect_left(kept, one)
            if (at == 0 or kept[at - 1][1] <= one[0]) and (at == len(kept) or kept[at][0] >= one[1]):
                insort(kept, one)
        return kept


def _matches(
    first: regex.Pattern, best: regex.Pattern, width: int, slack: int, text: str, begin: int, end: int
) -> Iterator[regex.Match]:
    """Matches that lie apart, with none left between them.

    ``first`` finds the leftmost place, ``best`` the place with the fewest edits; no match
    is longer than ``width``. Where a match begins, the best one that begins at most
    ``slack`` later is taken, and what is left of that is searched too.
    """
    at, step = begin, 4 * width
    while at < end:
        ahead = first.search(text, at, min(end, at + step))
        if not ahead:
            # A match that begins in the last ``width`` characters may be cut off.
            at += step - width
            continue
        start = ahead.start()
        near = best.search(text, start, min(end, start + slack + width))
        if near.start() <= start + slack:
            yield from _around(best, text, start, near.start())
            yield near
            at = near.end()
            continue
        # The best one begins late and may be cut off: take what stands before it.
        before = list(_around(best, text, start, near.start()))
        yield from before
        at = max([start + 1, near.start() - width, *(m.end() for m in before)])


def _around(best: regex.Pattern, text: str, begin: int, end: int) -> Iterator[regex.Match]:
    """The best match of a short stretch, then those of what is left and right of it."""
    waiting = [(begin, end)]
    while waiting:
        low, high = waiting.pop()
        match = best.search(text, low, high) if low < high else None
        if match:
            yield match
            waiting += [(match.end(), high), (low, match.start())]


@lru_cache(maxsize=4)
def _scanner(phrases: tuple, notices: tuple, errors: float) -> Scanner:
    return Scanner(dict(phrases), dict(notices), errors)


def scan_licenses(
    frame: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    notices: Mapping[str, str] = NOTICES,
    errors: float = ERRORS,
) -> DataFrame:
    """Licenses of every whole text.

    Gives key, n_words, n_base, first_word and last_word (of the exact phrases),
    base_labels, labels (with those of the notices), score, and ``notices``: start and end
    character in the text, label and edits. The score is 0 without any, 1 with an exact
    phrase or an unchanged notice, and falls with the best notice's edits.

    No shuffle. Null text is empty and has no licenses; a null key and repeated rows
    stay; other columns are ignored.
    """
    notice = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("edits", pa.int32())])
    types = {
        "id": pa.int64(),
        "n_words": pa.int64(),
        "n_base": pa.int64(),
        "first_word": pa.int64(),
        "last_word": pa.int64(),
        "base_labels": pa.string(),
        "labels": pa.string(),
        "score": pa.float64(),
        "notices": pa.list_(notice),
    }
    ddl = (
        "id BIGINT, n_words BIGINT, n_base BIGINT, first_word BIGINT, last_word BIGINT, "
        "base_labels STRING, labels STRING, score DOUBLE, "
        "notices ARRAY<STRUCT<start: BIGINT, end: BIGINT, label: STRING, edits: INT>>"
    )
    wanted = (tuple(phrases.items()), tuple(notices.items()), errors)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(*wanted)
        for batch in batches:
            rows = [
                (id_, *scan_text(scanner, text_))
                for id_, text_ in zip(*(c.to_pylist() for c in batch.columns), strict=True)
            ]
            columns = zip(*rows) if rows else ((),) * len(types)
            yield record_batch(dict(zip(types, columns)), types)

    return identified(frame, key, text).mapInArrow(scan, ddl).withColumnRenamed("id", key)


def scan_text(scanner: Scanner, text: str) -> tuple:
    """The values of ``scan_licenses`` for one text."""
    lower = text.translate(_LOWER)
    words = WORD.findall(lower)
    joined = " ".join(words)
    base, near = scanner.exact(joined), scanner.fuzzy(joined)
    blanks = [m.start() for m in re.finditer(" ", joined)] if base or near else []
    places = [bisect_left(blanks, at) for at, _ in base]
    labels = {label for _, label in base}
    best = max([1.0] * bool(base) + [1 - edits / (end - start) for start, end, _, edits in near], default=0.0)
    return (
        len(words),
        len(base),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(labels | {label for _, _, label, _ in near})),
        max(0.0, best),
        _in_text(lower, blanks, near),
    )


def _in_text(text: str, blanks: list[int], near: list[tuple[int, int, str, int]]) -> list[dict]:
    """The spans of notices as characters of the text, widened to whole words."""
    if not near:
        return []
    places = [m.span() for m in WORD.finditer(text)]
    return [
        {
            "start": places[bisect_left(blanks, start)][0],
            "end": places[min(bisect_left(blanks, end), len(places) - 1)][1],
            "label": label,
            "edits": edits,
        }
        for start, end, label, edits in near
    ]
