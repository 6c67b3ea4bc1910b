"""Neighbouring copies of license notices, against brute force."""

import random
import time

import pytest

from voltstream.llm.licenses import ERRORS, NOTICES, PHRASES, Scanner, scan_text


def fewest_edits(notice, text):
    """The least edit distance of the notice to any part of the text."""
    row = [0] * (len(text) + 1)
    for n, letter in enumerate(notice, 1):
        before, row = row, [n]
        for m, other in enumerate(text, 1):
            row.append(min(before[m - 1] + (letter != other), before[m] + 1, row[-1] + 1))
    return min(row)


def distance(left, right):
    row = list(range(len(right) + 1))
    for n, letter in enumerate(left, 1):
        before, row = row, [n]
        for m, other in enumerate(right, 1):
            row.append(min(before[m - 1] + (letter != other), before[m] + 1, row[-1] + 1))
    return row[-1]


def edited(rng, notice, edits):
    letters = list(notice)
    for at in sorted(rng.sample(range(1, len(letters) - 1), edits), reverse=True):
        letters[at : at + 1] = rng.choice([[], ["q"], [letters[at], "q"]])
    return "".join(letters)


def test_worse_copies_beside_better_ones_are_found():
    scanner = Scanner({}, NOTICES, ERRORS)
    two = scanner.fuzzy("relesed under the mit licence x released under the mit license")
    assert two == [(0, 29, "mit", 2), (32, 62, "mit", 0)]
    assert [f[2:] for f in scanner.fuzzy("all right reserved all rights reserved")] == [("reserved", 1), ("reserved", 0)]


def test_neighbouring_copies_against_brute_force():
    """No span but those with their exact edits, and nothing left in the gaps between them."""
    rng = random.Random(11)
    for notice in NOTICES:
        allowed = int(len(notice) * ERRORS)
        scanner = Scanner({}, {notice: "x"}, ERRORS)
        for _ in range(12):
            copies = [edited(rng, notice, rng.randrange(allowed + 1)) for _ in range(rng.randrange(2, 6))]
            text = "".join(c + rng.choice([" ", " x ", f" {notice[-7:]} "]) for c in copies)
            found = scanner.fuzzy(text)
            assert all(distance(notice, text[a:b]) == edits <= allowed for a, b, _, edits in found)
            edges = [0, *(e for a, b, *_ in found for e in (a, b)), len(text)]
            assert edges == sorted(edges)
            gaps = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
            assert all(fewest_edits(notice, gap) > allowed for gap in gaps)
            assert len(found) == len(copies)


def test_copies_side_by_side_in_one_long_stretch():
    """As many spans as copies, each with its exact edits, and nothing in the gaps."""
    rng = random.Random(12)
    notice = "released under the mit license"
    scanner = Scanner({}, {notice: "mit"}, ERRORS)
    copies = [edited(rng, notice, rng.randrange(4)) for _ in range(300)]
    text = " ".join(copies)
    found = scanner.fuzzy(text)
    assert all(distance(notice, text[a:b]) == edits <= 3 for a, b, _, edits in found)
    edges = [0, *(e for a, b, *_ in found for e in (a, b)), len(text)]
    assert edges == sorted(edges)
    assert all(fewest_edits(notice, text[a:b]) > 3 for a, b in zip(edges[::2], edges[1::2]))
    assert len(found) == 300


@pytest.mark.parametrize("faulty", ["all right reserved ", "relesed under the mit licence ", "gnu generl public license ", "x all rights reservd y "])
def test_time_grows_with_the_text(faulty):
    scanner = Scanner(PHRASES, NOTICES, ERRORS)

    def seconds(size):
        text = faulty * (size // len(faulty))
        began = time.process_time()
        scanned = scan_text(scanner, text)
        assert len(scanned[-1]) == size // len(faulty)
        return time.process_time() - began

    short, long = seconds(80_000), seconds(800_000)
    assert long < 30 * max(short, 0.1)
