import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltstream.llm.collocations import Chunk, collocations, phrase_counts, prefix_lengths, subtree


def brute_counts(rows):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            found = re.findall("[^ \t]+", piece)
            words[lang or "und"] += len(found)
            for k in range(1, 5):
                counts[lang or "und"].update(" ".join(found[i : i + k]) for i in range(len(found) - k + 1))
    return counts, words


def brute(rows, least, top):
    counts, words = brute_counts(rows)
    result = []
    for lang, f in counts.items():
        candidates = {p: n for p, n in f.items() if " " in p and n >= least}
        scored = []
        for p, a in candidates.items():
            w = p.split(" ")
            cuts = []
            for k in range(1, len(w)):
                left, right = f[" ".join(w[:k])], f[" ".join(w[k:])]
                cuts.append((2_000_000 * a // (left + right), k, left, right))
            score, _, left, right = min(cuts)
            if not any(f" {p} " in f" {q} " and q != p and 100 * b >= 80 * a for q, b in candidates.items()):
                scored.append((-score, -a, p.encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, rank, p.decode(), -a, left, right, words[lang], -score))
    return sorted(result)


def some_texts(seed, docs=60):
    rng = random.Random(seed)
    words = ["a", "B", "b", "the", "é", "Éa", "x\x1cy", "of", "...", "q"]
    fixed = ["new york city hall", "The of THE", "a a a a a"]
    rows = []
    for _ in range(docs):
        parts = [rng.choice(fixed) if rng.random() < 0.2 else rng.choice(words) for _ in range(rng.randrange(60))]
        blanks = [rng.choice([" ", "  ", "\t", ", ", "\n", " ; "]) if rng.random() < 0.3 else " " for _ in parts]
        rows.append(("".join(map("".join, zip(parts, blanks))), rng.choice(["en", "en", "de", None])))
    return rows + [(None, "en"), ("", None), ("   ", "fr"), (".,;", "fr"), rows[0], rows[0], ("lone", "xx")]


def frame(spark, rows):
    made = spark.createDataFrame(rows, "text STRING, lang STRING").repartition(3)
    return made.withColumns({"phrase": F.lit("clash"), "words": F.lit(1), "n": F.lit("x"), "group": F.lit(0)})


@pytest.mark.parametrize("budget", [1, 20, 10**6])
def test_equals_brute_force_for_any_budget(spark, budget):
    """A budget of 1 extends every prefix to the full depth."""
    rows = some_texts(1)
    got = collocations(frame(spark, rows), top=40, least=3, budget=budget, size=300)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 3, 40)


def test_all_counts(spark):
    rows = some_texts(2)
    counts, totals = phrase_counts(frame(spark, rows), least=2, budget=30, size=200)
    expected, words = brute_counts(rows)
    got = {(r.lang, r.phrase): r.n for r in counts.collect()}
    assert got == {(g, p): n for g, f in expected.items() for p, n in f.items() if n >= 2}
    assert len(got) == counts.count()
    assert {r.lang: r.words for r in totals.collect()} == {g: n for g, n in words.items() if n}


def test_prefixes_reach_to_the_first_word_within_the_budget():
    chunk = Chunk.of("en", [b"the of the cat of dog"])
    over = np.array([w in ("the", "of") for w in chunk.words.to_pylist()])
    suffixes = chunk.suffixes(4)
    spelled = chunk.spelled(suffixes).to_pylist()
    lengths = dict(zip(spelled, prefix_lengths(suffixes, over).tolist()))
    assert lengths == {
        "the of the cat": 4, "of the cat of": 3, "the cat of dog": 2, "cat of dog": 1, "of dog": 2, "dog": 1
    }


def test_leaf_totals():
    leaves, repeated = ["a b", "a", "a e", "f"], {"a b c": 2, "d": 5, "": 7}
    assert dict(subtree(leaves, repeated, 2)) == {"a": 5, "a b": 3, "a b c": 2, "d": 5}


def test_chunks_split_at_every_mark():
    chunk = Chunk.of("en", [b"A b.c\td", b"e\x0bf \xc3\x89"])
    words = [chunk.words[int(i)].as_py() for i in chunk.ids]
    assert words == ["a", "b", "c", "d", "e", "f", "É"]
    assert [len(set(chunk.piece[i : i + 2])) for i in range(6)] == [1, 2, 1, 2, 2, 1]


def test_empty_and_wordless(spark):
    for rows in ([], [(None, None), ("", "en"), (" . ", "en")]):
        assert collocations(frame(spark, rows)).collect() == []


def test_a_long_text_and_one_frequent_phrase(spark):
    long_text = "one two " * 40_000 + "."
    got = collocations(frame(spark, [(long_text, "en"), ("one two", "en")]), least=30, size=1000).collect()
    assert sorted(tuple(r) for r in got) == brute([(long_text, "en"), ("one two", "en")], 30, 2000)
