"""What the pipeline's stages keep and drop, against brute force."""

import random

import corpus_pipeline
from tests.llm.test_joins import closure

SCHEMA = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"


def similarity(left, right):
    def shingles(text):
        words = text.lower().split()
        return {tuple(words[n : n + 5]) for n in range(max(1, len(words) - 4))}

    one, two = shingles(left), shingles(right)
    return len(one & two) / len(one | two)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], SCHEMA)


def test_near_duplicates_are_those_of_five_words_and_four_fifths(spark):
    """Families of a text and its copies with 1 to 4 words changed."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    rows = []
    for _ in range(60):
        base = [word() for _ in range(rng.randrange(60, 120))]
        copy = list(base)
        for at in rng.sample(range(len(base)), rng.randrange(1, 5)):
            copy[at] = word()
        rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(copy))]
    found = [(a, b, similarity(s, t)) for a, s in rows for b, t in rows if a < b]
    assert sum(0.8 <= x < 0.85 for *_, x in found) > 3 and sum(0.6 < x < 0.8 for *_, x in found) > 3
    groups = closure(range(len(rows)), [(a, b) for a, b, x in found if x >= 0.8])
    kept = corpus_pipeline.one_of_each_group(spark, documents(spark, rows).repartition(3), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(groups.values()))


def test_one_row_stays_of_repeated_rows_and_rows_without_an_id(spark):
    """Whatever its id, a text stays once; texts that differ stay, also under one id."""
    one, two, three, four = (" ".join(f"{n}{w}" for w in range(30)) for n in "abcd")
    rows = [
        (5, one), (5, one), (5, two), (None, one), (None, three), (None, three), (4, three.upper()),
        (None, four), (None, four), (7, ""), (7, " "), (8, None), (None, None), (None, ""),
    ]
    frame = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)
    kept = corpus_pipeline.one_of_each_group(spark, frame.repartition(3), "").collect()
    found = sorted(((r.doc_id, (r.text or "").strip()) for r in kept), key=repr)
    wanted = [(5, one), (5, two), (4, three.upper()), (None, four), (7, ""), (8, ""), (None, "")]
    assert found == sorted(wanted, key=repr)
