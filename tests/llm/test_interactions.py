import random
from collections import Counter
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltstream.llm.interactions import (
    audit,
    document_filters,
    failure_masks,
    interaction_audit,
    lehmer_rank,
    removal_intervals,
    removals,
)

DOCUMENTS = "doc_id BIGINT, text STRING, lang STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT"


def test_ranks_are_places_in_the_list_of_orders():
    for size in (1, 3, 5):
        for rank, order in enumerate(permutations(range(size))):
            assert lehmer_rank(order, size) == rank
            assert lehmer_rank(order[:1], size) <= rank


@pytest.mark.parametrize("size", [1, 3, 5])
def test_intervals_cover_every_order_once(size):
    for mask in range(1 << size):
        seen = Counter()
        for step, first, after in removal_intervals(mask, size):
            for rank in range(first, after):
                seen[rank] += 1
                order = list(permutations(range(size)))[rank]
                assert [mask >> f & 1 for f in order].index(1) == step
        assert all(n == 1 for n in seen.values()) and len(seen) == (len(list(permutations(range(size)))) if mask else 0)


def test_removals_equal_a_run_of_every_order():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 2**55, (32, 3))
    got = removals(np.arange(32), counts, 5)
    for rank, order in enumerate(permutations(range(5))):
        left = dict(enumerate(counts))
        for step, f in enumerate(order):
            gone = [m for m in left if m >> f & 1]
            assert (got[rank, step] == sum((left.pop(m) for m in gone), np.zeros(3, np.int64))).all()


def fails(row, rows):
    text = row[1] or ""
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in text).split(" ") if w]
    mask = (len(words) < 200) * 1 + (100 * len(set(words)) < 50 * len(words)) * 2
    mask += (100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)) * 4 + any(c in text for c in "#$%&*|") * 8
    smaller = row[0] is not None and any(r[0] is not None and r[0] < row[0] and (r[1] or "") == text for r in rows)
    return mask + smaller * 16


def brute(rows, labels):
    result = []
    masks = [(r, fails(r, rows)) for r in rows]
    for part in {r[2] or "" for r in rows}:
        own = [(r, m) for r, m in masks if (r[2] or "") == part]
        shapley, table = Counter(), []
        for order in permutations(range(5)):
            left = own
            for step, f in enumerate(order):
                gone = [r for r, m in left if m >> f & 1]
                left = [(r, m) for r, m in left if not m >> f & 1]
                shapley[f] += len(gone)
                lost = [sum(any(x[0] == r[0] and x[n] == 1 for x in labels) for r in gone) for n in (1, 2)]
                redundant = sum(m >> f & 1 for _, m in own) - len(gone)
                alone = sum(m == 1 << f for _, m in own)
                name = "".join("ABCDE"[x] for x in order)
                table.append((part, name, step + 1, len(left), len(gone), redundant, alone, *lost, f))
        result += [(*t[:-1], shapley[t[-1]]) for t in table]
    return sorted(result)


def some_documents(seed):
    rng = random.Random(seed)
    texts = [None, "", "Aa", "#", "é" * 40, "x\x85y z " * 150, " ".join(map(str, range(300))), "A " * 250, "b\x0bc " * 90 + "|"]
    rows = [(rng.choice([*range(30), None]), rng.choice(texts), rng.choice(["en", "de", None, ""])) for _ in range(80)]
    labels = [(rng.randrange(30), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(40)] + [(None, 1, 1)]
    return [*rows, rows[0], rows[0]], labels


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed):
    """Repeated ids and rows, null ids, nulls in any column, repeated and null labels."""
    rows, labels = some_documents(seed)
    documents = spark.createDataFrame(rows, DOCUMENTS).withColumns({"mask": F.lit(1), "part": F.lit("x"), "n": F.lit(0)})
    marks = spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("clash"))
    labelled = [x for x in labels if x[0] is not None]
    got = interaction_audit(documents.repartition(3), marks)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, labelled)


def test_filters_of_one_text(spark):
    rows = [(n, t, "en") for n, t in enumerate(["a " * 199, " ".join(map(str, range(200))), "ABc" * 10, "x|"])]
    frame = spark.createDataFrame(rows, DOCUMENTS)
    got = frame.orderBy("doc_id").select(*(c.alias(k) for k, c in document_filters(frame).items())).collect()
    assert [tuple(map(int, r)) for r in got] == [(1, 1, 0, 0), (0, 0, 0, 0), (1, 0, 1, 0), (1, 0, 0, 1)]


def test_empty_tables(spark):
    documents, labels = spark.createDataFrame([], DOCUMENTS), spark.createDataFrame([], LABELS)
    assert interaction_audit(documents, labels).collect() == []
    some = spark.createDataFrame([(1, "a", "en")], DOCUMENTS)
    rows = interaction_audit(some, labels).collect()
    assert len(rows) == 600 and {r.good_lost for r in rows} == {0}


def test_any_number_of_filters(spark):
    masks = spark.createDataFrame([("p", 3, 5, 1, 0), ("p", 2, 1, 0, 0)], "part STRING, mask INT, documents BIGINT, good BIGINT, toxic BIGINT")
    rows = {(r.filter_order, r.step): r for r in audit(masks, "AB").collect()}
    assert len(rows) == 4
    assert (rows["AB", 1].removed, rows["AB", 2].removed, rows["AB", 2].redundant) == (5, 1, 5)
    assert (rows["BA", 1].removed, rows["BA", 2].removed, rows["BA", 2].redundant) == (6, 0, 5)
    assert rows["AB", 1].shapley == 5 and rows["AB", 2].shapley == 7 and rows["BA", 1].unique_fails == 1


def test_masks_of_copies_count_every_row(spark):
    rows = [(n, "same text", "en") for n in range(1000)]
    masks = failure_masks(spark.createDataFrame(rows, DOCUMENTS), spark.createDataFrame([], LABELS))
    assert {r["mask"]: r.documents for r in masks.collect()} == {1: 1, 17: 999}
