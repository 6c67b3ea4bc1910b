import math
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import voltstream.llm.embeddings as embeddings
import voltstream.llm.jaccard as jaccard
from voltstream.llm.components import components
from voltstream.streaming import workdir


def closure(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "none"])
def test_components(spark, shape):
    rng = random.Random(5)
    links = {
        "random": [(rng.randrange(200), rng.randrange(200)) for _ in range(120)],
        "chain": [(n, n + 1) for n in range(60)],
        "star": [(7, n) for n in range(100)],
        "none": [],
    }[shape]
    frame = spark.createDataFrame([*links, (None, 1), (3, 3)], "a BIGINT, b BIGINT")
    got = {r.node: r.component for r in components(frame).collect()}
    linked = {n for pair in links if pair[0] != pair[1] for n in pair}
    assert got == {n: c for n, c in closure(range(201), links).items() if n in linked}


def shingles(text):
    words = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).split()
    return {tuple(words[n : n + 4]) for n in range(max(1, len(words) - 3))} if words else set()


def brute_jaccard(rows):
    sets = {k: shingles(t) for k, t in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])
    ]
    found = closure(sets, links)
    return {(k, len(s), found[k]) for k, s in sets.items()}


def near_copies(count, seed):
    """A family of near copies, a shared passage in different texts, and odd texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdefg", k=4))
    base, passage, rows = [word() for _ in range(120)], [word() for _ in range(60)], []
    for n in range(count):
        copy = list(base)
        for _ in range(rng.randrange(5)):
            copy[rng.randrange(len(copy))] = word()
        rows.append((n, " ".join(copy)))
    for n in range(count, 2 * count):
        own = [word() for _ in range(rng.randrange(5, 90))]
        rows.append((n, " ".join(own + passage)))
    odd = ["", None, " \t\n", "one", "One", "two words", "a b c", "A  B\nc", "x " * 500, base and " ".join(base).upper()]
    return rows + [(2 * count + n, t) for n, t in enumerate(odd)]


@pytest.mark.parametrize("block, count", [(512, 40), (4, 40)])
def test_jaccard_join_against_brute_force(spark, monkeypatch, block, count):
    """With small blocks a family of 40 runs through pivots, classes and pairs of blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    monkeypatch.setattr(jaccard, "PIVOTS", 2)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    rows = near_copies(count, block)
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").withColumn("component", F.lit("x"))
    got = jaccard.jaccard_join(frame.repartition(3)).collect()
    assert {tuple(r) for r in got} == brute_jaccard(rows) and len(got) == len(rows)


def test_jaccard_join_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, "a b c d"), (2, "a b c d"), (2, "a b c d"), (3, "A b c d")], "doc_id BIGINT, text STRING")
    got = sorted(map(tuple, jaccard.jaccard_join(frame).collect()), key=repr)
    assert got == [(2, 1, 2), (2, 1, 2), (3, 1, 2), (None, 1, None)]
    assert jaccard.jaccard_join(frame.where("false")).collect() == []


def test_jaccard_join_of_ids_with_blank_and_missing_texts(spark):
    """Rows of one id are one document with the links of all its texts, whatever else it has."""
    base = " ".join(f"w{n}" for n in range(40))
    texts = [(1, base), (2, base + " x"), (2, None), (2, " "), (3, "other words only here"), (3, base + " y"), (4, ""), (None, base), (5, None)]
    frame = spark.createDataFrame(texts, "doc_id BIGINT, text STRING")
    got = sorted(map(tuple, jaccard.jaccard_join(frame).collect()), key=repr)
    assert got == sorted([(1, 37, 1), (2, 38, 1), (2, 0, 1), (2, 0, 1), (3, 1, 1), (3, 38, 1), (4, 0, 4), (None, 37, None), (5, 0, 5)], key=repr)


def dealt_rows(monkeypatch):
    """How many texts each call of the tree join is dealt, from now on."""
    rows, real = [], jaccard._tree_links
    monkeypatch.setattr(jaccard, "_tree_links", lambda dealt, *a: (rows.append(dealt.count()), real(dealt, *a))[1])
    return rows


def test_what_hangs_together_by_a_passage_is_not_compared_pair_by_pair(spark, monkeypatch):
    """Short texts with a passage in common are one cluster; almost none is similar to another."""
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    dealt = dealt_rows(monkeypatch)
    rng = random.Random(12)
    word = lambda: "".join(rng.choices("abcdefg", k=5))
    passage, rows = [word() for _ in range(12)], []
    for n in range(300):
        own = [word() for _ in range(12)]
        rows.append((n, " ".join(own[:6] + passage + own[6:])))
    rows += [(300 + n, rows[7 * n][1] + " " + word()) for n in range(10)]
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert {tuple(r) for r in jaccard.jaccard_join(frame.repartition(3)).collect()} == brute_jaccard(rows)
    assert sum(dealt) < 60


def test_pairs_of_blocks_are_dealt_in_turns(spark, monkeypatch):
    """A family around the threshold is many pairs of blocks: at once go about as many texts as there are."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    monkeypatch.setattr(jaccard, "PIVOT_ROUNDS", 1)
    dealt = dealt_rows(monkeypatch)
    rows = near_copies(60, 9)
    frame = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    assert {tuple(r) for r in jaccard.jaccard_join(frame.repartition(3)).collect()} == brute_jaccard(rows)
    assert sum(dealt) > 300 and max(dealt) < 180


@pytest.mark.parametrize("slices", [1, 4])
def test_every_slice_of_a_large_cluster_counts(spark, monkeypatch, slices):
    """All documents in one large cluster: their elements are taken in by parts, rows of one id together."""
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "FEW", 4)
    monkeypatch.setattr(jaccard, "SAMPLED", slices)
    rows = [(n, t) for n, t in near_copies(30, 3) if n < 30]
    frame = spark.createDataFrame([*rows, *rows[:9]], "doc_id BIGINT, text STRING")
    assert {tuple(r) for r in jaccard.jaccard_join(frame.repartition(3)).collect()} == brute_jaccard(rows)


def test_large_intermediate_tables_do_not_stay(spark):
    made = workdir._made[spark.conf.get("spark.app.id")]
    before = set(made)
    frame = spark.createDataFrame(near_copies(20, 2), "doc_id BIGINT, text STRING")
    assert jaccard.jaccard_join(frame).count() == 50
    left = {os.path.basename(f).rsplit("-", 1)[0] for f in set(made) - before}
    assert "components" in left
    assert left.isdisjoint({"sets", "distinct-sets", "prefixes", "candidates", "elements", "tasks"})


def test_a_tree_compares_many_nodes_at_once(monkeypatch):
    """A block of texts with a passage in common, each its own: calls, not pairs, take the time."""
    rng, seen, real = random.Random(8), [], jaccard.Level.may_link
    monkeypatch.setattr(jaccard.Level, "may_link", lambda self, left, *a: (seen.append(len(left)), real(self, left, *a))[1])
    passage = rng.sample(range(1 << 62), 40)
    sets = [(n, n, np.array(sorted(passage + rng.sample(range(1 << 62), 60)), np.uint64)) for n in range(300)]
    assert jaccard.tree_join(sets, 85) == []
    assert sum(seen) > 10_000 and len(seen) < sum(seen) / 100


def test_tree_join_of_odd_documents():
    """Empty sets, texts of one id, documents already of one class, fewer documents than a node has children."""
    few, other = np.arange(1, 21, dtype=np.uint64) << np.uint64(40), np.arange(30, 50, dtype=np.uint64) << np.uint64(40)
    empty = np.zeros(0, np.uint64)
    assert jaccard.tree_join([(1, 1, few)], 85) == []
    assert jaccard.tree_join([(1, 1, empty), (2, 2, empty), (3, 3, few)], 85) == []
    assert jaccard.tree_join([(2, 2, few), (1, 1, few[:18]), (3, 3, few[:16])], 85) in ([(2, 1), (3, 1)], [(3, 1), (2, 1)])
    assert jaccard.tree_join([(1, 1, few), (2, 1, few), (3, 3, other), (3, 3, empty)], 85) == []
    assert len(jaccard.tree_join([(n, n // 10, few) for n in range(30)], 85)) == 2
    assert jaccard.tree_join([(4, 4, few), (4, 5, few)], 85) == []


def test_signature_tree_loses_no_link():
    rng = random.Random(6)
    for _ in range(40):
        base = rng.sample(range(1 << 62), 60)
        sets = []
        for n in range(rng.randrange(2, 40)):
            own = set(rng.sample(base, rng.randrange(45, 60))) | set(rng.sample(range(1 << 62), rng.randrange(6)))
            sets.append((n, n, np.array(sorted(own), np.uint64)))
        links = jaccard.tree_join(sets, 85)
        want = [
            (a, b) for a, _, x in sets for b, _, y in sets
            if a < b and 100 * len(np.intersect1d(x, y)) >= 85 * len(np.union1d(x, y))
        ]
        keys = range(len(sets))
        assert closure(keys, links) == closure(keys, want)


def brute_cosine(rows, threshold=0.98):
    good = []
    for key, vector, label in rows:
        fine = label is not None and vector and None not in vector and all(map(math.isfinite, vector)) and any(vector)
        scaled = np.array(vector, float) / np.abs(vector).max() if fine else None
        good.append(scaled / np.linalg.norm(scaled) if fine else None)
    links, counts = [], [0] * len(rows)
    for a in range(len(rows)):
        for b in range(len(rows)):
            if a != b and good[a] is not None and good[b] is not None and rows[a][2] == rows[b][2]:
                if len(good[a]) == len(good[b]) and good[a] @ good[b] >= threshold:
                    counts[a] += 1
                    links.append((rows[a][0], rows[b][0]))
    found = closure([r[0] for r in rows], links)
    return {(r[0], counts[n], found[r[0]], found[r[0]] == r[0]) for n, r in enumerate(rows)}


def vectors(count):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(6, 16))
    rows = []
    for n in range(count):
        centre = centres[0] if n % 3 else centres[n % 6]
        rows.append((n, (centre + rng.normal(size=16) * rng.choice([0.01, 0.08, 0.3])).tolist(), n % 2))
    rows += [(count + n, rows[0][1], 0) for n in range(5)]
    odd = [None, [], [0.0] * 16, [math.nan] * 16, [math.inf] + [0.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [2.0, 4.0], [1e200, 2e200]]
    rows += [(count + 5 + n, v, 0) for n, v in enumerate(odd)]
    return rows + [(count + 50, rows[0][1], None)]


@pytest.mark.parametrize("leaf, block, sample", [(256, 512, 20_000), (8, 512, 20_000), (16, 7, 60)])
def test_embeddings_against_brute_force(spark, monkeypatch, leaf, block, sample):
    monkeypatch.setattr(embeddings, "LEAF", leaf)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "SAMPLE_ROWS", sample)
    rows = vectors(240)
    schema = "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"
    frame = spark.createDataFrame(rows, schema).withColumn("class", F.lit("x"))
    got = embeddings.near_duplicates(frame.repartition(3)).collect()
    want = brute_cosine(rows)
    found, there = sum(r.n_links for r in got), sum(r[1] for r in want)
    assert 0.98 * there <= found <= there and there > 1000
    if leaf == 256:
        assert {tuple(r) for r in got} == want
    assert embeddings.near_duplicates(frame.where("false")).collect() == []


def planted(spark, count, pairs, size=64):
    """Random vectors, and beside some of them one at a cosine of 0.98, 0.985 or 0.995."""
    rng = np.random.default_rng(21)
    base = rng.normal(size=(count, size))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [(n, v.tolist(), n % 2) for n, v in enumerate(base)]
    for n in range(pairs):
        cosine = (0.9801, 0.985, 0.995)[n % 3]
        other = rng.normal(size=size)
        other -= other @ base[n] * base[n]
        other /= np.linalg.norm(other)
        rows.append((count + n, (cosine * base[n] + np.sqrt(1 - cosine**2) * other).tolist(), n % 2))
    return spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT").repartition(4)


def test_leaves_stay_small_beyond_the_sample(spark, monkeypatch):
    """A sample of 100 of 6,000 vectors: its leaves are split on until they are small."""
    monkeypatch.setattr(embeddings, "SAMPLE_ROWS", 100)
    monkeypatch.setattr(embeddings, "BLOCK", 64)
    frame = planted(spark, 5400, 600)
    classes = embeddings._checked(frame, "vec_id", "embedding", "label").select(
        "class", F.col("id").alias("rep"), F.lit(1).cast("bigint").alias("copies"), "label", "data"
    )
    routed = embeddings._routed(classes, 0.98, embeddings.TREES)
    sizes = lambda f: f.groupBy("leaf", "label", "size").count().agg(F.max("count")).first()[0]
    split = embeddings.split_on(routed, 0.98)
    assert sizes(routed) > 3 * 64 and sizes(split) <= 64
    # No vector falls out, and overlap adds a bounded share per level.
    assert split.select("class").distinct().count() == 6000
    assert split.count() < 4 * routed.count()
    found = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    assert sum(found[5400 + n].component_id == n for n in range(600)) >= 0.97 * 600
    assert sum(r.n_links for r in found.values()) <= 1200


def test_recall_of_production_parameters_on_planted_pairs(spark):
    """All parameters as they are, and enough vectors for many leaves."""
    found = {r.vec_id: r for r in embeddings.near_duplicates(planted(spark, 20_000, 900)).collect()}
    hits = sum(found[20_000 + n].component_id == n for n in range(900))
    print("recall", hits / 900)
    assert hits >= 0.97 * 900 and sum(r.n_links for r in found.values()) <= 1800


def test_a_dense_cluster_is_not_split(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 20)
    rng = np.random.default_rng(22)
    centre = rng.normal(size=16)
    rows = [(n, (centre + 0.01 * rng.normal(size=16)).tolist(), 0) for n in range(150)]
    rows += [(150 + n, rng.normal(size=16).tolist(), 0) for n in range(150)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>, label INT"))
    assert {tuple(r) for r in got.collect()} == brute_cosine(rows)


def test_embeddings_without_a_key(spark):
    rows = [(None, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    got = sorted(map(tuple, embeddings.near_duplicates(frame).collect()), key=repr)
    assert got == [(1, 1, 1, True), (1, 1, 1, True), (None, 0, None, False)]
