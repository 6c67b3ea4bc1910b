import itertools
import os
import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from voltstream.llm import quality, toxicity
from voltstream.llm.learning import Scores, labelled_sample, learnt, logistic
from voltstream.llm.licenses import ERRORS, NOTICES, PHRASES, Scanner, scan_licenses, scan_text
from voltstream.llm.mixing import distribution, mix, rates

SCANNER = Scanner(PHRASES, NOTICES, ERRORS)


def test_base_phrases_against_brute_force():
    rng = random.Random(9)
    parts = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "CC-BY", "é", "x1", "İ"]
    joints = [" ", ", ", "-", "\n", "_", "\x7f", ""]
    for _ in range(500):
        text = "".join(rng.choice(parts) + rng.choice(joints) for _ in range(rng.randrange(25)))
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [
            (n, label) for phrase, label in PHRASES.items() for n in range(len(words))
            if words[n : n + len(phrase.split())] == phrase.split()
        ]
        n_words, n_base, first, last, base, labels, score, _ = scan_text(SCANNER, text)
        assert (n_words, n_base) == (len(words), len(places))
        assert (first, last) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert base == ",".join(sorted({label for _, label in places}))
        assert set(base.split(",")) - {""} <= set(labels.split(","))
        assert 0 <= score <= 1 and (score == 1 or not places)


@pytest.mark.parametrize("edits", [0, 1, 2])
def test_notices_with_errors_are_found_in_place(edits):
    rng = random.Random(edits)
    for notice, label in NOTICES.items():
        if int(len(notice) * ERRORS) < edits:
            continue
        letters = list(notice)
        for at in rng.sample([n for n, c in enumerate(letters) if c != " "], edits):
            letters[at] = "q"
        text = "Intro words. " + "".join(letters).title() + "; the rest 123"
        *_, labels, score, found = scan_text(SCANNER, text)
        assert label in labels.split(",")
        assert any(n["start"] <= 14 and n["end"] >= 12 + len(notice) - 1 for n in found) or label in ("gpl", "cc-by")
        assert score == 1.0 if not edits else score > 0.85


def test_far_texts_have_no_notice():
    assert scan_text(SCANNER, "licensed plumbers work under the apache tribe version of the law")[5] == ""


def test_license_scan_of_odd_rows(spark):
    frame = spark.createDataFrame(
        [(1, None), (2, ""), (None, "CC by"), (3, "All  rights\nreserved."), (3, "All  rights\nreserved.")],
        "doc_id BIGINT, text STRING",
    ).withColumn("score", F.lit("x"))
    got = sorted((tuple(r)[:8] for r in scan_licenses(frame).collect()), key=repr)
    empty = (0, 0, None, None, "", "", 0.0)
    third = (3, 3, 1, 0, 0, "reserved", "reserved", 1.0)
    assert got == sorted([(1, *empty), (2, *empty), (None, 2, 1, 0, 0, "cc-by", "cc-by", 1.0), third, third], key=repr)
    assert scan_licenses(frame.where("false")).collect() == []


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    transition = np.array([[0.0, -1.2], [-0.7, 0.4]])
    for size in (1, 2, 5):
        score = rng.normal(size=size) * 2
        weight = {0: 0.0, 1: 0.0}
        totals = np.zeros((size, 2))
        for states in itertools.product((0, 1), repeat=size):
            value = sum(s * x for s, x in zip(states, score)) + sum(transition[a, b] for a, b in zip(states, states[1:]))
            for t, s in enumerate(states):
                totals[t, s] += np.exp(value)
        (got,) = toxicity.marginals([score], transition)
        assert np.allclose(got, np.log(totals[:, 1] / totals[:, 0]))
    assert weight == {0: 0.0, 1: 0.0}


def test_segments_do_not_change_marginals(monkeypatch):
    rng = np.random.default_rng(2)
    transition = np.array([[0.0, -1.5], [-1.5, -1.3]])
    values = [rng.normal(size=n) * 3 for n in (0, 1, 511, 512, 513, 3000)]
    cut = toxicity.marginals(values, transition)
    monkeypatch.setattr(toxicity, "SEGMENT", 1 << 20)
    for a, b in zip(cut, toxicity.marginals(values, transition)):
        assert np.allclose(a, b, rtol=0, atol=1e-9)


def test_machine_equals_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    machine = quality.Machine(0.5, rng.normal(size=9), rng.normal(size=(9, 4)), None, None, None)
    index, value = np.array([0, 3, 5, 8]), rng.normal(size=4)
    (got,), _ = quality.evaluate(machine, index, value, np.array([0]))
    want = 0.5 + machine.weights[index] @ value
    for a, b in itertools.combinations(range(4), 2):
        want += machine.vectors[index[a]] @ machine.vectors[index[b]] * value[a] * value[b]
    assert np.isclose(got, want)


@pytest.fixture(scope="module")
def larger(spark):
    folder = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")


@pytest.mark.parametrize(
    "model, label, folds, fold, least", [(toxicity.toxicity, "toxic", 5, 0, 0.9), (quality.quality, "quality", 4, 2, 0.97)]
)
def test_held_out_accuracy(spark, larger, model, label, folds, fold, least):
    documents, labels = larger
    rows = model(documents, labels).join(labels, "doc_id").where("held_out").collect()
    # Not won by a constant answer: both answers are given, and the rarer one rightly.
    rare = 1 if label == "toxic" else 0
    assert np.mean([r.predicted == rare for r in rows if r[label] == rare]) > 0.6
    assert all(zlib.crc32(str(r.doc_id).encode()) % folds == fold for r in rows)
    assert np.mean([r.predicted == r[label] for r in rows]) >= least


@pytest.mark.parametrize("model, alone", [(toxicity.toxicity, 0), (quality.quality, 1)])
def test_scores_of_odd_rows(spark, larger, model, alone):
    documents, labels = larger
    schema = "doc_id BIGINT, text STRING"
    odd = spark.createDataFrame([(None, "x y"), (1, None), (2, ""), (2, "")], schema).withColumn("score", F.lit("x"))
    assert sorted(r.doc_id or 0 for r in model(odd, labels).collect()) == [0, 1, 2, 2]
    assert {r.predicted for r in model(odd, labels.where("false")).collect()} == {alone}
    field_rows = model(documents.unionByName(odd, allowMissingColumns=True).drop("score"), labels)
    found = [r for r in field_rows.where("doc_id IS NULL OR doc_id IN (1, 2)").collect()]
    assert all(0 <= r.score <= 1 for r in found)
    assert model(odd.where("false"), labels).collect() == []


def test_one_rule_labels_words_at_every_size():
    """The evidence decides, not the size of the sample."""
    def labelled(toxic_with, toxic, clean_with, clean):
        documents = [["bad"]] * toxic_with + [["x"]] * (toxic - toxic_with)
        documents += [["bad"]] * clean_with + [["x"]] * (clean - clean_with)
        return "bad" in toxicity._labelled_features(documents, np.array([1.0] * toxic + [0.0] * clean))

    assert [labelled(n, 20, 0, 200) for n in (1, 2, 4, 8)] == [False, True, True, True]
    assert [labelled(n, 1000, 0, 10_000) for n in (1, 2, 4, 8)] == [False, False, True, True]
    assert [labelled(n, 1000, 10 * n, 10_000) for n in (1, 10, 100)] == [False] * 3
    assert labelled(200, 1000, 100, 10_000) and not labelled(2, 1000, 1, 10_000)


def test_the_curve_is_fitted_on_texts_of_both_classes(caplog):
    texts = ["you scum", "scum here", "all scum"] + [f"plain words {n}" for n in range(30)]
    labels = np.array([1.0] * 3 + [0.0] * 30)
    assert toxicity.train(texts, labels) is not None and not caplog.records
    assert toxicity.train(texts[1:], labels[1:]) is not None and "fewer than three" in caplog.text
    assert toxicity.train(texts[3:], labels[3:]) is None


def test_toxic_spans_hold_the_words(spark, larger):
    documents, labels = larger
    rows = toxicity.toxicity(documents, labels).join(documents, "doc_id").where("size(spans) > 0").collect()
    words = {documents and r.text[s.start : s.end].lower().split()[0] for r in rows for s in r.spans}
    assert {"loser", "scum"} & words


def test_remembered_scores_are_bounded():
    scores = Scores(len, limit=3)
    assert [scores[w] for w in ("a", "bb", "ccc", "dddd", "a")] == [1, 2, 3, 4, 1] and len(scores) <= 3
    assert logistic(0) == 0.5


def test_distribution_is_poissons(spark):
    (row,) = spark.sql("SELECT 2.5D AS mean").select(distribution(F.col("mean")).alias("c")).collect()
    assert np.isclose(row.c[0], np.exp(-2.5)) and np.isclose(row.c[1], 3.5 * np.exp(-2.5)) and abs(row.c[-1] - 1) < 1e-12


def test_sources_meet_their_weights(spark):
    frame = spark.range(30_000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").when(F.col("id") % 100 == 1, "b").alias("source"),
        F.lit("clash").alias("copy"), F.lit(1.5).alias("position"),
    )
    mixed = mix(frame, {"a": 1, "b": 2, None: 1}, epochs=1.0)
    counts = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    for source, share in (("a", 0.25), ("b", 0.5), (None, 0.25)):
        assert abs(counts[source] - share * 30_000) < 5 * (share * 30_000) ** 0.5
    rows = mixed.select("position", "doc_id", "copy").collect()
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows)
    assert len({(r.doc_id, r.copy) for r in rows}) == len(rows)
    assert mix(frame, {"a": 1}).where("source IS NULL OR source <> 'a'").count() == 0
    wanted = rates(frame, {"b": 1}).where("source = 'b'").first()
    assert np.isclose(wanted.rate, 30_000 / wanted.documents)


def test_mixing_of_odd_tables(spark):
    frame = spark.createDataFrame([(None, None), (1, "s"), (1, "s")], "doc_id BIGINT, source STRING")
    rows = mix(frame, epochs=30.0).collect()
    copies = [r.copy for r in rows if r.doc_id == 1]
    assert len(copies) % 2 == 0 and {r.doc_id for r in rows} == {None, 1}
    assert mix(frame.where("false")).collect() == []


@pytest.mark.parametrize(
    "model, label, stage", [(toxicity, "toxic", corpus_pipeline.drop_toxic), (quality, "quality", corpus_pipeline.keep_quality)]
)
def test_models_are_learnt_in_one_task_and_not_in_the_driver(spark, tables, tmp_path, monkeypatch, model, label, stage):
    def seen(texts, labels):
        (tmp_path / str(os.getpid())).write_text(f"{len(texts)} {len(labels)} {sorted(set(labels.tolist()))}")

    documents, labels = (spark.read.parquet(f"{tables}/{name}.parquet") for name in ("documents", "labels"))
    known = labels.where(F.col(label).isNotNull() & ~(F.crc32(F.col("doc_id").cast("string")) % model.FOLDS == model.HELD_OUT))
    n = known.join(documents.where("length(text) <= 20000 OR text IS NULL"), "doc_id").select("doc_id").distinct().count()
    monkeypatch.setattr(model, "train", seen)
    operator = toxicity.toxicity if model is toxicity else quality.quality
    for run in (lambda: operator(documents, labels), lambda: stage(spark, documents, tables)):
        run()
        (found,) = tmp_path.iterdir()
        assert found.name != str(os.getpid()) and found.read_text() == f"{n} {n} [0.0, 1.0]"
        found.unlink()


def test_a_model_learns_in_the_order_of_keys_however_the_table_is_stored(spark):
    rows = [(n, f"text {n}", n % 2) for n in (7, 3, 12, 5, 9)]
    documents = spark.createDataFrame([r[:2] for r in rows], "doc_id BIGINT, text STRING").repartition(4)
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id BIGINT, toxic INT")
    sample = labelled_sample(documents, labels, "toxic", 100, 99)
    texts, answers = learnt(lambda texts, labels: (texts, labels), sample)
    assert texts == [f"text {n}" for n in (3, 5, 7, 9, 12)] and answers.tolist() == [1, 1, 1, 1, 0]
    assert learnt(toxicity.train, sample.where("false")) is None
