"""Toxic documents are rejected, on the tables with 3,980 labels: a constant answer fails here."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voltstream.llm import toxicity
from voltstream.llm.learning import in_fold

TABLES = "/root/testdata/sf0.1"
PLANTED = 1 << 40


@pytest.fixture(scope="module")
def larger(spark):
    corpus_pipeline.prepared(spark)
    return spark.read.parquet(f"{TABLES}/documents.parquet"), spark.read.parquet(f"{TABLES}/labels.parquet")


def test_op9_finds_held_out_toxic_documents(larger):
    documents, labels = larger
    rows = toxicity.toxicity(documents, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    assert len(toxic) > 80 and sum(toxic) > 0.85 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_the_stage_drops_held_out_and_planted_toxic_documents(spark, larger):
    documents, labels = larger
    held = labels.where(in_fold("doc_id", toxicity.FOLDS, toxicity.HELD_OUT))
    clean = documents.join(held.where("toxic = 0").select("doc_id"), "doc_id", "left_semi")
    planted = clean.withColumns(
        {
            "doc_id": F.col("doc_id") + PLANTED,
            "text": F.concat(F.col("text"), F.lit(" You are a loser, scum! "), F.col("text")),
        }
    )
    kept = {r.doc_id for r in corpus_pipeline.drop_toxic(spark, documents.unionByName(planted), TABLES).collect()}
    there = {r.doc_id for r in documents.select("doc_id").collect()}
    toxic = {r.doc_id for r in held.where("toxic = 1").collect()} & there
    good = {r.doc_id for r in clean.select("doc_id").collect()}
    print("held-out", len(toxic), len(toxic & kept), "planted", len(good), sum(i >= PLANTED for i in kept), "clean kept", len(good & kept))
    assert len(toxic) > 80 and len(toxic & kept) < 0.15 * len(toxic)
    assert len(good) > 500 and sum(i >= PLANTED for i in kept) <= 0.1 * len(good)
    assert len(good & kept) >= 0.97 * len(good)
