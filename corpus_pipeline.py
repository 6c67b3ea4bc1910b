"""From raw documents to packed training sequences, in five stages.

Every stage takes the columns of ``documents``; any of them may be null, texts may be empty or
of any length, rows and ids may repeat, and an empty table gives an empty result. Other
columns, whatever their names, are dropped. Every stage works on whole texts and on all
that its predecessor kept.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltstream.llm import quality as quality_model
from voltstream.llm import toxicity as toxicity_model
from voltstream.llm.common import DOCUMENT, discard, prepared, settled
from voltstream.llm.jaccard import jaccard_join
from voltstream.llm.learning import labelled_sample, learnt
from voltstream.llm.mixing import mix
from voltstream.llm.packing import pack

TOKENIZER = "byte_bpe_50k.json"
# Near-duplicates share so many percent of their shingles of so many words. The
# defaults of ``jaccard_join`` are those of op5's own contract.
NEAR_WORDS, NEAR_PERCENT = 5, 80

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

log = logging.getLogger(__name__)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the conditional random field does not call toxic.

    It learns from the labelled documents of ``docs`` outside the held-out fold. A null text is
    scored as the empty one; rows alike in text share their fate, so repeated rows stay or
    go together; a row without an id is scored like any other and never learnt from. A
    score at the threshold is toxic. Without labels of both kinds nothing is rejected, and a
    warning says so.
    """
    t = toxicity_model
    field = learnt(t.train, labelled_sample(docs, _labels(spark, sf_dir), "toxic", t.FOLDS, t.HELD_OUT))
    if field is None:
        log.warning("no labels of both kinds: no document is rejected as toxic")
    scored = t.score_documents(docs, field, keep=DOCUMENT)
    return scored.where("predicted = 0").select(*DOCUMENT)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine calls good.

    Null texts, repeated rows and rows without an id are treated as by ``drop_toxic``; a
    score at the threshold is good. Without labels of both kinds nothing is rejected, and a
    warning says so.
    """
    q = quality_model
    machine = learnt(q.train, labelled_sample(docs, _labels(spark, sf_dir), "quality", q.FOLDS, q.HELD_OUT))
    if machine is None:
        log.warning("no labels of both kinds: no document is rejected for its quality")
    scored = q.score_documents(docs, machine, keep=DOCUMENT)
    return scored.where("predicted = 1").select(*DOCUMENT)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest id of each component of near-duplicates.

    Near-duplicates have a Jaccard similarity of 0.8 or more over shingles of five words.
    Every row is joined under a number of its own, so repeated rows and rows without an
    id are in groups like any other; a row with an id goes before one without. Rows that
    share an id but not their text are different documents. Of rows without a word, one
    of each id stays.
    """
    prepared(spark)
    tie = F.xxhash64("text", "lang", "source", "n_chars")
    numbered = settled(docs.select("*", F.monotonically_increasing_id().alias("row"), tie.alias("tie")), "numbered")
    joined = jaccard_join(numbered, key="row", words=NEAR_WORDS, percent=NEAR_PERCENT)
    # Rows without a word have no links: they form a group by their id.
    blank = F.col("n_shingles") == 0
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "tie", "row")
    # Partial sums come before each shuffle, so a large group is one row per task.
    kept = (
        numbered.select("row", "doc_id", "tie")
        .join(joined.hint("merge"), "row")
        .groupBy(F.when(~blank, F.col("component_id")).alias("group"), F.when(blank, F.col("doc_id")).alias("blank"))
        .agg(F.min(rank)["row"].alias("row"))
        .select("row")
    )
    return numbered.join(settled(kept, "kept").hint("merge"), "row", "left_semi").select(*DOCUMENT)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as its source's rate draws, in random order.

    Copies are rows alike in all columns. A null source is a source of its own. The draw
    hangs on the id alone, so rows of one id, and all rows without one in a source, come
    out equally often.
    """
    prepared(spark)
    return mix(docs).select(*DOCUMENT)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences.

    A null text is one end token; repeated rows and rows without an id are packed like
    any others. Which of two pieces of one length comes first hangs on their ids and tokens.
    """
    prepared(spark)
    return pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_quality),
    ("ngram_jaccard", one_of_each_group),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Trained models and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each result written and read again."""
    docs = prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        before, docs = docs, settled(stage(spark, docs, sf_dir), name)
        discard(before)
    return docs


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")
