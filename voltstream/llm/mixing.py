"""Mixing sources to target weights by Poisson replication, in SQL functions.

A document of a source whose target rate is r comes out k times, k drawn from a Poisson
distribution of mean r by inverting its distribution function at a number hashed from
the document and a seed. Draws are independent, so no document waits for another, and a
source meets its target in expectation, with a standard deviation of the square root.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltstream.llm.common import settled

SEED = "mix"
TEMPERATURE = 0.5
# A rate is drawn as a sum of draws of at most this mean, which exp() can represent.
LARGEST_MEAN = 8.0
# No draw of such a mean exceeds this but with a probability beyond double precision.
MOST = 64
_DIGITS = 13  # hexadecimal digits of the hash: 52 bits, exact in a double


def rates(
    documents: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = 1.0,
    source: str = "source",
) -> DataFrame:
    """(source, documents, rate): how often a document of each source is wanted.

    All sources together give ``epochs`` times the number of documents. ``weights`` are
    shares of that, scaled to sum 1, and a source without one gets nothing; by default a
    source weighs its number of documents to the power of ``temperature``. A null source
    is a source of its own, named null. An empty table has no sources.
    """
    counts = documents.groupBy(F.col(f"`{source}`").alias("source")).agg(F.count("*").alias("documents"))
    if weights is None:
        weight = F.pow("documents", F.lit(float(temperature)))
    else:
        weight = F.lit(0.0)
        for name, share in weights.items():
            weight = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(share))).otherwise(weight)
    weighted = settled(counts.withColumn("weight", weight), "source-weights")
    total = weighted.agg(F.sum("weight"), F.sum("documents")).first()
    # The sum over sources is that of the rounded weights, the same in any order.
    scale = float(epochs) * float(total[1] or 0) / float(total[0] or 1)
    return weighted.select("source", "documents", (F.col("weight") * F.lit(scale) / F.col("documents")).alias("rate"))


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) hashed from the parts."""
    digest = F.md5(F.encode(F.concat_ws("|", *parts), "UTF-8"))
    return F.conv(F.substring(digest, 1, _DIGITS), 16, 10).cast("double") / F.lit(float(16**_DIGITS))


def distribution(mean: Column) -> Column:
    """P(k <= 0), P(k <= 1), ... of a Poisson distribution."""
    start = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(MOST)),
        start,
        lambda a, k: F.struct(
            (a["p"] * mean / k).alias("p"),
            F.concat(a["c"], F.array(F.element_at(a["c"], -1) + a["p"] * mean / k)).alias("c"),
        ),
        lambda a: a["c"],
    )


def mix(
    documents: DataFrame,
    weights: Mapping[str, float] | None = None,
    temperature: float = TEMPERATURE,
    epochs: float = 1.0,
    seed: str = SEED,
    key: str = "doc_id",
    source: str = "source",
) -> DataFrame:
    """Every document as often as drawn, in a global random order.

    Adds ``copy`` (from 0) and ``position``, a hash that the result is ordered by:
    partitions cover ascending ranges of it. All columns of the documents stay (ones named
    like the two added are replaced). Null and repeated keys draw alike, so repeated
    rows come out equally often. Documents are shuffled once, to their final places; the
    table of rates has a row per source and is sent out only if Spark finds it small.
    """
    wanted = settled(
        rates(documents, weights, temperature, epochs, source).where("rate > 0").select(
            F.col("source").alias("_source"),
            F.ceil(F.col("rate") / F.lit(LARGEST_MEAN)).cast("int").alias("_draws"),
            distribution(F.col("rate") / F.ceil(F.col("rate") / F.lit(LARGEST_MEAN))).alias("_cdf"),
        ),
        "rates",
    )
    name = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null"))

    def draw(n: Column) -> Column:
        number = uniform(F.lit(seed), name, n.cast("string"))
        return F.size(F.filter("_cdf", lambda c: c <= number))

    drawn = F.aggregate(F.sequence(F.lit(1), F.col("_draws")), F.lit(0), lambda total, n: total + draw(n))
    kept = [c for c in documents.columns if c not in ("copy", "position", "_source", "_draws", "_cdf")]
    copies = (
        documents.select(*(F.col(f"`{c}`") for c in kept))
        .join(wanted, F.col(f"`{source}`").eqNullSafe(F.col("_source")))
        .withColumn("copy", F.explode(F.sequence(F.lit(0), drawn)))
        .where(F.col("copy") > 0)
        .withColumn("copy", F.col("copy") - 1)
    )
    place = F.md5(F.encode(F.concat_ws("|", F.lit(seed), F.lit("place"), name, F.col("copy").cast("string")), "UTF-8"))
    placed = copies.withColumn("position", F.conv(F.substring(place, 1, 15), 16, 10).cast("bigint"))
    return (
        placed.select(*(F.col(f"`{c}`") for c in kept), "copy", "position")
        .repartitionByRange("position", key, "copy")
        .sortWithinPartitions("position", key, "copy")
    )
