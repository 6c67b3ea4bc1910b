"""What the operators leave on disk."""

import os

from pyspark.sql import functions as F

from voltstream.llm.common import CLEANUP, discard, settled
from voltstream.streaming import workdir


def shuffles(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
    return {blocks.apply(n).toString() for n in range(blocks.size()) if blocks.apply(n).isShuffle()}


def test_a_settled_table_leaves_no_shuffle_files(spark):
    frame = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    before, setting = shuffles(spark), spark.conf.get(CLEANUP)
    table = settled(frame, "counts")
    assert shuffles(spark) <= before
    assert spark.conf.get(CLEANUP) == setting
    # The frame itself can still be run.
    assert sorted(map(tuple, frame.collect())) == sorted(map(tuple, table.collect())) == sorted(map(tuple, frame.collect()))


def test_discard_deletes_what_settled_wrote_and_nothing_else(spark):
    made = workdir._made[spark.conf.get("spark.app.id")]
    one, two = settled(spark.range(5), "one"), settled(spark.range(6), "two")
    first, second = made[-2:]
    discard(one, spark.range(3), two.where("id > 1"))
    discard(one)
    assert not os.path.exists(first) and first not in made
    assert two.count() == 6 and second in made
