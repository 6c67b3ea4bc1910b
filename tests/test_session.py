from voltstream.session import (
    INITIAL_PARTITIONS,
    PARTITIONS,
    PROVIDER,
    get_spark,
    sized_partitions,
)
from voltstream.streaming.run import _stream_settings


def test_defaults(spark):
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert "RocksDB" in spark.conf.get(PROVIDER)
    assert spark.conf.get(PARTITIONS) == "4"
    assert spark.conf.get(INITIAL_PARTITIONS) == "16"


def test_static_settings_reach_the_context(spark):
    assert spark.sparkContext.getConf().get("spark.driver.memory") == "4g"
    assert get_spark().sparkContext is spark.sparkContext
    spark.conf.set(PARTITIONS, "4")
    spark.conf.set(INITIAL_PARTITIONS, "16")


def test_partitions_never_fall_below_sparks_default(spark):
    class Context:
        defaultParallelism = 2

    class Session:
        sparkContext = Context()

    assert sized_partitions(Session()) == 200
    Context.defaultParallelism = 4000
    assert sized_partitions(Session()) == 8000


def test_a_stream_takes_its_own_number_of_partitions(spark):
    before = spark.conf.get(PARTITIONS)
    with _stream_settings(spark, 17):
        assert spark.conf.get(PARTITIONS) == "17"
    assert spark.conf.get(PARTITIONS) == before


def test_stream_settings_fill_gaps_and_leave_no_trace(spark):
    own = {key: spark.conf.get(key) for key in (PARTITIONS, PROVIDER)}
    try:
        with _stream_settings(spark):
            assert {key: spark.conf.get(key) for key in own} == own
        for key in own:
            spark.conf.unset(key)
        with _stream_settings(spark):
            assert spark.conf.get(PARTITIONS) == str(sized_partitions(spark))
            assert "RocksDB" in spark.conf.get(PROVIDER)
        assert spark.conf.get(PARTITIONS, None) is None
        assert spark.conf.get(PROVIDER, None) is None
    finally:
        for key, value in own.items():
            spark.conf.set(key, value)
