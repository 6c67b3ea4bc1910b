import pytest

from voltstream.schemas import DEVICE_READING
from voltstream.sources.kafka import kafka_table, kafka_values
from voltstream.streaming.workdir import fresh_dir, job_dir, remove_made


class FakeReader:
    """Records what a Kafka reader was asked for and returns fixed records."""

    def __init__(self, spark, kind):
        self.spark, self.kind, self.asked = spark, kind, {}

    def format(self, name):
        assert name == "kafka"
        return self

    def options(self, **options):
        self.asked = options
        return self

    def load(self):
        return self.spark.sql(
            "SELECT CAST('d' AS BINARY) AS key, timestamp_millis(1000) AS timestamp,"
            """ CAST('{"device_id": "d", "motion": true, "ts": 5}' AS BINARY) AS value"""
        )


class FakeSession:
    def __init__(self, spark):
        self.readStream = FakeReader(spark, "stream")
        self.read = FakeReader(spark, "batch")


def test_stream_starts_at_the_latest_offset_by_default(spark):
    session = FakeSession(spark)
    values = kafka_values(session, "h:9092", "FV", group="iot-sensors")
    assert session.readStream.asked == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "FV",
        "startingOffsets": "latest",
        "groupIdPrefix": "iot-sensors",
    }
    assert values.dtypes == [("value", "string")]


def test_earliest_flag_options_and_arrival(spark):
    session = FakeSession(spark)
    values = kafka_values(
        session, "h:9092", "FV", earliest=True, arrival="arrived", minPartitions="64"
    )
    assert session.readStream.asked["startingOffsets"] == "earliest"
    assert session.readStream.asked["minPartitions"] == "64"
    assert values.columns == ["value", "arrived"]


def test_batch_read_has_no_latest_start(spark):
    session = FakeSession(spark)
    kafka_values(session, "h:9092", "FV", stream=False)
    assert "startingOffsets" not in session.read.asked


def test_a_callers_start_is_kept(spark):
    session = FakeSession(spark)
    kafka_values(session, "h:9092", "FV", startingOffsets='{"FV":{"0":5}}')
    assert session.readStream.asked["startingOffsets"] == '{"FV":{"0":5}}'


def test_json_table_parses_the_named_fields_only(spark):
    table = kafka_table(FakeSession(spark), "h:9092", "t", DEVICE_READING, fields=("ts",))
    assert table.columns == ["ts"] and table.first().ts == 5
    plan = table._jdf.queryExecution().analyzed().toString()
    assert "from_json(StructField(ts,LongType,true), " in plan


def test_json_table_reads_from_the_start(spark):
    session = FakeSession(spark)
    table = kafka_table(session, "h:9092", "sensor.readings", DEVICE_READING)
    assert session.readStream.asked["startingOffsets"] == "earliest"
    ((device, *_, ts),) = table.collect()
    assert (device, ts, table.first().motion) == ("d", 5, True)
    assert ", ".join(f"{n} {t.upper()}" for n, t in table.dtypes) == DEVICE_READING


class FakeContext:
    master, applicationId = "yarn", "app-x"


class FakeCluster:
    sparkContext = FakeContext()

    def __init__(self, **settings):
        self.conf = settings


def test_folders_lie_under_the_setting(spark):
    cluster = FakeCluster(**{"spark.checkpoint.dir": "hdfs:///shared/"})
    first, second = fresh_dir(cluster, "x"), fresh_dir(cluster, "x")
    assert first.startswith("hdfs:///shared/x-") and first != second
    assert job_dir(cluster, "means") == "hdfs:///shared/jobs/means"


def test_cluster_without_the_setting_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        fresh_dir(FakeCluster(), "x")


@pytest.mark.parametrize("master", ["local-cluster[2,1,1024]", "spark://h:7077"])
def test_only_a_single_machine_goes_without(monkeypatch, master):
    monkeypatch.setattr(FakeContext, "master", master)
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        fresh_dir(FakeCluster(), "x")


def test_made_folders_can_be_removed(spark):
    folder = fresh_dir(spark, "x")
    spark.range(3).write.parquet(folder)
    assert remove_made(spark) >= 1
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(folder)


def test_local_session_gets_one_root(spark):
    assert fresh_dir(spark, "x").rsplit("/", 1)[0] == fresh_dir(spark, "y").rsplit("/", 1)[0]
