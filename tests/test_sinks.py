import json
from dataclasses import replace
from unittest.mock import patch

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.readwriter import DataFrameWriter

from voltstream.plans.windowed import plant_means
from voltstream.schemas import DEVICE_CHARGE, MONGO_TARGET, PLANT_WINDOW, RAW_TABLE
from voltstream.sinks.base import Sink, fan_out
from voltstream.sinks.console import console_sink, describe, preview_sink
from voltstream.sinks.files import csv_sink, parquet_sink
from voltstream.sinks.jdbc import ROW, jdbc_sink, numbered, postgres_sink
from voltstream.sinks.kafka import json_sink, record_frame, text_sink
from voltstream.sinks.mongo import mongo_sink, mongo_uri
from voltstream.streaming.commitlog import CommitLog
from voltstream.streaming.run import start


@pytest.fixture(scope="module")
def window_row(spark):
    return spark.sql(
        "SELECT 7 AS extra, 'Vara' AS planta_id, TIMESTAMP'2024-05-01 10:00:00' AS window_start,"
        " TIMESTAMP'2024-05-01 10:01:00' AS window_end, 1.5D AS Potencia, 2.5D AS Radiacion"
    )


class Recorder:
    """Stands in for ``DataFrameWriter.save``; fails the first ``failures`` times."""

    def __init__(self, failures=0):
        self.failures, self.frames, self.options, self.statements = failures, [], [], []

    def __enter__(self):
        set_option = DataFrameWriter.options
        self.patches = [
            patch.object(DataFrameWriter, "save", lambda writer, *a, **k: self.save(writer)),
            patch.object(
                DataFrameWriter,
                "options",
                lambda writer, **o: (self.options.append(o), set_option(writer, **o))[1],
            ),
            patch("voltstream.sinks.base.time.sleep"),
            patch("voltstream.sinks.jdbc.execute", lambda s, o, sql: self.statements.append(sql)),
        ]
        for p in self.patches:
            p.start()
        return self

    def __exit__(self, *_):
        for p in self.patches:
            p.stop()

    def save(self, writer):
        self.frames.append(writer._df)
        if len(self.frames) <= self.failures:
            raise RuntimeError("connection lost")


def jdbc(**more):
    return jdbc_sink("jdbc:x", "raw_fv_data", RAW_TABLE, "u", "p", **more)


@pytest.fixture(scope="module")
def raw_row(spark):
    return spark.sql(
        "SELECT 'm' AS message_id, 7 AS planta_id, '{}' AS message,"
        " TIMESTAMP'2024-05-01 10:01:02.000345' AS timestamp"
    )


def test_jdbc_options_and_columns(raw_row):
    with Recorder() as seen:
        jdbc().write(raw_row, 3)
    (frame,), (options,) = seen.frames, seen.options
    assert frame.dtypes[:-1] == list(RAW_TABLE.items())
    assert tuple(frame.first())[:-1] == ("m", "7", "{}", "2024-05-01 10:01:02.000345")
    assert options["batchsize"] == "200" and options["dbtable"] == "raw_fv_data_staging"
    ((merge,),) = seen.statements
    assert merge.startswith('INSERT INTO raw_fv_data ("message_id", "planta_id"')
    plan = frame._jdf.queryExecution().logical().toString()
    assert "Repartition 16, true" in plan
    assert options["driver"] == "org.postgresql.Driver"


def test_jdbc_batch_column(raw_row):
    with Recorder() as seen:
        jdbc(batch_column="batch_id").write(raw_row, 3)
    assert seen.frames[0].dtypes[-2] == ("batch_id", "bigint")
    assert seen.frames[0].first().batch_id == 3
    assert seen.statements[0][0] == 'DELETE FROM raw_fv_data WHERE "batch_id" = 3'


def test_jdbc_retries_five_times(raw_row):
    with Recorder(failures=5) as seen:
        jdbc().write(raw_row)
    assert len(seen.frames) == 6
    with Recorder(failures=6) as seen, pytest.raises(RuntimeError):
        jdbc().write(raw_row)
    assert len(seen.frames) == 6


def test_jdbc_does_not_repeat_what_no_retry_mends(raw_row):
    with Recorder(failures=9) as seen, pytest.raises(RuntimeError):
        with patch.object(Recorder, "save", lambda self, writer: self.fail(writer)):
            Recorder.fail = lambda self, writer: (self.frames.append(1), _raise("no such column"))
            jdbc().write(raw_row)
    assert len(seen.frames) == 1


def _raise(text):
    raise RuntimeError(text)


class Database:
    """Stands in for a database: runs the sink's statements on a table of its own.

    The first ``failures`` writes to the staging table keep half of the rows and lose the
    connection; each other one has a task run twice.
    """

    def __init__(self, columns, failures=0):
        self.failures, self.sql = failures, duckdb.connect()
        self.names = ", ".join(f'"{c}" {kind}' for c, kind in columns.items())
        self.sql.execute(f"CREATE TABLE t ({self.names})")

    def save(self, writer):
        frame = writer._df
        rows = [tuple(r) for r in frame.collect()]
        names = ", ".join([*self.names.split(", ")[: len(frame.columns) - 1], f'"{ROW}" BIGINT'])
        self.sql.execute(f"CREATE OR REPLACE TABLE t_staging ({names})")
        failed, self.failures = self.failures > 0, self.failures - 1
        kept = rows[: len(rows) // 2] if failed else rows + rows[:3]
        if kept:
            self.sql.executemany(f"INSERT INTO t_staging VALUES ({', '.join('?' * len(kept[0]))})", kept)
        if failed:
            raise RuntimeError("connection lost")

    def execute(self, session, options, statements):
        for statement in ("BEGIN", *statements, "COMMIT"):
            self.sql.execute(statement)

    def rows(self):
        return sorted(self.sql.execute("SELECT * FROM t").fetchall(), key=repr)

    def __enter__(self):
        self.patches = [
            patch.object(DataFrameWriter, "save", lambda writer, *a, **k: self.save(writer)),
            patch("voltstream.sinks.jdbc.execute", self.execute),
            patch("voltstream.sinks.base.time.sleep"),
        ]
        for p in self.patches:
            p.start()
        return self

    def __exit__(self, *_):
        for p in self.patches:
            p.stop()


RAW_COLUMNS = {"message_id": "VARCHAR", "planta_id": "VARCHAR", "message": "VARCHAR", "timestamp": "VARCHAR"}
WINDOW_COLUMNS = {"planta_id": "VARCHAR", "window_start": "TIMESTAMP", "window_end": "TIMESTAMP",
                  "Potencia": "DOUBLE", "Radiacion": "DOUBLE"}


@pytest.mark.parametrize("failures", [0, 1, 5])
def test_jdbc_leaves_each_row_once(spark, failures):
    rows = spark.range(20).selectExpr(
        "string(id % 15) AS message_id", "1 AS planta_id", "'{}' AS message", "NULL AS timestamp"
    )
    sink = jdbc_sink("jdbc:x", "t", RAW_TABLE, "u", "p", batch_column="batch_id")
    with Database({**RAW_COLUMNS, "batch_id": "BIGINT"}, failures) as database:
        sink.write(rows, 1)
        sink.write(rows, 1)  # a replay after the driver was lost
        sink.write(rows, 2)
    for batch in (1, 2):
        ids = sorted(int(r[0]) for r in database.rows() if r[-1] == batch)
        assert ids == sorted(n % 15 for n in range(20))


def plant_windows(spark, *rows):
    frame = spark.createDataFrame(list(rows), "planta_id STRING, minute INT, Potencia DOUBLE")
    start = F.timestamp_seconds(F.col("minute") * 60)
    return frame.select(
        "planta_id", start.alias("window_start"), (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
        "Potencia", F.lit(1.0).alias("Radiacion"),
    )


def keyed():
    return jdbc_sink("jdbc:x", "t", PLANT_WINDOW, "u", "p", key=("planta_id", "window_start"))


def seen(database):
    return [(plant, start.minute, power) for plant, start, _, power, _ in database.rows()]


@pytest.mark.parametrize("failures", [0, 2])
def test_a_keyed_table_has_the_last_row_of_each_key(spark, failures):
    with Database(WINDOW_COLUMNS, failures) as database:
        keyed().write(plant_windows(spark, ("a", 1, 1.0), ("b", 1, 1.0), (None, 1, 1.0)), 0)
        keyed().write(plant_windows(spark, ("a", 1, 2.0), (None, 1, 3.0), ("a", 2, 1.0)), 1)
        once = seen(database)
        keyed().write(plant_windows(spark, ("a", 1, 2.0), (None, 1, 3.0), ("a", 2, 1.0)), 1)
    assert sorted(once, key=repr) == sorted(
        [("a", 1, 2.0), ("a", 2, 1.0), ("b", 1, 1.0), (None, 1, 3.0)], key=repr
    )
    assert seen(database) == once


def test_rows_of_one_key_in_a_batch_leave_the_largest(spark):
    with Database(WINDOW_COLUMNS) as database:
        keyed().write(plant_windows(spark, ("a", 1, 1.0), ("a", 1, 5.0), ("a", 1, 3.0), ("a", 1, None)), 0)
    assert seen(database) == [("a", 1, 5.0)]


def test_a_job_run_to_its_end_twice_leaves_one_row_per_window(spark, tmp_path):
    """The second run emits the open window again, with more rows."""
    source, sink = tmp_path / "in", keyed()
    source.mkdir()

    def run():
        schema = "planta_id STRING, potencia DOUBLE, radiacion DOUBLE, at TIMESTAMP"
        readings = spark.readStream.schema(schema).json(str(source))
        means = plant_means(readings.withWatermark("at", "1 minute"), "at")
        start(means, sink, str(tmp_path / "checkpoint"), mode="update", to_end=True).awaitTermination()

    reading = {"planta_id": "a", "radiacion": 1.0, "at": "1970-01-01T00:01:30Z"}
    with Database(WINDOW_COLUMNS) as database:
        (source / "0.json").write_text(json.dumps({**reading, "potencia": 1.0}))
        run()
        assert seen(database) == [("a", 1, 1.0)]
        (source / "1.json").write_text(json.dumps({**reading, "potencia": 2.0}))
        run()
        run()
    assert seen(database) == [("a", 1, 1.5)]


def test_equal_rows_are_numbered_where_they_are(spark):
    """A third of all rows may be equal: no task gets them all, and all stay apart."""
    frame = spark.range(0, 9000, 1, 6).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS x")
    placed = numbered(frame)
    assert placed.distinct().count() == 9000
    largest = placed.where("x = -1").groupBy(F.shiftright(ROW, 32)).count().agg(F.max("count")).first()[0]
    assert largest == 500


def test_postgres_login_comes_from_the_environment(monkeypatch):
    with pytest.raises(KeyError):
        postgres_sink("t", RAW_TABLE, "db:5432")
    for name, value in (("DB", "plants"), ("USER", "u"), ("PASSWORD", "secret")):
        monkeypatch.setenv(f"POSTGRES_{name}", value)
    options = postgres_sink("t", RAW_TABLE, "db:5432").options
    assert options["url"] == "jdbc:postgresql://db:5432/plants"
    assert (options["user"], options["password"]) == ("u", "secret")


def test_kafka_record(window_row):
    ((key, value),) = record_frame(window_row.drop("extra"), key="planta_id").collect()
    assert key == "Vara"
    assert json.loads(value) == {
        "planta_id": "Vara",
        "window_start": "2024-05-01 10:00:00",
        "window_end": "2024-05-01 10:01:00",
        "Potencia": 1.5,
        "Radiacion": 2.5,
    }


def test_kafka_json_sink_writes_the_target_columns(window_row):
    sink = json_sink("h:9092", "fv_table", PLANT_WINDOW)
    assert sink.options == {"kafka.bootstrap.servers": "h:9092", "topic": "fv_table"}
    with Recorder() as seen:
        sink.write(window_row)
    ((value,),) = seen.frames[0].collect()
    assert list(json.loads(value)) == list(PLANT_WINDOW)


def test_kafka_key_is_the_device(spark):
    frame = spark.sql("SELECT 'd' AS device_id, now() AS window_start, now() AS window_end, 1 AS charge_consumed")
    sink = json_sink("h:9092", "device.charge", DEVICE_CHARGE, key="device_id")
    assert sink.prepare(frame).first().key == "d"


def test_kafka_text_sink_leaves_values_alone(spark):
    frame = spark.sql("SELECT 'x' AS value")
    with Recorder() as seen:
        text_sink("h:9092", "FV_alerts", **{"kafka.acks": "all"}).write(frame)
    assert seen.frames[0] is frame
    assert seen.options[0]["kafka.acks"] == "all"


class Mongo(DataSource):
    """Stands in for the connector: a document is a file, named by its id if it has one."""

    @classmethod
    def name(cls):
        return "mongodb"

    def writer(self, schema, overwrite):
        assert not overwrite
        return MongoWriter(dict(self.options))


class MongoWriter(DataSourceWriter):
    def __init__(self, options):
        self.options = options

    def write(self, rows):
        import hashlib
        import json
        import uuid

        folder = self.options["connection.uri"].removeprefix("mongodb://")
        for row in rows:
            name = hashlib.md5(row._id.encode()).hexdigest() if "_id" in row else uuid.uuid4().hex
            with open(f"{folder}/{name}", "w") as out:
                json.dump({"row": row.asDict(), "options": self.options}, out, default=str)
        return WriterCommitMessage()


@pytest.fixture
def collection(spark, tmp_path):
    spark.dataSource.register(Mongo)
    (tmp_path / "documents").mkdir()

    def read():
        return [json.loads(f.read_text()) for f in (tmp_path / "documents").iterdir()]

    return f"mongodb://{tmp_path}/documents", read


def test_mongo_documents(window_row, collection):
    uri, read = collection
    mongo_sink(uri, **MONGO_TARGET, target=PLANT_WINDOW).write(window_row, 0)
    (document,) = read()
    assert list(document["row"]) == ["_id", *PLANT_WINDOW]
    assert document["row"]["window_end"] == "2024-05-01 10:01:00"
    assert document["options"]["database"] == "monitorizacion"
    assert document["options"]["collection"] == "fv"
    assert document["options"]["idfieldlist"] == "_id" or document["options"]["idFieldList"] == "_id"


def test_a_replayed_batch_leaves_the_same_documents(spark, collection):
    uri, read = collection
    rows = plant_windows(spark, ("a", 1, 1.0), ("a", 1, 1.0), ("b", 1, 1.0), (None, 2, None)).coalesce(1)
    sink = mongo_sink(uri, **MONGO_TARGET, target=PLANT_WINDOW, name="means")
    sink.write(rows, 4)
    first = sorted(d["row"]["_id"] for d in read())
    sink.write(rows, 4)
    assert sorted(d["row"]["_id"] for d in read()) == first and len(first) == 4
    sink.write(rows, 5)
    assert len(read()) == 8
    sink.write(rows)  # not a stream: no batch to be replayed
    assert len(read()) == 12


def test_keyed_documents_are_replaced(spark, collection):
    uri, read = collection
    sink = mongo_sink(uri, **MONGO_TARGET, target=PLANT_WINDOW, key=("planta_id", "window_start"))
    sink.write(plant_windows(spark, ("a", 1, 1.0), ('a"', 1, 1.0), (None, 1, 1.0)), 0)
    sink.write(plant_windows(spark, ("a", 1, 7.0), ("a", 2, 1.0)), 1)
    found = {(d["row"]["planta_id"], d["row"]["window_start"][14:16]): d["row"]["Potencia"] for d in read()}
    assert found == {("a", "01"): 7.0, ('a"', "01"): 1.0, (None, "01"): 1.0, ("a", "02"): 1.0}
    assert len(read()) == 4


def test_mongo_tries_again(spark, collection):
    uri, read = collection
    failures = [1, 1]
    save = DataFrameWriter.save

    def flaky(writer, *args, **kwargs):
        save(writer, *args, **kwargs)
        if failures:
            failures.pop()
            raise RuntimeError("connection reset")

    with patch.object(DataFrameWriter, "save", flaky), patch("voltstream.sinks.base.time.sleep"):
        mongo_sink(uri, **MONGO_TARGET, target=PLANT_WINDOW).write(plant_windows(spark, ("a", 1, 1.0)), 0)
    assert len(read()) == 1 and not failures


def test_mongo_login_comes_from_the_environment(monkeypatch):
    monkeypatch.setenv("MONGO_INITDB_ROOT_USERNAME", "u")
    monkeypatch.setenv("MONGO_INITDB_ROOT_PASSWORD", "p")
    assert mongo_uri("mongo:27017") == "mongodb://u:p@mongo:27017"


@pytest.mark.parametrize("sink", [csv_sink, parquet_sink])
def test_replayed_batch_leaves_no_copies(spark, tmp_path, sink):
    target = sink(str(tmp_path / "out"))
    for batch_id in (0, 1, 1, 0):
        target.write(spark.range(10), batch_id)
    read = spark.read.schema("id BIGINT, batch_id BIGINT").format(target.format)
    assert read.load(str(tmp_path / "out")).count() == 20


def test_batch_writes_append(spark, tmp_path):
    target = parquet_sink(str(tmp_path / "out"))
    target.write(spark.range(3))
    target.write(spark.range(3))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_fan_out_computes_the_batch_once(spark, tmp_path):
    runs = spark.sparkContext.accumulator(0)

    @F.udf("bigint")
    def count(x):
        runs.add(1)
        return x

    frame = spark.range(50).select(count("id").alias("id"))
    both = fan_out(parquet_sink(str(tmp_path / "a")), csv_sink(str(tmp_path / "b")))
    both.write(frame, 0)
    assert runs.value == 50
    assert spark.read.parquet(str(tmp_path / "a")).count() == 50
    assert spark.read.schema("id BIGINT").csv(str(tmp_path / "b")).count() == 50
    assert not frame.is_cached


def test_fan_out_frees_the_batch_when_a_sink_fails(spark):
    def fail(frame, batch_id):
        raise RuntimeError("down")

    frame = spark.range(5)
    with pytest.raises(RuntimeError):
        fan_out(Sink("x", native=False, custom_write=fail)).write(frame, 0)
    assert not frame.is_cached


def test_a_replay_passes_over_the_parts_that_have_the_batch(spark, tmp_path):
    got, crashes = [], [1]

    def append(frame, batch_id):
        got.append((batch_id, frame.count()))

    def flaky(frame, batch_id):
        if crashes:
            crashes.pop()
            raise RuntimeError("down")

    parts = [Sink(name, native=False, custom_write=write) for name, write in (("a", append), ("b", flaky))]
    done = CommitLog(spark, str(tmp_path / "log"))
    for sink in (fan_out(*parts), fan_out(fan_out(*parts).fed(lambda f: f.limit(3)), parts[0])):
        got.clear()
        crashes[:] = [1]
        done = CommitLog(spark, str(tmp_path / f"log{len(sink.parts[0].parts)}"))
        with pytest.raises(RuntimeError):
            sink.write(spark.range(5), 0, done)
        sink.write(spark.range(5), 0, done)
        sink.write(spark.range(5), 0, done)
        nested = bool(sink.parts[0].parts)
        assert got == ([(0, 3), (0, 5)] if nested else [(0, 5)])
        sink.write(spark.range(4), 1, done)
        assert len(got) == (4 if nested else 2)


def test_console(spark, capfd):
    preview_sink(rows=2).write(spark.range(5), 0)
    console_sink(preview=1).write(spark.range(5), 0)
    describe(spark.range(2))
    out = capfd.readouterr().out
    assert "only showing top 2 rows" in out and "|-- id: long" in out


def test_native_sink_streams_natively(spark, tmp_path):
    stream = spark.readStream.schema("id BIGINT").parquet(str(tmp_path))
    with patch("pyspark.sql.streaming.readwriter.DataStreamWriter.format") as chosen:
        json_sink("h:9092", "t", {"id": "bigint"}).attach(stream)
    assert [c.args[0] for c in chosen.call_args_list] == ["kafka"]
    batchwise = replace(json_sink("h:9092", "t", {"id": "bigint"}), native=False)
    with patch("pyspark.sql.streaming.readwriter.DataStreamWriter.foreachBatch") as chosen:
        batchwise.attach(stream)
    chosen.assert_called_once_with(batchwise.write)
