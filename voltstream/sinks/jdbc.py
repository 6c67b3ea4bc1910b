"""Relational tables over JDBC. Needs the database's driver on the cluster."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from voltstream.functions.records import conform
from voltstream.sinks.base import Sink

# Rows per insert batch, flush interval, retries after a failure.
BATCH_SIZE = 200
FLUSH_EVERY = "1 second"
RETRIES = 5


# Name of the column that tells the rows of one batch apart in the staging table.
ROW = "_row"
PLACE = "_place"


def jdbc_sink(
    url: str,
    table: str,
    target: dict[str, str],
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    connections: int = 16,
    batch_column: str | None = None,
    key: tuple[str, ...] = (),
) -> Sink:
    """Rows of the target schema into an existing table, each once.

    A batch first goes to ``<table>_staging``, overwriting it, and from there into the
    table in one transaction. An attempt that fails half-way, or a task that runs
    twice, so leaves its copies in the staging table, where rows carry a stable number
    and are taken once. One stream or job may write to a table at a time.

    ``key`` names the columns that tell rows apart, a window and its plant or a message's
    id: the table then has one row per key, that of the last batch, whatever is replayed,
    restarted or emitted again. The transaction takes the old rows of the batch's keys
    out, so the table needs no unique index, though one on the key makes that fast. Of
    several rows of one key in a batch the largest counts. A null in a key is a value
    like any other.

    ``batch_column`` names an extra BIGINT column of the table that receives the
    micro-batch number; the transaction clears that batch first, so a batch replayed
    after a loss of the driver is not doubled either. It serves tables without a key.
    With neither, delivery is at least once in that one case. ``connections`` is how many tasks write at the same time,
    whatever the size of the cluster: the database, not Spark, is the narrow side.
    """
    options = {
        "url": url,
        "dbtable": f"{table}_staging",
        "user": user,
        "password": password,
        "driver": driver,
        "batchsize": str(BATCH_SIZE),
    }

    def insert(frame: DataFrame, batch_id: int | None) -> None:
        if batch_column is not None:
            frame = frame.withColumn(batch_column, F.lit(batch_id).cast("bigint"))
        columns = frame.columns
        staged = (one_per_key(frame, key) if key else numbered(frame)).repartition(connections)
        staged.write.format("jdbc").options(**options).mode("overwrite").save()
        statements = [merge_statement(table, columns)]
        if batch_column is not None and batch_id is not None:
            statements.insert(0, f'DELETE FROM {table} WHERE "{batch_column}" = {int(batch_id)}')
        if key:
            statements.insert(0, outdated_statement(table, key))
        execute(frame.sparkSession, options, statements)

    return Sink(
        "jdbc",
        options,
        prepare=lambda frame: conform(frame, target),
        native=False,
        retries=RETRIES,
        custom_write=insert,
    )


def one_per_key(frame: DataFrame, key: tuple[str, ...]) -> DataFrame:
    """The largest row of every key, summed up before its shuffle."""
    others = [c for c in frame.columns if c not in key]
    largest = F.max(F.struct(*(F.col(f"`{c}`") for c in others)) if others else F.lit(1)).alias(ROW)
    found = frame.groupBy(*(F.col(f"`{c}`") for c in key)).agg(largest)
    columns = (F.col(f"`{c}`") if c in key else F.col(ROW)[c].alias(c) for c in frame.columns)
    return found.select(*columns, F.lit(1).alias(ROW))


def numbered(frame: DataFrame) -> DataFrame:
    """Add a number per row that a repeated task computes alike.

    It counts rows that are equal in all columns, so that those stay apart; unequal
    rows are apart anyway. Each partition counts its own, so that any number of equal
    rows is spread as it came; the partition is part of the number.
    """
    columns = [F.col(f"`{c}`") for c in frame.columns]
    placed = frame.withColumn(PLACE, F.spark_partition_id())
    same = Window.partitionBy(*columns, PLACE).orderBy(F.lit(0))
    number = F.shiftleft(F.col(PLACE).cast("bigint"), 32) + F.row_number().over(same)
    return placed.withColumn(ROW, number).drop(PLACE)


def merge_statement(table: str, columns: list[str]) -> str:
    """Take every distinct row of the staging table into the table."""
    names = ", ".join(f'"{c}"' for c in columns)
    staged = f'SELECT DISTINCT {names}, "{ROW}" FROM {table}_staging'
    return f"INSERT INTO {table} ({names}) SELECT {names} FROM ({staged}) AS s"


def outdated_statement(table: str, key: tuple[str, ...]) -> str:
    """Take out the rows of the table whose key the staging table has."""
    both = (f'(s."{c}" = {table}."{c}" OR (s."{c}" IS NULL AND {table}."{c}" IS NULL))' for c in key)
    return f"DELETE FROM {table} WHERE EXISTS (SELECT 1 FROM {table}_staging AS s WHERE {' AND '.join(both)})"


def execute(spark: SparkSession, options: dict[str, str], statements: list[str]) -> None:
    """Run the statements in one transaction, from the driver, all or none."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(
        options["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader()
    )
    connection = jvm.java.sql.DriverManager.getConnection(
        options["url"], options["user"], options["password"]
    )
    try:
        connection.setAutoCommit(False)
        for statement in statements:
            connection.createStatement().executeUpdate(statement)
        connection.commit()
    finally:
        connection.close()


def postgres_sink(table: str, target: dict[str, str], host: str, **options) -> Sink:
    """``jdbc_sink`` with database and login from POSTGRES_DB, _USER and _PASSWORD."""
    return jdbc_sink(
        f"jdbc:postgresql://{host}/{os.environ['POSTGRES_DB']}",
        table,
        target,
        user=os.environ["POSTGRES_USER"],
        password=os.environ["POSTGRES_PASSWORD"],
        **options,
    )
