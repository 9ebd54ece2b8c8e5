"""A database as target: chunks go to a staging table first, so a rerun never repeats rows."""

from __future__ import annotations

from collections.abc import Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haulage.sources.jdbc import Connection, query_frame, range_frame, table_frame, table_statistics
from haulage.sources.vendors import quote, table_name

STAGE_SUFFIX = "_STAGE"
NUMBER = "ITERATION"


@contextmanager
def _statements(spark: SparkSession, connection: Connection):
    """One transaction on the driver, for statements only; rows always go through executors."""
    jvm = spark._jvm
    jvm.java.lang.Class.forName(connection.driver, True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
    properties = jvm.java.util.Properties()
    for key, value in (("user", connection.user), ("password", connection.password)):
        if value is not None:
            properties.setProperty(key, value)
    opened = jvm.java.sql.DriverManager.getConnection(connection.url, properties)
    try:
        opened.setAutoCommit(False)
        statement = opened.createStatement()
        yield statement.executeUpdate
        opened.commit()
    except Exception:
        opened.rollback()
        raise
    finally:
        opened.close()


def table_exists(spark: SparkSession, connection: Connection, name: str) -> bool:
    try:
        query_frame(spark, connection, f"SELECT * FROM {name} WHERE 1 = 0").schema
        return True
    except Exception:
        return False


class RdbmsTarget:
    """Target table plus the staging table that holds every chunk with its number."""

    def __init__(self, spark: SparkSession, connection: Connection, table: str, schema: str | None = None):
        self.spark = spark
        self.connection = connection
        self.table = table_name(connection.vendor, table, schema)
        self.stage = table_name(connection.vendor, table + STAGE_SUFFIX, schema)
        self.number = quote(connection.vendor, NUMBER)

    def write_chunks(self, df: DataFrame, iterations: Sequence[int]) -> None:
        """Replace the staged rows of these iterations."""
        if table_exists(self.spark, self.connection, self.stage):
            listed = ", ".join(str(i) for i in iterations)
            with _statements(self.spark, self.connection) as execute:
                execute(f"DELETE FROM {self.stage} WHERE {self.number} IN ({listed})")
        self._append(df.withColumnRenamed("iteration", NUMBER), self.stage)

    def _append(self, df: DataFrame, name: str) -> None:
        df.write.format("jdbc").options(**self.connection.options()).option("dbtable", name).mode("append").save()

    def staged(self, iterations: Sequence[int] | None = None) -> DataFrame:
        """Staged rows; of given chunks, each read by a task of its own."""
        if iterations is None:
            df = table_frame(self.spark, self.connection, self.stage)
        else:
            df = range_frame(self.spark, self.connection, self.stage, [f"{self.number} = {i}" for i in iterations])
        return df.withColumnRenamed(NUMBER, "iteration")

    def statistics(self, schema: T.StructType, columns: Sequence[str]) -> DataFrame:
        """Counts, minima and maxima of the staged rows, computed by the database."""
        return table_statistics(self.spark, self.connection, self.stage, schema, columns)

    def delete_from(self, first: int) -> None:
        """Remove staged chunks numbered ``first`` and above."""
        if table_exists(self.spark, self.connection, self.stage):
            with _statements(self.spark, self.connection) as execute:
                execute(f"DELETE FROM {self.stage} WHERE {self.number} >= {first}")

    def staged_counts(self, iterations: Sequence[int]) -> dict[int, int]:
        """Rows per chunk in the staging table, counted by the database."""
        listed = ", ".join(str(i) for i in iterations)
        found = query_frame(
            self.spark,
            self.connection,
            f"SELECT {self.number} AS chunk_number, COUNT(*) AS chunk_rows FROM {self.stage} "
            f"WHERE {self.number} IN ({listed}) GROUP BY {self.number}",
        )
        return {r[0]: r[1] for r in found.collect()}

    def promote(self, columns: Sequence[str]) -> None:
        """Fill the target from the staging table in one transaction inside the database."""
        listed = ", ".join(quote(self.connection.vendor, c) for c in columns)
        if not table_exists(self.spark, self.connection, self.table):
            self._append(self.staged().select(*columns).limit(0), self.table)
        with _statements(self.spark, self.connection) as execute:
            execute(f"DELETE FROM {self.table}")
            execute(f"INSERT INTO {self.table} ({listed}) SELECT {listed} FROM {self.stage}")
