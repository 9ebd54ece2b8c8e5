"""One landed copy of a table (raw or masked), in the lake or in a database."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haulage.sources import lake, vendors
from haulage.sources.config import Target
from haulage.sources.jdbc import Connection
from haulage.sources.rdbms import RdbmsTarget

MASKED_SUFFIX = "_masked"


class LakeCopy:
    """A run's files; readers see them from `publish` on, and until then the run before."""

    def __init__(
        self, spark: SparkSession, target: Target, table: str, schema: T.StructType, masked: bool = False, run: int = 0
    ):
        folder = target.masked_folder if masked else target.folder
        if folder is None:
            raise ValueError(f"the target names no {'masked ' if masked else ''}folder")
        self.spark = spark
        self.format = target.write_format
        self.run = run
        self.table_folder = lake.table_folder(folder, table)
        self.folder = lake.run_folder(folder, table, run)
        self.schema = schema
        self.zone = target.masked_zone if masked else target.raw_zone
        self.published_as = table + MASKED_SUFFIX if masked else table

    def write(self, df: DataFrame, iterations: Sequence[int]) -> None:
        lake.write_chunks(df, self.folder, self.format)

    def write_empty(self) -> None:
        lake.write_empty(self.spark, self.schema, self.folder, self.format)

    def read(self, iterations: Sequence[int] | None = None) -> DataFrame:
        return lake.read_chunks(self.spark, self.folder, self.format, self.schema, iterations)

    def statistics(self, columns: Sequence[str]) -> DataFrame | None:
        """Files are read by Spark."""
        return None

    def settle(self, rows: dict[int, int]) -> None:
        """After a write: remove what chunks without rows had left behind. The write itself is all or nothing."""
        emptied = [number for number, n in rows.items() if not n]
        lake.delete_chunks(self.spark, self.folder, self.format, emptied)

    def keep_first(self, chunks: int) -> None:
        """Remove chunks of an earlier, longer plan."""
        lake.delete_from(self.spark, self.folder, self.format, chunks)

    def publish(self, before: int | None = None) -> str:
        """``before``: the run that readers have seen until now; it is kept for those that still read it."""
        name = lake.publish(self.spark, self.zone, self.published_as, self.schema, self.folder, self.format, self.run)
        if self.run:
            lake.drop_runs(self.spark, self.zone, self.published_as, self.table_folder, (self.run, before or 0))
        return name


class RdbmsCopy:
    def __init__(
        self,
        spark: SparkSession,
        connection: Connection,
        table: str,
        schema: T.StructType,
        schema_name: str | None = None,
        masked: bool = False,
    ):
        self.target = RdbmsTarget(spark, connection, table + MASKED_SUFFIX if masked else table, schema_name)
        self.spark = spark
        self.schema = schema

    def write(self, df: DataFrame, iterations: Sequence[int]) -> None:
        self.target.write_chunks(df, iterations)

    def write_empty(self) -> None:
        with_number = T.StructType([*self.schema.fields, T.StructField("iteration", T.IntegerType())])
        self.target.write_chunks(self.spark.createDataFrame([], with_number), [0])

    def read(self, iterations: Sequence[int] | None = None) -> DataFrame:
        return self.target.staged(iterations)

    def statistics(self, columns: Sequence[str]) -> DataFrame | None:
        """Of all staged rows, computed by the database; none where the staging table's text has no order there."""
        text = any(isinstance(f.dataType, T.StringType) for f in self.schema)
        if text and self.target.connection.vendor in vendors.TEXT_AS_OBJECTS:
            return None
        return self.target.statistics(self.schema, columns)

    def settle(self, rows: dict[int, int]) -> None:
        """After a write: a task that ran twice may have inserted twice, so the rows are counted."""
        staged = self.target.staged_counts(list(rows))
        wrong = [number for number, n in rows.items() if staged.get(number, 0) != n]
        if wrong:
            raise RuntimeError(f"staged rows of chunks {wrong} differ from the rows read")

    def keep_first(self, chunks: int) -> None:
        self.target.delete_from(chunks)

    def publish(self, before: int | None = None) -> str:
        self.target.promote(self.schema.fieldNames())
        return self.target.table


Copy = LakeCopy | RdbmsCopy
