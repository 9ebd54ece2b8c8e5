"""The lake: chunk folders, reading them back, and the tables published over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import quoted

MAX_ROWS_PER_FILE = 5_000_000


def table_folder(folder: str, table: str) -> str:
    return f"{folder.rstrip('/')}/{table}/"


def run_folder(folder: str, table: str, run: int) -> str:
    """Where a run's chunks are; run 0 is from before runs had folders of their own."""
    return table_folder(folder, table) + (f"run={run}/" if run else "")


def run_table(table: str, run: int) -> str:
    return f"{table}__run_{run}"


def write_chunks(df: DataFrame, folder: str, write_format: str) -> None:
    """Write rows with their ``iteration``; only the folders of the iterations present are replaced.

    Files are split by row count, so that what one task wrote is read by several.
    """
    (
        df.write.format(write_format)
        .partitionBy("iteration")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_ROWS_PER_FILE)
        .save(folder)
    )


def with_iteration(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("iteration", T.IntegerType())])


def write_empty(spark: SparkSession, schema: T.StructType, folder: str, write_format: str) -> None:
    empty = spark.createDataFrame([], with_iteration(schema))
    empty.write.format(write_format).partitionBy("iteration").mode("overwrite").save(folder)


def read_chunks(
    spark: SparkSession,
    folder: str,
    write_format: str,
    schema: T.StructType,
    iterations: Sequence[int] | None = None,
) -> DataFrame:
    """Landed rows, with the source's column types; a list of iterations prunes to their folders."""
    reader = spark.read.format(write_format)
    if write_format != "delta":
        reader = reader.schema(with_iteration(schema))
    df = reader.load(folder)
    return df if iterations is None else df.filter(F.col("iteration").isin(list(iterations)))


def delete_chunks(spark: SparkSession, folder: str, write_format: str, iterations: Sequence[int]) -> None:
    """Remove the files of chunks whose rows are gone at the source: an overwrite without rows keeps old ones."""
    if not iterations:
        return
    if write_format == "delta":
        listed = ", ".join(str(i) for i in iterations)
        spark.sql(f"DELETE FROM delta.`{folder}` WHERE iteration IN ({listed})")
        return
    jvm = spark._jvm
    for iteration in iterations:
        path = jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/iteration={iteration}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def delete_from(spark: SparkSession, folder: str, write_format: str, first: int) -> None:
    """Remove the files of all chunks numbered ``first`` and above: what a plan with more chunks had left."""
    if write_format == "delta":
        spark.sql(f"DELETE FROM delta.`{folder}` WHERE iteration >= {first}")
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return
    for found in system.listStatus(path):
        name, _, number = found.getPath().getName().partition("=")
        if name == "iteration" and number.isdigit() and int(number) >= first:
            system.delete(found.getPath(), True)


def publish(
    spark: SparkSession, database: str, table: str, schema: T.StructType, folder: str, write_format: str, run: int = 0
) -> str:
    """Let readers see a run: a table over its folder, then one replacement of the view that bears the table's name.

    Until that replacement readers see the run before, whole; from then on this one. A run that is published again (after a
    rerun of its chunks) is refreshed in place.
    """
    name, own = f"{quoted(database)}.{quoted(table)}", f"{quoted(database)}.{quoted(run_table(table, run))}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    _register(spark, own, schema, folder, write_format)
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")  # published before there were runs; its files stay
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {own}")
    return name


def _register(spark: SparkSession, name: str, schema: T.StructType, folder: str, write_format: str) -> None:
    """A table over a run's folder; one whose columns no longer fit is registered anew, its files stay where they are."""
    location = folder.replace("\\", "\\\\").replace("'", "\\'")
    if write_format == "delta":
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING delta LOCATION '{location}'")
        spark.sql(f"REFRESH TABLE {name}")
        return
    wanted = [(f.name.lower(), f.dataType) for f in with_iteration(schema)]
    if spark.catalog.tableExists(name):
        known = [(f.name.lower(), f.dataType) for f in spark.table(name).schema]
        if known != wanted:
            spark.sql(f"DROP TABLE {name}")
    columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in with_iteration(schema))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {write_format} "
        f"PARTITIONED BY (iteration) LOCATION '{location}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.sql(f"REFRESH TABLE {name}")


def drop_runs(spark: SparkSession, database: str, table: str, folder: str, keep: Sequence[int]) -> list[int]:
    """Remove tables and files of all runs but these; ``folder`` is the table's. Returns the runs removed.

    Called after a publication with the new run and the one before it, which readers may still be reading.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = set()
    for found in system.listStatus(path) if system.exists(path) else []:
        name, _, number = found.getPath().getName().partition("=")
        run = int(number) if name == "run" and number.isdigit() else 0 if name == "iteration" else None
        if run is not None and run not in keep:
            spark.sql(f"DROP TABLE IF EXISTS {quoted(database)}.{quoted(run_table(table, run))}")
            system.delete(found.getPath(), True)
            gone.add(run)
    return sorted(gone)
