"""Keys, indexes and partitions out of the sources' catalog rows, for all tables at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.functions.ordering import quoted


def key_columns(metadata: DataFrame) -> DataFrame:
    """Key columns in key order, repeated catalog rows removed.

    Input: table_key, column_name, ordinal_position. The dedup is an aggregate (combined before the
    shuffle); the window then sees one row per column of a table.
    """
    once = metadata.groupBy("table_key", "column_name").agg(F.min("ordinal_position").alias("ordinal_position"))
    order = Window.partitionBy("table_key").orderBy("ordinal_position", "column_name")
    return once.select("table_key", "column_name", F.row_number().over(order).alias("key_position"))


def index_columns(metadata: DataFrame, signed_lists: bool = True) -> DataFrame:
    """Index columns in index order; position 1 is the column that decides the strategy.

    Input: table_key, indexed_column, position. With ``signed_lists`` a value such as ``+A-B`` lists
    several columns with their sort direction and becomes one row per column.
    """
    listed = metadata.groupBy("table_key", "indexed_column").agg(F.min("position").alias("position"))
    if signed_lists:
        names = F.posexplode(F.split("indexed_column", "[+-]")).alias("place", "column_name")
    else:
        names = F.posexplode(F.array("indexed_column")).alias("place", "column_name")
    parts = listed.select("table_key", "position", names).filter("column_name <> ''")
    once = parts.groupBy("table_key", "column_name").agg(F.min(F.struct("position", "place")).alias("first"))
    order = Window.partitionBy("table_key").orderBy("first", "column_name")
    return once.select("table_key", "column_name", F.row_number().over(order).alias("index_position"))


def partition_profile(partitions: DataFrame) -> DataFrame:
    """Number of partitions per table; a single one is an index in disguise, not a partitioning.

    Input: table_key, partition_name (one row per partition).
    """
    return partitions.groupBy("table_key").agg(
        F.count(F.lit(1)).alias("n_partitions"), (F.count(F.lit(1)) >= 2).alias("is_partitioned")
    )


def lake_partitions(df: DataFrame, table_key: str, column: str) -> DataFrame:
    """Partition rows of a table that lives in the lake, with their sizes."""
    return df.groupBy(F.col(quoted(column)).cast("string").alias("partition_name")).agg(
        F.lit(table_key).alias("table_key"), F.count(F.lit(1)).alias("n_rows")
    )


def verified_key(df: DataFrame, table_key: str, columns: list[str]) -> DataFrame:
    """How many columns the declared key really has: 0 when it repeats or holds NULLs.

    Key-range chunks rely on uniqueness, so a source that does not enforce its key falls through to
    the next strategy.
    """
    keys = [F.col(quoted(c)) for c in columns]
    null = F.lit(False)
    for key in keys:
        null = null | key.isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.max(null).alias("has_null"))
    broken = F.coalesce(F.max((F.col("n") > 1) | F.col("has_null")), F.lit(False))
    return per_key.agg(
        F.lit(table_key).alias("table_key"), F.when(broken, 0).otherwise(len(columns)).alias("n_key_columns")
    )
