"""Which chunking strategy a table gets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulage.functions.ordering import quoted


def index_statistics(df: DataFrame, table_key: str, column: str, approximate: bool = False) -> DataFrame:
    """Rows, distinct values and rows of the most frequent value of an index column (NULL counts as a value).

    Counts per value are combined before the shuffle, so a hot value costs one row per task. The approximate
    form shuffles no values; it does not know the most frequent one.
    """
    if approximate:
        stats = df.agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.approx_count_distinct(quoted(column)).alias("n_values"),
            F.lit(None).cast("bigint").alias("max_rows"),
        )
    else:
        per_value = df.groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("n"))
        stats = per_value.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.lit(1)).alias("n_values"),
            F.max("n").alias("max_rows"),
        )
    return stats.select(F.lit(table_key).alias("table_key"), F.lit(column).alias("column_name"), "*")


def index_decision(statistics: DataFrame, chunk_rows: int | Column) -> DataFrame:
    """'yes' if whole values can be packed: small enough on average, and none alone exceeds a chunk."""
    limit = F.lit(chunk_rows) if isinstance(chunk_rows, int) else chunk_rows
    fits = (F.col("n_rows") / F.nullif("n_values", F.lit(0)) <= limit) & (F.coalesce("max_rows", F.lit(0)) <= limit)
    return statistics.withColumn("decision", F.when(fits, "yes").otherwise("no"))


def strategy_selection(profile: DataFrame) -> DataFrame:
    """Access path of every table at once.

    Input: table_key, vendor, n_key_columns, n_index_columns, decision, n_partitions.
    """
    keys = F.coalesce("n_key_columns", F.lit(0))
    indexes = F.coalesce("n_index_columns", F.lit(0))
    partitions = F.coalesce("n_partitions", F.lit(0))
    strategy = (
        F.when(keys == 1, "clustered")
        .when(keys > 1, "composite_clustered")
        .when((indexes > 0) & F.col("decision").eqNullSafe("yes"), "non_clustered")
        .when(indexes > 0, "non_clustered_limit_offset")
        .when((partitions >= 2) & (F.col("vendor") != "ibm"), "partition")
        .otherwise("limit_offset")
    )
    return profile.withColumn("strategy", strategy)
