"""Row counts, sizes and the number of rows one chunk may hold."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import quoted

# Results depend on them.
DEFAULT_TABLE_SIZE_MB = 0.1
MIN_AVG_ROW_MB = 0.00000001
BYTES_PER_MB = 1048576

FIXED_WIDTHS = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.FloatType: 4,
    T.DateType: 4,
    T.LongType: 8,
    T.DoubleType: 8,
    T.TimestampType: 8,
    T.TimestampNTZType: 8,
    T.DecimalType: 16,
}


def _value_bytes(column: Column, data_type: T.DataType) -> Column | int:
    """Bytes of one value: a number for fixed widths (the column is then not even read)."""
    width = FIXED_WIDTHS.get(type(data_type))
    if width is not None:
        return width
    if isinstance(data_type, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)).cast("bigint")
    if isinstance(data_type, T.ArrayType):
        inner = FIXED_WIDTHS.get(type(data_type.elementType))
        if inner is not None:
            return F.coalesce(F.size(column).cast("bigint") * inner, F.lit(0).cast("bigint"))
    return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)).cast("bigint")


def table_bytes(df: DataFrame, table_key: str) -> DataFrame:
    """One row: exact row count and payload bytes (NULL for a table without rows), in one scan."""
    sizes = [_value_bytes(F.col(quoted(f.name)), f.dataType) for f in df.schema]
    fixed = sum(s for s in sizes if isinstance(s, int))
    row = reduce(lambda a, b: a + b, [s for s in sizes if not isinstance(s, int)], F.lit(fixed).cast("bigint"))
    return df.agg(
        F.lit(table_key).alias("table_key"),
        F.count(F.lit(1)).alias("table_count"),
        F.sum(row).alias("table_bytes"),
    )


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Count, size and average row size of every table; all tables are one job."""
    sized = reduce(DataFrame.unionByName, [table_bytes(df, key) for key, df in tables.items()])
    counts = sized.select("table_key", "table_count", (F.col("table_bytes") / BYTES_PER_MB).alias("table_size_mb"))
    return with_row_size(counts)


def with_row_size(counts: DataFrame) -> DataFrame:
    """Average row size from a count and a size that may be unknown (NULL)."""
    size = F.coalesce("table_size_mb", F.lit(DEFAULT_TABLE_SIZE_MB))
    average = size / F.nullif("table_count", F.lit(0))
    return counts.select(
        "table_key",
        "table_count",
        size.alias("table_size_mb"),
        F.when(average == 0, MIN_AVG_ROW_MB).otherwise(average).alias("avg_row_size_mb"),
    )


def profile_from_metadata(counts: DataFrame, sizes: DataFrame) -> DataFrame:
    """As ``table_profile``, for a source that reports counts and sizes in its catalog."""
    return with_row_size(counts.join(sizes, "table_key", "left").select("table_key", "table_count", "table_size_mb"))


def chunk_sizing(profile: DataFrame, cluster_threshold_mb: float) -> DataFrame:
    """Rows per chunk: threshold over average row size, half to even, at least one."""
    rows = F.bround(F.lit(float(cluster_threshold_mb)) / F.col("avg_row_size_mb"), 0).cast("bigint")
    return profile.select(
        "table_key", "table_count", "avg_row_size_mb", F.greatest(F.lit(1).cast("bigint"), rows).alias("chunk_rows")
    )


def table_eligibility(profile: DataFrame) -> DataFrame:
    """Tables without rows are not chunked; they get an empty copy and count as successful."""
    empty = F.col("table_count") < 1
    return profile.select(
        "table_key",
        "table_count",
        F.when(empty, "skip").otherwise("extract").alias("action"),
        F.when(empty, "Success").alias("status"),
    )


def cluster_threshold_mb(spark, share: float = 1 / 3) -> float:
    """A chunk may fill this share of the executors' memory, as configured in the session.

    Under dynamic allocation the executors that it may grow to count, or else those it begins with. With two 32 GB executors and a third of the memory, a 64 GB table takes three chunks.
    """
    memory = spark.conf.get("spark.executor.memory", "1g").strip().lower()
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    number = memory.rstrip("bkmgt")
    unit = memory[len(number) : len(number) + 1]
    executors = spark.conf.get("spark.executor.instances", None)
    if executors is None and spark.conf.get("spark.dynamicAllocation.enabled", "false") == "true":
        named = [spark.conf.get(f"spark.dynamicAllocation.{n}Executors", None) for n in ("max", "initial", "min")]
        executors = next((n for n in named if n not in (None, "infinity", str(2**31 - 1))), None)
    return float(number) * (units[unit] if unit else 1) * max(int(executors or 1), 1) * share
