"""The six chunking strategies: a manifest of chunks, and the rows with their chunk number.

A chunk is a contiguous run of rows in a total order and holds at most ``chunk_rows`` rows.
Manifests read and sort key columns only; rows get their number by one sort over key ranges (see ``ranking``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import is_plain, quoted
from haulage.operators import ranking

IMAGE = "__image_"
SIGN = "__sign_"


def total_order(df: DataFrame, leading: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The leading columns, then every other column; values without an order are ordered by their text.

    Grouping takes -0.0 for 0.0, so a floating column is followed by a key that tells them apart.
    """
    reserved = [c for c in df.columns if c.startswith((IMAGE, SIGN))]
    if reserved:
        raise ValueError(f"columns {reserved} have names that paging uses")
    keys, images = [], {}
    for name in [*leading, *[c for c in df.columns if c not in leading]]:
        data_type = df.schema[name].dataType
        if is_plain(data_type):
            keys.append(name)
            if isinstance(data_type, (T.FloatType, T.DoubleType)):
                images[SIGN + name] = F.col(quoted(name)).cast("string") == "-0.0"
                keys.append(SIGN + name)
            continue
        column = F.col(quoted(name))
        text = F.hex(column) if isinstance(data_type, T.BinaryType) else F.to_json(F.struct(column))
        images[IMAGE + name] = text
        keys.append(IMAGE + name)
    return (df.withColumns(images) if images else df), keys


def _without_images(df: DataFrame) -> DataFrame:
    """The rows as they came: signs of zero put back, helping columns gone."""
    signs = {
        name: F.when(F.col(quoted(SIGN + name)), F.lit(-0.0).cast(df.schema[name].dataType)).otherwise(F.col(quoted(name)))
        for name in df.columns
        if SIGN + name in df.columns
    }
    return df.withColumns(signs).drop(*[c for c in df.columns if c.startswith((IMAGE, SIGN))])


def _manifest(edges: DataFrame, shown: Sequence[str]) -> DataFrame:
    lows = [F.col("lo")[k].alias(f"lo_{k}") for k in shown]
    highs = [F.col("hi")[k].alias(f"hi_{k}") for k in shown]
    return edges.select("iteration", "n_rows", *lows, *highs)


def clustered_manifest(df: DataFrame, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    """Single or composite primary key: exactly ``chunk_rows`` rows per chunk but the last."""
    return _manifest(ranking.page_edges(df, keys, chunk_rows, unique=True), keys)


def clustered_rows(df: DataFrame, keys: Sequence[str], chunk_rows: int) -> DataFrame:
    return ranking.assign_pages(df, keys, chunk_rows, unique=True)


def paged_manifest(df: DataFrame, order_by: Sequence[str], chunk_rows: int, shown: Sequence[str] = ()) -> DataFrame:
    """Limit/offset pages under a total order, so that pages neither overlap nor miss a row."""
    ordered, keys = total_order(df, order_by)
    return _manifest(ranking.page_edges(ordered, keys, chunk_rows, unique=False), shown or order_by)


def paged_rows(df: DataFrame, order_by: Sequence[str], chunk_rows: int) -> DataFrame:
    ordered, keys = total_order(df, order_by)
    return _without_images(ranking.assign_pages(ordered, keys, chunk_rows, unique=False))


def partition_manifest(
    df: DataFrame, partition: str, order_by: Sequence[str], chunk_rows: int, shown: Sequence[str] = ()
) -> DataFrame:
    """One chunk per source partition; a partition over the limit is paged inside."""
    ordered, keys = total_order(df, [partition, *order_by])
    edges = ranking.page_edges(ordered, keys, chunk_rows, unique=False, partition=partition)
    shown = list(shown or order_by)
    lows = [F.col("lo")[k].alias(f"lo_{k}") for k in shown]
    highs = [F.col("hi")[k].alias(f"hi_{k}") for k in shown]
    return edges.select("iteration", F.col("lo")[partition].alias(partition), "page", "n_rows", *lows, *highs)


def partition_rows(df: DataFrame, partition: str, order_by: Sequence[str], chunk_rows: int) -> DataFrame:
    ordered, keys = total_order(df, [partition, *order_by])
    return _without_images(ranking.assign_pages(ordered, keys, chunk_rows, unique=False, partition=partition))


def index_manifest(df: DataFrame, column: str, chunk_rows: int) -> DataFrame:
    """Pack whole values of an index column into chunks of at most ``chunk_rows`` rows."""
    return pack_values(df.groupBy(F.col(quoted(column)).alias("v")).agg(F.count(F.lit(1)).alias("n")), column, chunk_rows)


CHUNK = ["heavies_before", "heavy", "pack"]


def _packed(counts: DataFrame, column: str, chunk_rows: int) -> tuple[DataFrame, int, bool]:
    """Values (v, n) with the chunk they belong to (CHUNK) and their place among the light ones, the step of packing, and whether
    there is a NULL. ``counts`` is a written table."""
    heavy = F.col("n") * 2 > chunk_rows
    stats = counts.agg(
        F.max("n").alias("largest"),
        F.max(F.when(~heavy & F.col("v").isNotNull(), F.col("n"))).alias("light"),
        F.max(F.col("v").isNull()).alias("has_null"),
    ).first()
    if (stats["largest"] or 0) > chunk_rows:
        raise ValueError(f"a value of {column} exceeds {chunk_rows} rows: page by the index instead")
    values = counts.filter("v IS NOT NULL").select(
        "v", "n", heavy.cast("bigint").alias("heavy"), F.when(heavy, 0).otherwise(F.col("n")).alias("light")
    )
    packed = ranking.running_totals(values, ["v"], {"heavies_before": "heavy", "light_before": "light"})
    step = chunk_rows - (stats["light"] or 0) + 1
    group = F.when(F.col("heavy") == 1, 0).otherwise(F.floor(F.col("light_before") / step))
    return packed.withColumn("pack", group), step, bool(stats["has_null"])


def _numbered(packed: DataFrame, part: Column, shift: bool) -> DataFrame:
    """Chunks with their number, in value order; a chunk of NULLs comes before all others."""
    # parts first: sums per task, and a chunk's list is as long as it has parts
    parts = packed.groupBy(*CHUNK, F.when(F.col("heavy") == 1, 0).otherwise(part).alias("part")).agg(
        F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_values"), F.min("v").alias("lo"), F.max("v").alias("hi")
    )
    chunks = parts.groupBy(*CHUNK).agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_values").alias("n_values"),
        F.min("lo").alias("lo"),
        F.max("hi").alias("hi"),
        F.array_sort(F.collect_list("lo")).alias("part_lows"),
    )
    ranked = ranking.with_ranks(ranking.ordered(chunks, ["lo"]))
    return ranked.withColumn("iteration", (F.col("__at") + int(shift)).cast("int"))


def pack_values(counts: DataFrame, column: str, chunk_rows: int, part_rows: int | None = None) -> DataFrame:
    """Pack values (v, n) in value order. Input: one row per distinct value with its row count.

    With ``part_rows`` each chunk also gets ``part_lows``: the values at which its parts begin, so that a part holds at most
    that many rows besides those of its last value.

    Values over half a chunk stand alone. The others are packed by ``floor(rows_before / step)`` with
    ``step = chunk_rows - largest + 1``, which keeps the bound and makes chunks at least half full on
    average. NULL is a chunk of its own, before all others.
    """
    counts = ranking.written(counts, "value-counts")  # read three times below
    packed, step, has_null = _packed(counts, column, chunk_rows)
    part = F.floor((F.col("light_before") - F.col("pack") * step) / (part_rows or chunk_rows))
    lows = [] if part_rows is None else ["part_lows"]
    result = _numbered(packed, part, has_null).select(
        "iteration", "n_rows", "n_values", F.col("lo").alias(f"lo_{column}"), F.col("hi").alias(f"hi_{column}"), *lows
    )
    if not has_null:
        return result
    nulls = counts.filter("v IS NULL").select(
        F.lit(0).alias("iteration"),
        F.col("n").alias("n_rows"),
        F.lit(1).cast("bigint").alias("n_values"),
        F.col("v").alias(f"lo_{column}"),
        F.col("v").alias(f"hi_{column}"),
        *[F.array("v").alias(name) for name in lows],
    )
    return result.unionByName(nulls)


def index_rows(df: DataFrame, column: str, chunk_rows: int) -> DataFrame:
    """Rows with the number of their packed index chunk.

    Every value gets its number, then rows meet their value: in place while Spark finds the values small enough to broadcast,
    else in a join whose hot values it splits at run time.
    """
    counts = df.groupBy(F.col(quoted(column)).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    counts = ranking.written(counts, "value-counts")
    packed, _, has_null = _packed(counts, column, chunk_rows)
    chunks = _numbered(packed, F.lit(0), has_null).select(*CHUNK, "iteration")
    numbers = packed.join(chunks, CHUNK).select(F.col("v").alias("__v"), "iteration")
    if has_null:
        numbers = numbers.unionByName(counts.filter("v IS NULL").select(F.col("v").alias("__v"), F.lit(0).alias("iteration")))
    return df.join(numbers, df[column].eqNullSafe(numbers["__v"])).drop("__v")
