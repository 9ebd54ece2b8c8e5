"""Exact ranks, pages and running totals from one sort that is written down.

Rows are partitioned by ranges of their keys, sorted, and written to the shared folder once, each with the number of its
partition and its place there. The sizes of the partitions, one row each, tell at which rank each of them starts; start plus
place is a row's rank. Nothing is sorted in one task, and nothing but those sizes is put together. Running totals are counted
inside stretches of a partition, so no partition is gathered again: there the sizes are of stretches, a row per 65,536 rows.

Ranges are cut over the whole tuple, so a leading value that holds a third of the table is split by the later columns; full
copies are counted, per task first, before they are sorted, and written out again in blocks afterwards.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import quoted

PART, NTH, STRETCH = "__part", "__nth", "__stretch"
COPIES_PER_STEP = 4096
#: Rows of a stretch, as a power of two.
STRETCH_BITS = 16
#: Bits of monotonically_increasing_id() that count rows inside a partition.
PLACE_BITS = 33


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder that nothing else uses, among those that all executors share."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, computed once, from the folder that all executors share."""
    path = new_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ordered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df in key order over all partitions, written, with partition number and place in it."""
    order = [F.col(quoted(k)).asc_nulls_first() for k in keys]
    number = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn(PART, F.shiftright(number, PLACE_BITS).cast("int"))
    return written(rows.withColumn(NTH, number.bitwiseAND((1 << PLACE_BITS) - 1)), "ordered")


def with_totals(rows: DataFrame, sums: dict[str, str]) -> DataFrame:
    """Ordered rows; for each ``out: column`` add the column's sum over all earlier rows, and over all rows (``out_all``)."""
    rows = rows.withColumn(STRETCH, F.shiftright(NTH, STRETCH_BITS))
    sizes = rows.groupBy(PART, STRETCH).agg(*[F.sum(quoted(column)).alias(f"{out}_in") for out, column in sums.items()])
    before, every = Window.orderBy(PART, STRETCH).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    starts = sizes.select(
        PART,
        STRETCH,
        *[F.coalesce(F.sum(f"{out}_in").over(before), F.lit(0)).alias(f"{out}_start") for out in sums],
        *[F.sum(f"{out}_in").over(every).alias(f"{out}_all") for out in sums],
    )
    inside = Window.partitionBy(PART, STRETCH).orderBy(NTH).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(F.broadcast(starts), [PART, STRETCH])
    totals = {out: F.col(f"{out}_start") + F.sum(quoted(c)).over(inside) - F.col(quoted(c)) for out, c in sums.items()}
    return placed.withColumns(totals).drop(STRETCH, *[f"{out}_start" for out in sums])


def with_ranks(rows: DataFrame) -> DataFrame:
    """Ordered rows with __at, the rank from 0, and __span, the number of all rows; a projection beside the partition sizes."""
    sizes = rows.groupBy(PART).agg(F.count(F.lit(1)).alias("__size"))
    before, every = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    starts = sizes.select(
        PART, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start"), F.sum("__size").over(every).alias("__span")
    )
    return rows.join(F.broadcast(starts), PART).withColumn("__at", F.col("__start") + F.col(NTH)).drop("__start")


def running_totals(df: DataFrame, keys: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """For distinct key tuples: add, for each ``out: column``, the sum over all earlier tuples."""
    totals = with_totals(ordered(df, keys), sums)
    return totals.drop(PART, NTH, *[f"{out}_all" for out in sums])


def _entries(df: DataFrame, keys: Sequence[str], unique: bool) -> DataFrame:
    """Distinct key tuples with their copies, the rank of the first copy (__at) and the number of rows (__span)."""
    if unique:
        return with_ranks(ordered(df, keys)).withColumn("__copies", F.lit(1).cast("bigint"))
    others = [F.any_value(F.col(quoted(c))).alias(c) for c in df.columns if c not in keys]
    counted = df.groupBy(*[quoted(k) for k in keys]).agg(F.count(F.lit(1)).alias("__copies"), *others)
    return with_totals(ordered(counted, keys), {"__at": "__copies"}).withColumnRenamed("__at_all", "__span")


def _pieces(df: DataFrame, keys: Sequence[str], page_rows: int, unique: bool, partition: str | None) -> DataFrame:
    """One row per (tuple, page) with the place of its copies and the page's own place."""
    if page_rows < 1:
        raise ValueError("a chunk holds at least one row")
    if partition is not None and keys[0] != partition:
        raise ValueError("the partition column leads the key")
    rows = _entries(df, keys, unique)
    if partition is None:
        rows = rows.withColumn("__base", F.lit(0).cast("bigint"))
    else:
        rows = _inside_partitions(rows, page_rows, partition)
    if not unique:
        return _cut(rows, page_rows)
    # single rows need no cutting
    n, at = F.lit(page_rows).cast("bigint"), F.col("__at")
    return rows.withColumns(
        {
            "__page": F.floor(at / n),
            "__from": at,
            "__to": at + 1,
            "__opens": at % n == 0,
            "__closes": ((at + 1) % n == 0) | (at + 1 == F.col("__span")),
        }
    )


def _inside_partitions(rows: DataFrame, page_rows: int, partition: str) -> DataFrame:
    """Ranks start again in every source partition; __span is its size and __base the pages of those before it."""
    sizes = rows.groupBy(quoted(partition)).agg(F.sum("__copies").alias("__size"))
    sizes = sizes.withColumn("__pages", F.ceil(F.col("__size") / page_rows))
    spans = running_totals(sizes, [partition], {"__first": "__size", "__base": "__pages"})
    spans = spans.select(F.col(quoted(partition)).alias("__of"), "__size", "__first", "__base")
    placed = rows.drop("__span").join(spans, rows[partition].eqNullSafe(spans["__of"])).drop("__of")
    return placed.withColumn("__at", F.col("__at") - F.col("__first")).withColumnRenamed("__size", "__span")


def edges_schema(df: DataFrame, keys: Sequence[str]) -> T.StructType:
    key = T.StructType([T.StructField(k, df.schema[k].dataType) for k in keys])
    return T.StructType(
        [
            T.StructField("iteration", T.IntegerType()),
            T.StructField("page", T.LongType()),
            T.StructField("n_rows", T.LongType()),
            T.StructField("lo", key),
            T.StructField("hi", key),
            T.StructField("carried", T.LongType()),
            T.StructField("lo_rows", T.LongType()),
        ]
    )


def page_edges(
    df: DataFrame, keys: Sequence[str], page_rows: int, *, unique: bool, partition: str | None = None
) -> DataFrame:
    """One row per page of ``page_rows`` rows in key order (restarting in every partition).

    ``lo``/``hi`` are the first and last tuples, ``carried`` the copies of ``lo`` that lie on
    earlier pages and ``lo_rows`` its copies on this page. Only key columns are read.
    """
    keys = list(keys)
    keyed = df.select(*[quoted(k) for k in keys])
    return _edges(_pieces(keyed, keys, page_rows, unique, partition), keys, page_rows, edges_schema(df, keys))


def _edges(pieces: DataFrame, keys: Sequence[str], page_rows: int, schema: T.StructType) -> DataFrame:
    key = F.struct(*[F.col(quoted(k)) for k in keys])
    n = F.lit(page_rows).cast("bigint")
    return (
        pieces.filter("__opens OR __closes")
        .groupBy((F.col("__base") + F.col("__page")).cast("int").alias("iteration"), F.col("__page").alias("page"))
        .agg(
            F.max(F.least((F.col("__page") + 1) * n, F.col("__span")) - F.col("__page") * n).alias("n_rows"),
            F.max_by(key, F.col("__opens")).alias("lo"),
            F.max_by(key, F.col("__closes")).alias("hi"),
            F.max(F.when(F.col("__opens"), F.col("__from") - F.col("__at"))).alias("carried"),
            F.max(F.when(F.col("__opens"), F.col("__to") - F.col("__from"))).alias("lo_rows"),
        )
        .select(*schema.fieldNames())
    )


def _cut(rows: DataFrame, page_rows: int) -> DataFrame:
    """Cut every run of copies (from __at, __copies long) at the page borders."""
    n, page = F.lit(page_rows).cast("bigint"), F.col("__page")
    pages = F.sequence(F.expr(f"__at div {page_rows}"), F.expr(f"(__at + __copies - 1) div {page_rows}"))
    return (
        rows.withColumn("__page", F.explode(pages))
        .withColumn("__from", F.greatest(F.col("__at"), page * n))
        .withColumn("__to", F.least(F.col("__at") + F.col("__copies"), (page + 1) * n))
        .withColumn("__opens", F.col("__from") == page * n)
        .withColumn("__closes", F.col("__to") == F.least((page + 1) * n, F.col("__span")))
    )


def assign_pages(
    df: DataFrame,
    keys: Sequence[str],
    page_rows: int,
    *,
    unique: bool,
    partition: str | None = None,
    out: str = "iteration",
) -> DataFrame:
    """Every row with its page number; rows are shuffled once, by key range.

    Without ``unique`` the keys must determine the whole row.
    """
    pieces = _pieces(df, list(keys), page_rows, unique, partition)
    columns = [F.col(quoted(c)) for c in df.columns]
    number = (F.col("__base") + F.col("__page")).cast("int").alias(out)
    if unique:
        return pieces.select(*columns, number)
    places = [PART, NTH, "__page"]
    return repeat_rows(pieces.select(*columns, number, *places, (F.col("__to") - F.col("__from")).alias("__n")), "__n", places)


def repeat_rows(df: DataFrame, copies: str, places: Sequence[str]) -> DataFrame:
    """Write every row ``copies`` times, spread over tasks in blocks so no row is expanded in one piece.

    ``places`` tell the rows apart: blocks are dealt out by them. They and ``copies`` are left out of the result.
    """
    block, n = F.lit(COPIES_PER_STEP), F.col(copies)
    columns = [c for c in df.columns if c != copies and c not in places]
    blocks = df.withColumn("__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((n - 1) / block))))
    # a stated number: what is small here may be large once it is expanded
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = blocks.repartition(tasks, *places, "__block")
    here = F.least(block.cast("bigint"), n - F.col("__block") * block)
    return spread.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), here))).select(
        *[F.col(quoted(c)) for c in columns]
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; fall back to a temporary one only where none is named."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="haulage-checkpoint-"))
