"""Pages and totals against a plain global window, on the cases that break naive paging."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from haulage.operators import ranking


def brute(df, keys, n, partition=None):
    order = [F.col(k).asc_nulls_first() for k in keys]
    rn = F.row_number().over(Window.orderBy(*order)) - 1
    if partition is None:
        return df.withColumn("iteration", F.floor(rn / n).cast("int"))
    inside = F.row_number().over(Window.partitionBy(partition).orderBy(*order)) - 1
    paged = df.withColumn("__p", F.floor(inside / n))
    dense = F.dense_rank().over(Window.orderBy(F.col(partition).asc_nulls_first(), "__p")) - 1
    return paged.withColumn("iteration", dense.cast("int")).drop("__p")


def same(left, right):
    assert left.exceptAll(right).count() == 0
    assert right.exceptAll(left).count() == 0


def hot_rows(spark):
    """A third of the rows are full copies; keys hold NULLs, quotes and long common prefixes."""
    base = spark.range(3000).select(
        F.when(F.col("id") % 11 == 0, None)
        .otherwise(F.concat(F.lit("it's a \\ \"long\" prefix "), (F.col("id") % 37).cast("string")))
        .alias("k"),
        F.when(F.col("id") % 5 == 0, None).otherwise(F.col("id") % 13).alias("v"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (id % 7) / 3)").alias("at"),
        (F.col("id") % 3 / 7).alias("x"),
    )
    hot = spark.range(1500).select(
        F.lit("it's a \\ \"long\" prefix 5").alias("k"),
        F.lit(4).cast("bigint").alias("v"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("at"),
        F.lit(0.25).alias("x"),
    )
    return base.unionByName(hot)


@pytest.mark.parametrize("n", [1, 7, 100, 1499, 10_000])
def test_unique_key_pages(table, n):
    orders = table("orders").select("o_orderkey", "o_custkey")
    got = ranking.assign_pages(orders, ["o_orderkey"], n, unique=True)
    same(got, brute(orders, ["o_orderkey"], n))


@pytest.mark.parametrize("n", [1, 40, 333, 1000])
def test_pages_with_copies_and_nulls(spark, n):
    df = hot_rows(spark)
    keys = ["k", "v", "at", "x"]
    same(ranking.assign_pages(df, keys, n, unique=False), brute(df, keys, n))


def test_pages_keep_other_columns(table):
    lineitem = table("lineitem")
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    same(ranking.assign_pages(lineitem, keys, 700, unique=True), brute(lineitem, keys, 700))


@pytest.fixture
def many_partitions(spark):
    """As on a cluster: partitions that nothing puts together."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_ranks_over_many_partitions(spark, table, many_partitions):
    orders = table("orders").select("o_orderkey", "o_custkey").repartition(9)
    rows = ranking.ordered(orders, ["o_orderkey"])
    sizes = [r["count"] for r in rows.groupBy(ranking.PART).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 1500 / 8
    same(ranking.assign_pages(orders, ["o_orderkey"], 70, unique=True), brute(orders, ["o_orderkey"], 70))
    df, keys = hot_rows(spark).repartition(5), ["v", "k", "at", "x"]
    same(ranking.assign_pages(df, keys, 33, unique=False), brute(df, keys, 33))
    same(ranking.assign_pages(df, keys, 33, unique=False, partition="v"), brute(df, keys, 33, "v"))


def test_hot_leading_value_is_split(spark, many_partitions):
    """Ranges look at the whole tuple: a leading value with half of the rows spreads over many partitions."""
    rows = spark.range(4000).select(F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).alias("k"), "id")
    sizes = [r["count"] for r in ranking.ordered(rows, ["k", "id"]).groupBy(ranking.PART).count().collect()]
    assert max(sizes) < 4000 / 8


@pytest.mark.parametrize("n", [9, 50, 5000])
def test_edges(spark, n):
    df = hot_rows(spark)
    keys = ["k", "v", "at", "x"]
    got = ranking.page_edges(df, keys, n, unique=False).select("iteration", "n_rows", "lo", "hi")
    key = F.struct(*keys)
    want = (
        brute(df, keys, n)
        .groupBy("iteration")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    )
    same(got, want)


@pytest.mark.parametrize("n", [20, 1000])
def test_partitioned_edges(spark, n):
    df = hot_rows(spark)
    keys = ["v", "k", "at", "x"]
    got = ranking.page_edges(df, keys, n, unique=False, partition="v").select("iteration", "n_rows", "lo", "hi")
    key = F.struct(*keys)
    want = (
        brute(df, keys, n, "v")
        .groupBy("iteration")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.min(key).alias("lo"), F.max(key).alias("hi"))
    )
    same(got, want)


def test_running_totals(spark):
    df = hot_rows(spark).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    got = ranking.running_totals(df, ["k"], {"before": "n"})
    w = Window.orderBy(F.col("k").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    same(got, df.withColumn("before", F.sum("n").over(w) - F.col("n")))


@pytest.mark.parametrize("bits", [0, 3, 20])
def test_totals_over_stretches(spark, many_partitions, monkeypatch, bits):
    monkeypatch.setattr(ranking, "STRETCH_BITS", bits)
    df = hot_rows(spark).groupBy("k", "v", "at").agg(F.count(F.lit(1)).alias("n"))
    got = ranking.running_totals(df, ["k", "v", "at"], {"before": "n"})
    w = Window.orderBy(*[F.col(k).asc_nulls_first() for k in ("k", "v", "at")]).rowsBetween(Window.unboundedPreceding, -1)
    same(got, df.withColumn("before", F.coalesce(F.sum("n").over(w), F.lit(0))))


def rows_of_tasks(df):
    return [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]


def test_rows_without_copies_are_spread(table, many_partitions):
    """Rows that are alone differ neither in their block nor in the number of their copies."""
    sizes = rows_of_tasks(ranking.assign_pages(table("orders"), ["o_orderdate", "o_orderkey"], 70, unique=False))
    assert sum(sizes) == 1500 and max(sizes) < 1500 / 8


def test_expanded_copies_are_spread(spark):
    """Few tuples are a few bytes until their copies are written out."""
    rows = spark.range(200_000).select((F.col("id") % 3).alias("k"))
    sizes = rows_of_tasks(ranking.assign_pages(rows, ["k"], 50_000, unique=False))
    assert sum(sizes) == 200_000 and max(sizes) < 200_000 * 0.6


def test_empty_table(table):
    none = table("orders").where("false")
    assert ranking.page_edges(none, ["o_orderkey"], 10, unique=True).count() == 0
    assert ranking.assign_pages(none, ["o_orderkey"], 10, unique=True).count() == 0


def test_partitioned_rows(spark):
    df = hot_rows(spark)
    keys = ["v", "k", "at", "x"]
    same(ranking.assign_pages(df, keys, 70, unique=False, partition="v"), brute(df, keys, 70, "v"))


@pytest.mark.parametrize("n", [30, 2])
def test_wide_text_keys(table, n):
    documents = table("documents").select("text", "doc_id", "lang")
    keys = ["text", "doc_id", "lang"]
    same(ranking.assign_pages(documents, keys, n, unique=False), brute(documents, keys, n))


def test_bad_arguments(table):
    with pytest.raises(ValueError, match="at least one row"):
        ranking.assign_pages(table("orders"), ["o_orderkey"], 0, unique=True)
    with pytest.raises(ValueError, match="leads the key"):
        ranking.page_edges(table("orders"), ["o_orderkey"], 5, unique=True, partition="o_custkey")
