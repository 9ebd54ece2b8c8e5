"""Properties of all chunking strategies: nothing lost, nothing doubled, no chunk over its limit."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from haulage.operators import chunking, decision, masking, profile, ranking


def check(rows, whole, limit):
    bare = rows.drop("iteration")
    assert bare.exceptAll(whole).count() == 0 and whole.exceptAll(bare).count() == 0
    sizes = {r["iteration"]: r["count"] for r in rows.groupBy("iteration").count().collect()}
    assert None not in sizes or not sizes
    assert all(n <= limit for n in sizes.values())
    assert sorted(sizes) == list(range(len(sizes)))
    return sizes


@pytest.mark.parametrize("limit", [1, 64, 100_000])
def test_clustered(table, limit):
    supplier = table("customer")
    sizes = check(chunking.clustered_rows(supplier, ["c_custkey"], limit), supplier, limit)
    assert len(sizes) == -(-150 // limit)


@pytest.mark.parametrize("limit", [7, 100_000])
def test_paged_by_text(table, limit):
    part = table("part")
    check(chunking.paged_rows(part, ["p_type"], limit), part, limit)


def test_pages_of_nested_and_binary_columns(table, spark):
    rows = table("embeddings").limit(60).withColumn("raw", F.encode(F.col("vec_id").cast("string"), "UTF-8"))
    rows = rows.drop("vec_id").unionByName(rows.drop("vec_id")).checkpoint()
    got = chunking.paged_rows(rows, ["label"], 7)
    assert got.columns == [*rows.columns, "iteration"]
    check(got, rows, 7)


@pytest.mark.parametrize("limit", [10, 100_000])
def test_partitions(table, limit):
    events = table("events").withColumn("day", F.col("ts").cast("date"))
    rows = chunking.partition_rows(events, "day", ["event_id"], limit)
    check(rows, events, limit)
    assert rows.groupBy("iteration").agg(F.count_distinct("day").alias("d")).filter("d > 1").count() == 0


def hot_index(spark):
    """One value holds a third of all rows, others are rare, some are NULL."""
    return spark.range(6000).select(
        F.col("id"),
        F.expr("CASE WHEN id % 3 = 0 THEN 50 WHEN id % 17 = 0 THEN NULL ELSE id % 101 END").cast("int").alias("v"),
    )


@pytest.mark.parametrize("limit", [2060, 2100, 4500, 10_000])
def test_index_packing_with_a_hot_value(spark, limit):
    rows = hot_index(spark)
    sizes = check(chunking.index_rows(rows, "v", limit), rows, limit)
    assert len(sizes) <= 6 * 6000 // limit + 3
    manifest = chunking.index_manifest(rows, "v", limit)
    assert {r["iteration"]: r["n_rows"] for r in manifest.collect()} == sizes
    values = chunking.index_rows(rows, "v", limit).groupBy("v").agg(F.count_distinct("iteration").alias("n"))
    assert values.filter("n > 1").count() == 0


def test_paging_keeps_the_sign_of_zero(spark):
    rows = spark.createDataFrame([(x,) for x in [0.0, -0.0] * 5 + [1.0, None, float("nan")]], "x double")
    got = chunking.paged_rows(rows, [], 3)
    assert got.columns == ["x", "iteration"]
    texts = sorted(str(r["x"]) for r in got.collect())
    assert texts == sorted(["0.0", "-0.0"] * 5 + ["1.0", "None", "nan"])


def test_reserved_names_are_refused(spark):
    with pytest.raises(ValueError, match="__image_x"):
        chunking.paged_rows(spark.range(3).withColumnRenamed("id", "__image_x"), [], 2)


def test_index_value_over_the_limit(spark):
    rows = hot_index(spark)
    with pytest.raises(ValueError, match="page by the index"):
        chunking.index_manifest(rows, "v", 1000)
    stats = decision.index_statistics(rows, "t", "v")
    assert decision.index_decision(stats, 1000).first()["decision"] == "no"
    assert decision.index_decision(stats, 2100).first()["decision"] == "yes"
    rough = decision.index_statistics(rows, "t", "v", approximate=True)
    assert decision.index_decision(rough, 2100).first()["decision"] == "yes"


def test_empty_index(spark):
    none = hot_index(spark).where("false")
    assert chunking.index_manifest(none, "v", 10).count() == 0
    assert chunking.index_rows(none, "v", 10).count() == 0


def test_manifests_write_and_sort_keys_only(table):
    manifest = chunking.clustered_manifest(table("orders"), ["o_orderkey"], 400)
    text = manifest._jdf.queryExecution().executedPlan().toString()
    assert f"ReadSchema: struct<o_orderkey:bigint,{ranking.PART}:int,{ranking.NTH}:bigint>" in text
    assert "rangepartitioning" not in text  # sorted once, when it was written


def test_profile_rules(spark, table):
    sized = spark.createDataFrame(
        [("a", 10, 5.0), ("b", 4, 0.0), ("c", 3, None), ("d", 0, None)],
        "table_key string, table_count bigint, table_size_mb double",
    )
    rows = {r["table_key"]: r for r in profile.with_row_size(sized).collect()}
    assert rows["a"]["avg_row_size_mb"] == 0.5
    assert rows["b"]["avg_row_size_mb"] == 0.00000001
    assert rows["c"]["table_size_mb"] == 0.1
    assert rows["d"]["avg_row_size_mb"] is None
    chunks = {r["table_key"]: r["chunk_rows"] for r in profile.chunk_sizing(profile.with_row_size(sized), 1.25).collect()}
    # half to even: 2.5 rows become 2; a row larger than the threshold still gets a chunk
    assert chunks["a"] == 2
    assert {r["chunk_rows"] for r in profile.chunk_sizing(profile.with_row_size(sized), 0.01).filter("table_key = 'a'").collect()} == {1}


def test_cluster_threshold(spark):
    class Settings:
        conf = type("Conf", (), {"get": staticmethod(lambda k, d: {"spark.executor.memory": "32g", "spark.executor.instances": "2"}[k])})

    threshold = profile.cluster_threshold_mb(Settings)
    assert threshold == pytest.approx(64 * 1024 / 3)


@pytest.mark.parametrize(
    "more, executors",
    [({}, 1), ({"max": "12", "min": "2"}, 12), ({"max": "2147483647", "initial": "5"}, 5), ({"min": "0"}, 1)],
)
def test_cluster_threshold_under_dynamic_allocation(more, executors):
    known = {"spark.executor.memory": "3g", "spark.dynamicAllocation.enabled": "true"}
    known |= {f"spark.dynamicAllocation.{k}Executors": v for k, v in more.items()}

    class Settings:
        conf = type("Conf", (), {"get": staticmethod(known.get)})

    assert profile.cluster_threshold_mb(Settings) == pytest.approx(executors * 1024)


def test_reversible_mask(table):
    customer = table("customer")
    key = F.lit("0123456789abcdef")
    hidden = masking.encrypted_projection(customer, ["c_name", "c_acctbal"], key)
    assert hidden.join(customer, ["c_custkey", "c_name"]).count() == 0
    shown = hidden.withColumns(
        {
            "c_name": masking.decrypted(F.col("c_name"), key),
            "c_acctbal": masking.decrypted(F.col("c_acctbal"), key, "double"),
        }
    )
    assert shown.select(customer.columns).exceptAll(customer).count() == 0


def test_masks_keep_null_and_reject_unknown_columns(spark):
    rows = spark.sql("SELECT 1 AS id, CAST(NULL AS STRING) AS name")
    assert masking.masked_projection(rows, ["name"], "s").first()["name"] is None
    with pytest.raises(ValueError, match="nothing"):
        masking.masked_projection(rows, ["nothing"], "s")


def test_mask_lookup_is_exact(spark):
    work = spark.createDataFrame([("t1",), ("t10",)], "table_key string")
    masks = spark.createDataFrame([("t10", "a"), ("t10", "a"), ("t10", "b")], "table_key string, column_name string")
    assert [tuple(r) for r in masking.mask_columns(work, masks).collect()] == [("t10", 2, "a,b")]


def test_brute_force_against_global_window(table):
    lineitem = table("lineitem")
    keys = ["l_suppkey", *[c for c in lineitem.columns if c != "l_suppkey"]]
    number = F.floor((F.row_number().over(Window.orderBy(*keys)) - 1) / 450).cast("int")
    want = lineitem.withColumn("iteration", number)
    got = chunking.paged_rows(lineitem, ["l_suppkey"], 450)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
