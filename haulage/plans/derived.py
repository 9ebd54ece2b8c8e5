"""Work lists, catalog rows and trackers derived from the given tables, so that they grow with them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.operators import chunking, masking, tracking
from haulage.operators.validation import Sides
from haulage.sources.vendors import VENDORS

SALT = "haulage"
#: The given tables. Stated, so that opening one costs no job that reads file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
    "o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
TABLES = tuple(SCHEMAS)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def vendor_of(number: str):
    return F.element_at(F.array(*[F.lit(v) for v in VENDORS]), F.expr(f"cast({number} % 5 as int) + 1"))


def work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One source table per customer."""
    return load(spark, sf_dir, "customer").select(
        F.concat(F.lit("cust_"), "c_custkey").alias("table_key"),
        vendor_of("c_nationkey").alias("vendor"),
        F.concat(F.lit("jdbc:source://host"), "c_nationkey", F.lit(":1234/")).alias("base_url"),
        F.col("c_mktsegment").alias("database"),
    )


def mask_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Masked columns of a customer's table: one entry per order, with repeats."""
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("cust_"), "o_custkey").alias("table_key"),
        F.concat(F.lit("col_"), "o_orderstatus", F.lit("_"), F.substring("o_orderpriority", 1, 1)).alias("column_name"),
    )


def key_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key rows of one table per order: line items repeat and are out of order."""
    return load(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("order_"), "l_orderkey").alias("table_key"),
        F.concat(F.lit("col_"), F.expr("l_partkey % 10")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal_position"),
    )


def index_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index rows of one table per brand, each listing two or three columns."""
    return load(spark, sf_dir, "part").select(
        F.col("p_brand").alias("table_key"),
        F.concat(F.lit("+"), "p_type", F.lit("-"), F.translate("p_name", " ", "+")).alias("indexed_column"),
        F.col("p_size").alias("position"),
    )


def partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog rows of four tables; part has a single partition."""
    named = {
        "events": F.col("ts").cast("date").cast("string"),
        "orders": F.substring(F.col("o_orderdate").cast("string"), 1, 7),
        "customer": F.col("c_mktsegment"),
        "part": F.lit("p0"),
    }
    parts = None
    for table, name in named.items():
        rows = load(spark, sf_dir, table).groupBy(name.alias("partition_name")).agg(
            F.lit(table).alias("table_key"), F.count(F.lit(1)).alias("n_rows")
        )
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


def bounded(key: str):
    """A log_id, which is a fixed int column, from a bigint key: keys below 2^31 - 1 stay as they are."""
    return F.expr(f"cast({key} % 2147483647 as int)")


def chunk_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunk tracker with natural repeats: a line item is one attempt at chunk (order, line number)."""
    failed = F.col("l_returnflag") == "R"
    return load(spark, sf_dir, "lineitem").select(
        bounded("l_orderkey").alias("log_id"),
        F.expr("cast(l_suppkey % 5 as int)").alias("source_id"),
        F.concat(F.lit("SELECT * FROM t WHERE k = "), "l_partkey").alias("query"),
        F.lit("public").alias("schema_name"),
        F.lit("sales").alias("database_name"),
        vendor_of("l_suppkey").alias("rdbms_type"),
        F.concat(F.lit("table_"), F.expr("l_orderkey % 50")).alias("table_name"),
        F.concat(F.lit("source_"), F.expr("l_suppkey % 5")).alias("source_name"),
        F.lit("blob").alias("write_detail"),
        F.concat("l_suppkey", F.lit("/"), F.col("l_extendedprice").cast("decimal(12,2)")).alias("write_sub_detail"),
        F.col("l_partkey").alias("chunk_size"),
        F.lit("clustered").alias("extraction_approach"),
        F.col("l_shipdate").alias("start_timestamp"),
        F.expr("timestampadd(MINUTE, cast(l_quantity as int), l_shipdate)").alias("end_timestamp"),
        F.when(failed & F.expr("l_suppkey % 4 = 0"), tracking.FAIL).otherwise(tracking.PASS).alias("read_status"),
        F.lit(None).cast("string").alias("mask_read_status"),
        F.when(failed, tracking.FAIL).otherwise(tracking.PASS).alias("write_status"),
        F.when(F.expr("l_partkey % 2 = 0"), None)
        .when(F.expr("l_linestatus = 'F' AND l_suppkey % 3 = 0"), tracking.FAIL)
        .otherwise(tracking.PASS)
        .alias("mask_write_status"),
        F.col("l_linenumber").alias("iteration"),
    )


ATTEMPT_ORDER = ("end_timestamp", "chunk_size", "write_sub_detail")


def chunks_now(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.chunk_tracker_latest(chunk_history(spark, sf_dir), ATTEMPT_ORDER)


def master_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master tracker: one load per customer, one status update per order."""
    return load(spark, sf_dir, "orders").select(
        bounded("o_custkey").alias("log_id"),
        F.concat(F.lit("cust_"), "o_custkey").alias("table_key"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'Failed' WHEN 'O' THEN 'Success' ELSE 'Partial Success' END").alias(
            "load_status"
        ),
        F.col("o_orderdate").alias("end_timestamp"),
        F.col("o_orderkey").alias("attempt"),
    )


def sides(spark: SparkSession, sf_dir: str) -> list[Sides]:
    """Landed copies, good and faulty, built through the chunk plan where the table has a key."""
    orders = load(spark, sf_dir, "orders")
    # the filter keeps the chunk numbers in the plan: a row without one would be missing on the landed side
    landed_orders = chunking.clustered_rows(orders, ["o_orderkey"], 4000).filter("iteration >= 0").drop("iteration")
    order_masks = ["o_custkey", "o_orderpriority"]
    customer = load(spark, sf_dir, "customer")
    landed_customer = chunking.clustered_rows(customer, ["c_custkey"], 400).filter("iteration <> 1").drop("iteration")
    customer_masks = ["c_name", "c_acctbal"]
    part = load(spark, sf_dir, "part")
    supplier = load(spark, sf_dir, "supplier")
    nation = load(spark, sf_dir, "nation")
    return [
        Sides("orders", orders, landed_orders, masking.masked_projection(landed_orders, order_masks, SALT), order_masks),
        Sides(
            "customer",
            customer,
            landed_customer,
            masking.masked_projection(landed_customer, customer_masks, SALT),
            customer_masks,
        ),
        Sides("part", part, part.withColumn("p_retailprice", F.least("p_retailprice", F.lit(950.0)))),
        Sides(
            "supplier",
            supplier,
            supplier,
            masking.masked_projection(supplier.filter("s_nationkey <> 3"), ["s_name"], SALT),
            ["s_name"],
        ),
        Sides("nation", nation, nation.drop("n_regionkey")),
    ]
