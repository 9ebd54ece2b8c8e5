"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.operators import chunking, decision, discovery, masking, profile, ranking, recovery, tracking, validation
from haulage.plans import derived
from haulage.plans.derived import load
from haulage.sources import lake
from haulage.sources.vendors import url_expression

Query = Callable[[SparkSession, str], DataFrame]

# Fixed values shared with the checking SQL.
THRESHOLD_MB = 0.15
ORDERS_ROWS = 4000
LINEITEM_ROWS = 13000
LINEITEM_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
CONVERSATION_ROWS = 100
PART_ROWS = 600
EVENT_ROWS = 200
COPIES_ROWS = 7000
RECOVERY_CHUNKS = 5
DECISIONS = {"orders": ("o_custkey", 4000), "lineitem": ("l_suppkey", 500), "part": ("p_type", 600)}
# table: (vendor, declared key, index column, partition column)
STRATEGY_TABLES = {
    "orders": ("postgres", ["o_orderkey"], None, None),
    "conversations": ("mysql", ["conv_id", "turn"], None, None),
    "lineitem": ("mssql", ["l_orderkey", "l_linenumber"], "l_suppkey", None),
    "customer": ("maria", None, "c_nationkey", None),
    "part": ("maria", None, "p_type", None),
    "events": ("mysql", None, None, "ts"),
    "documents": ("ibm", None, "lang", None),
    "labels": ("ibm", None, None, "quality"),
}


def source_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.work_list(spark, sf_dir).select(
        "table_key", "vendor", url_expression(F.col("vendor"), F.col("base_url"), F.col("database")).alias("url")
    )


def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {name: load(spark, sf_dir, name) for name in derived.TABLES}
    tables["orders_empty"] = tables["orders"].where("false")
    return profile.table_profile(tables)


def chunk_sizing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.chunk_sizing(table_profile(spark, sf_dir), THRESHOLD_MB)


def table_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.table_eligibility(table_profile(spark, sf_dir))


def pk_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.key_columns(derived.key_metadata(spark, sf_dir))


def index_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.index_columns(derived.index_metadata(spark, sf_dir))


def partition_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.partition_profile(derived.partition_rows(spark, sf_dir))


def index_decision(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = None
    for table, (column, rows) in DECISIONS.items():
        stats = decision.index_statistics(load(spark, sf_dir, table), table, column)
        decided = decision.index_decision(stats, rows)
        parts = decided if parts is None else parts.unionByName(decided)
    return parts


def strategy_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = indexes = partitions = None
    tables = {name: load(spark, sf_dir, name) for name in STRATEGY_TABLES}

    def grow(found: DataFrame | None, rows: DataFrame) -> DataFrame:
        return rows if found is None else found.unionByName(rows)

    for name, (vendor, key, index, partition) in STRATEGY_TABLES.items():
        df = tables[name]
        if key:
            keys = grow(keys, discovery.verified_key(df, name, key))
        if index:
            indexes = grow(indexes, decision.index_statistics(df, name, index))
        if partition:
            column = F.col(partition).cast("date") if partition == "ts" else F.col(partition)
            rows = df.select(column.alias("part"))
            partitions = grow(partitions, discovery.lake_partitions(rows, name, "part"))
    vendors = F.create_map(*[F.lit(x) for name, spec in STRATEGY_TABLES.items() for x in (name, spec[0])])
    sized = profile.chunk_sizing(profile.table_profile(tables), THRESHOLD_MB)
    joined = (
        sized.select("table_key", vendors[F.col("table_key")].alias("vendor"), "chunk_rows")
        .join(keys, "table_key", "left")
        .join(indexes, "table_key", "left")
        .join(discovery.partition_profile(partitions), "table_key", "left")
    )
    decided = decision.index_decision(joined, F.col("chunk_rows")).select(
        "table_key",
        "vendor",
        "chunk_rows",
        F.coalesce("n_key_columns", F.lit(0)).alias("n_key_columns"),
        F.when(F.col("column_name").isNotNull(), 1).otherwise(0).alias("n_index_columns"),
        F.when(F.col("column_name").isNotNull(), F.col("decision")).alias("decision"),
        F.coalesce("n_partitions", F.lit(0)).alias("n_partitions"),
    )
    return decision.strategy_selection(decided)


def chunk_clustered_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.clustered_manifest(load(spark, sf_dir, "orders"), ["o_orderkey"], ORDERS_ROWS)


def chunk_clustered_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.clustered_rows(load(spark, sf_dir, "orders"), ["o_orderkey"], ORDERS_ROWS)


def chunk_composite_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.clustered_manifest(load(spark, sf_dir, "lineitem"), LINEITEM_KEY, LINEITEM_ROWS)


def chunk_composite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.clustered_rows(load(spark, sf_dir, "lineitem"), LINEITEM_KEY, LINEITEM_ROWS)


def chunk_composite_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.clustered_manifest(load(spark, sf_dir, "conversations"), ["conv_id", "turn"], CONVERSATION_ROWS)


def chunk_index_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.index_manifest(load(spark, sf_dir, "orders"), "o_custkey", ORDERS_ROWS)


def chunk_index_null_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("o_custkey", F.nullif("o_custkey", F.lit(0)))
    return chunking.index_manifest(orders, "o_custkey", ORDERS_ROWS)


def chunk_index_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").withColumn("o_custkey", F.nullif("o_custkey", F.lit(0)))
    return chunking.index_rows(orders, "o_custkey", ORDERS_ROWS)


def chunk_index_paged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.paged_rows(load(spark, sf_dir, "part"), ["p_type"], PART_ROWS)


def chunk_index_paged_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.paged_manifest(load(spark, sf_dir, "part"), ["p_type"], PART_ROWS, ["p_type", "p_partkey"])


def _events_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))


def chunk_partition_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.partition_manifest(_events_by_day(spark, sf_dir), "day", ["event_id"], EVENT_ROWS)


def chunk_partition_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.partition_rows(_events_by_day(spark, sf_dir), "day", ["event_id"], EVENT_ROWS)


def chunk_limit_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.paged_rows(load(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], ORDERS_ROWS)


def chunk_limit_offset_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.paged_manifest(load(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], ORDERS_ROWS)


def _line_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_linenumber")


def chunk_limit_offset_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of full copies: pages cut through groups that each hold a large share of the rows."""
    return chunking.paged_rows(_line_states(spark, sf_dir), ["l_returnflag"], COPIES_ROWS)


def chunk_limit_offset_zeros(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies that differ only in the sign of a zero keep it through paging."""
    # the sign comes from a column: the optimizer takes the literals -0.0 and 0.0 for one value
    number = F.col("l_linenumber").cast("double")
    signed = F.when(F.col("l_quantity") % 2 == 0, -number).otherwise(number) * F.lit(0.0)
    rows = load(spark, sf_dir, "lineitem").select("l_linenumber", signed.alias("z"))
    paged = chunking.paged_rows(rows, ["l_linenumber"], COPIES_ROWS)
    return paged.withColumn("z", F.col("z").cast("string"))


def mask_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.mask_columns(derived.work_list(spark, sf_dir), derived.mask_map(spark, sf_dir))


def masked_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return masking.masked_projection(load(spark, sf_dir, "customer"), ["c_name", "c_acctbal"], derived.SALT)


def masked_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.masked_minmax(derived.sides(spark, sf_dir))


def validate_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_counts(derived.sides(spark, sf_dir))


def validate_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_columns(derived.sides(spark, sf_dir))


def validate_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validate_minmax(derived.sides(spark, sf_dir))


def validation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.validation_status(derived.sides(spark, sf_dir))


def publish_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validation.publish_plan(validation_status(spark, sf_dir), "blob", "raw", "masked")


def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads summed up from their chunks; a load none of whose chunks could be read did not extract."""
    failed = F.col("write_status") == tracking.FAIL
    loads = derived.chunks_now(spark, sf_dir).groupBy("log_id").agg(
        F.max(failed).alias("raw_failed"),
        F.coalesce(F.max(F.col("mask_write_status") == tracking.FAIL), F.lit(False)).alias("masked_failed"),
        F.bool_and(F.col("read_status") == tracking.FAIL).alias("unread"),
    )
    status = (
        F.when(F.col("raw_failed"), validation.FAILED)
        .when(F.col("masked_failed"), validation.PARTIAL)
        .otherwise(validation.SUCCESS)
    )
    return validation.run_summary(
        loads.select(
            F.concat(F.lit("load_"), "log_id").alias("table_key"),
            status.alias("status"),
            F.when(F.col("unread"), "no chunk could be read").alias("error"),
        )
    )


def load_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    loads = load(spark, sf_dir, "events").groupBy(F.col("user_id").alias("log_id")).agg(
        F.min("ts").alias("start_timestamp"), F.max("ts").alias("end_timestamp")
    )
    return validation.load_durations(loads)


def chunk_tracker_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.chunks_now(spark, sf_dir)


def master_tracker_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracking.master_tracker_latest(derived.master_history(spark, sf_dir), ("end_timestamp", "attempt"))


def recovery_failed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.failed_logs(master_tracker_latest(spark, sf_dir))


def _failed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = derived.chunk_history(spark, sf_dir)
    return recovery.failed_chunks(history, recovery_failed_logs(spark, sf_dir), derived.ATTEMPT_ORDER)


def recovery_failed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failed_chunks(spark, sf_dir).select("log_id", "iteration", "query", "write_status", "mask_write_status")


def recovery_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.recovery_plan(_failed_chunks(spark, sf_dir)).select(
        "log_id",
        "iteration",
        "table_name",
        "write_status",
        "mask_write_status",
        "masking_applies",
        "rerun_raw",
        "rerun_masked",
    )


def recovery_republish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recovery.republish(recovery_plan(spark, sf_dir))


def recovery_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every failed chunk is rerun; a rerun passes unless its chunk size is a multiple of 7. Loads are rolled up again."""
    history = derived.chunk_history(spark, sf_dir)
    plan = recovery.recovery_plan(_failed_chunks(spark, sf_dir))
    outcome = F.when(F.col("chunk_size") % 7 == 0, tracking.FAIL).otherwise(tracking.PASS)
    reruns = plan.withColumns(
        {
            "end_timestamp": F.expr("timestampadd(HOUR, 1, end_timestamp)"),
            "write_status": outcome,
            "mask_write_status": F.when(F.col("masking_applies"), outcome),
        }
    ).select(*history.columns)
    now = tracking.chunk_tracker_latest(history.unionByName(reruns), derived.ATTEMPT_ORDER)
    return recovery.close_loads(now)


def recovery_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks that were planned but never tried: every chunk is planned, a tenth of the attempts never happened."""
    history = derived.chunk_history(spark, sf_dir)
    planned = history.withColumns(
        {
            "end_timestamp": F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
            "write_status": F.lit(tracking.PENDING),
            "mask_write_status": F.when(F.col("mask_write_status").isNotNull(), tracking.PENDING),
        }
    )
    tried = planned.unionByName(history.filter("chunk_size % 10 <> 0"))
    logs = history.select("log_id").distinct()
    found = recovery.failed_chunks(tried, logs, derived.ATTEMPT_ORDER)
    return recovery.recovery_plan(found).filter(F.col("write_status") == tracking.PENDING).select(
        "log_id", "iteration", "query", "masking_applies", "rerun_raw", "rerun_masked"
    )


def recovery_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written in five chunks, one of them lost, that one replayed from its stored key range and read back.

    The lake is a new folder among the shared ones; the replay replaces the lost chunk's partition only.
    """
    orders = load(spark, sf_dir, "orders")
    rows = max(1, -(-orders.count() // RECOVERY_CHUNKS))
    chunks = chunking.clustered_rows(orders, ["o_orderkey"], rows)
    plan = chunking.clustered_manifest(orders, ["o_orderkey"], rows)
    folder = ranking.new_folder(spark, "recovery-rewrite")
    lake.write_chunks(chunks, folder, "parquet")
    failed = plan.filter("(iteration * 3 + 7) % 5 = 0")
    lost = [r["iteration"] for r in failed.select("iteration").collect()]
    lake.delete_chunks(spark, folder, "parquet", lost)
    # the failed chunks' ranges are a handful of rows: one chunk is as large as a task's share of the table
    stored = failed.select("iteration", F.col("lo_o_orderkey").alias("__lo"), F.col("hi_o_orderkey").alias("__hi"))
    again = orders.join(F.broadcast(stored), orders["o_orderkey"].between(F.col("__lo"), F.col("__hi"))).drop("__lo", "__hi")
    lake.write_chunks(again, folder, "parquet")
    return lake.read_chunks(spark, folder, "parquet", orders.schema)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        source_url,
        table_profile,
        chunk_sizing,
        table_eligibility,
        pk_columns,
        index_columns,
        partition_profile,
        index_decision,
        strategy_selection,
        chunk_clustered_manifest,
        chunk_clustered_rows,
        chunk_composite_manifest,
        chunk_composite_rows,
        chunk_composite_conversations,
        chunk_index_manifest,
        chunk_index_null_manifest,
        chunk_index_rows,
        chunk_index_paged,
        chunk_index_paged_manifest,
        chunk_partition_manifest,
        chunk_partition_rows,
        chunk_limit_offset,
        chunk_limit_offset_manifest,
        chunk_limit_offset_copies,
        chunk_limit_offset_zeros,
        mask_columns,
        masked_projection,
        masked_minmax,
        validate_counts,
        validate_columns,
        validate_minmax,
        validation_status,
        publish_plan,
        run_summary,
        load_durations,
        chunk_tracker_latest,
        master_tracker_latest,
        recovery_failed_logs,
        recovery_failed_chunks,
        recovery_plan,
        recovery_republish,
        recovery_close,
        recovery_pending,
        recovery_rewrite,
    )
}
