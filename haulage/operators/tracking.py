"""Chunk and master trackers: append-only histories and their latest state."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The chunk tracker's columns, in order, and the states stored in it.
PASS = "PASS"
FAIL = "FAIL"
#: Ours: a planned chunk that has not been tried yet, and one that a later plan of its load no longer has.
PENDING = "PENDING"
REMOVED = "REMOVED"
LOAD_RUNNING = "Running"
LOAD_FAILED = "Failed"
LOAD_SUCCESS = "Success"
CHUNK_TRACKER_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.IntegerType()),
        T.StructField("source_id", T.IntegerType()),
        T.StructField("query", T.StringType()),
        T.StructField("schema_name", T.StringType()),
        T.StructField("database_name", T.StringType()),
        T.StructField("rdbms_type", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("source_name", T.StringType()),
        T.StructField("write_detail", T.StringType()),
        T.StructField("write_sub_detail", T.StringType()),
        T.StructField("chunk_size", T.LongType()),
        T.StructField("extraction_approach", T.StringType()),
        T.StructField("start_timestamp", T.TimestampNTZType()),
        T.StructField("end_timestamp", T.TimestampNTZType()),
        T.StructField("read_status", T.StringType()),
        T.StructField("mask_read_status", T.StringType()),
        T.StructField("write_status", T.StringType()),
        T.StructField("mask_write_status", T.StringType()),
        T.StructField("iteration", T.IntegerType()),
    ]
)
#: Ours: error texts of chunks, beside the fixed columns.
ERROR_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.IntegerType()),
        T.StructField("iteration", T.IntegerType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("message", T.StringType()),
    ]
)
MASTER_TRACKER_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.IntegerType()),
        T.StructField("table_key", T.StringType()),
        T.StructField("load_status", T.StringType()),
        T.StructField("start_timestamp", T.TimestampNTZType()),
        T.StructField("end_timestamp", T.TimestampNTZType()),
        T.StructField("message", T.StringType()),
    ]
)
#: Ours: the runs of a load, each a complete attempt with chunks and files of its own, and when it became what readers see.
STARTED = "started"
PUBLISHED = "published"
RUN_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.IntegerType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
    ]
)
#: Ours: the ranges that make up a planned chunk, so that a rerun reads it with as many tasks as the first attempt.
PART_SCHEMA = T.StructType(
    [
        T.StructField("log_id", T.IntegerType()),
        T.StructField("run", T.IntegerType()),
        T.StructField("iteration", T.IntegerType()),
        T.StructField("part", T.IntegerType()),
        T.StructField("source", T.StringType()),
        T.StructField("predicate", T.StringType()),
    ]
)


def latest(history: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row per key.

    Spark keeps only each task's last row per key before the shuffle, so a key with very many attempts
    does not gather anywhere; columns nobody asks for are not shuffled.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.col(o).desc_nulls_last() for o in order])
    return history.withColumn("__nth", F.row_number().over(last_first)).filter("__nth = 1").drop("__nth")


def chunk_tracker_latest(history: DataFrame, order: Sequence[str] = ("end_timestamp",)) -> DataFrame:
    return latest(history, ["log_id", "iteration"], order)


def master_tracker_latest(history: DataFrame, order: Sequence[str] = ("end_timestamp",)) -> DataFrame:
    return latest(history, ["log_id"], order)
