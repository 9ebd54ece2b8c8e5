"""Which chunks to run again, and how a load is closed afterwards: plans over whole trackers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.operators.tracking import (
    FAIL,
    LOAD_FAILED,
    LOAD_RUNNING,
    LOAD_SUCCESS,
    PASS,
    PENDING,
    chunk_tracker_latest,
)

#: States of a copy that still has to be made.
OPEN = (FAIL, PENDING)


def failed_logs(master: DataFrame) -> DataFrame:
    """Loads that failed, and those that never came to an end: their job broke off."""
    return master.filter(F.col("load_status").isin(LOAD_FAILED, LOAD_RUNNING)).select("log_id").distinct()


def failed_chunks(history: DataFrame, logs: DataFrame, order: Sequence[str] = ("end_timestamp",)) -> DataFrame:
    """Chunks of the given loads whose raw or masked copy failed in its last attempt or was never tried.

    Other loads' attempts are dropped before the last ones are looked for.
    """
    failed = F.col("write_status").isin(*OPEN) | F.col("mask_write_status").isin(*OPEN)
    return chunk_tracker_latest(history.join(logs, "log_id", "left_semi"), order).filter(failed)


def recovery_plan(failed: DataFrame) -> DataFrame:
    """What each failed chunk needs: its raw copy, its masked copy, or both, each once."""
    return failed.withColumns(
        {
            "masking_applies": F.coalesce(F.col("mask_write_status").isin(*OPEN, PASS), F.lit(False)),
            "rerun_raw": F.coalesce(F.col("write_status").isin(*OPEN), F.lit(False)),
            "rerun_masked": F.coalesce(F.col("mask_write_status").isin(*OPEN), F.lit(False)),
        }
    )


def republish(plan: DataFrame) -> DataFrame:
    """Per load: is the raw table, the masked table, or are both to be refreshed?"""
    return plan.groupBy("log_id", "table_name").agg(
        F.max("rerun_raw").alias("republish_raw"),
        F.max("rerun_masked").alias("republish_masked"),
    )


def close_loads(chunks: DataFrame) -> DataFrame:
    """Roll the latest chunk states up: a load succeeds if none of its chunks is failed or still to be tried."""
    failed = F.coalesce(F.col("write_status").isin(*OPEN), F.lit(False)) | F.coalesce(
        F.col("mask_write_status").isin(*OPEN), F.lit(False)
    )
    return chunks.groupBy("log_id").agg(
        F.count(F.lit(1)).alias("n_chunks"),
        F.sum(failed.cast("bigint")).alias("n_failed"),
        F.when(F.max(failed), LOAD_FAILED).otherwise(LOAD_SUCCESS).alias("load_status"),
        F.max("end_timestamp").alias("end_timestamp"),
    )
