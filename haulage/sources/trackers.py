"""Tracker tables: append-only Parquet folders that both jobs read and write."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from threading import Lock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.operators.tracking import (
    CHUNK_TRACKER_SCHEMA,
    ERROR_SCHEMA,
    MASTER_TRACKER_SCHEMA,
    PART_SCHEMA,
    PUBLISHED,
    REMOVED,
    RUN_SCHEMA,
    STARTED,
    latest,
)
from haulage.sources import history

# The text form of times and the columns that exports carry as text.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
TEXT_IN_EXPORTS = ("chunk_size", "start_timestamp", "end_timestamp")


def now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def export_schema() -> T.StructType:
    fields = [
        T.StructField(f.name, T.StringType() if f.name in TEXT_IN_EXPORTS else f.dataType) for f in CHUNK_TRACKER_SCHEMA
    ]
    return T.StructType(fields)


def read_chunk_export(spark: SparkSession, path: str) -> DataFrame:
    """Chunk tracker rows exported as JSON, with sizes and times typed."""
    rows = spark.read.schema(export_schema()).json(path)
    typed = {
        "chunk_size": F.col("chunk_size").try_cast("bigint"),
        "start_timestamp": F.try_to_timestamp("start_timestamp", F.lit(TIME_FORMAT)).cast("timestamp_ntz"),
        "end_timestamp": F.try_to_timestamp("end_timestamp", F.lit(TIME_FORMAT)).cast("timestamp_ntz"),
    }
    return rows.withColumns(typed)


def run_of(place: Column) -> Column:
    """The run that a file's rows belong to."""
    return F.coalesce(F.regexp_extract(place, r"/run=(\d+)/", 1).try_cast("int"), F.lit(0))


class Trackers:
    """Histories of loads. One job at a time writes a load's rows.

    A load has runs, numbered from 1. Chunk rows keep their fixed columns; the run they belong to is in the folder they are
    appended to (``run=N``). Rows without such a folder are of run 0, from before runs were told apart.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.chunk_folder = f"{folder.rstrip('/')}/chunks"
        self.master_folder = f"{folder.rstrip('/')}/master"
        self.error_folder = f"{folder.rstrip('/')}/errors"
        self.run_folder = f"{folder.rstrip('/')}/runs"
        self.part_folder = f"{folder.rstrip('/')}/parts"
        self._compacting = Lock()

    def _read(self, folder: str, schema: T.StructType, place: bool = False) -> DataFrame:
        """All rows of a history; with ``place`` also the file each of them is in."""
        paths = history.paths(self.spark, folder)
        if not paths:
            return self.spark.createDataFrame([], T.StructType([*schema, T.StructField("place", T.StringType())]) if place else schema)
        rows = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
        return rows.select("*", F.col("_metadata.file_path").alias("place")) if place else rows

    def chunk_history(self) -> DataFrame:
        """Chunk rows of all runs."""
        return self._read(self.chunk_folder, CHUNK_TRACKER_SCHEMA)

    def run_chunks(self) -> DataFrame:
        """Chunk rows of each load's last run; a run that broke off before its plan was recorded has none."""
        rows = self._read(self.chunk_folder, CHUNK_TRACKER_SCHEMA, place=True)
        of_run = rows.withColumn("run", run_of(F.col("place"))).join(self.last_runs().withColumnRenamed("run", "last"), "log_id", "left")
        return of_run.filter(F.col("run") == F.coalesce("last", F.lit(0))).select(*CHUNK_TRACKER_SCHEMA.fieldNames())

    def master_history(self) -> DataFrame:
        return self._read(self.master_folder, MASTER_TRACKER_SCHEMA)

    def chunks_now(self) -> DataFrame:
        """The last state of every chunk of each load's last run."""
        return latest(self.run_chunks(), ["log_id", "iteration"], ["end_timestamp"])

    def master_now(self) -> DataFrame:
        return latest(self.master_history(), ["log_id"], ["end_timestamp"])

    def runs(self) -> DataFrame:
        return self._read(self.run_folder, RUN_SCHEMA)

    def last_runs(self) -> DataFrame:
        return self.runs().groupBy("log_id").agg(F.max("run").alias("run"))

    def last_run(self, log_id: int) -> int:
        """Number of the load's last run; 0 if none was ever started."""
        return self.last_runs().filter(F.col("log_id") == log_id).agg(F.max("run")).first()[0] or 0

    def published_run(self, log_id: int, before: int) -> int | None:
        """The last run before this one that readers have seen."""
        seen = self.runs().filter((F.col("log_id") == log_id) & (F.col("event") == PUBLISHED) & (F.col("run") < before))
        return seen.agg(F.max("run")).first()[0]

    def start_run(self, log_id: int) -> int:
        run = self.last_run(log_id) + 1
        self._append([{"log_id": log_id, "run": run, "event": STARTED, "at": now()}], RUN_SCHEMA, self.run_folder)
        return run

    def record_published(self, log_id: int, run: int) -> None:
        self._append([{"log_id": log_id, "run": run, "event": PUBLISHED, "at": now()}], RUN_SCHEMA, self.run_folder)

    def parts(self, log_id: int, run: int) -> DataFrame:
        """The ranges of a run's chunks."""
        return self._read(self.part_folder, PART_SCHEMA).filter((F.col("log_id") == log_id) & (F.col("run") == run))

    def planned(self, log_id: int) -> int:
        """Chunks in the load's last plan: one more than the highest number that was not removed since."""
        now_there = self.chunks_now().filter((F.col("log_id") == log_id) & ~F.col("write_status").eqNullSafe(REMOVED))
        last = now_there.agg(F.max("iteration")).first()[0]
        return 0 if last is None else last + 1

    def errors(self) -> DataFrame:
        return self._read(self.error_folder, ERROR_SCHEMA)

    def append_errors(self, rows: Sequence[dict]) -> None:
        self._append(rows, ERROR_SCHEMA, self.error_folder)

    def append_chunks(self, rows: Sequence[dict]) -> None:
        """Chunk rows of the last run of their loads."""
        by_run: dict[int, list[dict]] = {}
        last = {log_id: self.last_run(log_id) for log_id in {r["log_id"] for r in rows}}
        for row in rows:
            by_run.setdefault(last[row["log_id"]], []).append(row)
        for run, some in by_run.items():
            self._append(some, CHUNK_TRACKER_SCHEMA, f"{self.chunk_folder}/run={run}")

    def append_parts(self, rows: Sequence[dict]) -> None:
        self._append(rows, PART_SCHEMA, self.part_folder)

    def append_master(self, rows: Sequence[dict]) -> None:
        self._append(rows, MASTER_TRACKER_SCHEMA, self.master_folder)

    def _append(self, rows: Sequence[dict], schema: T.StructType, folder: str) -> None:
        if not rows:
            return
        values = [tuple(r.get(n) for n in schema.fieldNames()) for r in rows]
        rows_of_append = self.spark.createDataFrame(values, schema).coalesce(1)
        # a folder per append: jobs that write at the same time do not share a commit folder
        rows_of_append.write.parquet(f"{folder}/{uuid.uuid4()}")
        self.compact(folder.partition("/run=")[0], schema)

    def compact(self, folder: str, schema: T.StructType, least: int = history.APPENDS) -> bool:
        """Put a history's appends together once there are many; readers go on meanwhile. True if it was done."""
        with self._compacting:
            if len(history.tail(self.spark, folder)) < least:
                return False

            def merged(paths: list[str]) -> DataFrame:
                rows = self.spark.read.schema(schema).option("recursiveFileLookup", True).parquet(*paths)
                return rows.withColumn("run", run_of(F.col("_metadata.file_path")))

            return history.compact(self.spark, folder, merged)
