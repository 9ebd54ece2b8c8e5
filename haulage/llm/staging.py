"""Tables in the folder that driver and executors share; they cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


#: A narrow table of known size is written by tasks of about so many rows, at least so many tasks.
ROWS_PER_TASK, MIN_TASKS = 200_000, 6


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; a temporary one only in a single-process session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        folder = tempfile.mkdtemp(prefix="haulage-llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def staged(df: DataFrame, label: str, rows: int | None = None) -> DataFrame:
    """The rows of df, computed once and written as Parquet; if their number is known, by tasks that are not tiny."""
    spark = df.sparkSession
    if rows is not None:
        df = df.coalesce(max(MIN_TASKS, rows // ROWS_PER_TASK))
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
