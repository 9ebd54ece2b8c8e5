"""Session settings the jobs rely on; a cluster's own settings win."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def local_session(cpus: int = 8, name: str = "haulage", **more: str) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(name)
    settings = {**SETTINGS, "spark.sql.shuffle.partitions": str(cpus), "spark.driver.memory": "8g", **more}
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
