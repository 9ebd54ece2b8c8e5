"""A source without a database: its tables are Spark's own, its SQL is run by Spark, and each query is one partition.

The vendor is mysql, whose quoting and dialect Spark understands. What a driver would do (connections, types of a vendor) is not
covered here.
"""

import re
from functools import reduce

from pyspark.sql import DataFrame

from haulage.sources import jdbc, vendors
from haulage.sources.jdbc import Connection, TableSpec

SOURCE = Connection("mysql", "jdbc:none", "none")


class Queries(list):
    """What was asked of the source, in order."""


def install(monkeypatch) -> Queries:
    asked = Queries()

    def query_frame(spark, connection, sql):
        # a driver's scan says nothing about its partitioning; Spark would put a union of single partitions into one
        spark.conf.set("spark.sql.unionOutputPartitioning", "false")
        asked.append(sql)
        # forms of the dialect that Spark writes in another way, and a limit beyond its integers
        sql = re.sub(r"CONVERT\((.*?) USING utf8mb4\)", r"decode(\1, 'UTF-8')", sql)
        return spark.sql(sql.replace(f"LIMIT {vendors.ALL_ROWS}", "LIMIT 1000000")).coalesce(1)

    def range_frame(spark, connection, source, predicates):
        return reduce(DataFrame.union, [query_frame(spark, connection, f"SELECT * FROM {source} WHERE {p}") for p in predicates])

    monkeypatch.setattr(jdbc, "query_frame", query_frame)
    monkeypatch.setattr(jdbc, "range_frame", range_frame)
    monkeypatch.setattr(jdbc, "table_frame", lambda spark, connection, source: spark.sql(f"SELECT * FROM {source}"))
    return asked


def catalog(monkeypatch, keys=(), indexes=(), partitions=(), size=1.0):
    def listed(names, *columns):
        rows = ", ".join(f"('{n}', {i + 1})" for i, n in enumerate(names)) or "('', 0)"
        return f"SELECT * FROM (VALUES {rows}) AS t({', '.join(columns)}) WHERE {columns[1]} > 0"

    found = vendors.CatalogQueries(
        size=f"SELECT CAST({size} AS DOUBLE) AS table_size_mb",
        keys=listed(keys, "column_name", "ordinal_position"),
        indexes=listed(indexes, "indexed_column", "position"),
        partitions=listed(partitions, "partition_name", "place"),
    )
    monkeypatch.setitem(vendors.CATALOG, "mysql", found)


def spec(view: str) -> TableSpec:
    return TableSpec(f"standin.{view}", "standin", view, "none")
