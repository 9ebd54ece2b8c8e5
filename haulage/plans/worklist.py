"""Loads from configuration: the work list, the vendors' connections and the masked columns, as frames."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulage.plans.extract import Load
from haulage.sources import vendors
from haulage.sources.jdbc import Connection, TableSpec

Secret = Callable[[str], str | None]


def loads(work: DataFrame, connections: DataFrame, masks: DataFrame | None, password: Secret) -> list[Load]:
    """One load per row of the work list, in the order of their numbers.

    work: log_id, table_key, sources, db_types, tables, databases, schemas. connections: rdbms, jdbc_url, db_driver, user_name;
    whatever else stands there, passwords too, is not read: they come from ``password``, by vendor. masks: table_key,
    column_name; they count for exactly that key. The driver holds what a row of the work list says, a line per table.
    """
    known = connections.select(F.lower("rdbms").alias("vendor"), "jdbc_url", "db_driver", "user_name").dropDuplicates(["vendor"])
    listed = work.withColumn("vendor", F.lower("db_types")).join(known, "vendor", "left")
    if masks is None:
        listed = listed.withColumn("columns", F.lit(None).cast("array<string>"))
    else:
        wanted = masks.select("table_key", "column_name").distinct()
        hidden = wanted.groupBy("table_key").agg(F.array_sort(F.collect_list("column_name")).alias("columns"))
        listed = listed.join(hidden, "table_key", "left")
    rows = listed.orderBy("log_id").collect()
    for problem, bad in (
        ("no connection is given for the databases of", [r["table_key"] for r in rows if r["jdbc_url"] is None]),
        ("log_id stands more than once:", [a["log_id"] for a, b in zip(rows, rows[1:]) if a["log_id"] == b["log_id"]]),
    ):
        if bad:
            raise ValueError(f"{problem} {', '.join(map(str, bad))}")
    secrets = {vendor: password(vendor) for vendor in {r["vendor"] for r in rows}}
    return [
        Load(
            r["log_id"],
            TableSpec(r["table_key"], r["sources"], r["tables"], r["databases"], r["schemas"]),
            Connection(
                r["vendor"],
                vendors.connection_url(r["vendor"], r["jdbc_url"], r["databases"]),
                r["db_driver"],
                r["user_name"],
                secrets[r["vendor"]],
            ),
            tuple(r["columns"] or ()),
        )
        for r in rows
    ]
