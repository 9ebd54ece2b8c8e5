"""An in-process, in-memory database as JDBC source and target; it opens no port."""

import itertools

from haulage.sources import vendors
from haulage.sources.jdbc import Connection, TableSpec
from haulage.sources.rdbms import _statements

_names = itertools.count()
_FROM = """FROM SYS.SYSTABLES t JOIN SYS.SYSSCHEMAS s ON s.SCHEMAID = t.SCHEMAID
JOIN SYS.SYSCOLUMNS c ON c.REFERENCEID = t.TABLEID
WHERE s.SCHEMANAME = {schema} AND t.TABLENAME = {table}"""


def catalog(keys=(), indexes=(), partitions=None, size=None):
    """Derby hides key columns in an object value, so tests name them; the rows still come from the source."""

    def listed(names, alias, place):
        tests = " ".join(f"WHEN '{n}' THEN {i + 1}" for i, n in enumerate(names))
        inside = ", ".join(f"'{n}'" for n in names) or "''"
        rank = f"CASE c.COLUMNNAME {tests} ELSE 0 END" if names else "0"
        return f"SELECT c.COLUMNNAME AS {alias}, {rank} AS {place} {_FROM} AND c.COLUMNNAME IN ({inside})"

    size_sql = "SELECT CAST(1 AS DOUBLE) AS table_size_mb FROM SYSIBM.SYSDUMMY1 WHERE 1 = 0"
    if size is not None:
        size_sql = f"SELECT CAST({size} AS DOUBLE) AS table_size_mb FROM SYSIBM.SYSDUMMY1"
    return vendors.CatalogQueries(
        size=size_sql,
        keys=listed(keys, "column_name", "ordinal_position"),
        indexes=listed(indexes, "indexed_column", "position"),
        partitions=partitions,
    )


def connection():
    url = f"jdbc:derby:memory:haulage{next(_names)};create=true"
    return Connection("derby", url, "org.apache.derby.iapi.jdbc.AutoloadedDriver")


def fill(df, conn, name, types=None):
    writer = df.write.format("jdbc").options(**conn.options()).option("dbtable", name)
    if types:
        writer = writer.option("createTableColumnTypes", types)
    writer.save()


def run(spark, conn, *statements):
    with _statements(spark, conn) as execute:
        for statement in statements:
            execute(statement)


def spec(table):
    return TableSpec(f"derby.{table}", "derby", table, "memory", "APP")
