"""What differs between database vendors: URLs, quoting, literals and catalog queries.

The catalog queries are configuration: they follow each vendor's public catalog views and return
columns of one fixed shape. ``derby`` is the in-process database of the tests.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vendor tags as they stand in work lists.
VENDORS = ("mysql", "maria", "postgres", "ibm", "mssql")
MSSQL_SUFFIX = ";encrypt=true;trustServerCertificate=true"

#: Where Spark creates text columns as large objects, which have no minimum or maximum.
TEXT_AS_OBJECTS = ("ibm", "derby")

#: A row limit that never bites, for dialects in which an offset needs one.
ALL_ROWS = 9_223_372_036_854_775_807

#: How the condition of a filtered FROM item begins.
FILTERED = "WHERE /* partition */ "

#: Offset at the end of a time: Z, or hours ahead of or behind it.
ZONE = re.compile(r"(?:Z|[+-]\d{2}:?\d{2}(?::?\d{2})?)$")

# mysql's driver would hold a whole result in memory without a cursor; Spark quotes names for
# jdbc:mariadb: URLs in double quotes, which the session must accept as names
SESSION_OPTIONS = {
    "mysql": {"useCursorFetch": "true"},
    "maria": {"sessionInitStatement": "SET SESSION sql_mode = CONCAT(@@sql_mode, ',ANSI_QUOTES')"},
}


def url_expression(vendor: Column, base: Column, database: Column) -> Column:
    """Connection URL over a work list."""
    mssql = F.concat(F.rtrim(base, F.lit("/")), F.lit(";databaseName="), database, F.lit(MSSQL_SUFFIX))
    return F.when(vendor == "mssql", mssql).otherwise(F.concat(base, database))


def connection_url(vendor: str, base: str, database: str, trust_certificate: bool = False) -> str:
    """Connection URL of one source; an unverified server certificate has to be asked for."""
    if vendor != "mssql":
        return base + database
    trust = "true" if trust_certificate else "false"
    return f"{base.rstrip('/')};databaseName={database};encrypt=true;trustServerCertificate={trust}"


def quote(vendor: str, name: str) -> str:
    if vendor in ("mysql", "maria"):
        return "`" + name.replace("`", "``") + "`"
    if vendor == "mssql":
        return "[" + name.replace("]", "]]") + "]"
    return '"' + name.replace('"', '""') + '"'


def table_name(vendor: str, table: str, schema: str | None) -> str:
    return f"{quote(vendor, schema)}.{quote(vendor, table)}" if schema else quote(vendor, table)


def text_literal(vendor: str, value: str) -> str:
    if vendor in ("mysql", "maria"):
        value = value.replace("\\", "\\\\")
    return ("N'" if vendor == "mssql" else "'") + value.replace("'", "''") + "'"


def literal(vendor: str, text: str, data_type: T.DataType) -> str:
    """SQL literal of a value given as the text Spark casts it to."""
    if isinstance(data_type, T.StringType):
        return text_literal(vendor, text)
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        if text.lower().lstrip("-") in ("nan", "infinity"):
            raise ValueError(f"{text} has no portable SQL literal")
        return text if "e" in text.lower() else text + "E0"
    if isinstance(data_type, T.BooleanType):
        return {"true": "1", "false": "0"}[text] if vendor in ("mssql", "mysql", "maria") else text
    if isinstance(data_type, T.DateType):
        return f"CAST('{text}' AS DATE)" if vendor == "mssql" else f"DATE '{text}'" if vendor != "derby" else f"DATE('{text}')"
    if isinstance(data_type, T.TimestampType):
        zone_free = ZONE.sub("", text).replace("T", " ")
        return literal(vendor, zone_free, T.TimestampNTZType())
    if isinstance(data_type, T.TimestampNTZType):
        if vendor == "mssql":
            return f"CAST('{text}' AS DATETIME2)"
        return f"TIMESTAMP('{text}')" if vendor == "derby" else f"TIMESTAMP '{text}'"
    return text


def ordered_column(vendor: str, name: str, data_type: T.DataType) -> str:
    """A key column compared in Spark's (binary) text order, whatever collation the source uses."""
    column = quote(vendor, name)
    if not isinstance(data_type, T.StringType):
        return column
    forms = {
        "mysql": f"CAST({column} AS BINARY)",
        "maria": f"CAST({column} AS BINARY)",
        "postgres": f'{column} COLLATE "C"',
        "mssql": f"{column} COLLATE Latin1_General_100_BIN2_UTF8",
        "ibm": f"COLLATION_KEY_BIT({column}, 'IDENTITY')",
    }
    return forms.get(vendor, column)


def ordered_literal(vendor: str, text: str, data_type: T.DataType) -> str:
    value = literal(vendor, text, data_type)
    if vendor == "ibm" and isinstance(data_type, T.StringType):
        return f"COLLATION_KEY_BIT({value}, 'IDENTITY')"
    return value


def extreme(vendor: str, word: str, name: str, data_type: T.DataType) -> str:
    """MIN or MAX of a column, text in Spark's order."""
    column = quote(vendor, name)
    if isinstance(data_type, T.BooleanType):
        yes, no = literal(vendor, "true", data_type), literal(vendor, "false", data_type)
        return f"{word.upper()}(CASE WHEN {column} = {yes} THEN 1 WHEN {column} = {no} THEN 0 END)"
    if isinstance(data_type, T.StringType) and vendor in ("mysql", "maria"):
        return f"CONVERT({word.upper()}(CAST({column} AS BINARY)) USING utf8mb4)"
    if isinstance(data_type, T.StringType) and vendor != "ibm":
        column = ordered_column(vendor, name, data_type)
    return f"{word.upper()}({column})"


def page_query(vendor: str, table: str, columns: Sequence[str], offset: int, rows: int) -> str:
    """One page of a table under the total order of the given columns."""
    order = ", ".join(columns)
    if vendor in ("mysql", "maria"):
        return f"SELECT * FROM {table} ORDER BY {order} LIMIT {rows} OFFSET {offset}"
    return f"SELECT * FROM {table} ORDER BY {order} OFFSET {offset} ROWS FETCH NEXT {rows} ROWS ONLY"


def boundary_query(
    vendor: str, table: str, keys: Sequence[str], chunk_rows: int, part_rows: int | None = None
) -> str | None:
    """First key of every chunk and of every part of it, found by the source along its own key index; None where it cannot."""
    if vendor == "derby":
        return None
    columns = ", ".join(quote(vendor, k) for k in keys)
    in_chunk = f"(rn - 1) % {chunk_rows}" if vendor == "mssql" else f"MOD(rn - 1, {chunk_rows})"
    if part_rows is not None and part_rows < chunk_rows:
        in_chunk = f"({in_chunk}) % {part_rows}" if vendor == "mssql" else f"MOD({in_chunk}, {part_rows})"
    first = f"{in_chunk} = 0"
    numbered = f"SELECT {columns}, ROW_NUMBER() OVER (ORDER BY {columns}) AS rn FROM {table}"
    return f"SELECT {columns}, rn FROM ({numbered}) numbered WHERE {first}"


def total_order(vendor: str, fields: Sequence[T.StructField]) -> str:
    """ORDER BY of a tuple in Spark's order: NULLs first, text by its bytes."""
    keys = []
    for f in fields:
        if f.nullable:
            keys.append(f"CASE WHEN {quote(vendor, f.name)} IS NULL THEN 0 ELSE 1 END")
        keys.append(ordered_column(vendor, f.name, f.dataType))
    return ", ".join(keys)


def page_border_query(
    vendor: str, source: str, fields: Sequence[T.StructField], rows: int, part_rows: int
) -> str | None:
    """The first row of every page and of every part of it: its values (k0, k1, …), how many copies of it stand before it
    (ordinal), its number (rn) and whether a page begins with it (page_start). None where the source cannot number rows."""
    if vendor == "derby":
        return None
    order = total_order(vendor, fields)
    columns = ", ".join(f"{quote(vendor, f.name)} AS k{i}" for i, f in enumerate(fields))
    rest = (lambda a, b: f"({a}) % {b}") if vendor == "mssql" else (lambda a, b: f"MOD({a}, {b})")
    in_page = rest("rn - 1", rows)
    numbered = f"SELECT {columns}, ROW_NUMBER() OVER (ORDER BY {order}) AS rn, RANK() OVER (ORDER BY {order}) AS place FROM {source}"
    keys = ", ".join(f"k{i}" for i in range(len(fields)))
    return (
        f"SELECT {keys}, rn - place AS ordinal, rn, CASE WHEN {in_page} = 0 THEN 1 ELSE 0 END AS page_start "
        f"FROM ({numbered}) numbered WHERE {rest(in_page, part_rows)} = 0"
    )


def value_statistics_query(vendor: str, table: str, field: T.StructField) -> str:
    """Rows, distinct values (NULL is one) and rows of the most frequent value of a column, one row."""
    counted = f"SELECT COUNT(*) AS n FROM {table} GROUP BY {_value_key(vendor, field)}"
    return f"SELECT SUM(n) AS n_rows, COUNT(*) AS n_values, MAX(n) AS max_rows FROM ({counted}) counted"


def _value_key(vendor: str, field: T.StructField) -> str:
    """Tells values apart by their bytes, whatever the source's collation."""
    column, key = quote(vendor, field.name), ordered_column(vendor, field.name, field.dataType)
    return column if key == column else f"{column}, {key}"


def value_border_query(vendor: str, table: str, field: T.StructField, rows: int, part_rows: int) -> str | None:
    """Where the chunks of packed values begin, and the parts inside them: v, chunk_start (1 or 0), place (in value order).

    The packing of ``chunking.pack_values``, done by the source: values over half a chunk stand alone, the others are packed
    by the rows before them. None where the source cannot number rows.
    """
    if vendor == "derby":
        return None
    rest = (lambda a, b: f"(({a}) % ({b}))") if vendor == "mssql" else (lambda a, b: f"MOD({a}, {b})")
    whole = lambda a, b: f"({a} - {rest(a, b)}) / {b}"
    column, key = quote(vendor, field.name), ordered_column(vendor, field.name, field.dataType)
    so_far = "OVER (ORDER BY k ROWS UNBOUNDED PRECEDING)"
    counted = (
        f"SELECT {column} AS v, {key} AS k, COUNT(*) AS n FROM {table} WHERE {column} IS NOT NULL "
        f"GROUP BY {_value_key(vendor, field)}"
    )
    weighed = (
        f"SELECT v, k, CASE WHEN n * 2 > {rows} THEN 1 ELSE 0 END AS heavy, CASE WHEN n * 2 > {rows} THEN 0 ELSE n END AS light "
        f"FROM ({counted}) counted"
    )
    summed = (
        f"SELECT v, k, heavy, SUM(heavy) {so_far} - heavy AS heavies, SUM(light) {so_far} - light AS before, "
        f"{rows + 1} - MAX(light) OVER () AS step FROM ({weighed}) weighed"
    )
    packed = (
        f"SELECT v, k, heavy, heavies, CASE WHEN heavy = 1 THEN 0 ELSE {whole('before', 'step')} END AS pack, "
        f"CASE WHEN heavy = 1 THEN 0 ELSE {whole(rest('before', 'step'), str(part_rows))} END AS part FROM ({summed}) summed"
    )
    started = (
        "SELECT v, k, ROW_NUMBER() OVER (PARTITION BY heavies, heavy, pack ORDER BY k) AS in_chunk, "
        f"ROW_NUMBER() OVER (PARTITION BY heavies, heavy, pack, part ORDER BY k) AS in_part FROM ({packed}) packed"
    )
    return (
        "SELECT v, CASE WHEN in_chunk = 1 THEN 1 ELSE 0 END AS chunk_start, ROW_NUMBER() OVER (ORDER BY k) AS place "
        f"FROM ({started}) started WHERE in_part = 1"
    )


def filtered(source: str) -> tuple[str, str | None]:
    """FROM item without its condition, and the condition, if a partition is read by one."""
    item, _, condition = source.partition(f" {FILTERED}")
    return item, condition or None


def partition_source(vendor: str, table: str, schema: str | None, partition: str) -> str:
    """FROM item (and filter) that reads one partition of a table."""
    name = table_name(vendor, table, schema)
    if vendor in ("mysql", "maria"):
        return f"{name} PARTITION ({quote(vendor, partition)})"
    if vendor == "postgres":
        return partition  # quoted, with its own schema, by the catalog query
    if vendor == "mssql":
        return f"{name} {FILTERED}({partition})"
    raise ValueError(f"no partition reads for {vendor}")


@dataclass(frozen=True)
class CatalogQueries:
    """Column shapes: size(table_size_mb); keys(column_name, ordinal_position);
    indexes(indexed_column, position); partitions(partition_name)."""

    size: str
    keys: str
    indexes: str
    partitions: str | None


_MYSQL = CatalogQueries(
    size="""SELECT data_length / 1048576 AS table_size_mb FROM information_schema.tables
WHERE table_schema = {database} AND table_name = {table}""",
    keys="""SELECT column_name AS column_name, ordinal_position AS ordinal_position
FROM information_schema.key_column_usage
WHERE constraint_name = 'PRIMARY' AND table_schema = {database} AND table_name = {table}""",
    indexes="""SELECT column_name AS indexed_column,
DENSE_RANK() OVER (ORDER BY index_name) * 1000 + seq_in_index AS position
FROM information_schema.statistics
WHERE index_name <> 'PRIMARY' AND table_schema = {database} AND table_name = {table}""",
    partitions="""SELECT DISTINCT partition_name AS partition_name FROM information_schema.partitions
WHERE partition_name IS NOT NULL AND table_schema = {database} AND table_name = {table}""",
)

_STANDARD_KEYS = """SELECT k.column_name AS column_name, k.ordinal_position AS ordinal_position
FROM information_schema.table_constraints c
JOIN information_schema.key_column_usage k
ON k.constraint_schema = c.constraint_schema AND k.constraint_name = c.constraint_name
WHERE c.constraint_type = 'PRIMARY KEY' AND c.table_schema = {schema} AND c.table_name = {table}"""

CATALOG: dict[str, CatalogQueries] = {
    "mysql": _MYSQL,
    "maria": _MYSQL,
    "postgres": CatalogQueries(
        size="""SELECT COALESCE((SELECT SUM(pg_table_size(t.relid)) FROM pg_partition_tree(c.oid) t),
pg_table_size(c.oid)) / 1048576.0 AS table_size_mb
FROM pg_class c JOIN pg_namespace n ON n.oid = c.relnamespace
WHERE n.nspname = {schema} AND c.relname = {table}""",
        keys=_STANDARD_KEYS,
        indexes="""SELECT a.attname AS indexed_column,
DENSE_RANK() OVER (ORDER BY i.indexrelid) * 1000 + k.place AS position
FROM pg_index i JOIN pg_class c ON c.oid = i.indrelid JOIN pg_namespace n ON n.oid = c.relnamespace
CROSS JOIN LATERAL unnest(i.indkey) WITH ORDINALITY AS k(attnum, place)
JOIN pg_attribute a ON a.attrelid = c.oid AND a.attnum = k.attnum
WHERE NOT i.indisprimary AND n.nspname = {schema} AND c.relname = {table}""",
        partitions="""SELECT quote_ident(own.nspname) || '.' || quote_ident(part.relname) AS partition_name FROM pg_inherits h
JOIN pg_class parent ON parent.oid = h.inhparent JOIN pg_class part ON part.oid = h.inhrelid
JOIN pg_namespace n ON n.oid = parent.relnamespace JOIN pg_namespace own ON own.oid = part.relnamespace
WHERE parent.relkind = 'p' AND n.nspname = {schema} AND parent.relname = {table}""",
    ),
    "mssql": CatalogQueries(
        size="""SELECT SUM(a.total_pages) * 8 / 1024.0 AS table_size_mb
FROM sys.tables t JOIN sys.schemas s ON s.schema_id = t.schema_id
JOIN sys.partitions p ON p.object_id = t.object_id
JOIN sys.allocation_units a ON a.container_id = p.partition_id
WHERE s.name = {schema} AND t.name = {table} GROUP BY t.object_id""",
        keys=_STANDARD_KEYS,
        indexes="""SELECT c.name AS indexed_column, i.index_id * 1000 + ic.key_ordinal AS position
FROM sys.indexes i JOIN sys.tables t ON t.object_id = i.object_id
JOIN sys.schemas s ON s.schema_id = t.schema_id
JOIN sys.index_columns ic ON ic.object_id = i.object_id AND ic.index_id = i.index_id
JOIN sys.columns c ON c.object_id = ic.object_id AND c.column_id = ic.column_id
WHERE i.is_primary_key = 0 AND ic.key_ordinal > 0 AND s.name = {schema} AND t.name = {table}""",
        partitions="""SELECT '$PARTITION.' + f.name + '(' + QUOTENAME(c.name) + ') = '
+ CAST(p.partition_number AS VARCHAR(10)) AS partition_name
FROM sys.partitions p JOIN sys.tables t ON t.object_id = p.object_id
JOIN sys.schemas s ON s.schema_id = t.schema_id
JOIN sys.indexes i ON i.object_id = p.object_id AND i.index_id = p.index_id
JOIN sys.partition_schemes ps ON ps.data_space_id = i.data_space_id
JOIN sys.partition_functions f ON f.function_id = ps.function_id
JOIN sys.index_columns ic ON ic.object_id = i.object_id AND ic.index_id = i.index_id AND ic.partition_ordinal = 1
JOIN sys.columns c ON c.object_id = ic.object_id AND c.column_id = ic.column_id
WHERE p.index_id IN (0, 1) AND s.name = {schema} AND t.name = {table}""",
    ),
    "ibm": CatalogQueries(
        size="""SELECT SUM(DATA_OBJECT_P_SIZE + LONG_OBJECT_P_SIZE + LOB_OBJECT_P_SIZE + XML_OBJECT_P_SIZE) / 1024.0
AS table_size_mb FROM SYSIBMADM.ADMINTABINFO
WHERE TABSCHEMA = {schema} AND TABNAME = {table} HAVING COUNT(*) > 0""",
        keys="""SELECT k.COLNAME AS column_name, k.COLSEQ AS ordinal_position
FROM SYSCAT.TABCONST c JOIN SYSCAT.KEYCOLUSE k
ON k.CONSTNAME = c.CONSTNAME AND k.TABSCHEMA = c.TABSCHEMA AND k.TABNAME = c.TABNAME
WHERE c.TYPE = 'P' AND c.TABSCHEMA = {schema} AND c.TABNAME = {table}""",
        indexes="""SELECT COLNAMES AS indexed_column, ROW_NUMBER() OVER (ORDER BY INDNAME) AS position
FROM SYSCAT.INDEXES WHERE UNIQUERULE <> 'P' AND TABSCHEMA = {schema} AND TABNAME = {table}""",
        partitions="""SELECT DATAPARTITIONNAME AS partition_name FROM SYSCAT.DATAPARTITIONS
WHERE TABSCHEMA = {schema} AND TABNAME = {table}""",
    ),
}
