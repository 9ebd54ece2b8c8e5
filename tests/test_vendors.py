"""Vendor text: URLs, literals, key ranges and boundary queries, run on an embedded SQL engine where it can."""

import itertools
import random

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.predicates import at_or_after, before, ranges
from haulage.sources import vendors


def field(name, data_type, nullable=False):
    return T.StructField(name, data_type, nullable)


def test_urls(spark):
    work = spark.createDataFrame(
        [("mssql", "jdbc:sqlserver://h:1433/"), ("mysql", "jdbc:mysql://h:3306/")], "vendor string, base string"
    )
    made = work.select(vendors.url_expression(F.col("vendor"), F.col("base"), F.lit("db")).alias("u")).collect()
    assert [r["u"] for r in made] == [
        "jdbc:sqlserver://h:1433;databaseName=db;encrypt=true;trustServerCertificate=true",
        "jdbc:mysql://h:3306/db",
    ]
    assert vendors.connection_url("mssql", "jdbc:sqlserver://h/", "db").endswith("trustServerCertificate=false")
    assert vendors.connection_url("mssql", "jdbc:sqlserver://h/", "db", True) == (
        "jdbc:sqlserver://h;databaseName=db;encrypt=true;trustServerCertificate=true"
    )


def test_quoting_and_literals():
    assert vendors.quote("mysql", "a`b") == "`a``b`"
    assert vendors.quote("mssql", "a]b") == "[a]]b]"
    assert vendors.literal("mysql", "it's \\", T.StringType()) == "'it''s \\\\'"
    assert vendors.literal("postgres", "it's \\", T.StringType()) == "'it''s \\'"
    assert vendors.literal("postgres", "1.5", T.DoubleType()) == "1.5E0"
    for zone in ("", "Z", "+02:00", "-05:00", "-0330"):
        assert vendors.literal("postgres", f"2024-01-02T03:04:05{zone}", T.TimestampType()) == "TIMESTAMP '2024-01-02 03:04:05'"
    assert vendors.literal("mssql", "2024-01-02", T.DateType()) == "CAST('2024-01-02' AS DATE)"
    assert vendors.literal("ibm", "2024-01-02 03:04:05", T.TimestampNTZType()) == "TIMESTAMP '2024-01-02 03:04:05'"
    assert vendors.literal("mssql", "true", T.BooleanType()) == "1"
    with pytest.raises(ValueError):
        vendors.literal("postgres", "NaN", T.DoubleType())


@pytest.mark.parametrize("vendor", vendors.VENDORS)
def test_catalog_queries_name_the_table(vendor):
    queries = vendors.CATALOG[vendor]
    for sql, column in (
        (queries.size, "table_size_mb"),
        (queries.keys, "ordinal_position"),
        (queries.indexes, "indexed_column"),
        (queries.partitions, "partition_name"),
    ):
        filled = sql.format(database="'d'", schema="'s'", table="'t'")
        assert column in filled and "'t'" in filled


def test_page_and_boundary_text():
    assert vendors.page_query("mysql", "`t`", ["`a`"], 20, 10) == "SELECT * FROM `t` ORDER BY `a` LIMIT 10 OFFSET 20"
    assert vendors.page_query("ibm", '"t"', ['"a"'], 20, 10).endswith("OFFSET 20 ROWS FETCH NEXT 10 ROWS ONLY")
    assert "(rn - 1) % 10 = 0" in vendors.boundary_query("mssql", "[t]", ["a"], 10)
    assert vendors.boundary_query("derby", "t", ["a"], 10) is None
    with pytest.raises(ValueError):
        vendors.partition_source("ibm", "t", "s", "p")


@pytest.mark.parametrize("limit", [1, 37, 1500])
def test_pushed_boundaries_split_the_table(limit):
    con = duckdb.connect()
    con.execute("CREATE TABLE t AS SELECT o_custkey AS a, o_orderkey AS b FROM '/root/testdata/sf0.001/orders.parquet'")
    found = con.execute(vendors.boundary_query("postgres", '"t"', ["a", "b"], limit)).fetchall()
    lows = [(str(a), str(b)) for a, b, _ in sorted(found, key=lambda r: r[2])]
    fields = [field("a", T.LongType()), field("b", T.LongType())]
    texts = ranges("postgres", fields, lows, binary=False)
    if len(texts) > 60:
        texts = texts[:30] + texts[-30:]
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in texts]
    assert set(sizes) <= {limit, 1500 % limit}
    if len(lows) == len(texts):
        assert sum(sizes) == 1500


def nulls_first(values):
    return tuple((v is not None, v if v is not None else 0) for v in values)


def test_ranges_with_nulls_in_any_column():
    """Against brute force over all tuples of a small nullable domain."""
    con = duckdb.connect()
    domain = [None, 1, 2, 3]
    rows = list(itertools.product(domain, domain, domain))
    con.execute("CREATE TABLE t (a INTEGER, b INTEGER, c INTEGER)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    fields = [field(n, T.IntegerType(), True) for n in "abc"]
    for pivot in random.Random(5).sample(rows, 24):
        text = tuple(None if v is None else str(v) for v in pivot)
        after = set(con.execute(f"SELECT * FROM t WHERE {at_or_after('postgres', fields, text)}").fetchall())
        earlier = set(con.execute(f"SELECT * FROM t WHERE {before('postgres', fields, text)}").fetchall())
        assert after == {r for r in rows if nulls_first(r) >= nulls_first(pivot)}
        assert earlier == {r for r in rows if nulls_first(r) < nulls_first(pivot)}


def test_text_keys_use_binary_order():
    con = duckdb.connect()
    words = ["Zebra", "apple", "it's", "Ärger", "zoo", "a b", 'quo"te', "back\\slash"]
    con.execute("CREATE TABLE t (w VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [(w,) for w in words])
    ordered = sorted(words)
    texts = ranges("postgres", [field("w", T.StringType())], [(ordered[0],), (ordered[3],), (ordered[6],)])
    got = [sorted(r[0] for r in con.execute(f"SELECT w FROM t WHERE {p}").fetchall()) for p in texts]
    assert got == [ordered[:3], ordered[3:6], ordered[6:]]
    assert "BINARY" in ranges("mysql", [field("w", T.StringType())], [("a",), ("b",)])[1]
    assert "BIN2" in ranges("mssql", [field("w", T.StringType())], [("a",), ("b",)])[1]
