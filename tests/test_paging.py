"""Pages of tables without a key: borders found in one query, key ranges, offsets only inside runs of full copies."""

import random
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.predicates import above, before, equal
from haulage.operators import chunking
from haulage.sources import jdbc, paging, vendors
from haulage.sources.jdbc import JdbcTable, chunk_scan
from tests import standin
from tests.conftest import SF_DIR

FIELDS = [T.StructField("a", T.IntegerType(), True), T.StructField("w", T.StringType(), True), T.StructField("b", T.LongType(), False)]


def pages_on(con, rows, part, cut_runs=True, vendor="postgres"):
    sql = vendors.page_border_query(vendor, "t", FIELDS, rows, part)
    found = sorted(con.execute(sql).fetchall(), key=lambda r: r[-2])
    texts = [tuple(None if v is None else str(v) for v in r[:3]) for r in found]
    borders = [paging.Border(t, r[3], r[5]) for t, r in zip(texts, found)]
    return paging.pages(vendor, FIELDS, borders, cut_runs, rows), found


def table(rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE t (a INTEGER, w VARCHAR, b BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?, ?)", rows)
    return con


def read(con, page):
    return Counter(con.execute(page.query("postgres", "t")).fetchall())


@pytest.mark.parametrize("rows,part", [(1, 1), (7, 7), (20, 6), (64, 10), (1000, 100)])
def test_no_offset_without_copies(rows, part):
    pick = random.Random(rows)
    made = list({(pick.choice([None, 1, 2, 3]), pick.choice([None, "it's", "Ä", "a", "B"]), n // 3) for n in range(300)})
    con = table(made)
    pages, _ = pages_on(con, rows, part)
    found = [read(con, p) for p in pages]
    assert sum(found, Counter()) == Counter(made)
    assert [sum(c.values()) for c in found] == [rows] * (len(made) // rows) + ([len(made) % rows] if len(made) % rows else [])
    assert all(p.predicate is not None and "OFFSET" not in p.query("postgres", "t") for p in pages)
    for page in pages:  # parts make up the page
        inside = [Counter(con.execute(f"SELECT * FROM t WHERE {x}").fetchall()) for x in page.parts or (page.predicate,)]
        assert sum(inside, Counter()) == read(con, page) and all(sum(c.values()) <= part for c in inside)


@pytest.mark.parametrize("rows", [1, 4, 10, 33, 500])
def test_runs_of_copies_are_cut_by_offset_inside_them(rows):
    made = [(1, "a", 1)] * 95 + [(None, None, 2)] * 40 + [(1, "a", n) for n in range(2, 30)] + [(2, "z", 9)] * 3
    con = table(made)
    pages, _ = pages_on(con, rows, max(1, rows // 2))
    found = [read(con, p) for p in pages]
    assert sum(found, Counter()) == Counter(made)
    sizes = [sum(c.values()) for c in found]
    assert set(sizes[:-1]) <= {rows} and 0 < sizes[-1] <= rows
    # Offsets stand inside a run only: a piece that skips or is cut has one tuple.
    assert all(len(read(con, p)) == 1 for p in pages if len(p.pieces) == 1)
    if rows == 500:
        assert pages[0].predicate == "1 = 1"


def test_runs_stay_whole_where_rows_of_a_run_may_differ():
    made = [(1, "a", 1)] * 95 + [(None, None, 2)] * 40 + [(1, "a", n) for n in range(2, 30)]
    con = table(made)
    for rows in (1, 7, 30, 50):
        pages, _ = pages_on(con, rows, rows, cut_runs=False)
        found = [read(con, p) for p in pages]
        assert sum(found, Counter()) == Counter(made)
        assert all(p.predicate is not None for p in pages)
        owners = Counter(row for c in found for row in c)
        assert max(owners.values()) == 1  # no tuple in two pages
        assert all(sum(c.values()) <= rows + 95 for c in found)


def test_three_way_split_is_exact():
    """Below, equal and above a tuple: every row in exactly one, whatever is NULL."""
    values = [(a, w, b) for a in (None, 1, 2) for w in (None, "a", "b") for b in (1, 2)]
    con = table(values)
    for pivot in values:
        text = tuple(None if v is None else str(v) for v in pivot)
        parts = [con.execute(f"SELECT * FROM t WHERE {f('postgres', FIELDS, text)}").fetchall() for f in (before, equal, above)]
        assert sum(map(len, parts)) == len(values) and set(sum(parts, [])) == set(values) and parts[1] == [pivot]


def test_a_partition_read_by_a_condition_keeps_it():
    source = vendors.partition_source("mssql", "t", None, "$PARTITION.f([a]) = 2")
    item, condition = vendors.filtered(source)
    assert (item, condition) == ("[t]", "($PARTITION.f([a]) = 2)")
    assert vendors.filtered("`t` PARTITION (`p`)") == ("`t` PARTITION (`p`)", None)
    borders = [paging.Border(("1", "a", "1"), 0), paging.Border(("2", "b", "5"), 3), paging.Border(("3", "c", "6"), 0)]
    pages = paging.pages("mssql", FIELDS, borders, True, 10, condition)
    for page in pages:
        assert page.query("mssql", item).count("SELECT * FROM [t] WHERE ($PARTITION.f([a]) = 2) AND ") == max(1, len(page.pieces))
    assert [len(p.pieces) for p in pages] == [2, 2, 0]


@pytest.mark.parametrize("vendor", vendors.VENDORS)
def test_border_queries_of_all_vendors(vendor):
    sql = vendors.page_border_query(vendor, "t", FIELDS, 10, 5)
    assert "RANK() OVER (ORDER BY CASE WHEN" in sql and ("%" in sql) == (vendor == "mssql")
    assert vendors.page_border_query("derby", "t", FIELDS, 10, 5) is None


def test_values_without_a_literal():
    fields = [T.StructField("x", T.DoubleType(), True)]
    with pytest.raises(paging.NoLiteral):
        paging.pages("postgres", fields, [paging.Border(("1.0",), 0), paging.Border(("NaN",), 0)], True, 5)


# Strategies over a stand-in source


@pytest.fixture
def source(spark, monkeypatch):
    part = spark.read.parquet(f"{SF_DIR}/part.parquet").withColumn("p_type", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type")))
    part.drop("p_partkey", "p_name").createOrReplaceTempView("s_types")
    part.createOrReplaceTempView("s_part")
    return standin.install(monkeypatch)


def check(spark, table, plan, strategy, limit=None):
    assert plan.strategy == strategy
    scan = chunk_scan(spark, table.connection, table.name, plan.chunks)
    whole = table.frame()
    assert scan.drop("iteration").exceptAll(whole).count() == 0 and whole.exceptAll(scan.drop("iteration")).count() == 0
    sizes = {r["iteration"]: r["count"] for r in scan.groupBy("iteration").count().collect()}
    assert max(sizes.values()) <= (limit or plan.chunk_rows)
    for chunk in plan.chunks[:4]:  # the stored query gives the chunk's rows
        assert jdbc.query_frame(spark, table.connection, chunk.query).count() == sizes.get(chunk.iteration, 0)
    tasks = scan.groupBy("iteration", F.spark_partition_id().alias("task")).count()
    return sizes, {r["iteration"]: r["count"] for r in tasks.groupBy("iteration").count().collect()}


def test_pages_are_ranges_read_by_several_tasks(spark, source, monkeypatch):
    standin.catalog(monkeypatch, size=2)
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_part"), task_rows=20)
    plan = table.plan(0.6)
    sizes, tasks = check(spark, table, plan, "limit_offset", 61)
    assert sorted(sizes.values()) == [20, 60, 60, 60] and sorted(tasks.values()) == [1, 3, 3, 3]
    assert not any("OFFSET" in q for q in source)


def test_pages_of_copies(spark, source, monkeypatch):
    spark.sql("SELECT p_brand, p_size % 2 AS half FROM s_types").createOrReplaceTempView("s_copies")
    standin.catalog(monkeypatch, size=2)
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_copies"))
    sizes, _ = check(spark, table, table.plan(0.07), "limit_offset")
    assert sorted(sizes.values()) == [4] + [7] * 28
    spark.sql("SELECT p_brand, p_size % 2 AS half, array(p_size) AS sizes FROM s_types").createOrReplaceTempView("s_nested")
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_nested"))
    source.clear()
    check(spark, table, table.plan(0.07), "limit_offset", 200)
    assert not any("OFFSET" in q for q in source)


def test_index_pages(spark, source, monkeypatch):
    standin.catalog(monkeypatch, indexes=["p_type"], size=2)
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_part"))
    sizes, _ = check(spark, table, table.plan(0.15), "non_clustered_limit_offset")
    assert sorted(sizes.values()) == [5] + [15] * 13
    assert not any("OFFSET" in q for q in source)


def test_index_chunks_are_read_by_several_tasks(spark, source, monkeypatch):
    standin.catalog(monkeypatch, indexes=["p_size"], size=2)
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_part"), task_rows=20)
    plan = table.plan(0.8)
    sizes, tasks = check(spark, table, plan, "non_clustered")
    full = {n: k for n, k in tasks.items() if sizes[n] >= 60}
    assert full and all(k >= 3 for k in full.values())
    assert not any("rows_of_value" in q for q in source)  # no list of all values
    monkeypatch.setattr(vendors, "value_border_query", lambda *_: None)
    again = table.plan(0.8)
    assert [(c.query, c.parts) for c in again.chunks] == [(c.query, c.parts) for c in plan.chunks]


def test_parts_of_packed_values(spark):
    random.seed(4)
    counts = spark.createDataFrame([(v, random.randint(1, 12)) for v in range(150)] + [(None, 9), (150, 70)], "v int, n long")
    manifest = chunking.pack_values(counts, "v", 100, 25).orderBy("iteration").collect()
    sized = {r["v"]: r["n"] for r in counts.collect()}
    for row in manifest:
        lows = row["part_lows"]
        assert lows[0] == row["lo_v"] and lows == sorted(lows, key=lambda x: (x is not None, x))
        if row["lo_v"] is None or len(lows) == 1:
            continue
        for a, b in zip(lows, [*lows[1:], row["hi_v"] + 1]):
            assert sum(sized[v] for v in range(a, b)) <= 25 + sized[b - 1]
    assert "part_lows" not in chunking.pack_values(counts, "v", 100).columns


@pytest.mark.parametrize("vendor", ["postgres", "mysql"])
@pytest.mark.parametrize("rows,part", [(70, 70), (100, 25), (300, 40)])
def test_values_packed_by_the_source(spark, vendor, rows, part):
    """The same chunks and parts as Spark packs, from one query."""
    pick = random.Random(rows)
    made = [(v, pick.randint(1, 12) if v % 40 else rows) for v in range(150)] + [(None, 9)]
    counts = spark.createDataFrame(made, "v int, n long")
    manifest = chunking.pack_values(counts, "v", rows, part).filter("lo_v IS NOT NULL").orderBy("iteration")
    want = [r["part_lows"] for r in manifest.collect()]
    field = T.StructField("v", T.IntegerType(), True)
    sql = vendors.value_border_query(vendor, "t", field, rows, part)
    stats = vendors.value_statistics_query(vendor, "t", field)
    if vendor == "postgres":
        con = duckdb.connect()
        con.execute("CREATE TABLE t (v INTEGER)")
        con.executemany("INSERT INTO t VALUES (?)", [(v,) for v, n in made for _ in range(n)])
        found, facts = con.execute(sql).fetchall(), con.execute(stats).fetchone()
    else:
        counts.selectExpr("v", "explode(sequence(1, n)) AS i").select("v").createOrReplaceTempView("t")
        found, facts = [tuple(r) for r in spark.sql(sql).collect()], tuple(spark.sql(stats).first())
    got = []
    for v, new, _ in sorted(found, key=lambda r: r[2]):
        got = [*got, [v]] if new else [*got[:-1], [*got[-1], v]]
    assert got == want
    assert tuple(map(int, facts)) == (sum(n for _, n in made), 151, rows)


@pytest.mark.parametrize("vendor", vendors.VENDORS)
def test_value_queries_of_all_vendors(vendor):
    field = T.StructField("w", T.StringType(), True)
    sql = vendors.value_border_query(vendor, "t", field, 10, 5)
    assert vendors.ordered_column(vendor, "w", field.dataType) + " AS k" in sql and ("%" in sql) == (vendor == "mssql")
    assert vendors.value_border_query("derby", "t", field, 10, 5) is None


def test_partitions(spark, source, monkeypatch):
    brands = [r[0] for r in spark.sql("SELECT DISTINCT p_brand FROM s_part").collect()]
    standin.catalog(monkeypatch, partitions=brands, size=2)
    for i, brand in enumerate(sorted(brands)):
        spark.sql(f"SELECT * FROM s_part WHERE p_brand = '{brand}'").createOrReplaceTempView(f"s_brand_{i}")
    names = {b: f"s_brand_{i}" for i, b in enumerate(sorted(brands))}
    monkeypatch.setattr(vendors, "partition_source", lambda vendor, table, schema, p: names[p])
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_part"))
    check(spark, table, table.plan(0.04), "partition")
    assert not any("OFFSET" in q for q in source)


def test_sources_that_cannot_number_rows(spark, source, monkeypatch):
    """Key borders are found by Spark, pages by offset; both are the rows of the table."""
    monkeypatch.setattr(vendors, "boundary_query", lambda *_: None)
    monkeypatch.setattr(vendors, "page_border_query", lambda *_: None)
    standin.catalog(monkeypatch, keys=["p_partkey"], size=2)
    table = JdbcTable(spark, standin.SOURCE, standin.spec("s_part"), task_rows=20)
    sizes, tasks = check(spark, table, table.plan(0.6), "clustered")
    assert sorted(sizes.values()) == [20, 60, 60, 60] and sorted(tasks.values()) == [1, 3, 3, 3]
    standin.catalog(monkeypatch, size=2)
    sizes, _ = check(spark, table, table.plan(0.6), "limit_offset")
    assert sorted(sizes.values()) == [20, 60, 60, 60]
