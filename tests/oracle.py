"""Run registered queries and their SQL side by side and compare the rows."""

import math
import sys
import time

import duckdb

from haulage.plans.derived import TABLES

sys.path.insert(0, ".")


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, con, sf_dir, name, query, sql):
    """None if equal, else a description of the first difference."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    found = con.execute(sql)
    columns = [d[0] for d in found.description]
    want = rows_of(columns, found.fetchall())
    if sorted(df.columns) != sorted(columns):
        return f"{name}: columns {sorted(df.columns)} != {sorted(columns)}"
    if len(got) != len(want):
        return f"{name}: {len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{name}: {a} != {b}"
    return None


if __name__ == "__main__":
    import __spark_entry__ as entry
    from haulage.session import local_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = local_session(name="haulage-oracle")
    con = connect(sf)
    bad = 0
    for name, query in entry.queries().items():
        if only and name not in only:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, sf, name, query, entry.oracle_sql()[name])
        except Exception as error:  # keep going: one report for all queries
            problem = f"{name}: {type(error).__name__} {str(error)[:600]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - started:6.2f}s {problem or 'ok'}", flush=True)
    print("differences:", bad)
