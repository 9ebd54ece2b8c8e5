"""Sources, strategies and both jobs against an in-process database."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulage.operators import recovery
from haulage.plans.copies import RdbmsCopy
from haulage.plans.extract import Job, Load, extract_all, extract_table
from haulage.plans.recover import recover
from haulage.plans.waves import split
from haulage.sources import lake, vendors
from haulage.sources.config import Target, connection_rows, read_target, recoverable
from haulage.sources.jdbc import Chunk, JdbcTable, chunk_scan, query_frame
from haulage.sources.rdbms import RdbmsTarget
from haulage.sources.trackers import Trackers, read_chunk_export
from tests import derby


@pytest.fixture(scope="module")
def source(spark):
    conn = derby.connection()
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
    derby.fill(read("orders"), conn, "ORDERS", "o_orderstatus VARCHAR(8), o_orderpriority VARCHAR(20)")
    derby.run(
        spark,
        conn,
        'ALTER TABLE ORDERS ALTER COLUMN "o_orderkey" NOT NULL',
        'ALTER TABLE ORDERS ADD PRIMARY KEY ("o_orderkey")',
    )
    lines = read("lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    derby.fill(lines, conn, "LINEITEM", "l_returnflag VARCHAR(4)")
    derby.fill(read("part"), conn, "PART", "p_name VARCHAR(60), p_brand VARCHAR(20), p_type VARCHAR(20)")
    derby.run(spark, conn, 'UPDATE PART SET "p_type" = NULL WHERE MOD("p_partkey", 9) = 0')
    derby.fill(read("orders").where("false").select("o_orderkey", "o_totalprice"), conn, "NOTHING")
    return conn


def table_of(spark, conn, monkeypatch, name, **facts):
    monkeypatch.setitem(vendors.CATALOG, "derby", derby.catalog(**facts))
    return JdbcTable(spark, conn, derby.spec(name))


def check_chunks(spark, table, plan, strategy):
    assert plan.strategy == strategy
    rows = chunk_scan(spark, table.connection, table.name, plan.chunks)
    whole = table.frame()
    assert rows.drop("iteration").exceptAll(whole).count() == 0
    assert whole.exceptAll(rows.drop("iteration")).count() == 0
    sizes = {r["iteration"]: r["count"] for r in rows.groupBy("iteration").count().collect()}
    assert max(sizes.values()) <= plan.chunk_rows
    # the stored query of a chunk reads exactly the rows of its place in the scan
    for chunk in plan.chunks[:3]:
        alone = query_frame(spark, table.connection, chunk.query)
        assert alone.exceptAll(rows.filter(F.col("iteration") == chunk.iteration).drop("iteration")).count() == 0
    return sizes


def test_query_scan_and_count(spark, source):
    assert query_frame(spark, source, 'SELECT COUNT(*) AS N FROM "ORDERS"').first()["N"] == 1500


def test_profile_defaults_to_a_tenth_of_a_megabyte(spark, source, monkeypatch):
    count, size, average = table_of(spark, source, monkeypatch, "ORDERS").profile()
    assert (count, size) == (1500, 0.1) and average == 0.1 / 1500
    count, size, average = table_of(spark, source, monkeypatch, "ORDERS", size=0).profile()
    assert (size, average) == (0.0, 0.00000001)


def test_clustered(spark, source, monkeypatch):
    table = table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    sizes = check_chunks(spark, table, table.plan(0.4), "clustered")
    assert sizes == {0: 400, 1: 400, 2: 400, 3: 300}


def test_a_chunk_is_read_by_several_tasks(spark, source, monkeypatch):
    monkeypatch.setitem(vendors.CATALOG, "derby", derby.catalog(keys=["o_orderkey"], size=1.5))
    table = JdbcTable(spark, source, derby.spec("ORDERS"), task_rows=100)
    plan = table.plan(0.4)
    assert [len(c.parts) for c in plan.chunks] == [4, 4, 4, 3]
    assert check_chunks(spark, table, plan, "clustered") == {0: 400, 1: 400, 2: 400, 3: 300}
    scan = chunk_scan(spark, source, table.name, plan.chunks)
    assert scan.rdd.getNumPartitions() == 15
    assert scan.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] == 100


def test_waves_are_bounded_by_queries_too():
    chunks = [Chunk(i, "q", "p", ("x",) * 5) for i in range(7)]
    assert [len(w) for w in split(chunks, 3, 100)] == [3, 3, 1]
    assert [len(w) for w in split(chunks, 3, 10)] == [2, 2, 2, 1]
    assert [len(w) for w in split(chunks, 3, 1)] == [1] * 7


def test_composite(spark, source, monkeypatch):
    key = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice"]
    table = table_of(spark, source, monkeypatch, "LINEITEM", keys=key, size=6)
    sizes = check_chunks(spark, table, table.plan(1.7), "composite_clustered")
    assert sizes == {0: 1700, 1: 1700, 2: 1700, 3: 900}


def test_index_with_nulls(spark, source, monkeypatch):
    table = table_of(spark, source, monkeypatch, "PART", indexes=["p_type"], size=2)
    sizes = check_chunks(spark, table, table.plan(0.7), "non_clustered")
    assert sizes[0] == 23


def test_index_pages(spark, source, monkeypatch):
    table = table_of(spark, source, monkeypatch, "PART", indexes=["p_type"], size=2)
    sizes = check_chunks(spark, table, table.plan(0.15), "non_clustered_limit_offset")
    assert sorted(sizes.values()) == [5] + [15] * 13


def test_limit_offset(spark, source, monkeypatch):
    table = table_of(spark, source, monkeypatch, "PART", size=2)
    sizes = check_chunks(spark, table, table.plan(0.6), "limit_offset")
    assert sorted(sizes.values()) == [20, 60, 60, 60]


def test_partitions(spark, source, monkeypatch):
    names = "SELECT DISTINCT \"p_brand\" AS partition_name FROM PART WHERE {table} = 'PART'"
    monkeypatch.setattr(
        "haulage.sources.vendors.partition_source",
        lambda vendor, table, schema, p: f"\"APP\".\"{table}\" WHERE \"p_brand\" = '{p}'",
    )
    table = table_of(spark, source, monkeypatch, "PART", partitions=names, size=2)
    check_chunks(spark, table, table.plan(0.09), "partition")


@pytest.fixture
def lake_job(spark, tmp_path):
    home = str(tmp_path)
    zones = (f"raw_{tmp_path.name}".replace("-", "_"), f"masked_{tmp_path.name}".replace("-", "_"))
    target = Target("blob", "parquet", f"{home}/raw", f"{home}/masked", "acc", "box", "key", *zones)
    return Job(target, Trackers(spark, f"{home}/trackers"), 9, 0.4, wave_chunks=3, salt="s")


def orders_load(source, masked=("o_orderstatus", "o_custkey")):
    return Load(1, derby.spec("ORDERS"), source, tuple(masked))


def test_extract_and_recover(spark, source, monkeypatch, lake_job, tmp_path):
    table = table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    load = orders_load(source)
    assert extract_table(spark, lake_job, load) == "Success"
    target = lake_job.target
    raw = spark.table(f"{target.raw_zone}.ORDERS").drop("iteration")
    assert raw.exceptAll(table.frame()).count() == 0 and raw.count() == 1500
    masked = spark.table(f"{target.masked_zone}.ORDERS_masked")
    assert masked.count() == 1500
    assert masked.filter("length(o_custkey) = 64 AND length(o_orderstatus) = 64").count() == 1500
    history = lake_job.trackers.chunk_history()
    assert history.count() == 8 and history.filter("write_status = 'PASS' AND mask_write_status = 'PASS'").count() == 4
    assert history.filter("write_status = 'PENDING' AND mask_write_status = 'PENDING'").count() == 4
    history = lake_job.trackers.chunks_now()

    # break the load: two raw chunks and one masked chunk
    folder = lake.run_folder(target.folder, "ORDERS", 1)
    hidden = lake.run_folder(target.masked_folder, "ORDERS", 1)
    broken = [
        {**r.asDict(), "write_status": "FAIL" if r["iteration"] in (0, 2) else "PASS",
         "mask_write_status": "FAIL" if r["iteration"] == 2 else "PASS"}
        for r in history.collect()
    ]
    from haulage.sources.trackers import now

    for row in broken:
        row["end_timestamp"] = now()
    lake_job.trackers.append_chunks(broken)
    lake_job.trackers.append_master(
        [{"log_id": 1, "table_key": "derby.ORDERS", "load_status": "Failed", "start_timestamp": now(), "end_timestamp": now()}]
    )
    schema = table.frame().schema
    rubbish = lake.read_chunks(spark, folder, "parquet", schema, [0]).limit(7).collect()
    lake.write_chunks(spark.createDataFrame(rubbish, lake.read_chunks(spark, folder, "parquet", schema).schema), folder, "parquet")
    lake.delete_chunks(spark, folder, "parquet", [2])
    lake.delete_chunks(spark, hidden, "parquet", [2])
    assert lake.read_chunks(spark, folder, "parquet", schema).count() == 7 + 400 + 300

    assert recover(spark, lake_job, lambda log_id: load) == [1]
    again = lake.read_chunks(spark, folder, "parquet", schema).drop("iteration")
    assert again.exceptAll(table.frame()).count() == 0 and again.count() == 1500
    assert spark.table(f"{target.raw_zone}.ORDERS").count() == 1500
    assert spark.table(f"{target.masked_zone}.ORDERS_masked").count() == 1500
    assert lake_job.trackers.master_now().first()["load_status"] == "Success"
    # only the failed chunks were run again
    assert lake_job.trackers.chunk_history().count() == 4 + 4 + 4 + 2
    assert recover(spark, lake_job, lambda log_id: load) == []


def test_bad_chunk_is_isolated(spark, source, monkeypatch, lake_job):
    """One unreadable chunk fails alone, the load is marked failed, and recovery completes it."""
    from haulage.plans import extract

    table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    real = extract.chunk_scan

    def faulty(session, connection, name, chunks):
        df = real(session, connection, name, chunks)
        bad = F.raise_error(F.lit("disk on fire")).cast("int")
        return df.withColumn("iteration", F.when(F.col("iteration") == 1, bad).otherwise(F.col("iteration")))

    monkeypatch.setattr(extract, "chunk_scan", faulty)
    load = orders_load(source)
    assert extract_table(spark, lake_job, load) == "Failed"
    states = {r["iteration"]: (r["read_status"], r["write_status"], r["mask_write_status"]) for r in lake_job.trackers.chunks_now().collect()}
    assert states[1] == ("FAIL", "FAIL", "FAIL")
    assert all(states[i] == ("PASS", "PASS", "PASS") for i in (0, 2, 3))
    assert "disk on fire" in lake_job.trackers.errors().filter("iteration = 1").first()["message"]
    plan = recovery.recovery_plan(
        recovery.failed_chunks(lake_job.trackers.chunk_history(), recovery.failed_logs(lake_job.trackers.master_now()))
    )
    assert [(r["iteration"], r["rerun_raw"], r["rerun_masked"]) for r in plan.collect()] == [(1, True, True)]
    monkeypatch.setattr(extract, "chunk_scan", real)
    assert recover(spark, lake_job, lambda log_id: load) == [1]
    assert spark.table(f"{lake_job.target.raw_zone}.ORDERS").count() == 1500
    assert spark.table(f"{lake_job.target.masked_zone}.ORDERS_masked").count() == 1500


class Killed(BaseException):
    """The job's process ends."""


def test_recovery_completes_a_job_that_broke_off(spark, source, monkeypatch, lake_job):
    from haulage.plans import extract

    table = table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    load, real, waves = orders_load(source), extract.run_wave, []

    def one_wave(*args):
        if waves:
            raise Killed
        waves.append(1)
        return real(*args)

    monkeypatch.setattr(extract, "run_wave", one_wave)
    with pytest.raises(Killed):
        extract_table(spark, replace(lake_job, wave_chunks=1), load)
    assert lake_job.trackers.master_now().first()["load_status"] == "Running"
    states = {r["iteration"]: r["write_status"] for r in lake_job.trackers.chunks_now().collect()}
    assert states == {0: "PASS", 1: "PENDING", 2: "PENDING", 3: "PENDING"}
    monkeypatch.setattr(extract, "run_wave", real)
    assert recover(spark, lake_job, lambda log_id: None) == []
    assert recover(spark, lake_job, lambda log_id: load) == [1]
    raw = spark.table(f"{lake_job.target.raw_zone}.ORDERS").drop("iteration")
    assert raw.count() == 1500 and raw.exceptAll(table.frame()).count() == 0
    assert lake_job.trackers.master_now().first()["load_status"] == "Success"


def test_recovery_goes_on_after_a_load_that_raises(spark, source, monkeypatch, lake_job):
    from haulage.sources.trackers import now

    table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    good, bad = orders_load(source), Load(0, derby.spec("MISSING"), source)
    for number in (0, 1):
        lake_job.trackers.append_master([{"log_id": number, "load_status": "Failed", "start_timestamp": now(), "end_timestamp": now()}])
    assert recover(spark, lake_job, {0: bad, 1: good}.get) == [0, 1]
    states = {r["log_id"]: r["load_status"] for r in lake_job.trackers.master_now().collect()}
    assert states == {0: "Failed", 1: "Success"}


@pytest.mark.parametrize("kind", ["blob", "rdbms"])
def test_a_shorter_plan_leaves_no_old_chunks(spark, source, monkeypatch, lake_job, kind):
    table = table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    job = lake_job
    if kind == "rdbms":
        job = replace(job, target=Target("rdbms", None, None), target_connection=derby.connection(), target_schema="AGAIN")
        derby.run(spark, job.target_connection, 'CREATE SCHEMA "AGAIN"')
    load = orders_load(source, ["o_orderpriority"])
    for threshold, chunks in ((0.5, 3), (0.8, 2)):
        assert extract_table(spark, replace(job, cluster_threshold_mb=threshold), load) == "Success"
        states = [r["write_status"] for r in job.trackers.chunks_now().orderBy("iteration").collect()]
        assert states == ["PASS"] * chunks + ["REMOVED"] * (3 - chunks)
    if kind == "blob":
        landed = spark.table(f"{job.target.raw_zone}.ORDERS").drop("iteration")
    else:
        landed = query_frame(spark, job.target_connection, 'SELECT * FROM "AGAIN"."ORDERS"')
    assert landed.count() == 1500 and landed.exceptAll(table.frame()).count() == 0


def test_masks_need_a_salt(spark, source, monkeypatch, lake_job):
    table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    with pytest.raises(ValueError, match="salt"):
        extract_table(spark, replace(lake_job, salt=""), orders_load(source))


def test_emptied_chunk_leaves_nothing_behind(spark, source, lake_job):
    folder = lake.table_folder(lake_job.target.folder, "T")
    rows = spark.range(30).selectExpr("id", "cast(id div 10 as int) AS iteration")
    lake.write_chunks(rows, folder, "parquet")
    from haulage.plans.copies import LakeCopy
    from haulage.plans.waves import run_raw
    from haulage.sources.jdbc import Chunk

    schema = spark.range(1).schema
    copy = LakeCopy(spark, lake_job.target, "T", schema)
    chunks = [Chunk(0, "q"), Chunk(1, "q")]
    outcome = run_raw(chunks, lambda some: rows.filter("iteration = 0 AND id < 4"), copy)
    assert {n: o.write_status for n, o in outcome.items()} == {0: "PASS", 1: "PASS"}
    left = {r["iteration"]: r["count"] for r in copy.read().groupBy("iteration").count().collect()}
    assert left == {0: 4, 2: 10}


def test_run_isolates_tables_and_handles_empty_ones(spark, source, monkeypatch, lake_job):
    monkeypatch.setitem(vendors.CATALOG, "derby", derby.catalog(size=1.5))
    loads = [
        Load(1, derby.spec("NOTHING"), source),
        Load(2, derby.spec("MISSING"), source),
        Load(3, derby.spec("ORDERS"), source, ("no_such_column",)),
        Load(4, derby.spec("PART"), source),
    ]
    together = replace(lake_job, tables_at_once=3)
    found = {r["table_key"]: r["outcome"] for r in extract_all(spark, together, loads).collect()}
    assert found == {
        "derby.NOTHING": "Successful Validation",
        "derby.MISSING": "Unsuccessful Extraction",
        "derby.ORDERS": "Unsuccessful Extraction",
        "derby.PART": "Successful Validation",
    }
    assert spark.table(f"{lake_job.target.raw_zone}.NOTHING").count() == 0
    master = {r["log_id"]: r["load_status"] for r in lake_job.trackers.master_now().collect()}
    assert master == {1: "Success", 2: "Failed", 3: "Failed", 4: "Success"}


def test_database_target(spark, source, monkeypatch, lake_job):
    table = table_of(spark, source, monkeypatch, "ORDERS", keys=["o_orderkey"], size=1.5)
    there = derby.connection()
    job = Job(Target("rdbms", None, None), lake_job.trackers, 9, 0.4, 3, 1, "s", there, "APP")
    assert extract_table(spark, job, orders_load(source, ["o_orderpriority"])) == "Success"
    whole = table.frame()
    landed = query_frame(spark, there, 'SELECT * FROM "APP"."ORDERS"')
    assert landed.exceptAll(whole).count() == 0 and landed.count() == 1500
    masked = query_frame(spark, there, 'SELECT * FROM "APP"."ORDERS_masked"')
    assert masked.filter("length(o_orderpriority) = 64").count() == 1500
    # a chunk written twice stays single
    target = RdbmsTarget(spark, there, "ORDERS", "APP")
    again = target.staged([1]).cache()
    assert again.count() == 400
    target.write_chunks(again, [1])
    assert target.staged().count() == 1500
    # a chunk whose rows were inserted twice is noticed
    copy = RdbmsCopy(spark, there, "ORDERS", whole.schema, "APP")
    derby.run(spark, there, 'INSERT INTO "APP"."ORDERS_STAGE" SELECT * FROM "APP"."ORDERS_STAGE" WHERE "ITERATION" = 1')
    with pytest.raises(RuntimeError, match="chunks .1."):
        copy.settle({0: 400, 1: 400})


def test_config_and_exports(spark, tmp_path):
    path = str(tmp_path / "target.csv")
    with open(path, "w") as f:
        f.write("target_kind,account_name,container_name,access_key,folder_structure,masked_folder_structure,write_format\n")
        f.write("Blob,acc,box,secret,/raw,/masked,parquet\n")
    target = read_target(spark, path)
    assert (target.kind, target.folder, target.write_format) == ("blob", "/raw", "parquet")
    assert recoverable(target) and "secret" not in repr(target)
    assert not recoverable(Target("rdbms", "parquet", "/raw", None, "a", "b", "c"))
    assert not recoverable(Target("blob", "parquet", None, None, "a", "b", "c"))

    rows = str(tmp_path / "connections.json")
    with open(rows, "w") as f:
        f.write(json.dumps({"rdbms": "mysql", "jdbc_url": "u", "db_name": "x"}) + "\n")
    assert connection_rows(spark, rows).columns == ["jdbc_url", "rdbms"]

    export = str(tmp_path / "chunks.json")
    with open(export, "w") as f:
        f.write(json.dumps({"log_id": 3, "iteration": 0, "chunk_size": "4000", "end_timestamp": "2024-05-06 07:08:09"}) + "\n")
    row = read_chunk_export(spark, export).first()
    assert row["chunk_size"] == 4000 and str(row["end_timestamp"]) == "2024-05-06 07:08:09"
    assert read_chunk_export(spark, export).columns[0] == "log_id"
