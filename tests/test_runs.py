"""Runs of a load: snapshots that readers see, parallel reruns, and states that stay with their run."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from haulage.plans import extract
from haulage.plans.extract import Job, Load, extract_table
from haulage.plans.recover import recover, stored_chunks
from haulage.sources import lake
from haulage.sources.config import Target
from haulage.sources.jdbc import Chunk, JdbcTable, chunk_scan
from haulage.sources.trackers import Trackers, now
from tests import standin
from tests.conftest import SF_DIR


@pytest.fixture
def asked(spark, monkeypatch):
    spark.read.parquet(f"{SF_DIR}/orders.parquet").createOrReplaceTempView("s_orders")
    spark.read.parquet(f"{SF_DIR}/part.parquet").withColumn(
        "p_type", F.when(F.col("p_partkey") % 9 != 0, F.col("p_type"))
    ).createOrReplaceTempView("s_part")
    return standin.install(monkeypatch)


@pytest.fixture
def job(spark, tmp_path):
    home, zone = str(tmp_path), tmp_path.name.replace("-", "_")
    target = Target("blob", "parquet", f"{home}/raw", f"{home}/masked", "acc", "box", "key", f"raw_{zone}", f"masked_{zone}")
    return Job(target, Trackers(spark, f"{home}/trackers"), 9, 0.4, wave_chunks=1, salt="s")


@pytest.fixture
def load(monkeypatch):
    standin.catalog(monkeypatch, keys=["o_orderkey"], size=1.5)
    monkeypatch.setattr(JdbcTable.__init__, "__defaults__", (100,))  # rows per task
    return Load(1, standin.spec("s_orders"), standin.SOURCE, ("o_orderstatus",))


def whole(spark):
    return spark.table("s_orders")


def same_rows(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


class Killed(BaseException):
    """The job's process ends."""


def after(count, real):
    """The real function for some calls, then the end of the process."""
    calls = []

    def run(*args):
        if len(calls) == count:
            raise Killed
        calls.append(1)
        return real(*args)

    return run


def test_readers_see_the_old_run_until_the_new_one_is_whole(spark, asked, job, load, monkeypatch):
    zone, hidden = f"{job.target.raw_zone}.s_orders", f"{job.target.masked_zone}.s_orders_masked"
    assert extract_table(spark, job, load) == "Success"
    assert same_rows(spark.table(zone).drop("iteration"), whole(spark))
    first, masks = spark.table(zone).collect(), spark.table(hidden).collect()
    # The source changes; a new run writes wave after wave, with chunks of another size.
    whole(spark).filter("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(1.0)).createOrReplaceTempView("s_orders")
    real, seen = extract.run_wave, []

    def watched(*args):
        found = real(*args)
        seen.append((sorted(spark.table(zone).collect()) == sorted(first), len(spark.table(hidden).collect()) == len(masks)))
        return found

    monkeypatch.setattr(extract, "run_wave", watched)
    assert extract_table(spark, replace(job, cluster_threshold_mb=0.7), load) == "Success"
    assert len(seen) >= 2 and all(raw and masked for raw, masked in seen)
    assert same_rows(spark.table(zone).drop("iteration"), whole(spark))
    assert spark.table(hidden).count() == whole(spark).count()
    # A reader that began on the old run still finds its files; one more run removes them.
    old = lake.run_folder(job.target.folder, "s_orders", 1)
    assert spark.read.parquet(old).count() == len(first)
    assert extract_table(spark, job, load) == "Success"
    assert job.trackers.last_run(1) == 3
    left = spark._jvm.java.io.File(lake.table_folder(job.target.folder, "s_orders")).list()
    assert sorted(left) == ["run=2", "run=3"]
    assert not spark.catalog.tableExists(f"{job.target.raw_zone}.s_orders__run_1")


def test_a_failed_run_leaves_readers_alone(spark, asked, job, load, monkeypatch):
    zone = f"{job.target.raw_zone}.s_orders"
    assert extract_table(spark, job, load) == "Success"
    first = sorted(spark.table(zone).collect())
    monkeypatch.setattr(extract, "run_wave", after(2, extract.run_wave))
    with pytest.raises(Killed):
        extract_table(spark, job, load)
    assert sorted(spark.table(zone).collect()) == first
    assert recover(spark, job, {1: load}.get) == [1]
    assert same_rows(spark.table(zone).drop("iteration"), whole(spark))
    assert job.trackers.published_run(1, 3) == 2


def test_a_table_published_before_runs_becomes_a_view(spark, asked, job, load):
    zone, folder = job.target.raw_zone, lake.table_folder(job.target.folder, "s_orders")
    rows = whole(spark).limit(9).withColumn("iteration", F.lit(0))
    lake.write_chunks(rows, folder, "parquet")
    spark.sql(f"CREATE DATABASE {zone}")
    lake._register(spark, f"{zone}.s_orders", whole(spark).schema, folder, "parquet")
    assert spark.table(f"{zone}.s_orders").count() == 9
    assert extract_table(spark, job, load) == "Success"
    assert spark.table(f"{zone}.s_orders").count() == 1500
    assert spark.read.parquet(f"{folder}iteration=0").count() == 9  # kept until another run is published
    assert extract_table(spark, job, load) == "Success"
    assert sorted(spark._jvm.java.io.File(folder).list()) == ["run=1", "run=2"]


def fail(job, numbers, masked=()):
    rows = [r.asDict() for r in job.trackers.chunks_now().collect()]
    for row in rows:
        row["end_timestamp"] = now()
        row["write_status"] = "FAIL" if row["iteration"] in numbers else row["write_status"]
        row["mask_write_status"] = "FAIL" if row["iteration"] in (*numbers, *masked) else row["mask_write_status"]
    job.trackers.append_chunks(rows)
    job.trackers.append_master([{"log_id": 1, "load_status": "Failed", "start_timestamp": now(), "end_timestamp": now()}])


def test_a_rerun_reads_with_as_many_tasks_as_the_first_attempt(spark, asked, job, load):
    assert extract_table(spark, job, load) == "Success"
    plan = JdbcTable(spark, load.connection, load.spec).plan(job.cluster_threshold_mb)
    rows = job.trackers.chunks_now().collect()
    again = stored_chunks(job, load, 1, rows)
    assert [c.parts for c in again] == [c.parts for c in plan.chunks]
    assert [len(c.parts) for c in again] == [4, 4, 4, 3]
    scan = chunk_scan(spark, load.connection, "s_orders", again)
    assert scan.rdd.getNumPartitions() == 15
    assert scan.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] == 100
    assert same_rows(scan, chunk_scan(spark, load.connection, "s_orders", plan.chunks))
    # The job: two raw chunks and one masked one are lost and come back, by their parts.
    folder = lake.run_folder(job.target.folder, "s_orders", 1)
    lake.delete_chunks(spark, folder, "parquet", [0, 3])
    fail(job, (0, 3), masked=(1,))
    asked.clear()
    assert recover(spark, job, {1: load}.get) == [1]
    assert sum("o_orderkey" in q and "SELECT * FROM" in q and "WHERE" in q for q in asked) == 4 + 3
    assert same_rows(spark.table(f"{job.target.raw_zone}.s_orders").drop("iteration"), whole(spark))
    assert job.trackers.master_now().first()["load_status"] == "Success"


def test_states_of_an_earlier_run_close_nothing(spark, asked, job, load, monkeypatch):
    """The job ends between `Running` and its plan; an older run of the load was complete."""
    assert extract_table(spark, job, load) == "Success"
    whole(spark).withColumn("o_totalprice", F.col("o_totalprice") + 1).createOrReplaceTempView("s_orders")
    monkeypatch.setattr(extract, "record_plan", after(0, extract.record_plan))
    with pytest.raises(Killed):
        extract_table(spark, job, load)
    monkeypatch.undo()
    standin.install(monkeypatch)
    standin.catalog(monkeypatch, keys=["o_orderkey"], size=1.5)
    assert job.trackers.master_now().first()["load_status"] == "Running"
    assert job.trackers.run_chunks().count() == 0 and job.trackers.chunk_history().count() > 0
    assert recover(spark, job, {1: load}.get) == [1]
    assert job.trackers.last_run(1) == 3
    assert same_rows(spark.table(f"{job.target.raw_zone}.s_orders").drop("iteration"), whole(spark))
    assert job.trackers.master_now().first()["load_status"] == "Success"
    assert recover(spark, job, {1: load}.get) == []


def test_tracker_rows_from_before_runs_count_as_a_run(spark, tmp_path):
    trackers = Trackers(spark, str(tmp_path))
    row = {"log_id": 4, "iteration": 0, "write_status": "FAIL", "end_timestamp": now()}
    trackers._append([row], trackers.chunk_history().schema, trackers.chunk_folder)
    assert trackers.last_run(4) == 0 and trackers.chunks_now().first()["write_status"] == "FAIL"
    trackers.append_chunks([{**row, "write_status": "PASS", "end_timestamp": now()}])
    assert trackers.chunks_now().first()["write_status"] == "PASS"
    assert trackers.start_run(4) == 1 and trackers.start_run(5) == 1 and trackers.start_run(4) == 2
    assert trackers.chunks_now().count() == 0 and trackers.chunk_history().count() == 2
    assert trackers.published_run(4, 2) is None
    trackers.record_published(4, 1)
    assert trackers.published_run(4, 2) == 1 and trackers.published_run(4, 1) is None


def test_a_wave_mixes_ranges_of_several_sources_and_queries(spark, asked):
    spark.range(40).createOrReplaceTempView("s_a")
    spark.range(100, 120).createOrReplaceTempView("s_b")
    chunks = [
        Chunk(0, "", "id < 20", ("id < 5", "id >= 5 AND id < 20")),
        Chunk(1, "SELECT * FROM s_a WHERE id >= 30"),
        Chunk(2, "", "id < 110", ("id < 103", "id >= 103 AND id < 110"), "s_b"),
        Chunk(3, "", "id >= 20 AND id < 30"),
        Chunk(4, "", "id >= 110", (), "s_b"),
    ]
    scan = chunk_scan(spark, standin.SOURCE, "s_a", chunks)
    assert scan.rdd.getNumPartitions() == 7
    got = {r["iteration"]: (r["lo"], r["n"]) for r in scan.groupBy("iteration").agg(F.min("id").alias("lo"), F.count("*").alias("n")).collect()}
    assert got == {0: (0, 20), 1: (30, 10), 2: (100, 10), 3: (20, 10), 4: (110, 10)}
