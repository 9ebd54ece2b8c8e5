"""Histories stay small: appends are put together, and readers see every row once throughout."""

import os
from datetime import datetime, timedelta

from haulage.sources import history
from haulage.sources.trackers import Trackers

START = datetime(2024, 1, 1)


def row(iteration, minute, status="PASS", log_id=1):
    at = START + timedelta(minutes=minute)
    return {"log_id": log_id, "iteration": iteration, "write_status": status, "start_timestamp": at, "end_timestamp": at}


def files(folder):
    return sum(name.endswith(".parquet") for _, _, names in os.walk(folder) for name in names)


def test_file_count_is_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(Trackers.compact, "__defaults__", (4,))
    trackers, most = Trackers(spark, str(tmp_path)), 0
    run, states = 0, {}
    for step in range(18):
        if step % 9 == 0:
            run, states = trackers.start_run(1), {}
        states[step % 3] = "FAIL" if step % 5 == 0 else "PASS"
        trackers.append_chunks([row(step % 3, step, states[step % 3])])
        most = max(most, files(trackers.chunk_folder))
        assert trackers.chunk_history().count() == step + 1
        assert {r["iteration"]: r["write_status"] for r in trackers.chunks_now().collect()} == states
    # a tail of four at most, the four that the last generation holds, and a file per run of two generations
    assert most <= 4 + 4 + 2 * 2
    assert trackers.last_run(1) == 2 and trackers.run_chunks().count() == 9


def test_readers_of_the_old_state_find_their_files(spark, tmp_path):
    trackers = Trackers(spark, str(tmp_path))
    trackers.append_master([{"log_id": 1, "load_status": "Running", "end_timestamp": START}])
    trackers.append_master([{"log_id": 1, "load_status": "Failed", "end_timestamp": START + timedelta(1)}])
    before = trackers.master_history()
    schema = before.schema
    assert trackers.compact(trackers.master_folder, schema, 2) and not trackers.compact(trackers.master_folder, schema, 1)
    assert before.count() == 2 and trackers.master_history().count() == 2
    trackers.append_master([{"log_id": 1, "load_status": "Success", "end_timestamp": START + timedelta(2)}])
    assert trackers.master_history().count() == 3 and before.count() == 2
    assert trackers.master_now().first()["load_status"] == "Success"
    assert trackers.compact(trackers.master_folder, schema, 1)
    assert trackers.master_history().count() == 3
    assert len(history.generations(spark, trackers.master_folder)) == 2


def test_a_broken_compaction_changes_nothing(spark, tmp_path, monkeypatch):
    trackers = Trackers(spark, str(tmp_path))
    for minute in range(3):
        trackers.append_chunks([row(0, minute)])
    schema = trackers.chunk_history().schema

    def dies(paths):
        raise KeyboardInterrupt

    try:
        history.compact(spark, trackers.chunk_folder, dies)
    except KeyboardInterrupt:
        pass
    os.makedirs(f"{trackers.chunk_folder}/generation=1-dead/run=0")  # written, never committed
    os.makedirs(f"{trackers.chunk_folder}/run=0/unfinished")  # an append without its mark of success
    assert trackers.chunk_history().count() == 3
    assert trackers.compact(trackers.chunk_folder, schema, 1) and trackers.chunk_history().count() == 3
    # another job commits the same generation first
    trackers.append_chunks([row(0, 9)])
    real = history.generations
    monkeypatch.setattr(history, "generations", lambda s, f: [])
    assert not history.compact(spark, trackers.chunk_folder, lambda paths: spark.range(1).selectExpr("0 AS run", "id"))
    monkeypatch.setattr(history, "generations", real)
    assert trackers.chunk_history().count() == 4
