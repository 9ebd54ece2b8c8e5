"""The recovery job: rerun failed chunks from their stored query, republish, close the load."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from haulage.operators import recovery
from haulage.operators.tracking import LOAD_FAILED, LOAD_SUCCESS, PASS
from haulage.plans.extract import (
    Job,
    Load,
    copies,
    extract_table,
    publish,
    record_errors,
    record_load,
    tracker_row,
    validate,
)
from haulage.plans.waves import Outcome, first_line, run_masked, run_raw, split
from haulage.sources.config import recoverable
from haulage.sources.jdbc import Chunk, JdbcTable, chunk_scan
from haulage.sources.trackers import now


def stored_chunks(job: Job, load: Load, run: int, rows: Sequence[Row]) -> list[Chunk]:
    """Chunks as the trackers say: their stored ranges, each read by a task of its own, or else their stored query."""
    numbers = [r["iteration"] for r in rows]
    found: dict[int, list[Row]] = {}
    # ranges of the chunks that failed, not data; a chunk has as many as tasks read it
    for part in job.trackers.parts(load.log_id, run).filter(F.col("iteration").isin(numbers)).collect():
        found.setdefault(part["iteration"], []).append(part)
    chunks = []
    for row in sorted(rows, key=lambda r: r["iteration"]):
        parts = sorted(found.get(row["iteration"], []), key=lambda p: p["part"])
        ranges = tuple(p["predicate"] for p in parts)
        whole = " OR ".join(f"({p})" for p in ranges) or None
        chunks.append(Chunk(row["iteration"], row["query"], whole, ranges, parts[0]["source"] if parts else None))
    return chunks


def rerun(spark: SparkSession, job: Job, load: Load, rows: list[Row], run: int) -> None:
    """Rerun what each chunk needs, wave by wave, into the files of the run that failed."""
    table = JdbcTable(spark, load.connection, load.spec)
    raw, masked = copies(spark, job, load, table, run)
    todo = {r["iteration"]: r for r in rows}
    chunks = stored_chunks(job, load, run, rows)
    read = lambda some: chunk_scan(spark, load.connection, table.name, some)
    for wave in split(chunks, job.wave_chunks, job.wave_tasks):
        started = now()
        outcomes = {
            c.iteration: Outcome(
                read_status=todo[c.iteration]["read_status"],
                write_status=todo[c.iteration]["write_status"],
                mask_read_status=todo[c.iteration]["mask_read_status"],
                mask_write_status=todo[c.iteration]["mask_write_status"],
            )
            for c in wave
        }
        lost = [c for c in wave if todo[c.iteration]["rerun_raw"]]
        if lost:
            for number, again in run_raw(lost, read, raw).items():
                outcomes[number].read_status = again.read_status
                outcomes[number].write_status = again.write_status
                outcomes[number].message = again.message
        hidden = [
            c for c in wave if todo[c.iteration]["rerun_masked"] and outcomes[c.iteration].write_status == PASS
        ]
        if hidden and masked is not None:
            again_masked = run_masked(
                hidden, raw, masked, lambda df: job.mask.apply(df, load.masked_columns)
            )
            for number, again in again_masked.items():
                outcomes[number].mask_read_status = again.mask_read_status
                outcomes[number].mask_write_status = again.mask_write_status
        job.trackers.append_chunks(
            [
                tracker_row(
                    job,
                    load,
                    c,
                    outcomes[c.iteration],
                    todo[c.iteration]["extraction_approach"],
                    todo[c.iteration]["chunk_size"],
                    started,
                )
                for c in wave
            ]
        )
        record_errors(job, load, outcomes)


def complete(spark: SparkSession, job: Job, load: Load, rows: list[Row], tracked: bool) -> None:
    """Bring one load to its end: rerun what is open, validate the whole table, publish, close."""
    started = now()
    if not tracked:  # it broke off before its chunks were planned
        extract_table(spark, job, load)
        return
    run = job.trackers.last_run(load.log_id)
    if rows:
        rerun(spark, job, load, rows, run)
    table = JdbcTable(spark, load.connection, load.spec)
    raw, masked = copies(spark, job, load, table, run)
    state = recovery.close_loads(job.trackers.chunks_now().filter(F.col("log_id") == load.log_id)).first()
    for copy in (raw, masked):
        if copy is not None:
            copy.keep_first(job.trackers.planned(load.log_id))
    status = validate(table, load, raw, masked) if state["load_status"] == LOAD_SUCCESS else LOAD_FAILED
    publish(job, load, raw, masked, status, run)
    record_load(job, load, started, status, None)


def recover(spark: SparkSession, job: Job, load_of: Callable[[int], Load | None]) -> list[int]:
    """Bring every load that failed or broke off to its end; returns the loads that were worked on.

    ``load_of`` gives table, connection and masked columns of a load by its log_id; a load it does not know stays
    as it is. A load that raises is recorded as failed and the others go on. Do not run it beside an extraction of the
    same loads: a load that is still running looks like one that broke off.
    """
    if not recoverable(job.target):
        raise ValueError("recovery needs a lake target with account, container, key, format and a folder")
    logs = recovery.failed_logs(job.trackers.master_now())
    # states of earlier runs of a load count for nothing: they belong to other plans and other files
    history = job.trackers.run_chunks()
    tracked = {r["log_id"] for r in history.join(logs, "log_id", "left_semi").select("log_id").distinct().collect()}
    # tracker rows of open chunks, not data; read once for all loads
    rows: dict[int, list[Row]] = {}
    for row in recovery.recovery_plan(recovery.failed_chunks(history, logs)).collect():
        rows.setdefault(row["log_id"], []).append(row)
    done = []
    for log_id in sorted(r["log_id"] for r in logs.collect()):
        load = load_of(log_id)
        if load is None:
            continue
        done.append(log_id)
        started = now()
        try:
            complete(spark, job, load, rows.get(log_id, []), log_id in tracked)
        except Exception as error:
            record_load(job, load, started, LOAD_FAILED, first_line(error))
    return done
