"""The extraction job: profile, plan, copy in waves, validate, publish, record."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.operators import masking, validation
from haulage.operators.tracking import FAIL, LOAD_FAILED, LOAD_RUNNING, PENDING, REMOVED
from haulage.operators.validation import FAILED, PARTIAL, SUCCESS, Sides
from haulage.plans.copies import Copy, LakeCopy, RdbmsCopy
from haulage.plans.waves import Outcome, first_line, run_wave, split
from haulage.sources.config import Target
from haulage.sources.jdbc import Chunk, ChunkPlan, Connection, JdbcTable, TableSpec, chunk_scan
from haulage.sources.trackers import Trackers, now


@dataclass(frozen=True)
class Job:
    """Everything one run shares between its tables."""

    target: Target
    trackers: Trackers
    source_id: int
    cluster_threshold_mb: float
    wave_chunks: int = 64
    tables_at_once: int = 1
    salt: str = field(default="", repr=False)
    target_connection: Connection | None = field(default=None, repr=False)
    target_schema: str | None = None
    wave_tasks: int = 4_096
    mask_kind: str = "hash"
    mask_key: str = field(default="", repr=False)

    @property
    def mask(self) -> masking.Mask:
        """By salted hash, or reversible by key."""
        return masking.Mask(self.mask_kind, self.salt if self.mask_kind == "hash" else self.mask_key)

    @property
    def database(self) -> tuple[Connection | None, str | None]:
        """Connection and schema of a database target, given to the job or described by the target."""
        return self.target_connection or self.target.database, self.target_schema or self.target.schema_name


@dataclass(frozen=True)
class Load:
    """One table of the run."""

    log_id: int
    spec: TableSpec
    connection: Connection
    masked_columns: tuple[str, ...] = ()


def copies(spark: SparkSession, job: Job, load: Load, table: JdbcTable, run: int) -> tuple[Copy, Copy | None]:
    """Raw and masked copy of a run; a masked column is text, whatever it was before."""
    if load.masked_columns:
        job.mask.check()
    schema = table.frame().schema
    hidden = job.mask.apply(table.frame(), load.masked_columns).schema
    name = load.spec.table

    def copy(shape, masked: bool) -> Copy:
        if job.target.kind == "rdbms":
            connection, schema_name = job.database
            if connection is None:
                raise ValueError("the target names no database")
            return RdbmsCopy(spark, connection, name, shape, schema_name, masked)
        return LakeCopy(spark, job.target, name, shape, masked, run)

    return copy(schema, False), copy(hidden, True) if load.masked_columns else None


def tracker_row(
    job: Job, load: Load, chunk: Chunk, outcome: Outcome, strategy: str, chunk_rows: int | None, started
) -> dict:
    return {
        "log_id": load.log_id,
        "source_id": job.source_id,
        "query": chunk.query,
        "schema_name": load.spec.schema,
        "database_name": load.spec.database,
        "rdbms_type": load.connection.vendor,
        "table_name": load.spec.table,
        "source_name": load.spec.source_name,
        "write_detail": job.target.kind,
        "write_sub_detail": job.target.folder if job.target.kind == "blob" else job.database[1],
        "chunk_size": chunk_rows,
        "extraction_approach": strategy,
        "start_timestamp": started,
        "end_timestamp": now(),
        "read_status": outcome.read_status,
        "mask_read_status": outcome.mask_read_status,
        "write_status": outcome.write_status,
        "mask_write_status": outcome.mask_write_status,
        "iteration": chunk.iteration,
    }


def copy_chunks(
    spark: SparkSession, job: Job, load: Load, table: JdbcTable, plan: ChunkPlan, raw: Copy, masked: Copy | None
) -> bool:
    """Run all waves; True if every chunk and its masked copy passed."""
    good = True
    for wave in split(plan.chunks, job.wave_chunks, job.wave_tasks):
        started = now()
        outcomes = run_wave(
            wave,
            lambda some: chunk_scan(spark, load.connection, table.name, some),
            raw,
            masked,
            lambda df: job.mask.apply(df, load.masked_columns),
        )
        job.trackers.append_chunks(
            [
                tracker_row(job, load, c, outcomes[c.iteration], plan.strategy, plan.chunk_rows, started)
                for c in wave
            ]
        )
        record_errors(job, load, outcomes)
        good = good and all(FAIL not in (o.write_status, o.mask_write_status) for o in outcomes.values())
    return good


def record_errors(job: Job, load: Load, outcomes: dict[int, Outcome]) -> None:
    failed = [
        {"log_id": load.log_id, "iteration": number, "at": now(), "message": outcome.message}
        for number, outcome in outcomes.items()
        if outcome.message is not None
    ]
    job.trackers.append_errors(failed)


def record_plan(job: Job, load: Load, plan: ChunkPlan, masked: Copy | None, run: int) -> None:
    """Before the first wave: every planned chunk, so that a job that breaks off can be completed from the trackers.

    The ranges of chunks that several tasks read go first: a chunk that is known has its parts. Chunks of an earlier plan with
    more of them are recorded as removed.
    """
    job.trackers.append_parts(
        [
            {"log_id": load.log_id, "run": run, "iteration": c.iteration, "part": i, "source": c.source, "predicate": part}
            for c in plan.chunks
            if c.predicate is not None
            for i, part in enumerate(c.parts or (c.predicate,))
        ]
    )
    started = now()
    planned = Outcome(write_status=PENDING, mask_write_status=PENDING if masked is not None else None)
    rows = [tracker_row(job, load, c, planned, plan.strategy, plan.chunk_rows, started) for c in plan.chunks]
    known = job.trackers.chunk_history().filter(F.col("log_id") == load.log_id).agg(F.max("iteration")).first()[0]
    gone = Outcome(write_status=REMOVED)
    surplus = range(len(plan.chunks), (-1 if known is None else known) + 1)
    rows += [tracker_row(job, load, Chunk(n, ""), gone, plan.strategy, plan.chunk_rows, started) for n in surplus]
    job.trackers.append_chunks(rows)


def validate(table: JdbcTable, load: Load, raw: Copy, masked: Copy | None) -> str:
    source = table.frame()
    side = Sides(
        load.spec.table_key,
        source,
        raw.read().drop("iteration"),
        None if masked is None else masked.read().drop("iteration"),
        list(load.masked_columns),
        table.statistics(source.columns),
        raw.statistics(source.columns),
        None if masked is None else masked.statistics(source.columns),
    )
    return validation.validation_status([side]).first()["status"]


def publish(job: Job, load: Load, raw: Copy, masked: Copy | None, status: str, run: int) -> list[str]:
    """Readers see the run from here on; what they saw before is kept until the next publication."""
    if status not in (SUCCESS, PARTIAL):
        return []
    before = job.trackers.published_run(load.log_id, run)
    names = [copy.publish(before) for copy in (raw, masked) if copy is not None]
    job.trackers.record_published(load.log_id, run)
    return names


def extract_table(spark: SparkSession, job: Job, load: Load) -> str:
    """Copy one table; returns its validation status and records it in the master tracker.

    The run is started before the load is marked as running: whatever breaks off after that belongs to this run, and states of
    earlier runs say nothing about it.
    """
    started = now()
    table = JdbcTable(spark, load.connection, load.spec)
    run = job.trackers.start_run(load.log_id)
    raw, masked = copies(spark, job, load, table, run)
    record_load(job, load, started, LOAD_RUNNING, None)
    plan = table.plan(job.cluster_threshold_mb)
    record_plan(job, load, plan, masked, run)
    complete = True
    if plan.table_count < 1:
        for copy in (raw, masked):
            if copy is not None:
                copy.write_empty()
                copy.keep_first(0)
        status = SUCCESS
    else:
        complete = copy_chunks(spark, job, load, table, plan, raw, masked)
        for copy in (raw, masked):
            if copy is not None:
                copy.keep_first(len(plan.chunks))
        status = validate(table, load, raw, masked) if complete else FAILED
    publish(job, load, raw, masked, status, run)
    record_load(job, load, started, status if complete else LOAD_FAILED, None)
    return status


def record_load(job: Job, load: Load, started, status: str, message: str | None) -> None:
    row = {
        "log_id": load.log_id,
        "table_key": load.spec.table_key,
        "load_status": status,
        "start_timestamp": started,
        "end_timestamp": now(),
        "message": message,
    }
    job.trackers.append_master([row])


def extract_all(spark: SparkSession, job: Job, loads: Sequence[Load]) -> DataFrame:
    """All tables; one that raises is recorded under its full key and the others go on.

    Returns the run summary (outcome, table_key, message).
    """

    def one(load: Load) -> tuple[str, str | None, str | None]:
        started = now()
        try:
            return load.spec.table_key, extract_table(spark, job, load), None
        except Exception as error:
            message = first_line(error)
            record_load(job, load, started, LOAD_FAILED, message)
            return load.spec.table_key, None, message

    with ThreadPoolExecutor(job.tables_at_once) as pool:
        rows = list(pool.map(one, loads))
    done = spark.createDataFrame(rows, "table_key string, status string, error string")
    summary = validation.run_summary(done)
    return summary.join(done.select("table_key", F.col("error").alias("message")), "table_key")
