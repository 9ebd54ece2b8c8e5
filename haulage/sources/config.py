"""Configuration rows: where to write, and how sources are reached."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from haulage.sources import vendors
from haulage.sources.jdbc import Connection

# Columns of the target file, all text.
TARGET_COLUMNS = (
    "target_kind",
    "write_format",
    "account_name",
    "container_name",
    "access_key",
    "folder_structure",
    "masked_folder_structure",
)
# Its columns for a database, after the others.
DATABASE_COLUMNS = ("rdbms_type", "database_name", "db_url", "db_driver", "db_user", "db_password", "schema_name")
TARGET_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in TARGET_COLUMNS])


@dataclass(frozen=True)
class Target:
    """Where a run writes to. ``kind`` is blob or rdbms, in lower case."""

    kind: str
    write_format: str | None
    folder: str | None
    masked_folder: str | None = None
    account_name: str | None = None
    container_name: str | None = None
    access_key: str | None = field(default=None, repr=False)
    raw_zone: str = "raw"
    masked_zone: str = "masked"
    database: Connection | None = field(default=None, repr=False)
    schema_name: str | None = None

    def __post_init__(self) -> None:
        object.__setattr__(self, "kind", self.kind.lower())


def read_target(spark: SparkSession, path: str, **zones: str) -> Target:
    """First row of a CSV with header; columns are found by name, whatever their order."""
    columns = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    row = spark.read.option("header", True).schema(schema).csv(path).first()
    if row is None:
        raise ValueError(f"no target in {path}")
    found = row.asDict()
    values = {c: found.get(c) for c in (*TARGET_COLUMNS, *DATABASE_COLUMNS)}
    database = None
    if (values["target_kind"] or "").lower() == "rdbms":
        database = _database(values)
    return Target(
        kind=values["target_kind"] or "",
        write_format=values["write_format"],
        folder=values["folder_structure"],
        masked_folder=values["masked_folder_structure"],
        account_name=values["account_name"],
        container_name=values["container_name"],
        access_key=values["access_key"],
        database=database,
        schema_name=values["schema_name"],
        **zones,
    )


def _database(values: dict[str, str | None]) -> Connection:
    missing = [c for c in ("rdbms_type", "database_name", "db_url", "db_driver") if not values[c]]
    if missing:
        raise ValueError(f"a database target needs {', '.join(missing)}")
    vendor = values["rdbms_type"].lower()
    url = vendors.connection_url(vendor, values["db_url"], values["database_name"])
    return Connection(vendor, url, values["db_driver"], values["db_user"], values["db_password"])


def recoverable(target: Target) -> bool:
    """Recovery needs a complete lake target; a database target is not rerun by chunk folder."""
    named = (target.account_name, target.container_name, target.access_key, target.write_format)
    has_folder = target.folder is not None or target.masked_folder is not None
    return target.kind == "blob" and has_folder and all(v is not None for v in named)


def connection_rows(spark: SparkSession, path: str) -> DataFrame:
    """Connection settings per source, without the database name (the work list gives it)."""
    return spark.read.json(path).drop("db_name")
