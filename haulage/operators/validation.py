"""Does the landed copy equal its source? Counts, columns, minima and maxima, and the verdict.

Each side is read once per table: all counts, minima and maxima come from one aggregate, and a query
that needs only some of them prunes the others away.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import is_plain, quoted
from haulage.operators.masking import checked_numeric_columns

# Verdicts as they are stored.
SUCCESS = "Success"
PARTIAL = "Partial Success"
FAILED = "Failed"


@dataclass
class Sides:
    """One table: its source, what landed, and the masked copy if there is one."""

    table_key: str
    source: DataFrame
    landed: DataFrame
    masked: DataFrame | None = None
    masked_columns: Sequence[str] = field(default_factory=list)
    # statistics that a database computed itself, over the source's columns; that side is then not scanned
    source_statistics: DataFrame | None = None
    landed_statistics: DataFrame | None = None
    masked_statistics: DataFrame | None = None


def shown(column: Column, data_type: T.DataType) -> Column:
    """Minimum or maximum as text of one fixed form."""
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return column.try_cast("decimal(38,6)").cast("string")
    if isinstance(data_type, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    if isinstance(data_type, T.TimestampNTZType):
        # date_format would read it in the session's zone
        text = column.cast("string")
        return F.rpad(F.when(F.length(text) == 19, F.concat(text, F.lit("."))).otherwise(text), 26, "0")
    return column.cast("string")


def statistics(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: n_rows, and filled values, minimum and maximum of the i-th column as filled, low, high + i."""
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, name in enumerate(columns):
        if name not in df.columns:
            continue
        column = F.col(quoted(name))
        aggregates.append(F.count(column).alias(f"filled{i}"))
        if is_plain(df.schema[name].dataType):
            aggregates += [F.min(column).alias(f"low{i}"), F.max(column).alias(f"high{i}")]
    return df.agg(*aggregates)


def _columns(side: Sides) -> list[str]:
    return side.source.columns + [c for c in side.landed.columns if c not in side.source.columns]


def _compared(side: Sides, columns: Sequence[str], copies: Sequence[str] = ("landed",)) -> DataFrame:
    """One row: statistics of the source next to those of its copies, each side read once.

    The sides' rows are stacked, each in its own columns, and folded by table key: no join is needed.
    """
    rows = {}
    for name in ("source", *copies):
        known = getattr(side, f"{name}_statistics")
        rows[name] = statistics(getattr(side, name), columns) if known is None else known
    stacked = reduce(
        lambda above, below: above.unionByName(below, allowMissingColumns=True),
        [
            frame.select(
                F.lit(side.table_key).alias("table_key"), *[F.col(n).alias(f"{name}_{n}") for n in frame.columns]
            )
            for name, frame in rows.items()
        ],
    )
    folded = [F.max(n).alias(n) for n in stacked.columns if n != "table_key"]
    return stacked.groupBy("table_key").agg(*folded)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def validate_counts(sides: Sequence[Sides]) -> DataFrame:
    return _union(
        [
            _compared(s, []).select(
                "table_key",
                F.col("source_n_rows").alias("source_rows"),
                F.col("landed_n_rows").alias("landed_rows"),
                (F.col("source_n_rows") == F.col("landed_n_rows")).alias("matches"),
            )
            for s in sides
        ]
    )


def _same_type(side: Sides, name: str) -> bool:
    if name not in side.source.columns or name not in side.landed.columns:
        return False
    return side.source.schema[name].dataType == side.landed.schema[name].dataType


def _unpivoted(wide: DataFrame, rows: list[Column]) -> DataFrame:
    return wide.select("table_key", F.inline(F.array(*rows)))


def validate_columns(sides: Sequence[Sides]) -> DataFrame:
    """One row per column of either side: presence, type agreement and filled values."""
    parts = []
    for side in sides:
        names = _columns(side)
        wide = _compared(side, names)
        rows = []
        for i, name in enumerate(names):
            here, there = name in side.source.columns, name in side.landed.columns
            rows.append(
                F.struct(
                    F.lit(name).alias("column_name"),
                    F.lit(here).alias("in_source"),
                    F.lit(there).alias("in_landed"),
                    (F.col(f"source_filled{i}") if here else F.lit(None).cast("bigint")).alias("source_values"),
                    (F.col(f"landed_filled{i}") if there else F.lit(None).cast("bigint")).alias("landed_values"),
                    F.lit(_same_type(side, name)).alias("matches"),
                )
            )
        parts.append(_unpivoted(wide, rows))
    return _union(parts)


def _minmax_rows(
    wide: DataFrame, schema: T.StructType, columns: Sequence[str], checked: Sequence[str], copy: str = "landed"
) -> DataFrame:
    rows = []
    for i, name in enumerate(columns):
        if name not in checked:
            continue
        data_type = schema[name].dataType
        low, high = F.col(f"source_low{i}"), F.col(f"source_high{i}")
        landed_low, landed_high = F.col(f"{copy}_low{i}"), F.col(f"{copy}_high{i}")
        rows.append(
            F.struct(
                F.lit(name).alias("column_name"),
                shown(low, data_type).alias("source_min"),
                shown(high, data_type).alias("source_max"),
                shown(landed_low, data_type).alias("landed_min"),
                shown(landed_high, data_type).alias("landed_max"),
                (low.eqNullSafe(landed_low) & high.eqNullSafe(landed_high)).alias("matches"),
            )
        )
    return _unpivoted(wide, rows)


def _checked(side: Sides) -> list[str]:
    return [c for c in side.source.columns if _same_type(side, c) and is_plain(side.source.schema[c].dataType)]


def validate_minmax(sides: Sequence[Sides]) -> DataFrame:
    """Minimum and maximum of every comparable column, compared in the column's own type."""
    return _union(
        [_minmax_rows(_compared(s, _columns(s)), s.source.schema, _columns(s), _checked(s)) for s in sides]
    )


def masked_minmax(sides: Sequence[Sides]) -> DataFrame:
    """The same for the masked copy, over the numeric columns that are not masked."""
    parts = []
    for side in sides:
        if side.masked is not None:
            names = side.source.columns
            wide = _compared(side, names, ["masked"])
            numeric = checked_numeric_columns(side.source, side.masked_columns)
            parts.append(_minmax_rows(wide, side.source.schema, names, numeric, "masked"))
    return _union(parts)


def _agreement(columns: Sequence[str], checked: Sequence[str], copy: str) -> Column:
    equal = F.lit(True)
    for i, name in enumerate(columns):
        if name in checked:
            for end in ("low", "high"):
                equal = equal & F.col(f"source_{end}{i}").eqNullSafe(F.col(f"{copy}_{end}{i}"))
    return equal


def validation_status(sides: Sequence[Sides]) -> DataFrame:
    """Verdict per table: differing counts or columns fail it; min/max or the masked copy make it partial."""
    parts = []
    for side in sides:
        names = _columns(side)
        masked = F.lit(None).cast("boolean")
        if side.masked is not None:
            numeric = checked_numeric_columns(side.source, side.masked_columns)
            masked = (
                (F.col("source_n_rows") == F.col("masked_n_rows"))
                & F.lit(set(side.source.columns) == set(side.masked.columns))
                & _agreement(names, numeric, "masked")
            )
        parts.append(
            _compared(side, names, ["landed"] if side.masked is None else ["landed", "masked"]).select(
                "table_key",
                (F.col("source_n_rows") == F.col("landed_n_rows")).alias("counts_ok"),
                F.lit(all(_same_type(side, n) for n in names)).alias("columns_ok"),
                _agreement(names, _checked(side), "landed").alias("minmax_ok"),
                masked.alias("masked_ok"),
            )
        )
    status = (
        F.when(~F.col("counts_ok") | ~F.col("columns_ok"), FAILED)
        .when(~F.col("minmax_ok") | ~F.coalesce("masked_ok", F.lit(True)), PARTIAL)
        .otherwise(SUCCESS)
    )
    return _union(parts).withColumn("status", status)


def publish_plan(statuses: DataFrame, target_kind: str, raw_zone: str, masked_zone: str) -> DataFrame:
    """Tables to register: validated ones in a lake target; the masked copy too where columns are masked."""
    passed = statuses.filter(F.col("status").isin(SUCCESS, PARTIAL) & F.lit(target_kind.lower() == "blob"))
    raw = F.concat(F.lit(raw_zone + "."), "table_key")
    masked = F.concat(F.lit(masked_zone + "."), "table_key", F.lit("_masked"))
    names = F.array_compact(F.array(raw, F.when(F.col("masked_ok").isNotNull(), masked)))
    return passed.select("table_key", F.explode(names).alias("published_as"))


def run_summary(loads: DataFrame) -> DataFrame:
    """The three closing lists as rows (outcome, table_key): nothing is gathered into one value.

    Input: table_key, status (NULL while not validated), error (NULL unless the extraction raised).
    """
    outcome = (
        F.when(F.col("error").isNotNull(), "Unsuccessful Extraction")
        .when(F.col("status").isin(SUCCESS, PARTIAL), "Successful Validation")
        .when(F.col("status") == FAILED, "Failed Validation")
    )
    return loads.select(outcome.alias("outcome"), "table_key").filter("outcome IS NOT NULL")


def load_durations(loads: DataFrame) -> DataFrame:
    """Elapsed time as hours, minutes and seconds. Input: log_id, start_timestamp, end_timestamp."""
    # an interval, not timestampdiff: the latter reads zone-free times in the session's zone
    elapsed = F.expr("cast(cast(end_timestamp - start_timestamp AS INTERVAL SECOND) AS BIGINT)")
    timed = loads.select("log_id", elapsed.alias("total_seconds"))
    return timed.selectExpr(
        "log_id",
        "total_seconds",
        "total_seconds div 3600 AS hours",
        "total_seconds % 3600 div 60 AS minutes",
        "total_seconds % 60 AS seconds",
    ).withColumn("elapsed", F.format_string("%dh:%dm:%ds", "hours", "minutes", "seconds"))
