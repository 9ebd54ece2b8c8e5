"""The masked copy: which columns, and how they are replaced."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import quoted


def mask_columns(work_list: DataFrame, mask_map: DataFrame) -> DataFrame:
    """Masked columns of every table in the work list, matched on the exact table key.

    Repeated entries are combined before the shuffle, so a list never holds more than the
    distinct column names of one table.
    """
    wanted = mask_map.select("table_key", "column_name").distinct()
    return (
        work_list.select("table_key")
        .distinct()
        .join(wanted, "table_key")
        .groupBy("table_key")
        .agg(
            F.count(F.lit(1)).alias("n_masked"),
            F.concat_ws(",", F.array_sort(F.collect_list("column_name"))).alias("columns"),
        )
    )


def hashed(column: Column, salt: str) -> Column:
    """Salted SHA-256 of the value's text; NULL stays NULL."""
    return F.sha2(F.concat(F.lit(salt + "|"), column.cast("string")), 256)


def encrypted(column: Column, key: Column) -> Column:
    """Reversible mask: AES-GCM of the value's text, base64; NULL stays NULL."""
    return F.base64(F.aes_encrypt(column.cast("string"), key))


def decrypted(column: Column, key: Column, data_type: str = "string") -> Column:
    return F.aes_decrypt(F.unbase64(column), key).cast("string").cast(data_type)


def masked_projection(df: DataFrame, columns: Sequence[str], salt: str) -> DataFrame:
    unknown = sorted(set(columns) - set(df.columns))
    if unknown:
        raise ValueError(f"masked columns not in the table: {', '.join(unknown)}")
    return df.withColumns({c: hashed(F.col(quoted(c)), salt) for c in columns})


def encrypted_projection(df: DataFrame, columns: Sequence[str], key: Column) -> DataFrame:
    return df.withColumns({c: encrypted(F.col(quoted(c)), key) for c in columns})


@dataclass(frozen=True)
class Mask:
    """How a job masks: ``hash`` (salted, one way) or ``aes`` (reversible for those who have the key).

    Salt and key stand in the plans of the jobs that use them: keep event logs as safe as the secrets, or let Spark redact them.
    """

    kind: str = "hash"
    secret: str = field(default="", repr=False)

    def __post_init__(self) -> None:
        if self.kind not in ("hash", "aes"):
            raise ValueError(f"no mask of kind {self.kind}")
        if self.kind == "aes" and len(self.secret.encode()) not in (16, 24, 32):
            raise ValueError("an AES key has 16, 24 or 32 bytes")

    def check(self) -> None:
        if not self.secret:
            raise ValueError("masked columns need a salt: unsalted hashes of short values can be looked up")

    def apply(self, df: DataFrame, columns: Sequence[str]) -> DataFrame:
        if self.kind == "hash":
            return masked_projection(df, columns, self.secret)
        unknown = sorted(set(columns) - set(df.columns))
        if unknown:
            raise ValueError(f"masked columns not in the table: {', '.join(unknown)}")
        return encrypted_projection(df, columns, F.lit(self.secret))


def checked_numeric_columns(df: DataFrame, masked: Sequence[str]) -> list[str]:
    """Numeric columns whose minimum and maximum still mean something in the masked copy."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in masked]
