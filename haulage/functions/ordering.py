"""Column names, key values as text, and numbers looked up by place."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def key_text(column: Column, data_type: T.DataType) -> Column:
    """Text that casts back to exactly the same value in any session zone."""
    if isinstance(data_type, T.TimestampType):
        return F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return column.cast("string")


def is_plain(data_type: T.DataType) -> bool:
    """Types whose values survive the round trip through text."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType)
    intervals = (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)
    return not isinstance(data_type, (*nested, *intervals, T.NullType))


def lookup(values: Sequence[int | None], index: Column) -> Column:
    """Element of a literal bigint array; NULL where the array holds NULL."""
    array = F.from_json(F.lit(json.dumps(list(values))), "array<bigint>")
    return F.get(array, index)
