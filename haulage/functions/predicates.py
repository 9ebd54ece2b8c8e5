"""Key ranges as SQL text that every vendor understands: plain comparisons, no row values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from haulage.sources.vendors import literal, ordered_column, ordered_literal, quote

Tuple = Sequence[str | None]


def _parts(
    vendor: str, fields: Sequence[T.StructField], values: Tuple, binary: bool
) -> list[tuple[str, str | None, bool]]:
    """Column, literal and nullability per key; ``binary`` compares text in Spark's order, not the source's."""
    column = ordered_column if binary else lambda vendor, name, _: quote(vendor, name)
    value = ordered_literal if binary else literal
    return [
        (column(vendor, f.name, f.dataType), None if v is None else value(vendor, v, f.dataType), f.nullable)
        for f, v in zip(fields, values)
    ]


def _equal(column: str, value: str | None) -> str:
    return f"{column} IS NULL" if value is None else f"{column} = {value}"


def _above(column: str, value: str | None) -> str:
    return f"{column} IS NOT NULL" if value is None else f"{column} > {value}"


def _below(column: str, value: str | None, nullable: bool) -> str | None:
    if value is None:
        return None
    return f"({column} < {value} OR {column} IS NULL)" if nullable else f"{column} < {value}"


def _alternatives(parts: list, last) -> list[str]:
    """One alternative per key column: equal before it, beyond it there."""
    found = []
    for i, part in enumerate(parts):
        beyond = last(part)
        if beyond is not None:
            found.append(" AND ".join([_equal(c, v) for c, v, _ in parts[:i]] + [beyond]))
    return found


def at_or_after(vendor: str, fields: Sequence[T.StructField], values: Tuple, binary: bool = True) -> str:
    """Key tuple >= values, NULLs first. The leading column alone is stated too, for the source's index."""
    parts = _parts(vendor, fields, values, binary)
    choices = _alternatives(parts, lambda p: _above(p[0], p[1]))
    choices.append(" AND ".join(_equal(c, v) for c, v, _ in parts))
    text = "(" + " OR ".join(f"({c})" for c in choices) + ")"
    column, value, _ = parts[0]
    return f"{column} >= {value} AND {text}" if value is not None and len(parts) > 1 else text


def above(vendor: str, fields: Sequence[T.StructField], values: Tuple, binary: bool = True) -> str:
    """Key tuple > values, NULLs first."""
    parts = _parts(vendor, fields, values, binary)
    return "(" + " OR ".join(f"({c})" for c in _alternatives(parts, lambda p: _above(p[0], p[1]))) + ")"


def equal(vendor: str, fields: Sequence[T.StructField], values: Tuple, binary: bool = True) -> str:
    """Key tuple = values, NULL equal to NULL."""
    return "(" + " AND ".join(_equal(c, v) for c, v, _ in _parts(vendor, fields, values, binary)) + ")"


def before(vendor: str, fields: Sequence[T.StructField], values: Tuple, binary: bool = True) -> str:
    """Key tuple < values, NULLs first."""
    parts = _parts(vendor, fields, values, binary)
    choices = _alternatives(parts, lambda p: _below(p[0], p[1], p[2]))
    text = "(" + " OR ".join(f"({c})" for c in choices) + ")" if choices else "1 = 0"
    column, value, nullable = parts[0]
    if value is None or len(parts) == 1 or nullable:
        return text
    return f"{column} <= {value} AND {text}"


def ranges(
    vendor: str, fields: Sequence[T.StructField], lows: Sequence[Tuple], binary: bool = True
) -> list[str]:
    """Disjoint, gapless predicates of consecutive chunks; the outer ends stay open for late rows."""
    found = []
    for i in range(len(lows)):
        tests = []
        if i > 0:
            tests.append(at_or_after(vendor, fields, lows[i], binary))
        if i + 1 < len(lows):
            tests.append(before(vendor, fields, lows[i + 1], binary))
        found.append(" AND ".join(tests) or "1 = 1")
    return found
