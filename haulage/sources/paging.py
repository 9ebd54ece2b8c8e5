"""Pages of a table without a key, as SQL: key ranges between borders, and offsets only inside runs of full copies."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import types as T

from haulage.functions.predicates import above, at_or_after, before, equal
from haulage.sources import vendors


class NoLiteral(ValueError):
    """A border has a value that no literal can name (NaN, infinity)."""


@dataclass(frozen=True)
class Border:
    """First row of a page, or of a part of one: its values as text and how many copies of it stand before it."""

    values: tuple[str | None, ...]
    ordinal: int
    page_start: int = 1


@dataclass(frozen=True)
class Page:
    """A key range (predicate, in parts), or a query where a run of copies is cut."""

    predicate: str | None = None
    parts: tuple[str, ...] = ()
    pieces: tuple[tuple[str, int, int | None], ...] = ()  # (condition, copies to skip, copies to take or None for the rest)
    order: str = ""

    def query(self, vendor: str, source: str) -> str:
        if self.predicate is not None:
            return f"SELECT * FROM {source} WHERE {self.predicate}"
        return " UNION ALL ".join(
            f"SELECT * FROM ({some}) piece{i}" for i, some in enumerate(self._piece(vendor, source, *p) for p in self.pieces)
        )

    def _piece(self, vendor: str, source: str, condition: str, skip: int, take: int | None) -> str:
        where = f"{source} WHERE {condition}"
        if not skip and take is None:
            return f"SELECT * FROM {where}"
        limit = take if take is not None else vendors.ALL_ROWS
        return vendors.page_query(vendor, where, [self.order], skip, limit)


def pages(
    vendor: str,
    fields: Sequence[T.StructField],
    borders: Sequence[Border],
    cut_runs: bool,
    rows: int,
    condition: str | None = None,
) -> list[Page]:
    """The pages between borders, in order; disjoint, gapless, the outer ends open for late rows.

    ``condition``: what else a row has to fulfil to be in the source.
    ``cut_runs``: copies of one tuple are full copies, so that a page may end inside their run; otherwise a run belongs to the
    page it begins in.
    """
    if not cut_runs:
        borders = _whole_runs(borders)
    try:
        found = _between(vendor, fields, borders, rows)
    except ValueError as error:
        raise NoLiteral(str(error)) from error
    return found if condition is None else [_within(page, condition) for page in found]


def _within(page: Page, condition: str) -> Page:
    both = lambda test: f"{condition} AND {test}"
    pieces = tuple((both(test), skip, take) for test, skip, take in page.pieces)
    return Page(page.predicate and both(page.predicate), tuple(both(p) for p in page.parts), pieces, page.order)


def _whole_runs(borders: Sequence[Border]) -> list[Border]:
    """Borders inside a run move to its start: one border per tuple, which starts a page if any of its borders does."""
    kept: list[Border] = []
    for border in borders:
        if kept and kept[-1].values == border.values:
            kept[-1] = Border(border.values, 0, max(kept[-1].page_start, border.page_start))
        else:
            kept.append(Border(border.values, 0, border.page_start))
    return kept


def _between(vendor: str, fields: Sequence[T.StructField], borders: Sequence[Border], rows: int) -> list[Page]:
    starts = [i for i, b in enumerate(borders) if b.page_start]
    found = []
    for n, i in enumerate(starts):
        low = borders[i] if n else None
        high = borders[starts[n + 1]] if n + 1 < len(starts) else None
        inner = borders[i + 1 : starts[n + 1] if high else len(borders)]
        found.append(_page(vendor, fields, low, high, inner, rows))
    return found


def _page(vendor, fields, low: Border | None, high: Border | None, inner: Sequence[Border], rows: int) -> Page:
    order = vendors.total_order(vendor, fields)
    if not (low and low.ordinal) and not (high and high.ordinal):
        # parts begin at tuples, each tuple once: copies of one tuple are read by one task
        cuts = []
        for border in inner:
            if border.values not in (low.values if low else None, cuts[-1] if cuts else None):
                cuts.append(border.values)
        ends = [low.values if low else None, *cuts, high.values if high else None]
        parts = tuple(_range(vendor, fields, a, b) for a, b in zip(ends, ends[1:]))
        return Page(_range(vendor, fields, ends[0], ends[-1]), parts if len(parts) > 1 else ())
    if low and high and low.values == high.values:  # the whole page lies in one run
        return Page(pieces=((equal(vendor, fields, low.values), low.ordinal, rows),), order=order)
    pieces: list[tuple[str, int, int | None]] = []
    begin = at_or_after(vendor, fields, low.values) if low else None
    if low and low.ordinal:
        pieces.append((equal(vendor, fields, low.values), low.ordinal, None))
        begin = above(vendor, fields, low.values)
    end = before(vendor, fields, high.values) if high else None
    pieces.append((" AND ".join(t for t in (begin, end) if t) or "1 = 1", 0, None))
    if high and high.ordinal:
        pieces.append((equal(vendor, fields, high.values), 0, high.ordinal))
    return Page(pieces=tuple(pieces), order=order)


def _range(vendor, fields, low, high) -> str:
    tests = [at_or_after(vendor, fields, low)] if low is not None else []
    tests += [before(vendor, fields, high)] if high is not None else []
    return " AND ".join(tests) or "1 = 1"
