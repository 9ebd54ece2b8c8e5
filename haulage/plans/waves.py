"""Writing chunks in waves: one Spark job per wave and copy, so a failed run restarts where it stopped."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from haulage.operators.tracking import FAIL, PASS
from haulage.plans.copies import Copy
from haulage.sources.jdbc import Chunk

Reader = Callable[[Sequence[Chunk]], DataFrame]
Mask = Callable[[DataFrame], DataFrame]


@dataclass
class Outcome:
    """What happened to one chunk; NULL masked states mean that masking does not apply."""

    read_status: str | None = None
    write_status: str | None = None
    mask_read_status: str | None = None
    mask_write_status: str | None = None
    message: str | None = None


def first_line(error: Exception) -> str:
    return (str(error).splitlines() or [""])[0] or type(error).__name__


def split(chunks: Sequence[Chunk], size: int, tasks: int = 4_096) -> Iterator[Sequence[Chunk]]:
    """Waves of at most ``size`` chunks and, unless one chunk alone has more, at most ``tasks`` source queries."""
    wave: list[Chunk] = []
    queries = 0
    for chunk in chunks:
        parts = max(1, len(chunk.parts))
        if wave and (len(wave) == size or queries + parts > tasks):
            yield wave
            wave, queries = [], 0
        wave.append(chunk)
        queries += parts
    if wave:
        yield wave


def _write(read: Callable[[], DataFrame], copy: Copy, chunks: Sequence[Chunk]) -> None:
    """Write the chunks in one job, counting their rows on the way."""
    numbers = [c.iteration for c in chunks]
    seen = Observation()
    counts = [F.count(F.when(F.col("iteration") == n, 1)).alias(f"n{n}") for n in numbers]
    copy.write(read().observe(seen, *counts), numbers)
    found = seen.get
    copy.settle({n: found.get(f"n{n}", 0) for n in numbers})


def _attempt(read: Reader, copy: Copy, chunks: Sequence[Chunk]) -> dict[int, Exception | None]:
    """One job for all chunks; if it fails, each chunk alone, so that only the bad ones are marked."""
    try:
        _write(lambda: read(chunks), copy, chunks)
        return {c.iteration: None for c in chunks}
    except Exception as error:
        if len(chunks) == 1:
            return {chunks[0].iteration: error}
    result: dict[int, Exception | None] = {}
    for chunk in chunks:
        result |= _attempt(read, copy, [chunk])
    return result


def _readable(read: Reader, chunk: Chunk) -> bool:
    try:
        read([chunk]).write.format("noop").mode("overwrite").save()
        return True
    except Exception:
        return False


def run_raw(chunks: Sequence[Chunk], read: Reader, raw: Copy) -> dict[int, Outcome]:
    outcomes = {}
    errors = _attempt(read, raw, chunks)
    for chunk in chunks:
        error = errors[chunk.iteration]
        readable = error is None or _readable(read, chunk)
        outcomes[chunk.iteration] = Outcome(
            read_status=PASS if readable else FAIL,
            write_status=PASS if error is None else FAIL,
            message=None if error is None else first_line(error),
        )
    return outcomes


def run_masked(chunks: Sequence[Chunk], raw: Copy, masked: Copy, mask: Mask) -> dict[int, Outcome]:
    """The masked copy is made from the landed raw chunks: the source is read once per chunk."""

    def landed(some: Sequence[Chunk]) -> DataFrame:
        return mask(raw.read([c.iteration for c in some]))

    outcomes = {}
    errors = _attempt(landed, masked, chunks) if chunks else {}
    for chunk in chunks:
        error = errors[chunk.iteration]
        readable = error is None or _readable(landed, chunk)
        outcomes[chunk.iteration] = Outcome(
            mask_read_status=PASS if readable else FAIL,
            mask_write_status=PASS if error is None else FAIL,
            message=None if error is None else first_line(error),
        )
    return outcomes


def run_wave(
    chunks: Sequence[Chunk], read: Reader, raw: Copy, masked: Copy | None, mask: Mask | None
) -> dict[int, Outcome]:
    outcomes = run_raw(chunks, read, raw)
    if masked is None or mask is None:
        return outcomes
    landed = [c for c in chunks if outcomes[c.iteration].write_status == PASS]
    copied = run_masked(landed, raw, masked, mask)
    for chunk in chunks:
        outcome, copy = outcomes[chunk.iteration], copied.get(chunk.iteration)
        # a chunk that did not land could not be masked either
        outcome.mask_read_status = copy.mask_read_status if copy else FAIL
        outcome.mask_write_status = copy.mask_write_status if copy else FAIL
        outcome.message = outcome.message or (copy.message if copy else None)
    return outcomes
