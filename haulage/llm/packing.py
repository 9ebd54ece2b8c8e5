"""Best-fit packing of token pieces into sequences by minimum bin slack.

For each sequence the longest piece left is placed first; a subset sum over a bitset of the lengths that are left
finds the fullest way to fill the rest, and those pieces are taken out. Pieces of one length are interchangeable, so
the search needs only the count of each length: a histogram of at most `capacity` rows, whatever the number of pieces.
One combination is used as often as the counts allow, which is what choosing it bin by bin would do. After each use
some length has fewer pieces left than the combination needs, so there are at most about capacity * (1 + ln(capacity))
combinations; the table of places made from them has that bound and may be broadcast.

Pieces get their places by rank within their length. The rank is counted inside the task that makes the piece
(`part`, `nth`) and completed by a prefix sum over (length, part), so no length is ever gathered in one task.

Null texts count as empty (one piece: the end id). Equal rows are separate pieces. An empty table gives no rows.
Columns of the input beyond the named ones are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging, tokens

PIECES = (
    "doc_id {id}, piece int, start long, length long, ids_crc32 long, ids binary, part int, nth long"
)


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: only the first may be shorter than capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, n, capacity)]


def token_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    capacity: int = 1024,
    end_id: int = 2,
    vocabulary: str | None = None,
    keep_ids: bool = True,
) -> DataFrame:
    """One row per piece of each text's ids and end id; `ids` holds little-endian unsigned 32-bit ids."""
    vocabulary = vocabulary or tokens.default_vocabulary()
    id_type = docs.schema[id_column].dataType.simpleString()
    schema = PIECES.format(id=id_type)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = tokens.encoder(vocabulary), TaskContext.get().partitionId(), {}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for a, b in tokens.slices(texts):
                ids_of = encoder.encode([text or "" for text in texts[a:b]])
                rows, source = [], []
                for k, ids in enumerate(ids_of):
                    data = np.append(ids, np.uint32(end_id)).astype("<u4").tobytes()
                    for piece, (start, length) in enumerate(cut(len(ids) + 1, capacity)):
                        body = data[4 * start : 4 * (start + length)]
                        nth = seen[length] = seen.get(length, -1) + 1
                        source.append(a + k)
                        rows.append((piece, start, length, zlib.crc32(body), body if keep_ids else None, part, nth))
                columns = [batch.column(0).take(pa.array(source, pa.int64()))]
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64())
                columns += [pa.array(values, kind) for values, kind in zip(zip(*rows), types)]
                yield pa.RecordBatch.from_arrays(columns, names=NAMES)

    return docs.select(F.col(id_column), F.col(text_column)).mapInArrow(pieces, schema)


NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "part", "nth"]


def fullest(left: dict[int, int], capacity: int) -> dict[int, int]:
    """The longest piece left and the fullest filling of the rest: {length: pieces of it}."""
    longest = max(left)
    rest = capacity - longest
    mask, reach, layers = (1 << (rest + 1)) - 1, 1, []
    for length in sorted((x for x in left if x <= rest), reverse=True):
        many, step = min(left[length] - (length == longest), rest // length), 1
        while many > 0:
            step = min(step, many)
            layers.append((length, step, reach))
            reach |= reach << (length * step) & mask
            many, step = many - step, 2 * step
        if reach >> rest:
            break
    fill, chosen = reach.bit_length() - 1, {longest: 1}
    for length, step, before in reversed(layers):
        if not before >> fill & 1:
            chosen[length] = chosen.get(length, 0) + step
            fill -= length * step
    return chosen


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Combinations with the number of sequences that use each."""
    left, combinations = {n: c for n, c in counts.items() if c > 0}, []
    while left:
        chosen = fullest(left, capacity)
        times = min(left[n] // k for n, k in chosen.items())
        combinations.append((chosen, times))
        for n, k in chosen.items():
            left[n] -= k * times
            if not left[n]:
                del left[n]
    return combinations


def places(combinations: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, last rank, sequence of the first rank, offset) for every slot of every combination."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for chosen, times in combinations:
        offset = 0
        for length in sorted(chosen, reverse=True):
            for _ in range(chosen[length]):
                first = used.get(length, 0)
                rows.append((length, first, first + times - 1, sequence, offset))
                used[length], offset = first + times, offset + length
        sequence += times
    return rows


def pack(pieces: DataFrame, capacity: int = 1024) -> DataFrame:
    """pieces with sequence_id and offset; they have `length` (1 to capacity), `part` and `nth`."""
    spark = pieces.sparkSession
    parts = staging.staged(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "packing-parts")
    counts = {r.length: r.n for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    rows = places(plan(counts, capacity))
    table = spark.createDataFrame(rows, "p_length long, first long, last long, sequence long, offset long")
    before = parts.select(
        F.col("length").alias("b_length"),
        F.col("part").alias("b_part"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"),
    )
    ranked = (
        pieces.join(before, F.expr("length = b_length AND part = b_part"))
        .withColumn("rank", F.expr("before + nth"))
        .drop("b_length", "b_part", "before")
    )
    placed = ranked.join(F.broadcast(table), F.expr("length = p_length AND rank BETWEEN first AND last"))
    return placed.withColumn("sequence_id", F.expr("sequence + rank - first")).drop(
        "p_length", "first", "last", "sequence", "rank", "part", "nth"
    )


def packed_documents(docs: DataFrame, capacity: int = 1024, vocabulary: str | None = None, keep_ids=True) -> DataFrame:
    """Pieces of all docs (doc_id, text) with their places."""
    made = token_pieces(docs, capacity=capacity, vocabulary=vocabulary, keep_ids=keep_ids)
    return pack(staging.staged(made, "packing-pieces"), capacity)
