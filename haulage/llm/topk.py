"""Exact top-k search by columnar branch-and-bound.

Vectors are scaled to integers and held by columns (vertical layout): a chunk of candidates is a matrix of
dimensions x candidates. Queries of a strip are answered against a chunk dimension block by dimension block. After
each block a candidate's score is bounded from above by its partial score plus |rest of query| * |rest of candidate|
(Cauchy-Schwarz on the remaining mass); candidates whose bound is below the k-th best score known to the query are
out. Queries left with few candidates see further dimensions of these only, the others of all, as one product of
matrices. Dimensions are taken in order of the queries' mass. All arithmetic is exact: partial sums are integers
below 2^53, kept as doubles, and bounds are rounded up.

Work is dealt out in cells: candidates in chunks by groups of chunks, queries in blocks by groups of queries, one cell
(and one task) for each pair of groups. A cell is sent its blocks of queries first, which it holds, then its chunks,
each of them once, which it streams. There are as many groups of queries as keep what a cell holds below CELL_BYTES,
and as many groups of chunks as give all tasks work, fewer where blocks and results, which are repeated for each, would
come to more than REPEATED_BYTES. Rows move as the narrowest integers that hold them. Each cell keeps the best k per query, a window over (query)
with a limit per task merges them. No row exists for a pair that is not among a cell's best k.

Vectors that are null, or hold null or non-finite components, take no part. A query is compared with vectors
of its own length only; an empty vector scores 0 with other empty vectors. Equal scores rank by smaller id.
A query's own row is left out by id, so a repeated row with the query's id is left out too. Equal query rows are
answered once; repeated candidates each count. Components whose products might pass 2^53 are summed as Python integers and scores saturate at the
limits of a long. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging

SCALE = 1024
CHUNK_ROWS = 8_192
QUERY_ROWS = 512
#: Blocks of vectors with more dimensions than this have fewer rows.
USUAL_DIMENSIONS = 64
#: The first block of dimensions; each bound is tried after eight times as many as the one before.
DIMENSION_BLOCK, GROWTH = 8, 8
#: Queries that are answered at once.
STRIP = 128
#: A query that less than this share of a chunk is left to sees further dimensions of these candidates only.
FEW = 1 / 32
#: What a cell may hold: its queries, and the best of each so far.
CELL_BYTES = 48 << 20
#: What may be repeated of blocks and results, for groups of chunks; FEW_GROUPS in any case.
REPEATED_BYTES, FEW_GROUPS = 4 << 30, 64
EXACT = float(1 << 53)
LONG = (1 << 63) - 1
LOWEST = -np.finfo(np.float64).max


def scaled(matrix: np.ndarray) -> np.ndarray:
    """floor(1024 * x), x as double."""
    return np.floor(SCALE * matrix.astype(np.float64))


def clean(frame: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vector (array<double>) of the rows that take part."""
    ok = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = frame.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vector"))
    return rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull() & F.forall("vector", ok))


def narrow(matrix: np.ndarray) -> np.ndarray:
    """The same whole numbers as int16 or int32 where these hold them, else as they are."""
    most = np.abs(matrix).max(initial=0)
    return matrix.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.float64)


def packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of rows of one length: dims, ids (bytes of longs), body (bytes of narrow(), one column after the other)."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, tuple[list, list]] = {}

        def block(dims: int) -> pa.RecordBatch:
            ids, vectors = waiting.pop(dims)
            body = narrow(scaled(np.array(vectors, np.float64).reshape(len(ids), dims)).T)
            values = (dims, np.array(ids, np.int64).tobytes(), np.ascontiguousarray(body).tobytes())
            kinds = (pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=["dims", "ids", "body"])

        for batch in batches:
            for key, vector in zip(batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)):
                ids, vectors = waiting.setdefault(len(vector), ([], []))
                ids.append(key)
                vectors.append(vector)
                if len(ids) >= min(size, max(1, size * USUAL_DIMENSIONS // max(1, len(vector)))):
                    yield block(len(vector))
        for dims in list(waiting):
            yield block(dims)

    return rows.mapInArrow(pack, "dims int, ids binary, body binary")


def unpack(dims: int, ids, body) -> tuple[np.ndarray, np.ndarray]:
    keys = np.frombuffer(ids, np.int64)
    kind = {2: np.int16, 4: np.int32}.get(len(body) // max(1, dims * len(keys)), np.float64)
    return keys, np.frombuffer(body, kind).reshape(dims, len(keys))


class Best:
    """The k best (score, smaller id first) of each query of a strip so far."""

    def __init__(self, queries: np.ndarray, k: int):
        self.k = k
        self.scores = np.zeros((len(queries), k), np.int64)
        self.ids = np.zeros((len(queries), k), np.int64)
        self.found = np.zeros(len(queries), np.int64)

    def floors(self) -> np.ndarray:
        """A candidate must reach this score to matter."""
        return np.where(self.found == self.k, self.scores[:, -1].astype(np.float64), LOWEST)

    def add(self, q: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """Candidates, each with its query's place in the strip."""
        old, place = np.nonzero(np.arange(self.k) < np.where(np.isin(np.arange(len(self.found)), q), self.found, 0)[:, None])
        q, scores, ids = (np.concatenate(x) for x in ((old, q), (self.scores[old, place], scores), (self.ids[old, place], ids)))
        order = np.lexsort((ids, ~scores, q))  # ~ turns longs round without overflow
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        first = place < self.k
        q, place, order = q[first], place[first], order[first]
        self.scores[q, place], self.ids[q, place] = scores[order], ids[order]
        np.maximum.at(self.found, q, place + 1)

    def rows(self, q_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        q, place = np.nonzero(np.arange(self.k) < self.found[:, None])
        return q_ids[q], self.ids[q, place], self.scores[q, place]


def cuts(dims: int) -> list[int]:
    """Where blocks of dimensions end."""
    ends, at = [], DIMENSION_BLOCK
    while at < dims:
        ends, at = [*ends, at], GROWTH * at
    return [*ends, dims]


def rests(matrix: np.ndarray) -> list[np.ndarray]:
    """The mass of each column that remains behind each cut."""
    squares = np.square(matrix)
    return [np.sqrt(squares[at:].sum(axis=0)) for at in cuts(len(matrix))]


def search(q_ids, queries, c_ids, candidates, best: Best, k: int) -> None:
    """Branch-and-bound of all queries of a strip over one chunk; both are dimensions x rows."""
    order = np.argsort(-np.square(queries).sum(axis=1), kind="stable")
    queries, candidates = queries[order], candidates[order]
    bounded(q_ids, queries, rests(queries), c_ids, candidates, rests(candidates), best)


def bounded(q_ids, queries, q_rest, c_ids, candidates, c_rest, best: Best) -> None:
    """search() with dimensions in order."""
    dims, n, k = len(queries), len(c_ids), best.k
    floors = best.floors()
    # Far more than what is lost by rounding in the masses and in sums with them.
    slack = 1 + 1e-13 * max(1, dims) * np.sqrt(np.square(queries).sum(axis=0)) * np.sqrt(np.square(candidates).sum(axis=0)).max(initial=0)
    least = floors - slack
    ends = cuts(dims)
    left = np.arange(len(q_ids))  # queries that see all candidates
    partial = np.zeros((len(q_ids), n))
    for step, (at, end) in enumerate(zip([0, *ends], ends)):
        partial += queries[at:end, left].T @ candidates[at:end]
        if end == dims:
            break
        bound = np.multiply.outer(q_rest[step][left], c_rest[step])
        bound += partial
        alive = bound >= least[left][:, None]
        few = np.count_nonzero(alive, axis=1) <= FEW * n
        if few.any():
            q, c = np.nonzero(alive & few[:, None])
            sums, q = partial[q, c], left[q]
            for then, (a, b) in enumerate(zip(ends[step:], ends[step + 1 :]), step + 1):
                sums = sums + np.einsum("dp,dp->p", queries[a:b][:, q], candidates[a:b][:, c])
                keep = sums + q_rest[then][q] * c_rest[then][c] >= least[q]
                q, c, sums = q[keep], c[keep], sums[keep]
            keep = (sums >= floors[q]) & (c_ids[c] != q_ids[q])
            best.add(q[keep], sums[keep].astype(np.int64), c_ids[c[keep]])
            left, partial = left[~few], partial[~few]
            if not len(left):
                return
    by_id = np.argsort(c_ids, kind="stable")
    first, last = (np.searchsorted(c_ids, q_ids[left], side, sorter=by_id) for side in ("left", "right"))
    for row in np.flatnonzero(first < last):
        partial[row, by_id[first[row] : last[row]]] = -np.inf
    floors = floors[left]
    hits = partial >= floors[:, None]
    many = np.flatnonzero(np.count_nonzero(hits, axis=1) > 2 * k)
    if len(many) and n > k:
        floors[many] = np.maximum(floors[many], np.partition(partial[many], n - k, axis=1)[:, n - k])
        hits[many] = partial[many] >= floors[many][:, None]
        for row in many[np.count_nonzero(hits[many], axis=1) > 2 * k]:  # equal scores: only the smallest ids matter
            tied = np.flatnonzero(partial[row] == floors[row])
            hits[row, tied[np.argpartition(c_ids[tied], k - 1)[k:]]] = False
    q, c = np.nonzero(hits)
    best.add(left[q], partial[q, c].astype(np.int64), c_ids[c])


def search_wide(q_ids, queries, c_ids, candidates, best: Best, k: int) -> None:
    """The same scores by Python integers, for components too large for doubles."""
    whole = [[int(x) for x in column] for column in candidates.T]
    for q, own in enumerate(q_ids.tolist()):
        query = [int(x) for x in queries[:, q]]
        found = [(sum(map(int.__mul__, query, column)), key) for column, key in zip(whole, c_ids.tolist()) if key != own]
        found = sorted(((max(-LONG - 1, min(LONG, s)), key) for s, key in found), key=lambda x: (-x[0], x[1]))[:k]
        best.add(np.full(len(found), q), np.array([s for s, _ in found], np.int64), np.array([key for _, key in found], np.int64))


class Held:
    """The queries of a cell that have one length and one width, in strips, and the best of each so far."""

    def __init__(self, blocks: list[tuple[np.ndarray, np.ndarray]], k: int):
        ids, matrix = np.concatenate([x for x, _ in blocks]), np.concatenate([x for _, x in blocks], axis=1)
        mass = sum(np.square(matrix[:, at : at + STRIP].astype(np.float64)).sum(axis=1) for at in range(0, len(ids), STRIP))
        self.k, self.order = k, np.argsort(-mass, kind="stable")
        self.strips = []
        for at in range(0, len(ids), STRIP):
            strip = matrix[self.order, at : at + STRIP]
            self.strips.append((ids[at : at + STRIP], strip, np.abs(strip.astype(np.float64)).max(initial=0) or 1, Best(strip.T, k)))

    def meet(self, c_ids: np.ndarray, candidates: np.ndarray) -> None:
        candidates = candidates[self.order].astype(np.float64)
        largest = (np.abs(candidates).max(initial=0) or 1) * max(len(candidates), 1)
        c_rest = None
        for q_ids, strip, most, best in self.strips:
            queries = strip.astype(np.float64)
            if most * largest < EXACT:
                c_rest = c_rest or rests(candidates)
                bounded(q_ids, queries, rests(queries), c_ids, candidates, c_rest, best)
            else:
                search_wide(q_ids, queries, c_ids, candidates, best, self.k)


def cell_answers(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    """query_id, vec_id, score of the best k of each query in a cell's rows: of_queries, dims, ids, body; queries come first."""
    blocks: dict[tuple[int, int], list] = {}
    held: list[tuple[int, Held]] = []
    for batch in batches:
        columns = [batch.column(name) for name in ("of_queries", "dims", "ids", "body")]
        for row in range(batch.num_rows):
            of_queries, dims = columns[0][row].as_py(), columns[1][row].as_py()
            ids, matrix = unpack(dims, *(x[row].as_buffer() for x in columns[2:]))
            if of_queries:
                blocks.setdefault((dims, matrix.itemsize), []).append((ids.copy(), matrix.copy()))
                continue
            while blocks:
                (length, _), found = blocks.popitem()
                held.append((length, Held(found, k)))
            for length, queries in held:
                if length == dims:
                    queries.meet(ids, matrix)
    for _, queries in held:
        for at in range(0, len(queries.strips), 64):
            parts = zip(*(best.rows(q_ids) for q_ids, _, _, best in queries.strips[at : at + 64]))
            columns = [pa.array(np.concatenate(x), pa.int64()) for x in parts]
            yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])


def grid(held_bytes: int, tasks: int) -> tuple[int, int]:
    """Groups of queries and groups of chunks."""
    query_groups = max(1, -(-held_bytes // CELL_BYTES))
    return query_groups, min(max(1, -(-tasks // query_groups)), max(FEW_GROUPS, REPEATED_BYTES // max(1, held_bytes)))


def top_k(
    rows: DataFrame, is_query: Column, k: int = 10, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of is_query its k best other rows. is_query is on `id`."""
    spark = rows.sparkSession
    took_part = clean(rows, id_column, vector_column)
    blocks = staging.staged(packed(took_part.filter(is_query).distinct(), QUERY_ROWS), "topk-queries")
    per_id = F.length("ids") * (1 + 2 * k)
    held_bytes = blocks.agg(F.sum(F.length("body").cast("long") + per_id)).first()[0] or 0
    query_groups, chunk_groups = grid(held_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))

    # Blocks and chunks go to groups in turn, from another one in each partition.
    def in_turn(groups: int) -> Column:
        return F.expr(f"pmod(monotonically_increasing_id() % 8589934592 + spark_partition_id(), {groups})").cast("int")

    def sent(frame: DataFrame, of_queries: bool) -> DataFrame:
        other, n = ("c", chunk_groups) if of_queries else ("q", query_groups)
        frame = frame.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        cell = (F.col("q") * chunk_groups + F.col("c")).alias("cell")
        return frame.select(cell, F.lit(of_queries).alias("of_queries"), "dims", "ids", "body")

    chunks = packed(took_part, CHUNK_ROWS).withColumn("c", in_turn(chunk_groups))
    cells = sent(chunks, False).unionAll(sent(blocks.withColumn("q", in_turn(query_groups)), True))
    cells = cells.repartitionById(query_groups * chunk_groups, "cell").sortWithinPartitions(F.col("of_queries").desc())
    found = cells.mapInArrow(lambda batches: cell_answers(batches, k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
