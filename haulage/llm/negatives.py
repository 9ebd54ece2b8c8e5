"""Hard-negative mining with cover trees over norm-augmented candidates.

A row's score is its integer inner product with the anchor. Each candidate gets one more component, sqrt(M^2 - |x|^2), so that all
of a chunk have the norm M; the anchor gets a 0 there, and scores stay. Distances between candidates then bound scores: below a
node with centre c and covering radius r every score lies within |anchor| * r of the centre's score.

A cover tree is built for each chunk of CHUNK_ROWS rows: level after level the radius is halved and centres are added, farthest
row first, until every row is within the radius of one; a centre stays one on all levels below. A node keeps the radius that it
really covers and the least and greatest label below it. The search takes the node of the highest possible score first, skips
nodes whose scores lie outside all windows still open, or below the k-th best found, or whose labels cannot count, and reads
the scores of single rows exactly. Radii are rounded up; scores are whole numbers below 2^53 held as doubles.

Two searches: the positives of each anchor (rows of its label), then for each positive the rows of other labels in the window
that its score opens; the windows of one anchor share a descent. Chunks of candidates and blocks of anchors meet in cells: a cell
holds the chunks of one group (about CHUNKS_PER_CELL) and the blocks of one set (about BLOCKS_PER_CELL), whatever the size of
the tables. A chunk is sent once per set of blocks, and a block once per group. Each cell gives at most k rows per window.

Rows with a null id, a null label, a null vector or null or non-finite components take no part. Anchors meet candidates of
their own length only; empty vectors score 0. Equal scores rank by smaller id. A row with the anchor's id is never its positive.
Equal anchor rows are answered once; anchors that share an id but differ are answered each by itself; repeated candidates each
count. Scores that might pass 2^53 are worked out as Python integers and end at the limits of a long. Anchors without positives
or without rows in a window give no rows; empty tables give none. Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging

SCALE = 256
CHUNK_ROWS, CHUNKS_PER_CELL = 2_048, 8
BLOCK_ROWS, BLOCKS_PER_CELL = 256, 16
EXACT = float(1 << 52)
LONG = (1 << 63) - 1


def clean(frame: DataFrame, id_column: str, label_column: str | Column, vector_column: str) -> DataFrame:
    """id, label, vector (array<double>) of the rows that take part."""
    label = F.col(label_column) if isinstance(label_column, str) else label_column
    rows = frame.select(
        F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("vector").isNotNull() & finite)


PACKED = "part int, number int, dims int, ids binary, labels binary, keys binary, body binary, windows array<array<bigint>>"


def packed(rows: DataFrame, size: int, scale: int) -> DataFrame:
    """Blocks of at most `size` rows of one length, scaled to whole numbers. rows: id, label, key, tops, vector."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}
        part, number = TaskContext.get().partitionId(), 0

        def block(dims: int) -> pa.RecordBatch:
            nonlocal number
            number += 1
            ids, labels, keys, tops, vectors = zip(*waiting.pop(dims))
            body = np.floor(scale * np.array(vectors, np.float64).reshape(len(ids), dims))
            values = (part, number, dims, *(np.array(x, np.int64).tobytes() for x in (ids, labels, keys)), body.tobytes(), tops)
            kinds = (pa.int32(),) * 3 + (pa.binary(),) * 4 + (pa.list_(pa.list_(pa.int64())),)
            names = [field.split()[0] for field in PACKED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)

        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(4)]
            for row in zip(*columns, batch.column(4).to_numpy(zero_copy_only=False)):
                group = waiting.setdefault(len(row[4]), [])
                group.append(row)
                if len(group) == size:
                    yield block(len(row[4]))
        for dims in list(waiting):
            yield block(dims)

    return rows.select("id", "label", "key", "tops", "vector").mapInArrow(pack, PACKED)


def unpacked(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    ids, labels, keys = (np.frombuffer(row[name], np.int64) for name in ("ids", "labels", "keys"))
    return ids, labels, keys, np.frombuffer(row["body"], np.float64).reshape(len(ids), row["dims"])


class Level:
    """Nodes of one level, the children of a node side by side on the next."""

    def __init__(self, rows: np.ndarray, radius: np.ndarray, points: np.ndarray, labels: np.ndarray, ids: np.ndarray, below: tuple):
        self.radius, self.points, self.labels, self.ids = radius, points[rows], labels[rows], ids[rows]
        self.least, self.most, self.single = below
        self.first: np.ndarray | None = None  # children of node i: first[i] to first[i + 1]


class CoverTree:
    def __init__(self, ids: np.ndarray, labels: np.ndarray, points: np.ndarray):
        n = len(ids)
        norms = np.square(points).sum(axis=1)
        most = norms.max(initial=0.0)
        lifted = np.column_stack([points, np.sqrt(most - norms)])
        # Squares are rounded up by more than the error of the products.
        distance = np.sqrt(np.maximum(2 * (most - lifted @ lifted.T), 0) + 1e-9 * most)
        np.fill_diagonal(distance, 0)
        nets, near, radius = [[0]], distance[0].copy(), distance[0].max()
        while len(nets[-1]) < n and radius > 0:
            radius = radius / 2 if radius > 1e-3 else 0
            net = list(nets[-1])
            while len(net) < n and near[far := int(near.argmax())] > radius:
                net.append(far)
                np.minimum(near, distance[far], out=near)
            if len(net) > len(nets[-1]):
                nets.append(net)
        if len(nets[-1]) < n:  # equal rows
            nets.append(nets[-1] + sorted(set(range(n)) - set(nets[-1])))
        parents = [np.array(net)[distance[np.array(below)][:, net].argmin(axis=1)] for net, below in zip(nets, nets[1:])]
        rows = [np.array(nets[0])]
        for above, below in zip(parents, nets[1:]):  # children in the order of their parents
            place = np.empty(n, np.int64)
            place[rows[-1]] = np.arange(len(rows[-1]))
            rows.append(np.array(below)[np.argsort(place[above], kind="stable")])
        self.levels: list[Level] = []
        over = np.arange(n)  # the row that stands for each row on this level
        for depth in range(len(nets) - 1, -1, -1):
            if depth < len(nets) - 1:
                up = np.empty(n, np.int64)
                up[np.array(nets[depth + 1])] = parents[depth]
                over = up[over]
            of = lambda ufunc, start, values: (out := np.full(n, start), ufunc.at(out, over, values))[0][rows[depth]]  # noqa: B023, E731
            below = of(np.minimum, LONG, labels), of(np.maximum, -LONG - 1, labels), of(np.add, 0, np.ones(n, np.int64)) == 1
            cover = of(np.maximum, 0.0, distance[over, np.arange(n)]) * (1 + 1e-9)
            level = Level(rows[depth], cover, points, labels, ids, below)
            if self.levels:
                up_place = np.empty(n, np.int64)
                up_place[rows[depth]] = np.arange(len(rows[depth]))
                level.first = np.searchsorted(np.sort(up_place[up[rows[depth + 1]]]), np.arange(len(rows[depth]) + 1))
            self.levels.insert(0, level)


class Found:
    """The k best (score, smaller id first) with lo <= score <= hi."""

    def __init__(self, k: int, lo: float = -np.inf, hi: float = np.inf):
        self.k, self.lo, self.hi = k, lo, hi
        self.scores, self.ids = np.zeros(0), np.zeros(0, np.int64)

    @property
    def floor(self) -> float:
        return max(self.lo, self.scores[-1]) if len(self.scores) == self.k else self.lo

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.floor) & (scores <= self.hi)
        if fits.any():
            scores, ids = np.concatenate([self.scores, scores[fits]]), np.concatenate([self.ids, ids[fits]])
            first = np.lexsort((ids, -scores))[: self.k]
            self.scores, self.ids = scores[first], ids[first]


def descend(tree: CoverTree, own: int, label: int, anchor: np.ndarray, windows: list[Found], same: bool) -> None:
    """Best-first search of one anchor for all its windows: rows of its label (not its own id), or of all others."""
    norm, top = np.sqrt(np.square(anchor).sum()) * (1 + 1e-9), max(w.hi for w in windows)
    tie = 0

    def look(level: Level, nodes: slice) -> Iterator[tuple[float, int]]:
        scores = level.points[nodes] @ anchor
        spread = norm * level.radius[nodes] + 1e-6 * np.abs(scores)
        floor = min(w.floor for w in windows)
        wanted = (scores + spread >= floor) & (scores - spread <= top)
        if same:
            wanted &= (level.least[nodes] <= label) & (level.most[nodes] >= label)
        else:
            wanted &= (level.least[nodes] != label) | (level.most[nodes] != label)
        leaf = wanted & level.single[nodes]
        if leaf.any():
            labels, ids = level.labels[nodes][leaf], level.ids[nodes][leaf]
            counts = (labels == label) & (ids != own) if same else labels != label
            for window in windows:
                window.add(scores[leaf][counts], ids[counts])
        inner = np.flatnonzero(wanted & ~level.single[nodes])
        return zip((scores + spread)[inner].tolist(), (inner + nodes.start).tolist())

    heap: list = []
    for bound, node in look(tree.levels[0], slice(0, 1)):
        heap.append((-bound, tie, 0, node))
    while heap:
        bound, _, depth, node = heapq.heappop(heap)
        if -bound < min(w.floor for w in windows):
            return
        first = tree.levels[depth].first
        for below, child in look(tree.levels[depth + 1], slice(int(first[node]), int(first[node + 1]))):
            tie += 1
            heapq.heappush(heap, (-below, tie, depth + 1, child))


def plain_search(ids, labels, points, own: int, label: int, anchor, windows: list[Found], same: bool) -> None:
    """The same by Python integers, for components too large for doubles. Scores become Python integers."""
    query = [int(x) for x in anchor]
    for window in windows:
        best = list(zip(list(window.scores), window.ids.tolist()))
        for key, kind, point in zip(ids.tolist(), labels.tolist(), points):
            if (kind == label and key != own) if same else kind != label:
                score = max(-LONG - 1, min(LONG, sum(a * int(b) for a, b in zip(query, point))))
                if window.lo <= score <= window.hi:
                    best.append((score, key))
        best = sorted(best, key=lambda x: (-int(x[0]), x[1]))[: window.k]
        window.scores, window.ids = np.array([s for s, _ in best], object), np.array([i for _, i in best], np.int64)


def cells(chunks: DataFrame, blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cell (g, s): each chunk in one group, each block in one set, every pair of them in one cell."""
    groups, sets = -(-max(chunks.count(), 1) // CHUNKS_PER_CELL), -(-max(blocks.count(), 1) // BLOCKS_PER_CELL)
    deal = lambda n: F.pmod(F.xxhash64("part", "number"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    return (
        chunks.withColumn("g", deal(groups)).withColumn("s", every(sets)),
        blocks.withColumn("s", deal(sets)).withColumn("g", every(groups)),
    )


def searched(chunks: DataFrame, blocks: DataFrame, k: int, least: float | None) -> DataFrame:
    """key, anchor, label, slot, id, score: each cell's k best per anchor, or per window.

    least None: rows of the anchor's label, slot 0. Otherwise blocks carry `windows` (for each anchor the scores of its positives,
    best first), and rows of other labels between `least` hundredths of such a score and the score are taken.
    """

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        anchors = []
        for row in right.to_pylist():
            ids, labels, keys, body = unpacked(row)
            for own, label, key, anchor, tops in zip(ids.tolist(), labels.tolist(), keys.tolist(), body, row["windows"]):
                # The lower border is rounded up: least * score <= 100 * other.
                windows = [Found(k)] if least is None else [Found(k, -((-least * top) // 100), top) for top in tops]
                anchors.append((row["dims"], own, label, key, anchor, windows))
        for row in left.to_pylist():
            ids, labels, _, points = unpacked(row)
            largest, tree = np.abs(points).max(initial=0), None
            for dims, own, label, _, anchor, windows in anchors:
                if dims != row["dims"]:
                    continue
                wide = max(np.abs(anchor).max(initial=0), 1) * max(largest, 1) * max(dims, 1) >= EXACT or max(largest, 1) ** 2 * max(dims, 1) >= EXACT
                if wide or any(w.scores.dtype == object for w in windows):
                    plain_search(ids, labels, points, own, label, anchor, windows, least is None)
                else:
                    tree = tree or CoverTree(ids, labels, points)
                    descend(tree, own, label, anchor, windows, least is None)
        out = [
            (key, own, label, slot, i, int(score))
            for _, own, label, key, _, windows in anchors
            for slot, window in enumerate(windows)
            for i, score in zip(window.ids.tolist(), window.scores.tolist())
        ]
        names = ["key", "anchor", "label", "slot", "id", "score"]
        kinds = [pa.int64()] * 3 + [pa.int32()] + [pa.int64()] * 2
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds)], names=names)

    left, right = cells(chunks, blocks)
    found = left.groupBy("g", "s").cogroup(right.groupBy("g", "s")).applyInArrow(
        search, "key long, anchor long, label long, slot int, id long, score long"
    )
    order = Window.partitionBy("key", "anchor", "slot").orderBy(F.col("score").desc(), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    least: int = 80,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    For each row of is_anchor (on `id`) its best other rows of the same label, and for each of these the best rows of other labels
    with least * positive_score <= 100 * negative_score <= 100 * positive_score.
    """
    part = clean(rows, id_column, label, vector_column)
    part = part.withColumn("key", F.xxhash64("id", "label", "vector")).withColumn("tops", F.lit(None).cast("array<bigint>"))
    chunks = staging.staged(packed(part, CHUNK_ROWS, scale), "negatives-chunks")
    anchors = staging.staged(part.filter(is_anchor).distinct().withColumnRenamed("id", "anchor"), "negatives-anchors")
    blocks = staging.staged(packed(anchors.withColumnRenamed("anchor", "id"), BLOCK_ROWS, scale), "negatives-blocks")
    chosen = staging.staged(searched(chunks, blocks, positives, None), "negatives-positives")

    # The anchors again, now with the scores of their positives.
    scores = F.array_sort(F.collect_list(F.struct("rank", "score")))["score"]
    opened = anchors.drop("tops").join(chosen.groupBy("key", "anchor").agg(scores.alias("tops")), ["key", "anchor"])
    blocks = staging.staged(packed(opened.withColumnRenamed("anchor", "id"), BLOCK_ROWS, scale), "negatives-windows")
    found = searched(chunks, blocks, negatives, least).withColumnRenamed("id", "negative_id").withColumnRenamed("score", "negative_score")
    chosen = chosen.select("key", "anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(chosen, ["key", "anchor", "slot"]).select(
        F.col("anchor").alias("anchor_id"), "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )

