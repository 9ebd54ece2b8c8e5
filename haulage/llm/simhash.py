"""SimHash near-dedup: fingerprints of whole texts, linked by vantage-point trees.

Fingerprint: ASCII letters lower-cased, words split at ASCII white space, shingles of four words with repeats; a bit is 1
if it is set in over half of the shingles' hashes. Fingerprints at `radius` or fewer differing bits are linked; groups
are the connected components of the links.

1. Copies collapse: from here on a fingerprint stands for all documents that have it (`min` of their ids).
2. A bounded sample of fingerprints (`SAMPLE`) gives the upper levels of a vantage-point tree. Each leaf is a shard.
   A fingerprint goes down by its Hamming distance to the vantage points and is at home in one shard; with every
   boundary closer than `radius` it also visits the other side, if that side's number is higher. By the triangle
   inequality two linked fingerprints meet in the home shard of one of them. The sample decides how even the shards
   are, never which links are found. Shards grow with the square root of the number of fingerprints, which balances
   visits against a shard's size; one ball of radius 4 holds at most 679,121 fingerprints, which bounds what cannot be split.
3. In a shard a vantage-point tree over the home fingerprints is searched with all of them and all visitors at once.
   Links are merged as they are found (union-find), so a dense group costs no list of its pairs; the shard returns
   the members of each group as a chain, at most one link for each fingerprint.
4. Chains are joined to components round by round: a label moves to the least label that any of its nodes sees at a
   neighbour, so every round merges each group with another one. Rounds are written to the shared folder. A chain has
   no hubs, and joins by label are such that Spark splits skewed ones at run time.

Null and wordless texts have fingerprint zero and link like any other. Null ids take part in links; a component
without any id has a null component_id. Repeated rows are copies. Columns of the input pass through `near_dedup`
unchanged, whatever their names. An empty table gives an empty table.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from haulage.llm import staging

SEED = 42
#: Fingerprints that shape the tree of shards: at most this many come to the driver.
SAMPLE = 65_536
#: Share of the fingerprints that the driver sees at most; the sample only decides how even shards are.
SAMPLE_SHARE = 0.1
LEAF = 256


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Bits set in over half of the shingles' XXH64 hashes, as an unsigned number; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[min(shingle, len(words)) - 1 :].tolist()
    first = [0, *(ends[: len(last) - 1] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(first, last)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):  # bounded memory for very long texts
        block = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def with_fingerprints(docs: DataFrame, text_column: str, shingle: int) -> DataFrame:
    """All columns of docs, then fp (the fingerprint's bits as a long) and rid (a number of the row's own)."""
    at = docs.columns.index(text_column)
    kept = len(docs.columns)
    fields = [*docs.schema.fields]
    names = [f"c{k}" for k in range(kept)] + ["fp", "rid"]
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(fields)) + ", fp long, rid long"

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rid = TaskContext.get().partitionId() << 40
        for batch in batches:
            found = [fingerprint(text, shingle) for text in batch.column(at).to_pylist()]
            fps = pa.array(np.array(found, np.uint64).view(np.int64))
            rids = pa.array(np.arange(rid, rid + batch.num_rows))
            rid += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, fps, rids], names=names)

    return docs.toDF(*names[:kept]).mapInArrow(add, schema)


def distance(a, b) -> np.ndarray:
    return np.bitwise_count(np.bitwise_xor(a, b)).astype(np.int16)


class ShardTree:
    """Upper levels of the vantage-point tree, the same in every task."""

    def __init__(self, sample: np.ndarray, depth: int):
        self.nodes: list[tuple[np.uint64, int] | None] = []
        self.random = np.random.default_rng(SEED)
        self.n_shards = 0
        self.root = self.grow(np.unique(sample), depth)

    def grow(self, points: np.ndarray, depth: int):
        if depth == 0 or len(points) < 2:
            self.n_shards += 1
            return self.n_shards - 1
        # Of some vantage points, the one whose distances spread most.
        tried = self.random.choice(points, min(16, len(points)), replace=False)
        vantage = max(tried, key=lambda v: float(np.var(distance(points, v))))
        d = distance(points, vantage)
        border = int(np.median(d))
        if not ((d <= border).any() and (d > border).any()):
            border = (int(d.min()) + int(d.max())) // 2
        near, far = points[d <= border], points[d > border]
        if not len(near) or not len(far):
            self.n_shards += 1
            return self.n_shards - 1
        return (vantage, border, self.grow(near, depth - 1), self.grow(far, depth - 1))

    def route(self, points: np.ndarray, radius: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each shard, the points at home there and the points that visit it from lower shards."""
        home = [points[:0]] * self.n_shards
        visits = [points[:0]] * self.n_shards

        def go(node, settled: np.ndarray, guests: np.ndarray):
            if isinstance(node, int):
                home[node], visits[node] = settled, guests
                return
            vantage, border, near, far = node
            d, g = distance(settled, vantage), distance(guests, vantage)
            inside = d <= border
            go(near, settled[inside], guests[g <= border + radius])
            # Points that belong to the near side visit the far one; far shards have the higher numbers.
            crossing = settled[inside & (d > border - radius)]
            go(far, settled[~inside], np.concatenate([crossing, guests[g > border - radius]]))

        go(self.root, points, points[:0])
        return home, visits


class Groups:
    """Union-find over points 0 to n - 1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: np.ndarray) -> np.ndarray:
        roots = self.parent[x]
        while True:
            above = self.parent[roots]
            if np.array_equal(above, roots):
                return roots
            roots = above

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        ra, rb = self.find(a), self.find(b)
        unequal = ra != rb
        if not unequal.any():
            return
        for x, y in np.unique(np.stack([ra[unequal], rb[unequal]], axis=1), axis=0).tolist():
            while self.parent[x] != x:
                x = int(self.parent[x])
            while self.parent[y] != y:
                y = int(self.parent[y])
            self.parent[max(x, y)] = min(x, y)

    def chains(self) -> tuple[np.ndarray, np.ndarray]:
        """Neighbours in the chain of each group of two or more."""
        roots = self.find(np.arange(len(self.parent)))
        order = np.argsort(roots, kind="stable")
        same = roots[order][1:] == roots[order][:-1]
        return order[:-1][same], order[1:][same]


def link(points: np.ndarray, n_home: int, radius: int) -> Groups:
    """Groups of all points, from every link that has an end among the first n_home."""
    groups, random = Groups(len(points)), np.random.default_rng(SEED)

    def compare(members: np.ndarray, asking: np.ndarray) -> None:
        step = max(1, 1_000_000 // max(1, len(members)))
        for at in range(0, len(asking), step):
            some = asking[at : at + step]
            hit = np.bitwise_count(points[some][:, None] ^ points[members][None, :]) <= radius
            i, j = np.nonzero(hit)
            groups.merge(some[i], members[j])

    def search(members: np.ndarray, asking: np.ndarray) -> None:
        """members: home points of this node; asking: points that may have links among them."""
        if len(members) <= LEAF:
            compare(members, asking)
            return
        v = members[random.integers(len(members))]
        d, q = distance(points[members], points[v]), distance(points[asking], points[v])
        close = asking[q <= radius]
        groups.merge(close, np.full(len(close), v))
        border = int(np.median(d))
        near, far = d <= border, d > border
        if not far.any():  # at most half of the points are nearer than the median: cut below it
            border -= 1
            near, far = d <= border, d > border
        if min(near.sum(), far.sum()) < len(members) // 64:
            compare(members, asking)  # nearly all at one distance from the vantage point: no border parts them
            return
        search(members[near], asking[q <= border + radius])
        search(members[far], asking[q > border - radius])

    search(np.arange(n_home), np.arange(len(points)))
    return groups


def links(fingerprints: DataFrame, radius: int, n: int) -> DataFrame:
    """a, b: chains whose components are those of all links among the n distinct fingerprints (fp)."""
    spark = fingerprints.sparkSession
    depth = max(4, round(math.log2(math.sqrt(max(n, 1)) / 6))) if n > 4_096 else 0
    taken = fingerprints.sample(min(SAMPLE_SHARE, 0.8 * SAMPLE / max(n, 1)), SEED).limit(SAMPLE) if depth else fingerprints.limit(0)
    sample = np.array([row.fp for row in taken.collect()], np.int64).view(np.uint64)
    tree = ShardTree(sample, depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            home, visits = tree.route(points, radius)
            shards = [k for k in range(tree.n_shards) if len(home[k]) or len(visits[k])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(shards, pa.int32()),
                    pa.array([home[k].tobytes() for k in shards], pa.binary()),
                    pa.array([visits[k].tobytes() for k in shards], pa.binary()),
                ],
                names=["shard", "home", "visits"],
            )

    def search(table: pa.Table) -> pa.Table:
        read = lambda name: np.frombuffer(b"".join(table.column(name).to_pylist()), np.uint64)
        home, visits = read("home"), read("visits")
        points = np.concatenate([home, visits])
        a, b = link(points, len(home), radius).chains()
        return pa.table({"a": points[a].view(np.int64), "b": points[b].view(np.int64)})

    dealt = fingerprints.select("fp").mapInArrow(deal, "shard int, home binary, visits binary")
    return dealt.groupBy("shard").applyInArrow(search, "a long, b long")


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node, label (the component's least node) for every node of the edges (a, b), of which there are about rows."""
    way = lambda node, other: F.struct(F.col(node).alias("node"), F.col(other).alias("other"))
    ways = edges.filter("a <> b").select(F.explode(F.array(way("a", "b"), way("b", "a"))).alias("e"))
    both = staging.staged(ways.select("e.*").distinct(), "simhash-edges", rows)
    n = both.count()  # from the files' footers; there are no more nodes than edges
    labels = staging.staged(both.select("node").distinct().withColumn("label", F.col("node")), "simhash-labels", n)
    while True:
        seen = both.join(labels.toDF("other", "theirs"), "other").groupBy("node").agg(F.min("theirs").alias("least"))
        lower = staging.staged(
            labels.join(seen, "node").select("node", F.least("label", "least").alias("label"), F.col("label").alias("was")),
            "simhash-labels",
            n,
        )
        # All nodes of a label follow the one among them that saw the least label; then every label takes its own label,
        # which halves the length of paths.
        hooks = lower.groupBy(F.col("was").alias("root")).agg(F.min("label").alias("lowest"))
        merged = staging.staged(
            lower.join(hooks, F.expr("was = root")).select("node", F.col("lowest").alias("label"), "was"), "simhash-labels", n
        )
        onward = merged.select(F.col("node").alias("through"), F.col("label").alias("beyond"))
        moved = Observation()
        jumped = merged.join(onward, F.expr("label = through")).observe(moved, F.count_if(F.expr("beyond <> was")).alias("n"))
        labels = staging.staged(jumped.select("node", F.col("beyond").alias("label")), "simhash-labels", n)
        if not n or not moved.get["n"]:
            return labels


def grouped(rows: DataFrame, radius: int) -> DataFrame:
    """rows (id, fp, rid; a written table) with component_id, the smallest id of the component."""
    distinct = staging.staged(rows.groupBy("fp").agg(F.min("id").alias("least")), "simhash-distinct", rows.count())
    n = distinct.count()
    nodes = components(links(distinct.select("fp"), radius, n), n)
    members = distinct.join(nodes, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("label", "fp").alias("label")
    )
    members = staging.staged(members, "simhash-members", n)
    least = staging.staged(members.groupBy("label").agg(F.min("least").alias("component_id")), "simhash-least", n)
    named = staging.staged(
        members.join(least.withColumnRenamed("label", "l"), F.expr("label = l")).select("fp", "label", "component_id"),
        "simhash-named",
        n,
    )
    return rows.join(named.withColumnRenamed("fp", "f"), F.expr("fp = f")).drop("f")


def near_duplicates(docs: DataFrame, id_column="doc_id", text_column="text", shingle=4, radius=4) -> DataFrame:
    """id, fp, component_id for every row; fp is the fingerprint's bits as a signed long."""
    pair = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    made = with_fingerprints(pair, "text", shingle).selectExpr("c0 AS id", "fp", "rid")
    return grouped(staging.staged(made, "simhash-fingerprints"), radius).select("id", "fp", "component_id")


def near_dedup(docs: DataFrame, id_column="doc_id", text_column="text", shingle=4, radius=4) -> DataFrame:
    """docs with one document of each group: the one with the smallest id (of several rows with it, one)."""
    names = docs.columns
    wide = staging.staged(with_fingerprints(docs, text_column, shingle), "simhash-documents")
    id_name = f"c{names.index(id_column)}"
    rows = wide.selectExpr(f"{id_name} AS id", "fp", "rid")
    first = F.min(F.struct(F.col("id").isNull(), F.col("id"), F.col("rid"))).alias("first")
    winners = grouped(rows, radius).groupBy("label").agg(first).select(F.col("first.rid").alias("rid"))
    return wide.join(winners, "rid", "left_semi").drop("fp", "rid").toDF(*names)
