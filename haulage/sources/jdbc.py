"""Reading a database table: catalog queries, chunk plans pushed to the source, and chunk scans."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from haulage.functions.ordering import is_plain, key_text, lookup, quoted
from haulage.functions.predicates import ranges
from haulage.operators import chunking, decision, discovery, profile, ranking
from haulage.sources import paging, vendors

KEY_SCAN_ROWS = 2_000_000
RESERVED = "__"
#: Rows of a chunk that one task reads, about.
TASK_ROWS = 1_000_000


@dataclass(frozen=True)
class Connection:
    """How to reach a database. The password never enters a DataFrame or a log line."""

    vendor: str
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    fetch_rows: int = 10_000
    batch_rows: int = 10_000

    def options(self) -> dict[str, str]:
        known = {"url": self.url, "driver": self.driver, "user": self.user, "password": self.password}
        known |= {"fetchsize": str(self.fetch_rows), "batchsize": str(self.batch_rows)}
        known |= vendors.SESSION_OPTIONS.get(self.vendor, {})
        return {k: v for k, v in known.items() if v is not None}


@dataclass(frozen=True)
class TableSpec:
    """One entry of the work list."""

    table_key: str
    source_name: str
    table: str
    database: str
    schema: str | None = None


@dataclass(frozen=True)
class Chunk:
    """One restartable unit: the query that reads it, its key range if it has one, and the parts of that range.

    Parts are disjoint and make up the range; each is read by a task of its own. The range is one of ``source``, if that is
    not the table itself (one partition of it).
    """

    iteration: int
    query: str
    predicate: str | None = None
    parts: tuple[str, ...] = ()
    source: str | None = None


@dataclass(frozen=True)
class ChunkPlan:
    strategy: str
    table_count: int
    chunk_rows: int
    chunks: tuple[Chunk, ...]


def query_frame(spark: SparkSession, connection: Connection, sql: str) -> DataFrame:
    """Run a query at the source."""
    return spark.read.format("jdbc").options(**connection.options()).option("query", sql).load()


def table_frame(spark: SparkSession, connection: Connection, source: str) -> DataFrame:
    """A whole table as one lazy scan."""
    return spark.read.format("jdbc").options(**connection.options()).option("dbtable", source).load()


def range_frame(spark: SparkSession, connection: Connection, source: str, predicates: Sequence[str]) -> DataFrame:
    """One source query, and one partition, per predicate, in their order."""
    properties = {k: v for k, v in connection.options().items() if k != "url"}
    return spark.read.jdbc(connection.url, source, predicates=list(predicates), properties=properties)


def chunk_scan(spark: SparkSession, connection: Connection, table: str, chunks: Sequence[Chunk]) -> DataFrame:
    """The rows of several chunks in one frame; one source query and one task per part of a chunk."""
    by_source: dict[str, list[Chunk]] = {}
    for chunk in chunks:
        if chunk.predicate is not None:
            by_source.setdefault(chunk.source or table, []).append(chunk)
    frames = []
    for source, some in by_source.items():
        parts = [(c.iteration, part) for c in some for part in c.parts or (c.predicate,)]
        reader = range_frame(spark, connection, source, [part for _, part in parts])
        # the scan has exactly one partition per predicate, in order
        number = lookup([number for number, _ in parts], F.spark_partition_id())
        frames.append(reader.withColumn("iteration", number.cast("int")))
    for chunk in chunks:
        if chunk.predicate is None:
            frames.append(query_frame(spark, connection, chunk.query).withColumn("iteration", F.lit(chunk.iteration)))
    return reduce(DataFrame.union, frames)


def table_statistics(
    spark: SparkSession, connection: Connection, name: str, schema: T.StructType, columns: Sequence[str]
) -> DataFrame:
    """As ``validation.statistics`` of a database's table, computed there in one query; values in the types of ``schema``."""
    items, types = ["COUNT(*) AS n_rows"], {"n_rows": T.LongType()}
    for i, column in enumerate(columns):
        data_type = schema[column].dataType
        items.append(f"COUNT({vendors.quote(connection.vendor, column)}) AS filled{i}")
        types[f"filled{i}"] = T.LongType()
        if is_plain(data_type):
            for word, end in (("min", "low"), ("max", "high")):
                items.append(f"{vendors.extreme(connection.vendor, word, column, data_type)} AS {end}{i}")
                types[f"{end}{i}"] = data_type
    row = query_frame(spark, connection, f"SELECT {', '.join(items)} FROM {name}").toDF(*types)
    return row.select(*[F.col(n).cast(t).alias(n) for n, t in types.items()])


class JdbcTable:
    """A source table seen through its connection."""

    def __init__(self, spark: SparkSession, connection: Connection, spec: TableSpec, task_rows: int = TASK_ROWS):
        self.spark = spark
        self.connection = connection
        self.spec = spec
        self.vendor = connection.vendor
        self.task_rows = task_rows
        self.name = vendors.table_name(self.vendor, spec.table, spec.schema)

    def frame(self) -> DataFrame:
        """The whole table as one lazy scan; used for its schema."""
        return table_frame(self.spark, self.connection, self.name)

    def _query(self, sql: str) -> DataFrame:
        return query_frame(self.spark, self.connection, sql)

    def _catalog(self, sql: str) -> DataFrame:
        names = {
            "database": vendors.text_literal(self.vendor, self.spec.database),
            "schema": vendors.text_literal(self.vendor, self.spec.schema or ""),
            "table": vendors.text_literal(self.vendor, self.spec.table),
        }
        return self._query(sql.format(**names))

    def profile(self) -> tuple[int, float, float]:
        """Exact row count, size in MB (a default if the catalog has none) and MB per row."""
        counts = self._query(f"SELECT COUNT(*) AS table_count FROM {self.name}").select(
            F.lit(self.spec.table_key).alias("table_key"), F.col("table_count").cast("bigint").alias("table_count")
        )
        sizes = self._catalog(vendors.CATALOG[self.vendor].size).select(
            F.lit(self.spec.table_key).alias("table_key"),
            F.col("table_size_mb").cast("double").alias("table_size_mb"),
        )
        row = profile.profile_from_metadata(counts, sizes).first()
        return row["table_count"], row["table_size_mb"], row["avg_row_size_mb"]

    def key_columns(self) -> list[str]:
        rows = self._catalog(vendors.CATALOG[self.vendor].keys).select(
            F.lit(self.spec.table_key).alias("table_key"), "column_name", "ordinal_position"
        )
        return [r["column_name"] for r in discovery.key_columns(rows).orderBy("key_position").collect()]

    def index_columns(self) -> list[str]:
        rows = self._catalog(vendors.CATALOG[self.vendor].indexes).select(
            F.lit(self.spec.table_key).alias("table_key"), "indexed_column", "position"
        )
        found = discovery.index_columns(rows, signed_lists=self.vendor == "ibm")
        return [r["column_name"] for r in found.orderBy("index_position").collect()]

    def partitions(self) -> list[str]:
        """Partition names; a single one does not count as a partitioning."""
        sql = vendors.CATALOG[self.vendor].partitions
        if sql is None:
            return []
        names = {r["partition_name"] for r in self._catalog(sql).select("partition_name").collect()}
        return sorted(names) if len(names) >= 2 else []

    def plan(self, cluster_threshold_mb: float) -> ChunkPlan:
        """Profile, discover, choose the strategy and lay out the chunks."""
        taken = [c for c in self.frame().columns if c.lower() == "iteration" or c.startswith(RESERVED)]
        if taken:
            raise ValueError(f"columns {taken} of {self.spec.table} have names that chunks use; read them under others")
        count, size_mb, average = self.profile()
        if count < 1:
            return ChunkPlan("empty", 0, 1, ())
        sized = self.spark.range(1).select(
            F.lit(self.spec.table_key).alias("table_key"),
            F.lit(count).cast("bigint").alias("table_count"),
            F.lit(float(average)).alias("avg_row_size_mb"),
        )
        rows = profile.chunk_sizing(sized, cluster_threshold_mb).first()["chunk_rows"]
        keys = self.key_columns()
        indexes = [] if keys else self.index_columns()
        partitions = [] if keys or indexes else self.partitions()
        decided = "yes" if indexes and self._packs(indexes[0], rows) else "no"
        facts = self.spark.range(1).select(
            F.lit(self.vendor).alias("vendor"),
            F.lit(len(keys)).alias("n_key_columns"),
            F.lit(len(indexes)).alias("n_index_columns"),
            F.lit(decided).alias("decision"),
            F.lit(len(partitions)).alias("n_partitions"),
        )
        strategy = decision.strategy_selection(facts).first()["strategy"]
        chunks = {
            "clustered": lambda: self._key_chunks(keys, rows, count),
            "composite_clustered": lambda: self._key_chunks(keys, rows, count),
            "non_clustered": lambda: self._index_chunks(indexes[0], rows),
            "non_clustered_limit_offset": lambda: self._pages(self.name, indexes, rows, count, 0),
            "partition": lambda: self._partition_chunks(partitions, rows),
            "limit_offset": lambda: self._pages(self.name, [], rows, count, 0),
        }[strategy]()
        return ChunkPlan(strategy, count, rows, tuple(chunks))

    def _value_counts(self, column: str) -> DataFrame:
        """Rows per index value, counted by the source once and kept in shared storage for the plan."""
        name = vendors.quote(self.vendor, column)
        sql = f"SELECT {name} AS value_of_index, COUNT(*) AS rows_of_value FROM {self.name} GROUP BY {name}"
        ranking.ensure_checkpoint_dir(self.spark)
        return self._query(sql).toDF("v", "n").withColumn("n", F.col("n").cast("bigint")).checkpoint()

    def _packs(self, column: str, rows: int) -> bool:
        """Whether whole values of the column fit into chunks; counted by the source, which returns one row."""
        sql = vendors.value_statistics_query(self.vendor, self.name, self._fields([column])[0])
        stats = self._query(sql).toDF("n_rows", "n_values", "max_rows")
        stats = stats.select(*[F.col(c).cast("bigint").alias(c) for c in stats.columns])
        return decision.index_decision(stats, rows).first()["decision"] == "yes"

    def _fields(self, keys: Sequence[str]) -> list[T.StructField]:
        schema = self.frame().schema
        return [schema[k] for k in keys]

    def _key_frame(self, keys: Sequence[str], count: int) -> DataFrame:
        """Key columns only, read in parallel strides of a numeric leading key, written once to shared storage."""
        frame = self.frame().select(*[quoted(k) for k in keys])
        scans = -(-count // KEY_SCAN_ROWS)
        if scans > 1 and isinstance(frame.schema[keys[0]].dataType, T.IntegralType):
            name = vendors.quote(self.vendor, keys[0])
            ends = self._query(f"SELECT MIN({name}) AS lo, MAX({name}) AS hi FROM {self.name}").toDF("lo", "hi").first()
            frame = (
                self.spark.read.format("jdbc")
                .options(**self.connection.options())
                .options(dbtable=self.name, partitionColumn=name, numPartitions=str(scans))
                .options(lowerBound=str(ends["lo"]), upperBound=str(ends["hi"]))
                .load()
                .select(*[quoted(k) for k in keys])
            )
        ranking.ensure_checkpoint_dir(self.spark)
        return frame.checkpoint()

    def _key_chunks(self, keys: list[str], rows: int, count: int) -> list[Chunk]:
        fields = [T.StructField(f.name, f.dataType, False) for f in self._fields(keys)]
        # several borders inside each chunk: a chunk is what restarts, its parts are what tasks read
        part = min(rows, self.task_rows)
        tasks = -(-rows // part)
        sql = vendors.boundary_query(self.vendor, self.name, keys, rows, part)
        if sql is not None:
            found = self._query(sql)
            texts = [key_text(F.col(quoted(k)), found.schema[k].dataType).alias(f"c{i}") for i, k in enumerate(keys)]
            borders = found.orderBy("rn").select(*texts).collect()
            lows = [tuple(r) for r in borders]
            return self._range_chunks(fields, lows, source_order=True, tasks=tasks)
        frame = self._key_frame(keys, count)
        tasks = next(n for n in range(tasks, 0, -1) if rows % n == 0)  # pages are of one size here
        edges = ranking.page_edges(frame, keys, rows // tasks, unique=True)
        texts = [key_text(F.col("lo")[k], frame.schema[k].dataType).alias(f"c{i}") for i, k in enumerate(keys)]
        borders = edges.orderBy("iteration").select(*texts).collect()
        return self._range_chunks(fields, [tuple(r) for r in borders], tasks=tasks)

    def _range_chunks(
        self, fields: list[T.StructField], lows: list[tuple], first: int = 0, source_order: bool = False, tasks: int = 1
    ) -> list[Chunk]:
        """Ranges in the order the borders were found in: the source's own, or Spark's binary one."""
        found = ranges(self.vendor, fields, lows[::tasks], binary=not source_order)
        if tasks == 1:
            return [self._where(first + i, text) for i, text in enumerate(found)]
        parts = ranges(self.vendor, fields, lows, binary=not source_order)
        return [
            self._where(first + i, text, tuple(parts[i * tasks : (i + 1) * tasks])) for i, text in enumerate(found)
        ]

    def _where(self, iteration: int, predicate: str, parts: tuple[str, ...] = ()) -> Chunk:
        return Chunk(iteration, f"SELECT * FROM {self.name} WHERE {predicate}", predicate, parts)

    def _index_chunks(self, column: str, rows: int) -> list[Chunk]:
        """Packed values; a chunk's parts begin at values too, about ``task_rows`` rows apart."""
        listed = self._packed_lows(column, rows, min(rows, self.task_rows))
        field_ = self._fields([column])[0]
        name = vendors.quote(self.vendor, column)
        chunks = []
        if field_.nullable:
            # also planned when no NULL exists yet: rows may arrive while the job runs
            chunks.append(self._where(0, f"{name} IS NULL"))
        filled = T.StructField(field_.name, field_.dataType, False)
        parts = iter(ranges(self.vendor, [filled], [(v,) for lows in listed for v in lows]))
        whole = ranges(self.vendor, [filled], [(lows[0],) for lows in listed])
        present = f"{name} IS NOT NULL AND "
        for lows, predicate in zip(listed, whole):
            inside = tuple(present + next(parts) for _ in lows)
            chunks.append(self._where(len(chunks), present + predicate, inside if len(inside) > 1 else ()))
        return chunks

    def _packed_lows(self, column: str, rows: int, part_rows: int) -> list[list[str]]:
        """Per chunk the values, as text, at which its parts begin; found by the source, or by Spark where that cannot."""
        field_ = self._fields([column])[0]
        sql = vendors.value_border_query(self.vendor, self.name, field_, rows, part_rows)
        if sql is None:
            manifest = chunking.pack_values(self._value_counts(column), column, rows, part_rows)
            lo = f"lo_{column}"
            text = lambda c: key_text(c, manifest.schema[lo].dataType)
            found = manifest.filter(F.col(quoted(lo)).isNotNull()).orderBy("iteration")
            return [r["lows"] for r in found.select(F.transform("part_lows", text).alias("lows")).collect()]
        found = self._query(sql).toDF("v", "chunk_start", "place").orderBy("place")
        listed: list[list[str]] = []
        for row in found.select(key_text(F.col("v"), field_.dataType).alias("v"), F.col("chunk_start").cast("int").alias("new")).collect():
            if row["new"]:
                listed.append([])
            listed[-1].append(row["v"])
        return listed

    def _pages(self, source: str, leading: Sequence[str], rows: int, count: int, first: int) -> list[Chunk]:
        """Pages under a total order of the columns that have one, cut at borders that the source finds in one query.

        A page is a key range. Where a run of full copies is cut, the page is its range and the copies on either side of it,
        counted by offset inside the run: copies are alike, so it does not matter which of them a page gets. In tables with
        columns that have no order rows of a run may differ; there a run stays whole, in one page.
        """
        fields = [self.frame().schema[n] for n in leading]
        fields += [f for f in self.frame().schema if f.name not in leading and is_plain(f.dataType)]
        loose = (T.FloatType, T.DoubleType)  # 0.0 and -0.0 are equal, but no copies
        cut_runs = all(is_plain(f.dataType) and not isinstance(f.dataType, loose) for f in self.frame().schema)
        part = min(rows, self.task_rows)
        sql = vendors.page_border_query(self.vendor, source, fields, rows, part) if fields else None
        if sql is None:
            return self._offset_pages(source, [f.name for f in fields], rows, count, first)
        keys = [key_text(F.col(f"k{i}"), f.dataType).alias(f"k{i}") for i, f in enumerate(fields)]
        numbers = [F.col(n).cast("bigint").alias(n) for n in ("ordinal", "page_start")]
        found = self._query(sql).orderBy("rn").select(*keys, *numbers).collect()
        borders = [paging.Border(tuple(r)[:-2], *tuple(r)[-2:]) for r in found]
        item, condition = vendors.filtered(source)
        try:
            pages = paging.pages(self.vendor, fields, borders, cut_runs, rows, condition)
        except paging.NoLiteral:
            return self._offset_pages(source, [f.name for f in fields], rows, count, first)
        return [
            Chunk(first + i, page.query(self.vendor, item), page.predicate, page.parts, None if item == self.name else item)
            for i, page in enumerate(pages)
        ]

    def _offset_pages(self, source: str, names: Sequence[str], rows: int, count: int, first: int) -> list[Chunk]:
        """For sources that cannot number rows, and borders that have no literal."""
        columns = [vendors.quote(self.vendor, n) for n in names]
        return [
            Chunk(first + i, vendors.page_query(self.vendor, source, columns, i * rows, rows)) for i in range(-(-count // rows))
        ]

    def _partition_chunks(self, partitions: list[str], rows: int) -> list[Chunk]:
        sources = [
            vendors.partition_source(self.vendor, self.spec.table, self.spec.schema, p) for p in partitions
        ]
        counted = [
            self._query(f"SELECT COUNT(*) AS n FROM {s}").select(F.lit(i).alias("i"), F.col("n").cast("bigint").alias("n"))
            for i, s in enumerate(sources)
        ]
        sizes = {r["i"]: r["n"] for r in reduce(DataFrame.unionByName, counted).collect()}
        chunks: list[Chunk] = []
        for i, source in enumerate(sources):
            if sizes[i] <= min(rows, self.task_rows):
                chunks.append(Chunk(len(chunks), f"SELECT * FROM {source}"))
            else:
                chunks += self._pages(source, [], rows, sizes[i], len(chunks))
        return chunks

    def statistics(self, columns: Sequence[str]) -> DataFrame:
        """As ``validation.statistics``, computed by the source in one query."""
        return table_statistics(self.spark, self.connection, self.name, self.frame().schema, columns)
