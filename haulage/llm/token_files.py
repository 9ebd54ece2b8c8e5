"""Token ids in a binary format: blocks of ids turned into planes, every plane compressed by itself.

Format. A chunk holds whole documents in ascending order of doc_id, cut once it has `chunk_ids` ids. Its ids are
handled in blocks of `block_ids` (the last may be shorter). A block of n ids is transposed: with byte planes, plane p
holds byte p of all n ids (4 planes); with bit planes, plane p holds bit p of all n ids, packed (32 planes). Every
plane is one zstandard frame. `payload` is the frames of all blocks one after the other, plane 0 first; the chunk index
`frame_ends` (end of each frame in the payload) lets a reader fetch any id range by decoding the blocks it touches.
A plane that is zero throughout is an empty frame.

Files. Chunks are rows of a Parquet table in the shared folder (plain encoding: the payload is compressed already), so
writing is committed task by task on any store, and a reader of the index does not touch payloads. File part p holds
a range of doc_ids below that of part p + 1.

Null texts count as empty. Documents with one id (repeated rows) keep all copies, next to each other. Columns beyond
the named ones are not read. An empty table gives an empty table of chunks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulage.llm import staging, tokens

CHUNK = (
    "part int, chunk int, n_ids long, block_ids int, planes string, "
    "doc_ids array<long>, doc_tokens array<long>, frame_ends array<long>, payload binary"
)
PLANES = {"byte": 4, "bit": 32}


def to_planes(ids: np.ndarray, planes: str) -> np.ndarray:
    """A block of ids as a row of bytes for each plane."""
    as_bytes = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == "byte":
        return np.ascontiguousarray(as_bytes.T)
    bits = np.unpackbits(as_bytes, axis=1, bitorder="little")
    return np.packbits(bits.T, axis=1, bitorder="little")


def from_planes(rows: np.ndarray, n: int, planes: str) -> np.ndarray:
    if planes == "byte":
        return np.ascontiguousarray(rows.T).view("<u4").reshape(-1)
    bits = np.unpackbits(rows, axis=1, count=n, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view("<u4").reshape(-1)


def encode_chunk(ids: np.ndarray, block_ids: int, planes: str, level: int = 3) -> tuple[bytes, list[int]]:
    compressor = zstandard.ZstdCompressor(level=level)
    frames, ends, end = [], [], 0
    for at in range(0, len(ids), block_ids):
        for plane in to_planes(ids[at : at + block_ids], planes):
            frame = compressor.compress(plane.tobytes()) if plane.any() else b""
            frames.append(frame)
            end += len(frame)
            ends.append(end)
    return b"".join(frames), ends


def decode_ids(payload: bytes, ends: list[int], n_ids: int, block_ids: int, planes: str, first=0, last=None):
    """The ids first to last (exclusive) of a chunk; only blocks that hold some of them are decoded."""
    last = n_ids if last is None else min(last, n_ids)
    if first >= last:
        return np.empty(0, "<u4")
    decompressor, count, found = zstandard.ZstdDecompressor(), PLANES[planes], []
    for block in range(first // block_ids, (last - 1) // block_ids + 1):
        n = min(block_ids, n_ids - block * block_ids)
        width = n if planes == "byte" else -(-n // 8)
        rows = np.zeros((count, width), np.uint8)
        for p in range(count):
            k = block * count + p
            frame = payload[ends[k - 1] if k else 0 : ends[k]]
            if frame:
                rows[p] = np.frombuffer(decompressor.decompress(frame, max_output_size=width), np.uint8)
        found.append(from_planes(rows, n, planes))
    base = first // block_ids * block_ids
    return np.concatenate(found)[first - base : last - base]


def write(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 2,
    vocabulary: str | None = None,
    planes: str = "byte",
    block_ids: int = 65_536,
    chunk_ids: int = 262_144,
) -> None:
    """Encode every text, append end_id, and write the chunks to path.

    Texts are dealt out by ranges of (doc_id, hash of the text), so that even one id with a third of the rows is
    split over tasks, and sorted inside each range; nothing is sorted in one task.
    """
    vocabulary = vocabulary or tokens.default_vocabulary()

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, number = tokens.encoder(vocabulary), TaskContext.get().partitionId(), 0
        names: list = []
        parts: list[np.ndarray] = []
        size = 0

        def close():
            nonlocal names, parts, size, number
            ids = np.concatenate(parts)
            payload, ends = encode_chunk(ids, block_ids, planes)
            lengths = [len(x) for x in parts]
            row = (part, number, len(ids), block_ids, planes, names, lengths, ends, payload)
            names, parts, size, number = [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, TYPES)], names=NAMES)

        for batch in batches:
            keys, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for a, b in tokens.slices(texts):
                for key, ids in zip(keys[a:b], encoder.encode([text or "" for text in texts[a:b]])):
                    names.append(key)
                    parts.append(np.append(ids, np.uint32(end_id)))
                    size += len(parts[-1])
                    if size >= chunk_ids:
                        yield close()
        if parts:
            yield close()

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"), F.xxhash64(text_column).alias("h")
    )
    ordered = rows.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text").select("doc_id", "text")
    ordered.mapInArrow(chunks, CHUNK).write.option("compression", "none").parquet(path)


NAMES = ["part", "chunk", "n_ids", "block_ids", "planes", "doc_ids", "doc_tokens", "frame_ends", "payload"]
TYPES = (
    pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.string(),
    pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(),
)


def index(spark: SparkSession, path: str) -> DataFrame:
    """The chunk index: position of every chunk in the stream of all ids. One row per chunk, no payload is read.

    Parts are summed first; the running sum over parts has one row for each output file.
    """
    chunks = spark.read.schema(CHUNK).parquet(path).select("part", "chunk", "n_ids", "block_ids", "planes", "frame_ends")
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("part_start"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("chunk")) - F.col("n_ids")
    return chunks.withColumn("inside", inside).join(before, "part").selectExpr(
        "part", "chunk", "part_start + inside AS chunk_start", "n_ids", "block_ids", "planes", "frame_ends"
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """Per document, decoded from the files: doc_id, start, n_tokens, ids (little-endian unsigned 32 bit), ids_crc32."""

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {name: batch.column(name)[row].as_py() for name in batch.schema.names}
                ids = decode_ids(r["payload"], r["frame_ends"], r["n_ids"], r["block_ids"], r["planes"])
                lengths = np.array(r["doc_tokens"], np.int64)
                starts = np.cumsum(lengths) - lengths
                bodies = [ids[a : a + n].astype("<u4").tobytes() for a, n in zip(starts.tolist(), lengths.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(r["doc_ids"], pa.int64()),
                        pa.array(starts + r["chunk_start"], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array(bodies, pa.binary()),
                        pa.array([zlib.crc32(body) for body in bodies], pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids", "ids_crc32"],
                )

    where = index(spark, path).select("part", "chunk", "chunk_start")
    chunks = spark.read.schema(CHUNK).parquet(path).join(where, ["part", "chunk"])
    return chunks.mapInArrow(decode, "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long")


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write docs in the format to a new folder among the shared ones and read them back."""
    spark = docs.sparkSession
    path = staging.new_path(spark, "token-files")
    write(docs, path, **options)
    return read(spark, path)
