"""Substring dedup by seed and extend on winnowed anchors.

A repeat is a run of at least `length` words that also starts earlier: in a document with a smaller id, or before in the same
document. Words of later starts go; what is a repeat is judged on the input, never on what is left.

Seeds. Of all `anchor`-word grams of a window of `length` words the one with the least hash (the first of equals) is its
anchor. Equal windows choose the same anchor at the same place, so documents that share a window share an anchor: about two of
`length - anchor + 2` positions are kept and nothing is lost. Neighbouring windows that choose the same anchor form one
occurrence; its context is all words that these windows hold.

Join and extension, coarse to fine, each step on what the one before left open:

1. Within a batch of documents, and then over all of them (one shuffle by anchor): occurrences of equal context are equal in
   all their windows, so all but the first are repeats. Anchors seen in one context only need nothing else.
2. Anchors seen in several contexts are where a match ends. The first occurrence of each context is extended both ways word by
   word: its windows are compared by themselves (one shuffle by window).
3. Repeated windows that touch or overlap are joined to maximal repeats, which are cut out of the text.

Hot groups. A batch sends one row per context, and for an anchor with several contexts in the batch one mark and the windows
themselves, each once; so an anchor, a context or a window that a third of all documents hold has as many rows as there are
batches. No pair of documents is ever made, and no group is collected.

Texts move only where they have to: to extend an occurrence, and to cut. A bitmap of fixed size (2 MB) keeps out most documents
that need neither; those that pass by chance are joined to nothing. They travel compressed.

Equality is that of two independent 64-bit sums of 128-bit word hashes. Null and empty texts have no words. Documents of fewer
than `length` words have no repeats. Rows with equal id and text are one document; rows that share an id but not the text are
ordered by a hash of the text; null ids come last. Long texts are handled whole, in the memory of one batch. An empty table
gives an empty table. Other columns of the input are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging
from haulage.llm.wordspans import slices, words_of

#: Words of a repeat at least, and of an anchor.
LENGTH, ANCHOR = 20, 8
#: Bits of the map of documents that are wanted, 64 to a row: a fixed 2 MB.
MAP_BITS = 1 << 24
#: Bytes of text that are taken together, about: what a task holds in arrays is some twenty times as much.
BATCH_BYTES = 6 << 20
#: Kinds of rows in `place` (start << 16 | number of windows << 2 | kind).
OCCURRENCE, MARK, WINDOW, REPEAT = range(4)
ROWS = "x long, y long, doc_id long, text_key long, place long"
#: Odd multipliers of the two rolling sums.
FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of sums of hashes; one to one."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class Rolling:
    """Hashes of any run of words of a sequence, each in constant time."""

    def __init__(self, hashes: np.ndarray, factor: int):
        powers = lambda base: np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(len(hashes), base, np.uint64)]))
        self.sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * powers(factor)[:-1], dtype=np.uint64)])
        self.back = powers(pow(factor, -1, 1 << 64))

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * self.back[starts])


class Sequence:
    """Words of a batch of texts with their rolling hashes."""

    def __init__(self, column: pa.Array):
        words = words_of(column)
        digests = b"".join(xxhash.xxh3_128_digest(word) for word in words.distinct.to_pylist())
        hashes = np.frombuffer(digests, np.uint64).reshape(-1, 2)[words.codes] if len(words.codes) else np.zeros((0, 2), np.uint64)
        self.first, self.second = (Rolling(np.ascontiguousarray(hashes[:, i]), FACTORS[i]) for i in range(2))
        self.texts = words.texts
        self.bounds = np.searchsorted(words.texts, np.arange(len(column) + 1))

    def occurrences(self, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, last window (both as word numbers) and anchor position of every occurrence."""
        n = len(self.texts)
        if n < length:
            return (np.zeros(0, np.int64),) * 3
        grams = np.arange(n - anchor + 1)
        hashes = self.first.runs(grams, grams + anchor)
        choices = length - anchor + 1
        starts = np.arange(n - length + 1)
        least, at = hashes[: len(starts)].copy(), np.zeros(len(starts), np.int64)
        for step in range(1, choices):
            other = hashes[step : step + len(starts)]
            less = other < least
            np.copyto(least, other, where=less)
            at[less] = step
        whole = self.texts[starts] == self.texts[starts + length - 1]
        starts, at = starts[whole], (starts + at)[whole]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (starts[1:] != starts[:-1] + 1)
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(at)) - 1 if len(at) else first
        return starts[first], starts[last], at[first]


def first_of_each(order: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows sorted by keys and order, and which of them are the first of their keys."""
    by = np.lexsort((order, *reversed(keys)))
    first = np.ones(len(by), bool)
    if len(by):
        same = np.ones(len(by) - 1, bool)
        for key in keys:
            same &= key[by][1:] == key[by][:-1]
        first[1:] = ~same
    return by, first


class Batch:
    """Documents of one batch, each (id, text) once, and the rows made of them."""

    def __init__(self, ids: pa.Array, keys: np.ndarray, texts: pa.Array):
        self.ids, self.keys = ids, keys
        self.known = ~np.asarray(ids.is_null())
        self.numbers = ids.fill_null(0).to_numpy(zero_copy_only=False)
        by, first = first_of_each(np.arange(len(keys)), ~self.known, self.numbers, keys)
        self.single = np.zeros(len(keys), bool)
        self.single[by[first]] = True
        self.rank = np.empty(len(keys), np.int64)
        self.rank[by] = np.arange(len(keys))
        self.words = Sequence(texts)

    def rows(self, kind: int, x: np.ndarray, y: np.ndarray, at: np.ndarray, count) -> pa.RecordBatch:
        """Rows of the occurrences or windows that begin at the words `at`."""
        text = self.words.texts[at]
        place = ((at - self.words.bounds[text]) << 16) | (np.broadcast_to(count, at.shape) << 2) | kind
        if kind == REPEAT:  # compared with nothing any more: dealt out evenly
            x, y = mixed(self.keys[text].view(np.uint64) ^ mixed(place.astype(np.uint64))), np.zeros(len(at), np.uint64)
        values = [v.view(np.int64) for v in (x, y)]
        columns = [pa.array(values[0]), pa.array(values[1]), self.ids.take(pa.array(text)), pa.array(self.keys[text]), pa.array(place)]
        return pa.RecordBatch.from_arrays(columns, names=["x", "y", "doc_id", "text_key", "place"])

    def order(self, at: np.ndarray) -> np.ndarray:
        """Place among all words of the batch, documents by rank."""
        return (self.rank[self.words.texts[at]] << 40) | (at - self.words.bounds[self.words.texts[at]])

    def windows(self, at: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
        """The windows that begin at `at`: the first of each equal ones, the others as repeats."""
        one, two = self.words.first.runs(at, at + length), self.words.second.runs(at, at + length)
        by, first = first_of_each(self.order(at), one, two)
        yield self.rows(WINDOW, one[by[first]], two[by[first]], at[by[first]], 1)
        yield self.rows(REPEAT, one[by[~first]], two[by[~first]], at[by[~first]], 1)


def exploded(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """first, first + 1, … (count of them) for each."""
    within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    return np.repeat(first, count) + within


def seeds_of(batch: Batch, length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    first, last, at = batch.words.occurrences(length, anchor)
    single = batch.single[batch.words.texts[first]]
    first, last, at = first[single], last[single], at[single]
    count = last - first + 1
    seeds = batch.words.first.runs(at, at + anchor)
    shape = mixed((at - first).astype(np.uint64) << np.uint64(32) | count.astype(np.uint64))
    contexts = batch.words.second.runs(first, last + length) ^ shape
    by, new = first_of_each(batch.order(first), seeds, contexts)
    again, kept = by[~new], by[new]
    yield batch.rows(REPEAT, seeds[again], contexts[again], first[again], count[again])
    # Runs of one anchor among the contexts that are left.
    start = np.ones(len(kept), bool)
    start[1:] = seeds[kept][1:] != seeds[kept][:-1]
    group = np.cumsum(start) - 1
    several = (np.bincount(group, minlength=1) > 1)[group] if len(kept) else start
    alone, marks, open_ = kept[~several], kept[several & start], kept[several]
    yield batch.rows(OCCURRENCE, seeds[alone], contexts[alone], first[alone], count[alone])
    yield batch.rows(MARK, seeds[marks], contexts[marks], first[marks], 0)
    yield from batch.windows(exploded(first[open_], count[open_]), length)


def seeded(docs: DataFrame, length: int, anchor: int) -> DataFrame:
    """Anchor occurrences, marks, windows and repeats of every batch. docs: doc_id, text_key, text."""

    def seed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, size in slices(batch.column(2), BATCH_BYTES):
                part = batch.slice(start, size)
                yield from seeds_of(Batch(part.column(0), part.column(1).to_numpy(), part.column(2)), length, anchor)

    return docs.mapInArrow(seed, ROWS)


def extended(found: DataFrame, length: int) -> DataFrame:
    """Windows and repeats of documents' open occurrences. found: doc_id, text_key, body, places."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            # Compressed texts: a third of the bytes, so that the texts of a slice come to about BATCH_BYTES.
            for start, size in slices(batch.column(2), BATCH_BYTES // 3):
                part = batch.slice(start, size)
                texts = pa.array([inflate(x) for x in part.column(2).to_pylist()], pa.large_binary())
                docs_of = Batch(part.column(0), part.column(1).to_numpy(), texts)
                places = part.column(3)
                text = np.repeat(np.arange(len(places)), np.diff(places.offsets.to_numpy()))
                place = places.flatten().to_numpy()
                mine = docs_of.single[text]
                text, place = text[mine], place[mine]
                starts = exploded((place >> 16) + docs_of.words.bounds[text], (place >> 2) & 0x3FFF)
                yield from docs_of.windows(np.unique(starts), length)

    return found.mapInArrow(extend, ROWS)


def compared(rows: DataFrame) -> DataFrame:
    """Rows with `later`: not the first of its anchor and context, or of its window."""
    kind = F.col("place").bitwiseAND(3)
    order = Window.partitionBy("x", "y", kind).orderBy(F.col("doc_id").asc_nulls_last(), "text_key", F.shiftright("place", 16))
    return rows.withColumn("kind", kind).withColumn("later", (F.rank().over(order) > 1) & kind.isin(OCCURRENCE, WINDOW))


def wanted(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """docs with `hit`: false only for documents that are not among keys (doc_id, text_key)."""
    bit = F.pmod(F.xxhash64(F.lit(5), "doc_id", "text_key"), F.lit(MAP_BITS))
    words = keys.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("cell"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 64) AS int))")).alias("bits"))
    marked = docs.withColumn("bit", bit).withColumn("cell", F.shiftright("bit", 6))
    # At most MAP_BITS / 64 rows, whatever the input.
    joined = marked.join(F.broadcast(words), "cell", "left")
    hit = F.col("bits").isNotNull() & (F.expr("shiftrightunsigned(bits, cast(pmod(bit, 64) AS int))").bitwiseAND(1) == 1)
    return joined.withColumn("hit", hit).drop("cell", "bit", "bits")


def plain(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def squeezed(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, and either the compressed text (a hit) or the number of words and the digest of the whole text."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        deflate = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            texts, hits = batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()
            words = [None if hit else text.split() for text, hit in zip(texts, hits)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([None if w is None else len(w) for w in words], pa.int64()),
                    pa.array([None if w is None else hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
                    pa.array([deflate(text) if hit else None for text, hit in zip(texts, hits)], pa.binary()),
                ],
                names=["doc_id", "text_key", "n_words", "digest", "body"],
            )

    return docs.select("doc_id", "text_key", "text", "hit").mapInArrow(
        squeeze, "doc_id long, text_key long, n_words long, digest string, body binary"
    )


def by_document(rows: DataFrame, name: str) -> DataFrame:
    """The places of each document, as many as it has words at most."""
    return rows.groupBy("doc_id", "text_key").agg(F.collect_set("place").alias(name))


def same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def joined_to(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Documents with their places; sorted by both sides, so that neither is held in memory."""
    return docs.alias("d").join(lists.hint("merge").alias("l"), same_document("d", "l"), how).select("d.*", "l.places")


def repeat_places(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, text_key, places: the repeated windows of each document, neighbours counted in one place. docs as `plain` gives."""
    every = Window.partitionBy("x")
    occurrence, mark = F.col("kind") == OCCURRENCE, F.col("kind") == MARK
    # How many contexts an anchor has over all: least and greatest differ, or a batch saw several.
    judged = compared(seeded(docs, length, anchor).repartition("x"))
    judged = (
        judged.withColumn("least", F.min(F.when(occurrence, F.col("y"))).over(every))
        .withColumn("most", F.max(F.when(occurrence, F.col("y"))).over(every))
        .withColumn("marked", F.max(mark).over(every))
    )
    verdict = (
        F.when((F.col("kind") == REPEAT) | F.col("later"), REPEAT)
        .when(F.col("kind") == WINDOW, WINDOW)
        .when(occurrence & (F.col("marked") | (F.col("least") != F.col("most"))), OCCURRENCE)
    )
    judged = judged.withColumn("verdict", verdict).filter(F.col("verdict").isNotNull())
    judged = staging.staged(judged.select("x", "y", "doc_id", "text_key", "place", "verdict"), "substring-seeds")
    of = lambda kind: judged.filter(F.col("verdict") == kind).select("x", "y", "doc_id", "text_key", "place")

    open_ = staging.staged(by_document(of(OCCURRENCE), "places"), "substring-open")
    texts = squeezed(wanted(docs, open_).filter("hit")).select("doc_id", "text_key", "body")
    windows = extended(joined_to(texts, open_, "inner").select("doc_id", "text_key", "body", "places"), length).unionByName(of(WINDOW))
    late = compared(windows).filter(F.col("later") | (F.col("kind") == REPEAT)).select("doc_id", "text_key", "place")
    return staging.staged(by_document(of(REPEAT).select("doc_id", "text_key", "place").unionByName(late), "places"), "substring-repeats")


def maximal(places: list[int] | None, length: int) -> list[tuple[int, int]]:
    """Word spans (start, end) of maximal repeats, in order."""
    spans: list[list[int]] = []
    for place in sorted(places or ()):
        start, end = place >> 16, (place >> 16) + ((place >> 2) & 0x3FFF) - 1 + length
        if spans and start <= spans[-1][1]:
            spans[-1][1] = max(spans[-1][1], end)
        else:
            spans.append([start, end])
    return [tuple(s) for s in spans]


def without_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    anchor: int = ANCHOR,
    id_column: str = "doc_id",
    text_column: str = "text",
    keep_text: bool = True,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, spans (removed words, [start, end) each) and, for documents that lost words, text.

    One row per row of docs. text: the kept words with one space between them; null where nothing was removed, or not asked for.
    """
    if not 1 <= anchor <= length:
        raise ValueError("an anchor has between one and `length` words")
    rows = plain(docs, id_column, text_column)
    lists = repeat_places(rows, length, anchor)
    carried = squeezed(wanted(rows, lists))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inflate = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for doc_id, n_words, digest, body, places in zip(*(c.to_pylist() for c in batch.columns)):
                spans, text = [], None
                if body is not None:
                    words = inflate(body).split()
                    keep = np.ones(len(words), bool)
                    for a, b in (spans := maximal(places, length)):
                        keep[a:b] = False
                    kept = b" ".join(compress(words, keep))
                    n_words, digest = len(words), hashlib.sha256(kept).hexdigest()
                    text = kept.decode() if spans and keep_text else None
                removed = sum(b - a for a, b in spans)
                out.append((doc_id, n_words, removed, digest, [{"start": a, "end": b} for a, b in spans], text))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(span), pa.string())
            names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 6, kinds)], names=names)

    found = joined_to(carried, lists, "left").select("doc_id", "n_words", "digest", "body", "places")
    return found.mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<start:long,end:long>>, text string"
    )
