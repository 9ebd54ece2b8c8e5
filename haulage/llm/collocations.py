"""Phrase collocations from count streams in prefix and suffix order.

f(phrase) is the number of its contiguous occurrences inside pieces of text, n the number of all words of its language. A
candidate has 2 to MOST_WORDS words and f >= least. Cut after its first k words, it scores floor(1000 * f * n / (l * r)) with
l = f(first part), r = f(rest); the lowest-scoring cut counts. Candidates that stand inside a longer one just as often are dropped.

Layout, nothing of which is held in memory or in a hash table that grows with the text:

1. Chunks. Texts of one language become blocks of word codes with their own dictionary, written once.
2. Thinning. Each chunk sends its distinct word pairs with their counts; the sums over all chunks (one shuffle by pair) tell
   each chunk which of its pairs reach `least`, and it is cut at all others; what is left of several chunks becomes one; then the
   same for triples. No longer phrase can
   reach `least` unless all its pairs and triples do. They go by 64-bit hashes: equal hashes can only keep too many, and the
   counts that follow are exact.
3. Prefix order. Every position that is left gives the window of up to MOST_WORDS words that begins there. Windows are merged within the chunk, range-partitioned and sorted: occurrences of a phrase are then a run of windows that begin with it, and
   one pass with one open count per length gives f of all phrases of all lengths. Runs that touch the border of a partition are
   added up afterwards, at most 2 * MOST_WORDS per partition.
4. Lockstep merge joins. Cuts of candidates are sorted by their first part (prefix order) and merged with the count stream, then
   by their rest (suffix order) and merged again; extensions by one word to the left and right are merged with the candidates.
   A phrase contained as often in any longer candidate is contained as often in one that is longer by one word, since counts
   cannot grow with length.

Hot groups. A pair, triple or window has one row per chunk at most. Cuts with a common first part or rest are salted, the count stream
holds a copy per salt. The best of a language are kept per task before they meet.

Letters A-Z are lower-cased. Pieces end at .,;:!? and the bytes 0x0A to 0x0D, words at 0x20 and 0x09. Null texts are empty; a null
language is `und`. Repeated rows and documents count again. Equal scores are ordered by f, then by the phrase's bytes. Empty
tables give no rows. Other columns are not looked at.

Memory. A task holds a batch of texts and, per language, the codes (4 bytes a word) and distinct words of one open chunk. Words are
looked for in stretches of SLICE_BYTES, also within a long text; hashes and windows of a chunk are made and sent ROWS at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulage.llm import staging
from haulage.llm.substring import mixed
from haulage.llm.wordspans import coded, joined, slices, spans

LEAST, MOST_WORDS, PER_LANGUAGE = 100, 5, 2_000
#: Bytes of text in a chunk, about.
CHUNK_BYTES = 24 << 20
#: Words of a chunk that is put together of thinned ones, about.
CHUNK_WORDS = 3_000_000
#: Bytes of text whose words are looked for at once; positions and rows of a chunk that are worked on or sent at once.
SLICE_BYTES, ROWS = 2 << 20, 50_000
#: Copies of the count stream that cuts with a common part are dealt to.
SALTS = 16
PIECE_ENDS = np.zeros(256, bool)
PIECE_ENDS[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
WORD_ENDS = PIECE_ENDS.copy()
WORD_ENDS[[0x20, 0x09]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CHUNK = "part int, number int, lang string, n_words long, words array<string>, counts array<bigint>, codes binary"


def stretches(whole: np.ndarray) -> Iterator[np.ndarray]:
    """whole in parts of about SLICE_BYTES, each up to the end of a piece or, in longer pieces, to the end of a word."""
    at = 0
    while at < len(whole):
        end = at + SLICE_BYTES
        while end < len(whole):
            found = next((x for x in (np.flatnonzero(ends[whole[at:end]]) for ends in (PIECE_ENDS, WORD_ENDS)) if len(x)), ())
            if len(found):
                end = at + int(found[-1]) + 1
                break
            end += end - at  # a word longer than that
        yield whole[at:end]
        at = end


class Coding:
    """A chunk while its texts come in."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, whole: np.ndarray) -> None:
        """Words of a stretch, which ends with a byte of WORD_ENDS."""
        self.size += len(whole)
        starts, ends = spans(whole, WORD_ENDS)
        if self.parts and PIECE_ENDS[whole[: starts[0] if len(starts) else None]].any():
            self.parts[-1][-1] |= 1
        if not len(starts):
            return
        codes, distinct = coded(whole, starts, ends)
        numbers = self.numbers
        number = np.array([numbers.setdefault(word, len(numbers)) for word in distinct.to_pylist()], np.uint32)
        pieces = np.cumsum(PIECE_ENDS[whole], dtype=np.int32)
        last = np.diff(pieces[starts], append=pieces[-1]) > 0
        self.parts.append(number[codes] * 2 + last)

    def row(self, lang: str, part: int, number: int) -> pa.RecordBatch:
        codes = np.concatenate(self.parts)
        self.parts.clear()
        return Chunk(lang, [word.decode() for word in self.numbers], (codes >> 1).astype(np.int32), (codes & 1).astype(bool)).row(part, number)


def encoded(docs: DataFrame) -> DataFrame:
    """Chunks: codes (compressed, 2 * code + 1 for the last word of a piece), distinct words and their counts. docs: lang, text.

    A piece is a run of the chunk.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[str, Coding] = {}
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for first, count in slices(batch.column(1), SLICE_BYTES):
                langs, texts = (batch.column(i).slice(first, count) for i in range(2))
                for lang in pc.unique(langs).to_pylist():
                    whole, _ = joined(texts.filter(pc.equal(langs, lang)))
                    for stretch in stretches(whole):
                        chunk = waiting.setdefault(lang, Coding())
                        chunk.add(LOWER[stretch])
                        if chunk.parts and chunk.size >= CHUNK_BYTES and chunk.parts[-1][-1] & 1:
                            yield waiting.pop(lang).row(lang, part, number)
                            number += 1
        for lang, chunk in waiting.items():
            if chunk.parts:
                yield chunk.row(lang, part, number)
                number += 1

    return docs.mapInArrow(encode, CHUNK)


class Chunk:
    """Words of a chunk in runs; no phrase crosses the end of a run."""

    def __init__(self, lang: str, words: list[str], codes: np.ndarray, last: np.ndarray):
        self.lang, self.words, self.codes, self.last = lang, words, codes, last

    @classmethod
    def read(cls, lang: str, words: list[str], body: bytes) -> Chunk:
        codes = np.frombuffer(zstandard.ZstdDecompressor().decompress(body), np.uint32)
        return cls(lang, words, (codes >> 1).astype(np.int32), (codes & 1).astype(bool))

    def grams(self, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Some positions at a time: the first, hash of the `size` words from each on, and whether they are of one run."""
        total = max(len(self.codes) - size + 1, 0)
        seed = xxhash.xxh3_64_intdigest(self.lang.encode())
        words = np.array([xxhash.xxh3_64_intdigest(w.encode(), seed=seed) for w in self.words], np.uint64)
        for first in range(0, total, ROWS):
            count = min(ROWS, total - first)
            hashes, inside = np.zeros(count, np.uint64), np.ones(count, bool)
            for step in range(first, first + size):
                hashes = mixed(hashes * np.uint64(0x9E3779B97F4A7C15) + words[self.codes[step : step + count]])
                if step > first:
                    inside &= ~self.last[step - 1 : step - 1 + count]
            yield first, hashes, inside

    def counted(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes of the phrases of `size` words, and how often they occur."""
        hashes = np.concatenate([np.zeros(0, np.uint64), *(h[inside] for _, h, inside in self.grams(size))])
        hashes.sort()
        new = np.ones(len(hashes), bool)
        new[1:] = hashes[1:] != hashes[:-1]
        first = np.flatnonzero(new)
        return hashes[first], np.diff(first, append=len(hashes)).astype(np.int32)

    def thinned(self, size: int, frequent: np.ndarray) -> Chunk:
        """Runs cut at every phrase of `size` (2 or 3) words that is not frequent; runs of single words go.

        The run before ends with the last word but one of such a phrase, the run after begins with its second word.
        """
        frequent, bad = np.sort(frequent), np.zeros(max(len(self.codes) - size + 1, 0), bool)
        for first, hashes, inside in self.grams(size):
            at = np.searchsorted(frequent, hashes)
            at[at == len(frequent)] = 0
            bad[first : first + len(hashes)] = inside & (frequent[at] != hashes if len(frequent) else True)
        codes, last = self.codes, self.last.copy()
        if size == 2:
            last[:-1] |= bad
        else:  # the middle word ends one run and begins another
            middle = np.zeros(len(codes), bool)
            middle[1:-1] = bad
            codes, last = np.repeat(codes, 1 + middle), np.repeat(last, 1 + middle)
            last[np.flatnonzero(middle) + np.arange(np.count_nonzero(middle))] = True
        kept = ~(last & np.append(True, last[:-1]))
        codes = codes[kept]
        used = np.zeros(len(self.words), bool)
        used[codes] = True
        return Chunk(self.lang, [self.words[c] for c in np.flatnonzero(used).tolist()], (np.cumsum(used, dtype=np.int32) - 1)[codes], last[kept])

    def windows(self, most_words: int) -> Iterator[tuple[list[str], np.ndarray]]:
        """Distinct windows of two to most_words words, each word with a space behind it, and how often they occur; some at a time."""
        n = len(self.codes)
        more, going = np.zeros(n, np.int32), np.append(~self.last, np.zeros(most_words, bool))
        for step in range(most_words - 2, -1, -1):
            more = np.where(going[step : step + n], more + 1, 0)
        at = np.flatnonzero(more)
        more, codes = more[at], np.append(self.codes, np.zeros(most_words, np.int32))
        rows = np.empty((most_words, len(at)), np.int32)
        for j in range(most_words):
            rows[j] = np.where(more >= j, codes[at + j], -1)
        del at, more, codes, going
        by = np.lexsort(rows[::-1])
        new = np.zeros(len(by), bool)
        new[:1] = True
        for row in rows:  # sorted in place
            row[:] = row[by]
            new[1:] |= row[1:] != row[:-1]
        del by
        first = np.flatnonzero(new)
        counts = np.diff(first, append=len(new))
        for i in range(0, len(first), ROWS):
            found = rows[:, first[i : i + ROWS]].T.tolist()
            yield ["".join([self.words[c] + " " for c in row if c >= 0]) for row in found], counts[i : i + ROWS]

    def row(self, part: int, number: int) -> pa.RecordBatch:
        body = zstandard.ZstdCompressor(level=1).compress((self.codes * 2 + self.last).astype(np.uint32).tobytes())
        counts = np.bincount(self.codes, minlength=len(self.words))
        values = (part, number, self.lang, len(self.codes), self.words, counts, body)
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64()), pa.binary()]
        names = [field.split()[0] for field in CHUNK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], names=names)


def chunks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, Chunk, np.ndarray | None]]:
    """part, number, chunk and, if there is such a column, the frequent phrases of each row."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = [batch.column(name)[i] for name in ("part", "number", "lang", "words", "codes")]
            part, number, lang, words, body = (value.as_py() for value in row)
            listed = batch.column("frequent")[i].values.to_numpy().view(np.uint64) if "frequent" in batch.schema.names else None
            yield part, number, Chunk.read(lang, words, body), listed


def with_frequent(chunks: DataFrame, size: int, least: int) -> DataFrame:
    """Chunks with `frequent`: those of their phrases of `size` words that occur `least` times or more in all chunks together.

    A chunk without any has an empty list.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, number, chunk, _ in chunks_of(batches):
            grams, counts = chunk.counted(size)
            for i in range(0, len(grams), ROWS):
                some = grams[i : i + ROWS].view(np.int64)
                place = [np.full(len(some), x, np.int32) for x in (part, number)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (*place, some, counts[i : i + ROWS])], names=["part", "number", "gram", "count"])

    chunks = chunks.select("part", "number", "lang", "words", "codes")
    found = chunks.mapInArrow(count, "part int, number int, gram long, count int")
    found = found.withColumn("f", F.sum("count").over(Window.partitionBy("gram"))).filter(F.col("f") >= least)
    lists = found.groupBy("part", "number").agg(F.collect_list("gram").alias("frequent"))
    listed = merged(chunks, lists, ["part", "number"], "left")
    return listed.withColumn("frequent", F.coalesce("frequent", F.array().cast("array<bigint>")))


def refilled(chunks: DataFrame) -> DataFrame:
    """Thinned chunks of a language put together to chunks of about CHUNK_WORDS words; their runs stay as they are.

    A phrase has a row per chunk at most, so the number of chunks should follow the words that are left, not the tasks and languages.
    """

    def put(group: pa.Table) -> pa.Table:
        numbers: dict[str, int] = {}
        codes, last = [], []
        for part, number, chunk, _ in chunks_of(iter(group.to_batches())):
            own = np.array([numbers.setdefault(word, len(numbers)) for word in chunk.words], np.int32)
            codes.append(own[chunk.codes])
            last.append(chunk.last)
        whole = Chunk(chunk.lang, list(numbers), np.concatenate(codes), np.concatenate(last))
        return pa.Table.from_batches([whole.row(part, number)])

    chunks = chunks.filter("n_words > 0")
    before = F.sum("n_words").over(Window.partitionBy("lang").orderBy("part", "number")) - F.col("n_words")
    place = chunks.select("part", "number", F.floor(before / CHUNK_WORDS).alias("place"))
    return merged(chunks, place, ["part", "number"]).groupBy("lang", "place").applyInArrow(put, CHUNK)


def frequent_windows(chunks: DataFrame, least: int, most_words: int) -> DataFrame:
    """lang, window, count: distinct windows of each chunk, all of whose words stand in pairs and triples that reach `least`."""

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, number, chunk, frequent in chunks_of(batches):
            yield chunk.thinned(2, frequent).row(part, number)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, chunk, frequent in chunks_of(batches):
            if frequent is not None:
                chunk = chunk.thinned(3, frequent)
            for windows, counts in chunk.windows(most_words):
                columns = [pa.array([chunk.lang] * len(windows), pa.string()), pa.array(windows, pa.string()), pa.array(counts, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "window", "count"])

    kept = staging.staged(with_frequent(chunks, 2, least).mapInArrow(thin, CHUNK), "collocations-pairs")
    kept = staging.staged(refilled(kept), "collocations-refilled")
    if most_words > 2:
        kept = with_frequent(kept, 3, least)
    return kept.mapInArrow(cut, "lang string, window string, count long")


def run_counts(windows: DataFrame, least: int, most_words: int) -> DataFrame:
    """lang, phrase, n_words, f of phrases of two words and more; windows sorted within partitions.

    Runs that touch the first or last row of a partition are parts; all others are whole and kept only from `least`.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lang, words, open_, at_start = None, [], [0] * (most_words + 1), True
        born_first = [False] * (most_words + 1)  # the run touches the first row
        out: list[tuple] = []

        def close(above: int, border: bool) -> None:
            for size in range(max(above + 1, 2), len(words) + 1):
                if border or born_first[size] or open_[size] >= least:
                    out.append((lang, " ".join(words[:size]), size, open_[size]))

        def flush() -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int32(), pa.int64())
            columns = zip(*out) if out else ((),) * 4
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=["lang", "phrase", "n_words", "f"])
            out.clear()
            return batch

        for batch in batches:
            for lang_, window, n in zip(*(batch.column(i).to_pylist() for i in range(3))):
                found = window[:-1].split(" ")
                same = 0
                if lang_ == lang:
                    while same < len(words) and same < len(found) and words[same] == found[same]:
                        same += 1
                close(same, False)
                for size in range(same + 1, len(found) + 1):
                    open_[size], born_first[size] = 0, at_start
                # A shorter window leaves longer runs closed; they are not among its words.
                lang, words, at_start = lang_, found, False
                for size in range(1, len(found) + 1):
                    open_[size] += n
            yield flush()
        if words:
            close(0, True)
            yield flush()

    return windows.mapInArrow(count, "lang string, phrase string, n_words int, f long")


def merged(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Sorted streams in lockstep."""
    return left.join(right.hint("merge"), on, how)


def phrase_counts(docs: DataFrame, least: int, most_words: int) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n_words, f) of all words and phrases with f >= least, and (lang, n). docs: lang, text."""
    chunks = staging.staged(encoded(docs), "collocations-chunks")
    windows = staging.staged(frequent_windows(chunks, least, most_words), "collocations-windows")
    ordered = windows.repartitionByRange("lang", "window").sortWithinPartitions("lang", "window")
    phrases = run_counts(ordered, least, most_words).groupBy("lang", "phrase", "n_words").agg(F.sum("f").alias("f"))
    words = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w"))
    words = words.groupBy("lang", F.col("w.words").alias("phrase")).agg(F.sum("w.counts").alias("f"))
    counts = words.select("lang", "phrase", F.lit(1).alias("n_words"), "f").unionByName(phrases).filter(F.col("f") >= least)
    return staging.staged(counts, "collocations-counts"), chunks.groupBy("lang").agg(F.sum("n_words").alias("n"))


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    most_words: int = MOST_WORDS,
    per_language: int = PER_LANGUAGE,
    text_column: str = "text",
    lang_column: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of every language."""
    if most_words < 2 or least < 1:
        raise ValueError("phrases have two words at least and occur")
    rows = docs.select(
        F.coalesce(F.col(lang_column).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    )
    counts, totals = phrase_counts(rows, least, most_words)
    part = lambda first, n: F.concat_ws(" ", F.slice(F.split("phrase", " "), first, n))
    size = F.col("n_words")

    # Extensions by a word to the right of the first part and to the left of the rest.
    longer = counts.filter(size > 2)
    extensions = longer.select("lang", F.explode(F.array(part(1, size - 1), part(2, size - 1))).alias("phrase"), "f")
    extensions = extensions.groupBy("lang", "phrase").agg(F.max("f").alias("extension"))
    candidates = merged(counts.filter(size > 1).withColumnRenamed("f", "a"), extensions, ["lang", "phrase"], "left")
    candidates = candidates.filter(F.col("extension").isNull() | (F.col("extension") < F.col("a")))

    cuts = candidates.select("lang", "phrase", "a", "n_words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumn("first", part(1, F.col("k"))).withColumn("rest", part(F.col("k") + 1, size))
    cuts = cuts.withColumn("salt", F.pmod(F.xxhash64("lang", "phrase"), F.lit(SALTS)).cast("int"))
    stream = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    cuts = merged(cuts, stream.select("lang", F.col("phrase").alias("first"), "salt", F.col("f").alias("l")), ["lang", "first", "salt"])
    cuts = merged(cuts, stream.select("lang", F.col("phrase").alias("rest"), "salt", F.col("f").alias("r")), ["lang", "rest", "salt"])

    scored = cuts.join(totals, "lang").withColumn(
        "score",
        F.expr(
            "CAST((CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(15, 0)) * CAST(n AS DECIMAL(17, 0)))"
            " div (CAST(l AS DECIMAL(18, 0)) * CAST(r AS DECIMAL(18, 0))) AS BIGINT)"
        ),
    )
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= per_language)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
