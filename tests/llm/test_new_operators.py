"""Phrase collocations, substring dedup and hard negatives against plain versions, on given tables and on odd rows."""

import math
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from haulage.llm import collocations, negatives, queries, substring, wordspans
from tests.conftest import SF_DIR
from tests.llm import brute
from tests.llm.test_operators import DOCS, ODD

VECTORS = "vec_id long, label int, embedding array<float>, key long, rank string"


@pytest.fixture(scope="module")
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(*r, f"r{i}", i, "s") for i, r in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


# Words


def test_words_and_slices():
    texts = [None, "", "a  bc\n", "\x1cé\tb", "a"]
    words = wordspans.words_of(pa.array(texts))
    found = [(t, words.distinct[c].as_py().decode()) for t, c in zip(words.texts.tolist(), words.codes.tolist())]
    assert found == [(2, "a"), (2, "bc"), (3, "\x1cé"), (3, "b"), (4, "a")]
    sliced = pa.array(["skipped", *texts]).slice(1)
    assert wordspans.words_of(sliced).codes.tolist() == words.codes.tolist()
    column = pa.array([None, "x" * 50, "a", "b", "c" * 9, ""])
    cuts = wordspans.slices(column, 10)
    assert cuts == [(0, 2), (2, 3), (5, 1)]
    assert wordspans.slices(column.slice(0, 0), 10) == []


# Collocations


@pytest.mark.parametrize("least", [2, 7])
def test_collocations(given, odd, least):
    for docs in (given, odd, odd.filter("false")):
        want = brute.collocations([(r.lang, r.text) for r in docs.select("lang", "text").collect()], least)
        got = [tuple(r) for r in collocations.collocations(docs, least=least).collect()]
        assert sorted(got) == sorted(want)


def test_collocations_over_many_small_chunks_and_partitions(spark, given, monkeypatch):
    """Runs of a phrase cross partition borders; a hot phrase spans several."""
    monkeypatch.setattr(collocations, "CHUNK_BYTES", 2_000)
    rows = [("en", "the cat sat. the cat ran, the cat sat on the mat"), (None, "The Cat sat"), ("und", "the cat")] * 60
    docs = spark.createDataFrame(rows, "lang string, text string").unionByName(given.select("lang", "text")).repartition(7)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        want = brute.collocations([(r.lang, r.text) for r in docs.collect()], 5, per_language=50)
        got = [tuple(r) for r in collocations.collocations(docs, least=5, per_language=50).collect()]
        pairs = sorted(tuple(r) for r in collocations.collocations(docs, least=5, most_words=2, per_language=9).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted(got) == sorted(want)
    assert pairs == sorted(brute.collocations([(r.lang, r.text) for r in docs.collect()], 5, 2, 9))


def peak_of(job):
    """Bytes allocated at most while job runs."""
    tracemalloc.start()
    try:
        job()
        return tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def encoder(monkeypatch):
    """What a task of `encoded` does with its batches."""
    monkeypatch.setattr(collocations, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    return collocations.encoded(SimpleNamespace(mapInArrow=lambda encode, _: encode))


def test_texts_are_encoded_and_windows_sent_some_at_a_time(monkeypatch):
    """Memory far below what all words of a batch or of a chunk take at once."""
    encode, words = encoder(monkeypatch), np.random.default_rng(1).integers(0, 40_000, 1_500_000)
    texts = [" ".join(f"w{x}" for x in words[i : i + 500]) for i in range(0, len(words), 500)]
    batch, size = pa.record_batch({"lang": ["en"] * len(texts), "text": texts}), sum(map(len, texts))
    rows = []
    assert peak_of(lambda: rows.extend(encode(iter([batch])))) < 6 * size
    chunk = next(collocations.chunks_of(iter(rows)))[2]
    assert peak_of(lambda: [None for _ in chunk.windows(5)]) < 100 * len(chunk.codes)
    assert peak_of(lambda: chunk.counted(2)) < 45 * len(chunk.codes)


def test_texts_are_cut_between_words_without_loss(spark, monkeypatch):
    """Pieces and words longer than a stretch, blanks and ends of pieces on its border."""
    encode, random = encoder(monkeypatch), np.random.default_rng(2)
    alphabet = np.array(["a", "b", "é", "LongerThanAStretch", " ", " ", " ", "\t", ".", "\n"])
    rows = [("en", "".join(random.choice(alphabet, random.integers(0, 60)))) for _ in range(80)] + [("en", "a b " * 40), ("fr", "a . b"), ("fr", " . ")]
    batch = pa.record_batch([pa.array(c) for c in zip(*rows)], names=["lang", "text"])

    def runs(found):
        for _, _, chunk, _ in collocations.chunks_of(found):
            for run in np.split(chunk.codes, np.flatnonzero(chunk.last)[:-1] + 1):
                yield chunk.lang, [chunk.words[c] for c in run]

    whole = sorted(runs(encode(iter([batch]))))
    for size in (1, 3, 8, 50):
        monkeypatch.setattr(collocations, "SLICE_BYTES", size)
        monkeypatch.setattr(collocations, "ROWS", size)
        monkeypatch.setattr(collocations, "CHUNK_BYTES", 6 * size)
        assert sorted(runs(encode(iter([batch])))) == whole
    lower = [(lang, re.findall(r"[^ \t]+", piece.lower())) for lang, text in rows for piece in re.split(r"[.\n]", text)]
    assert whole == sorted((lang, words) for lang, words in lower if words)
    monkeypatch.setattr(collocations, "TaskContext", TaskContext)  # chunks are told apart by their task
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert sorted(tuple(r) for r in collocations.collocations(docs, least=3).collect()) == sorted(brute.collocations(rows, 3))


def test_windows_have_few_rows_however_many_tasks_read_the_texts(spark, monkeypatch):
    rows = [(lang, f"the cat sat on the mat, number{i}") for lang in ("en", "fr") for i in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    chunks = collocations.staging.staged(collocations.encoded(docs.repartition(16)), "many")
    found = lambda: sorted(tuple(r) for r in collocations.frequent_windows(chunks, 5, 5).collect())
    tails = ["the cat sat on the ", "cat sat on the mat ", "sat on the mat ", "on the mat ", "the mat "]
    assert found() == sorted((lang, window, 40) for lang in ("en", "fr") for window in tails)
    monkeypatch.setattr(collocations, "CHUNK_WORDS", 100)  # 240 words of a language are left
    assert 2 * len(tails) < len(parts := found()) <= 2 * len(tails) * 3
    assert {(lang, w): sum(n for x, y, n in parts if (x, y) == (lang, w)) for lang, w, _ in parts} == {(x, w): 40 for x in ("en", "fr") for w in tails}


def test_run_counts_keep_parts_at_borders(spark):
    windows = spark.createDataFrame([("en", "a b c ", 1), ("en", "a b d ", 2), ("en", "a c ", 9), ("en", "b c ", 1)], "lang string, window string, count long")
    got = {(r.phrase, r.f) for r in collocations.run_counts(windows.coalesce(1), 3, 5).collect()}
    assert got == {("a b", 3), ("a b c", 1), ("a c", 9), ("b c", 1)}  # the first and the last window may go on elsewhere


def test_products_beyond_64_bits(spark, monkeypatch):
    """a * n * 1000 beyond 2^63: counts are put in, not counted."""
    big = 10**13
    counts = [("en", "new", 1, 3 * big), ("en", "york", 1, 2 * big), ("en", "new york", 2, big)]
    frames = (
        spark.createDataFrame(counts, "lang string, phrase string, n_words int, f long"),
        spark.createDataFrame([("en", 9 * big)], "lang string, n long"),
    )
    monkeypatch.setattr(collocations, "phrase_counts", lambda *_: frames)
    row = collocations.collocations(spark.createDataFrame([("en", "x")], "lang string, text string")).collect()[0]
    assert row.score == 1000 * big * 9 * big // (3 * big * 2 * big) == 1500


# Substring dedup


def removed(docs, **given):
    rows = substring.without_repeats(docs, **given).collect()
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=repr)


def test_substrings(given, odd):
    for docs in (given, odd, odd.filter("false")):
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        assert removed(docs) == sorted(brute.substrings(rows), key=repr)


def test_substrings_of_planted_repeats(spark):
    random = np.random.default_rng(5)
    words = lambda n: [f"w{x}" for x in random.integers(0, 10**6, n)]
    passage, other = words(57), words(20)
    rows = []
    for i in range(120):  # one passage in every document, another in some, short repeats that must stay
        text = words(int(random.integers(0, 60))) + passage + words(3) + (other if i % 7 == 0 else other[:19]) + words(int(random.integers(0, 9)))
        rows.append((i, " ".join(text)))
    rows += [(200 + i, " ".join(["a"] * i)) for i in (0, 1, 19, 20, 21, 60)]  # repeats within a document overlap themselves
    rows += [(300, rows[3][1]), (300, rows[3][1]), (301, rows[3][1] + " more"), (302, " ".join(passage[1:21])), (None, rows[5][1]), (None, "none")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    for anchor in (8, 1, 20):
        assert removed(docs, anchor=anchor) == sorted(brute.substrings(rows), key=repr)
    full = {r.doc_id: r for r in substring.without_repeats(docs).filter("doc_id IS NOT NULL").collect()}
    assert [tuple(s) for s in full[302].spans] == [(0, 20)] and full[302].text == ""
    first = rows[0][1].split().index(passage[0])
    assert full[0].spans == [] and full[0].text is None and first >= 0
    one = rows[1][1].split()
    start = one.index(passage[0])
    assert [tuple(s) for s in full[1].spans] == [(start, start + 57)] and full[1].text.split() == one[:start] + one[start + 57 :]


def test_substrings_in_small_slices(given, monkeypatch):
    """Every slice knows few documents: all that crosses slices is found by the shuffles."""
    monkeypatch.setattr(substring, "BATCH_BYTES", 3_000)
    rows = [(r.doc_id, r.text) for r in given.select("doc_id", "text").collect()]
    assert removed(given) == sorted(brute.substrings(rows), key=repr)


def test_a_passage_in_all_documents_has_few_rows(spark):
    """Anchors and windows of a hot passage: one row per slice, not per document; no pairs."""
    random = np.random.default_rng(6)
    passage = " ".join(f"p{i}" for i in range(40))
    rows = [(i, f"{' '.join(f'w{x}' for x in random.integers(0, 10**9, 5))} {passage} x{i}") for i in range(2_000)]
    docs = substring.plain(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), "doc_id", "text")
    seeds = substring.seeded(docs, 20, 8).filter("place % 4 <> 3").groupBy("x", "y").count()
    assert seeds.agg(F.max("count")).first()[0] == 1


def test_substring_parameters(given):
    with pytest.raises(ValueError):
        substring.without_repeats(given, length=5, anchor=6)


# Hard negatives


def mined(frame, **more):
    return sorted(tuple(r) for r in negatives.hard_negatives(frame, F.col("id") % 100 == 0, **more).collect())


def test_hard_negatives(spark):
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    got = sorted(tuple(r) for r in queries.hard_negatives(spark, SF_DIR).collect())
    label = lambda r: (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label
    assert got == brute.hard_negatives([(r.vec_id, label(r), r.embedding) for r in rows.collect()])


def test_hard_negatives_over_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 40)
    monkeypatch.setattr(negatives, "CHUNKS_PER_CELL", 2)
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 2)
    monkeypatch.setattr(negatives, "BLOCKS_PER_CELL", 1)
    random = np.random.default_rng(9)
    centres = random.normal(size=(6, 4))
    rows = []
    for i in range(400):
        x = centres[i % 6] + 0.1 * random.normal(size=4) if i % 3 else np.round(random.normal(size=4), 1)
        rows.append((i, int(random.integers(0, 3)), x.tolist()))
    rows += [(500, 1, rows[100][2]), (501, 2, rows[100][2]), (502, 1, [0.0] * 4), (600, 1, [0.0] * 4)]  # ties, zero vectors
    rows += [(700, 1, [1.0, 2.0]), (701, 1, [1.0, 2.0]), (702, 2, [1.0, 1.9]), (800, 2, []), (801, 2, []), (802, 0, [])]  # other lengths
    bad = [(900, None, [1.0] * 4), (901, 1, None), (902, 1, [1.0, None, 1.0, 1.0]), (903, 1, [math.nan] * 4), (904, 1, [math.inf] * 4), (None, 1, [1.0] * 4)]
    frame = spark.createDataFrame([(*r, 1, "r") for r in rows + bad], VECTORS.replace("embedding array<float>, key", "embedding array<double>, key"))
    frame = frame.select("vec_id", "label", "embedding", "key", "rank").repartition(4)
    assert mined(frame) == brute.hard_negatives(rows)
    assert mined(frame.filter("false")) == []
    assert mined(frame, least=100) == brute.hard_negatives(rows, least=100)


def test_hard_negatives_beyond_doubles(spark):
    random = np.random.default_rng(2)
    rows = [(i, i % 2, (random.normal(size=3) * 1e7).tolist()) for i in range(0, 300, 5)]
    frame = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(frame) == brute.hard_negatives(rows)


def test_covering_radii_hold():
    random = np.random.default_rng(1)
    points = np.floor(256 * np.concatenate([random.normal(size=(80, 8)), 0.01 * random.normal(size=(60, 8)), np.zeros((5, 8))]))
    tree = negatives.CoverTree(np.arange(145), np.zeros(145, np.int64), points)
    assert len(tree.levels[0].ids) == 1 and sorted(tree.levels[-1].ids.tolist()) == list(range(145))
    lift = np.column_stack([points, np.sqrt((points**2).sum(1).max() - (points**2).sum(1))])

    def check(depth, node, inside):
        level = tree.levels[depth]
        for centre, radius in inside:
            assert np.linalg.norm(lift[level.ids[node]] - lift[centre]) <= radius
        if depth + 1 < len(tree.levels):
            for child in range(level.first[node], level.first[node + 1]):
                check(depth + 1, child, [*inside, (level.ids[node], level.radius[node])])

    check(0, 0, [])
