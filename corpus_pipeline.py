"""Corpus pipeline: toxicity, line dedup, SimHash near-dedup, mixing to target weights, best-fit packing.

Each stage works on all that the one before it kept; its result is written to the shared folder as Parquet and read again.
All stages but the last give the columns of documents; the last one gives the packed pieces.

Whatever a column holds, no stage breaks off. Null texts count as empty where a text is scored, hashed, counted or packed, and
stay null; null ids, languages and sources are values of their own, the last ones in any order. Texts are taken whole, however
long. Repeated rows are rows of their own, but of one group of near duplicates one row stays. Columns that documents have
besides pass through, whatever their names. An empty table passes as an empty table, and packs to no pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from haulage.llm import line_dedup, mixing, packing, simhash, staging, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the table of labels, predicts to be toxic go.

    Equal texts get equal scores; empty and null texts are scored like any other. Where the labels
    known are all of one kind, every document gets that verdict; without any all stay.
    """
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on more than a tenth of a source's documents go; no document does.

    A null source is a source of its own; a source with one document keeps all lines. A text may become empty.
    """
    return line_dedup.clean_documents(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the smallest id, null ids last, and of repeated rows one.

    Texts without words are alike, so one of them stays.
    """
    return simhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, twice at most, those of higher labelled quality first.

    Documents without words have size 0: they are taken like others of their source, and not at all from a source without any.
    """
    return mixing.mixed_documents(docs, labels=spark.read.parquet(f"{sf_dir}/labels.parquet"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences and places; an empty text is one piece, its end id."""
    packed = packing.packed_documents(docs, capacity=1024, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: Tokenizing and training have no SQL form; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.staged(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
