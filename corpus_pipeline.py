"""A corpus pipeline of five stages: quality, language, near-duplicates, mixing, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import common, language, mixing, order_minhash, packing, quality
from eventmart.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learnt from their labelled rows, does not reject.

    Rejected: score below one half.  Without labels of both classes nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.keep_good(docs, labels).select(*COLUMNS)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told with a margin; texts without a letter go, as do undecided ones."""
    return language.keep_certain(docs).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near-duplicates."""
    return order_minhash.keep_one(docs).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, the last repetition of a source's mix in part.

    A repetition in part keeps the first words of the text; its ``n_chars`` are its own.
    """
    return mixing.repeated(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences of at most 2048 tokens and places there."""
    pieces = packing.token_pieces(docs, tokenizer_path("word_bpe_49k.json"))
    return packing.pack_lengths(common.stored(packing.checksum(pieces)))


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_copies", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to shared storage and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*COLUMNS)
    for _, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
