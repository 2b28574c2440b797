"""A corpus pipeline of five operators, each stage on all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared folder and reads it back for the next stage. All but
the last return the columns of ``documents``.

- ``language_id`` drops texts without a letter and texts of whose parts the
  network cannot tell the language better than chance.
- ``exact_dedup`` leaves one of the texts equal after lower-casing A-Z.
- ``jaccard_dedup`` leaves one of each component of texts that share four fifths
  of their five-word shingles.
- ``mix_sources`` takes each source up to its target: a document gives one row
  for each pass of the mix that takes words of it, with the words taken.
- ``bpe`` encodes the texts and decodes them again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm import bpe as bpe_codec
from priceloom.llm import exact_dedup as exact
from priceloom.llm import jaccard_join, language_id, mixing
from priceloom.llm.common import ship, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_id.keep_known(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return exact.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return jaccard_join.keep_one(docs, width=5, threshold=0.8)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return mixing.mix_texts(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and decoded_sha256."""
    ship(spark)
    coded = bpe_codec.encode(docs.select("doc_id", "lang", "source", "text"))
    return coded.select(
        "doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_tokens"), "decoded_sha256"
    )


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_dedup", drop_near_copies),
    ("mix_sources", mix_sources),
    ("bpe", encode),
]

#: The stages train a network, draw slots and build tokens, which SQL cannot say.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
