"""From raw documents to token ids: language ID, exact dedup, near-dedup, mixing, BPE.

Each stage takes (spark, docs, sf_dir) with ``docs`` a parquet table and returns a frame; :func:`run` writes it below the
shared folder and hands the reread table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placemill.llm import bpe, exact, langid, minhash, mixing
from placemill.llm.queries import word_vocabulary
from placemill.session import stable

LEAST_LANGUAGE_SCORE = 0.5


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters and whose language is told with a posterior of at least one half."""
    return langid.keep_known(docs, langid.fit(docs), LEAST_LANGUAGE_SCORE)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id."""
    return exact.drop_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each near-duplicate class the document with the smallest doc_id."""
    return minhash.keep_first(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights."""
    return mixing.mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids per document and copy, and the digest of what they decode to."""
    rows = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.decode(bpe.encode(rows, word_vocabulary()), word_vocabulary())
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
                        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language ID", known_language),
    ("exact dedup", without_copies),
    ("near-dedup", without_near_copies),
    ("mixing", mixed),
    ("BPE", encoded),
]

# language ID, consistent weighted sampling and BPE have no SQL form: tests hold run() against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stable(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
