"""The corpus pipeline: documents through five operators of tidemark.llm.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept. All but the last return the columns of
documents; n_chars follows the text where a stage changes it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, mixing, pieces, quality, surrogates
from tidemark.llm.common import stored, table
from tidemark.llm.queries import SURROGATE_KEY, site


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality classifier rejects."""
    return quality.classify(docs, table(spark, sf_dir, "labels"), *site(docs)).where("_keep").select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.first_of_each(docs)


def replace_private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by surrogates."""
    replaced = surrogates.replace(docs, SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.when(F.col("_entities") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document comes once for each pass that takes words of it, with those words."""
    rows = mixing.Mix(docs).rows(docs)
    return rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether decoding them gives the text again."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    keep = ["doc_id", "lang", "source", "text_crc32"]
    plain = docs.withColumn("text_crc32", F.crc32(F.replace(F.coalesce("text", F.lit("")), F.lit(pieces.SPACE), F.lit(" "))))
    back = pieces.decode(pieces.encode(plain.select(*keep, "text"), path, keep), path, keep, with_ids=True)
    return back.select("doc_id", "lang", "source", "ids", "n_ids", "ids_crc32", (F.crc32("text") == F.col("text_crc32")).alias("round_trip"))


STAGES = [("quality", classify), ("near-duplicates", deduplicate), ("surrogates", replace_private), ("mixing", mix), ("sentencepiece", encode)]

#: A fitted classifier and keyed draws have no SQL; tests hold each stage against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents through every stage, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
