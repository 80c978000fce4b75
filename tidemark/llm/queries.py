"""The registered queries of this subpackage, one for each operator."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import credentials, crosswalk, dialogue, hilbert, jaccard, mixing, pieces, quality, subspace, surrogates, token_counts, token_files, warc
from tidemark.llm.common import table
from tidemark.llm.registry import query


#: The key of the surrogates; in use it is a secret, given from outside.
SURROGATE_KEY = "example key"


def site(docs: DataFrame):
    """Host and path of a document: its source, and its language in the source."""
    return F.col("source"), F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))


@query("op1_quality")
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), *site(docs))
    return scored.select("doc_id", F.col("_evidence").alias("evidence"), F.col("_host_posterior").alias("host_posterior"),
                         F.col("_path_posterior").alias("path_posterior"), F.col("_posterior").alias("posterior"), F.col("_keep").alias("keep"))


@query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query("op3_warc", sql="""
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN f ON p.d = f.d AND p.n >= 100""")
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = warc.archive(table(spark, sf_dir, "pages"), "page_id", "url", "html")
    return warc.read_warc(spark, manifest, payloads=False).select(F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op4_mixing")
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.Mix(table(spark, sf_dir, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


@query("op5_jaccard")
def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op6_surrogates")
def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its entities replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return surrogates.replace(docs, SURROGATE_KEY).select("doc_id", F.col("_entities").cast("long").alias("n_entities"), "text")


@query("op7_subspace")
def op7_subspace(spark: SparkSession, sf_dir: str) -> DataFrame:
    return subspace.dedup(table(spark, sf_dir, "embeddings"))


@query("op8_token_files")
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_ids(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), vocabulary_size=50257, end_id=0)
    return token_files.read_ids(spark, manifest)


@query("op9_sentencepiece")
def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document's ids and, decoded from them again, its text, as sizes and checksums."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.crc32(F.replace(F.coalesce("text", F.lit("")), F.lit(pieces.SPACE), F.lit(" "))).alias("text_crc32"))
    keep = ["doc_id", "text_crc32"]
    back = pieces.decode(pieces.encode(docs, path, keep), path, keep)
    return back.select("doc_id", "n_ids", "ids_crc32", F.octet_length("text").cast("long").alias("decoded_bytes"),
                       F.crc32("text").alias("decoded_crc32"), (F.crc32("text") == F.col("text_crc32")).alias("round_trip"))


@query("op10_hilbert")
def op10_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert.search(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


@query("op11_crosswalk")
def op11_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = crosswalk.align_corpus(docs, "text", ["doc_id"], public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


@query("op12_secrets")
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of every whole text; an owner is a source, a repository its language in it."""
    docs = table(spark, sf_dir, "documents")
    scanned = credentials.scan(docs, "text", *site(docs), ["doc_id"])
    return credentials.by_document(scanned, credentials.findings(scanned))


@query("op13_dialogue")
def op13_dialogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_damaged(table(spark, sf_dir, "conversations"))
