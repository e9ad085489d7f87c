"""The numbered queries: thin wrappers that read whole tables and name the result columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import (
    bpe, chunks, lexical, licenses, mixing, negatives, neighbours, quality, sharding, simhash,
    topk, toxicity, word_lm,
)
from terrane.llm.common import table
from terrane.session import written


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    both = bpe.decode(bpe.encode(docs, path), path)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", "severity", "grade", "p_toxic", F.col("rejected").cast("int").alias("toxic"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return neighbours.search(vectors, every=50, k=5)


def op4_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = written(word_lm.tokenized(docs).select("doc_id", "tokens"), "tokens")
    return word_lm.score_tokens(rows, word_lm.fit_tokens(rows))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).select("doc_id", "held_out", "score", "predicted")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.labels(docs)


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return topk.search(vectors, every=100, k=10)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shards(docs, n=40).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return lexical.search(docs, items, k=10)


def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", "embedding", moved.alias("label"))
    return negatives.mine(vectors, every=100)


def op13_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.compared(table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES = {
    "op1_bpe": op1_bpe, "op2_toxicity": op2_toxicity, "op3_neighbours": op3_neighbours,
    "op4_lm": op4_lm, "op5_quality": op5_quality, "op6_mixing": op6_mixing,
    "op7_simhash": op7_simhash, "op8_licenses": op8_licenses, "op9_topk": op9_topk,
    "op10_sharding": op10_sharding, "op11_lexical": op11_lexical,
    "op12_negatives": op12_negatives, "op13_chunks": op13_chunks,
}

ORACLES = {
    "op6_mixing": mixing.ORACLE_SQL, "op8_licenses": licenses.ORACLE_SQL,
    "op9_topk": topk.ORACLE_SQL, "op11_lexical": lexical.ORACLE_SQL,
    "op12_negatives": negatives.ORACLE_SQL,
}
