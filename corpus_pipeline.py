"""From raw documents to token ids: toxic and poor documents go, of near-duplicates one stays,
sources are mixed, and the mix is encoded.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept. Null and
empty texts, repeated rows, ties, empty tables, and further columns are treated as the
operators' docstrings say. Filters keep rows as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrane.llm import bpe, mixing, nearcopies, quality, toxicity
from terrane.llm.common import table
from terrane.session import written


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.clean(docs, model)


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score reaches the cut."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.good(docs, model)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates."""
    return nearcopies.deduplicate(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.repeated(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the token ids, their number, and whether decoding gives the text."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = bpe.decode(bpe.encode(docs.select("doc_id", "source", "text"), path), path)
    return rows.select(
        "doc_id", "source", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids",
        (F.col("decoded") == F.coalesce("text", F.lit(""))).alias("decodes"))


STAGES = [
    ("toxicity", clean), ("quality classifier", good), ("simhash near-dedup", distinct),
    ("mixing sources", mixed), ("bpe encoding", encoded),
]

#: Training and hashing have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = written(docs, name.replace(" ", "-"))
    return docs
