"""From raw documents to packed training sequences, as five stages.

Each stage takes all that the one before it kept, written as Parquet and read
again, and its decisions take effect: rejected documents and copies are gone,
mixed documents stand as often as the mix takes them. All stages but the last
return the columns of ``documents``.

Defined results of the stages are those of their operators (see the modules
in ``strata.llm``): null texts count as empty and pass every filter that does
not reject an empty text; an empty table stays empty through all stages.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from strata.config import ensure_checkpoint_dir
from strata.llm import exact_dedup, jaccard_join, mixing, packing, quality, queries
from strata.sources.tables import read_table

# Near-copies: shingles of five words, a likeness of 0.8 or more.
NEAR_WORDS, NEAR_SHARE = 5, (80, 100)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    classifier = queries.quality_classifier(docs, read_table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, classifier)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of equal texts."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near-copies."""
    return jaccard_join.drop_near_copies(docs, words=NEAR_WORDS, share=NEAR_SHARE)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in training sequences."""
    return packing.pack(docs, queries.tokenizer_path())


STAGES = [
    ("quality classifier", quality_filter),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("mixing sources to target weights", source_mix),
    ("packing", packed_sequences),
]

# A trained network, balanced sampling and a tokenizer are beyond SQL; the
# stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written below the checkpoint folder."""
    queries.find_package(spark)
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
