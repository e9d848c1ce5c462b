"""From raw documents to packed training sequences: five stages, each written as Parquet before the next one reads it.

The stages are operators 6, 10, 8, 2 and 7. What operator 8 links is decided by 5-word shingles and a similarity of 0.8; MinHash
bands add the candidates that its 4 bits do not reach. Each stage loads its operator when it runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalogue.sources.shared import settle


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression bands and the base rules keep."""
    from catalogue.llm import bands

    return bands.drop_rejected(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    from catalogue.llm import blocks

    return blocks.drop_duplicates(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of which no near copy (5-word shingles, Jaccard 0.8) with a smaller doc_id stays."""
    from catalogue.llm import nearcopies

    return nearcopies.drop_near_copies(docs)


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix takes them."""
    from catalogue.llm import mixing

    return mixing.mixed_documents(docs)


def sequence_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in training sequences."""
    from catalogue.llm import packing

    return packing.pack(docs)


STAGES = [("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing_to_weights), ("packing", sequence_packing)]

#: four of the stages have no SQL: compression, fingerprints and tokens; ``tests/llm`` checks run() by brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
