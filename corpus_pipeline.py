"""A corpus pipeline of five stages: from documents to training sequences.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage
before it kept; ``run`` writes every stage's result as Parquet in the session's
shared folder and reads it back, so a lost executor repeats one stage at most.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cadence.llm import minhash, packing, quality, suffix, toxicity
from cadence.llm.tables import cut, read, ship_code


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.good_documents(docs, read(spark, sf_dir, "labels"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier does not reject."""
    return toxicity.clean_documents(docs, read(spark, sf_dir, "labels"))


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest doc_id."""
    ship_code(spark)
    return minhash.without_near_duplicates(docs)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the long strings that occur earlier in the corpus."""
    ship_code(spark)
    return suffix.without_repeats(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    ship_code(spark)
    return packing.pack(docs, public_tokenizers.path(packing.TOKENIZER))


STAGES = [("quality", good), ("toxicity", clean), ("near_dedup", distinct), ("suffix_dedup", unrepeated), ("packing", packed)]

#: Fitted classifiers and tokenizers are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir))
    return docs
