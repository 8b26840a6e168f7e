"""A corpus made ready for training: reject bad texts, drop copies and near copies, pack the rest.

Each stage takes the documents its predecessor kept and returns those that stay, with the same
columns; the last returns the packed pieces. Between stages the documents are written as
Parquet and read back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyforge.llm.common import stored
from tallyforge.llm.exact_dedup import drop_exact_duplicates
from tallyforge.llm.packing import pack
from tallyforge.llm.quality import accepted
from tallyforge.llm.simhash import drop_near_duplicates


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the compression classifier accepts, every row of them."""
    return accepted(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def keep_distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, the one with the largest id."""
    return drop_exact_duplicates(docs)


def keep_dissimilar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints link."""
    return drop_near_duplicates(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and the sequences they are packed into."""
    return pack(docs, joint=True)


STAGES = [
    ("quality_classifier", keep_quality),
    ("exact_dedup", keep_distinct),
    ("simhash_near_dedup", keep_dissimilar),
    ("best_fit_packing", pack_sequences),
]

#: Compressed sizes, fingerprints and best-fit decisions have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every stage's rows are written and read back."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
