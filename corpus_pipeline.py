"""The corpus pipeline: documents in, packed training sequences out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import mixing, neighbours, packing, pii, simhash
from millrace.llm.common import stored


def _quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the classifier rejects go; it learns from ``labels``."""
    labels = spark.read.parquet(f"{folder.rstrip('/')}/labels.parquet")
    return neighbours.accepted(docs, neighbours.fit(docs, labels))


def _simhash(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of similar texts (five-word shingles, 0.8) stays."""
    return simhash.one_per_group(docs, simhash.similar_documents(docs, least=0.8, shingle=5))


def _pii(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Personal data is masked in every text."""
    return pii.mask(docs)


def _mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document as often as its source's target asks for."""
    return mixing.repeated(docs)


def _packing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Token sequences of at most 1024."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", _quality),
    ("simhash_near_dedup", _simhash),
    ("pii", _pii),
    ("mixing", _mixing),
    ("packing", _packing),
]

#: Fingerprints, vectors and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after the other, each written to the shared folder before the next."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs
