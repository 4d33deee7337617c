"""Exact histogram of encoded lengths, and what every context limit keeps.

Documents are counted by length on the map side, so one small row per distinct
length and task is shuffled.  Running sums over the distinct lengths are taken
within blocks of 1024 lengths and over the blocks, so no window holds them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import bpe

BLOCK = 1024


def encoded_lengths(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, length`` in tokens of every row of ``docs``; null and empty texts have 0."""
    path = path or bpe.vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = bpe.encoder(path)
        for batch in batches:
            lengths = [len(encode(t.as_py())) // 4 for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "length"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, length long")


def histogram(lengths: DataFrame) -> DataFrame:
    """``length, docs`` for every length that occurs."""
    return lengths.groupBy("length").agg(F.count("*").alias("docs"))


def at_every_limit(counts: DataFrame) -> DataFrame:
    """One row per length that occurs, taken as the context limit.

    ``docs_within`` and ``tokens_within`` count documents no longer than the
    limit; ``docs_beyond`` and ``tokens_beyond`` are the suffix sums over longer
    ones; ``kept_tokens`` is the total when every document is truncated to the
    limit and ``lost_tokens`` the rest; ``quantile`` is the share of documents
    within.  Between two lengths kept_tokens is linear: see ``kept_at``.  No
    documents give no rows.
    """
    block = F.floor(F.col("length") / BLOCK)
    rows = cut_lineage(counts.select("length", "docs", (F.col("length") * F.col("docs")).alias("tokens"), block.alias("block")))
    blocks = rows.groupBy("block").agg(F.sum("docs").alias("block_docs"), F.sum("tokens").alias("block_tokens"))
    after = W.orderBy(F.col("block").desc()).rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.select(
        F.col("block").alias("of"),
        F.coalesce(F.sum("block_docs").over(after), F.lit(0)).alias("docs_after"),
        F.coalesce(F.sum("block_tokens").over(after), F.lit(0)).alias("tokens_after"),
    )
    total = rows.agg(F.sum("docs").alias("all_docs"), F.sum("tokens").alias("all_tokens")).first()
    longer = W.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(W.unboundedPreceding, -1)
    suffix = (
        rows.withColumn("docs_longer", F.coalesce(F.sum("docs").over(longer), F.lit(0)))
        .withColumn("tokens_longer", F.coalesce(F.sum("tokens").over(longer), F.lit(0)))
        .join(blocks, F.col("block") == F.col("of"))
        .withColumn("docs_beyond", F.col("docs_longer") + F.col("docs_after"))
        .withColumn("tokens_beyond", F.col("tokens_longer") + F.col("tokens_after"))
    )
    docs, tokens = F.lit(total["all_docs"]).cast("long"), F.lit(total["all_tokens"]).cast("long")
    kept = tokens - F.col("tokens_beyond") + F.col("length") * F.col("docs_beyond")
    return suffix.select(
        "length",
        "docs",
        (docs - F.col("docs_beyond")).alias("docs_within"),
        (tokens - F.col("tokens_beyond")).alias("tokens_within"),
        "docs_beyond",
        "tokens_beyond",
        kept.alias("kept_tokens"),
        (tokens - kept).alias("lost_tokens"),
        ((docs - F.col("docs_beyond")) / docs).alias("quantile"),
    )


def kept_at(limits: DataFrame, limit: int) -> int:
    """Tokens left when documents are truncated to any ``limit``, from ``at_every_limit``."""
    below = limits.where(F.col("length") <= limit).orderBy(F.col("length").desc()).limit(1).collect()
    if below:
        return below[0]["tokens_within"] + limit * below[0]["docs_beyond"]
    return limit * (limits.agg(F.sum("docs")).first()[0] or 0)


def length_quantile(limits: DataFrame, share: float) -> int | None:
    """The smallest length that at least ``share`` of all documents do not exceed."""
    return limits.where(F.col("quantile") >= share).agg(F.min("length")).first()[0]
