"""Mixing sources to target weights by capped water-filling.

Sizes are word counts.  Every source is due a share of all words by its weight,
at most ``epochs`` times its own size; what a clamped source leaves goes to the
others by weight until none is above its cap.  A source's target then becomes
whole repetitions of all its documents and one more repetition of the documents
that come first in a seeded order, up to the words that are left.

All of it is DataFrame work.  Sizes and order keys are summed by (source, 4096
slices of the key) on the map side; only the one slice in which a source's cut
lies is looked at row by row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from ..session import cut_lineage
from .common import WORD, stored

#: Sources up to this number are broadcast (a few dozen bytes each), more are joined.
BROADCAST_SOURCES = 20_000
#: Bits of the order key that make a slice.
SLICE_BITS = 12


def word_count(text: Column) -> Column:
    """Words of a text (null: 0)."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def order_key(seed: int) -> Column:
    """The seeded order of documents: a hash of id and text, so a rerun agrees."""
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def water_level(sources: DataFrame, total: int, epochs: int) -> float:
    """Words due to a weight of 1 once all clamped sources are taken out.

    Each round is one aggregate over the sources and clamps at least one more;
    the level only rises, so it ends.
    """
    level, clamped = 0.0, -1
    while True:
        full = F.col("source_size") * epochs <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, F.col("source_size") * epochs)), F.lit(0)).alias("held"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if row["n"] == clamped or not row["open"]:
            return level
        level, clamped = (total - row["held"]) / row["open"], row["n"]


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3) -> DataFrame:
    """``source, source_size, weight, target`` for every source of ``sizes`` (``source, size``).

    Sources in code point order, null last, take the weights in turn.
    """
    summed = cut_lineage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    ordered = number_rows(summed, [F.col("source").asc_nulls_last()], "place")
    place = F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int")
    weighted = cut_lineage(
        ordered.select("source", "source_size", F.array(*map(F.lit, weights))[place].alias("weight"))
    )
    total = weighted.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    due = F.col("weight") * F.lit(water_level(weighted, total, epochs))
    return weighted.withColumn("target", F.least(due, F.col("source_size") * epochs).cast("double"))


def plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 17):
    """The sized documents and what each source takes.

    Returns ``doc_id, source, size, key`` for every row, ``source, source_size,
    target, whole, cut_slice, cut_key, cut_copies, cut_taken`` for every source, and the
    number of sources.  Rows before the cut key are taken once more than ``whole``, and
    so are ``cut_taken`` of the rows that share the cut key.
    """
    sized = stored(
        docs.select("doc_id", F.col("source").cast("string").alias("source"), word_count(F.col("text")).alias("size"), order_key(seed).alias("key")),
        "mixing",
    )
    due = targets(sized.select("source", "size"), weights, epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int")
    due = due.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    due = cut_lineage(due)
    n = due.count()

    slices = cut_lineage(sized.groupBy("source", _slice().alias("slice")).agg(F.sum("size").alias("size")))
    running = F.sum("size").over(W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, 0))
    cut = (
        slices.withColumn("upto", running)
        .join(_side(due.select(F.col("source").alias("of"), "rest"), n), F.col("source").eqNullSafe(F.col("of")))
        .where(F.col("upto") > F.col("rest"))
        .groupBy("of")
        .agg(F.min(F.struct("slice", (F.col("rest") - F.col("upto") + F.col("size")).alias("left"))).alias("cut"))
        .select("of", "cut.slice", "cut.left")
    )
    cut = cut_lineage(cut)

    inside = sized.withColumn("slice_of", _slice()).join(
        _side(cut, n), F.col("source").eqNullSafe(F.col("of")) & (F.col("slice_of") == F.col("slice"))
    )
    # rows that repeat an id and its text share a key: one group, whatever their number
    groups = inside.groupBy("of", "key").agg(F.count("*").alias("copies"), F.any_value("size").alias("size"), F.any_value("left").alias("left"))
    every = F.col("copies") * F.col("size")
    before = F.coalesce(F.sum(every).over(W.partitionBy("of").orderBy("key").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    last = (
        groups.withColumn("before", before)
        .where(F.col("before") + every > F.col("left"))
        .groupBy(F.col("of").alias("last_of"))
        .agg(F.min(F.struct("key", "copies", "size", "left", "before")).alias("cut"))
        .select(
            "last_of", F.col("cut.key").alias("cut_key"), F.col("cut.copies").alias("cut_copies"),
            F.floor((F.col("cut.left") - F.col("cut.before")) / F.col("cut.size") + 0.5).alias("cut_taken"),
        )
    )
    done = (
        due.join(cut.select("of", F.col("slice").alias("cut_slice")), F.col("source").eqNullSafe(F.col("of")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("last_of")), "left")
        .select("source", "source_size", "target", "whole", "cut_slice", "cut_key", "cut_copies", "cut_taken")
    )
    return sized, cut_lineage(done), n


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 17) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    ``taken`` is the row's words times its repetitions: none is above ``epochs``.
    A source's taken words differ from its target by at most one document; of rows
    that repeat an id with its text as many are taken as that needs.  Null and empty texts have size 0 and take nothing; a source of
    size 0 has target 0.  Null is a source of its own.  An empty table gives none.
    """
    sized, sources, n = plan(docs, weights, epochs, seed)
    joined = _timed(sized, sources, n)
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"))


def repeated(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), epochs: int = 3, seed: int = 17) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns as they are."""
    _, sources, n = plan(docs, weights, epochs, seed)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col("source").cast("string").alias("source"),
        order_key(seed).alias("key"),
    )
    often = _timed(rows, sources, n).select("row", "times").where("times > 0")
    return often.select("row", F.explode(F.sequence(F.lit(1), F.col("times")))).select("row.*")


def _timed(rows: DataFrame, sources: DataFrame, n: int) -> DataFrame:
    """Rows with ``source`` and ``key``, the columns of their source, and ``times``, their repetitions."""
    joined = rows.join(_side(sources.withColumnRenamed("source", "of"), n), F.col("source").eqNullSafe(F.col("of")))
    at_cut = F.coalesce((_slice() == F.col("cut_slice")) & (F.col("key") == F.col("cut_key")), F.lit(False))
    split = at_cut & (F.col("cut_taken") > 0) & (F.col("cut_taken") < F.col("cut_copies"))
    more = (_slice() < F.col("cut_slice")) | ((_slice() == F.col("cut_slice")) & (F.col("key") < F.col("cut_key"))) | (at_cut & (F.col("cut_taken") > 0))
    times = lambda once: F.col("whole") + F.coalesce(once, F.lit(False)).cast("int")
    if sources.where((F.col("cut_taken") > 0) & (F.col("cut_taken") < F.col("cut_copies"))).isEmpty():
        return joined.withColumn("times", times(more))
    # some of the rows that share a key: they are equal, so any order will do, as long as it is kept
    copies = joined.where(split).withColumn("__id", F.monotonically_increasing_id())
    numbered = number_rows(copies, ["of", "__id"], "__nth", start=0)
    first = numbered.groupBy("of").agg(F.min("__nth").alias("__first")).withColumnRenamed("of", "__of")
    met = numbered.join(_side(first, n), F.col("of").eqNullSafe(F.col("__of")))
    chosen = met.withColumn("times", times(F.col("__nth") - F.col("__first") < F.col("cut_taken")))
    others = joined.where(~F.coalesce(split, F.lit(False))).withColumn("times", times(more))
    return others.unionByName(chosen.select(*others.columns))


def _slice() -> Column:
    return F.shiftright("key", 64 - SLICE_BITS)


def _side(sources: DataFrame, n: int) -> DataFrame:
    return F.broadcast(sources) if n <= BROADCAST_SOURCES else sources
