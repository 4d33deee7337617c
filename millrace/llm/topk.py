"""Exact top-k inner products by columnar branch-and-bound.

Candidates and queries are packed into blocks in vertical layout (one run of
memory per dimension).  Candidate blocks are dealt to lanes, query blocks go to all
lanes, and the two meet by an equi join on the lane, so no pair of vectors is ever a
row and no candidate is moved twice.
Scores grow block of dimensions by block; after each, a candidate stays only if
its score so far and the most that the remaining mass can add reach the query's
tenth best, and the survivors are compacted.  A task carries the tenth best from
one candidate block to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Vectors of a candidate block and of a query block, dimensions added at a time.
CANDIDATES, QUERIES, STEP = 4096, 1024, 16
#: Query blocks whose best lists a task holds before it passes them on.
HELD = 32
#: Above this an inner product may not be exact in a double.
EXACT = float(1 << 53)

BLOCK = "dim int, block long, ids binary, columns binary"


def scaled(vectors: DataFrame) -> DataFrame:
    """Rows that take part: ``vec_id, v`` with v = floor(1024 * component) as exact doubles."""
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 1024).cast("double"))
    wide = F.transform("embedding", lambda x: x.cast("double") * 1024)
    usable = F.forall(wide, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    # a bigint holds floor() below 2**63; larger doubles are whole numbers already
    exact = F.zip_with(v, wide, lambda a, b: F.when(F.abs(b) < 2.0**62, a).otherwise(b))
    return vectors.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & usable).select(
        F.col("vec_id").cast("long").alias("vec_id"), exact.alias("v")
    )


def _packed(rows: DataFrame, size: int) -> DataFrame:
    """Blocks of at most ``size`` vectors of one length, in vertical layout."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids = np.concatenate([a for a, _ in held[dim]])
            columns = np.concatenate([b for _, b in held.pop(dim)]).T
            first = int(ids.min())
            return pa.RecordBatch.from_pylist(
                [{"dim": dim, "block": first, "ids": ids.tobytes(), "columns": np.ascontiguousarray(columns).tobytes()}],
                pa.schema([("dim", pa.int32()), ("block", pa.int64()), ("ids", pa.binary()), ("columns", pa.binary())]),
            )

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(), batch.column(1)
            flat, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
            lengths = np.diff(ends, prepend=0)
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                rows_ = flat[(ends[at] - dim)[:, None] + np.arange(dim)]
                for k in range(0, len(at), size):
                    held.setdefault(int(dim), []).append((ids[at[k : k + size]], rows_[k : k + size]))
                    if sum(len(a) for a, _ in held[int(dim)]) >= size:
                        yield out(int(dim))
        for dim in list(held):
            yield out(dim)

    return rows.mapInArrow(run, BLOCK)


class Best:
    """The best ``k`` of every query of a block so far: scores falling, then ids rising."""

    def __init__(self, ids: np.ndarray, columns: np.ndarray, k: int):
        self.ids, self.rows, self.k = ids, np.ascontiguousarray(columns.T), k
        self.found: list[list[tuple]] = [[] for _ in ids]
        self.least = np.full(len(ids), -np.inf)

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        keep = ids != self.ids[q]
        scores, ids = scores[keep], ids[keep]
        if len(ids) > self.k:
            order = np.lexsort((ids, -scores))[: self.k]
            scores, ids = scores[order], ids[order]
        both = self.found[q] + list(zip((-scores).tolist(), ids.tolist(), strict=True))
        self.found[q] = sorted(both)[: self.k]
        if len(self.found[q]) == self.k:
            self.least[q] = -self.found[q][-1][0]

    def search(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """Take in a candidate block."""
        d, n = columns.shape
        largest = np.abs(self.rows).max(initial=0) * np.abs(columns).max(initial=0) * d
        if not largest < EXACT:
            whole = np.array([[int(x) for x in c] for c in columns], object)
            for q, row in enumerate(self.rows):
                scores = np.array([int(x) for x in row], object) @ whole
                self.offer(q, np.clip(scores, -(2**63), 2**63 - 1).astype(object), ids)
            return
        lead, led = min(n, 8 * self.k), np.isinf(self.least)
        if led.any():  # a first tenth best from the block's head
            head = self.rows @ columns[:, :lead]
            for q in np.flatnonzero(led):
                self.offer(q, head[q], ids[:lead])
        order = np.argsort(-np.abs(columns).sum(axis=1), kind="stable")
        columns, rows = columns[order], self.rows[:, order]
        # mass of what is left after each step, for candidates and queries
        c_rest = [np.sqrt((columns[s:] ** 2).sum(axis=0)) for s in range(STEP, d + STEP, STEP)]
        q_rest = [np.sqrt((rows[:, s:] ** 2).sum(axis=1)) for s in range(STEP, d + STEP, STEP)]
        start = rows[:, :STEP] @ columns[:STEP]
        for q in range(len(rows)):
            score, need = start[q], self.least[q]
            alive = np.flatnonzero(score + q_rest[0][q] * c_rest[0] * (1 + 1e-9) + 1 > need)
            score = score[alive]
            for k, s in enumerate(range(STEP, d, STEP), 1):
                if not len(alive):
                    break
                score = score + rows[q, s : s + STEP] @ columns[s : s + STEP, alive]
                stay = score + q_rest[k][q] * c_rest[k][alive] * (1 + 1e-9) + 1 > need
                alive, score = alive[stay], score[stay]
            good = (score >= need) & ((alive >= lead) | ~led[q])  # the head was offered above
            if good.any():
                self.offer(q, score[good], ids[alive[good]])


def top_k(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` largest inner products.

    Queries are the rows of ``vectors`` for which ``queries`` holds, candidates
    all rows but those with the query's own id.  Vectors that are null, empty or
    hold null or non-finite components, and rows without an id, take no part;
    vectors of different lengths are not compared.  Ties go to the smaller id;
    candidate rows that repeat count each.  Of query rows that repeat an id the
    one with the smallest vector asks.  Scores beyond a long are cut to its range.
    """
    rows = stored(scaled(vectors), "vectors")
    asked = rows.where(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    parts = max(1, -(-rows.where(queries).count() // QUERIES))
    asked = _packed(asked.repartition(parts), QUERIES).select(
        "dim", F.monotonically_increasing_id().alias("query_block"), F.col("ids").alias("query_ids"), F.col("columns").alias("query_columns")
    )
    lanes = max(8, 4 * vectors.sparkSession.sparkContext.defaultParallelism)
    asked = stored(asked, "queries").withColumn("lane", F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))))
    dealt = _packed(rows, CANDIDATES).select(
        F.col("dim").alias("of_dim"), F.pmod(F.xxhash64("block", "dim"), F.lit(lanes)).cast("int").alias("of_lane"), "ids", "columns"
    )
    # queries lead, so that a task meets all candidate blocks of its lane for one query block in a row; merged,
    # because Spark's estimate of the exploded side is a lane's share, and it would be broadcast whole
    met = asked.hint("merge").join(dealt, (F.col("dim") == F.col("of_dim")) & (F.col("lane") == F.col("of_lane")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                d = row["dim"]
                columns = np.frombuffer(row["columns"], np.float64).reshape(d, -1)
                best = held.get(row["query_block"])
                if best is None:
                    if len(held) >= HELD:
                        yield _rows(held.pop(next(iter(held))))
                    asked_ids = np.frombuffer(row["query_ids"], np.int64)
                    best = Best(asked_ids, np.frombuffer(row["query_columns"], np.float64).reshape(d, -1), k)
                    held[row["query_block"]] = best
                best.search(np.frombuffer(row["ids"], np.int64), columns)
        for best in held.values():
            yield _rows(best)

    met = met.select("dim", "ids", "columns", "query_block", "query_ids", "query_columns")
    partial = met.mapInArrow(run, "query_id long, vec_id long, score long")
    order = W.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = partial.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def _rows(best: Best) -> pa.RecordBatch:
    flat = [(int(q), i, int(-s)) for q, found in zip(best.ids, best.found, strict=True) for s, i in found]
    columns = list(zip(*flat, strict=True)) or [()] * 3
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])
