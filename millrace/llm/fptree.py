"""Ranked lexical search by branch and bound over FP-trees of documents.

A document is restricted to the terms that some item asks for.  The restricted
terms, most frequent first, are its path, so documents that share frequent terms
share the head of a trie (an FP-tree).  A task builds the trie of one block of
documents at a time; every node keeps, over the documents below it, the largest
count of each term and the least length measure ``m``.  Both give an upper bound
for every document below, because a term's part grows with its count and falls
with ``m``.  For each item the trie is walked depth-first, better children first,
and a subtree is left out when its bound is below the k-th best score so far.

Items are few against documents, but their number is not bounded: they come in
blocks of a stated size, each of which is sent to all tasks and passes over the
documents once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import stored

#: Bytes of item texts that are sent at once; what one block asks for is at most this much.
ITEM_BYTES = 256 << 10
#: Cells (documents times terms) of one trie, and documents of one trie at most.
CELLS, DOCUMENTS = 12 << 20, 4096
#: A node with so many documents or fewer is a leaf; paths are told apart by so many terms.
LEAF, DEPTH = 32, 16
#: Parts of an item's candidates that are cut to the best k before they meet.
SALTS = 64

#: Letters, digits and everything beyond ASCII make terms; only A-Z is lowered.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)

VECTOR = "doc_id long, n long, terms binary, counts binary"


def terms(text: str | None) -> list[bytes]:
    """Terms of a text in order, as UTF-8; null has none."""
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def restricted(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Length and counts of the vocabulary's terms for every document that has a term."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shared.value
        for batch in batches:
            ids, sizes, held, counts = [], [], [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                known = Counter(k for k in map(number.get, found) if k is not None)
                ids.append(doc_id)
                sizes.append(len(found))
                held.append(np.fromiter(known.keys(), np.int32, len(known)).tobytes())
                counts.append(np.fromiter(known.values(), np.int32, len(known)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(held, pa.binary()), pa.array(counts, pa.binary())],
                ["doc_id", "n", "terms", "counts"],
            )

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, VECTOR)


def _flat(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int32)


def _frequencies(vectors: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """Documents, all their terms, and the documents of each vocabulary term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            docs += batch.num_rows
            length += int(batch.column(0).to_numpy().sum())
            seen += np.bincount(_flat(batch.column(1)), minlength=size)
        held = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([-2, -1, *held.tolist()], pa.int32()), pa.array([docs, length, *seen[held].tolist()], pa.int64())],
            ["term", "total"],
        )

    partial = vectors.select("n", "terms").mapInArrow(run, "term int, total long")
    found = dict(partial.groupBy("term").agg(F.sum("total")).collect())  # a row per term of the block
    df = np.zeros(size, np.int64)
    for term, total in found.items():
        if term >= 0:
            df[term] = total
    return found.get(-2, 0), found.get(-1, 0), df


class Tree:
    """The FP-tree of one block of documents; node 0 is the root.

    ``rows`` are the documents in path order, one column per term in order of
    frequency.  A node covers the rows ``lo`` to ``hi``; its children are nodes
    ``child`` to ``end`` (none for a leaf).
    """

    def __init__(self, ids: np.ndarray, m: np.ndarray, row_of: np.ndarray, terms_: np.ndarray, counts: np.ndarray, size: int):
        n = len(ids)
        order = np.lexsort((terms_, row_of))
        row_of, terms_, counts = row_of[order], terms_[order], counts[order]
        step = np.arange(len(row_of)) - np.searchsorted(row_of, np.arange(n))[row_of]
        paths = np.full((n, DEPTH), -1, np.int32)
        head = step < DEPTH
        paths[row_of[head], step[head]] = terms_[head]
        order = np.lexsort(paths.T[::-1])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        self.ids, self.m, paths = ids[order], m[order], paths[order]
        self.rows = np.zeros((n, size), np.int32)
        self.rows[place[row_of], terms_] = counts
        self._grow(paths, n)
        starts = self.lo[self.leaves]
        most, least = np.maximum.reduceat(self.rows, starts, axis=0), np.minimum.reduceat(self.m, starts)
        first, last = np.searchsorted(starts, self.lo), np.searchsorted(starts, self.hi)
        self.most = np.stack([most[a:b].max(axis=0) for a, b in zip(first, last, strict=True)])
        self.least = np.array([least[a:b].min() for a, b in zip(first, last, strict=True)])

    def _grow(self, paths: np.ndarray, n: int) -> None:
        lo, hi, child, end = [0], [n], [0], [0]
        todo = [(0, 0)]
        while todo:
            node, depth = todo.pop()
            a, b = lo[node], hi[node]
            while depth < DEPTH and paths[a, depth] == paths[b - 1, depth]:
                depth += 1  # documents lie in path order: equal ends, equal between
            if b - a <= LEAF or depth == DEPTH:
                continue
            cuts = a + 1 + np.flatnonzero(np.diff(paths[a:b, depth]))
            child[node] = len(lo)
            start = a
            for cut, after in zip([*cuts.tolist(), b], [*cuts[1:].tolist(), b, b], strict=True):
                if cut < b and after - start <= LEAF:
                    continue  # small neighbours share a leaf
                todo.append((len(lo), depth))
                lo.append(start), hi.append(cut), child.append(0), end.append(0)
                start = cut
            end[node] = len(lo)
        self.lo, self.hi, self.child, self.end = map(np.array, (lo, hi, child, end))
        leaves = np.flatnonzero(self.end == 0)
        self.leaves = leaves[np.argsort(self.lo[leaves])]

    def search(self, item: Item) -> None:
        """Offer an item every document that may belong to its best."""
        todo = [(int(item.value(self.most[:1, item.terms], self.least[:1])[0]), 0)]
        while todo:
            bound, node = todo.pop()
            if bound < item.need:
                continue
            if not self.end[node]:
                at = slice(self.lo[node], self.hi[node])
                item.offer(item.value(self.rows[at, item.terms], self.m[at]), self.ids[at])
                continue
            below = slice(self.child[node], self.end[node])
            bounds = item.value(self.most[below, item.terms], self.least[below])
            order = np.argsort(bounds, kind="stable")
            order = order[bounds[order] >= item.need]
            todo += zip(bounds[order].tolist(), (order + self.child[node]).tolist(), strict=True)


class Item:
    """An item's terms and weights, and its best documents so far."""

    def __init__(self, item_id: int, terms_: np.ndarray, weights: np.ndarray, k: int):
        self.id, self.terms, self.weights, self.k = item_id, terms_, weights, k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.need = 1  # scores of zero are no results

    def value(self, counts: np.ndarray, m: np.ndarray) -> np.ndarray:
        counts = counts.astype(np.int64)
        return (1_000_000_000 * counts // (1000 * counts + 20 * m[:, None])) @ self.weights

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= self.need
        if not good.any():
            return
        scores, ids = np.concatenate((self.scores, scores[good])), np.concatenate((self.ids, ids[good]))
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]
        if len(order) == self.k:
            self.need = int(self.scores[-1])


def _searched(vectors: DataFrame, asked: list[tuple[int, np.ndarray]], size: int, k: int) -> DataFrame:
    """The best ``k`` documents of each item within each task's documents."""
    n_docs, length, df = _frequencies(vectors, size)
    weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
    rank = np.empty(size, np.int64)
    rank[np.lexsort((np.arange(size), -df))] = np.arange(size)
    shared = vectors.sparkSession.sparkContext.broadcast((asked, weights, rank))
    most = max(1, min(DOCUMENTS, CELLS // max(1, size)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, weights, rank = shared.value
        items = [Item(i, rank[t], weights[t], k) for i, t in asked]
        held: list[pa.RecordBatch] = []

        def search() -> None:
            block = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            n, lists = block["n"].to_numpy(), block["terms"]
            sizes = np.array([len(x) // 4 for x in lists.to_pylist()])
            m = 100 - 50 + np.array([50 * x * n_docs // length for x in n.tolist()], np.int64)
            tree = Tree(block["doc_id"].to_numpy(), m, np.repeat(np.arange(len(n)), sizes), rank[_flat(lists)], _flat(block["counts"]), size)
            for item in items:
                tree.search(item)

        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, most - sum(b.num_rows for b in held))
                batch = batch.slice(part.num_rows)
                held.append(part)
                if sum(b.num_rows for b in held) == most:
                    search()
        if held:
            search()
        for item in items:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(item.ids), item.id)), pa.array(item.ids), pa.array(item.scores)], ["item_id", "doc_id", "score"]
            )

    whole = vectors.where(F.col("doc_id").isNotNull() & (F.length("terms") > 0))
    return whole.mapInArrow(run, "item_id long, doc_id long, score long")


def rank(docs: DataFrame, items: DataFrame, k: int = 50) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above zero.

    Ties go to the smaller doc_id; rows that repeat count each.  Documents that are
    null, empty or without a term have no part in any number; those without an id
    count in the statistics and are never returned.  Of item rows that repeat an id
    the one with the smallest text asks; items without an id or a term give no rows.
    Empty tables give no rows, other columns are not read.
    """
    spark = docs.sparkSession
    asked = (
        items.where(F.col("item_id").isNotNull() & F.col("text").isNotNull())
        .groupBy(F.col("item_id").cast("long").alias("item_id"))
        .agg(F.min(F.col("text").cast("string")).alias("text"))
    )
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // ITEM_BYTES))
    found = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for block in range(blocks):
        mine = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        number: dict[bytes, int] = {}
        queries = []
        for item_id, text in sorted(mine):
            held = dict.fromkeys(terms(text))
            queries.append((item_id, np.array([number.setdefault(t, len(number)) for t in held], np.int64)))
        queries = [q for q in queries if len(q[1])]
        if queries:
            vectors = stored(restricted(docs, number), "restricted")
            found = found.union(_searched(vectors, queries, len(number), k))
    salted = found.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    for keys in (["item_id", "salt"], ["item_id"]):
        order = W.partitionBy(*keys).orderBy(F.col("score").desc(), "doc_id")
        salted = salted.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return salted.select("item_id", "rank", "doc_id", "score")
