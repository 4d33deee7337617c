"""Near-duplicate vectors by spherical-cap filters from random product codes.

After Becker, Ducas, Gama and Laarhoven, "New directions in nearest neighbor
searching" (2016).  A filter is a pair of code words, one for each half of a randomly
rotated vector; a vector belongs to every filter whose direction it exceeds by its
threshold, which sorted half scores list without looking at the others.  The
threshold is the vector's own: the score that a fixed number of directions reach, six
for each doubling of the code.  (With one threshold for all, vectors whose halves
score low have few filters or none: at a cosine of exactly 0.93, 137 of 3000 pairs
were missed with a code of 75 words; so, none of 12000 with any code from 16 to 1000
words.)  Vectors
meet where filter (and label) agree and are verified in double precision.  The
codes grow with the square root of the largest label, so a filter holds a
similar number of vectors at every size.

A link is counted in the smallest filter that both ends share, so no list of pairs
is ever made; a filter sends on one count and one component member per vector.
Filters of many vectors are split into blocks that meet pairwise.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .components import components
from .simhash import _unite

#: Filters of a vector for each doubling of the code, and the code's words squared for each vector of the largest label.
FILTERS, SPREAD = 6, 0.75
#: Vectors of a filter that one group compares; more are split into blocks.
BLOCK = 2000
#: Split filters known to the tasks, at most; with more of them only larger ones are split.
SPLIT = 100_000
#: Vectors of fewer components have one filter: all of them.
LEAST_DIMENSIONS = 16


class Codes:
    """Rotation and code words for one number of dimensions."""

    def __init__(self, dim: int, words: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.dim, self.half, self.words = dim, (dim + 1) // 2, words
        self.rotation = np.linalg.qr(rng.standard_normal((2 * self.half, 2 * self.half)))[0][:dim]
        self.code = rng.standard_normal((2, words, self.half))
        self.code /= np.linalg.norm(self.code, axis=2, keepdims=True)
        # the n best sums are among those of ranks p and q with p * q <= n
        self.count = int(FILTERS * np.log2(words))
        rank = np.arange(1, min(words, self.count) + 1)
        self.p, self.q = (x.ravel() for x in np.nonzero(rank[:, None] * rank[None, :] <= self.count))

    def decode(self, units: np.ndarray) -> np.ndarray:
        """The numbers of the filters of each unit vector, rising."""
        if self.dim < LEAST_DIMENSIONS:
            return np.zeros((len(units), 1), np.int64)
        turned = units @ self.rotation
        a, b = turned[:, : self.half] @ self.code[0].T, turned[:, self.half :] @ self.code[1].T
        top = min(self.words, self.count)
        i, j = np.argsort(-a, axis=1)[:, :top], np.argsort(-b, axis=1)[:, :top]
        sums = np.take_along_axis(a, i, axis=1)[:, self.p] + np.take_along_axis(b, j, axis=1)[:, self.q]
        best = np.argpartition(-sums, self.count - 1, axis=1)[:, : self.count]
        return np.sort(np.take_along_axis(i[:, self.p] * self.words + j[:, self.q], best, axis=1), axis=1)


def unit(v: np.ndarray) -> np.ndarray:
    """Rows in double precision at length 1 (scaled first, so that squares cannot overflow)."""
    v = v.astype(np.float64)
    v = v / np.abs(v).max(axis=-1, keepdims=True)
    return v / np.sqrt((v * v).sum(axis=-1, keepdims=True))


def _arrays(lists: pa.ListArray) -> list[np.ndarray]:
    """The vectors of a batch, which may differ in length."""
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(lists.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(lists) else []


def near_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vectors``.

    Vectors of equal label and length link from a cosine of ``least`` up.  A null
    label, a vector that is null, empty or zero, or a null or non-finite component
    links with nothing.  Equal rows are found by equality and count as links of
    each other.  Ids that repeat stay rows of their own; a null id is never the
    smallest.  An empty table gives no rows; other columns are not read.
    """
    kind = vectors.schema["embedding"].dataType.elementType.simpleString()
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    able = F.col("label").isNotNull() & sound & F.exists("embedding", lambda x: x != 0)
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").alias("label"),
        F.transform("embedding", lambda x: x + F.lit(0).cast(kind)).alias("v"),  # -0.0 becomes 0.0
        F.coalesce(able, F.lit(False)).alias("able"),
    )
    distinct = rows.where("able").groupBy("label", "v").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("copies"))
    distinct = cut_lineage(distinct.withColumn("node", F.monotonically_increasing_id()))
    met = cut_lineage(_meetings(distinct, least))
    links = met.groupBy("node").agg(F.sum("links").alias("links")).withColumnRenamed("node", "linked")
    roots = components(met.select(F.col("node").alias("a"), F.col("root").alias("b")))
    joined = (
        distinct.join(links, F.col("node") == F.col("linked"), "left")
        .join(roots, F.col("node") == F.col("id"), "left")
        .select("label", "v", "least_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "node").alias("of"))
    )
    joined = cut_lineage(joined)
    least_of = joined.groupBy(F.col("of").alias("root")).agg(F.min("least_id").alias("component_id"))
    named = joined.join(least_of, F.col("of") == F.col("root")).select(
        F.col("label").alias("of_label"), F.col("v").alias("of_v"), "n_links", "component_id"
    )
    named = cut_lineage(named)
    linked = rows.where("able").join(named, (F.col("label") == F.col("of_label")) & (F.col("v") == F.col("of_v")))
    alone = rows.where("NOT able").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    both = linked.select("vec_id", "n_links", "component_id").union(alone)
    return both.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def _meetings(distinct: DataFrame, least: float) -> DataFrame:
    """``node, links, root``: per filter and vector its counted links and the least node it hangs with there."""
    largest = distinct.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    words = max(16, int(np.ceil(np.sqrt(largest * SPREAD))))

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Label hash and filter of each membership, to count them."""
        codes: dict[int, Codes] = {}
        for batch in batches:
            found = _decoded(_arrays(batch.column(1)), codes, words)
            counts = np.array([len(f) for f in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), counts))), pa.array(np.concatenate([*found, np.zeros(0, np.int64)]))],
                ["part", "filter"],
            )

    # equal hashes of different labels or lengths would only meet without being compared
    part = F.xxhash64("label", F.size("v")).alias("part")
    sizes = distinct.select(part, "v").mapInArrow(keys, "part long, filter long").groupBy("part", "filter").count()
    large = sizes.where(F.col("count") > BLOCK).orderBy(F.col("count").desc()).limit(SPLIT).collect()
    blocks = {(r["part"], r["filter"]): -(-r["count"] // BLOCK) for r in large}
    shared = distinct.sparkSession.sparkContext.broadcast(blocks)
    number = np.float32 if distinct.schema["v"].dataType.elementType.simpleString() == "float" else np.float64
    small = np.int32 if words**2 < 1 << 31 else np.int64

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each filter of a vector, or for each pair of its blocks there."""
        codes: dict[int, Codes] = {}
        names = ["part", "filter", "low", "high", "block", "node", "copies", "label", "raw", "filters"]
        for batch in batches:
            raw = _arrays(batch.column(1))
            found = _decoded(raw, codes, words)
            for start in range(0, len(raw), 64):
                out = []
                for k in range(start, min(start + 64, len(raw))):
                    p, node = batch.column(0)[k].as_py(), batch.column(2)[k].as_py()
                    rest = (node, batch.column(3)[k].as_py(), batch.column(4)[k].as_py(), raw[k].tobytes(), found[k].astype(small).tobytes())
                    for f in found[k].tolist():
                        n = shared.value.get((p, f), 1)
                        own = hash((node, 11)) % n
                        out += [(p, f, min(own, x), max(own, x), own, *rest) for x in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array(c) if c else pa.array([], t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.binary()]

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = [_compare(g, least, number, small) for _, g in group.assign(n=group["raw"].map(len)).groupby(["label", "n"])]
        return pd.concat(out) if out else pd.DataFrame({"node": [], "links": [], "root": []})

    dealt = distinct.select(part, "v", "node", "copies", F.col("label").cast("string").alias("label")).mapInArrow(
        deal, "part long, filter long, low long, high long, block long, node long, copies long, label string, raw binary, filters binary"
    )
    return dealt.groupBy("part", "filter", "low", "high").applyInPandas(compare, "node long, links long, root long")


def _decoded(vectors: list[np.ndarray], codes: dict[int, Codes], words: int) -> list[np.ndarray]:
    """Filters of vectors of mixed lengths."""
    found: list[np.ndarray] = [np.zeros(0, np.int64)] * len(vectors)
    lengths = np.array([len(v) for v in vectors])
    for dim in np.unique(lengths):
        code = codes.setdefault(int(dim), Codes(int(dim), words))
        at = np.flatnonzero(lengths == dim)
        for start in range(0, len(at), 256):
            some = at[start : start + 256]
            for k, f in zip(some, code.decode(unit(np.array([vectors[x] for x in some]))), strict=True):
                found[k] = f
    return found


def _compare(group: pd.DataFrame, least: float, number: type, small: type) -> pd.DataFrame:
    """All links of a group, counted for their ends, and the ends' components.

    A group is a filter, a block of it, or two blocks, between which alone it then looks.
    """
    group = group.sort_values("node", kind="stable")
    units = unit(np.frombuffer(b"".join(group["raw"]), number).reshape(len(group), -1))
    own, here = group["block"].to_numpy(), group["filter"].iloc[0]
    two = group["low"].iloc[0] != group["high"].iloc[0]
    copies, filters = group["copies"].to_numpy(), [np.frombuffer(f, small) for f in group["filters"]]
    links, label = np.zeros(len(group), np.int64), np.arange(len(group))
    for a in range(0, len(group), 1024):
        for b in range(a, len(group), 1024):
            i, j = np.nonzero(units[a : a + 1024] @ units[b : b + 1024].T >= least)
            i, j = i + a, j + b
            keep = (i < j) & ((own[i] != own[j]) | (not two))
            i, j = i[keep], j[keep]
            if not len(i):
                continue
            _unite(label, i, j)
            for at in range(0, len(i), 20_000):
                x, y = i[at : at + 20_000], j[at : at + 20_000]
                first = _first_common(filters, x, y) == here
                np.add.at(links, x[first], copies[y[first]])
                np.add.at(links, y[first], copies[x[first]])
    nodes = group["node"].to_numpy()
    met = (label != np.arange(len(group))) | (np.bincount(label, minlength=len(group)) > 1)
    return pd.DataFrame({"node": nodes[met], "links": links[met], "root": nodes[label[met]]})


def _first_common(filters: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest filter that both ends of each pair are in."""
    counts = np.array([len(filters[x]) + len(filters[y]) for x, y in zip(i, j, strict=True)])
    pair = np.repeat(np.arange(len(i)), counts)
    every = np.concatenate([f for x, y in zip(i, j, strict=True) for f in (filters[x], filters[y])])
    order = np.lexsort((every, pair))
    pair, every = pair[order], every[order]
    twice = np.flatnonzero((every[1:] == every[:-1]) & (pair[1:] == pair[:-1]))
    _, first = np.unique(pair[twice], return_index=True)
    return every[twice[first]]
