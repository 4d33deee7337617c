"""SimHash near-duplicates by a self-join of a binary trie.

Fingerprints are the majority bits of the XXH64 hashes of a text's word
shingles.  Distinct fingerprints form a binary trie.  Pairs of trie nodes are
walked together from the top: each step down adds the bits in which the two
prefixes differ, and a pair is dropped as soon as it exceeds the error budget.
The top of the trie is walked on 4096 prefix counts; each surviving pair of
subtries is a group that one task walks to the end.  Inside a task, node pairs
are arrays, expanded depth-first in bounded chunks, and pairs whose two
subtries already hang together are dropped, so a dense cluster of m near copies
gives m links and not m * m / 2.

Two operators use this.  ``near_duplicates`` links 64-bit fingerprints that differ in
a few bits.  ``similar_documents`` is for a stated similarity of shingle sets: its
fingerprints have several words, cut into slices with a trie each, and the width and
number of slices follow the number of texts (``slice_plan``), so that a text meets
about as many unrelated ones at any size.  What comes close in a slice is a candidate
if the bits allow it, and a link only if the shingle sets are similar enough.  Neither
leaves a task as a pair: the first walk names the members that have a candidate, the
second has their shingle sets at hand and unites what it has verified in place.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .common import stored, words
from .components import components

#: Prefix bits counted for the top of the trie: at most 2**12 counts reach the driver.
TOP_BITS = 12
#: The trie's top is cut at this depth at least, so that small tables spread too and
#: every fingerprint goes to the same number of pairs at all sizes below SUBTRIE * 16.
LEAST_DEPTH = 4
#: A subtrie is cut further (down to TOP_BITS) while it holds more fingerprints.
SUBTRIE = 50_000
#: Node pairs expanded at a time inside a task.
CHUNK = 200_000
#: Node pairs with at most so many member pairs are compared member by member.
FEW = 16
#: Member pairs compared at a time.
AT_ONCE = 2_000_000
#: Words of a wide fingerprint at least (as many least hashes are kept), and bits in which slices may differ.
WIDE, SLICE_BUDGET = 4, 3
#: Unrelated texts that come close to a text in any slice, on average at most; the share
#: of pairs at the threshold that come close in none; members of a group on average at most.
MEETINGS, MISSED, GROUP = 4000, 1e-4, 100_000
#: A candidate's bits may differ by so many standard deviations more than the mean of a
#: pair at the threshold, which is computed exactly for sets of up to EXACT shingles.
SIGMAS, EXACT = 4, 64


def shingle_hashes(parts: list[bytes], shingle: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``shingle`` words (of all words, if there are fewer), repeats included."""
    line = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(parts))
    spans = zip(starts[: len(parts) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashed = xxhash.xxh64_intdigest
    return np.fromiter((hashed(line[s:e], seed) for s, e in spans), np.uint64, len(parts) - k + 1)


def fingerprint(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """64 majority bits; a bit is 1 if more than half of the shingle hashes have it.

    A text of fewer words than ``shingle`` is one shingle; without words: 0.
    """
    parts = words(text)
    if not parts:
        return 0
    hashes, sums = shingle_hashes(parts, shingle, seed), np.zeros(64, np.int64)
    total = len(hashes)
    for at in range(0, total, 65536):
        block = hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        sums += np.unpackbits(block, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(sums * 2 > total).tobytes(), "big")


def wide_sketch(text: str | None, shingle: int = 5, seed: int = 42, wide: int = WIDE) -> tuple[bytes, int, list[int]]:
    """Majority bits over a text's distinct shingles, their number, and ``WIDE`` least hashes.

    The bits are ``wide`` big-endian words, each of which mixes the shingle hashes
    anew; the least hashes are those of the first mixes.  No words: all zero.
    """
    hashes = shingle_set(text, shingle, seed)
    if not len(hashes):
        return bytes(8 * wide), 0, [0] * WIDE
    sums, least = np.zeros(64 * wide, np.int64), np.full(wide, 2**64 - 1, np.uint64)
    for at in range(0, len(hashes), 16384):
        block = hashes[at : at + 16384, None] ^ (_ODD * np.arange(1, wide + 1, dtype=np.uint64))
        block = (block ^ (block >> np.uint64(31))) * _ODD
        block = (block ^ (block >> np.uint64(29))) * _ODD
        block ^= block >> np.uint64(32)
        least = np.minimum(least, block.min(axis=0))
        sums += np.unpackbits(block.astype(">u8").view(np.uint8), axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(sums * 2 > len(hashes)).tobytes(), len(hashes), least[:WIDE].view(np.int64).tolist()


def shingle_set(text: str | None, shingle: int = 5, seed: int = 42) -> np.ndarray:
    """The sorted distinct shingle hashes of a text; none without words."""
    parts = words(text)
    return np.unique(shingle_hashes(parts, shingle, seed)) if parts else np.zeros(0, np.uint64)


_ODD = np.uint64(0x9E3779B97F4A7C15)


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fp`` (the 64 bits as a signed long) for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fps = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(fps.view(np.int64))], ["doc_id", "text_hash", "fp"])

    return _texts(docs).mapInArrow(run, "doc_id long, text_hash long, fp long")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"))


def near_duplicates(docs: DataFrame, shingle: int = 3, budget: int = 3, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, fp, component_id`` for every row of ``docs``.

    text_hash tells rows of one id apart (``one_per_group``).  component_id is the smallest doc_id reachable over links of at most
    ``budget`` differing bits, the row's own included.  Null and empty texts have
    fingerprint 0 and link like any other; equal texts always meet.  A null
    doc_id is never the smallest one (a component of nothing else has null).
    Repeated rows stay.  An empty table gives no rows; other columns are not read.
    """
    marked = stored(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("doc_id").alias("least_id")))
    roots = components(trie_links(distinct.select("fp"), budget))
    joined = distinct.join(roots, distinct["fp"] == roots["id"], "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    joined = cut_lineage(joined)
    named = joined.join(joined.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    named = cut_lineage(named.select(F.col("fp").alias("of_fp"), "component_id"))
    return marked.join(named, marked["fp"] == named["of_fp"]).select("doc_id", "text_hash", "fp", "component_id")


def similar_documents(docs: DataFrame, least: float = 0.8, shingle: int = 5, seed: int = 42) -> DataFrame:
    """``doc_id, text_hash, component_id`` for every row of ``docs``: groups of similar texts.

    Texts link where the Jaccard similarity of their shingle sets is ``least`` or more;
    every link is verified on the sets (as 64-bit hashes).  Wide fingerprints only find
    the candidates.  Of pairs at exactly 0.8 they find 99.99 %, of closer ones more; of
    4 shingles against the same and one more, the worst case, 99 %.  Null ids, null
    and empty texts, repeats and empty tables as in ``near_duplicates``.
    """
    plan = slice_plan(docs.select(F.approx_count_distinct("text")).first()[0], least)
    limits = bit_limits(least, plan.wide)

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(zip(*(wide_sketch(t.as_py(), shingle, seed, plan.wide) for t in batch.column(1)), strict=True)) or [(), (), ()]
            columns = [pa.array(c, k) for c, k in zip(made, (pa.binary(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *columns], ["doc_id", "text_hash", "wide", "size", "least"])

    texts = _texts(docs)
    marked = stored(texts.mapInArrow(mark, "doc_id long, text_hash long, wide binary, size long, least array<long>"), "fingerprints")
    nodes = marked.groupBy(F.col("text_hash").alias("node")).agg(
        F.min("doc_id").alias("least_id"), *[F.any_value(c).alias(c) for c in ("wide", "size", "least")]
    )
    nodes = cut_lineage(nodes)
    # families of near copies first, so that the tries need not name all their pairs
    sure = similar_pairs(texts, head_pairs(nodes, limits, least), least, shingle, seed)
    roots = cut_lineage(components(sure))
    known = nodes.join(roots, F.col("node") == F.col("id"), "left").select("node", "wide", "size", F.coalesce("root", "node").alias("family"))
    more = slice_links(texts, cut_lineage(known), plan, least, shingle, seed)
    roots = components(roots.select(F.col("id").alias("a"), F.col("root").alias("b")).union(more))
    joined = nodes.join(roots, F.col("node") == F.col("id"), "left").select("node", "least_id", F.coalesce("root", "node").alias("root"))
    joined = cut_lineage(joined)
    named = joined.join(joined.groupBy("root").agg(F.min("least_id").alias("component_id")), "root")
    named = cut_lineage(named.select("node", "component_id"))
    return marked.join(named, F.col("text_hash") == F.col("node")).select("doc_id", "text_hash", "component_id")


def bit_limits(least: float, wide: int = WIDE) -> np.ndarray:
    """How many bits may differ, by the sizes of two shingle sets (beyond EXACT: EXACT + 1); -1: no such pair.

    Bits of a fingerprint are independent, so the differing ones are binomial; the
    share is that of a pair of these sizes with as little in common as ``least`` allows.
    """
    bits, limits = 64 * wide, np.full((EXACT + 2, EXACT + 2), -1, np.int64)
    limits[0, 0] = 0
    chance = [np.array([math.comb(n, k) / 2**n for k in range(n + 1)]) for n in range(EXACT + 1)]

    def majority(common: int, size: int) -> np.ndarray:
        """The chance that more than half of a set votes 1, by the votes among the common part."""
        own = chance[size - common]
        return np.array([own[max(0, size // 2 + 1 - k) :].sum() for k in range(common + 1)])

    for x in range(1, EXACT + 1):
        for y in range(x, EXACT + 1):
            common = math.ceil(least / (1 + least) * (x + y) - 1e-9)
            if common <= x:
                p, q = majority(common, x), majority(common, y)
                share = float((chance[common] * (p * (1 - q) + q * (1 - p))).sum())
                limits[x, y] = limits[y, x] = int(bits * share + SIGMAS * math.sqrt(bits * share * (1 - share)))
    # the share falls towards that of the angle as sets grow, so the larger half of the table is enough for all beyond
    angle = math.acos(2 * least / (1 + least)) / math.pi
    beyond = max(int(bits * angle + SIGMAS * math.sqrt(bits * angle * (1 - angle))), int(limits[EXACT // 2 :, EXACT // 2 :].max()))
    limits[EXACT + 1, 1:] = limits[1:, EXACT + 1] = beyond
    return limits


def _possible(limits: np.ndarray, least: float, wide: np.ndarray, size: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Which pairs of wide fingerprints (rows of words) sizes and bits allow to be similar."""
    x, y = size[i], size[j]
    good = np.minimum(x, y) >= least * np.maximum(x, y) - 1e-9
    at = np.flatnonzero(good)
    allowed = limits[np.minimum(x[at], EXACT + 1), np.minimum(y[at], EXACT + 1)]
    good[at] = np.bitwise_count(wide[i[at]] ^ wide[j[at]]).sum(axis=1, dtype=np.int64) <= allowed
    return good


def _wide_rows(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Wide fingerprints as rows of bytes."""
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), np.uint8).reshape(len(rows), -1 if rows else 8 * WIDE)


def head_pairs(nodes: DataFrame, limits: np.ndarray, least: float) -> DataFrame:
    """Candidates ``a, b``: each text and the smallest node that shares a least hash; at most WIDE for each."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = np.concatenate((_wide_rows(batch.column(1)), _wide_rows(batch.column(4)))).view(">u8").astype(np.uint64)
            size = np.concatenate((batch.column(2).to_numpy(), batch.column(5).to_numpy()))
            rows = np.arange(batch.num_rows)
            good = pa.array(_possible(limits, least, both, size, rows, rows + batch.num_rows))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(3).filter(good)], ["a", "b"])

    met = nodes.select(F.explode("least").alias("hash"), F.struct("node", "wide", "size").alias("own"))
    heads = met.groupBy("hash").agg(F.min("own").alias("head"))
    pairs = met.join(heads, "hash").where("own.node != head.node").select("own.node", "own.wide", "own.size", "head.node", "head.wide", "head.size")
    return pairs.toDF("node", "wide", "size", "node_2", "wide_2", "size_2").mapInArrow(check, "a long, b long").distinct()


def similar_pairs(texts: DataFrame, pairs: DataFrame, least: float, shingle: int, seed: int) -> DataFrame:
    """Those of ``pairs`` (``a, b``, hashes of texts) whose shingle sets have a Jaccard similarity of ``least`` or more."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), shingle, seed).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["node", "shingles"])

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for left, right in zip(batch.column(2), batch.column(3), strict=True):
                good.append(_similar(*(np.frombuffer(s.as_py(), np.uint64) for s in (left, right)), least))
            take = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(take), batch.column(1).filter(take)], ["a", "b"])

    pairs = cut_lineage(pairs)
    held = _texts_of(texts, pairs.select(F.explode(F.array("a", "b")).alias("node")))
    known = stored(held.mapInArrow(sets, "node long, shingles binary"), "shingles")
    left, right = known.toDF("node_a", "set_a"), known.toDF("node_b", "set_b")
    joined = pairs.join(left, F.col("a") == F.col("node_a")).join(right, F.col("b") == F.col("node_b"))
    return cut_lineage(joined.select("a", "b", "set_a", "set_b").mapInArrow(check, "a long, b long"))


#: Rows of a few numbers that are sent to all tasks at most; more are joined.
SENT = 500_000


def _side(rows: DataFrame) -> DataFrame:
    """A side of a join, kept; it is sent to all tasks if it is counted to be small, so that texts need not move."""
    rows = cut_lineage(rows)
    return F.broadcast(rows) if rows.count() <= SENT else rows


def _texts_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``text_hash, text`` of the named nodes, each once."""
    needed = _side(nodes.distinct())
    return texts.join(needed, F.col("text_hash") == F.col("node"), "left_semi").groupBy("text_hash").agg(F.any_value("text").alias("text"))


def one_per_group(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of ``found``, that of the smallest doc_id; columns as they are.

    Of rows that repeat an id with its text one stays.  A row without an id goes if
    its group has one with an id; else equal texts without an id become one.
    """
    rows = found.groupBy("doc_id", "text_hash").agg(F.min("component_id").alias("component_id"), F.count("*").alias("rows"))
    goes = F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    # only rows that go or repeat are looked up; all others pass
    marked = rows.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), goes.alias("goes"), "rows").where("goes OR rows > 1")
    marked = _side(marked)
    held = {f"column_{i}": F.col(f"`{c}`") for i, c in enumerate(docs.columns)}
    named = docs.select(*[c.alias(n) for n, c in held.items()], F.col("doc_id").cast("long").alias("id"), F.xxhash64(F.col("text").cast("string")).alias("hash"))
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("hash") == F.col("of_hash"))
    once = named.join(marked, same, "left_anti").select(*held)
    again = named.join(marked.where("NOT goes"), same).groupBy("id", "hash").agg(F.any_value(F.struct(*held)).alias("row"))
    more = again.select("row.*")
    return once.union(more).toDF(*docs.columns)


@dataclass(frozen=True)
class SlicePlan:
    """Slices of a wide fingerprint: their bits and number, blocks of a slice and those of them that must agree."""

    bits: int
    slices: int
    blocks: int

    @property
    def wide(self) -> int:
        """Words that hold all slices."""
        return max(WIDE, -(-self.bits * self.slices // 64))

    @property
    def combinations(self) -> list[tuple[int, ...]]:
        """Of two slices within the budget at least so many blocks agree: one of these choices does."""
        return list(combinations(range(self.blocks), self.blocks - SLICE_BUDGET))

    def masks(self) -> np.ndarray:
        """The bits of each choice of blocks, in a slice that stands at the top of 64 bits."""
        cuts = np.linspace(0, self.bits, self.blocks + 1).astype(int)
        ones = [((1 << int(b - a)) - 1) << int(64 - b) for a, b in zip(cuts, cuts[1:], strict=False)]
        return np.array([sum(ones[k] for k in choice) for choice in self.combinations], np.uint64)

    def keys(self, wide: np.ndarray) -> np.ndarray:
        """The slices of wide fingerprints (rows of bytes), each at the top of 64 bits."""
        flat = np.unpackbits(wide, axis=1)[:, : self.slices * self.bits].reshape(-1, self.slices, self.bits)
        whole = np.zeros((*flat.shape[:2], 64), np.uint8)
        whole[:, :, : self.bits] = flat
        return np.packbits(whole, axis=2).view(">u8").reshape(-1, self.slices).astype(np.uint64)


def slice_plan(n: int, least: float) -> SlicePlan:
    """Slices for ``n`` texts: as narrow as unrelated meetings allow, as many as recall needs.

    A bit differs for a pair at the threshold with the chance of its angle; for
    unrelated texts every second one does.
    """
    share = math.acos(2 * least / (1 + least)) / math.pi
    for bits in range(16, 61):
        within = [math.comb(bits, k) for k in range(SLICE_BUDGET + 1)]
        close = sum(c * share**k * (1 - share) ** (bits - k) for k, c in enumerate(within))
        slices = math.ceil(math.log(MISSED) / math.log(1 - close))
        if n * slices * sum(within) / 2**bits <= MEETINGS:
            break
    blocks = next((m for m in range(SLICE_BUDGET + 1, 8) if n / 2 ** (bits * (m - SLICE_BUDGET) // m) <= GROUP), 8)
    return SlicePlan(bits, slices, blocks)


def slice_links(texts: DataFrame, nodes: DataFrame, plan: SlicePlan, least: float, shingle: int, seed: int) -> DataFrame:
    """Links ``a, b`` that connect nodes of different families whose shingle sets are similar enough.

    ``nodes`` has ``node, wide, size, family``; ``texts`` has ``text`` and ``text_hash``,
    the node.  A group holds the nodes that agree in a choice of blocks of a slice.  A
    group gives at most one row for each member, first those with a candidate, then
    the link of each that was united with another.
    """
    masks, limits = plan.masks(), bit_limits(least, plan.wide)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 8192):
                batch = whole.slice(at, 8192)
                keys = plan.keys(_wide_rows(batch.column(1)))
                for k in range(plan.slices):
                    for c, mask in enumerate(masks):
                        # a group's number mixes the slice, the choice of blocks, and their bits
                        group = ((keys[:, k] & mask) ^ np.uint64(k * len(masks) + c)).view(np.int64)
                        choice = pa.array(np.full(len(group), k * len(masks) + c, np.int32))
                        yield pa.RecordBatch.from_arrays([pa.array(group), *batch.columns, choice], ["group", "node", "wide", "size", "family", "choice"])

    class Members:
        """The members of a group in the order of their slice, with their families as numbers."""

        def __init__(self, table: pa.Table):
            self.slice, self.blocks = divmod(table["choice"][0].as_py(), len(masks))
            wide = _wide_rows(table["wide"])
            keys = plan.keys(wide)
            self.order = np.argsort(keys[:, self.slice], kind="stable")
            self.keys, self.wide = keys[self.order], wide[self.order].view(">u8").astype(np.uint64)
            self.size = table["size"].to_numpy()[self.order]
            first, label = np.unique(table["family"].to_numpy()[self.order], return_index=True, return_inverse=True)[1:]
            self.label = first[label]  # the family's first member

        def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            """Pairs of different families that may be similar and meet in no group before this one."""
            label, mine = self.label, self.keys[:, self.slice]
            for i, j in _meetings(mine, None, SLICE_BUDGET, label, plan.bits):
                near = (i < j) & (label[i] != label[j])
                near[near] = np.bitwise_count(mine[i[near]] ^ mine[j[near]]) <= SLICE_BUDGET
                near[near] = _possible(limits, least, self.wide, self.size, i[near], j[near])
                i, j = i[near], j[near]
                first = (np.bitwise_count(self.keys[i, : self.slice] ^ self.keys[j, : self.slice]) > SLICE_BUDGET).all(axis=1)
                first &= (((mine[i] ^ mine[j])[:, None] & masks[: self.blocks]) != 0).all(axis=1)
                yield i[first], j[first]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        members = Members(table)
        has = np.zeros(table.num_rows, bool)
        for i, j in members.candidates():
            has[i] = has[j] = True
        yield from table.select(["group", "choice", "node"]).take(pa.array(members.order[has])).to_batches()

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), shingle, seed).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["of_node", "shingles"])

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        members = Members(table)
        label, node = members.label, table["node"].to_numpy()[members.order]
        shingles = [np.frombuffer(x, np.uint64) for x in table["shingles"].take(pa.array(members.order)).to_pylist()]
        links = []
        for i, j in members.candidates():
            lot = np.argsort(i, kind="stable")
            for a, b in zip(i[lot].tolist(), j[lot].tolist(), strict=True):
                if label[a] != label[b] and _similar(shingles[a], shingles[b], least):
                    links.append((a, b))
                    low, high = sorted((label[a], label[b]))
                    label[label == high] = low
        ends = np.array(links, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays([pa.array(node[ends[:, 0]]), pa.array(node[ends[:, 1]])], ["a", "b"])

    row = "group long, node long, wide binary, size long, family long, choice int"
    dealt = nodes.select("node", "wide", "size", "family").mapInArrow(deal, row)
    found = cut_lineage(dealt.groupBy("group", "choice").applyInArrow(find, "group long, choice int, node long"))
    held = _texts_of(texts, found.select("node"))
    known = stored(held.mapInArrow(sets, "of_node long, shingles binary"), "shingles")
    met = found.join(nodes.select(F.col("node").alias("same_node"), "wide", "size", "family"), F.col("node") == F.col("same_node"))
    met = met.join(known, F.col("node") == F.col("of_node")).select("group", "choice", "node", "wide", "size", "family", "shingles")
    return cut_lineage(met.groupBy("group", "choice").applyInArrow(unite, "a long, b long"))


def _similar(x: np.ndarray, y: np.ndarray, least: float) -> bool:
    """Whether two sorted sets have a Jaccard similarity of ``least`` or more; empty sets only with each other."""
    common = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()) if len(x) and len(y) else 0
    return common >= least * (len(x) + len(y) - common) - 1e-9


def _dealt(nodes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For members of subtries: which member goes where, once for each pair its subtrie is in."""
    times = first[nodes + 1] - first[nodes]
    rows = np.repeat(np.arange(len(nodes)), times)
    return rows, np.repeat(first[nodes] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())


def trie_links(distinct: DataFrame, budget: int = 3) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``budget`` bits of each other.

    ``distinct`` has one long column ``fp`` without repeats.  The links span the
    same components as all pairs within the budget and are at most one for each
    fingerprint and pair of subtries.
    """
    prefix = F.shiftrightunsigned("fp", 64 - TOP_BITS).cast("int")
    counts = np.zeros(1 << TOP_BITS, np.int64)
    for row in distinct.groupBy(prefix.alias("prefix")).count().collect():
        counts[row["prefix"]] = row["count"]
    node_of, first, pair, side = _top_pairs(counts, budget, LEAST_DEPTH)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Send each fingerprint to every pair of subtries that its own one is in."""
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            nodes = node_of[(fps.view(np.uint64) >> np.uint64(64 - TOP_BITS)).astype(np.int64)]
            for at in range(0, len(fps), 4096):
                rows, slots = _dealt(nodes[at : at + 4096], first)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pair[slots]), pa.array(side[slots]), pa.array(fps[at : at + 4096][rows])],
                    ["pair", "side", "fp"],
                )

    def walk(group: pd.DataFrame) -> pd.DataFrame:
        fps, sides = group["fp"].to_numpy().view(np.uint64), group["side"].to_numpy()
        left = np.sort(fps[sides == 0])
        right = np.sort(fps[sides == 1])
        a, b = walk_tries(left, right if len(right) else None, budget)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    dealt = distinct.select("fp").mapInArrow(deal, "pair int, side byte, fp long")
    return dealt.groupBy("pair").applyInPandas(walk, "a long, b long")


def _top_pairs(counts: np.ndarray, budget: int, least_depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cut the trie's top into subtries and pair those within the budget.

    Returns the subtrie of each prefix and, as offsets and two columns, the pairs
    that each subtrie takes part in and on which side.
    """
    nodes, leaves = [(0, 0)], []  # (depth, prefix of that many bits)
    while nodes:
        depth, prefix = nodes.pop()
        span = 1 << (TOP_BITS - depth)
        held = counts[prefix * span : (prefix + 1) * span].sum()
        if (held > SUBTRIE or depth < least_depth) and depth < TOP_BITS:
            nodes += [(depth + 1, prefix * 2), (depth + 1, prefix * 2 + 1)]
        elif held:
            leaves.append((depth, prefix))
    node_of = np.zeros(1 << TOP_BITS, np.int64)
    for k, (depth, prefix) in enumerate(leaves):
        span = 1 << (TOP_BITS - depth)
        node_of[prefix * span : (prefix + 1) * span] = k
    depths = np.array([d for d, _ in leaves], np.int64)
    heads = np.array([p for _, p in leaves], np.int64)
    owner, other = [], []
    for k in range(len(leaves)):  # at most 4096 rows of at most 4096 comparisons
        common = np.minimum(depths[k], depths[k:])
        apart = np.bitwise_count((heads[k] >> (depths[k] - common)) ^ (heads[k:] >> (depths[k:] - common)))
        near = np.flatnonzero(apart <= budget) + k
        owner.append(np.full(len(near), k))
        other.append(near)
    x = np.concatenate(owner) if owner else np.zeros(0, np.int64)
    y = np.concatenate(other) if other else np.zeros(0, np.int64)
    ids, two = np.arange(len(x), dtype=np.int32), x != y
    member = np.concatenate((x, y[two]))
    pair = np.concatenate((ids, ids[two]))
    side = np.concatenate((np.zeros(len(x), np.int8), np.ones(two.sum(), np.int8)))
    order = np.argsort(member, kind="stable")
    first = np.searchsorted(member[order], np.arange(len(leaves) + 1))
    return node_of, first, pair[order], side[order]


class _Trie:
    """Nodes of a binary trie over the first bits of sorted fingerprints, level by level."""

    def __init__(self, fps: np.ndarray, levels: int):
        self.fps, n = fps, len(fps)
        self.low: list[np.ndarray] = [np.zeros(1, np.int64)]  # first member of each node of a level
        self.child: list[np.ndarray] = []  # (2, nodes): the child for bit 0 and 1, or -1
        node = np.zeros(n, np.int64)
        for depth in range(levels):
            bit = ((fps >> np.uint64(63 - depth)) & np.uint64(1)).astype(np.int64)
            new = np.ones(n, bool)
            new[1:] = (node[1:] != node[:-1]) | (bit[1:] != bit[:-1])
            below = np.cumsum(new) - 1
            low = np.flatnonzero(new)
            child = np.full((2, len(self.low[-1])), -1, np.int32)
            child[bit[low], node[low]] = below[low]
            self.child.append(child)
            self.low.append(low)
            node = below
            if len(low) == n:  # only single members from here on
                break
        self.high = [np.append(x[1:], n) for x in self.low]


def walk_tries(left: np.ndarray, right: np.ndarray | None, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect everything within ``budget`` bits in one or between two tries.

    ``left`` and ``right`` are sorted distinct unsigned fingerprints; without
    ``right`` the trie is joined with itself.
    """
    everything = left if right is None else np.concatenate((left, right))
    label = _walk(left, right, budget, lambda i, j: np.bitwise_count(everything[i] ^ everything[j]) <= budget)
    linked = np.flatnonzero(label != np.arange(len(label)))
    return everything[linked], everything[label[linked]]


def _walk(left: np.ndarray, right: np.ndarray | None, budget: int, near: Callable[[np.ndarray, np.ndarray], np.ndarray], levels: int = 64) -> np.ndarray:
    """Each member's smallest member over links of sorted keys that come close and pass ``near``."""
    label = np.arange(len(left) + (0 if right is None else len(right)))
    for i, j in _meetings(left, right, budget, label, levels):
        good = near(i, j)
        if good.any():
            _unite(label, i[good], j[good])
    return label


def _meetings(left: np.ndarray, right: np.ndarray | None, budget: int, label: np.ndarray, levels: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Member pairs of sorted keys that come close, in lots; node pairs under one label are left out.

    The taker may unite labels in place between lots.
    """
    own = right is None
    if not len(left) or (not own and not len(right)):
        return
    a = _Trie(left, levels)
    b = a if own else _Trie(right, levels)
    shift = 0 if own else len(left)
    number = lambda: np.cumsum(np.concatenate(([0], label[1:] != label[:-1])))
    runs = number()  # members with equal neighbours share a number
    stack = [(0, np.zeros(1, np.int32), np.zeros(1, np.int32), np.zeros(1, np.int8))]
    deepest = min(len(a.child), len(b.child))
    while stack:
        depth, x, y, err = stack.pop()
        if len(x) > CHUNK:
            stack += [(depth, x[i : i + CHUNK], y[i : i + CHUNK], err[i : i + CHUNK]) for i in range(0, len(x), CHUNK)]
            continue
        xl, xh, yl, yh = a.low[depth][x], a.high[depth][x], b.low[depth][y] + shift, b.high[depth][y] + shift
        together = (runs[xl] == runs[xh - 1]) & (runs[yl] == runs[yh - 1]) & (label[xl] == label[yl])
        few = ((xh - xl) * (yh - yl) <= FEW) | (depth == deepest)
        check = np.flatnonzero(few & ~together)
        for xl_, xh_, yl_, yh_ in _pieces(xl[check], xh[check], yl[check], yh[check]):
            apart = ~((runs[xl_] == runs[xh_ - 1]) & (runs[yl_] == runs[yh_ - 1]) & (label[xl_] == label[yl_]))
            i, j = _members(xl_[apart], xh_[apart], yl_[apart], yh_[apart])
            yield i, j
            runs = number()
        go = ~(few | together)
        x, y, err = x[go], y[go], err[go]
        if not len(x):
            continue
        found = []
        for p, q in ((0, 0), (1, 1), (0, 1), (1, 0)):
            cx, cy = a.child[depth][p][x], b.child[depth][q][y]
            ok = (cx >= 0) & (cy >= 0)
            if p != q:
                ok &= err < budget
            if own and (p, q) == (1, 0):
                ok &= x != y
            found.append((cx[ok], cy[ok], err[ok] + np.int8(p != q)))
        stack.append((depth + 1, *(np.concatenate(k) for k in zip(*found, strict=True))))


def _pieces(xl: np.ndarray, xh: np.ndarray, yl: np.ndarray, yh: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The node pairs in lots of at most about AT_ONCE member pairs; large ones are cut."""
    total = (xh - xl) * (yh - yl)
    for k in np.flatnonzero(total > AT_ONCE):
        step = max(1, AT_ONCE // int(yh[k] - yl[k]))
        for low in range(int(xl[k]), int(xh[k]), step):
            yield np.array([low]), np.array([min(low + step, int(xh[k]))]), yl[k : k + 1], yh[k : k + 1]
    small = np.flatnonzero(total <= AT_ONCE)
    lot = np.cumsum(total[small]) // AT_ONCE
    for part in np.split(small, np.flatnonzero(np.diff(lot)) + 1):
        if len(part):
            yield xl[part], xh[part], yl[part], yh[part]


def _members(xl: np.ndarray, xh: np.ndarray, yl: np.ndarray, yh: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All member pairs of node pairs that have few of them."""
    nx, ny = xh - xl, yh - yl
    total = nx * ny
    if (total == 1).all():
        return xl, yl
    at = np.arange(total.sum()) - np.repeat(np.cumsum(total) - total, total)
    return np.repeat(xl, total) + at // np.repeat(ny, total), np.repeat(yl, total) + at % np.repeat(ny, total)


def _unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Merge the sets of i and j; ``label`` is each member's smallest member."""
    while True:
        low = np.minimum(label[i], label[j])
        if (label[i] == label[j]).all():
            return
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while True:
            jumped = label[label]
            if (jumped == label).all():
                break
            label[:] = jumped
