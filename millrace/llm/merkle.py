"""A Merkle manifest of a dataset, with leaf coordinates by bitmap rank.

Every row is a leaf of its group's tree (a group is a language).  Where a leaf
stands is not found by sorting leaves: the ids of a group form a bitmap, kept as
its non-zero 64-bit words, that partial aggregation merges by OR.  A popcount
directory (blocks of words, blocks of blocks) gives the number of ids before each
word, and a leaf's position is that number plus the popcount of the bits below its
own.  Positions are the keys of the tree: leaves with the same position div 512
are put in one array by their slots, and one task reduces three levels of it.
The tops of these arrays are the leaves of the next step, so the number of
shuffles is a third of the number of levels and each is 512 times smaller.

On the way down each array gets the runs that lie on its path to the root, so a
proof and the root that it folds to are computed where the array is.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.numbering import number_rows
from .common import id_crc, stored

#: Children of a node, and levels that one task reduces at once.
FAN, LEVELS = 8, 3
SPAN = FAN**LEVELS
#: Words of a directory block, and blocks of a block of blocks, as powers of two.
BLOCK_BITS = 12

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(**columns: Column) -> Column:
    """Lowercase hex SHA-256 of the fields, each as its byte count, a colon and its value, or ``-``."""
    parts = []
    for name in FIELDS:
        value = columns.get(name, F.col(name)).cast("string")
        length = F.octet_length(value).cast("string")
        parts.append(F.coalesce(F.concat(length, F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def tampered_text() -> Column:
    """The text with A-Z lowered and nothing else."""
    return F.translate(F.col("text").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def leaves(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, leaf, changed``: each row's leaf, and the one of its tampered copy where there is one.

    ``changed`` is null where nothing is tampered with, which includes rows without an id.
    """
    rows = docs.select(*[F.col(name).cast("long" if name in ("doc_id", "n_chars") else "string") for name in FIELDS])
    tampered = F.when(F.col("doc_id").isNotNull() & (id_crc("doc_id") % 3 == 0), leaf_digest(text=tampered_text()))
    return rows.select("doc_id", "lang", leaf_digest().alias("leaf"), tampered.alias("changed"))


def _at_bit(pattern: int) -> Column:
    """A pattern moved up to the id's bit in its word."""
    return F.call_function("shiftleft", F.lit(pattern).cast("long"), F.col("doc_id").bitwiseAND(F.lit(63)).cast("int"))


def rank_directory(rows: DataFrame) -> DataFrame:
    """``lang, word, bits, rows, before`` for every non-zero word of each language's bitmap of ids.

    ``bits`` are the 64 ids from ``64 * word`` on, ``rows`` counts rows with one of
    these ids and ``before`` the language's rows below them.  A null language is a
    language of its own.  Rows without an id have a null word, no bits, and come
    before all others.  Every window holds 4096 words, 4096 blocks of words, or the
    blocks of those, one for 2 ** 30 ids.
    """
    words = rows.groupBy("lang", F.shiftright("doc_id", 6).alias("word")).agg(F.bit_or(_at_bit(1)).alias("bits"), F.count("*").alias("rows"))
    words = stored(words, "bitmap").withColumn("block", F.shiftright("word", BLOCK_BITS))
    blocks = words.groupBy("lang", "block").agg(F.sum("rows").alias("rows")).withColumn("outer", F.shiftright("block", BLOCK_BITS))
    outers = blocks.groupBy("lang", "outer").agg(F.sum("rows").alias("rows"))
    outers = _running(outers, [], "outer")
    blocks = _started(_running(blocks, ["outer"], "block"), outers, "outer")
    return _started(_running(words, ["block"], "word"), blocks, "block").drop("block")


def _running(table: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Adds the rows before each entry of its block."""
    order = W.partitionBy("lang", *keys).orderBy(F.col(at).asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    return table.withColumn("before", F.coalesce(F.sum("rows").over(order), F.lit(0).cast("long")))


def _started(table: DataFrame, above: DataFrame, key: str) -> DataFrame:
    """Adds the rows before the entry's block to those before it in the block."""
    start = above.select(F.col("lang").alias("of_lang"), F.col(key).alias("of_key"), F.col("before").alias("start"))
    met = table.join(start, F.col("lang").eqNullSafe(F.col("of_lang")) & F.col(key).eqNullSafe(F.col("of_key")))
    return met.withColumn("before", F.col("before") + F.col("start")).drop("of_lang", "of_key", "start")


def positions(rows: DataFrame) -> DataFrame:
    """Adds ``position`` from 0 among a language's rows, and ``members``, their number.

    A rank query per row: rows before its word, plus the bits below its own.  Words
    with more rows than bits hold repeated ids; their counts go along with the word,
    and only the rows that share an id (or have none) are numbered by a range sort,
    by leaf, so that no id and no language is a task of its own.
    """
    words = stored(rank_directory(rows), "directory")
    members = words.groupBy("lang").agg(F.sum("rows").alias("members")).select(F.col("lang").alias("of_lang"), "members")
    crowded = words.where(F.coalesce(F.bit_count("bits"), F.lit(0)) < F.col("rows"))
    more = "array<struct<bit: int, more: bigint>>"
    if crowded.isEmpty():
        words, rows = words.withColumn("repeats", F.lit(None).cast(more)), rows.withColumn("within", F.lit(0).cast("long"))
    else:
        key = ["lang", "doc_id"]
        held = _meets(rows, crowded.select("lang", "word")).groupBy(*key).agg(F.count("*").alias("copies"))
        held = stored(held.where((F.col("copies") > 1) | F.col("doc_id").isNull()), "repeats")
        entry = F.struct(F.col("doc_id").bitwiseAND(F.lit(63)).cast("int").alias("bit"), (F.col("copies") - 1).alias("more"))
        repeats = held.groupBy("lang", F.shiftright("doc_id", 6).alias("word")).agg(F.collect_list(entry).alias("repeats"))  # 64 at most
        mine = repeats.select(F.col("lang").alias("of_lang"), F.col("word").alias("of_word"), "repeats")
        same_word = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("word").eqNullSafe(F.col("of_word"))
        words = words.join(mine, same_word, "left").drop("of_lang", "of_word")
        named = held.select(F.col("lang").alias("of_lang"), F.col("doc_id").alias("of_id"))
        same = F.col("lang").eqNullSafe(F.col("of_lang")) & F.col("doc_id").eqNullSafe(F.col("of_id"))
        among = number_rows(rows.join(named, same, "left_semi"), [*key, "leaf", "changed"], "number", start=0)
        first = among.groupBy(*key).agg(F.min("number").alias("first"))
        first = first.select(F.col("lang").alias("of_lang"), F.col("doc_id").alias("of_id"), "first")
        among = among.join(first, same).withColumn("within", F.col("number") - F.col("first"))
        alone = rows.join(named, same, "left_anti").withColumn("within", F.lit(0).cast("long"))
        rows = alone.unionByName(among.select(*alone.columns))
    words = words.select(F.col("lang").alias("of_lang"), "word", "bits", "before", "repeats")
    same_word = F.col("lang").eqNullSafe(F.col("of_lang")) & F.shiftright("doc_id", 6).eqNullSafe(F.col("word"))
    low = F.col("doc_id").bitwiseAND(F.lit(63)).cast("int")
    below = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(_at_bit(-1))))
    copies = F.aggregate("repeats", F.lit(0).cast("long"), lambda n, x: n + F.when(x["bit"] < low, x["more"]).otherwise(0))
    position = F.col("before") + F.coalesce(below, F.lit(0)) + F.coalesce(copies, F.lit(0)) + F.col("within")
    placed = rows.join(words, same_word).withColumn("position", position).select(*rows.columns, "position")
    return placed.drop("within").join(members, F.col("lang").eqNullSafe(F.col("of_lang"))).drop("of_lang")


def _meets(rows: DataFrame, words: DataFrame) -> DataFrame:
    words = words.select(F.col("lang").alias("of_lang"), "word")
    return rows.join(words, F.col("lang").eqNullSafe(F.col("of_lang")) & F.shiftright("doc_id", 6).eqNullSafe(F.col("word")), "left_semi")


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _levels(digests: list[str], members: int, step: int) -> list[list[str]]:
    """The array's own level and those that this step computes from it; the last has one node."""
    depth = 0
    while FAN**depth < members:
        depth += 1
    out = [digests]
    for _ in range(max(0, min(LEVELS, depth - LEVELS * step))):
        below = out[-1]
        out.append([_hash("".join(below[k : k + FAN])) for k in range(0, len(below), FAN)])
    return out


def _runs(levels: list[list[str]], at: int) -> list[tuple[int, str]]:
    """The runs on the way from a node of the array to the array's top: own slot, and all digests as one text."""
    out = []
    for level in levels[:-1]:
        slot, start = at % FAN, at - at % FAN
        out.append((slot, "".join(level[start : start + FAN])))
        at //= FAN
    return out


def _siblings(runs: list[tuple[int, str]]) -> str:
    return "".join(run[: 64 * slot] + run[64 * slot + 64 :] for slot, run in runs)


def _fold(digest: str, runs: list[tuple[int, str]]) -> str:
    for slot, run in runs:
        digest = _hash(run[: 64 * slot] + digest + run[64 * slot + 64 :])
    return digest


#: The way of a node to the root, its tree's top, and the root.
PATH = "tree string, position long, path array<struct<slot: int, run: string>>, subroot string, root string"


def _arrays(nodes: DataFrame, kept: tuple[str, ...] = ()) -> DataFrame:
    """Nodes whose positions agree but for the last three digits (base 8), in one array by slot."""
    entry = F.struct(F.pmod("position", F.lit(SPAN)).alias("slot"), "digest", *kept)
    part = F.shiftright("position", 3 * LEVELS)  # three bits a level
    arrays = nodes.groupBy("tree", "members", part.alias("part")).agg(F.array_sort(F.collect_list(entry)).alias("nodes"))
    return stored(arrays, "arrays")


def _tops(arrays: DataFrame, step: int) -> DataFrame:
    """Each array's top as a node of the next step."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column(2).to_pylist(), batch.column(1).to_pylist(), strict=True)
            tops = [_levels(digests, members, step)[-1][0] for digests, members in rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), pa.array(tops, pa.string())], ["tree", "members", "position", "digest"])

    return arrays.select("tree", "members", "nodes.digest", "part").mapInArrow(run, "tree string, members long, position long, digest string")


def _climb(arrays: DataFrame, most: int) -> tuple[list[DataFrame], DataFrame]:
    """The arrays of every step up to the trees' tops, and the tops."""
    steps = [arrays]
    while True:
        tops = _tops(steps[-1], len(steps) - 1)
        if SPAN ** len(steps) >= most:
            return steps, tops
        steps.append(_arrays(tops))


def _with_paths(arrays: DataFrame, paths: DataFrame) -> DataFrame:
    """Arrays with the way of their top to the root."""
    above = paths.select(F.col("tree").alias("of_tree"), F.col("position").alias("of_part"), "path", "subroot", "root")
    same = F.col("tree").eqNullSafe(F.col("of_tree")) & (F.col("part") == F.col("of_part"))
    return arrays.join(above, same).drop("of_tree", "of_part")


def _descend(steps: list[DataFrame], paths: DataFrame) -> DataFrame:
    """The ways of the tops of the lowest arrays, from those of the trees' tops."""
    for step in range(len(steps) - 1, 0, -1):
        paths = _ways(_with_paths(steps[step], paths), step)
    return paths


def _ways(arrays: DataFrame, step: int) -> DataFrame:
    """The way of every node of the arrays to the root."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("path", pa.list_(pa.struct([("slot", pa.int32()), ("run", pa.string())]))),
                            ("subroot", pa.string()), ("root", pa.string())])
        for batch in batches:
            for row in batch.to_pylist():
                levels = _levels(row["digest"], row["members"], step)
                above = [(x["slot"], x["run"]) for x in row["path"]]
                made = [
                    {"tree": row["tree"], "position": SPAN * row["part"] + k, "subroot": row["subroot"], "root": row["root"],
                     "path": [{"slot": s, "run": r} for s, r in _runs(levels, k) + above]}
                    for k in range(len(row["digest"]))
                ]
                yield pa.RecordBatch.from_pylist(made, schema)

    rows = arrays.select("tree", "members", "part", F.col("nodes.digest").alias("digest"), "path", "subroot", "root")
    return rows.mapInArrow(run, PATH)


OUT = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def _proofs(arrays: DataFrame) -> DataFrame:
    """Every leaf's proof, and the root that its present leaf folds to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
        for batch in batches:
            for row in batch.to_pylist():
                digests, root = row["digest"], row["root"]
                levels = _levels(digests, row["members"], 0)
                above = [(x["slot"], x["run"]) for x in row["path"]]
                rest, folded = _siblings(above), {}
                proofs, roots = [], []
                for k, (leaf, changed) in enumerate(zip(digests, row["changed"], strict=True)):
                    runs = _runs(levels, k)
                    proofs.append(_hash(_siblings(runs) + rest))
                    top = _fold(leaf if changed is None else changed, runs)
                    if top not in folded:
                        folded[top] = _fold(top, above)
                    roots.append(folded[top])
                n = len(digests)
                columns = [pa.array(row["doc_id"], pa.int64()), digests, [row["subroot"]] * n, [root] * n, proofs, roots, [r == root for r in roots]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    rows = arrays.select("members", F.col("nodes.digest").alias("digest"), "nodes.doc_id", "nodes.changed", "path", "subroot", "root")
    return rows.mapInArrow(run, OUT)


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: leaf, tree tops, the proof's digest and what the present row folds to.

    Present rows differ from the manifest's where they are tampered with (a third of
    all, by id); ``verified`` is false where that changed the leaf.  Null fields are
    part of a leaf.  A null language is a tree of its own and the first; rows
    without an id lead their tree, rows that share an id come by leaf, and rows
    that repeat are leaves each.  A lone leaf is its tree's top, a lone tree's top is
    the root, and a proof without siblings is the digest of nothing.  An empty table
    gives no rows; other columns are not read.
    """
    rows = stored(leaves(docs), "leaves")
    placed = positions(rows).select(F.col("lang").alias("tree"), "members", "position", F.col("leaf").alias("digest"), "doc_id", "changed")
    ground = _arrays(placed, ("doc_id", "changed"))
    most = ground.agg(F.max("members")).first()[0]
    if most is None:
        return docs.sparkSession.createDataFrame([], OUT)
    steps, tops = _climb(ground, most)
    trees = number_rows(tops.select(F.col("tree").alias("lang"), F.col("digest").alias("subroot")), [F.col("lang").asc_nulls_first()], "position", start=0)
    n_trees = trees.count()
    upper = trees.select(F.lit(None).cast("string").alias("tree"), F.lit(n_trees).cast("long").alias("members"), "position", F.col("subroot").alias("digest"))
    upper_steps, root = _climb(_arrays(upper), n_trees)
    root = root.first()["digest"]
    start = root_path(docs, root)
    ways = _ways(_with_paths(upper_steps[0], _descend(upper_steps, start)), 0)
    ways = ways.join(trees.select("lang", F.col("subroot").alias("top"), F.col("position").alias("at")), F.col("position") == F.col("at"))
    ways = ways.select(F.col("lang").alias("tree"), F.lit(0).cast("long").alias("position"), "path", F.col("top").alias("subroot"), "root")
    return _proofs(_with_paths(steps[0], _descend(steps, ways)))


def root_path(docs: DataFrame, root: str) -> DataFrame:
    """The way of the root to itself: no runs."""
    return docs.sparkSession.createDataFrame([(None, 0, [], None, root)], PATH)
