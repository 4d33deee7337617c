"""Judging versions of changed items in order: a scan that is cut where partitions end.

Whether a version is new depends on the item's last processed version, so an item's
versions are judged one after the other.  An item with very many versions must not
be one task, so rows are range partitioned by item and order, which cuts such an item
into pieces of equal size.  Every piece first says what it does to the last processed
version it is entered with: one result if that version has another tag than the
piece's first, one if it has the same, which may be that it stays.  The pieces of an
item are composed in order, two rows for each partition, and then all are judged
exactly from their starts.  A version can also equal an older one by its time alone,
which the two results leave out; so the exact ends are compared with those that were
expected, and pieces are judged again from the exact ends until all agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

#: A last processed version: tag and time, either may be empty.
Version = tuple[str, str]
PIECE = "part int, first boolean, item_id string, begin_etag string, begin_modified string, tag string, other array<string>, same array<string>"


def _matches(held: Version, etag: str | None, modified: str | None) -> bool:
    return bool((held[0] and etag == held[0]) or (held[1] and modified == held[1]))


def _end(held: Version, versions: list[tuple]) -> Version:
    """The last processed version after (etag, modified, error) rows in order."""
    for etag, modified, error in versions:
        if error is None and not _matches(held, etag, modified):
            held = (etag or "", modified or "")
    return held


def _piece(versions: list[tuple]) -> tuple[str | None, Version | None, Version | None]:
    """A piece's first tag, its end when entered with another tag, and with that tag; None where nothing changes."""
    good = [v for v in versions if v[2] is None]
    if not good:
        return None, None, None
    tag = good[0][0] or ""
    other = _end((good[0][0] or "", good[0][1] or ""), good[1:])
    run = next((k for k, v in enumerate(good) if not tag or v[0] != tag), None)
    same = None if run is None else _end((good[run][0] or "", good[run][1] or ""), good[run + 1 :])
    return tag, other, same


def _through(held: Version, tag: str | None, other: list | None, same: list | None) -> Version:
    if tag is None:
        return held
    if tag and held[0] == tag:
        return held if same is None else tuple(same)
    return tuple(other)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last item of a partition, each with what its piece does."""
    part, item, begin, versions, done = None, None, ("", ""), [], []

    def close() -> None:
        tag, other, same = _piece(versions)
        done.append((part, not done, item, *begin, tag, other, same))

    for batch in batches:
        for p, i, e, m, error, held_etag, held_modified in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if part is None or i != item:
                if part is not None and not done:
                    close()
                part, item, begin, versions = p, i, (held_etag or "", held_modified or ""), []
            versions.append((e, m, error))
    if part is not None:
        close()
    columns = list(zip(*done, strict=True)) or [()] * 8
    kinds = [pa.int32(), pa.bool_(), *[pa.string()] * 4, *[pa.list_(pa.string())] * 2]
    names = ["part", "first", "item_id", "begin_etag", "begin_modified", "tag", "other", "same"]
    yield pa.RecordBatch.from_arrays([pa.array([list(x) if isinstance(x, tuple) else x for x in c], k) for c, k in zip(columns, kinds, strict=True)], names)


def _starts(pieces: list) -> dict[int, Version]:
    """The last processed version that each partition's first item is entered with."""
    starts, item, held, known = {}, None, ("", ""), False
    for row in sorted(pieces, key=lambda r: (r["part"], not r["first"])):
        if not known or row["item_id"] != item:
            item, held, known = row["item_id"], (row["begin_etag"], row["begin_modified"]), True
        if row["first"]:
            starts[row["part"]] = held
        held = _through(held, row["tag"], row["other"], row["same"])
    return starts


def _judge(starts: dict[int, Version], kept: list[str]):
    """Rows of a partition in order -> their outcomes; the last row also has its item's end."""
    names = [*kept, "outcome", "__end_etag", "__end_modified"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        item, held, begun, waiting = None, ("", ""), False, None
        for batch in batches:
            if not batch.num_rows:
                continue
            if waiting is not None:
                yield waiting
            outcomes = []
            columns = [batch.column(c).to_pylist() for c in ("__part", "item_id", "etag", "last_modified", "error", "held_etag", "held_modified")]
            for p, i, e, m, error, held_etag, held_modified in zip(*columns, strict=True):
                if not begun and p in starts:
                    item, held, begun = i, starts[p], True
                elif not begun or i != item:
                    begun = True
                    item, held = i, (held_etag or "", held_modified or "")
                if _matches(held, e, m):
                    outcomes.append("skipped")
                elif error is not None:
                    outcomes.append("failed")
                else:
                    outcomes.append("processed")
                    held = (e or "", m or "")
            nothing = pa.nulls(batch.num_rows, pa.string())
            rows = [*batch.select(kept).columns, pa.array(outcomes)]
            # held back, because only the partition's last row has an end
            waiting = pa.RecordBatch.from_arrays([*rows, nothing, nothing], names)
        if waiting is not None:
            n = waiting.num_rows - 1
            yield waiting.slice(0, n)
            last = waiting.slice(n).columns[:-2]
            yield pa.RecordBatch.from_arrays([*last, pa.array([held[0]]), pa.array([held[1]])], names)

    return run


def judge_versions(tried: DataFrame, order: str) -> DataFrame:
    """Adds ``outcome`` (processed, skipped or failed) to versions in the place of ``held_etag`` and ``held_modified``.

    ``tried`` has item_id, etag, last_modified, error and the last processed version
    of the item before these rows.  No task gets more than its share of the rows,
    whatever the item.
    """
    texts = {c: F.col(c).cast("string") for c in ("item_id", "etag", "last_modified", "error", "held_etag", "held_modified")}
    ranged = tried.withColumns(texts).repartitionByRange("item_id", order).sortWithinPartitions("item_id", order)
    placed = cut_lineage(ranged.withColumn("__part", F.spark_partition_id()))
    starts, firsts = {}, {}
    if placed.rdd.getNumPartitions() > 1:
        slim = placed.select("__part", "item_id", "etag", "last_modified", "error", "held_etag", "held_modified")
        pieces = slim.mapInArrow(_pieces, PIECE).collect()  # two rows for each partition at most
        starts, firsts = _starts(pieces), {r["part"]: r["item_id"] for r in pieces if r["first"]}
    kept = [f for f in placed.schema.fields if f.name not in ("held_etag", "held_modified")]
    ends = [T.StructField(n, T.StringType()) for n in ("outcome", "__end_etag", "__end_modified")]
    while True:
        judged = placed.mapInArrow(_judge(starts, [f.name for f in kept]), T.StructType([*kept, *ends]))
        if len(starts) < 2:
            return judged.drop("__part", "__end_etag", "__end_modified")
        judged = cut_lineage(judged)
        exact = {r["__part"]: r for r in judged.where("__end_etag IS NOT NULL").select("__part", "item_id", "__end_etag", "__end_modified").collect()}
        better = dict(starts)
        parts = sorted(exact)
        for before, part in zip(parts, parts[1:], strict=False):
            if firsts[part] == exact[before]["item_id"]:
                better[part] = (exact[before]["__end_etag"], exact[before]["__end_modified"])
        if better == starts:
            return judged.drop("__part", "__end_etag", "__end_modified")
        starts = better
