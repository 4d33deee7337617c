"""Bounded-space online packing of token sequences.

Each partition keeps a fixed number of open windows.  A document's full windows
leave at once; its rest goes where it fits best.  When it fits nowhere, the
fullest window is topped up with the head of it and leaves, so that no window
leaves with padding.  What is open at the end of the partitions is merged, 64
partitions at a time, and the last rest is cut into powers of two, which need no
padding either.  Nothing but these leftovers is shuffled, and no group of them
exceeds 64 times the open windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import bpe
from .common import stored

#: Tokens of a window, open windows of a partition, partitions whose leftovers meet.
WINDOW, OPEN, MEET = 1024, 16, 64
#: Sequence numbers of a partition or of a merge; merges have numbers of their own.
SPAN, MERGED = 1 << 33, 1 << 62

PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = [c.split()[0] for c in PIECE.split(", ")]


class Packer:
    """Open windows of one partition; finished pieces are collected in ``done``."""

    def __init__(self, first: int, window: int, slots: int):
        self.next, self.window, self.slots = first, window, slots
        self.open: list[list] = []  # [fill, pieces]
        self.done: list[tuple] = []

    def add(self, doc: object, total: int, start: int, ids: bytes) -> None:
        """Place ``ids``, which are tokens ``start`` onwards of a document of ``total`` tokens."""
        at, left = 0, len(ids) // 4
        while left >= self.window:
            self.close([0, [(doc, total, start + at, ids[4 * at : 4 * (at + self.window)])]])
            at, left = at + self.window, left - self.window
        while left:
            fits = [w for w in self.open if w[0] + left <= self.window]
            if fits:
                into = max(fits, key=lambda w: w[0])
            elif len(self.open) < self.slots:
                into = [0, []]
                self.open.append(into)
            else:
                into = max(self.open, key=lambda w: w[0])
            take = min(left, self.window - into[0])
            into[1].append((doc, total, start + at, ids[4 * at : 4 * (at + take)]))
            into[0], at, left = into[0] + take, at + take, left - take
            if into[0] == self.window:
                self.open = [w for w in self.open if w is not into]
                self.close(into)

    def close(self, window: list) -> None:
        offset = 0
        for doc, total, start, ids in window[1]:
            length = len(ids) // 4
            self.done.append((doc, start, length, zlib.crc32(ids), total, self.next, offset))
            offset += length
        self.next += 1


def merge(windows: list[list], first: int, window: int) -> list[tuple]:
    """Pack leftover windows without padding: full windows, then powers of two."""
    packer = Packer(first, window, 1)
    for pieces in sorted(windows, key=lambda w: -sum(len(p[3]) for p in w)):
        for doc, total, start, ids in pieces:
            packer.add(doc, total, start, ids)
    rest = packer.open[0] if packer.open else [0, []]
    fill, pieces = rest[0], rest[1]
    while fill:
        size, part, filled = 1 << (fill.bit_length() - 1), [], 0
        while filled < size:
            doc, total, start, ids = pieces.pop(0)
            take = min(len(ids) // 4, size - filled)
            part.append((doc, total, start, ids[: 4 * take]))
            filled += take
            if take < len(ids) // 4:
                pieces.insert(0, (doc, total, start + take, ids[4 * take :]))
        packer.close([size, part])
        fill -= size
    return packer.done


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, slots: int = OPEN, end_id: int = 0) -> DataFrame:
    """One row per piece of every row of ``docs``.

    A document is the ids of its text and then ``end_id``; null and empty texts
    are that id alone.  Pieces cover each document from 0 to ``doc_tokens``
    without a gap, and each sequence from offset 0 to ``window`` or to a power of
    two.  Repeated rows are documents of their own.  An empty table gives none.
    """
    path = path or bpe.vocabulary_path()
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode = TaskContext.get().partitionId(), bpe.encoder(path)
        packer = Packer(part * SPAN, window, slots)
        for batch in batches:
            for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                ids = encode(text.as_py()) + end
                packer.add(doc.as_py(), len(ids) // 4, 0, ids)
            yield _batch(packer.done, part)
            packer.done = []
        yield _batch(
            [(doc, start, len(ids) // 4, None, total, number, None, ids) for number, w in enumerate(packer.open) for doc, total, start, ids in w[1]],
            part,
        )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    placed = stored(rows.mapInArrow(run, f"{PIECE}, ids binary, part int"), "packing")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["part", "sequence_id"], kind="stable")
        windows = [
            [(None if pd.isna(p.doc_id) else int(p.doc_id), p.doc_tokens, p.start, p.ids) for p in w.itertuples()]
            for _, w in group.groupby(["part", "sequence_id"], sort=False)
        ]
        first = MERGED + int(group["part"].iloc[0]) // MEET * SPAN
        out = pd.DataFrame(merge(windows, first, window), columns=NAMES)
        return out.astype({"doc_id": "Int64"})

    left = placed.where(F.col("ids").isNotNull()).withColumn("met", F.floor(F.col("part") / MEET))
    merged = left.groupBy("met").applyInPandas(meet, PIECE)
    return placed.where(F.col("ids").isNull()).select(*NAMES).unionByName(merged)


def _batch(rows: list[tuple], part: int) -> pa.RecordBatch:
    rows = [r if len(r) == 8 else (*r, None) for r in rows]
    columns = list(zip(*rows, strict=True)) or [()] * 8
    kinds = [pa.int64()] * 7 + [pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array([part] * len(rows), pa.int32())]
    return pa.RecordBatch.from_arrays(arrays, [*NAMES, "ids", "part"])
