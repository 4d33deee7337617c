"""Records of delimited text whose quoted fields hold line ends, read in parallel.

A line end ends a record if an even number of quotes stands before it in the file.
So every file block counts its quotes, the parities of the blocks before give the
state in which a block starts, and then every block cuts its own lines to records.
A record that runs over the end of a block comes in pieces, at most two for each
block, which are put together by file.  Only record borders are found here; fields
are left to ``from_csv``.

Quotes stand as RFC 4180 has them: around a field, and doubled inside one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: File blocks whose state is sent to all tasks; more are joined by a shuffle of the lines.
SENT_BLOCKS = 100_000
PIECE = "file string, start long, no long, record string, open boolean, head boolean"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in order with the state of their block -> records, and the pieces of records that cross a block."""
    names = ["file", "start", "no", "record", "open", "head"]
    place, inside, no, held, first = None, False, 0, [], 0

    def piece(is_open: bool) -> tuple:
        return (*place, first, "\n".join(held), is_open, first < 0)

    for batch in batches:
        lines, files, starts, states = (batch.column(k) for k in range(4))
        odd = pc.count_substring(lines, '"').to_numpy(zero_copy_only=False) % 2 == 1
        new = np.ones(batch.num_rows, dtype=bool)
        if batch.num_rows:
            same_file = files.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            offsets = starts.to_numpy(zero_copy_only=False)
            new[1:] = (np.diff(same_file) != 0) | (np.diff(offsets) != 0)
        bounds = np.flatnonzero(new).tolist()
        for a, b in zip(bounds, [*bounds[1:], batch.num_rows], strict=True):
            here = (files[a].as_py(), starts[a].as_py())
            out = []
            if here != place:
                if held:
                    out.append(piece(True))
                place, inside, no, held = here, bool(states[a].as_py()), 0, []
                first = -1 if inside else 0
            flips = odd[a:b]
            if not inside and not flips.any():  # every line is a record
                n = b - a
                columns = [pa.array([place[0]] * n), pa.array([place[1]] * n, pa.int64()), pa.array(np.arange(no, no + n)), lines.slice(a, n)]
                if out:
                    yield _rows(out, names)
                yield pa.RecordBatch.from_arrays([*columns, pa.array(np.zeros(n, bool)), pa.array(np.zeros(n, bool))], names)
                no += n
                continue
            for line, flip in zip(lines.slice(a, b - a).to_pylist(), flips.tolist(), strict=True):
                if not held and not inside:
                    first = no
                held.append(line)
                no += 1
                inside ^= flip
                if not inside:
                    out.append(piece(False))
                    held = []
            yield _rows(out, names)
    if held:
        yield _rows([piece(True)], names)


def _rows(rows: list[tuple], names: list[str]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.bool_()]
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def records(spark: SparkSession, path: str | list[str], pattern: str | None = None) -> DataFrame:
    """``file, start, no, record`` for every record: its file, the block it begins in, its line there, its text.

    Line ends inside quotes stay as they are; the one that ends a record is taken off,
    a carriage return before it too.  A quote that is never closed runs to the end
    of its file.  Empty records are left out.
    """
    reader = spark.read.option("lineSep", "\n")
    reader = reader.option("pathGlobFilter", pattern) if pattern else reader
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    blocks = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("odd"))
    before = W.partitionBy("file").orderBy("start").rowsBetween(W.unboundedPreceding, -1)
    blocks = blocks.withColumn("state", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).where("state").select("file", "start", "state")
    inner = blocks.limit(SENT_BLOCKS + 1).toPandas()  # blocks that start inside quotes
    if not len(inner):
        known = lines.withColumn("state", F.lit(False))
    elif len(inner) <= SENT_BLOCKS:
        table = spark.createDataFrame(inner, blocks.schema)
        known = lines.join(F.broadcast(table), ["file", "start"], "left").select("value", "file", "start", "state")
    else:
        placed = lines.withColumn("place", F.monotonically_increasing_id())
        joined = placed.join(blocks, ["file", "start"], "left").repartition("file", "start")
        known = joined.sortWithinPartitions("file", "start", "place").select("value", "file", "start", "state")
    cut = known.select("value", "file", "start", F.coalesce("state", F.lit(False)).alias("state")).mapInArrow(_cut, PIECE)
    whole = cut.where("NOT open AND NOT head").select("file", "start", "no", "record")
    if len(inner):
        order = W.partitionBy("file").orderBy("start", "no")
        pieces = cut.where("open OR head").withColumn("nth", F.sum(F.when(F.col("head"), 0).otherwise(1)).over(order))
        parts = F.array_sort(F.collect_list(F.struct("start", "no", "record")))
        joined = pieces.groupBy("file", "nth").agg(parts.alias("parts"))
        text = F.array_join(F.transform("parts", lambda p: p["record"]), "\n")
        whole = whole.union(joined.select("file", F.col("parts")[0]["start"], F.col("parts")[0]["no"], text))
    else:
        whole = whole.union(cut.where("open").select("file", "start", "no", "record"))  # unclosed quotes at the end of a file
    return whole.withColumn("record", F.regexp_replace("record", "\r$", "")).where(F.col("record").rlike(r"\S"))


def is_header(start="start", no="no"):
    """Whether a record is the first of its file."""
    return (F.col(start) == 0) & (F.col(no) == 0)
