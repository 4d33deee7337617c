"""Global row numbers without a single-task window."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage


POSITION = (1 << 33) - 1


def _in_order(df: DataFrame, order_by: Sequence[str | Column], placed: bool) -> DataFrame:
    """The rows in order, with ``__pos`` and the number of their partition in ``__part``."""
    rows = df if placed else df.orderBy(*order_by)
    # the id carries the partition in its upper bits and the row in its lower 33
    rows = rows.withColumn("__pos", F.monotonically_increasing_id()).withColumn("__part", F.shiftright("__pos", 33))
    return rows if placed else cut_lineage(rows)


def number_rows(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "row_index", start: int = 1, placed: bool = False
) -> DataFrame:
    """Consecutive numbers from ``start`` in the given order.

    The frame is range partitioned and sorted once and written to the shared
    folder, so positions cannot change when a task is run again.  The offsets
    come from one row count per partition and go into the plan as one constant
    array, so no join is needed.
    ``order_by`` should identify rows; ties get some order.  The result keeps its
    rows in order: ``placed`` says that ``df`` is such a result, with columns and rows
    taken away or added but not moved, and spares the sort.
    """
    placed_rows = _in_order(df, order_by, placed)
    sizes = dict(placed_rows.groupBy("__part").agg(F.count("*")).collect())
    before, offsets = start, []
    for part in range(max(sizes, default=-1) + 1):
        offsets.append(before)
        before += sizes.get(part, 0)
    first = F.get(F.from_json(F.lit(json.dumps(offsets)), "array<bigint>"), F.col("__part").cast("int"))
    row = F.col("__pos").bitwiseAND(F.lit(POSITION))
    return placed_rows.withColumn(name, row + first).drop("__pos", "__part")


def batch_ids(
    df: DataFrame, order_by: Sequence[str | Column], size: int, name: str = "batch_id"
) -> DataFrame:
    """Fixed-size batches in a stable order; the last one may be shorter."""
    numbered = number_rows(df, order_by, "__row", start=0)
    return numbered.withColumn(name, F.floor(F.col("__row") / size).cast("bigint")).drop("__row")


def with_previous(
    df: DataFrame, order_by: Sequence[str | Column], columns: dict[str, str], placed: bool = False
) -> DataFrame:
    """Values of the row before, over the whole table.

    The rows are sorted once and stay in order.  The last row of every partition is a
    small side table that gives the next partition its first previous row; all others
    have theirs in the partition.  ``columns`` maps a source column to the name of its
    previous value; ``placed`` is that of ``number_rows``.
    """
    rows = _in_order(df, order_by, placed)
    kept, sources = df.columns, list(columns)
    side = rows.select("__part", *sources)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = batch.slice(batch.num_rows - 1) if batch.num_rows else held
        if held is not None:
            yield held

    ends = side.mapInArrow(last, side.schema).toArrow().sort_by("__part")  # a row for each partition
    numbers = ends["__part"].to_numpy()

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if held is None:
                at = int(np.searchsorted(numbers, batch.column("__part")[0].as_py())) - 1
                held = {c: ends[c].slice(at, 1).combine_chunks() if at >= 0 else None for c in sources}
            previous = []
            for c in sources:
                column = batch.column(c)
                before = pa.nulls(1, column.type) if held[c] is None else held[c].cast(column.type)
                previous.append(pa.concat_arrays([before, column.slice(0, batch.num_rows - 1)]))
                held[c] = column.slice(batch.num_rows - 1)
            yield pa.RecordBatch.from_arrays([*batch.select(kept).columns, *previous], [*kept, *columns.values()])

    made = [T.StructField(new, df.schema[c].dataType) for c, new in columns.items()]
    return rows.drop("__pos").mapInArrow(shift, T.StructType([*df.schema.fields, *made]))
