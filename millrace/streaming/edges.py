"""Leading-edge selection per key: throttling and time-to-live caches.

An event is an *edge* when at least ``seconds`` have passed since the previous
edge of its key.  Each edge depends on the one before it, yet a key with a third
of all rows must not be walked by one task.  So time is cut into slices, and what
a slice does to a walk is a step function: from the time at which the walk may
take its next edge on entering the slice, to that time on leaving it.  Step
functions of neighbouring slices are composed, four at a time, to those of longer
and longer blocks until a key has at most four; then the times at which blocks
are entered are handed down again, and every slice is walked on its own from its
known start.

No task gets more of one key than the events of a slice, or four step functions,
and a step function has at most one step for each event of one edge distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.moments import floor_div, micros
from ..session import cut_lineage

#: A slice spans this many edge distances.
SLICE_EDGES = 2
#: Neighbouring blocks that are composed at once, as a power of two.
FAN_BITS = 2
NEVER = -(2**62)
LONG = T.LongType()


def _schema(*fields: T.StructField | tuple) -> T.StructType:
    return T.StructType([f if isinstance(f, T.StructField) else T.StructField(*f) for f in fields])


def _changes(batch: pa.RecordBatch | pa.Table, columns: list[str]) -> np.ndarray:
    """Where a row differs from the one before it in any of the columns; nulls are equal."""
    change = np.zeros(max(0, batch.num_rows - 1), dtype=bool)
    for name in columns:
        column = batch.column(name)
        column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
        codes = column.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False)
        change |= codes[1:] != codes[:-1]
    return change


def _whole_groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Sorted rows as tables of whole groups, with the number of each row's group in its table."""
    held: list[pa.RecordBatch] = []

    def out() -> tuple[pa.Table, np.ndarray]:
        table = pa.Table.from_batches(held).combine_chunks()
        return table, np.concatenate(([0], np.cumsum(_changes(table, columns))))

    for batch in batches:
        if not batch.num_rows:
            continue
        cuts = np.flatnonzero(_changes(batch, columns)) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        if held and not last:
            ends = pa.Table.from_batches([held[-1].slice(held[-1].num_rows - 1), batch.slice(0, 1)])
            if _changes(ends, columns)[0]:
                yield out()
                held = []
        if last:
            held.append(batch.slice(0, last))
            yield out()
            held = []
        held.append(batch.slice(last))
    if held:
        yield out()


class _Slices:
    """Sorted events of several (key, slice) groups at once, on one rising axis."""

    def __init__(self, group: np.ndarray, slice_no: np.ndarray, times: np.ndarray, width: int, span: int):
        self.group, self.times, self.width, self.span = group, times, width, span
        self.since = times - slice_no * self.span
        # a group's part of the axis is two slices long, so that no step leads into the next
        self.axis = group * (2 * self.span) + self.since

    def first_from(self, group: np.ndarray, since: np.ndarray) -> np.ndarray:
        """The first event of a group at or after a time since the slice's start, or the group's end."""
        return np.searchsorted(self.axis, group * (2 * self.span) + np.clip(since, 0, 2 * self.span - 1))

    def following(self) -> tuple[np.ndarray, np.ndarray]:
        """For each event the next edge if it is one, and whether that lies in its slice."""
        after = self.first_from(self.group, self.since + self.width)
        inside = after < len(self.group)
        inside[inside] = self.group[after[inside]] == self.group[inside]
        return after, inside


def _parts(group: np.ndarray, span: int) -> Iterator[slice]:
    """Ranges of rows with so few groups that their axis fits a long."""
    most = max(1, 2**61 // (2 * span))
    bounds = np.searchsorted(group, np.arange(0, int(group[-1]) + 1, most))
    yield from map(slice, bounds, [*bounds[1:], len(group)])


def _steps(width: int, span: int):
    """Sorted events -> the step function of each (key, slice): the entries that lead to one exit, by their last."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _whole_groups(batches, ["__key", "__slice"]):
            slices, times = table["__slice"].to_numpy(), table["__us"].to_numpy()
            for part in _parts(group, span):
                new = np.ones(part.stop - part.start, dtype=bool)
                new[1:] = (np.diff(times[part]) != 0) | (np.diff(group[part]) != 0)
                rows = np.flatnonzero(new) + part.start
                here = _Slices(group[rows] - group[rows[0]], slices[rows], times[rows], width, span)
                after, inside = here.following()
                last = np.where(inside, after, np.arange(len(rows)))
                while (last != (further := last[last])).any():
                    last = further
                # a walk from before the slice enters within one distance of its start
                entered = np.arange(len(rows)) <= here.first_from(here.group, np.full(len(rows), width))
                kept = rows[entered]
                leave, mine = (here.times[last] + width)[entered], here.group[entered]
                steps = np.append((np.diff(leave) != 0) | (np.diff(mine) != 0), True)
                chosen = pa.array(kept[steps])
                yield pa.RecordBatch.from_arrays(
                    [table["__key"].combine_chunks().take(chosen), pa.array(slices[kept[steps]]), pa.array(times[kept[steps]]), pa.array(leave[steps])],
                    ["__key", "__slice", "__entry", "__exit"],
                )

    return run


def _blocks(table: pa.Table, group: np.ndarray) -> Iterator[tuple[int, list[tuple[int, np.ndarray, np.ndarray]]]]:
    """The step functions of each group in order of time, with the group's first row."""
    slices, entry, leave = (table[c].to_numpy() for c in ("__slice", "__entry", "__exit"))
    cut = np.flatnonzero((np.diff(group) != 0) | (np.diff(slices) != 0)) + 1
    blocks: list = []
    for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(group)], strict=True):
        if blocks and group[a] != group[a - 1]:
            yield first, blocks
            blocks = []
        if not blocks:
            first = a
        blocks.append((int(slices[a]), entry[a:b], leave[a:b]))
    yield first, blocks


def _compose(width: int, span: int):
    """Step functions of neighbouring blocks -> that of the longer block, which spans ``span``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _whole_groups(batches, ["__key", "__parent"]):
            parents = table["__parent"].to_numpy()
            firsts, numbers, entries, exits = [], [], [], []
            for first, blocks in _blocks(table, group):
                _, entry, leave = blocks[0]
                for _, more, out in blocks[1:]:
                    at = np.searchsorted(more, leave)
                    # what no event of the later block stops passes through it unchanged
                    through = np.where(at < len(more), out[np.minimum(at, len(more) - 1)], leave)
                    entry, leave = np.concatenate((entry, more)), np.concatenate((through, out))
                kept = np.searchsorted(entry, int(parents[first]) * span + width) + 1
                entry, leave = entry[:kept], leave[:kept]
                steps = np.append(np.diff(leave) != 0, True)
                firsts.append(np.full(int(steps.sum()), first))
                numbers.append(np.full(int(steps.sum()), parents[first]))
                entries.append(entry[steps])
                exits.append(leave[steps])
            key = table["__key"].combine_chunks().take(pa.array(np.concatenate(firsts)))
            columns = [key, *(pa.array(np.concatenate(c)) for c in (numbers, entries, exits))]
            yield pa.RecordBatch.from_arrays(columns, ["__key", "__slice", "__entry", "__exit"])

    return run


def _hand_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's start and the step functions within it -> the start of each part.

    The start is a row with a null entry; without one the walk starts afresh.
    """
    for table, group in _whole_groups(batches, ["__key", "__parent"]):
        begins = table["__entry"].is_null().to_numpy()
        starts = dict(zip(group[begins].tolist(), table["__exit"].to_numpy()[begins].tolist(), strict=True))
        chosen = pa.array(np.flatnonzero(~begins))
        table, group = table.take(chosen).combine_chunks(), group[~begins]
        if not len(group):
            continue
        rows = []
        for first, blocks in _blocks(table, group):
            until = starts.get(int(group[first]), NEVER)
            for number, entry, leave in blocks:
                rows.append((first, number, until))
                at = int(np.searchsorted(entry, until))
                until = int(leave[at]) if at < len(entry) else until
        first, number, until = (pa.array(c, pa.int64()) for c in zip(*rows, strict=True))
        key = table["__key"].combine_chunks().take(first)
        yield pa.RecordBatch.from_arrays([key, number, until], ["__key", "__slice", "__until"])


def _walk(width: int, span: int, kept: list[str]):
    """Sorted events of a slice behind the row with its start -> edge flag and the edge each event falls under."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in _whole_groups(batches, ["__key", "__slice"]):
            begins = table["__us"].is_null().to_numpy()
            until = table["__until"].to_numpy()[begins]  # one for each group, in order
            events = table.take(pa.array(np.flatnonzero(~begins))).combine_chunks()
            group, times, slices = group[~begins], events["__us"].to_numpy(), events["__slice"].to_numpy()
            n = len(times)
            edge, under = np.zeros(n, dtype=bool), np.empty(n, dtype=np.int64)
            for part in _parts(group, span):
                base = group[part.start]
                here = _Slices(group[part] - base, slices[part], times[part], width, span)
                starts = np.searchsorted(here.group, np.arange(int(here.group[-1]) + 1))
                start = until[base : base + len(starts)]
                after, inside = here.following()
                # the first edge of each slice, then all slices step by step
                at = here.first_from(here.group[starts], start - slices[part][starts] * here.span)
                at = at[(at < len(here.group)) & (here.group[np.minimum(at, len(here.group) - 1)] == here.group[starts])]
                mark = np.zeros(len(here.group), dtype=bool)
                while len(at):
                    mark[at] = True
                    at = after[at[inside[at]]]
                latest = np.maximum.accumulate(np.where(mark, np.arange(len(mark)), -1))
                known = latest >= starts[here.group]
                edge[part] = mark
                under[part] = np.where(known, here.times[np.maximum(latest, 0)], (start - width)[here.group])
            out = events.select(kept).append_column("is_edge", pa.array(edge)).append_column("edge_us", pa.array(under))
            yield from out.to_batches()

    return run


def _starts(slim: DataFrame, kind: T.DataType, width: int) -> DataFrame:
    """``__key, __slice, __until``: when a walk over a key's events may take its next edge on entering each slice."""
    steps = _schema(("__key", kind), ("__slice", LONG), ("__entry", LONG), ("__exit", LONG))
    span = width * SLICE_EDGES
    levels = [
        cut_lineage(
            slim.repartition("__key", "__slice")
            .sortWithinPartitions("__key", "__slice", "__us")
            .mapInArrow(_steps(width, span), steps)
        )
    ]
    low, high = levels[0].agg(F.min("__slice"), F.max("__slice")).first()
    while low is not None and high - low >> FAN_BITS:
        low, high, span = low >> FAN_BITS, high >> FAN_BITS, span << FAN_BITS
        joined = levels[-1].withColumn("__parent", F.shiftright("__slice", FAN_BITS)).repartition("__key", "__parent")
        ordered = joined.sortWithinPartitions("__key", "__parent", "__slice", "__entry")
        levels.append(ordered.mapInArrow(_compose(width, span), steps))
        if high - low >> FAN_BITS:
            levels[-1] = cut_lineage(levels[-1])  # composed further, and handed down through
    starts = None
    for level in reversed(levels):
        parent = F.lit(0).cast("bigint") if starts is None else F.shiftright("__slice", FAN_BITS)
        rows = level.withColumn("__parent", parent)
        if starts is not None:
            above = starts.select("__key", F.lit(None).cast("bigint").alias("__slice"), F.lit(None).cast("bigint").alias("__entry"),
                                  F.col("__until").alias("__exit"), F.col("__slice").alias("__parent"))
            rows = rows.unionByName(above)
        ordered = rows.repartition("__key", "__parent").sortWithinPartitions("__key", "__parent", "__slice", "__entry")
        starts = ordered.mapInArrow(_hand_down, _schema(("__key", kind), ("__slice", LONG), ("__until", LONG)))
    return starts


def mark_edges(
    df: DataFrame, key: str, ts: str, seconds: float, tie: str, held: DataFrame | None = None
) -> DataFrame:
    """Add ``is_edge`` and ``edge_us``, the time of the edge an event falls under.

    ``tie`` orders events of equal time.  ``held`` (key, until_us) carries the
    end of the last edge of each key over from earlier batches; events before it
    fall under that edge, and the walk starts behind them.
    """
    width = int(seconds * 1_000_000)
    kind = df.schema[key].dataType
    events = df.withColumns({"__key": F.col(key), "__us": micros(F.col(ts))})
    covered = None
    if held is not None:
        past = held.select(F.col(key).alias("__k"), F.col("until_us").alias("__held"))
        events = events.join(past, F.col("__key").eqNullSafe(F.col("__k")), "left").drop("__k")
        covered = events.where(F.col("__us") < F.col("__held"))
        covered = covered.select(*df.columns, F.lit(False).alias("is_edge"), (F.col("__held") - width).alias("edge_us"))
        events = events.where(F.col("__held").isNull() | (F.col("__us") >= F.col("__held"))).drop("__held")
    events = events.withColumn("__slice", floor_div(F.col("__us"), width * SLICE_EDGES))
    starts = _starts(events.select("__key", "__slice", "__us"), kind, width)
    rows = events.withColumn("__until", F.lit(None).cast("bigint")).unionByName(starts, allowMissingColumns=True)
    out = _schema(*df.schema.fields, ("is_edge", T.BooleanType()), ("edge_us", LONG))
    # a slice's start has no time, so it comes before the slice's events
    marked = (
        rows.repartition("__key", "__slice")
        .sortWithinPartitions("__key", "__slice", "__us", tie)
        .mapInArrow(_walk(width, width * SLICE_EDGES, df.columns), out)
    )
    return marked if covered is None else marked.unionByName(covered)


def throttle(df: DataFrame, key: str, ts: str, seconds: float, tie: str, held: DataFrame | None = None) -> DataFrame:
    """Events that are let through: the first, then none until ``seconds`` later."""
    return mark_edges(df, key, ts, seconds, tie, held).where("is_edge").drop("is_edge", "edge_us")


def ttl_lookup(df: DataFrame, key: str, ts: str, value: str, seconds: float, tie: str) -> DataFrame:
    """Every event with the value cached for its key at that time.

    The first event after expiry recomputes the value; ``is_refresh`` marks it.
    """
    marked = mark_edges(df, key, ts, seconds, tie)
    fresh = marked.where("is_edge").select(
        F.col(key).alias("__k"), F.col("edge_us").alias("__e"), F.col(value).alias("cached_value")
    )
    same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("edge_us") == F.col("__e"))
    return marked.join(fresh, same).drop("__k", "__e", "edge_us").withColumnRenamed("is_edge", "is_refresh")


def held_until(marked: DataFrame, key: str, seconds: float) -> DataFrame:
    """Carry-over for the next batch: when each key with a new edge may have its next."""
    width = int(seconds * 1_000_000)
    return marked.where("is_edge").groupBy(key).agg((F.max("edge_us") + width).alias("until_us"))


def debounce(df: DataFrame, key: str, ts: str, seconds: int, tie: str) -> DataFrame:
    """The last event of each burst; a burst ends after more than ``seconds`` of quiet.

    Time is cut into buckets of that length.  Only the last event of a (key,
    bucket) can end a burst, and only the next bucket can continue it, so hot
    keys are reduced on the map side and spread over their buckets; no task sees
    all rows of a key.
    """
    width = int(seconds * 1_000_000)
    timed = df.withColumn("__us", micros(F.col(ts)))
    bucket = floor_div(F.col("__us"), width)
    row = F.max_by(F.struct(*df.columns), F.struct("__us", tie))
    reduced = timed.groupBy(F.col(key).alias("__key"), bucket.alias("__bucket")).agg(
        row.alias("row"), F.max("__us").alias("last_us"), F.min("__us").alias("first_us")
    )
    following = reduced.select(
        F.col("__key").alias("__k"), (F.col("__bucket") - 1).alias("__b"), F.col("first_us").alias("next_us")
    )
    same = F.col("__key").eqNullSafe(F.col("__k")) & (F.col("__bucket") == F.col("__b"))
    quiet = F.col("next_us").isNull() | (F.col("next_us") - F.col("last_us") > width)
    return reduced.join(following, same, "left").where(quiet).select("row.*")


def debounce_windows(stream: DataFrame, key: str, ts: str, seconds: float, tie: str) -> DataFrame:
    """The same on a watermarked stream, as session windows in append mode."""
    window = F.session_window(ts, f"{int(seconds * 1_000_000)} microseconds")
    row = F.max_by(F.struct(*stream.columns), F.struct(ts, tie))
    return stream.groupBy(window, F.col(key).alias("__key")).agg(row.alias("row")).select("row.*")
