"""Debounce on a stream: session windows of a key, and the row that ends them all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The store that keeps state outside the heap; sessions whose end has passed leave none.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Settings of the query: a hot key is merged to its sessions before it is shuffled.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STORE,
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
}


def closing_row(df: DataFrame, ts: str, seconds: float, delay_seconds: float) -> DataFrame:
    """The flush: one row, null but for a time late enough that every open burst of ``df`` ends.

    Sent as the last input, it moves the watermark past all bursts, and they
    come out in the same run.  It opens a burst under the null key that never ends, so
    nothing of it comes out.
    """
    newest = F.timestamp_add("MICROSECOND", F.lit(int((seconds + delay_seconds) * 1_000_000) + 2_000), F.max(ts))
    row = df.agg(newest.alias(ts))
    return row.select(*[F.col(f.name) if f.name == ts else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields])
