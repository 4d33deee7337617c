"""Streaming jobs: queue sweeper, change feed, throttle, debounce, live filter.

State between micro-batches is kept in hash buckets (``buckets.BucketState``): a
batch reads the buckets of its keys and writes them and its results under its own
number, so a batch that is run again after a failure replaces its own output and
changes nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.groups import latest_per_key
from ..plans import staging
from ..session import cut_lineage
from ..sources import publish, storage
from . import bursts, edges
from .changes import judge_versions
from .buckets import BucketState, stamp


def state_before(spark: SparkSession, base: str, name: str, batch_id: int) -> DataFrame | None:
    """The small table that the given batch starts from."""
    older = [v for v in publish.versions(spark, base, name) if v[2:] < stamp(batch_id)]
    return publish.read_version(spark, base, name, older[0]) if older else None


COMPACT_EVERY = 50


def read_state(spark: SparkSession, base: str, name: str, batch_id: int, keys: Sequence[str]) -> DataFrame | None:
    """A small state before a batch, whole: the last full version and the changes since."""
    full = [v for v in publish.versions(spark, base, name) if v[2:] < stamp(batch_id)][:1]
    since = full[0] if full else ""
    changes = [v for v in publish.versions(spark, base, f"{name}_changes") if since < v and v[2:] < stamp(batch_id)]
    tables = [publish.read_version(spark, base, name, v) for v in full]
    tables += [publish.read_version(spark, base, f"{name}_changes", v) for v in changes]
    if not tables:
        return None
    return latest_per_key(reduce(DataFrame.unionByName, tables), keys, ["state_batch"])


def write_state(changes: DataFrame, held: DataFrame | None, base: str, name: str, batch_id: int, keys: Sequence[str]) -> None:
    """Publish the keys a batch changed; now and then, the whole state too."""
    spark = changes.sparkSession
    marked = changes.withColumn("state_batch", F.lit(batch_id).cast("bigint"))
    publish.publish_version(marked, base, f"{name}_changes", stamp(batch_id), retain=3 * COMPACT_EVERY)
    if batch_id % COMPACT_EVERY == COMPACT_EVERY - 1:
        written = publish.read_version(spark, base, f"{name}_changes", f"v={stamp(batch_id)}")
        whole = written if held is None else latest_per_key(held.unionByName(written), keys, ["state_batch"])
        publish.publish_version(whole, base, name, stamp(batch_id))


def run_available(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None]) -> bool:
    """Work off everything that has arrived, then stop.

    A start while the same job is still busy in this session is ignored and
    answers False; Spark itself admits one query per checkpoint.
    """
    name = f"run {checkpoint}"
    if any(q.name == name for q in stream.sparkSession.streams.active):
        return False
    query = (
        stream.writeStream.foreachBatch(handle)
        .queryName(name)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return True


def run_every(stream: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None], seconds: int = 60):
    """The same work on a clock; returns the running query."""
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=f"{seconds} seconds")
        .start()
    )


def sweep_queue(base: str, first: DataFrame, user: str, at, rows: int | None = None) -> Callable[[DataFrame, int], None]:
    """Handler for NEW rows: settle each, merge the good ones, keep every outcome.

    ``first`` is the export table before any batch; it is dealt to hash buckets once.
    A batch reads and writes the buckets that its keys fall into, each bucket by a
    worker of its own; ``nightly_table`` puts the whole table together.  Rows
    without a key match nothing and are kept apart.  Outcomes are partitioned by
    status, and a failed row never stops the batch.  ``rows`` is a bucket's size.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = BucketState(spark, base, "nightly", ["integration_id"], first, rows)
        settled, seen = staging.settle(batch), Observation()
        path = f"{base}/outcomes/batch={stamp(batch_id)}"
        good = F.col("status") == "SUCCESS"
        counted = settled.observe(
            seen, F.count_if(good & F.col("id").isNotNull()).alias("named"), F.count_if(good & F.col("id").isNull()).alias("lone")
        )
        counted.write.mode("overwrite").partitionBy("status").parquet(path)
        kept = spark.read.schema(settled.schema).parquet(path).where(good)
        if seen.get.get("named"):
            named = kept.where("id IS NOT NULL")
            keys = named.select(F.col("id").alias("integration_id"))
            state.update(keys, lambda held: staging.sync_nightly(held, named, at, user), batch_id)
        if seen.get.get("lone"):
            lone = staging.sync_nightly(first.limit(0), kept.where("id IS NULL"), at, user)
            lone.write.mode("overwrite").parquet(f"{base}/lone/batch={stamp(batch_id)}")

    return handle


def nightly_table(spark: SparkSession, base: str, first: DataFrame) -> DataFrame:
    """The export table after all batches of a sweep that started from ``first``."""
    held = BucketState(spark, base, "nightly", ["integration_id"]).all()
    if held is None:
        return first
    if not storage.child_folders(spark, f"{base}/lone"):
        return held.select(*first.columns)
    lone = spark.read.schema(first.schema).parquet(f"{base}/lone")
    return held.select(*first.columns).unionByName(lone.select(*first.columns))


def warm_baseline(stream: DataFrame, checkpoint: str) -> None:
    """Make what is there now the baseline: it is passed over, later arrivals are not."""
    run_available(stream, checkpoint, lambda batch, batch_id: None)


def only_endings(items: DataFrame, column: str, endings: Sequence[str]) -> DataFrame:
    return items.where(F.lower(column).rlike("(" + "|".join(e.replace(".", r"\.") for e in endings) + ")$"))


def process_changes(
    base: str, process: Callable[[DataFrame], DataFrame], order: str
) -> Callable[[DataFrame, int], None]:
    """Handler for changed items (item_id, etag, last_modified, ...).

    A version whose tag or time equals the item's last processed version is
    skipped; only that last version is remembered, so going back to an older one
    counts as a change.  ``process`` adds a text column ``error``; a failed item
    leaves the state as it was, is kept in a dead-letter table and is tried again
    with the next batch.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = BucketState(spark, base, "state", ["item_id"])
        retry = state_before(spark, base, "dead", batch_id)
        items = batch if retry is None else retry.select(*batch.columns).unionByName(batch)
        tried = process(items)
        held = state.of(items, batch_id)
        if held is None:
            tried = tried.withColumns({c: F.lit(None).cast("string") for c in ("held_etag", "held_modified")})
        else:
            known = held.select("item_id", F.col("etag").alias("held_etag"), F.col("last_modified").alias("held_modified"))
            tried = tried.join(known, "item_id", "left")
        judged, seen = judge_versions(tried, order), Observation()
        counts = [F.count_if(F.col("outcome") == o).alias(o) for o in ("processed", "failed")]
        path = f"{base}/outcomes/batch={stamp(batch_id)}"
        judged.observe(seen, *counts).write.mode("overwrite").parquet(path)
        judged = spark.read.schema(judged.schema).parquet(path)
        if seen.get.get("processed"):
            done = judged.where("outcome = 'processed'").select("item_id", "etag", "last_modified", order)
            state.write(latest_per_key(done, ["item_id"], [order]).drop(order), batch_id)
        if seen.get.get("failed") or retry is not None:
            publish.publish_version(judged.where("outcome = 'failed'").select(*batch.columns), base, "dead", stamp(batch_id))

    return handle


def throttle_stream(base: str, key: str, ts: str, seconds: float, tie: str) -> Callable[[DataFrame, int], None]:
    """Handler that lets an event through only after ``seconds`` since the key's last one."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        state = BucketState(batch.sparkSession, base, "held", [key])
        marked = cut_lineage(edges.mark_edges(batch, key, ts, seconds, tie, state.of(batch, batch_id)))
        state.write(edges.held_until(marked, key, seconds), batch_id)
        out = marked.where("is_edge").drop("is_edge", "edge_us")
        out.write.mode("overwrite").parquet(f"{base}/emitted/batch={stamp(batch_id)}")

    return handle


def ttl_stream(base: str, key: str, ts: str, value: str, seconds: float, tie: str) -> Callable[[DataFrame, int], None]:
    """Handler that answers each event with the value cached for its key.

    The state holds, per key, the time and value of the last refresh; the first
    event after expiry refreshes both.
    """
    width = int(seconds * 1_000_000)

    def handle(batch: DataFrame, batch_id: int) -> None:
        state = BucketState(batch.sparkSession, base, "cache", [key])
        held = state.of(batch, batch_id)
        limits = None if held is None else held.select(key, (F.col("edge_us") + width).alias("until_us"))
        marked = cut_lineage(edges.mark_edges(batch, key, ts, seconds, tie, limits))
        new = marked.where("is_edge").select(key, "edge_us", F.col(value).alias("cached_value"))
        every = new if held is None else held.select(*new.columns).unionByName(new)
        fresh = every.withColumnsRenamed({key: "__k", "edge_us": "__e"})
        same = F.col(key).eqNullSafe(F.col("__k")) & (F.col("edge_us") == F.col("__e"))
        answered = marked.join(fresh, same).drop("__k", "__e", "edge_us").withColumnRenamed("is_edge", "is_refresh")
        answered.write.mode("overwrite").parquet(f"{base}/answered/batch={stamp(batch_id)}")
        state.write(latest_per_key(new, [key], ["edge_us"]), batch_id)

    return handle


def debounce_stream(
    stream: DataFrame, key: str, ts: str, seconds: float, delay: str, out: str, checkpoint: str, tie: str
) -> None:
    """Write the last event of each burst once the watermark has passed its end.

    ``tie`` orders events of one time.  A burst that is open when the input ends
    stays in the query's state and comes out with the next run that moves the
    watermark past it; ``bursts.closing_row`` is an input that does so for all.
    """
    conf = stream.sparkSession.conf
    before = {setting: conf.get(setting, None) for setting in bursts.SETTINGS}
    for setting, value in bursts.SETTINGS.items():
        conf.set(setting, value)
    try:
        query = (
            edges.debounce_windows(stream.withWatermark(ts, delay), key, ts, seconds, tie)
            .writeStream.format("parquet").outputMode("append")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
    finally:
        for setting, value in before.items():
            conf.unset(setting) if value is None else conf.set(setting, value)


def route_late(base: str, ts: str, delay_seconds: float) -> Callable[[DataFrame, int], None]:
    """Handler that splits off rows older than the latest time seen before minus the delay."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        held = state_before(batch.sparkSession, base, "latest", batch_id)
        rows = cut_lineage(batch)
        newest = rows.agg(F.max(ts).alias("latest"))
        late = F.lit(False)
        if held is not None:
            limit = held.first()["latest"]  # one row
            if limit is not None:
                late = F.col(ts) < F.lit(limit) - F.expr(f"INTERVAL {delay_seconds} SECONDS")
            newest = held.unionByName(newest).agg(F.max("latest").alias("latest"))
        rows.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(
            f"{base}/routed/batch={stamp(batch_id)}"
        )
        publish.publish_version(newest, base, "latest", stamp(batch_id))

    return handle
