"""Streaming jobs fed from files written out of the input tables, and their batch twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import lines
from ..plans import staging
from ..session import work_folder
from ..streaming import bursts, edges, feeds
from .loading import FIELDS, at, nightly_sql, nightly_table, payloads
from .registry import query

DAY = 86400


def drop_in_turn(df, order, path, parts=3):
    """Write the rows in drops that arrive one after the other in the given order; returns the files of a drop."""
    low, high = df.agg(F.min(order), F.max(order)).first()
    step = (high - low) / parts
    files = df.rdd.getNumPartitions()
    for i in range(parts):
        after = F.col(order) >= F.lit(low + step * i)
        before = F.lit(True) if i == parts - 1 else F.col(order) < F.lit(low + step * (i + 1))
        df.where(after & before).repartition(files).write.mode("append").parquet(path)
    return files


def work_off(t, df, order, base, handler, parts=3, where=None):
    """Let the drops arrive and work them off, a drop in a batch."""
    files = drop_in_turn(df, order, f"{base}/in", parts)
    stream = t.spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    feeds.run_available(where(stream) if where else stream, f"{base}/checkpoint", handler)


_EDGES = """
    WITH RECURSIVE ev AS (SELECT user_id, ts, min(event_id) AS event_id FROM events GROUP BY 1, 2),
    nxt AS (SELECT a.user_id, a.ts, min(b.ts) AS nts FROM ev a JOIN ev b ON a.user_id = b.user_id AND b.ts >= a.ts + INTERVAL 1 DAY GROUP BY 1, 2),
    e AS (SELECT user_id, min(ts) AS ts FROM ev GROUP BY 1 UNION ALL SELECT nxt.user_id, nts FROM e JOIN nxt ON e.user_id = nxt.user_id AND e.ts = nxt.ts)"""

_THROTTLED = f"{_EDGES} SELECT ev.user_id, ev.event_id FROM e JOIN ev ON e.user_id = ev.user_id AND e.ts = ev.ts"
_CACHED = f"""{_EDGES}, r AS (SELECT e.user_id, e.ts, v.event_id AS refreshed, v.value FROM e JOIN ev ON e.user_id = ev.user_id AND e.ts = ev.ts
                JOIN events v ON v.event_id = ev.event_id)
    SELECT x.event_id, x.event_id = r.refreshed AS is_refresh, r.value AS cached_value FROM events x ASOF JOIN r ON x.user_id = r.user_id AND x.ts >= r.ts"""
_QUIET = """
    SELECT user_id, event_id FROM (SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS after FROM events)
    WHERE after IS NULL OR after - ts > INTERVAL 12 HOUR"""


def slim_events(t):
    return t.events.select("event_id", "ts", "user_id", "value")


@query("throttle_events", "R7", _THROTTLED)
def throttle_events(t):
    return edges.throttle(slim_events(t), "user_id", "ts", DAY, "event_id").select("user_id", "event_id")


@query("throttle_stream", "R7 R2", _THROTTLED)
def throttle_stream(t):
    base = work_folder(t.spark, "throttle")
    work_off(t, slim_events(t), "event_id", base, feeds.throttle_stream(base, "user_id", "ts", DAY, "event_id"))
    return t.spark.read.parquet(f"{base}/emitted").select("user_id", "event_id")


@query("ttl_lookup", "R9", _CACHED)
def ttl_lookup(t):
    out = edges.ttl_lookup(slim_events(t), "user_id", "ts", "value", DAY, "event_id")
    return out.select("event_id", "is_refresh", "cached_value")


@query("ttl_stream", "R9", _CACHED)
def ttl_stream(t):
    base = work_folder(t.spark, "ttl")
    work_off(t, slim_events(t), "event_id", base, feeds.ttl_stream(base, "user_id", "ts", "value", DAY, "event_id"))
    return t.spark.read.parquet(f"{base}/answered").select("event_id", "is_refresh", "cached_value")


@query("debounce_events", "R8", _QUIET)
def debounce_events(t):
    events = t.events.select("event_id", "ts", "user_id")
    return edges.debounce(events, "user_id", "ts", DAY // 2, "event_id").select("user_id", "event_id")


@query("debounce_stream", "R8", _QUIET)
def debounce_stream(t):
    """The drops, then a run from the checkpoint with the closing row that ends all bursts."""
    base = work_folder(t.spark, "debounce")
    events = t.events.select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id")
    files = drop_in_turn(events, "event_id", f"{base}/in")
    stream = t.spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{base}/in")
    job = (stream, "user_id", "ts", DAY // 2, "1 hour", f"{base}/out", f"{base}/checkpoint", "event_id")
    feeds.debounce_stream(*job)
    bursts.closing_row(events, "ts", DAY // 2, 3600).write.mode("append").parquet(f"{base}/in")
    feeds.debounce_stream(*job)
    return t.spark.read.schema(events.schema).parquet(f"{base}/out").select("user_id", "event_id")


@query(
    "late_rows",
    "R8",
    """
    WITH e AS (SELECT event_id, CASE WHEN event_id % 50 = 0 THEN ts - INTERVAL 20 DAY ELSE ts END AS ts FROM events),
    r AS (SELECT min(event_id) AS lo, (max(event_id) - min(event_id)) / 3.0 AS step FROM e),
    b AS (SELECT event_id, ts, CASE WHEN event_id < lo + step THEN 0 WHEN event_id < lo + step * 2 THEN 1 ELSE 2 END AS b FROM e, r),
    m AS (SELECT b, max(max(ts)) OVER (ORDER BY b) AS latest FROM b GROUP BY b)
    SELECT event_id, coalesce(b.ts < m.latest - INTERVAL 1 DAY, false) AS late FROM b LEFT JOIN m ON m.b = b.b - 1""",
)
def late_rows(t):
    base = work_folder(t.spark, "late")
    old = F.expr("ts - INTERVAL 20 DAYS")
    events = t.events.select("event_id", F.when(F.col("event_id") % 50 == 0, old).otherwise(F.col("ts")).alias("ts"))
    work_off(t, events, "event_id", base, feeds.route_late(base, "ts", DAY))
    return t.spark.read.parquet(f"{base}/routed").select("event_id", F.col("late").cast("boolean").alias("late"))


def staged(t):
    return staging.stage_payloads(payloads(t), "payload", FIELDS, ["c_custkey"], at())


@query("sweep_stream", "R1 R2 R3 M14 M18", nightly_sql("FULL"))
def sweep_stream(t):
    base = work_folder(t.spark, "sweep")
    handler = feeds.sweep_queue(base, nightly_table(t), "SYNC", at())
    work_off(t, staged(t), "stage_order", base, handler)
    nightly = feeds.nightly_table(t.spark, base, nightly_table(t))
    return nightly.select("integration_id", "first_name", "sex", "created_by", "updated_by")


@query(
    "sweep_statuses",
    "R1 M14",
    """SELECT CASE WHEN c_custkey % 97 = 0 THEN 'ERROR' ELSE 'SUCCESS' END AS status, count(*) AS n
       FROM (SELECT c_custkey, unnest(range(c_custkey % 2 + 1)) AS i FROM customer) GROUP BY 1""",
)
def sweep_statuses(t):
    base = work_folder(t.spark, "sweep")
    handler = feeds.sweep_queue(base, nightly_table(t), "SYNC", at())
    work_off(t, staged(t), "stage_order", base, handler)
    return t.spark.read.parquet(f"{base}/outcomes").groupBy("status").agg(F.count("*").alias("n"))


def changed_items(t):
    ending = F.when(F.col("event_id") % 7 == 0, ".txt").when(F.col("event_id") % 2 == 0, ".XLSX").otherwise(".xlsm")
    return t.events.select(
        F.concat(F.lit("file"), "user_id", ending).alias("name"),
        F.col("user_id").cast("string").alias("item_id"),
        F.col("event_type").alias("etag"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("last_modified"),
        F.col("event_id").alias("seq"),
    )


def judged_sql(source: str) -> str:
    return f"""
    WITH x AS (SELECT event_id, user_id, event_type AS etag FROM ({source}) WHERE event_id % 7 <> 0),
    p AS (SELECT *, last_value(etag IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM x)
    SELECT event_id AS seq, CASE WHEN held = etag THEN 'skipped' ELSE 'processed' END AS outcome FROM p"""


def wanted(items):
    return feeds.only_endings(items, "name", [".xlsx", ".xlsm"])


def no_errors(items):
    return items.withColumn("error", F.lit(None).cast("string"))


@query("change_feed", "R4 R5", judged_sql("SELECT * FROM events"))
def change_feed(t):
    base = work_folder(t.spark, "feed")
    work_off(t, changed_items(t), "seq", base, feeds.process_changes(base, no_errors, "seq"), where=wanted)
    return t.spark.read.parquet(f"{base}/outcomes").select("seq", "outcome")


@query(
    "change_feed_baseline",
    "R4",
    judged_sql("SELECT * FROM events WHERE event_id >= (SELECT avg(event_id) FROM events)"),
)
def change_feed_baseline(t):
    """Items there at the start are the baseline; only later ones are emitted."""
    base = work_folder(t.spark, "baseline")
    items = changed_items(t)
    middle = items.agg(F.avg("seq")).first()[0]
    items.where(F.col("seq") < middle).write.parquet(f"{base}/in")
    stream = t.spark.readStream.schema(items.schema).parquet(f"{base}/in")
    stream = wanted(stream)
    feeds.warm_baseline(stream, f"{base}/checkpoint")
    items.where(F.col("seq") >= middle).write.mode("append").parquet(f"{base}/in")
    feeds.run_available(stream, f"{base}/checkpoint", feeds.process_changes(base, no_errors, "seq"))
    return t.spark.read.parquet(f"{base}/outcomes").select("seq", "outcome")


@query(
    "change_feed_failures",
    "R6 R5",
    """
    WITH x AS (SELECT event_id, user_id, event_type AS etag, event_id % 11 = 3 AS bad FROM events WHERE event_id % 7 <> 0),
    p AS (SELECT *, last_value(CASE WHEN NOT bad THEN etag END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS held FROM x)
    SELECT event_id AS seq, CASE WHEN held = etag THEN 'skipped' WHEN bad THEN 'failed' ELSE 'processed' END AS outcome FROM p""",
)
def change_feed_failures(t):
    base = work_folder(t.spark, "failures")

    def process(items):
        return items.withColumn("error", F.when(F.col("seq") % 11 == 3, "cannot read"))

    work_off(t, changed_items(t), "seq", base, feeds.process_changes(base, process, "seq"), 1, wanted)
    return t.spark.read.parquet(f"{base}/outcomes").select("seq", "outcome")


@query(
    "live_grep",
    "R10",
    """SELECT line, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
       WHERE regexp_matches(line, 'tion[a-z]* of') GROUP BY line""",
)
def live_grep(t):
    base = work_folder(t.spark, "grep")
    t.documents.select("text").write.text(f"{base}/in")
    stream = t.spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/in")
    matching = lines.live_lines(stream, "value", "tion[a-z]* of")
    job = (
        matching.writeStream.format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start()
    )
    job.awaitTermination()
    found = t.spark.read.schema("value string").parquet(f"{base}/out")
    return found.groupBy(F.col("value").alias("line")).agg(F.count("*").alias("n"))
