"""Streaming operators under hot keys, restarts and repeated batches, against plain walks."""

import threading

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.plans import staging
from millrace.session import work_folder
from millrace.sources import publish
from millrace.streaming import bursts, changes, edges, feeds
from millrace.streaming.buckets import BucketState

START = "2024-01-01"


def timed(spark, rows):
    """(key, microseconds, number) rows as events."""
    frame = spark.createDataFrame(rows, "k bigint, us bigint, i bigint")
    return frame.withColumn("ts", F.timestamp_add("MICROSECOND", F.col("us"), F.lit(START).cast("timestamp_ntz")))


def walked(rows, width):
    """The edge every event falls under, by a plain walk in order of time."""
    until, out = {}, {}
    for key, us, i in sorted(rows, key=lambda r: (r[1], r[2])):
        fresh = us >= until.get(key, -(10**18))
        if fresh:
            until[key] = us + width
        out[i] = (fresh, until[key] - width)
    return out


DAY = 86_400


def hot_events(n=20_000, days=30):
    """A third of all rows under one key, spread over a month; some times repeat, some sit on an edge."""
    rng = np.random.default_rng(4)
    keys = np.where(rng.random(n) < 1 / 3, 7, rng.integers(10, 200, n))
    times = rng.integers(0, days * DAY, n) * 1_000_000
    times[::50] = times[1::50] + DAY * 1_000_000
    return [(None if k == 11 else int(k), int(u), i) for i, (k, u) in enumerate(zip(keys, times, strict=True))]


def test_hot_key_edges_at_the_registered_width(spark):
    rows = hot_events()
    marked = edges.mark_edges(timed(spark, rows), "k", "ts", DAY, "i").collect()
    epoch = int(np.datetime64(START).astype("datetime64[us]").astype(int))
    assert {r["i"]: (r["is_edge"], r["edge_us"] - epoch) for r in marked} == walked(rows, DAY * 1_000_000)


def test_no_task_gets_a_large_share_of_a_hot_key(spark):
    """The rows that meet in one group of any step: events of a slice, or step functions of a parent."""
    rows = [(7, i * 26_000_000, i) for i in range(100_000)]  # one key, an event every 26 seconds for a month
    slim = timed(spark, rows).select(F.col("k").alias("__key"), edges.micros(F.col("ts")).alias("__us"))
    span = DAY * 1_000_000 * edges.SLICE_EDGES
    slices = slim.groupBy(F.floor(F.col("__us") / span)).count().agg(F.max("count")).first()[0]
    assert slices <= 0.07 * len(rows)
    steps = slim.withColumn("__slice", F.floor(F.col("__us") / span))
    level = steps.repartition("__slice").sortWithinPartitions("__key", "__slice", "__us").mapInArrow(
        edges._steps(DAY * 1_000_000, span), "__key long, __slice long, __entry long, __exit long"
    )
    parents = level.groupBy(F.shiftright("__slice", edges.FAN_BITS)).count().agg(F.max("count")).first()[0]
    assert parents <= 0.14 * len(rows)


def test_long_walks_compose_over_many_levels(spark, monkeypatch):
    monkeypatch.setattr(edges, "SLICE_EDGES", 1)
    monkeypatch.setattr(edges, "FAN_BITS", 1)
    rng = np.random.default_rng(8)
    rows = [(int(rng.integers(0, 3)), int(u), i) for i, u in enumerate(rng.integers(-600, 600, 1500) * 500_000)]
    marked = edges.mark_edges(timed(spark, rows), "k", "ts", 5, "i").collect()
    assert {r["i"]: r["is_edge"] for r in marked} == {i: fresh for i, (fresh, _) in walked(rows, 5_000_000).items()}


def test_carried_edges_in_batches(spark):
    rows = hot_events(6_000)
    base = work_folder(spark, "throttle-test")
    handle = feeds.throttle_stream(base, "k", "ts", DAY, "i")
    ordered = sorted(rows, key=lambda r: r[1])
    for batch, at in enumerate(range(0, 6_000, 2_000)):
        handle(timed(spark, ordered[at : at + 2_000]), batch)
    handle(timed(spark, ordered[4_000:]), 2)  # the last batch once more
    got = {r["i"] for r in spark.read.parquet(f"{base}/emitted").collect()}
    assert got == {i for i, (fresh, _) in walked(rows, DAY * 1_000_000).items() if fresh}


def plain_judging(rows):
    held, out = {}, {}
    for item, etag, modified, seq, bad in sorted(rows, key=lambda r: r[3]):
        e, m = held.get(item, ("", ""))
        if (e and etag == e) or (m and modified == m):
            out[seq] = "skipped"
        elif bad:
            out[seq] = "failed"
        else:
            out[seq], held[item] = "processed", (etag or "", modified or "")
    return out


@pytest.mark.parametrize("tags", [2, 6, 400])
def test_half_of_all_versions_under_one_item(spark, tags):
    """Tags and times repeat, so that versions match each other by either; some items fail."""
    rng = np.random.default_rng(tags)
    n = 4_000
    rows = []
    for seq in range(n):
        item = "hot" if rng.random() < 0.5 else f"i{rng.integers(0, 60)}"
        etag = None if rng.random() < 0.05 else f"e{rng.integers(0, tags)}"
        modified = None if rng.random() < 0.05 else f"t{rng.integers(0, 10 * tags)}"
        rows.append((item, etag, modified, seq, bool(rng.random() < 0.1)))
    frame = spark.createDataFrame(rows, "item_id string, etag string, last_modified string, seq long, bad boolean").repartition(5)
    tried = frame.withColumns({"error": F.expr("CASE WHEN bad THEN 'x' END"),
                               "held_etag": F.lit(None).cast("string"), "held_modified": F.lit(None).cast("string")})
    judged = changes.judge_versions(tried, "seq")
    assert judged.columns == ["item_id", "etag", "last_modified", "seq", "bad", "error", "outcome"]
    assert {r["seq"]: r["outcome"] for r in judged.collect()} == plain_judging(rows)


def test_one_version_all_over_and_the_size_of_a_task(spark):
    """The same tag in every row: the first is processed, wherever pieces begin."""
    rows = [("hot", "e", f"t{seq}", seq) for seq in range(3_000)]
    frame = spark.createDataFrame(rows, "item_id string, etag string, last_modified string, seq long")
    tried = frame.withColumns({c: F.lit(None).cast("string") for c in ("error", "held_etag", "held_modified")})
    ranged = tried.repartitionByRange("item_id", "seq").groupBy(F.spark_partition_id()).count()
    judged = {r["seq"]: r["outcome"] for r in changes.judge_versions(tried, "seq").collect()}
    assert judged == {seq: "skipped" if seq else "processed" for seq in range(3_000)}
    assert ranged.count() >= 1
    assert changes.judge_versions(tried.limit(0), "seq").count() == 0


def test_pieces_compose_like_a_walk():
    """What pieces say of themselves, put together, is what a walk over all rows ends with."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        versions = [(f"e{rng.integers(0, 3)}", f"t{k}", "x" if rng.random() < 0.2 else None) for k in range(int(rng.integers(1, 30)))]
        cut = sorted(rng.integers(0, len(versions) + 1, 3).tolist())
        held = (f"e{rng.integers(0, 3)}", "t-1")
        walked_end = changes._end(held, versions)
        for a, b in zip([0, *cut], [*cut, len(versions)], strict=True):
            tag, other, same = changes._piece(versions[a:b])
            held = changes._through(held, tag, other, same)
        assert held == walked_end


def bytes_read(spark, state, batch):
    """Bytes of the files that a batch's state is read from."""
    from millrace.sources import storage

    total = 0
    for file in state.touched(batch, 2**62).inputFiles():
        fs, path = storage._fs(spark, file)
        total += fs.getFileStatus(path).getLen()
    return total


def test_state_reads_follow_the_batch_when_the_table_grows(spark):
    def grown(rows):
        first = spark.range(rows).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
        return BucketState(spark, work_folder(spark, "grow-test"), "s", ["k"], first, rows=200)

    batch = spark.createDataFrame([(3,), (500,), (10**9,)], "k long")
    small, large = grown(2_000), grown(20_000)
    few, many = bytes_read(spark, small, batch), bytes_read(spark, large, batch)
    assert 0 < many < 2 * few
    assert large.all().count() == 20_000 and large.of(batch, 2**62).count() == 2


def test_bucket_state_against_a_dict(spark):
    base = work_folder(spark, "bucket-test")
    rng = np.random.default_rng(6)
    state, want, seen = BucketState(spark, base, "s", ["k"], rows=20), {}, []
    assert state.all() is None and state.of(spark.range(3).withColumnRenamed("id", "k"), 0) is None
    for batch in range(8):
        keys = {None if x == 0 else int(x) for x in rng.integers(0, 30 * (batch + 1), 40)}
        rows = [(k, f"{batch} {rng.bytes(200).hex()}") for k in keys]
        frame = spark.createDataFrame(rows, "k long, v string")
        state.write(frame, batch)
        state.write(frame, batch)  # a batch that is run again changes nothing
        want |= dict(rows)
        seen.append(dict(want))
        assert {r["k"]: r["v"] for r in state.all().collect()} == want
        held = state.of(frame, batch)
        assert batch == 0 or {r["k"]: r["v"] for r in held.collect()} == {k: v for k, v in seen[batch - 1].items() if k in keys}
    assert state.manifest(2**62)["buckets"] > 2  # the layout follows the rows
    assert state.manifest(0) is None


def test_one_payload_gives_exactly_one_export_row(spark):
    base = work_folder(spark, "sweep-test")
    fields = {"id": "string", "first_name": "string", "last_name": "string", "birthdate": "date", "sex": "int"}
    payload = '[{"id":"999111","first_name":"Testy","last_name":"McTest","birthdate":"1985-05-05"}]'
    rows = staging.shred_payload(spark.createDataFrame([(1, payload)], "n int, payload string"), "payload", fields)
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    staged = staging.stage_records(rows, ["n", "item_no"], at)
    first = spark.sql(
        "SELECT '000000001' AS integration_id, 'Old' AS first_name, CAST(NULL AS string) AS last_name, CAST(NULL AS date) AS birthdate, "
        "CAST(NULL AS int) AS sex, CAST(NULL AS timestamp_ntz) AS created_at, CAST(NULL AS timestamp_ntz) AS updated_at, 'o' AS created_by, 'o' AS updated_by"
    )
    staged.write.parquet(f"{base}/in")
    stream = spark.readStream.schema(staged.schema).parquet(f"{base}/in")
    for _ in range(2):  # the second run finds nothing new
        feeds.run_available(stream, f"{base}/checkpoint", feeds.sweep_queue(base, first, "SYNC", at))
    out = feeds.nightly_table(spark, base, first)
    assert out.count() == 2
    new = out.where("integration_id = '999111'").collect()
    assert [(r["first_name"], r["last_name"], str(r["birthdate"]), r["created_by"]) for r in new] == [("Testy", "McTest", "1985-05-05", "SYNC")]


def test_debounce_goes_on_from_its_checkpoint(spark):
    """Bursts that stay open over a restart; the closing row lets the last ones out."""
    rng = np.random.default_rng(3)
    times = np.sort(rng.permutation(40_000)[:3_000]) * 500_000
    rows = [(None if k == 29 else int(k), int(u), i) for i, (k, u) in enumerate(zip(np.where(rng.random(3_000) < 0.5, 1, rng.integers(2, 30, 3_000)), times, strict=True))]
    frame = timed(spark, rows).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("note", F.concat(F.lit("n"), "i"))
    base = work_folder(spark, "debounce-test")

    def run():
        stream = spark.readStream.schema(frame.schema).parquet(f"{base}/in")
        feeds.debounce_stream(stream, "k", "ts", 30, "10 seconds", f"{base}/out", f"{base}/checkpoint", "i")
        return spark.read.schema(frame.schema).parquet(f"{base}/out").collect()

    counts = []
    for part in range(3):
        frame.where(F.floor(F.col("i") / 1_000) == part).write.mode("append").parquet(f"{base}/in")
        counts.append(len(run()))
    wanted = {r["i"] for r in edges.debounce(frame, "k", "ts", 30, "i").collect()}
    assert 0 < counts[0] < counts[1] < counts[2] < len(wanted)
    bursts.closing_row(frame, "ts", 30, 10).write.mode("append").parquet(f"{base}/in")
    got = run()
    assert {r["i"] for r in got} == wanted and len(got) == len(wanted)
    text = {i: (k, u) for k, u, i in rows}
    assert all(r["k"] == text[r["i"]][0] and r["note"] == f"n{r['i']}" for r in got)


def test_current_never_fails_while_a_stamp_is_published_again(spark):
    base = work_folder(spark, "publish-again")
    publish.publish_version(spark.range(100), base, "t", "1")
    stop, seen, failed = threading.Event(), [], []

    def read():
        while not stop.is_set():
            try:
                seen.append(publish.current(spark, base, "t").count())
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for n in range(101, 109):
        publish.publish_version(spark.range(n), base, "t", "1")
    stop.set()
    reader.join()
    assert not failed and seen == sorted(seen) and publish.versions(spark, base, "t") == ["v=1"]
    assert publish.current(spark, base, "t").count() == 108
