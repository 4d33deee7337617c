"""Operators under hot keys, ties and repeats, against brute force."""

import numpy as np
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators import groups, joins, numbering, quantiles
from millrace.plans import align, load, migrate
from millrace.plans.spec import ColumnSpec, TableSpec
from millrace.session import work_folder
from millrace.sources import publish
from millrace.streaming import edges, feeds


def hot_frame(spark, n=3000):
    """A third of all rows share one key."""
    key = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 97 + 1)
    return spark.range(n).select(F.col("id"), key.alias("k"))


def test_group_count_with_hot_and_null_keys(spark):
    frame = hot_frame(spark).withColumn("k", F.when(F.col("id") % 10 != 7, F.col("k")))
    got = {r["id"]: r["n"] for r in joins.with_group_count(frame, ["k"], "n").collect()}
    sizes = {r["k"]: r["count"] for r in frame.groupBy("k").count().collect()}
    assert got == {r["id"]: sizes[r["k"]] for r in frame.collect()}


def test_lookup_with_hot_keys(spark):
    frame = hot_frame(spark).withColumn("k", F.when(F.col("id") % 10 != 7, F.col("k")))
    table = spark.createDataFrame([(i, f"v{i}") for i in range(0, 60)], "k bigint, v string")
    got = {r["id"]: r["v"] for r in joins.lookup_join(frame, table, ["k"]).collect()}
    assert got == {r["id"]: (f"v{r['k']}" if r["k"] is not None and r["k"] < 60 else None) for r in frame.collect()}


def test_lists_in_parts_hold_everything_in_order(spark):
    frame = hot_frame(spark, 900)
    parts = groups.json_array_agg(frame, ["k"], F.col("id"), ["id"], "ids", part_rows=50)
    rows = parts.select("k", "part", F.from_json("ids", "array<bigint>").alias("ids")).orderBy("k", "part").collect()
    assert max(len(r["ids"]) for r in rows) == 50
    whole = {}
    for r in rows:
        whole.setdefault(r["k"], []).extend(r["ids"])
    wanted = {}
    for r in frame.orderBy("id").collect():
        wanted.setdefault(r["k"], []).append(r["id"])
    assert whole == wanted
    whole_rows = groups.json_array_agg(frame, ["k"], F.col("id"), ["id"], "ids")
    assert whole_rows.columns == ["k", "ids"]
    assert {r["k"]: json.loads(r["ids"]) for r in whole_rows.collect()} == wanted


def test_one_group_a_thousand_times_as_large_stays_one_row(spark):
    frame = spark.range(105_000).select("id", F.when(F.col("id") < 103_000, 0).otherwise(F.col("id") % 20).alias("k"))
    lists = groups.ordered_list(frame, ["k"], "id", ["id"], " ", count="n").collect()
    assert len(lists) == 20 and all(len(r["list"].split()) == r["n"] for r in lists)
    objects = groups.json_object_agg(frame.withColumn("name", F.col("id") % 7), ["k"], "name", "id", order_by=["id"])
    assert objects.count() == 20


def test_object_with_repeated_keys(spark):
    frame = spark.createDataFrame([("g", "a", 1), ("g", "a", 2), ("g", "b", None)], "g string, k string, v int")
    assert groups.json_object_agg(frame, ["g"], "k", "v").first()["object"] == '{"a":2,"b":null}'
    assert groups.json_object_agg(frame, ["g"], "k", "v", absent_on_null=True).first()["object"] == '{"a":2}'
    timed = spark.createDataFrame([("g", "a", 5, 1), ("g", "a", 2, 2)], "g string, k string, v int, at int")
    assert groups.json_object_agg(timed, ["g"], "k", "v", order_by=["at"]).first()["object"] == '{"a":2}'
    with pytest.raises(Exception, match="repeated key"):
        groups.json_object_agg(frame, ["g"], "k", "v", unique_keys=True).collect()


@pytest.mark.parametrize("shape", ["normal", "hot", "tiny", "spread", "signs"])
def test_exact_quantiles(spark, shape, monkeypatch):
    monkeypatch.setattr(quantiles, "SMALL", 100)
    monkeypatch.setattr(quantiles, "BINS", 16)
    rng = np.random.default_rng(7)
    values = {
        "normal": rng.normal(size=4000),
        "hot": np.where(rng.random(4000) < 0.4, 5.0, rng.random(4000) * 10),
        "tiny": np.array([3.0]),
        "spread": 10.0 ** rng.uniform(-30, 30, size=3000),
        "signs": np.concatenate([-(10.0 ** rng.uniform(-5, 12, 1500)), 10.0 ** rng.uniform(-5, 12, 1500)]),
    }[shape]
    frame = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    got = quantiles.exact_quantiles(frame, "x", [0.0, 0.25, 0.5, 0.75, 1.0])
    assert got == pytest.approx(list(np.quantile(values, [0.0, 0.25, 0.5, 0.75, 1.0])), rel=1e-12)


def test_quantiles_of_nothing(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert quantiles.exact_quantiles(empty, "x", [0.5]) == [None]
    assert quantiles.remove_outliers(empty, ["x"]).count() == 0


def test_numbering_and_previous(spark):
    frame = hot_frame(spark, 500).repartition(7)
    rows = numbering.number_rows(frame, ["k", "id"], "n", start=10).orderBy("n").collect()
    assert [r["n"] for r in rows] == list(range(10, 510))
    assert [(r["k"], r["id"]) for r in rows] == sorted((r["k"], r["id"]) for r in rows)
    before = numbering.with_previous(frame, ["id"], {"id": "p"}).collect()
    assert {r["id"]: r["p"] for r in before} == {i: (i - 1 if i else None) for i in range(500)}


def brute_edges(rows, width):
    until, out = {}, set()
    for key, us, tie in sorted(rows, key=lambda r: (r[1], r[2])):
        if us >= until.get(key, -(10**18)):
            out.add(tie)
            until[key] = us + width
    return out


@pytest.mark.parametrize("slice_edges", [1, 3, 256])
def test_edges_match_a_plain_walk(spark, slice_edges, monkeypatch):
    monkeypatch.setattr(edges, "SLICE_EDGES", slice_edges)
    rng = np.random.default_rng(slice_edges)
    n = 3000
    # One key holds half of the rows; times repeat; some events sit exactly on an edge.
    keys = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 40, n))
    times = rng.integers(0, 4_000, n) * 250_000
    rows = [(int(k), int(u), i) for i, (k, u) in enumerate(zip(keys, times))]
    frame = spark.createDataFrame(rows, "k bigint, us bigint, i bigint").withColumn(
        "ts", F.timestamp_add("MICROSECOND", F.col("us"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    got = {r["i"] for r in edges.throttle(frame, "k", "ts", 7, "i").collect()}
    assert got == brute_edges(rows, 7_000_000)


def test_debounce_twins_agree_with_a_plain_walk(spark):
    rng = np.random.default_rng(3)
    n = 2000
    keys = np.where(rng.random(n) < 0.5, 1, rng.integers(2, 30, n))
    times = rng.permutation(20_000)[:n] * 500
    rows = [(int(k), int(u), i) for i, (k, u) in enumerate(zip(keys, times))]
    frame = spark.createDataFrame(rows, "k bigint, ms bigint, i bigint").withColumn(
        "ts", F.timestamp_add("MILLISECOND", F.col("ms"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    by_key = {}
    for k, u, i in sorted(rows, key=lambda r: r[1]):
        by_key.setdefault(k, []).append((u, i))
    wanted = {
        i for events in by_key.values() for (u, i), after in zip(events, [*events[1:], (None, None)])
        if after[0] is None or after[0] - u > 30_000
    }
    assert {r["i"] for r in edges.debounce(frame, "k", "ts", 30, "i").collect()} == wanted
    zoned = frame.withColumn("ts", F.col("ts").cast("timestamp"))
    assert {r["i"] for r in edges.debounce_windows(zoned, "k", "ts", 30, "i").collect()} == wanted


def test_ttl_uses_the_value_of_the_refresh(spark):
    rows = [(1, 0, "a"), (1, 5, "b"), (1, 10, "c"), (1, 19, "d"), (1, 20, "e"), (2, 3, "z")]
    frame = spark.createDataFrame(rows, "k int, s int, v string").withColumn(
        "ts", F.timestamp_add("SECOND", F.col("s"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    out = {(r["k"], r["s"]): (r["is_refresh"], r["cached_value"]) for r in edges.ttl_lookup(frame, "k", "ts", "v", 10, "s").collect()}
    assert out == {
        (1, 0): (True, "a"), (1, 5): (False, "a"), (1, 10): (True, "c"), (1, 19): (False, "c"), (1, 20): (True, "e"), (2, 3): (True, "z"),
    }


def test_upsert_is_idempotent_and_keeps_null_keys(spark):
    target = spark.createDataFrame([(1, "a", 1), (2, "b", 2), (None, "n", 3)], "k int, v string, w int")
    source = spark.createDataFrame([(2, "x", 1), (2, None, 2), (5, "e", 1), (None, "m", 1)], "k int, v string, seq int")
    once = load.upsert(target, source, ["k"], ["seq"])
    got = sorted((str(r["k"]), str(r["v"]), str(r["w"])) for r in once.collect())
    assert got == [("1", "a", "1"), ("2", "None", "2"), ("5", "e", "None"), ("None", "m", "None"), ("None", "n", "3")]
    keyed = source.where("k is not null")
    first = load.upsert(target, keyed, ["k"], ["seq"])
    second = load.upsert(first, keyed, ["k"], ["seq"])
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    with pytest.raises(ValueError):
        load.upsert(target, source, [])
    with pytest.raises(ValueError):
        load.delete(target, target, "k")
    with pytest.raises(ValueError):
        load.load(target, source, "merge")


def test_hot_parent_key_validation(spark):
    frame = hot_frame(spark, 300)
    spec = TableSpec("t", (ColumnSpec("id", "integer", unique=True), ColumnSpec("k", "integer", references="p.k")))
    parents = spark.createDataFrame([(i,) for i in range(1, 98)], "k bigint")
    bad = load.validate(frame, spec, {"k": (parents, "k")}).where("error_msg is not null")
    assert bad.count() == 100 and {r["error_msg"] for r in bad.collect()} == {"k has no parent"}


def test_widening(spark):
    spec = TableSpec("t", (ColumnSpec("s", max_length=3),))
    frame = spark.createDataFrame([("ab",), ("abcdef",), ("x" * 4001,)], "s string")
    good, rejected, wider = align.widen_on_overflow(frame, spec)
    assert (good.count(), rejected.count(), wider.columns[0].max_length) == (2, 1, 56)
    assert good.schema["s"].metadata["max_length"] == 56


def test_publish_keeps_the_old_version_on_failure(spark):
    base = work_folder(spark, "publish-test")

    def refuse(_):
        raise ValueError("no")

    publish.publish_version(spark.range(3), base, "kept", "1", view="kept")
    with pytest.raises(ValueError):
        publish.publish_version(spark.range(5), base, "kept", "2", check=refuse, view="kept")
    assert publish.current(spark, base, "kept").count() == 3
    assert spark.table("kept").count() == 3
    for i in range(2, 6):
        publish.publish_version(spark.range(i), base, "kept", str(i), retain=0)
    assert len(publish.versions(spark, base, "kept")) == 5


def test_state_before_ignores_the_batch_itself(spark):
    base = work_folder(spark, "state-test")
    for i in range(3):
        publish.publish_version(spark.range(i + 1), base, "s", feeds.stamp(i))
    assert feeds.state_before(spark, base, "s", 2).count() == 2
    assert feeds.state_before(spark, base, "s", 0) is None


def test_state_is_kept_as_changes_and_folded(spark, monkeypatch):
    monkeypatch.setattr(feeds, "COMPACT_EVERY", 3)
    base = work_folder(spark, "fold-test")

    def state(i):
        held = feeds.read_state(spark, base, "s", i, ["k"])
        return None if held is None else {r["k"]: r["v"] for r in held.collect()}

    for i in range(7):
        rows = spark.createDataFrame([(i % 4, i)], "k int, v int")
        feeds.write_state(rows, feeds.read_state(spark, base, "s", i, ["k"]), base, "s", i, ["k"])
    assert state(0) is None and state(1) == {0: 0}
    assert state(7) == {0: 4, 1: 5, 2: 6, 3: 3} and state(6) == {0: 4, 1: 5, 2: 2, 3: 3}
    assert publish.versions(spark, base, "s") == [f"v={feeds.stamp(5)}", f"v={feeds.stamp(2)}"]


def test_changed_back_to_an_older_version_is_processed(spark):
    base = work_folder(spark, "changes-test")
    handle = feeds.process_changes(base, lambda d: d.withColumn("error", F.when(F.col("etag") == "bad", "x")), "seq")
    schema = "item_id string, etag string, last_modified string, seq int"

    def outcomes(i, rows):
        handle(spark.createDataFrame(rows, schema), i)
        out = spark.read.parquet(f"{base}/outcomes/batch={feeds.stamp(i)}").orderBy("seq")
        return [(r["seq"], r["outcome"]) for r in out.collect()]

    assert outcomes(0, [("a", "1", "t1", 1), ("a", "1", "t2", 2), ("a", "2", "t2", 3), ("a", "1", "t1", 4), ("b", "bad", "t", 5)]) == [
        (1, "processed"), (2, "skipped"), (3, "processed"), (4, "processed"), (5, "failed"),
    ]
    # The failed item comes again from the dead letters; a known time alone also counts as processed.
    assert outcomes(1, [("a", "", "t1", 6), ("a", "", "", 7)]) == [(5, "failed"), (6, "skipped"), (7, "processed")]
    # A batch that is run again gives the same result.
    assert outcomes(1, [("a", "", "t1", 6), ("a", "", "", 7)]) == [(5, "failed"), (6, "skipped"), (7, "processed")]


def test_run_log_can_be_off(spark):
    path = work_folder(spark, "log-test")
    migrate.RunLog(spark, path, "r", enabled=False).write("a", "b")
    log = migrate.RunLog(spark, path, "r")
    log.write("step", "message", "payload")
    assert [(r["run_id"], r["payload"]) for r in log.read().collect()] == [("r", "payload")]
