"""Inputs that once lost rows, hung or changed values."""

import math

import pytest
from pyspark.sql import functions as F

from millrace.functions import jsondoc as js
from millrace.operators import lines, quantiles
from millrace.plans import load, staging
from millrace.session import work_folder
from millrace.sources import delimited, publish


def test_line_anchors_hold_inside_documents(spark):
    docs = spark.createDataFrame([(1, "a\nERROR x\nb")], "k int, text string")
    assert [r["line_no"] for r in lines.search_lines(docs, "k", "text", "^ERROR").collect()] == [2]
    assert [r["line_no"] for r in lines.context_lines(docs, "k", "text", "x$", 0).collect()] == [2]
    assert [r["line"] for r in lines.lines_between(docs, "k", "text", "^ERROR", "^b$").collect()] == ["ERROR x", "b"]


def test_infinities_do_not_stop_quantiles(spark):
    values = spark.range(30_000).select(F.col("id").cast("double").alias("v"))
    odd = values.union(spark.createDataFrame([(math.inf,), (-math.inf,)], "v double"))
    assert quantiles.exact_quantiles(odd, "v", [0.0, 0.5, 1.0]) == [-math.inf, 14999.5, math.inf]
    only = spark.createDataFrame([(math.inf,), (math.inf,)], "v double")
    assert quantiles.exact_quantiles(only, "v", [0.5]) == [math.inf]


def test_repeated_keys_need_an_order(spark):
    target = spark.createDataFrame([(1, "old")], "id int, v string")
    twice = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "id int, v string, at int")
    with pytest.raises(Exception, match="several rows without an order"):
        load.upsert(target, twice, ["id"]).collect()
    got = load.upsert(target, twice, ["id"], ["at"]).collect()
    assert sorted((r["id"], r["v"]) for r in got) == [(1, "b"), (2, "c")]
    once = load.upsert(target, twice.where("at = 1"), ["id"]).collect()
    assert sorted((r["id"], r["v"]) for r in once) == [(1, "a"), (2, "c")]


def test_broken_payloads_are_reported(spark):
    rows = spark.createDataFrame([(1, '[{"id":"a"}]'), (2, '[{"id":'), (3, None), (4, "[]")], "k int, p string")
    got = {r["k"]: r["error_msg"] for r in staging.shred_payload(rows, "p", {"id": "string"}).collect()}
    assert got == {1: None, 2: "payload is not a JSON array"}
    with pytest.raises(Exception, match="not a JSON array"):
        staging.shred_payload(rows, "p", {"id": "string"}, fail_fast=True).collect()


def test_numbers_of_a_patch_keep_their_text(spark):
    docs = spark.createDataFrame([('{"a":12345678901234567.12345,"b":1}', '{"b":1e400}'), ("{", "{}"), ('{"a":NaN}', "{}")], "d string, p string")
    got = [r[0] for r in docs.select(js.merge_patch(F.col("d"), F.col("p"))).collect()]
    assert got == ['{"a":12345678901234567.12345,"b":1e400}', None, None]


def test_checks_run_before_a_version_is_seen(spark):
    base = work_folder(spark, "publish-check")
    publish.publish_version(spark.range(3), base, "t", "1")
    seen = []
    publish.publish_version(spark.range(5), base, "t", "2", check=lambda _: seen.append(publish.current(spark, base, "t").count()))
    assert seen == [3] and publish.current(spark, base, "t").count() == 5
    publish.publish_version(spark.range(7), base, "t", "2")
    assert publish.current(spark, base, "t").count() == 7 and publish.versions(spark, base, "t") == ["v=2", "v=1"]


def test_long_quoted_fields_parse(spark):
    text = 'a,b\n"' + 'x""\n' * 60_000 + '",1\n'
    row = delimited.parse_csv_column(spark.createDataFrame([(text,)], "t string"), "t", ["a", "b"]).first()
    assert len(row["a"]) == 180_000 and row["b"] == "1"


def test_sweeps_change_only_the_keys_of_a_batch(spark):
    from millrace.queries.loading import FIELDS
    from millrace.streaming import feeds

    base = work_folder(spark, "sweep-test")
    at = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

    def batch(text):
        rows = staging.shred_payload(spark.createDataFrame([(1, text)], "k int, p string"), "p", FIELDS)
        return staging.stage_records(rows, ["k", "item_no"], at)

    empty = staging.sync_nightly(
        spark.createDataFrame([], "integration_id string, first_name string, last_name string, birthdate date, sex int, created_at timestamp_ntz, created_by string, updated_at timestamp_ntz, updated_by string"),
        staging.settle(batch('[{"id":"a","first_name":"A"},{"id":"b","first_name":"B"}]')), at, "OLD",
    )
    handle = feeds.sweep_queue(base, empty, "SYNC", at)
    handle(batch('[{"id":"b","first_name":"B1"},{"id":"c","first_name":"C1"},{"first_name":"lone"}]'), 0)
    handle(batch('[{"id":"c","first_name":"C2"},{"id":"d","first_name":"D2"},{"first_name":"lone"}]'), 1)
    handle(batch('[{"id":"c","first_name":"C2"},{"id":"d","first_name":"D2"},{"first_name":"lone"}]'), 1)  # run again
    got = sorted(((r["integration_id"] or "", r["first_name"], r["created_by"]) for r in feeds.nightly_table(spark, base, empty).collect()))
    assert got == [("", "lone", "SYNC"), ("", "lone", "SYNC"), ("a", "A", "OLD"), ("b", "B1", "OLD"), ("c", "C2", "SYNC"), ("d", "D2", "SYNC")]
    state = feeds.BucketState(spark, base, "nightly", ["integration_id"])
    before, after = ({tuple(r) for r in state.all(batch).collect()} for batch in (1, 2))
    named = empty.columns.index("integration_id")
    assert {r[named] for r in before ^ after} == {"c", "d"}


def test_a_second_start_is_ignored_while_the_first_runs(spark):
    from millrace.streaming import feeds

    base = work_folder(spark, "busy")
    spark.range(3).write.parquet(f"{base}/in")
    seen = []

    def handle(rows, _):
        stream = spark.readStream.schema("id long").parquet(f"{base}/in")
        seen.append(feeds.run_available(stream, f"{base}/checkpoint", handle))

    stream = spark.readStream.schema("id long").parquet(f"{base}/in")
    assert feeds.run_available(stream, f"{base}/checkpoint", handle) is True
    assert seen == [False]
