"""Work that grows with the tables: dealt out, bounded in a task, without a cost for each row that repeats."""

import decimal
import json
import re

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from millrace.functions import jsondoc as js
from millrace.functions import jsonrows, text
from millrace.plans import staging
from millrace.queries import REGISTRY, loading, streams
from millrace.queries.registry import Tables
from millrace.session import spread, work_folder
from millrace.sources import delimited, files
from millrace.streaming import bursts, edges, feeds

SMALL = "/root/testdata/sf0.001"


def test_long_quoted_fields_are_dealt_out(spark):
    """One row group of long texts is not parsed by one task."""
    rows = REGISTRY["csv_long_field"].run(spark, SMALL)
    tasks = rows.select(F.spark_partition_id().alias("task")).distinct().count()
    assert tasks > 1
    frame = spark.createDataFrame([(1, 'a,b,c\n"x""y"z,p""q,""\n"",",\n","u""')], "k int, text string")
    got = [(r["a"], r["b"], r["c"]) for r in delimited.parse_csv_column(frame, "text", ["a", "b", "c"]).orderBy("record_no").collect()]
    assert got == [('x"y', 'p""q', ""), ("", ",\n", 'u"')]


def test_spread_deals_out_a_file_of_one_row_group(spark, tmp_path):
    """A file has many splits, but its rows lie in one of them."""
    pq.write_table(pa.table({"k": np.arange(900_000), "x": np.random.default_rng(1).random(900_000)}), tmp_path / "t.parquet", row_group_size=1 << 20)
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(1 << 19))
    try:
        table = spark.read.parquet(str(tmp_path / "t.parquet"))
        assert table.rdd.getNumPartitions() >= 8
        dealt = spread(table).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set(setting, before)
    assert len(dealt) >= 8 and sum(r["count"] for r in dealt) == 900_000 and max(r["count"] for r in dealt) <= 150_000


def test_json_value_of_text_as_whole_number(spark):
    """Text that is no number is null or the default, text that is one converts; no exception is made for each row."""
    texts = ["Customer 5", " 7", "-3", "+4", " 7", "1.5", "", "x"]
    docs = spark.createDataFrame([(i, json.dumps({"a": s})) for i, s in enumerate(texts)], "i int, doc string")
    docs = docs.select("i", F.parse_json("doc").alias("v")).cache()
    value = js.json_value(F.col("v"), "$.a", "bigint", default_on_error=-1)
    got = [r["n"] for r in docs.orderBy("i").select(value.alias("n")).collect()]
    plain = [r["n"] for r in docs.orderBy("i").select(F.coalesce(F.try_variant_get("v", "$.a", "bigint"), F.lit(-1)).alias("n")).collect()]
    assert got == plain and got[:4] == [-1, 7, -3, 4]
    assert "[-+.0-9]" in str(value)


def test_debounce_stream_of_many_keys(spark):
    """Bursts are made in the JVM: no Python call for each key; rows that lie the quiet time apart are one burst."""
    base = work_folder(spark, "debounce-growth")
    times = F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id").cast("bigint") * 1_000_000 * F.when(F.col("id") % 4 == 3, 30).otherwise(1))
    frame = spark.range(4_000).select("id", (F.col("id") % 500).alias("k"), times.alias("ts"))
    exact = spark.createDataFrame([(10_000 + i, -1, 1_700_000_000_000_000 + u) for i, u in enumerate([0, 30_000_000, 60_000_001, 90_000_001])], "id bigint, k bigint, us bigint")
    frame = frame.unionByName(exact.select("id", "k", F.timestamp_micros("us").alias("ts")))
    frame.coalesce(1).write.parquet(f"{base}/in")
    bursts.closing_row(spark.read.parquet(f"{base}/in"), "ts", 30, 10).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema(frame.schema).parquet(f"{base}/in")
    feeds.debounce_stream(stream, "k", "ts", 30, "10 seconds", f"{base}/out", f"{base}/checkpoint", "id")
    got = [r["id"] for r in spark.read.schema(frame.schema).parquet(f"{base}/out").collect()]
    wanted = [r["id"] for r in edges.debounce(frame, "k", "ts", 30, "id").collect()]
    assert sorted(got) == sorted(wanted) and {10_001, 10_003} <= set(got) and 10_000 not in got


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_ledger_amounts_are_written_once(spark):
    """Whether an amount is one is seen from its number; only kept rows write it as text."""
    filters = [line for line in plan_of(REGISTRY["ledger_parse"].run(spark, SMALL)).splitlines() if "Filter" in line]
    assert filters and not any("format_number" in line for line in filters)


def test_folders_are_written_without_a_sort(spark):
    """One file for each value, and the session's setting is as before."""
    path = work_folder(spark, "folders")
    setting = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(setting, None)
    rows = spark.range(30_000).select(F.concat(F.lit("f"), F.col("id") % 5).alias("folder"), F.col("id").cast("string").alias("value"))
    files.write_folders(rows, path, "folder")
    assert spark.conf.get(setting, None) == before
    assert spark.read.text(path).groupBy("folder").count().where("count = 6000").count() == 5
    assert files.read_files_as_rows(spark, path, "*.txt", larger_than=0).count() == 5


def test_slug_sends_only_other_than_ascii(spark):
    """Texts of ASCII characters alone do not go to Python; compatibility forms come out as before."""
    import unicodedata

    texts = ["plain Text", "", None, "½ ﬁne ① ㎥", "Ångström café", "가  x", "𝐀".encode("utf-16", "surrogatepass").decode("utf-16")]
    frame = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    slugs = frame.select("i", text.url_slug(F.col("v")).alias("slug"))
    assert "octet_length" in plan_of(slugs)
    for row in slugs.collect():
        v = texts[row["i"]]
        folded = None if v is None else unicodedata.normalize("NFKD", v).encode("ascii", "ignore").decode().lower()
        wanted = None if v is None else re.sub(r"[-\s]+", "-", re.sub(r"[^\w\s-]", "", folded)).strip("-")
        assert row["slug"] == wanted


def test_json_rows_in_one_pass(spark):
    """Rows are taken as they lie, without a shuffle by key, and short ways give what the long ones give."""
    plan = REGISTRY["json_rows_function"].run(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    after_join = plan[: plan.index("Join")]
    assert "Sort" not in after_join and "Exchange" not in after_join
    docs = [{"a": {"b": 1}}, {"a": [{"b": 2}, {"b": 3}]}, {"a": 5}, [{"a": {"b": [7, 8]}}], {"a": {"b": None}}, 4, {}]
    for doc in docs:
        for path in (["a"], ["a", "b"], ["a", "[*]", "b"], []):
            assert jsonrows.first_element(doc, path) == next(iter(jsonrows.elements(doc, path)), None)
    assert jsonrows.convert(2**63, "bigint") is None and jsonrows.convert(2**63 - 1, "bigint") == 2**63 - 1
    assert jsonrows.convert(3, "double") == 3.0 and jsonrows.convert(decimal.Decimal("1.50"), "double") == 1.5
    assert jsonrows.convert(True, "bigint") is None and jsonrows.convert(decimal.Decimal("2.5"), "bigint") is None


def test_payloads_are_dealt_out_and_parsed_once(spark):
    """No single task writes or parses all payloads, and no column of the shredded rows parses a payload again."""
    payloads = loading.payloads(Tables(spark, SMALL))
    assert payloads.select(F.spark_partition_id().alias("task")).distinct().count() > 1
    plan = plan_of(staging.shred_payload(payloads, "payload", loading.FIELDS))
    assert plan.count("StructsToJsonEvaluator") == plan.count("from_json") == 1


def test_staged_payloads_keep_the_order(spark):
    """Payloads sorted as text give the ids and rows that sorting the shredded rows gives."""
    texts = ["[{\"id\": \"a\", \"sex\": \"1\"}, {\"id\": \"b\", \"sex\": \"x\"}]", "[]", None, "[{\"id\"", "[null, {\"id\": \"c\"}]"]
    frame = spark.createDataFrame([((i * 37) % 100, texts[i % 5]) for i in range(100)], "k int, p string").repartition(7)
    fields, at = {"id": "string", "sex": "int"}, loading.at()
    got = staging.stage_payloads(frame, "p", fields, ["k"], at)
    wanted = staging.stage_records(staging.shred_payload(frame, "p", fields), ["k", "item_no"], at)
    assert sorted(map(str, got.collect())) == sorted(map(str, wanted.select(got.columns).collect()))
    assert [r["stage_order"] for r in got.orderBy("k", "item_no").collect()] == list(range(100))


def parses_under(monkeypatch, run):
    """Optimized plans, of those that ``run`` has kept by staging, that parse payloads."""
    plans, keep = [], staging.cut_lineage
    monkeypatch.setattr(staging, "cut_lineage", lambda df: plans.append(plan_of(df)) or keep(df))
    run()
    return [p for p in plans if "from_json" in p]


def test_sweeper_parses_after_the_sort(spark, monkeypatch):
    """The sweeper's rows come from sorted payloads; the shredded rows are not sorted."""
    plans = parses_under(monkeypatch, lambda: streams.staged(Tables(spark, SMALL)))
    assert len(plans) == 1 and plans[0].index("from_json") < plans[0].index("Sort")


def test_address_merge_parses_once_for_links_and_rows(spark, monkeypatch):
    """Links and addresses come from the same staged rows, parsed once after the sort of the payloads."""
    plans = parses_under(monkeypatch, lambda: REGISTRY["merge_address"].run(spark, SMALL))
    assert len(plans) == 1 and plans[0].index("from_json") < plans[0].index("Sort")


def test_sorted_payloads_are_written_once(spark):
    """Customers are dealt out by ranges of their key, so the sort moves no payload and does not write all of them for its sample."""
    payloads = loading.payloads(Tables(spark, SMALL))
    plan = payloads.orderBy("c_custkey")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.index("StructsToJson") < plan.index("Exchange rangepartitioning")
    assert [r["c_custkey"] for r in payloads.orderBy("c_custkey").collect()] == sorted(r["c_custkey"] for r in Tables(spark, SMALL).customer.collect())
