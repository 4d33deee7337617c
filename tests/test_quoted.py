"""Delimited text in blocks, exact numbers and documents of any shape, against plain Python."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from millrace.functions import jsondoc, jsonrows
from millrace.operators import clean, joins, numbering
from millrace.session import work_folder
from millrace.sources import delimited, files, quoted


@pytest.fixture
def small_blocks(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")
    before = {n: spark.conf.get(n, None) for n in names}
    for name, value in zip(names, ("700", "0", "1"), strict=True):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def put(spark, base, name, text):
    """One file of the given text, written by the file system that Spark uses."""
    from millrace.sources import storage

    storage.write_text(spark, f"{base}/{name}", text)


def cells(rng):
    return [
        str(rng.randrange(10**6)),
        rng.choice(["plain", "with, comma", 'say "hi"', "two\nlines", "\n\n\n", 'a "quoted\n""line', "x" * 300, "é\r\nü", "y\n" * 400]),
        rng.choice(["", "end"]),
    ]


def written(rows, line_end):
    out = io.StringIO(newline="")
    csv.writer(out, lineterminator=line_end).writerows(rows)
    return out.getvalue()


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_many_blocks_of_one_file(spark, small_blocks, line_end):
    """Quoted line ends lie across block borders; some cells are longer than a block."""
    rng = random.Random(len(line_end))
    rows = [cells(rng) for _ in range(250)]
    base = work_folder(spark, "quoted")
    put(spark, base, "a.csv", written([["id", "text", "last"], *rows], line_end))
    found = quoted.records(spark, f"{base}/a.csv")
    assert found.select("start").distinct().count() > 20 and found.count() == len(rows) + 1
    assert spark.read.text(f"{base}/a.csv").rdd.getNumPartitions() > 20  # many tasks for one file
    got = delimited.read_rows(spark, f"{base}/a.csv", delimited.T.StructType.fromDDL("id string, text string, last string")).collect()
    want = sorted((i, text, last or None) for i, text, last in rows)
    assert sorted(tuple(r) for r in got) == want


def test_files_with_their_own_headers(spark, small_blocks):
    base = work_folder(spark, "folder")
    put(spark, base, "a.csv", 'id,"two\nlines"\n1,"x\ny"\n')
    put(spark, base, "b.csv", 'id,other\n2,z\n\n3,"open\nto the end')
    put(spark, base, "c.csv", 'id,"two\nlines"\n4,w')
    put(spark, base, "empty.csv", "")
    put(spark, base, "note.txt", "id\n9\n")
    heads = {r["header"]: len(r["files"]) for r in delimited.headers(spark, base, "*.csv").collect()}
    assert heads == {'id,"two\nlines"': 2, "id,other": 1}
    got = {r["id"]: (r["two\nlines"], r["other"]) for r in delimited.load_all_csvs(spark, base).collect()}
    assert got == {"1": ("x\ny", None), "2": (None, "z"), "3": (None, "open\nto the end"), "4": ("w", None)}
    typed = files.read_fast(spark, f"{base}/c.csv", "id bigint, text string").collect()
    assert [tuple(r) for r in typed] == [(4, "w")]


def test_states_by_a_join_when_there_are_very_many(spark, small_blocks, monkeypatch):
    monkeypatch.setattr(quoted, "SENT_BLOCKS", 3)
    rng = random.Random(9)
    rows = [cells(rng) for _ in range(200)]
    base = work_folder(spark, "joined")
    put(spark, base, "a.csv", written(rows, "\n"))
    put(spark, base, "b.csv", written(rows[::-1], "\n"))
    got = delimited.read_rows(spark, base, delimited.T.StructType.fromDDL("id string, text string, last string"), header=False)
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, text, last or None) for i, text, last in rows * 2)


def test_merge_patch_reports_what_it_refuses(spark):
    rows = [('{"a":1}', '{"a":'), ("[1", "{}"), (None, "{}"), ('{"a":1}', "NaN"), ("[" * 100_000, "{}"), ('{"a":{"b":1.50}}', '{"a":{"c":[]}}')]
    frame = spark.createDataFrame(rows, "d string, p string")
    got = frame.select(jsondoc.merge_patch_checked(F.col("d"), F.col("p")).alias("m")).select("m.*").collect()
    assert [r["result"] for r in got] == [None, None, None, None, None, '{"a":{"b":1.50,"c":[]}}']
    assert [(r["error"] or "").split(":")[0] for r in got] == ["patch", "document", "", "patch", "document", ""]


def plain_descendants(value, name, path=()):
    out = []
    entries = sorted(value.items()) if isinstance(value, dict) else enumerate(value) if isinstance(value, list) else []
    for key, child in entries:
        if key == name:
            out.append(json.dumps(child, separators=(",", ":")))
        out += plain_descendants(child, name)
    return out


def test_descendants_of_random_documents(spark):
    rng = random.Random(4)

    def made(depth):
        if depth == 0 or rng.random() < 0.2:
            return rng.choice([1, "s", None, True])
        if rng.random() < 0.5:
            return {k: made(depth - 1) for k in rng.sample("abz", rng.randrange(4))}
        return [made(depth - 1) for _ in range(rng.randrange(13))]

    docs = [made(7) for _ in range(40)] + [None]
    frame = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "i int, t string").withColumn("d", F.try_parse_json("t"))
    got = {r["i"]: r["found"] for r in jsondoc.deep_descendants(frame, "d", "z").collect()}
    assert got == {i: sorted_members(d) for i, d in enumerate(docs)}


def sorted_members(doc):
    def ordered(v):
        if isinstance(v, dict):
            return {k: ordered(v[k]) for k in sorted(v)}
        return [ordered(x) for x in v] if isinstance(v, list) else v

    return plain_descendants(ordered(doc), "z")


def test_json_rows_from_sql(spark):
    docs = [(1, '{"items":[{"sku":"a","n":2,"when":"2024-02-03T00:00"},{"sku":7,"n":"x"}]}'), (2, '{"items":{"sku":"one"}}'), (3, "{broken"), (4, None), (5, '{"items":[]}')]
    jsonrows.register(spark)
    frame = spark.createDataFrame(docs, "k int, doc string")
    got = spark.sql("SELECT * FROM json_rows(TABLE({t}), '$.items[*]', 'sku string, n bigint, day date when') ORDER BY k, element_no", t=frame).collect()
    assert [(r["k"], r["element_no"], r["sku"], r["n"], str(r["day"])) for r in got] == [
        (1, 1, "a", 2, "2024-02-03"), (1, 2, "7", None, "None"), (2, 1, "one", None, "None"),
        (3, None, None, None, "None"), (4, None, None, None, "None"), (5, None, None, None, "None"),
    ]
    with pytest.raises(Exception, match="none of"):
        spark.sql("SELECT * FROM json_rows(TABLE({t}), '$', 'x money')", t=frame).collect()


def test_previous_row_over_partitions_and_without_a_second_sort(spark):
    frame = spark.range(1000).select(F.col("id"), F.when(F.col("id") % 7 != 0, F.concat(F.lit("v"), "id")).alias("v"), F.timestamp_micros(F.col("id") * 1_000_003).alias("ts"))
    numbered = numbering.number_rows(frame.repartition(9), ["id"], "n", 0)
    kept = numbered.where("id % 5 > 0 AND (id < 200 OR id > 700)")
    got = numbering.with_previous(kept, ["id"], {"id": "p", "v": "pv", "ts": "pts"}, placed=True).collect()
    rows = sorted((tuple(r[c] for c in ("id", "v", "ts")) for r in kept.collect()))
    before = {r[0]: b for r, b in zip(rows, [(None, None, None), *rows], strict=False)}
    assert {r["id"]: (r["p"], r["pv"], r["pts"]) for r in got} == before
    again = numbering.number_rows(kept, ["id"], "m", 1, placed=True).collect()
    assert {r["id"]: r["m"] for r in again} == {r[0]: m for m, r in enumerate(rows, 1)}
    assert numbering.with_previous(frame.limit(0), ["id"], {"id": "p"}).count() == 0


def test_counts_come_with_the_merge(spark):
    left, right = spark.range(10).withColumnRenamed("id", "k"), spark.range(5, 30).withColumnRenamed("id", "k")
    merged, report = joins.observed_merge(left, right, ["k"], "outer")
    assert merged.count() == 30 and report() == {"rows_before": 10, "rows_after": 30, "change": 20}


def test_numbers_that_a_double_would_change(spark):
    texts = ["9007199254740993", "9007199254740992", "1e3", "-5", "1.5", "1,000", "x", None, "123456789012345678901234567890"]
    frame = spark.createDataFrame([(t, t, t) for t in texts], "a string, b string, c string")
    got = clean.normalise_cells(frame, {"a": "number", "b": "whole", "c": "text"}).collect()
    assert [r["a"] for r in got] == [None, 9007199254740992.0, 1000.0, -5.0, 1.5, 1000.0, None, None, None]
    assert [None if r["b"] is None else str(r["b"]) for r in got] == ["9007199254740993", "9007199254740992", None, "-5", None, "1000", None, None, texts[-1]]
    cast = clean.cast_record(frame.select("a"), {"a": "long"}).collect()
    assert [(r["a"], r["cast_failures"]) for r in cast][:5] == [(9007199254740993, 0), (9007199254740992, 0), (1000, 0), (-5, 0), (None, 1)]
