from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), epochs=3):
    order = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        open_ = sum(weight[s] for s in order if s not in full)
        level = left / open_ if open_ else 0.0
        more = {s for s in order if s not in full and epochs * sizes[s] < level * weight[s]}
        if not more:
            return {s: epochs * sizes[s] if s in full else level * weight[s] for s in order}
        full |= more


def check(table):
    rows = mixing.mix(table).collect()
    texts = defaultdict(list)
    for r in table.collect():
        texts[r["doc_id"]].append(len((r["text"] or "").encode().split()))
    by_source = defaultdict(int)
    source_of = {r["doc_id"]: r["source"] for r in table.collect()}
    for r in rows:
        by_source[source_of[r["doc_id"]]] += r["size"]
    want = brute_targets(by_source)
    taken, largest = defaultdict(int), defaultdict(int)
    for r in rows:
        s = source_of[r["doc_id"]]
        assert r["size"] in texts[r["doc_id"]] and r["source_size"] == by_source[s]
        assert r["target"] == pytest.approx(want[s]) and 0 <= r["taken"] <= 3 * r["size"]
        assert not r["size"] or r["taken"] % r["size"] == 0
        taken[s] += r["taken"]
        largest[s] = max(largest[s], r["size"])
    for s in by_source:
        assert abs(taken[s] - want[s]) <= largest[s] + 1e-6, s
    assert len(rows) == table.count()
    again = mixing.mix(table).collect()
    assert sorted(map(str, rows)) == sorted(map(str, again))
    return rows


def test_targets_and_shares(docs):
    rows = [(i, "w " * (i % 17), ["a", "b", "c", "Z", "é", None][i % 6]) for i in range(900)]
    rows += [(2000 + i, "hot word " * 9, "hot") for i in range(600)]
    rows += [(5000, "one two", "tiny"), (5001, None, "empty"), (5002, "", "empty"), (5003, "x\x0by\x1fz\xa0q", "tiny")]
    check(docs(rows))


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_empty_null_and_repeated(docs):
    assert mixing.mix(docs([(1, "a", "s")]).limit(0)).collect() == []
    only = mixing.mix(docs([(None, None, None), (None, "a b", None), (1, "", "s")])).collect()
    assert len(only) == 3 and {r["size"] for r in only} == {0, 2}
    assert mixing.repeated(docs([(1, None, "s")])).count() == 0


def test_repeated_rows_keep_columns(docs):
    rows = [(i, "w " * (1 + i % 5), f"s{i % 3}") for i in range(300)]
    table = docs(rows).withColumn("times", F.lit(7)).withColumn("key", F.lit("k"))
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(table).collect()}
    got = mixing.repeated(table)
    assert got.columns == table.columns
    counts = {r["doc_id"]: r["count"] for r in got.groupBy("doc_id").count().collect()}
    assert counts == {k: v for k, v in taken.items() if v}


def test_repeated_rows_meet_the_target(docs):
    """A group of equal rows holds most of its source; as many of them are taken as the target needs."""
    rows = [(7, "same text here now", "hot")] * 900 + [(10 + i, "w " * (1 + i % 5), "hot") for i in range(50)]
    rows += [(2000 + i, "v " * 8, "other") for i in range(700)] + [(9000, "x y z", "third")] * 40
    table = docs(rows)
    got = check(table)
    assert len({r["taken"] for r in got if r["doc_id"] == 7}) == 2  # some once more than others
    counts = mixing.repeated(table).groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()
    sizes = defaultdict(int)
    for r in got:
        sizes[r["target"], r["source_size"]] += r["taken"]
    assert sorted(r["n"] for r in counts) == sorted(sizes.values())
