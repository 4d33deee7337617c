import zlib

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import neighbours

LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    scored = neighbours.score(table, neighbours.fit(table, labels, per_label=400))
    rows = scored.join(labels, "doc_id").where("held_out").select("quality", "predicted").collect()
    assert sum(r["quality"] == r["predicted"] for r in rows) / len(rows) > 0.99
    assert scored.count() == table.count() and scored.where("score < 0 or score > 1 or isnan(score)").count() == 0


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark, docs):
    good, bad = "Plain words in a line of text. ", "BUY!! NOW!! "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 7), f"s{i % 2}") for i in range(200)]
    table = docs(rows).withColumn("label", F.lit("x")).withColumn("labelled_id", F.lit(1))
    right = [(i, i % 2, 0) for i in range(200)]
    wrong = [(i, (i + 1) % 2 if zlib.crc32(str(i).encode()) % 3 == 1 else i % 2, 0) for i in range(200)]
    wrong += [(None, 1, 0), (5000, 0, 0), (3, None, 1)]
    a = neighbours.score(table, neighbours.fit(table, spark.createDataFrame(right, LABELS))).collect()
    b = neighbours.score(table.withColumn("source", F.lit(None)), neighbours.fit(table, spark.createDataFrame(wrong, LABELS))).collect()
    assert {r["doc_id"]: r["predicted"] for r in a} == {r["doc_id"]: r["predicted"] for r in b} == {i: i % 2 for i in range(200)}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in a)


def test_odd_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \n "), (None, "a"), (4, "x" * 3_000_000), (5, "ab"), (5, "ab")]
    table = docs(rows).withColumn("score", F.lit("s"))
    none = neighbours.fit(table, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in neighbours.score(table, none).collect()} == {0.5}
    one = neighbours.fit(table, spark.createDataFrame([(5, 1, 0), (4, 1, 0), (3, 0, 0)], LABELS))
    assert neighbours.score(table, one).count() == len(rows)
    assert neighbours.score(table.limit(0), one).count() == 0
    kept = neighbours.accepted(table, one)
    assert kept.columns == table.columns and kept.schema == table.schema and kept.count() <= len(rows)


def test_votes_against_brute_force():
    """The nearest labelled vectors by plain sorting, ties to the first, weighted by a power of their similarity."""
    rng = np.random.default_rng(5)
    rows = np.abs(rng.standard_normal((60, neighbours.FEATURES)).astype(np.float32))
    rows[10:30] = rows[40:60]  # equal vectors
    labels = rng.integers(0, 2, 60)
    model = neighbours.train(rows, labels, 0.3)
    asked = np.vstack((rows[:20] + 0.1 * np.abs(rng.standard_normal((20, neighbours.FEATURES)).astype(np.float32)), np.zeros((1, neighbours.FEATURES), np.float32)))
    close = model.project(asked) @ model.vectors.T
    want = []
    for row in close:
        best = sorted(range(60), key=lambda k: (-row[k], k))[: neighbours.VOTERS]
        power = [max(float(row[k]), 0.0) ** neighbours.POWER for k in best]
        want.append(sum(p * labels[k] for p, k in zip(power, best, strict=True)) / sum(power) if sum(power) else 0.3)
    assert np.allclose(model.vote(asked), want, atol=1e-5)
    tied = np.array([[1.0, 2.0, 2.0, 2.0, 0.0], [3.0, 3.0, 3.0, 3.0, 3.0]], np.float32)
    assert [set(r) for r in neighbours._nearest(tied, 2).tolist()] == [{1, 2}, {0, 1}]


def test_one_row_of_each_sampled_id(spark, docs):
    rows = [(3, f"{k} words of one id that many rows share") for k in range(400)] + [(i, "plain " * (i % 9)) for i in range(10, 60)]
    labels = spark.createDataFrame([(3, 1, 0), *[(i, i % 2, 0) for i in range(10, 60)]], LABELS)
    model = neighbours.fit(docs(rows), labels, per_label=20)
    assert len(model.labels) <= 40
