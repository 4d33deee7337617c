import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, k=10):
    whole = []
    for i, v, _ in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v):
            continue
        whole.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    asked = {}
    for i, v in whole:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = set()
    for q, v in asked.items():
        cut = lambda x: max(-(2**63), min(2**63 - 1, x))
        scores = sorted((-cut(sum(a * b for a, b in zip(v, w, strict=True))), i) for i, w in whole if i != q and len(w) == len(v))
        out |= {(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)}
    return out


def found(table, k=10):
    rows = topk.top_k(table, F.col("vec_id") % 100 == 0, k).collect()
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in rows}


def test_random_vectors_with_ties(spark, monkeypatch):
    monkeypatch.setattr(topk, "CANDIDATES", 64)
    monkeypatch.setattr(topk, "QUERIES", 4)
    monkeypatch.setattr(topk, "HELD", 2)
    rng = np.random.default_rng(2)
    base = rng.standard_normal((40, 50))
    rows = [(i, [float(np.float32(x)) for x in base[i % 40] * (1 + i % 3)], i % 3) for i in range(1500)]
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(table) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, -2.0], 1), (100, None, 1), (200, [], 1), (300, [nan, 1.0], 1), (1, [None, 1.0], 1), (2, [inf, 1.0], 1), (3, [1e30, 1e30], 1),
            (4, [-1e30, 1e30], None), (5, [0.5, 0.25], 1), (5, [0.5, 0.25], 1), (400, [1e30, 3.0], 1), (None, [1.0, 1.0], 1), (6, [1.0, 2.0, 3.0], 1),
            (500, [1.0, 1.0, 1.0], 2), (600, [0.0, 0.0], 1), (7, [-0.0001, 0.0001], 1), (0, [1.0, -2.0], 1), (-100, [2.0, 2.0], 1)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("dim", F.lit("x")).withColumn("score", F.lit(1))
    want = brute(rows)
    got = found(table)
    assert len(topk.top_k(table, F.col("vec_id") % 100 == 0).collect()) == len(got)
    assert got == want
    assert topk.top_k(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(table.where("vec_id % 100 != 0"), F.col("vec_id") % 100 == 0).count() == 0


@pytest.mark.parametrize("n", [3, 11])
def test_fewer_candidates_than_asked_for(spark, n):
    rows = [(100 * i, [float(i), 1.0], 0) for i in range(n)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
