import math

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import caps

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, least=0.93):
    n = len(rows)
    able = [r[2] is not None and bool(r[1]) and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1]) for r in rows]
    label, links = list(range(n)), [0] * n
    units = [np.array(r[1], np.float64) / np.linalg.norm(np.array(r[1], np.float64)) if ok else None for r, ok in zip(rows, able, strict=True)]

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(n):
        for j in range(i):
            if able[i] and able[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                if units[i] @ units[j] >= least or rows[i][1] == rows[j][1]:
                    links[i] += 1
                    links[j] += 1
                    label[top(i)] = top(j)
    least_of = {}
    for i in range(n):
        least_of.setdefault(top(i), []).append(rows[i][0])
    return sorted((str(r[0]), links[i], min(x for x in least_of[top(i)] if x is not None) if any(x is not None for x in least_of[top(i)]) else None) for i, r in enumerate(rows))


def found(table):
    return sorted((str(r["vec_id"]), r["n_links"], r["component_id"]) for r in caps.near_vectors(table).collect())


def cloud(seed, dim, n, groups):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups, dim))
    at = rng.integers(0, groups, n)
    return (centres[at] + rng.standard_normal((n, dim)) * rng.choice([0.1, 0.22, 0.3, 1.0], n)[:, None]).astype(np.float32)


def test_clouds_against_all_pairs(spark):
    v = cloud(1, 64, 700, 60)
    rows = [(i, [float(x) for x in v[i]], [0, 0, 0, 1, None][i % 5]) for i in range(700)]
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(40)]
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(4)) == brute(rows)


def test_blocks_of_large_filters(spark, monkeypatch):
    monkeypatch.setattr(caps, "BLOCK", 20)
    v = cloud(2, 20, 300, 4)
    rows = [(i, [float(x) for x in v[i]], 0) for i in range(300)]
    assert found(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, 0.0], 0), (4, [nan, 1.0], 0), (5, [None, 1.0], 0), (6, [inf, 1.0], 0), (7, [1.0, 1.0], None),
            (8, [1.0, 1.0], 0), (9, [2.0, 2.0], 0), (8, [1.0, 1.0], 0), (None, [3.0, 3.0], 0), (10, [-1.0, -1.0], 0), (11, [1.0, 1.0, 0.0], 0),
            (12, [1e38, 1e38], 0), (13, [1e-38, 1e-38], 0), (14, [-0.0, 1.0], 0), (15, [0.0, 1.0], 0), (16, [1.0, 1.0], 1), (8, [0.0, 1.0], 0), (None, [5.0, -4.0], 2)]
    table = spark.createDataFrame(rows, SCHEMA).withColumn("node", F.lit("x")).withColumn("v", F.lit(1))
    got = found(table)
    want = brute([(i, [x + 0.0 if x is not None else x for x in v] if v else v, k) for i, v, k in rows])
    assert [g for g in got if g[0] != "8"] == [w for w in want if w[0] != "8"] and len(got) == len(want)
    assert caps.near_vectors(table.limit(0)).count() == 0
    kept = {(str(r["vec_id"]), r["kept"]) for r in caps.near_vectors(table).collect()}
    assert ("9", False) in kept and ("10", True) in kept and ("1", True) in kept


def test_recall_of_the_filters_alone():
    rng = np.random.default_rng(9)
    a = rng.standard_normal((3000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((3000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    for words in (16, 75, 1000):
        code = caps.Codes(64, words)
        near = code.decode(0.93 * a + math.sqrt(1 - 0.93**2) * b)
        own = code.decode(a)
        lost = sum(not np.intersect1d(x, y).size for x, y in zip(own, near, strict=True))
        print(words, lost, np.mean([len(x) for x in own]))
        assert lost <= 3
