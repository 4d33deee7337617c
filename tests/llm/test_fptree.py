import math
import random
import re
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from millrace.llm import fptree

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute(docs, items, k=50):
    held = [(i, TERM.findall((t or "").translate(LOWER))) for i, t in docs]
    held = [(i, Counter(w), len(w)) for i, w in held if w]
    n_docs, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    smallest = {}
    for item, text in items:
        if item is not None and text is not None:
            smallest[item] = min(smallest.get(item, text), text)
    out = []
    for item, text in smallest.items():
        scores = []
        for i, c, n in held:
            m = 100 - 50 + 50 * n * n_docs // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(TERM.findall(text.translate(LOWER)))
                if t in c
            )
            if score > 0 and i is not None:
                scores.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def found(docs, items, k=50):
    return sorted(map(tuple, fptree.rank(docs, items, k).collect()))


def corpus(n, seed=1):
    rng = random.Random(seed)
    common, rare = [f"w{k}" for k in range(40)], [f"Ré{k}" for k in range(400)]
    docs = [
        (i, " ".join(rng.choices(common, k=rng.randrange(1, 60)) + rng.choices(rare, k=rng.randrange(8))) + rng.choice([".", "-x", "!"]))
        for i in range(n)
    ]
    docs += [(n + i, docs[i % 5][1]) for i in range(n // 4)]  # copies: ties
    items = [(i, " ".join(rng.choices(common, k=5) + rng.choices(rare, k=4))) for i in range(25)]
    return docs, items


def test_against_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(fptree, "DOCUMENTS", 64)
    monkeypatch.setattr(fptree, "ITEM_BYTES", 600)  # several blocks of items
    rows, items = corpus(900)
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert found(docs(rows), asked, 7) == brute(rows, items, 7)


def test_odd_rows(spark, docs):
    rows = [(5, "Alpha beta"), (3, "alpha BETA"), (3, "alpha BETA"), (7, None), (8, ""), (9, " .,;"), (None, "alpha gamma"),
            (10, "größe Ä ä alpha1 1"), (11, "  x" * 3), (12, "beta " * 200_000)]
    items = [(1, "alpha beta"), (2, None), (3, ""), (None, "alpha"), (4, "nothing here"), (5, "größe Ä 1  "), (6, "beta"), (6, "alpha")]
    clash = docs(rows).withColumn("score", F.lit(1)).withColumn("terms", F.lit("x")).withColumn("n", F.lit(1)).withColumn("item_id", F.lit(3))
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1)).withColumn("rank", F.lit(1))
    assert found(clash, asked) == brute(rows, items)
    assert found(clash.limit(0), asked) == [] and found(clash, asked.limit(0)) == []
    assert found(docs([(1, None), (2, "")]), asked) == []


def test_bounds_hold_and_prune():
    """No document beats the bound of a node above it, and a search leaves subtrees out."""
    rng = np.random.default_rng(4)
    size, rows = 60, []
    for row in range(700):
        held = np.unique(np.minimum(rng.geometric(0.08, 15) - 1, size - 1))
        rows += [(row, t, int(rng.integers(1, 9))) for t in held]
    row_of, terms, counts = (np.array(c) for c in zip(*rows, strict=True))
    tree = fptree.Tree(np.arange(700), rng.integers(60, 400, 700), row_of, terms, counts, size)
    assert (tree.hi - tree.lo)[tree.leaves].sum() == 700
    item = fptree.Item(1, np.array([2, 11, 17, 30]), np.array([50, 900, 2000, 3000]), 10)
    scores = item.value(tree.rows[:, item.terms], tree.m)
    for node in range(len(tree.lo)):
        bound = item.value(tree.most[node : node + 1, item.terms], tree.least[node : node + 1])[0]
        assert scores[tree.lo[node] : tree.hi[node]].max() <= bound
    looked = []
    offer = item.offer
    item.offer = lambda s, i: (looked.append(len(i)), offer(s, i))
    tree.search(item)
    best = sorted(zip(-scores, tree.ids, strict=True))[:10]
    assert list(zip(-item.scores, item.ids, strict=True)) == best
    assert sum(looked) < 700
