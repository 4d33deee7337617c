import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from millrace.llm import merkle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(text):
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def brute(rows):
    """The manifest by the definition: sort, hash runs of eight, walk up."""
    trees = {}
    for row in rows:
        doc_id, text = row[0], row[1]
        changed = text
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0 and text is not None:
            changed = text.translate({k: k + 32 for k in range(65, 91)})
        trees.setdefault(row[2], []).append((doc_id is not None, doc_id or 0, leaf(row, text), leaf(row, changed), doc_id))
    tops, kept = [], []
    for lang in sorted(trees, key=lambda x: (x is not None, (x or "").encode())):
        level = sorted(trees[lang])
        ways = [[t[4], t[2], t[3], "", k] for k, t in enumerate(level)]
        top = climb([t[2] for t in level], ways)
        for way in ways:
            way[4] = len(tops)
            way.append(top)
        tops.append(top)
        kept += ways
    root = climb(tops, kept)
    return sorted((w[0] is not None, w[0] or 0, w[1], w[5], root, h(w[3]), w[2], w[2] == root) for w in kept)


def climb(level, ways):
    """Hash level by level; each way has its folded digest (2), siblings (3) and place (4)."""
    while len(level) > 1:
        for way in ways:
            start, slot = way[4] - way[4] % 8, way[4] % 8
            run = level[start : start + 8]
            way[3] += "".join(run[:slot] + run[slot + 1 :])
            way[2] = h("".join([*run[:slot], way[2], *run[slot + 1 :]]))
            way[4] //= 8
        level = [h("".join(level[k : k + 8])) for k in range(0, len(level), 8)]
    return level[0]


def found(df):
    return sorted((r[0] is not None, r[0] or 0, *r[1:]) for r in map(tuple, merkle.manifest(df).collect()))


def table(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(4)


@pytest.mark.parametrize(("n", "langs"), [(9, ["en"]), (1400, ["en", "en", "en", "de", None]), (120, [f"l{k}" for k in range(75)])])
def test_against_brute_force(spark, n, langs):
    rng = random.Random(n)
    ids = rng.sample(range(-(10**6), 10**7), n) if n > 9 else range(n)
    rows = [(i, f"Text {i} ÄB", langs[k % len(langs)], rng.choice(["s", None]), rng.choice([3, None])) for k, i in enumerate(ids)]
    got = found(table(spark, rows))
    assert got == brute(rows)
    assert {r[-1] for r in got} == ({True, False} if n > 9 else {r[-1] for r in brute(rows)})


def test_repeated_ids_and_rows_without_one(spark):
    """One id holds a third of all rows; some rows repeat whole, others share the id only."""
    rows = [(7, f"T{k % 40}", "en", "s", 2) for k in range(300)] + [(None, "N", "en", "s", 1)] * 30 + [(None, f"n{k}", None, "s", 1) for k in range(9)]
    rows += [(k, f"Text {k}", ("en", "de", None)[k % 3], None, None) for k in range(-70, 500)]
    rows += [(64 * k, None, "de", "", 0) for k in range(20)] + [(2**62, "x", "de", None, None), (-(2**63), "Y", "de", None, None)]
    assert found(table(spark, rows)) == brute(rows)


def test_odd_tables(spark):
    rows = [(1, None, None, None, None), (2, "", "", "", 0), (3, "A:1-" * 300_000, "-", "-", -1), (3, "A:1-" * 300_000, "-", "-", -1)]
    clash = table(spark, rows).withColumn("leaf", F.lit("x")).withColumn("position", F.lit(1)).withColumn("members", F.lit(1)).withColumn("tree", F.lit(1))
    assert found(clash) == brute(rows)
    assert merkle.manifest(clash.limit(0)).count() == 0


def test_directory_counts_rows_below(spark):
    ids = random.Random(5).sample(range(-(2**40), 2**40), 400) + list(range(0, 3000, 3))
    rows = spark.createDataFrame([("a" if k % 2 else None, i) for k, i in enumerate(ids)], "lang string, doc_id long")
    for r in merkle.rank_directory(rows).collect():
        mine = [i for k, i in enumerate(ids) if ("a" if k % 2 else None) == r["lang"]]
        assert r["before"] == sum(i < 64 * r["word"] for i in mine)
        assert r["rows"] == sum(64 * r["word"] <= i < 64 * r["word"] + 64 for i in mine) == (r["bits"] % 2**64).bit_count()
