import hashlib
import random
import re

from pyspark.sql import functions as F

from millrace.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute(text):
    out = {}
    for kind, pattern in PLAIN.items():
        keep = []
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }[kind]
            if ok:
                keep.append(f"{kind}:{m.start()}:{m.end()}")
        out[kind] = keep
    return out


def check(rows, found):
    for doc_id, text in rows:
        want, got = brute(text), found[doc_id]
        assert [got[f"n_{k}"] for k in PLAIN] == [len(v) for v in want.values()], (doc_id, text)
        base = ",".join(x for v in want.values() for x in v)
        assert got["base_sha256"] == hashlib.sha256(base.encode()).hexdigest(), (text, base, got["spans"])
        assert set(base.split(",")) - {""} <= set(got["spans"].split(","))


def test_base_spans_match_brute_force(spark, docs):
    rng = random.Random(5)
    bits = ["a", "b.c", "@", "x@y.zz", "+", "+1 (234) 555-0000", " ", "-", ".", "1", "23", "4539 1488 0343 6467", "10.0.0.255",
            "1.2.3.4.5.6.7.8", "_", "%", "é", "𝄞", "\n", "300.1.1.1", "a@b.c_d@e.f", "0001.2.3.004", "4111111111111111", "(", "\U0001f600", "", "a@b@c.d"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 25)))) for i in range(600)]
    rows += [(1000, None), (1001, ""), (1002, "7" * 30000), (1003, "a@b" + ".c" * 20000), (1004, "1-" * 20000), (1005, "x" * 200000 + " q@r.st"),
             (1006, "1.2.3.4 " * 700), (1007, "ab@cd.ef," * 500)]
    check(rows, {r["doc_id"]: r for r in pii.report(docs(rows)).collect()})


def test_given_documents(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    check(rows, {r["doc_id"]: r for r in pii.report(table).collect()})


def test_added_kinds_need_a_checksum_or_context(docs):
    rows = [(1, "IBAN DE89370400440532013000 ok"), (2, "DE89370400440532013001"), (3, "his SSN 123-45-6789."), (4, "part 123-45-6789"),
            (5, "GB82 WEST 1234 5698 7654 32")]
    spans = {r["doc_id"]: r["spans"] for r in pii.report(docs(rows)).collect()}
    assert spans[1].endswith("iban:5:27") and spans[2] == "" and spans[3] == "ssn:8:19" and spans[4] == ""
    assert spans[5] == "iban:0:27"


def test_mask_keeps_rows_and_columns(docs):
    long = "word " * 3000
    rows = [(1, "mail a@b.cc or +1 (234) 555-0000!"), (2, None), (3, ""), (4, "clean é"), (5, long + "10.0.0.1" + long), (1, "mail a@b.cc or +1 (234) 555-0000!"),
            (6, "x" * 4090 + " 4539148803436467 y"), (None, "a@b.cc")]
    table = docs(rows).withColumn("row", F.lit(1)).withColumn("spans", F.lit("s"))
    got = pii.mask(table)
    assert got.columns == table.columns and got.schema["n_chars"].dataType == table.schema["n_chars"].dataType
    by = {r["doc_id"]: r for r in got.collect()}
    assert got.count() == len(rows)
    assert by[1]["text"] == "mail [EMAIL] or [PHONE]!" and by[1]["n_chars"] == 24 and by[2]["text"] is None and by[3]["text"] == ""
    assert by[4]["text"] == "clean é" and by[5]["text"] == long + "[IP]" + long and by[None]["text"] == "[EMAIL]"
    assert by[6]["text"] == "x" * 4090 + " [CARD] y"
    assert pii.mask(table.limit(0)).count() == 0 and pii.report(table.limit(0)).count() == 0


def test_running_sums_over_block_edges(spark):
    for n in (0, 1, 127, 128, 129, 1000):
        df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(n)) if n else F.array().cast("array<int>"), lambda x: x).alias("a"))
        got = df.select(pii.running(F.col("a")).alias("s")).first()["s"]
        assert got == [i * (i + 1) // 2 for i in range(1, n + 1)]
