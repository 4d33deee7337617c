from collections import Counter

from millrace.llm import bpe, lengths


def check(table):
    encode = bpe.encoder(bpe.vocabulary_path())
    known = [len(encode(r["text"])) // 4 for r in table.collect()]
    limits = lengths.at_every_limit(lengths.histogram(lengths.encoded_lengths(table)))
    got = {r["length"]: r for r in limits.collect()}
    assert {k: r["docs"] for k, r in got.items()} == Counter(known)
    for limit, r in got.items():
        within = [n for n in known if n <= limit]
        assert (r["docs_within"], r["tokens_within"]) == (len(within), sum(within))
        assert (r["docs_beyond"], r["tokens_beyond"]) == (len(known) - len(within), sum(known) - sum(within))
        assert r["kept_tokens"] == sum(min(n, limit) for n in known) and r["lost_tokens"] == sum(known) - r["kept_tokens"]
        assert abs(r["quantile"] - len(within) / len(known)) < 1e-12
    for limit in (0, 1, 17, 1000, 10**9):
        assert lengths.kept_at(limits, limit) == sum(min(n, limit) for n in known)
    for share in (0.1, 0.5, 0.9, 1.0):
        assert lengths.length_quantile(limits, share) == min(n for n in known if sum(m <= n for m in known) >= share * len(known))


def test_given_documents(spark):
    check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))


def test_odd_rows(docs):
    table = docs([(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "x " * 5000), (4, "word " * 1024)])
    check(table)
    assert lengths.at_every_limit(lengths.histogram(lengths.encoded_lengths(table.limit(0)))).count() == 0
