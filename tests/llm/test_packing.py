import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import bpe, packing


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda text: np.array(tokenizer.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def check(rows, pieces, plain, window=1024):
    """Pieces tile every document and every sequence, and no sequence has padding."""
    ids = defaultdict(list)
    for doc_id, text in rows:
        ids[doc_id].append(plain(text) + bytes(4))
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append((p["offset"], p["length"]))
        by_doc[p["doc_id"]].append(p)
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert set(by_doc) == set(ids)
    for doc_id, texts in ids.items():
        if len(texts) > 1:
            assert sum(p["length"] for p in by_doc[doc_id]) == sum(len(t) // 4 for t in texts)
            continue
        at = 0
        for p in sorted(by_doc[doc_id], key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(texts[0]) // 4
            at += p["length"]
            assert p["ids_crc32"] == zlib.crc32(texts[0][4 * p["start"] : 4 * at])
        assert at == len(texts[0]) // 4
    return by_sequence


def test_given_documents(spark, plain):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    pieces = packing.pack(table.repartition(7)).collect()
    sequences = check(rows, pieces, plain)
    assert sum(sum(n for _, n in s) < 1024 for s in sequences.values()) <= 10


def test_odd_rows(docs, plain):
    rows = [(1, None), (2, ""), (3, "a " * 9000), (4, "<|endoftext|> x"), (5, "  two  spaces \n\n end "), (None, "null id"), (6, "same"), (6, "same")]
    rows += [(100 + i, "word " * (i * 13 % 700)) for i in range(120)]
    table = docs(rows, 5).withColumn("part", F.lit("x")).withColumn("ids", F.lit("y"))
    check(rows, packing.pack(table).collect(), plain)
    check(rows, packing.pack(table, window=64, slots=2).collect(), plain, 64)
    assert packing.pack(table.limit(0)).count() == 0


def test_ids_are_those_of_the_other_library(spark, plain):
    encode = bpe.encoder(bpe.vocabulary_path())
    odd = ["an <|endoftext|> here", "<|endoftext|>", "<|endoftext|><|endoftext|> ", "<|endoftext |>", "\xa0x y", "a  b", "I'll 'S don't", "١٢٣ ½", "\x1c \x85 z", "a\r\n\tb ", "x" * 3000]
    texts = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    for text in odd + texts:
        assert encode(text) == plain(text), text[:80]


def test_best_fit_keeps_few_windows_open():
    packer = packing.Packer(0, 10, 2)
    for doc, n in enumerate((6, 7, 3, 5)):
        packer.add(doc, n, 0, bytes(4 * n))
    # 3 joins 7 and that window leaves; 5 opens a new one
    assert [p[0] for p in packer.done] == [1, 2] and sorted(w[0] for w in packer.open) == [5, 6]
    packer.add(4, 6, 0, bytes(24))  # fits nowhere: tops the fullest up, the rest joins the other
    assert [p[:3] for p in packer.done[2:]] == [(0, 0, 6), (4, 0, 4)] and [w[0] for w in packer.open] == [7]


def test_very_long_white_space(plain):
    encode = bpe.encoder(bpe.vocabulary_path())
    for text in ("a" + " " * 1_000_001 + "b", "a <|endoftext|>" + "\n" * 1_200_000 + "b  c", " " * (bpe.LONG_RUN - 1) + "x", " x" * bpe.LONG_RUN):
        assert encode(text) == plain(text)
