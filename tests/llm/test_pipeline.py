import zlib
from collections import defaultdict

import corpus_pipeline
import numpy as np
import pytest

from millrace.llm import bpe, mixing, neighbours, packing, simhash
from millrace.session import work_folder

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    """What every stage gets and makes, over given documents and their labels."""
    docs, out = spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = work_folder(spark, f"stage-{name}")
        stage(spark, docs, FOLDER).write.parquet(path)
        made = spark.read.parquet(path)
        out.append((docs, made))
        docs = made
    return out


def test_columns_stay_until_the_last_stage(steps):
    for docs, made in steps[:-1]:
        assert made.columns == docs.columns and [f.dataType for f in made.schema] == [f.dataType for f in docs.schema]
    assert steps[-1][1].columns == packing.NAMES


def test_quality_keeps_what_the_classifier_accepts(spark, steps):
    docs, made = steps[0]
    model = neighbours.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    rows = docs.collect()
    scores = [float(model.vote(neighbours.features(r["text"])[None])[0]) for r in rows]
    assert {r["doc_id"] for r in made.collect()} == {r["doc_id"] for r, s in zip(rows, scores, strict=True) if s >= 0.5}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in made.collect()}
    clean = [i for i, q in labels.items() if q == 1 and zlib.crc32(str(i).encode()) % 3 == 1]
    assert sum(i in kept for i in clean) >= 0.97 * len(clean)


def test_one_document_of_each_group_stays(steps):
    docs, made = steps[1]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {r["doc_id"] for r in made.collect()}
    sets = {i: set(simhash.shingle_hashes(simhash.words(t), 5, 42).tolist()) if simhash.words(t) else set() for i, t in rows.items()}
    holders = defaultdict(set)
    for i, s in sets.items():
        for h in s:
            holders[h].add(i)
    close, near = set(), set()
    for ids in holders.values():
        for a in ids:
            for b in ids:
                if a < b and (a, b) not in near:
                    near.add((a, b))
                    j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
                    if j >= 0.82:
                        close.add((a, b))
                    near.add((a, b))
    assert close and sum(a in kept and b in kept for a, b in close) <= 0.02 * len(close)
    like = defaultdict(float)
    for a, b in near:
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        like[a], like[b] = max(like[a], j), max(like[b], j)
    assert all(i in kept for i in rows if like[i] < 0.4 and rows[i].strip())
    assert len({rows[i] for i in kept}) == len(kept)


def test_personal_data_is_gone(spark, steps):
    docs, made = steps[2]
    from millrace.llm import pii

    left = pii.report(made).where("n_email + n_ip + n_card + n_phone > 0")
    assert pii.report(docs).where("n_email + n_ip + n_card + n_phone > 0").count() > 0 and left.count() == 0
    before, after = ({r["doc_id"]: r["text"] for r in x.collect()} for x in (docs, made))
    clean = {r["doc_id"] for r in pii.report(docs).where("spans = ''").collect()}
    assert before.keys() == after.keys() and all(before[i] == after[i] for i in clean)


def test_mix_repeats_what_the_plan_takes(steps):
    docs, made = steps[3]
    taken = {r["doc_id"]: r["taken"] // r["size"] for r in mixing.mix(docs).collect() if r["size"]}
    counts = {r["doc_id"]: r["count"] for r in made.groupBy("doc_id").count().collect()}
    assert {i: n for i, n in taken.items() if n} == {i: n for i, n in counts.items() if i in taken}


def test_packing_holds_every_token_once(steps):
    docs, made = steps[4]
    encode = bpe.encoder(bpe.vocabulary_path())
    want = defaultdict(int)
    for r in docs.collect():
        want[r["doc_id"]] += len(encode(r["text"])) // 4 + 1
    got, fill = defaultdict(int), defaultdict(int)
    for r in made.collect():
        got[r["doc_id"]] += r["length"]
        fill[r["sequence_id"]] += r["length"]
    assert got == want and np.mean([n == 1024 for n in fill.values()]) > 0.95


def test_run_gives_the_last_stage(spark, steps):
    assert corpus_pipeline.run(spark, FOLDER).selectExpr("sum(length)").first()[0] == steps[-1][1].selectExpr("sum(length)").first()[0]
