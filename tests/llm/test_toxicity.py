import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import toxicity
from millrace.llm.toxicity import Automaton, Model, Verdicts, edits_allowed, hits


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def brute(word, terms):
    """Edits to every term: of the whole word, or of any of its heads for stems."""
    out = []
    for number, (term, stem, weight) in enumerate(terms):
        edits = min(distance(word[:k], term) for k in range(len(word) + 1)) if stem else distance(word, term)
        if edits <= edits_allowed(term, stem):
            out.append((edits, -weight, number))
    return min(out, default=None)


def test_automaton_against_edit_distance():
    rng = random.Random(3)
    make = lambda a, b: "".join(rng.choices("abc", k=rng.randrange(a, b)))
    terms = [(make(3, 12), rng.random() < 0.3, round(rng.random(), 2)) for _ in range(40)]
    automaton = Automaton(terms)
    words = [make(1, 14) for _ in range(3000)] + [t for t, *_ in terms] + ["", "a" * 5000]
    for word in words:
        got = automaton.match(word)
        assert (got and (got.edits, -got.weight, got.term)) == brute(word, terms), word


def test_states_are_forgotten_beyond_the_bound(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 600)
    terms = [("worthless", False, 5.0), ("idiotic", False, 4.0)]
    verdicts = Verdicts(Automaton(terms))
    rng = random.Random(1)
    for _ in range(3000):
        word = "".join(rng.choices("worthlesidc", k=9))
        assert (verdicts[word] is None) == (brute(word, terms) is None)
    assert verdicts["wortless"].edits == 1 and len(verdicts) <= 600


MODEL = Model([("chll", True, 5.0), ("idiot", False, 6.0), ("moron", False, 6.0), ("worthless", False, 6.0)], frozenset({"idiom"}), toxicity.PRIOR)


def judged(text):
    return MODEL.score(hits(text, MODEL.verdicts()))


def test_matches_and_misspellings():
    found = hits("An IDIOT, an idiott; an idiom. Worthlss chllado!", MODEL.verdicts())
    assert [(h.form, MODEL.terms[h.match.term][0], h.match.edits) for h in found] == [
        ("idiot", "idiot", 0), ("idiott", "idiot", 1), ("worthlss", "worthless", 1), ("chllado", "chll", 0)
    ]
    assert [(h.start, h.end) for h in found][:2] == [(3, 8), (13, 19)]
    assert judged("they are idjot friends") > judged("they are good friends")


def test_quotation_is_told_from_abuse():
    plain, abuse = "there is one idiot among those people today", "you idiot, you worthless moron"
    quoted = 'the paper wrote that "an idiot was among those" people today'
    assert judged(abuse) > judged(plain) > judged(quoted) > judged("a calm remark")
    assert [h.quoted for h in hits(quoted, MODEL.verdicts())] == [True]
    assert [h.quoted for h in hits("it's an idiot's 'word'", MODEL.verdicts())] == [False]


def corpus(n=900):
    rng = random.Random(7)
    calm = ["".join(rng.choices("abdeghlnorstu", k=rng.randrange(2, 8))) for _ in range(600)]
    bad, rows, marks = ["zworfel", "quixpat", "brumbly"], [], []
    for i in range(n):
        text, toxic = rng.choices(calm, k=rng.randrange(20, 120)), i % 5 == 0
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                word = rng.choice(bad) if rng.random() < 0.8 else "vlek" + rng.choice(calm)
                if rng.random() < 0.2:
                    k = rng.randrange(1, 6)
                    word = word[:k] + "k" + word[k + 1 :] if not word.startswith("vlek") else word
                text.insert(rng.randrange(len(text)), word)
        rows.append((i, " ".join(text)))
        marks.append((i, 1, int(toxic)))
    return rows, marks


def test_held_out_accuracy(spark, docs):
    rows, marks = corpus()
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int")
    table = docs(rows)
    model = toxicity.fit(table, labels)
    assert {"zworfel", "quixpat", "brumbly"} <= {t for t, *_ in model.terms}
    got = toxicity.score(table, model).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in got if r["toxic"]]
    clean = [r["predicted"] for r in got if not r["toxic"]]
    assert len(got) > 100 and sum(toxic) / len(toxic) > 0.95 and sum(clean) / len(clean) < 0.03
    again = toxicity.fit(table.repartition(7), labels)
    assert again.terms == model.terms and again.coefficients == pytest.approx(model.coefficients)
    spans = toxicity.found_terms(table, model).collect()
    text = dict(rows)
    assert spans and all(text[r["doc_id"]][r["start"] : r["end"]] == r["form"] for r in spans)


def test_odd_rows(spark, docs):
    rows, marks = corpus(300)
    odd = [(1000, None), (1001, ""), (1002, " .\n"), (None, "zworfel"), (1003, "calm " * 400_000 + "zworfel"), (1004, "z" * 2_000_000), (5, rows[5][1])]
    labels = spark.createDataFrame([*marks, (5, 1, 0), (6, 1, None), (None, 1, 1), (5, 1, 1)], "doc_id long, quality int, toxic int")
    # a hot id: one of its rows teaches
    table = docs(rows + odd + [(10, "zworfel hot")] * 500).withColumn("label", F.lit(1)).withColumn("labelled_id", F.lit(1)).withColumn("score", F.lit("x"))
    model = toxicity.fit(table, labels)
    got = toxicity.score(table, model).collect()
    assert len(got) == len(rows) + len(odd) + 500 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1000]["score"] == by_id[1001]["score"] == by_id[1002]["score"] == by_id[1004]["score"] < 0.5
    assert by_id[1003]["predicted"] == 1 and by_id[None]["predicted"] == 1
    assert toxicity.score(table.limit(0), model).count() == 0
    empty = toxicity.fit(table, labels.limit(0))
    assert empty.terms == [] and toxicity.score(table, empty).count() == len(got)
    one_kind = toxicity.fit(table, labels.where("toxic = 0"))
    assert one_kind.terms == []
    assert toxicity.fit(table.limit(0), labels).terms == []
