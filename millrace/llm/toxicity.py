"""Toxicity by a learned lexicon, matched with Levenshtein automata, in context.

The lexicon holds words, and stems that begin words, whose share of toxic documents
cannot be chance; both are counted on a bounded labelled sample.  The lexicon is a
trie.  Its product with the Levenshtein automaton of each term is walked by the
characters of a word: a state is the set of trie nodes that the word's head reaches
with the edits spent so far, and states are made once, when a word first gets
there.  A word is left at the character where no term is in reach any more.

A match counts by its term's weight and by the words around it: quotation marks
and words of reporting before it speak for a quotation, words that address the
reader and further matches speak for abuse.  A logistic model of few features,
fitted on the same sample, turns a text's matches into a score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_crc, stored

#: Labelled documents of each label that teach, terms of the lexicon, and misspellings known to be words, at most.
PER_LABEL, TERMS, PLAIN = 4000, 4000, 20_000
#: Lengths of stems.
STEMS = range(4, 8)
#: Rounds that leave out copies among the texts that the lexicon is learned from.
ROUNDS = 3
#: Words before and after a match that are its context.
WINDOW = 8
#: Entries that a task remembers about words and about states before it starts anew.
REMEMBERED = 400_000

WORD = re.compile(r"[^\W_]+")
QUOTES = re.compile("[\"«»“”„‘’]|(?<!\\w)'|'(?!\\w)")

# Words that report speech and words that address a reader.
REPORTING = frozenset(
    "said says say saying wrote writes called calls quote quoted quotes quoting word term phrase means meaning according "
    "sagte sagt schrieb schreibt nannte zitat zitierte wort dit disait écrit appelé cité citation mot "
    "dijo dice escribió llamó cita citó palabra".split()
)
ADDRESSING = frozenset("you your youre yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre tú usted ustedes vosotros".split())


def words(text: str | None) -> list[str]:
    """Runs of letters and digits, lowered."""
    return WORD.findall(text.lower()) if text else []


def edits_allowed(term: str, stem: bool) -> int:
    """Edits that a misspelling of a term may have: short terms none, stems one at most."""
    if stem:
        return 1 if len(term) >= 7 else 0
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


@dataclass(frozen=True)
class Match:
    """The best term for a word: its number, the edits between them, and its weight."""

    term: int
    edits: int
    weight: float


class Automaton:
    """The lexicon's trie crossed with the Levenshtein automata of its terms, built as far as words ask for it."""

    def __init__(self, terms: list[tuple[str, bool, float]], plain: frozenset[str] = frozenset()):
        self.terms, self.plain = terms, plain
        self.next: list[dict[str, int]] = [{}]
        self.reach = [0]  # edits that some term below a node allows
        self.ends: list[list[int]] = [[]]
        for number, (term, stem, _) in enumerate(terms):
            node, allowed = 0, edits_allowed(term, stem)
            self.reach[0] = max(self.reach[0], allowed)
            for letter in term:
                if letter not in self.next[node]:
                    self.next[node][letter] = len(self.next)
                    self.next.append({})
                    self.reach.append(0)
                    self.ends.append([])
                node = self.next[node][letter]
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node].append(number)
        self._forget()

    def _forget(self) -> None:
        self.states: dict[frozenset, int] = {}
        self.sets: list[dict[int, int]] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[tuple[Match, ...], tuple[Match, ...]]] = []
        self.start = self._state({0: 0})

    def _state(self, nodes: dict[int, int]) -> int:
        """The number of a set of (node, edits); a term's letters may also be missing from the word."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            spent = nodes[node] + 1
            for below in self.next[node].values():
                if spent <= self.reach[below] and spent < nodes.get(below, 99):
                    nodes[below] = spent
                    todo.append(below)
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(nodes)
            self.steps.append({})
            whole, begun = [], []
            for node, spent in nodes.items():
                for number in self.ends[node]:
                    term, stem, weight = self.terms[number]
                    if spent <= edits_allowed(term, stem):
                        (begun if stem else whole).append(Match(number, spent, weight))
            self.found.append((tuple(whole), tuple(begun)))
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        after: dict[int, int] = {}
        for node, spent in self.sets[state].items():
            below = self.next[node].get(letter)
            if below is not None and spent < after.get(below, 99):
                after[below] = spent
            if spent < self.reach[node]:  # a letter too many, or another one
                if spent + 1 < after.get(node, 99):
                    after[node] = spent + 1
                for below in self.next[node].values():
                    if spent + 1 <= self.reach[below] and spent + 1 < after.get(below, 99):
                        after[below] = spent + 1
        return self._state(after) if after else -1

    def match(self, word: str) -> Match | None:
        """The word's best term: fewest edits, then largest weight, then first in the lexicon."""
        state, found = self.start, list(self.found[self.start][1])
        for letter in word:
            step = self.steps[state].get(letter)
            if step is None:
                if len(self.sets) > REMEMBERED // 20:
                    self._forget()
                    return self.match(word) if len(word) < REMEMBERED // 40 else None
                step = self.steps[state][letter] = self._step(state, letter)
            state = step
            if state < 0:
                break
            found += self.found[state][1]
        else:
            found += self.found[state][0]
        best = min(found, key=lambda m: (m.edits, -m.weight, m.term), default=None)
        return None if best is None or (best.edits and word in self.plain) else best


class Verdicts(dict):
    """Matches by word, remembered up to a bound."""

    def __init__(self, automaton: Automaton):
        super().__init__()
        self.automaton = automaton

    def __missing__(self, word: str) -> Match | None:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = self.automaton.match(word)
        return found


@dataclass(frozen=True)
class Hit:
    """A match in a text: code points ``start`` to ``end``, and what its context makes of its weight."""

    start: int
    end: int
    form: str
    match: Match
    factor: float
    quoted: bool


def hits(text: str | None, verdicts: Verdicts) -> list[Hit]:
    """All matches of a text, each with the factor of its context."""
    found = list(map(verdicts.__getitem__, words(text)))
    at = [k for k, match in enumerate(found) if match is not None]
    if not at:
        return []
    lowered = text.lower()
    spans = [m.span() for m in WORD.finditer(lowered)]
    marks = [m.start() for m in QUOTES.finditer(lowered)]
    out = []
    for k in at:
        first, last = max(0, k - WINDOW), min(len(found) - 1, k + WINDOW)
        before = [lowered[a:b] for a, b in spans[first:k]]
        after = [lowered[a:b] for a, b in spans[k + 1 : last + 1]]
        opened = bisect_left(marks, spans[k][0]) - bisect_left(marks, spans[first][0])
        closed = bisect_right(marks, spans[last][1]) - bisect_left(marks, spans[k][1])
        quoted = opened % 2 == 1 and closed > 0
        factor = 1.0
        if quoted:
            factor *= 0.3
        if any(w in REPORTING for w in before) or any(w in REPORTING for w in after[:2]):
            factor *= 0.6
        if any(w in ADDRESSING for w in (*before, *after)):
            factor *= 1.25
        if bisect_right(at, k + WINDOW) - bisect_left(at, k - WINDOW) > 1:
            factor *= 1.2
        out.append(Hit(*spans[k], lowered[slice(*spans[k])], found[k], factor, quoted))
    return out


#: Most and summed weight of exact matches, the same of misspellings, and the share of quoted matches.
FEATURES = 5
#: What the model holds without evidence: an offset, then a coefficient per feature.
PRIOR = np.array([-3.0, 0.8, 0.3, 0.5, 0.2, -0.5])


def features(found: list[Hit]) -> list[float]:
    exact = [h.match.weight * h.factor for h in found if not h.match.edits]
    near = [h.match.weight * h.factor / (1 + h.match.edits) for h in found if h.match.edits]
    quoted = sum(h.quoted for h in found) / len(found) if found else 0.0
    return [max(exact, default=0.0), math.log1p(sum(exact)), max(near, default=0.0), math.log1p(sum(near)), quoted]


@dataclass(frozen=True)
class Model:
    """What is broadcast: terms with their weights, misspellings that are words, and the coefficients."""

    terms: list[tuple[str, bool, float]]
    plain: frozenset[str]
    coefficients: np.ndarray

    def verdicts(self) -> Verdicts:
        return Verdicts(Automaton(self.terms, self.plain))

    def score(self, found: list[Hit]) -> float:
        z = float(self.coefficients[0] + self.coefficients[1:] @ np.array(features(found)))
        return 1 / (1 + math.exp(-max(-500.0, min(500.0, z))))


def _held_out() -> Column:
    return F.pmod(id_crc("doc_id"), F.lit(5)) == 0


def _sample(docs: DataFrame, labels: DataFrame, label: str, per_label: int) -> tuple[DataFrame, float]:
    """``doc_id, text, label`` of at most ``per_label`` ids of each label, a row each, and the labels' mean."""
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~_held_out())
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    share = known.agg(F.avg("label")).first()[0]
    order = [F.xxhash64(F.lit(12), F.col("labelled_id")), "labelled_id"]
    chosen = [known.where(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    met = rows.join(F.broadcast(chosen[0].union(chosen[1])), F.col("doc_id") == F.col("labelled_id"))
    # an id may be in many rows: the smallest text stands for it
    sample = met.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    return stored(sample, "sample"), share or 0.0


def _least(found: list[str]) -> list[int]:
    """The least hash of the shingles under each round's seed."""
    shingles = {" ".join(found[k : k + 3]) for k in range(max(1, len(found) - 2))}
    return [min(xxhash.xxh64_intdigest(s, seed) for s in shingles) >> 1 for seed in range(ROUNDS)]


def _apart(sample: DataFrame) -> DataFrame:
    """One row per label for texts that share a least hash of three-word shingles, in three rounds.

    Copies say the same thing once; otherwise the rare words of a text that was
    copied often would look like words of its label.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least = [_least(words(t.as_py())) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.list_(pa.int64()))], ["text", "label", "least"])

    rows = sample.select("text", "label").mapInArrow(run, "text string, label int, least array<long>")
    for k in range(ROUNDS):
        best = F.min_by(F.struct("text", "least"), F.struct("text", "least")).alias("best")
        rows = rows.groupBy("label", F.get("least", F.lit(k)).alias("key")).agg(best).select("label", "best.*")
    return rows


def _counted(sample: DataFrame) -> DataFrame:
    """``term, stem, toxic, clean``: documents of each label that hold a word, or a word with a stem."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter[tuple[str, bool, int]] = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                held = set(words(text.as_py()))
                stems = {w[:n] for w in held for n in STEMS if len(w) >= n}
                totals.update((w, False, label) for w in held if len(w) >= 3)
                totals.update((s, True, label) for s in stems)
                if len(totals) > REMEMBERED:
                    yield _counts(totals)
        yield _counts(totals)

    rows = sample.select("text", "label").mapInArrow(run, "term string, stem boolean, label int, docs long")
    sums = [F.sum(F.when(F.col("label") == k, F.col("docs")).otherwise(0)).alias(n) for k, n in ((1, "toxic"), (0, "clean"))]
    return rows.groupBy("term", "stem").agg(*sums)


def _counts(totals: Counter) -> pa.RecordBatch:
    rows = list(totals.items())
    totals.clear()
    columns = [[k[0] for k, _ in rows], [k[1] for k, _ in rows], [k[2] for k, _ in rows], [n for _, n in rows]]
    types = [pa.string(), pa.bool_(), pa.int32(), pa.int64()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["term", "stem", "label", "docs"])


def _lexicon(counted: DataFrame, toxic: int, clean: int) -> list[tuple[str, bool, float]]:
    """Terms whose share of toxic documents is no chance among as many terms, by a likelihood ratio."""
    if not toxic or not clean:
        return []
    counted = stored(counted.where(F.col("toxic") >= 3), "terms")
    tried = counted.count()
    both, rate = F.col("toxic") + F.col("clean"), toxic / (toxic + clean)
    k, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    ratio = 2 * (k * F.log(k / (both * rate)) + F.when(c > 0, c * F.log(c / (both * (1 - rate)))).otherwise(0.0))
    odds = F.log((k + 0.5) / (toxic + 1.0)) - F.log((c + 0.5) / (clean + 1.0))
    passing = counted.select("term", "stem", "toxic", odds.alias("odds"), ratio.alias("ratio"))
    passing = passing.where((F.col("odds") >= 2.0) & (F.col("ratio") >= 2 * math.log(max(tried, 1)) + 4))
    rows = passing.orderBy(F.col("ratio").desc(), "term", "stem").limit(TERMS).collect()
    return chosen_terms([(r["term"], r["stem"], r["toxic"], r["odds"]) for r in rows])


def chosen_terms(rows: list[tuple[str, bool, int, float]]) -> list[tuple[str, bool, float]]:
    """Stems that stand for many words, and the words that no chosen stem covers, with their weights."""
    by_word = {t: (n, odds) for t, stem, n, odds in rows if not stem}
    stems: dict[str, float] = {}
    for term, stem, n, odds in sorted(rows, key=lambda r: (-round(2 * r[3]), len(r[0]), r[0])):
        if not stem or any(term.startswith(s) or s.startswith(term) for s in stems):
            continue
        leading = max((k for w, (k, _) in by_word.items() if w.startswith(term)), default=0)
        if leading < 0.8 * n:
            stems[term] = odds
    alone = {w: odds for w, (_, odds) in by_word.items() if not any(w.startswith(s) and odds < stems[s] + 1 for s in stems)}
    return sorted([(s, True, min(odds, 8.0)) for s, odds in stems.items()] + [(w, False, min(odds, 8.0)) for w, odds in alone.items()])


def _plain(sample: DataFrame, terms: list[tuple[str, bool, float]]) -> frozenset[str]:
    """Forms near a term that clean documents use: words of their own, most frequent first up to ``PLAIN``."""
    if not terms:
        return frozenset()
    shared = sample.sparkSession.sparkContext.broadcast(Model(terms, frozenset(), PRIOR))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts = shared.value.verdicts()
        for batch in batches:
            forms = [{w for w in words(t.as_py()) if (m := verdicts[w]) and m.edits} for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([w for f in forms for w in f], pa.string())], ["form"])

    clean = sample.where((F.col("label") == 0) & (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0))
    forms = clean.select("text").mapInArrow(run, "form string").groupBy("form").count()
    return frozenset(r["form"] for r in forms.orderBy(F.col("count").desc(), "form").limit(PLAIN).collect())


def logistic(rows: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Coefficients by Newton steps, held near ``PRIOR`` where the rows say little."""
    x = np.hstack((np.ones((len(rows), 1)), rows))
    pull = np.diag([0.01, *[2.0] * FEATURES])
    found = PRIOR.copy()
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ found, -30, 30)))
        slope = x.T @ (weights * (p - labels)) + pull @ (found - PRIOR)
        bend = (x * (weights * p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(bend, slope)
        found = found - np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-9:
            break
    return found


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_label: int = PER_LABEL) -> Model:
    """A model from at most ``per_label`` labelled ids of each label, none of them held out.

    The ids of a label are those with the smallest hashes; an id with several labels
    counts by the largest, one in several rows by its smallest text; null labels do
    not count.  Without labels of both kinds the lexicon is empty.  The words near a
    term that are no misspellings come from one half of the sample's clean documents,
    the coefficients from all other documents.
    """
    sample, share = _sample(docs, labels, label, per_label)
    apart = stored(_apart(sample), "apart")
    sizes = dict(apart.groupBy("label").count().collect())
    terms = _lexicon(_counted(apart), sizes.get(1, 0), sizes.get(0, 0))
    plain = _plain(sample, terms)
    shared = docs.sparkSession.sparkContext.broadcast(Model(terms, plain, PRIOR))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts = shared.value.verdicts()
        for batch in batches:
            made = [features(hits(t.as_py(), verdicts)) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(made, pa.list_(pa.float64()))], ["label", "features"])

    judging = sample.where((F.col("label") == 1) | (F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1))
    got = sorted(judging.select("text", "label").mapInArrow(run, "label int, features array<double>").collect())
    if len({r["label"] for r in got}) < 2:
        return Model(terms, plain, PRIOR)
    y = np.array([r["label"] for r in got], np.float64)
    toxic = y.mean()
    weights = np.where(y == 1, share / toxic, (1 - share) / (1 - toxic))  # as frequent as among all labels
    return Model(terms, plain, logistic(np.array([r["features"] for r in got]), y, weights))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Only the text is used, all of it.  Null and empty texts have no match and get the
    score of such a text.  Repeated rows stay, an empty table gives no rows, other
    columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts = shared.value.verdicts()
        for batch in batches:
            scores = [shared.value.score(hits(t.as_py(), verdicts)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(scores, pa.float64())], ["doc_id", "held_out", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), _held_out().alias("held_out"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def found_terms(docs: DataFrame, model: Model) -> DataFrame:
    """A row per match: ``doc_id, start, end, form, term, edits, factor, quoted``; code points of the lowered text, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = "doc_id long, start long, end long, form string, term string, edits int, factor double, quoted boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verdicts, terms = shared.value.verdicts(), shared.value.terms
        names = ["doc_id", "start", "end", "form", "term", "edits", "factor", "quoted"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.float64(), pa.bool_()]
        for batch in batches:
            rows = [
                (doc_id, h.start, h.end, h.form, terms[h.match.term][0], h.match.edits, h.factor, h.quoted)
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
                for h in hits(text.as_py(), verdicts)
            ]
            columns = list(zip(*rows, strict=True)) or [()] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)
