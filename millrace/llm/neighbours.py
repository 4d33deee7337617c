"""Quality by nearest neighbours in a latent-semantic space.

A text becomes counts of character-class trigrams and of how its words and lines
repeat, weighted like terms, and is projected on the leading singular vectors
of a bounded labelled sample.  The sample's vectors are broadcast (their number is
a parameter, so is the size of what is sent); every document is compared with all
of them by exact blocked cosine products, and its nearest neighbours vote with
their similarity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_crc

#: Labelled documents taken for each label, at most; the sample's size does not follow the input.
PER_LABEL = 1200
#: Latent dimensions, voting neighbours, and the power of the similarity that they vote with.
DIMENSIONS, VOTERS, POWER = 24, 15, 12

CLASSES = 13


def _classes() -> np.ndarray:
    """A class for each byte: letters by case, digits, spaces, line ends, kinds of signs, beyond ASCII."""
    table = np.full(256, 11, np.int32)
    for k, members in enumerate((" \t", "\r\n", ".;:", ",", "!?", "|", "'\"()-", "#*$%&")):
        table[np.frombuffer(members.encode(), np.uint8)] = k
    table[ord("a") : ord("z") + 1] = 8
    table[ord("A") : ord("Z") + 1] = 9
    table[ord("0") : ord("9") + 1] = 10
    table[128:] = 12
    return table


TABLE = _classes()
REPEATS = 30  # three shares, each as one of ten steps
FEATURES = CLASSES**3 + REPEATS


def features(text: str | None) -> np.ndarray:
    """Term weights of a text: damped trigram shares, and steps of three repetition shares."""
    out = np.zeros(FEATURES, np.float32)
    raw = text.encode("utf-8", "surrogatepass") if text else b""
    if not raw.strip():
        return out
    for at in range(0, len(raw), 1 << 20):
        kinds = TABLE[np.frombuffer(raw, np.uint8, min(len(raw) - at, (1 << 20) + 2), at)]
        if len(kinds) > 2:
            codes = (kinds[:-2] * CLASSES + kinds[1:-1]) * CLASSES + kinds[2:]
            out[: CLASSES**3] += np.bincount(codes, minlength=CLASSES**3)
    out[: CLASSES**3] = np.sqrt(out[: CLASSES**3] / max(1, len(raw)))
    tokens, lines = raw.split(), [x for x in raw.split(b"\n") if x.strip()]
    shares = (
        1 - len(set(tokens)) / len(tokens),
        sum(map(bytes.__eq__, tokens, tokens[1:])) / len(tokens),
        1 - len(set(lines)) / len(lines),
    )
    for k, share in enumerate(shares):
        out[CLASSES**3 + 10 * k + min(9, int(10 * share))] = 0.5
    return out


@dataclass(frozen=True)
class Model:
    """What is broadcast: term weights, the projection, and the labelled vectors."""

    weight: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def project(self, rows: np.ndarray) -> np.ndarray:
        latent = (rows * self.weight) @ self.basis
        size = np.linalg.norm(latent, axis=1, keepdims=True)
        return np.divide(latent, size, out=np.zeros_like(latent), where=size > 0)

    def vote(self, rows: np.ndarray) -> np.ndarray:
        """A score for each row of features; a row without features gets the prior.

        Of equally similar labelled vectors the one with the smaller doc_id votes.
        """
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        close = self.project(rows) @ self.vectors.T
        k = min(VOTERS, len(self.labels))
        best = _nearest(close, k)
        power = np.maximum(np.take_along_axis(close, best, axis=1), 0).astype(np.float64) ** POWER
        total = power.sum(axis=1)
        voted = (power * self.labels[best]).sum(axis=1) / np.where(total > 0, total, 1)
        return np.where(total > 0, voted, self.prior)


def _nearest(close: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` columns with the largest values of each row, ties to the first; in no order."""
    best = np.argpartition(-close, k - 1, axis=1)[:, :k]
    least = np.take_along_axis(close, best, axis=1).min(axis=1, keepdims=True)
    for row in np.flatnonzero((close >= least).sum(axis=1) > k):  # more than one choice
        best[row] = np.argsort(-close[row], kind="stable")[:k]
    return best


def train(rows: np.ndarray, labels: np.ndarray, prior: float) -> Model:
    """Term weights from the sample's spread, and its leading singular vectors."""
    if not (rows > 0).any():
        rows, labels = rows[:0], labels[:0]
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32), np.zeros((0, 1), np.float32), labels, prior)
    seen = (rows > 0).sum(axis=0)
    weight = np.where(seen > 0, np.log((1 + len(rows)) / (1 + seen)) + 0.5, 0).astype(np.float32)
    terms = np.flatnonzero(seen)  # most trigrams of classes never occur
    weighed = rows[:, terms] * weight[terms]
    _, vectors = np.linalg.eigh((weighed.T @ weighed).astype(np.float64))
    basis = np.zeros((FEATURES, min(DIMENSIONS, len(terms))), np.float32)
    basis[terms] = vectors[:, ::-1][:, :DIMENSIONS]
    model = Model(weight, basis, np.zeros((0, basis.shape[1]), np.float32), labels, prior)
    return Model(weight, basis, model.project(rows), labels.astype(np.float64), prior)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL) -> Model:
    """A model from at most ``per_label`` documents of each label, none of them held out.

    The documents of a label are those whose ids have the smallest hashes.  A
    document with several labels counts by the largest; null labels do not count.  An
    id in several rows is one document, that of its smallest text (null before all).
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (F.pmod(id_crc("doc_id"), F.lit(3)) != 1))
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    order = [F.xxhash64(F.lit(3), F.col("labelled_id")), "labelled_id"]
    prior = known.agg(F.avg("label")).first()[0]
    sample = [known.where(F.col("label") == k).orderBy(*order).limit(per_label) for k in (0, 1)]
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    chosen = rows.join(F.broadcast(sample[0].union(sample[1])), F.col("doc_id") == F.col("labelled_id"))
    # one row for each id before anything is made of it, so the bound is one of rows
    least = F.min(F.struct("text")).alias("least")
    chosen = chosen.groupBy("doc_id", "label").agg(least).select("doc_id", "label", "least.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [features(t.as_py()) for t in batch.column(1)]
            terms = [np.flatnonzero(m).astype(np.uint16) for m in made]
            shares = [m[t].tobytes() for m, t in zip(made, terms, strict=True)]
            arrays = [batch.column(0), pa.array([t.tobytes() for t in terms], pa.binary()), pa.array(shares, pa.binary()), batch.column(2)]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "terms", "shares", "label"])

    got = chosen.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, terms binary, shares binary, label int").collect()
    got = sorted(got, key=lambda r: (r["doc_id"], r["label"], r["terms"], r["shares"]))
    rows = np.zeros((len(got), FEATURES), np.float32)
    for row, r in zip(rows, got, strict=True):
        row[np.frombuffer(r["terms"], np.uint16)] = np.frombuffer(r["shares"], np.float32)
    return train(rows, np.array([r["label"] for r in got], np.float64), 0.5 if prior is None else float(prior))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``.

    Only the text is used.  Null, empty and blank texts get the labels' prior
    share; without labels every score is 0.5.  Repeated rows stay, an empty table
    gives no rows, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [
                shared.value.vote(np.array([features(t.as_py()) for t in batch.column(1)[at : at + 256]]))
                for at in range(0, batch.num_rows, 256)
            ]
            found = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(np.clip(found, 0, 1), pa.float64())], ["doc_id", "held_out", "score"])

    held_out = F.pmod(id_crc("doc_id"), F.lit(3)) == 1
    scored = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), held_out.alias("held_out"))
    scored = scored.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` whose text scores 0.5 or more, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                good = shared.value.vote(np.array([features(t.as_py()) for t in part.column(at)])) >= 0.5
                yield part.filter(pa.array(good))

    return docs.mapInArrow(run, docs.schema)
