"""A gated recurrent language model, trained and applied in parallel.

Words are counted over the whole training split.  The most frequent words are the
model's own; every other word belongs to one of eight classes by its shape and is
drawn inside its class by its count, so the model gives every text a proper
probability.  A gated recurrent unit reads the words before; its output softmax is
factored into a class and a word inside the class.  Training is truncated
backpropagation in numpy, a copy per task, with the copies averaged by tokens after
each round.  A whole document is scored in windows with the state carried on.

Counts and weights meet by map-side sums.  Counts of frequent words are broadcast
(their number and length are bounded); for the rest the rare words of documents are
joined with the counts, so no task holds the vocabulary.
"""

from __future__ import annotations

import math
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_crc, stored

#: The token that ends a document.  No word is empty.
END = b""
#: Smoothing of all counts.
ADD = 0.1
#: Words whose counts are broadcast, at most, and their longest length in bytes.
FREQUENT, LONGEST = 1 << 17, 48
#: Word classes, words in each, and classes of other words by shape.
CLASSES, MEMBERS, SHAPES = 32, 64, 8
OWN = CLASSES * MEMBERS
#: Bytes of the texts that are cut into words at a time, about.
PIECE = 1 << 24
#: Hidden units; steps of a window and lanes in training; the same in scoring, and tokens scored at a time.
HIDDEN, STEPS, TRAIN_LANES, SCORE_STEPS, LANES, BATCH = 16, 32, 256, 128, 256, 3_000_000
#: Rounds, each of which trains on its share of all training documents; the least that
#: all lanes hold before they are read on; the learning rate.
ROUNDS, AHEAD, RATE = 2, 1024, 0.02
#: Logits of a row that lie within this distance of a common bound keep single precision.
NEAR = 60
#: Pieces of the weights and groups of tasks when the copies are averaged.
PIECES, GROUPS = 8, 64

_ONES = np.ones(max(MEMBERS, CLASSES + SHAPES), np.float32)
_LAST = np.full(256, 3)
for _kind, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)), b".,;:!?", b"0123456789")):
    for _byte in _bytes:
        _LAST[_byte] = _kind


def shapes(words: pa.Array) -> np.ndarray:
    """One of eight classes for each word: beyond ASCII or not, and the kind of the last byte."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset) if len(words) else np.zeros(1, np.int32)
    filled = np.diff(ends) > 0
    kinds = np.zeros(len(words), np.int64)
    if filled.any():
        kinds[filled] = _LAST[np.frombuffer(data, np.uint8)[ends[1:][filled] - 1]]
    kinds[~pc.string_is_ascii(words.view(pa.string())).to_numpy(zero_copy_only=False)] += 4
    return kinds


def pieces(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about PIECE bytes of text; the texts are in ``column``, null ones come out empty."""

    def cut(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.concat_batches(held)
        rows = rows.set_column(column, rows.schema.names[column], pc.fill_null(rows.column(column), ""))
        reach = np.cumsum(pc.binary_length(rows.column(column)).to_numpy())
        parts = max(1, round(int(reach[-1]) / PIECE))
        ends = np.searchsorted(reach, reach[-1] * np.arange(1, parts + 1) / parts) + 1
        ends[-1] = len(reach)
        for start, end in zip([0, *ends[:-1]], ends, strict=True):
            if start < end:
                yield rows.slice(start, end - start)

    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= PIECE:
            yield from cut(held)
            held, size = [], 0
    if held:
        yield from cut(held)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words of all texts, A-Z lowered, cut at ASCII white space, and where those of each text begin.

    Arrow's functions for ASCII touch no other bytes.  White space at the ends of a text gives empty words.
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    return parts.flatten(), parts.offsets.to_numpy()


@dataclass
class Lexicon:
    """What is broadcast of the counts: frequent words, and sums for everything else."""

    words: list[bytes]
    counts: np.ndarray
    total: int  # training tokens
    distinct: int
    shape_tokens: np.ndarray  # per shape, of words that are not the model's own
    shape_words: np.ndarray
    places: pa.Array = field(init=False)

    def __post_init__(self) -> None:
        self.places = pa.array(self.words, pa.binary()).view(pa.string())
        kinds = shapes(self.places)
        own = np.arange(len(self.words)) < OWN
        #: the model's token of each frequent word
        self.token = np.where(own, np.arange(len(self.words)), OWN + kinds).astype(np.int32)
        # these have a zero more, which place -1 gives
        self.seen = np.append(self.counts > 0, False)
        self.log_count = np.append(np.log10(self.counts + ADD), 0.0)
        self.shape_norm = np.log10(self.shape_tokens + ADD * (self.shape_words + 1))
        #: log10 probability inside the shape class, zero for the model's own words
        self.inside = np.append(np.where(own, 0.0, self.log_count[:-1] - self.shape_norm[kinds]), 0.0)
        self.norm = float(np.log10(self.total + ADD * (self.distinct + 1)))


def _sigmoid(x: np.ndarray) -> None:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def _lowered(bias: np.ndarray, pull: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Biases less a bound of the logits, and whether it is close to the largest logit of every row.

    ``pull`` bounds what the hidden units add to each logit.
    """
    return bias - (bias + pull).max(axis=-1, keepdims=True), 2 * pull.max(axis=-1) < NEAR


class Net:
    """Weights in one vector, with a view for each part."""

    SHAPES_OF = {
        "x": (OWN + SHAPES, 3 * HIDDEN),
        "u": (HIDDEN, 3 * HIDDEN),
        "vc": (HIDDEN, CLASSES + SHAPES),
        "bc": (CLASSES + SHAPES,),
        "w": (CLASSES, HIDDEN, MEMBERS),
        "bw": (CLASSES, MEMBERS),
    }

    def __init__(self, flat: np.ndarray):
        self.flat, self.rooms, at = flat, {}, 0
        for name, dims in self.SHAPES_OF.items():
            size = int(np.prod(dims))
            setattr(self, name, flat[at : at + size].reshape(dims))
            at += size

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(d)) for d in cls.SHAPES_OF.values())

    @classmethod
    def start(cls, lexicon: Lexicon, seed: int = 5) -> Net:
        """Small random weights, and biases that give the words' plain shares."""
        net = cls((np.random.default_rng(seed).standard_normal(cls.size()) * 0.1).astype(np.float32))
        net.x[:, : 2 * HIDDEN] *= 0.5
        net.u *= 10 / np.sqrt(HIDDEN)
        share = np.zeros(OWN)
        share[: min(OWN, len(lexicon.counts))] = lexicon.counts[:OWN] + ADD
        member = share.reshape(MEMBERS, CLASSES).T  # word i is member i // CLASSES of class i % CLASSES
        net.bc[:] = np.log(np.concatenate((member.sum(axis=1), lexicon.shape_tokens + ADD)) + ADD)
        net.bw[:] = np.where(member > 0, np.log(np.maximum(member, 1e-30)), -30)
        return net

    def room(self, name: str, *shape: int) -> np.ndarray:
        """Memory for what lives no longer than a window, used again: new pages cost as much as the work on them."""
        size, held = math.prod(shape), self.rooms.get(name)
        if held is None or len(held) < size:
            held = self.rooms[name] = np.empty(size, np.float32)
        return held[:size].reshape(shape)

    def states(self, before: np.ndarray, keep: np.ndarray, h: np.ndarray):
        """Run the unit over a window; ``keep`` is 0 where a text begins.

        Inside, units come before lanes, so that each gate is one piece of memory.
        """
        steps, lanes = before.shape
        given = np.take(self.x, before, axis=0, out=self.room("given", steps, lanes, 3 * HIDDEN), mode="clip")
        gates = self.room("gates", steps, 3 * HIDDEN, lanes)
        gates[:] = given.transpose(0, 2, 1)
        was, inner, out = (self.room(name, steps, HIDDEN, lanes) for name in ("was", "inner", "out"))
        pull, h = np.ascontiguousarray(self.u.T), np.array(h.T, order="C")
        for t in range(steps):
            np.multiply(h, keep[t], out=was[t])
            pulled = pull @ was[t]
            both, n = gates[t, : 2 * HIDDEN], gates[t, 2 * HIDDEN :]
            both += pulled[: 2 * HIDDEN]
            _sigmoid(both)
            inner[t] = pulled[2 * HIDDEN :]
            n += both[HIDDEN:] * inner[t]
            n *= 2  # tanh, by a quicker way
            _sigmoid(n)
            n *= 2
            n -= 1
            h = out[t]
            np.subtract(was[t], n, out=h)
            h *= both[:HIDDEN]
            h += n
        hidden = self.room("hidden", steps, lanes, HIDDEN)
        hidden[:] = out.transpose(0, 2, 1)
        return hidden, (was, gates, inner), h.T.copy()

    def _softmax(self, hidden: np.ndarray, weights: np.ndarray, bias: np.ndarray, near: bool):
        """Logits less a number that none exceeds, their exponentials and the sums of these.

        Where the bound that is taken off the ``bias`` is ``near``, it serves all rows; else each row takes its own largest.
        """
        shape = len(hidden), weights.shape[1]
        logits = np.matmul(hidden, weights, out=self.room("logits", *shape))
        logits += bias
        if not near:
            logits -= logits.max(axis=1, keepdims=True)
        p = np.exp(logits, out=self.room("p", *shape))
        return logits, p, p @ _ONES[: shape[1]]

    def output(self, hidden: np.ndarray, target: np.ndarray, grad: Net | None = None, weight: np.ndarray | None = None):
        """Natural log probability of each target; with ``grad`` also the loss's gradients."""
        slots = target // CLASSES
        kind = np.where(target < OWN, target - slots * CLASSES, target - OWN + CLASSES)
        rows, ones = np.arange(len(target)), np.ones(len(target), np.float32)
        largest = np.abs(hidden).max(initial=0)
        logits, p, sums = self._softmax(hidden, self.vc, *_lowered(self.bc, largest * np.abs(self.vc).sum(axis=0)))
        out = logits[rows, kind] - np.log(sums)
        back = None
        if grad is not None:
            p *= (weight / sums)[:, None]
            p[rows, kind] -= weight
            grad.vc += hidden.T @ p
            grad.bc += ones @ p
            back = np.matmul(p, self.vc.T, out=self.room("back", len(p), HIDDEN))
        # the model's own words, class by class
        order = np.argsort(kind.astype(np.uint8), kind="stable")
        ends = np.searchsorted(kind[order], np.arange(CLASSES + 1))
        order = order[: ends[-1]]
        near = np.take(hidden, order, axis=0, out=self.room("near", len(order), HIDDEN), mode="clip")
        slots = slots[order]
        picked, totals = np.empty(len(order), np.float32), np.empty(len(order), np.float32)
        if grad is not None:
            shares, added = weight[order], self.room("added", *near.shape)
        bias, close = _lowered(self.bw, largest * np.abs(self.w).sum(axis=1))
        for c in range(CLASSES):
            at = slice(ends[c], ends[c + 1])
            h, slot = near[at], slots[at]
            if not len(h):
                continue
            logits, p, sums = self._softmax(h, self.w[c], bias[c], close[c])
            picked[at], totals[at] = logits[rows[: len(h)], slot], sums
            if grad is not None:
                p *= (shares[at] / sums)[:, None]
                p[rows[: len(h)], slot] -= shares[at]
                grad.w[c] += h.T @ p
                grad.bw[c] += ones[: len(h)] @ p
                np.matmul(p, self.w[c].T, out=added[at])
        out[order] += picked - np.log(totals)
        if grad is not None:
            back[order] += added
        return out, back

    def learn(self, before, keep, target, weight, h, grad: Net):
        """Gradients of one window by backpropagation that stops at its start; returns the state after it."""
        out, (was, gates, inner), h = self.states(before, keep, h)
        scale = np.float32(1 / max(1.0, weight.sum()))
        _, back = self.output(out.reshape(-1, HIDDEN), target.ravel(), grad, (weight * scale).ravel())
        shape = steps, _, lanes = was.shape
        later_back = self.room("later", *shape)
        later_back[:] = back.reshape(steps, lanes, HIDDEN).transpose(0, 2, 1)
        z, r, n = gates[:, :HIDDEN], gates[:, HIDDEN : 2 * HIDDEN], gates[:, 2 * HIDDEN :]
        to_z, to_r, to_n, spare = (self.room(name, *shape) for name in ("to_z", "to_r", "to_n", "spare"))
        np.subtract(1, z, out=spare)
        np.subtract(was, n, out=to_z)
        to_z *= z
        to_z *= spare
        np.multiply(n, n, out=to_n)
        np.subtract(1, to_n, out=to_n)
        to_n *= spare
        np.subtract(1, r, out=to_r)
        to_r *= r
        to_r *= inner
        pulled, inmost = self.room("pulled", *gates.shape), spare
        later = np.zeros_like(was[0])
        for t in range(len(before) - 1, -1, -1):
            d, dn, p = later, inmost[t], pulled[t]
            d += later_back[t]
            np.multiply(d, to_n[t], out=dn)
            np.multiply(d, to_z[t], out=p[:HIDDEN])
            np.multiply(dn, to_r[t], out=p[HIDDEN : 2 * HIDDEN])
            np.multiply(dn, r[t], out=p[2 * HIDDEN :])
            d *= z[t]
            d += self.u @ p
            d *= keep[t]
        grad.u += (was @ pulled.transpose(0, 2, 1)).sum(axis=0)
        pulled[:, 2 * HIDDEN :] = inmost
        flat = before.ravel().astype(np.uint16)  # stable sorts of short integers go by digits
        order = np.argsort(flat, kind="stable")
        first = np.flatnonzero(np.diff(flat[order].astype(np.int32), prepend=-1))
        rows = self.room("given", steps, lanes, 3 * HIDDEN)
        rows[:] = pulled.transpose(0, 2, 1)
        given = np.take(rows.reshape(-1, 3 * HIDDEN), order, axis=0, out=gates.reshape(-1, 3 * HIDDEN), mode="clip")
        grad.x[flat[order][first]] += np.add.reduceat(given, first)
        return h


class Trainer:
    """Adam on one copy of the weights; texts lie end to end on lanes that are read whole."""

    def __init__(self, flat: np.ndarray):
        self.net, self.grad = Net(flat.copy()), Net(np.zeros_like(flat))
        self.mean, self.square, self.steps = np.zeros_like(flat), np.zeros_like(flat), 0
        self.held, self.load = [deque() for _ in range(TRAIN_LANES)], np.zeros(TRAIN_LANES, np.int64)
        self.h, self.spare = np.zeros((TRAIN_LANES, HIDDEN), np.float32), np.empty_like(flat)

    def add(self, text: np.ndarray) -> None:
        """Lay a text's tokens on the shortest lane; lanes that all reach far enough are read on."""
        lane = int(self.load.argmin())
        inside = np.arange(len(text)) > 0
        self.held[lane].append(np.stack((text, np.concatenate(([0], text[:-1])), inside)).astype(np.int32))
        self.load[lane] += len(text)
        if (least := int(self.load.min())) >= AHEAD:
            self.read(least // STEPS * STEPS)

    def finish(self) -> None:
        """Read what is left, to the end of the longest lane."""
        while self.load.any():
            self.read(min(int(self.load.max()), AHEAD))

    def read(self, count: int) -> None:
        """Train on the next ``count`` tokens of every lane in consecutive windows, the state carried on."""
        order = np.argsort(-self.load, kind="stable")
        loads = np.minimum(self.load[order], count)
        rows = np.zeros((3, count, TRAIN_LANES), np.int32)
        for k, lane in enumerate(order):
            at, held = 0, self.held[lane]
            while at < loads[k]:
                part = held.popleft()
                taken = part[:, : loads[k] - at]
                rows[:, at : at + taken.shape[1], k] = taken
                at += taken.shape[1]
                if taken.shape[1] < part.shape[1]:
                    held.appendleft(part[:, taken.shape[1] :])
        h, alive, inside = self.h[order], (np.arange(count)[:, None] < loads).astype(np.float32), rows[2].astype(np.float32)
        for low in range(0, count, STEPS):
            at = np.s_[low : low + STEPS, : int((loads > low).sum())]
            h[: at[1].stop] = self.net.learn(rows[1][at], inside[at], rows[0][at], alive[at], h[: at[1].stop], self.grad)
            self.step()
        self.h[order] = h
        self.load[order] -= loads

    def step(self) -> None:
        """``mean`` and ``square`` are kept as plain decayed sums, 10 and 100 times the means."""
        g, spare, self.steps = self.grad.flat, self.spare, self.steps + 1
        size = float(np.sqrt(g @ g))
        if size > 1:
            g *= 1 / size
        self.mean *= 0.9
        self.mean += g
        g *= g
        self.square *= 0.99
        self.square += g
        rate = RATE * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps) * min(1.0, self.steps / 20)
        np.sqrt(self.square, out=spare)
        spare += 1e-5
        np.divide(self.mean, spare, out=spare)
        spare *= rate
        self.net.flat -= spare
        g[:] = 0


class Lanes:
    """Texts laid end to end on lanes of similar length, walked in windows of all lanes."""

    def __init__(self, lengths: list[int], lanes: int):
        starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
        order = np.argsort(-np.array(lengths), kind="stable")
        self.count = max(1, min(lanes, len(lengths)))
        load, held = np.zeros(self.count, np.int64), [[] for _ in range(self.count)]
        for text in order:
            lane = int(load.argmin())
            held[lane].append(text)
            load[lane] += lengths[text]
        by_load = np.argsort(-load, kind="stable")
        self.load = load[by_load]
        self.at = [np.concatenate([np.arange(starts[t], starts[t] + lengths[t]) for t in held[k]]) for k in by_load]
        self.inside = np.ones(int(self.load.sum()), np.float32)
        self.inside[starts] = 0

    def windows(self, steps: int):
        """(token positions, 0 where a text begins else 1, 1 where there is a token) for each window."""
        for low in range(0, int(self.load[0]), steps):
            lanes = int(np.searchsorted(-self.load, -low, side="left"))
            high = min(low + steps, int(self.load[0]))
            at, alive = np.zeros((high - low, lanes), np.int64), np.zeros((high - low, lanes), np.float32)
            for k in range(lanes):
                part = self.at[k][low:high]
                at[: len(part), k], alive[: len(part), k] = part, 1
            yield at, self.inside[at], alive


def log_probabilities(net: Net, texts: list[np.ndarray]) -> np.ndarray:
    """Sum of log10 probabilities of each text's tokens, read from start to end."""
    lengths = [len(t) for t in texts]
    tokens, owner = np.concatenate(texts), np.repeat(np.arange(len(texts)), lengths)
    before = np.concatenate(([0], tokens[:-1]))
    before[np.cumsum([0, *lengths[:-1]])] = 0  # the end of a text stands before its first word
    lanes = Lanes(lengths, LANES)
    h, sums = np.zeros((lanes.count, HIDDEN), np.float32), np.zeros(len(texts))
    for at, keep, alive in lanes.windows(SCORE_STEPS):
        out, _, h = net.states(before[at], keep, h[: at.shape[1]])
        there = alive.ravel() > 0
        places = at.ravel()[there]
        logs, _ = net.output(out.reshape(-1, HIDDEN)[there], tokens[places])
        sums += np.bincount(owner[places], logs, len(texts))
    return sums / np.log(10)


def held_out() -> Column:
    return F.pmod(id_crc("doc_id"), F.lit(10)) == 0


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` over all texts, ends included; each task sums before it hands on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, 0):
            seen = pc.value_counts(words(piece.column(0))[0])
            word, n = seen.field("values").cast(pa.binary()), seen.field("counts")
            filled = pc.not_equal(pc.binary_length(word), 0)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([word.filter(filled), pa.array([END], pa.binary())]), pa.concat_arrays([n.filter(filled), pa.array([piece.num_rows], pa.int64())])],
                ["word", "n"],
            )

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def lexicon(counts: DataFrame) -> Lexicon:
    """The broadcast part of ``counts``: at most FREQUENT words, chosen by a count that few exceed."""
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    short = counts.where((F.octet_length("word") <= LONGEST) & (F.octet_length("word") > 0))
    step = F.floor(F.log2("n") * 8).cast("int")  # at most 512 steps
    least, held = 1 << 30, 0
    for row in sorted(short.groupBy(step.alias("step")).count().collect(), key=lambda r: -r["step"]):
        if held + row["count"] > FREQUENT:
            break
        least, held = row["step"], held + row["count"]
    rows = short.where(step >= least).collect() if held else []
    rows = sorted(((-r["n"], bytes(r["word"])) for r in rows))
    ends = counts.where(F.octet_length("word") == 0).first()
    found = [END] + [w for _, w in rows]
    numbers = np.array([ends["n"] if ends else 0] + [-n for n, _ in rows], np.int64)
    own = pa.array(found[:OWN], pa.binary())

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            others = batch.filter(pc.invert(pc.is_in(batch.column(0), value_set=own)))
            kind, tokens = shapes(others.column(0)), np.zeros(SHAPES, np.int64)
            np.add.at(tokens, kind, others.column(1).to_numpy())
            kinds = np.bincount(kind, minlength=SHAPES)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(SHAPES)), pa.array(tokens), pa.array(kinds)], ["shape", "tokens", "words"])

    tokens, kinds = np.zeros(SHAPES), np.zeros(SHAPES)
    for row in counts.mapInArrow(sums, "shape long, tokens long, words long").groupBy("shape").agg(F.sum("tokens").alias("t"), F.sum("words").alias("w")).collect():
        tokens[row["shape"]], kinds[row["shape"]] = row["t"], row["w"]
    return Lexicon(found, numbers, total, distinct, tokens, kinds)


def train(docs: DataFrame, lex: Lexicon) -> np.ndarray:
    """Weights after ROUNDS of parallel training on ``docs``, the training split."""
    flat = Net.start(lex).flat
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(lex)
    for turn in range(ROUNDS):
        given = context.broadcast(flat)

        def run(batches: Iterator[pa.RecordBatch], given=given) -> Iterator[pa.RecordBatch]:
            trainer, tokens = Trainer(given.value), 0
            for batch in pieces(batches, 0):
                ids, _, ends, _ = _tokens(shared.value, batch.column(0))
                for text in np.split(ids, ends[:-1]):
                    trainer.add(text)
                tokens += len(ids)
            trainer.finish()
            if tokens:
                part = TaskContext.get().partitionId() % GROUPS
                values = np.array_split(trainer.net.flat.astype(np.float64) * tokens, PIECES)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(PIECES)), pa.array([part] * PIECES), pa.array([float(tokens)] * PIECES), pa.array([v.tobytes() for v in values], pa.binary())],
                    ["piece", "part", "tokens", "sums"],
                )

        def add(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["part", "tokens"], kind="stable")
            total = sum(np.frombuffer(v, np.float64) for v in rows["sums"])
            return pd.DataFrame({"piece": [rows["piece"].iloc[0]], "part": [0], "tokens": [rows["tokens"].sum()], "sums": [total.tobytes()]})

        kind = "piece long, part long, tokens double, sums binary"
        mine = docs.where(F.pmod(F.floor(id_crc("doc_id") / 10), F.lit(ROUNDS)) == turn).select(F.col("text").cast("string"))
        summed = mine.mapInArrow(run, kind).groupBy("piece", "part").applyInPandas(add, kind).groupBy("piece").applyInPandas(add, kind)
        rows = sorted(summed.collect(), key=lambda r: r["piece"])
        if rows:
            flat = (np.concatenate([np.frombuffer(r["sums"], np.float64) for r in rows]) / rows[0]["tokens"]).astype(np.float32)
    return flat


def _tokens(lex: Lexicon, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Texts end to end, each closed by END: the model's tokens, their places in the lexicon (-1: not frequent),
    where each text ends, and the words that are not frequent."""
    parts, starts = words(texts)
    found = pc.index_in(parts, value_set=lex.places).fill_null(-1).to_numpy()
    filled = found != 0  # an empty word has the place of END
    ends = np.concatenate(([0], np.cumsum(filled)))[starts[1:]] + np.arange(1, len(texts) + 1)
    inside = np.ones(len(texts) + int(filled.sum()), bool)
    inside[ends - 1] = False
    at = np.zeros(len(inside), np.int32)
    at[inside] = found[filled]
    rare = parts.filter(pa.array(found < 0))
    tokens = lex.token[at]
    tokens[at < 0] = OWN + shapes(rare)
    return tokens, at, ends, rare


def _per_text(owner: np.ndarray, rare: pa.Array, count: int) -> list[pa.Array]:
    """Lists of the different words of each text, and how often each is there."""
    code = rare.dictionary_encode()
    size = max(1, len(code.dictionary))
    key, times = np.unique(owner * size + code.indices.to_numpy(), return_counts=True)
    bounds = pa.array(np.searchsorted(key, np.arange(count + 1) * size), pa.int32())
    found = code.dictionary.cast(pa.binary()).take(pa.array(key % size))
    return [pa.ListArray.from_arrays(bounds, values) for values in (found, pa.array(times, pa.int64()))]


def score(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row of ``docs``.

    Rows whose id's crc32 is divisible by 10 are held out, all others teach (a null
    id counts as the empty text).  A null or empty text is its end alone.  With
    nothing to learn from, the base gives every token probability 1.  Repeated
    rows stay, an empty table gives no rows, other columns are not read.
    """
    taught = docs.where(~held_out())
    counts = stored(count_words(taught), "counts")
    lex = lexicon(counts)
    flat = docs.sparkSession.sparkContext.broadcast(train(taught, lex))
    shared = docs.sparkSession.sparkContext.broadcast(lex)
    names = ["row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "rare", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, net, number = shared.value, Net(flat.value), TaskContext.get().partitionId() << 33
        for piece in pieces(batches, 2):
            count = piece.num_rows
            tokens, at, ends, rare = _tokens(lex, piece.column(2))
            starts = np.concatenate(([0], ends[:-1]))
            others = np.flatnonzero(at < 0)
            owner = np.searchsorted(ends, others, side="right")
            norms = np.bincount(owner, lex.shape_norm[tokens[others] - OWN], count)
            sums = [np.add.reduceat(part[at], starts) for part in (lex.seen.astype(np.int64), lex.log_count, lex.inside)]
            texts, scores = np.split(tokens, ends[:-1]), []
            for group in np.split(np.arange(count), np.flatnonzero(np.diff(starts // BATCH)) + 1):
                scores.append(log_probabilities(net, texts[group[0] : group[-1] + 1]))
            columns = [number + np.arange(count), piece.column(0), piece.column(1), ends - starts, sums[0], sums[1], np.concatenate(scores) + sums[2] - norms]
            yield pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns] + _per_text(owner, rare, count), names)
            number += count

    given = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), F.col("text").cast("string"))
    marked = stored(
        given.mapInArrow(run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, rare array<binary>, times array<long>"),
        "scored",
    )
    pairs = marked.select(F.col("row").alias("of_row"), F.explode(F.arrays_zip("rare", "times")).alias("x")).select("of_row", "x.rare", "x.times")
    found = pairs.join(counts, F.col("rare") == F.col("word"), "left").groupBy("of_row").agg(
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + ADD)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    joined = marked.drop("rare", "times").join(found, F.col("row") == F.col("of_row"), "left")
    more = F.coalesce("more", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(lex.total).cast("long").alias("train_tokens"),
        (F.col("base") + more - F.col("n_tokens") * F.lit(lex.norm)).alias("base_score"),
        (F.col("score") + more).alias("score"),
    )
