import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from millrace.llm import lm


def small_lexicon(n=200, seed=1):
    rng = np.random.default_rng(seed)
    counts = np.sort(rng.integers(1, 1000, n))[::-1]
    return lm.Lexicon([lm.END] + [f"w{i}".encode() for i in range(n - 1)], counts, int(counts.sum()) + 80, n + 8, np.full(8, 10.0), np.full(8, 1.0))


def test_probabilities_sum_to_one():
    lex = small_lexicon()
    net = lm.Net.start(lex)
    net.flat += np.random.default_rng(0).standard_normal(len(net.flat)).astype(np.float32) * 0.1
    hidden = np.random.default_rng(1).standard_normal((1, lm.HIDDEN)).astype(np.float32)
    every = np.arange(lm.OWN + lm.SHAPES)
    logs, _ = net.output(np.repeat(hidden, len(every), axis=0), every)
    assert np.exp(logs.astype(np.float64)).sum() == pytest.approx(1, abs=1e-4)


def test_start_gives_the_plain_shares():
    lex = small_lexicon()
    net = lm.Net.start(lex)
    net.vc[:] = 0
    net.w[:] = 0
    logs, _ = net.output(np.zeros((200, lm.HIDDEN), np.float32), np.arange(200))
    assert np.allclose(np.exp(logs), lex.counts / lex.total, rtol=0.02)


def test_gradients_match_differences():
    rng = np.random.default_rng(3)
    net = lm.Net((lm.Net.start(small_lexicon()).flat * 2).astype(np.float32))
    net.bw[:] = 0
    before, target = rng.integers(0, lm.OWN + 8, (6, 5)), rng.integers(0, lm.OWN + 8, (6, 5))
    keep = (rng.random((6, 5)) > 0.2).astype(np.float32)
    alive = (rng.random((6, 5)) > 0.2).astype(np.float32)
    h = rng.standard_normal((5, lm.HIDDEN)).astype(np.float32)
    grad = lm.Net(np.zeros_like(net.flat))
    net.learn(before, keep, target, alive, h, grad)

    def loss():
        out, _, _ = net.states(before, keep, h)
        logs, _ = net.output(out.reshape(-1, lm.HIDDEN), target.ravel())
        return -float((logs.astype(np.float64) * alive.ravel()).sum()) / alive.sum()

    for name in ("x", "u", "vc", "bc", "w", "bw"):
        part, g = getattr(net, name), getattr(grad, name)
        for at in np.argsort(-np.abs(g), axis=None)[:4]:
            k = np.unravel_index(at, g.shape)
            was = part[k]
            part[k] = was + 0.01
            up = loss()
            part[k] = was - 0.01
            down = loss()
            part[k] = was
            assert g[k] == pytest.approx((up - down) / 0.02, rel=0.05, abs=1e-4), name


def test_state_is_carried_across_windows():
    rng = np.random.default_rng(4)
    net = lm.Net.start(small_lexicon())
    texts = [rng.integers(0, lm.OWN + 8, n).astype(np.int32) for n in (1, 400, 3, 77, 64, 32, 31, 33)]
    for text, got in zip(texts, lm.log_probabilities(net, texts), strict=True):
        before = np.concatenate(([0], text[:-1]))[:, None]
        out, _, _ = net.states(before, np.concatenate(([0], np.ones(len(text) - 1)))[:, None].astype(np.float32), np.zeros((1, lm.HIDDEN), np.float32))
        logs, _ = net.output(out[:, 0], text)
        assert got == pytest.approx(logs.sum() / math.log(10), rel=1e-4)


def plain(rows):
    """The base by its definition: counts of all training tokens."""
    tokens = lambda t: [w.decode("utf-8") for w in (t or "").encode().lower().split()] + [None]
    apart = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    counts = Counter(w for i, t in rows if not apart(i) for w in tokens(t))
    total, v = sum(counts.values()), len(counts)
    out = []
    for i, t in rows:
        all_ = tokens(t)
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (v + 1))) for w in all_)
        out.append((i, apart(i), len(all_), sum(counts[w] > 0 for w in all_), total, base))
    return out


def check(table):
    rows = [(r["doc_id"], r["text"]) for r in table.collect()]
    got = lm.score(table).collect()
    key = lambda r: (str(r[0]), r[2], round(r[5], 3))
    want = sorted(plain(rows), key=key)
    mine = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    assert len(want) == len(mine)
    for a, b in zip(want, mine, strict=True):
        assert a[:5] == b[:5] and b[5] == pytest.approx(a[5], rel=1e-9, abs=1e-6)
    assert all(r["score"] <= 1e-6 and math.isfinite(r["score"]) for r in got)
    return got


def test_given_documents_base_and_held_out_gain(spark, monkeypatch):
    monkeypatch.setattr(lm, "FREQUENT", 3000)
    got = check(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    apart = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in apart) > sum(r["base_score"] for r in apart)


def test_odd_rows(docs):
    rows = [(1, None), (2, ""), (3, "A a\tÀ \x1f b"), (4, "word " * 30000), (None, "null id"), (5, "a a"), (5, "a a"), (10**12, "x" * 100000)]
    table = docs(rows).withColumn("score", F.lit("s")).withColumn("row", F.lit(1))
    check(table)
    assert lm.score(table.limit(0)).count() == 0
    only = [i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0][:3]
    check(docs([(i, "nothing to learn from") for i in only]))


def test_every_token_teaches_with_its_state(monkeypatch):
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, lm.OWN + 8, n).astype(np.int32) for n in [1, 5000, 3, 65, 64, 32, 31, 33] + [700] * 200]
    trainer, seen = lm.Trainer(lm.Net.start(small_lexicon()).flat), []

    def learn(self, before, keep, target, weight, h, grad):
        # the state counts the tokens read of a text
        out = h.copy()
        for t in range(len(before)):
            out = out * keep[t][:, None] + 1
            seen.extend((int(n), int(x), int(y)) for n, x, y, w in zip(out[:, 0], before[t], target[t], weight[t], strict=True) if w)
        return out

    monkeypatch.setattr(lm.Net, "learn", learn)
    for text in texts:
        trainer.add(text)
    trainer.finish()
    want = [(k + 1, int(text[k - 1]) if k else 0, int(x)) for text in texts for k, x in enumerate(text)]
    assert Counter(seen) == Counter(want)


def test_short_documents_teach(docs):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 and zlib.crc32(str(i).encode()) // 101 % 8][:40]
    table = docs([(i, "only a few words") for i in ids])
    lex = lm.lexicon(lm.count_words(table))
    assert (lm.train(table, lex) != lm.Net.start(lex).flat).any()


def test_windows_reuse_their_memory():
    """Windows after the first make no new arrays of a window's size; results do not depend on what was there."""
    rng = np.random.default_rng(6)
    net = lm.Net(lm.Net.start(small_lexicon()).flat)
    grad = lm.Net(np.zeros_like(net.flat))
    before, target = rng.integers(0, lm.OWN + 8, (2, lm.STEPS, 64))
    keep, h = np.ones((lm.STEPS, 64), np.float32), np.zeros((64, lm.HIDDEN), np.float32)
    net.learn(before, keep, target, keep, h, grad)
    first, held = grad.flat.copy(), {k: v.ctypes.data for k, v in net.rooms.items()}
    grad.flat[:] = 0
    net.learn(before[:5, :7], keep[:5, :7], target[:5, :7], keep[:5, :7], h[:7], grad)
    grad.flat[:] = 0
    net.learn(before, keep, target, keep, h, grad)
    assert np.array_equal(grad.flat, first) and {k: v.ctypes.data for k, v in net.rooms.items()} == held


@pytest.mark.parametrize("size", [0.1, 3.0, 30.0])
def test_common_bound_and_own_largest_agree(size):
    """Large weights leave the common bound; both ways give the probabilities of plain double precision."""
    net = lm.Net.start(small_lexicon())
    rng = np.random.default_rng(9)
    net.vc[:], net.w[:] = rng.standard_normal(net.vc.shape) * size, rng.standard_normal(net.w.shape) * size
    hidden, target = np.tanh(rng.standard_normal((500, lm.HIDDEN))).astype(np.float32), rng.integers(0, lm.OWN + 8, 500)
    logs, _ = net.output(hidden, target)
    for h, t, got in zip(hidden.astype(float), target, logs, strict=True):
        parts = [(h @ net.vc + net.bc, t % lm.CLASSES if t < lm.OWN else t - lm.OWN + lm.CLASSES)]
        if t < lm.OWN:
            parts.append((h @ net.w[t % lm.CLASSES] + net.bw[t % lm.CLASSES], t // lm.CLASSES))
        want = sum(x[k] - x.max() - np.log(np.exp(x - x.max()).sum()) for x, k in parts)
        assert got == pytest.approx(want, rel=1e-4, abs=1e-3)


def test_words_of_many_texts_at_once(monkeypatch):
    """Texts are cut and looked up together, without a Python object for each word, as the plain rule cuts them one by one."""
    every = "".join(map(chr, range(300)))
    texts = [None, "", " \t", "W1 w1\nrare  W2 ", every, " Rare rare\x1fRARE \xa0w3\x85 w4.", "w5", *[f"w{i} é{i % 7} É" for i in range(500)]]
    lex, odd = small_lexicon(), pa.array([b"w1 \xff\xfeA w2", b"\xc3"], pa.binary()).view(pa.string())
    batches = [pa.record_batch([pa.array(part, pa.string())], ["text"]) for part in (texts[:3], [], texts[3:6], texts[6:])]
    monkeypatch.setattr(lm, "PIECE", 1000)
    cut = list(lm.pieces(iter([*batches, pa.record_batch([odd], ["text"])]), 0))
    assert len(cut) > 3 and max(len("".join(p.column(0).to_pylist()).encode()) for p in cut[:3]) < 2000
    plain = [(t or "").encode().lower().split() for t in texts] + [b.as_py().lower().split() for b in odd.view(pa.binary())]
    place = {w: k for k, w in enumerate(lex.words)}
    for piece in cut:
        tokens, at, ends, rare = lm._tokens(lex, piece.column(0))
        owner = np.searchsorted(ends, np.flatnonzero(at < 0), side="right")
        kept, times = (a.to_pylist() for a in lm._per_text(owner, rare, piece.num_rows))
        for k, ids in enumerate(np.split(tokens, ends[:-1])):
            mine = plain.pop(0)
            kinds = [(0 if w[-1:].islower() or w[-1] > 127 else 1 if w[-1:] in b".,;:!?" else 2 if w[-1:].isdigit() else 3) + 4 * (not w.isascii()) for w in mine]
            assert ids.tolist() == [place.get(w, lm.OWN + s) for w, s in zip(mine, kinds, strict=True)] + [0]
            assert dict(zip(kept[k], times[k], strict=True)) == Counter(w for w in mine if w not in place)
    assert not plain
