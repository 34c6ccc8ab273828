import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from ticketlake.llm import lm

from .frames import documents, edge_texts, empty, words


def test_base_score_and_edges(spark):
    docs = edge_texts() + [(100 + i, words(30 + i % 40, i, 60)) for i in range(60)] + [(300, "Never seen words"), (301, "w1a w1a never")]
    learn = [(i, t) for i, t in docs if i is not None and zlib.crc32(str(i).encode()) % 7 != 2]
    tok = lambda t: [*(t or "").encode().lower().split(), b""]
    c = Counter(x for _, t in learn for x in tok(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for i, t in docs:
        w = tok(t)
        want[(str(i), len(w), sum(x in c for x in w), n, round(sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w), 6))] += 1
    got = lm.score_documents(documents(spark, docs), documents(spark, learn), share=2, held=80, vocabulary=20).collect()
    assert Counter((str(r.doc_id), r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    assert lm.score_documents(empty(spark), documents(spark, learn), share=2).count() == 0


def test_nothing_to_learn(spark):
    got = lm.score_documents(documents(spark, [(1, "a b"), (2, None)]), empty(spark)).collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got) == [(1, 0, 0, 0.0), (3, 0, 0, 0.0)]


def small_net():
    return lm.Network(np.array([50, 30, 20, 10, 5, 5, 3, 2]), 12.0, width=5, classes=3, seed=1)


def test_probabilities_sum_to_one():
    net = small_net()
    h = np.random.default_rng(0).normal(0, 1, (1, 5)).astype(np.float32)
    assert math.isclose(sum(math.exp(net.output(h, np.array([s]))[0]) for s in range(9)), 1, abs_tol=1e-5)


def test_state_is_carried_over_windows():
    net = small_net()
    r = random.Random(3)
    texts = [np.array([r.randrange(9) for _ in range(n)]) for n in (1, 7, 50, 3, 20, 1, 33)]

    def alone(x):
        h, out = np.zeros((1, 5), np.float32), 0.0
        for s in x:
            out += net.output(h, np.array([s]))[0]
            h, _ = net.step(h, np.array([s]))
        return out

    for lanes, window in ((1, 4), (3, 5), (16, 64)):
        assert np.allclose(lm.score_texts(net, texts, lanes, window), [alone(x) for x in texts], atol=1e-3)


def test_one_very_long_text_costs_its_own_length():
    import tracemalloc
    net = small_net()
    texts = [np.zeros(400_000, np.int32)] + [np.ones(3, np.int32)] * 255
    dealt = lm.Lanes(texts, 256)
    assert sum(x.nbytes for x in dealt.symbols) < 2_000_000
    tracemalloc.start()
    got = lm.score_texts(net, [t[:20_000] for t in texts])
    assert tracemalloc.get_traced_memory()[1] < 30_000_000
    tracemalloc.stop()
    assert np.allclose(got[1:], got[1]) and np.isfinite(got).all()


def test_gradients_by_differences():
    net = small_net()
    h = np.random.default_rng(1).normal(0, 1, (6, 5)).astype(np.float32)
    s = np.array([0, 1, 4, 8, 7, 2])
    _, back, grads = net.output(h, s, gradient=True)
    loss = lambda: -net.output(h.astype(np.float64), s).sum()
    e = 1e-3
    for i, j in ((0, 0), (3, 2), (5, 4)):
        h[i, j] += e
        up = loss()
        h[i, j] -= 2 * e
        down = loss()
        h[i, j] += e
        assert abs((up - down) / (2 * e) - back[i, j]) < 1e-2
    net.p["wc"][1, 1] += e
    up = loss()
    net.p["wc"][1, 1] -= 2 * e
    assert abs((up - loss()) / (2 * e) - grads["wc"][1, 1]) < 2e-2


def test_training_lowers_the_loss_of_held_out_texts():
    r = random.Random(5)
    follow = {s: [(s * 3 + k) % 9 for k in (1, 2)] for s in range(9)}

    def text(n):
        out = [r.randrange(9)]
        while len(out) < n:
            out.append(r.choice(follow[out[-1]]))
        return np.array(out)

    net, held = small_net(), [text(40) for _ in range(20)]
    before = lm.score_texts(net, held).sum()
    for _ in range(8):
        lm.train_texts(net, [text(60) for _ in range(60)])
    assert lm.score_texts(net, held).sum() > 0.8 * before


def test_a_training_window_takes_many_symbols(monkeypatch):
    r = random.Random(9)
    net, calls, output = small_net(), [], lm.Network.output
    monkeypatch.setattr(lm.Network, "output", lambda *a, **k: calls.append(1) or output(*a, **k))
    texts = [np.array([r.randrange(9) for _ in range(300)], np.uint16) for _ in range(400)]
    assert lm.train_texts(net, texts) == 120_000
    assert len(calls) <= 30                               # each window costs the same again for all classes


def test_sums_by_symbol():
    r = np.random.default_rng(4)
    symbol, rows = np.concatenate([np.zeros(90, int), r.integers(0, 40, 200), [70_000]]), r.normal(0, 1, (291, 6))
    got, sums = lm.sums_by_symbol(symbol, rows)
    assert sorted(got) == sorted(set(symbol.tolist()))
    for s, v in zip(got, sums, strict=True):
        assert np.allclose(v, rows[symbol == s].sum(axis=0))


def test_split_texts_as_bytes_do():
    r = random.Random(8)
    odd = [bytes(r.choice(b"\t\n\x0b\x0c\r\x1c\x1d\x1f  AZaz\x85\xa0\xc3\x84\xff") for _ in range(r.randrange(25))) for _ in range(500)]
    for texts in (odd, [b"", b" ", b" x "], []):
        words, n = lm.split_texts(pa.array([b"cut off", *texts], pa.binary()).slice(1))
        assert words.to_pylist() == [w for t in texts for w in t.lower().split()]
        assert n.tolist() == [len(t.split()) for t in texts]


def test_tokens_that_no_worker_holds(spark):
    docs = documents(spark, [(1, " a b"), (2, None), (3, "a c c")])
    got = lm.score_documents(docs, documents(spark, [(1, "a b"), (2, "")]), held=0).collect()
    want = {1: math.log10(2 / 8) * 2 + math.log10(3 / 8), 2: math.log10(3 / 8), 3: math.log10(2 / 8) + 2 * math.log10(1 / 8) + math.log10(3 / 8)}
    assert {r.doc_id: (r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got} == {
        1: (3, 3, 4, round(want[1], 6)), 2: (1, 1, 4, round(want[2], 6)), 3: (4, 2, 4, round(want[3], 6))}


def test_average(spark):
    rows = [(0, 1.0, np.array([1, 2], np.float32).tobytes()), (0, 3.0, np.array([5, 2], np.float32).tobytes()), (1, 2.0, np.array([9], np.float32).tobytes())]
    assert lm.average(spark.createDataFrame(rows, "chunk int, weight double, values binary")).tolist() == [4.0, 2.0, 9.0]


def test_every_training_document_trains_the_network(spark):
    rows = documents(spark, [(7 if i % 3 else i, words(20 + i % 30, i, 60)) for i in range(90)])
    counts = lm.token_counts(rows)
    for partitions in (1, 5):
        got = lm.learn(rows.repartition(partitions), counts, copies=3, round_tokens=300, vocabulary=40)
        assert got.learned == got.total == counts.agg({"c": "sum"}).first()[0]
        slices = lm.training_symbols(rows.repartition(partitions), spark.sparkContext.broadcast(got), 2, 3).groupBy("round", "copy").count().collect()
        assert len(slices) == 6 and max(r["count"] for r in slices) < 30   # no slice follows the key or the input's partitions
    assert lm.learn(rows, counts, share=3, vocabulary=40).learned < got.total
