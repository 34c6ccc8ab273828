import math
import random

import numpy as np
import pytest

from ticketlake.llm.whitening import bidiagonalise, whiten

SCHEMA = "vec_id long, embedding array<float>, label int, x string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", "n") for i, v in rows], SCHEMA)


def brute(rows):
    """(vec_id, x) of the usable rows, exact deviations, eigenvalues and vectors."""
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100000 for c in v] for _, v in good]
    n, total = len(x), [sum(c) for c in zip(*x, strict=True)]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(v, total, strict=True)) for v in x]
    centred = np.array(x, float) - np.array([s / n for s in total])
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in good], deviation, centred, value[::-1], vector[:, ::-1]


def vectors(n, d, seed):
    r = random.Random(seed)
    scale = [1.2 ** -k for k in range(d)]
    return [(i, [r.gauss(0.1, 1) * s for s in scale]) for i in range(n)]


@pytest.mark.parametrize("block", [8, 1, 3])
def test_against_brute_force(spark, block):
    rows = vectors(300, 20, 1)
    rows += [(900, None), (901, []), (902, [None] + [1.0] * 19), (903, [float("nan")] * 20), (904, [float("inf")] + [0.0] * 19),
             (905, [1.0, 2.0]), (None, rows[0][1]), (7, rows[7][1])]
    usable = [r for r in rows if r[0] != 905]
    ids, deviation, centred, value, vector = brute(usable)
    got = whiten(frame(spark, rows), block=block).collect()
    assert len(got) == 8 * len(ids) and {r.n for r in got} == {len(ids)}
    assert sorted((str(r.vec_id), r.deviation) for r in got if r.component == 1) == sorted(zip(map(str, ids), deviation, strict=True))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-9
    for k in range(8):
        mine = sorted((str(r.vec_id), r.deviation, r.whitened) for r in got if r.component == k + 1)
        own = centred @ vector[:, k] / math.sqrt(value[k])
        want = [w for *_, w in sorted(zip(map(str, ids), deviation, own, strict=True))]
        sign = np.sign(np.dot([w for *_, w in mine], want))
        assert np.allclose([sign * w for *_, w in mine], want, rtol=0, atol=1e-9)
        e = {r.explained for r in got if r.component == k + 1}
        assert len(e) == 1 and abs(e.pop() / (value[k] / value.sum()) - 1) < 1e-9


def test_fewer_dimensions_than_components(spark):
    rows = vectors(50, 3, 2)
    got = whiten(frame(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2, 3} and len(got) == 150
    assert abs(sum({r.explained for r in got}) - 1) < 1e-9


def test_no_variance_gives_no_rows(spark):
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, [0.5, 0.25])])).count() == 0
    assert whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(20)])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    # on a line: one component
    line = whiten(frame(spark, [(i, [i / 4, i / 2, 1.0]) for i in range(9)])).collect()
    assert {r.component for r in line} == {1} and abs(line[0].explained - 1) < 1e-12


def test_extreme_entries(spark):
    rows = [(i, [float(i % 3), float(i % 5) / 2]) for i in range(30)] + [(99, [3e30, 1.0])]
    got = whiten(frame(spark, rows)).collect()
    by = {r.vec_id: r for r in got if r.component == 1}
    assert by[99].deviation is None and all(math.isfinite(r.whitened) for r in got)


def test_equal_deviations_are_all_found():
    r = np.random.default_rng(0)
    q = np.linalg.qr(r.standard_normal((400, 60)))[0]
    x = q * np.r_[np.full(6, 5.0), np.full(54, 1.0)]
    value, vector = bidiagonalise(lambda w: x.T @ (x @ w), 60)
    assert np.allclose(value, [5] * 6 + [1] * 2) and np.allclose(np.abs(vector[6:, :6]), 0, atol=1e-12)


def test_wide_vectors_stop_when_converged():
    r = np.random.default_rng(1)
    x = r.standard_normal((500, 400)) * 0.9 ** np.arange(400)
    passes = []

    def back(w):
        passes.append(w.shape[1])
        return x.T @ (x @ w)

    value, vector = bidiagonalise(back, 400)
    want, basis = np.linalg.eigh(x.T @ x)
    assert np.allclose(value ** 2, want[::-1][:8], rtol=1e-12) and sum(passes) < 200
    assert np.allclose(np.abs((vector * basis[:, ::-1][:, :8]).sum(axis=0)), 1, atol=1e-12)
