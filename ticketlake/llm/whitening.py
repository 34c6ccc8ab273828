"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows X (n x d) are never gathered. A step takes a few right vectors
v of length d, lets tasks compute u = Xv for their rows and X'u summed over
them, and orthogonalises fully: u against all earlier u, v against all earlier
v. In these two bases X is upper bidiagonal, and the singular value
decomposition of that small matrix gives the components (right vectors) and
the deviations (singular values over sqrt(n)).

The block form is used: vectors are taken BLOCK at a time, as many as
components are asked for, and the entries of the bidiagonal matrix are blocks.
One pass over the rows then serves BLOCK vectors, and equal deviations, of
which a single start vector meets one direction only, are all found.
``block=1`` is the classical form.

A left vector has n entries. It is never stored: every u is X w for some w of
length d, and tasks make it anew from their rows, so a lost executor loses
nothing. Its inner products with the other left vectors follow from X'u, which
is what the step returns. Only vectors of length d reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, table

#: Components asked for, and right vectors of a step.
COMPONENTS = BLOCK = 8
#: x = floor(SCALE * entry) + OFFSET; scaled entries beyond +-LARGEST count as that.
SCALE, OFFSET, LARGEST = 1024, 100_000, 1 << 40
#: A direction with a smaller share of the largest variance is none.
RANK = 1e-13


def usable(rows: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows that the fit list holds (see ``whiten``)."""
    e = F.col("embedding")
    scaled = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST))))
    good = F.forall(e, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    own = rows.select("vec_id", "embedding").where(e.isNotNull() & (F.size(e) > 0) & F.coalesce(good, F.lit(False)))
    return own.select("vec_id", F.transform(e, lambda c: scaled(c) + F.lit(OFFSET)).alias("x"))


def _matrix(batch: pa.RecordBatch, column: int = 0) -> np.ndarray:
    x = batch.column(column)
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _exact_sums(x: np.ndarray) -> list[int]:
    """Column sums of longs, exact at any size."""
    high, low = x >> 20, x & ((1 << 20) - 1)
    return [(int(a) << 20) + int(b) for a, b in zip(high.sum(axis=0), low.sum(axis=0), strict=True)]


def sums(vectors: DataFrame, d: int) -> list[int]:
    """Exact sum of every dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            if batch.num_rows:
                total = [a + b for a, b in zip(total, _exact_sums(_matrix(batch)), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array([str(t) for t in total])], names=["i", "s"])

    rows = (vectors.select("x").mapInArrow(run, "i int, s string")
            .groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())
    out = dict.fromkeys(range(d), 0) | {r["i"]: int(r["s"]) for r in rows}
    return [out[i] for i in range(d)]


class CentredRows:
    """The rows x - mean, spread over the cluster."""

    def __init__(self, vectors: DataFrame, n: int, total: list[int]):
        self.vectors, self.n, self.d = vectors, n, len(total)
        self.mean = np.array([s / n for s in total])

    def _summed(self, partial: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum over all rows of ``partial`` of the centred rows of a batch."""
        mean, size = self.mean, int(np.prod(shape))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(shape)
            for batch in batches:
                if batch.num_rows:
                    total += partial(_matrix(batch) - mean)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int32()), pa.array(total.ravel())], names=["i", "v"])

        rows = self.vectors.select("x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
        out = np.zeros(size)
        out[rows["i"].to_numpy()] = rows["v"].to_numpy()
        return out.reshape(shape)

    def there_and_back(self, w: np.ndarray) -> np.ndarray:
        """X'(Xw): one pass over the rows."""
        return self._summed(lambda x: x.T @ (x @ w), w.shape)

    def square_sum(self) -> float:
        return float(self._summed(lambda x: np.array([(x * x).sum()]), (1,))[0])

    def covariance_of(self, w: np.ndarray) -> np.ndarray:
        """Covariance (divisor n) of the projections Xw."""
        k = w.shape[1]

        def partial(x: np.ndarray) -> np.ndarray:
            y = x @ w
            return np.concatenate([y.T @ y, y.sum(axis=0)[None, :]])

        t = self._summed(partial, (k + 1, k))
        m = t[k] / self.n
        return t[:k] / self.n - np.outer(m, m)


def _orthogonal(v: np.ndarray, to: list[np.ndarray]) -> np.ndarray:
    for _ in range(2):                                         # twice is enough
        for q in to:
            v = v - q @ (q.T @ v)
    return v


def bidiagonalise(there_and_back: Callable[[np.ndarray], np.ndarray], d: int, components: int = COMPONENTS,
                  block: int = BLOCK, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """The largest singular values of X and their right vectors (columns), at
    most ``components``. ``there_and_back(w)`` is X'(Xw).

    A block of equal or missing directions shrinks; its place is taken by new
    random vectors, so the bases grow until the values asked for have
    converged or the right vectors span everything.
    """
    random = np.random.default_rng(seed)
    block = min(block, d)
    v = np.linalg.qr(random.standard_normal((d, block)))[0]
    vs, ws, zs, blocks = [v], [], [], []                       # blocks: (left number, right number, entries)
    while True:
        j = len(vs) - 1
        w = vs[j]
        if j and ws[j - 1].shape[1]:
            above = zs[j - 1].T @ vs[j]                        # u(j-1)' X v(j)
            blocks.append((j - 1, j, above))
            w = w - ws[j - 1] @ above
        z = there_and_back(w)
        for _ in range(2):                                     # u against all earlier u
            for w0, z0 in zip(ws, zs, strict=True):
                c = w0.T @ z
                w, z = w - w0 @ c, z - z0 @ c
        gram = w.T @ z                                         # u'u
        value, turn = np.linalg.eigh((gram + gram.T) / 2)
        largest = max([value[-1], *(np.linalg.norm(b) ** 2 for *_, b in blocks)])
        kept = value > RANK * max(largest, 0) if largest > 0 else np.zeros(len(value), bool)
        root = np.sqrt(value[kept])
        upper = root[:, None] * turn[:, kept].T                # u = Xw = u_new upper
        q, upper = np.linalg.qr(upper) if len(root) else (np.zeros((0, 0)), np.zeros((0, w.shape[1])))
        ws.append(w @ turn[:, kept] / root @ q), zs.append(z @ turn[:, kept] / root @ q)
        blocks.append((j, j, upper))
        # the next right vectors: X'u without what is known
        rest = _orthogonal(zs[j] - vs[j] @ upper.T, vs)
        left, size, _ = np.linalg.svd(rest, full_matrices=False)
        scale = max([np.linalg.norm(b, 2) for *_, b in blocks if b.size] or [0.0])
        new = left[:, size > 1e-14 * scale] if scale else left[:, :0]

        right = np.cumsum([0, *(x.shape[1] for x in vs)])
        rows = np.cumsum([0, *(x.shape[1] for x in ws)])
        small = np.zeros((rows[-1], right[-1]))
        for a, b, entries in blocks:
            small[rows[a]:rows[a + 1], right[b]:right[b + 1]] = entries
        p, value, turn = np.linalg.svd(small)
        asked = min(components, len(value))
        coupling = zs[j].T @ new                               # what the known part of X'u leaves out
        open_ = np.linalg.norm(coupling.T @ p[rows[j]:, :asked], axis=0) if new.size and coupling.size else np.zeros(asked)
        done = asked == components and (open_ <= 1e-14 * scale).all() and right[-1] >= 2 * block
        if done or right[-1] >= d:
            break
        room = min(block, d - right[-1])
        new = _orthogonal(new[:, :room], vs)
        if new.shape[1] < room:
            new = np.concatenate([new, random.standard_normal((d, room - new.shape[1]))], axis=1)
        new = np.linalg.qr(_orthogonal(np.linalg.qr(_orthogonal(new, vs))[0], vs))[0]
        vs.append(new)
    found = value[:asked] > np.sqrt(RANK) * (value[0] if len(value) else 0)
    vectors = (np.concatenate(vs, axis=1) @ turn.T[:, :asked])[:, found]
    for i in range(vectors.shape[1]):                          # either sign would do
        vectors[:, i] *= np.sign(vectors[np.abs(vectors[:, i]).argmax(), i])
    return value[:asked][found], vectors / np.linalg.norm(vectors, axis=0)


def whiten(rows: DataFrame, components: int = COMPONENTS, block: int = BLOCK) -> DataFrame:
    """Rows (vec_id, embedding) whitened: for every row and component ``vec_id,
    component, n, deviation, whitened, explained, identity_error``.

    Rows whose vector is NULL or empty, or holds NULL or non-finite entries,
    are dropped; so are vectors of another length than most (of equally
    frequent lengths the longest stays). Scaled entries beyond 2^40 count as
    2^40; a ``deviation`` that a long cannot hold is NULL. A NULL vec_id stays
    NULL, repeated rows stay repeated and weigh in the fit each time. Of equal
    deviations any basis may come out. There are as many components as the
    rows span, ``components`` at most: one row, equal rows and an empty table
    give no rows. Extra columns are not read.
    """
    spark, out = rows.sparkSession, ("vec_id long, component int, n long, deviation long, whitened double, "
                                     "explained double, identity_error double")
    all_ = usable(rows)
    most = all_.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if not most:
        return spark.createDataFrame([], out)
    d, n = most[0]["d"], most[0]["n"]
    vectors = stored(all_.where(F.size("x") == d).select(F.col("vec_id").cast("long").alias("vec_id"), "x"), "vectors")
    total = sums(vectors, d)
    x = CentredRows(vectors, n, total)
    squares = x.square_sum()
    value, v = bidiagonalise(x.there_and_back, d, components, block) if squares > 0 else (np.zeros(0), np.zeros((d, 0)))
    if not len(value):
        return spark.createDataFrame([], out)
    e = value ** 2 / n
    w = v / np.sqrt(e)
    error = float(np.abs(x.covariance_of(w) - np.eye(len(e))).max())
    explained, mean = e / (squares / n), x.mean
    exact = np.array([s % (1 << 64) for s in total], np.uint64).view(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(e)
        for batch in batches:
            if not batch.num_rows:
                continue
            own = _matrix(batch, 1)
            centred = own - mean
            fits = (centred * centred).sum(axis=1) * float(n) * float(n) < 9.2e18
            with np.errstate(over="ignore"):                   # differences and sums are right modulo 2^64, and fit
                apart = own * np.int64(n) - exact
                deviation = (apart * apart).sum(axis=1)
            again = lambda a: np.repeat(a, k)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(again(np.arange(len(own))))), pa.array(np.tile(np.arange(1, k + 1), len(own)), pa.int32()),
                 pa.array(np.full(len(own) * k, n), pa.int64()), pa.array(again(deviation), pa.int64(), mask=again(~fits)),
                 pa.array((centred @ w).ravel()), pa.array(np.tile(explained, len(own))), pa.array(np.full(len(own) * k, error))],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select("vec_id", "x").mapInArrow(run, out)


def op13(spark, sf_dir):
    return whiten(table(spark, sf_dir, "embeddings"))
