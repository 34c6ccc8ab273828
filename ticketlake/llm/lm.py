"""Document scores of a gated recurrent language model.

Counts of all training tokens come first, as a distributed aggregate. The most
frequent tokens form the network's vocabulary; every other token is the
symbol "rare" followed by its share of the rare tokens (add-one), so the model
gives every text a probability.

The network is a gated recurrent unit with a class-factored softmax: classes
hold about equal shares of the square roots of the counts, a token's
probability is its class's times its own inside the class, and all output
biases start at the logarithms of the counts. It is trained in numpy by
truncated backpropagation through time, on every training document once. The
documents are stored as symbols and dealt, row by row, to rounds of COPIES
slices: each slice trains a copy, and the round's copies are averaged by a
distributed sum (step sizes too). Rounds follow the token count, so a copy
never goes far alone; the number of copies is the same for any input files.

Scoring puts the documents of an Arrow batch into lanes that run in step.
Windows bound the memory; the state goes on from window to window, so a score
is the log-likelihood of the complete document.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, most_frequent, stored, table

#: Network vocabulary, state width, classes; tokens with counts that workers hold.
VOCABULARY, WIDTH, CLASSES, HELD = 8191, 24, 64, 400_000
#: One training document in SHARE trains the network (1: all of them); lanes and
#: steps of a training window; step size; lanes and steps of a scoring window.
SHARE, LANES, STEPS, RATE = 1, 192, 64, 0.2
#: A window's gradients are sums over its symbols, divided by this and then cut off at CLIP.
PER_SYMBOLS, CLIP = 64, 8
#: Copies trained side by side, and about the tokens of each in a round.
COPIES, ROUND_TOKENS = 12, 1 << 20
SCORE_LANES, SCORE_STEPS = 256, 64
#: Sizes up to which exponentials of float32 numbers are summed as they are.
SAFE = 60
#: Steps of lanes laid out at once; rows of the class layer at once; rows of a
#: symbol up to which symbols are summed side by side.
BLOCK_STEPS, ROWS_AT_ONCE, SIDE_BY_SIDE = 512, 2048, 16
#: Tokens of the documents that are put into lanes together.
TOKENS_AT_ONCE = 1 << 21
#: Floats of a row of the distributed average; words a worker counts at once.
CHUNK, COUNT_AT_ONCE = 4096, 1 << 22

#: The end token.
END = b""


def split_texts(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The lower-cased (A-Z) words of all ``texts`` (bytes, none NULL) one after
    the other, and how many each text has. The end that follows each text is not among them."""
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.string())))
    flat = parts.flatten().view(pa.binary())
    word = pc.greater(pc.binary_length(flat), 0)          # white space at either end leaves empty parts
    until = np.concatenate([[0], np.cumsum(word.to_numpy(zero_copy_only=False))])
    offsets = parts.offsets.to_numpy() - parts.offsets[0].as_py()
    return flat.filter(word), np.diff(until[offsets])


def token_counts(docs: DataFrame) -> DataFrame:
    """``token, c`` over all texts of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n_texts, n_words = [], 0, 0

        def flush() -> pa.RecordBatch:
            found = pc.value_counts(pa.chunked_array(held, pa.binary()))
            n = np.append(found.field("counts").to_numpy(), n_texts)
            return pa.RecordBatch.from_arrays([pa.concat_arrays([found.field("values"), pa.array([END], pa.binary())]), pa.array(n, pa.int64())],
                                              names=["token", "n"])

        for batch in batches:
            held.append(split_texts(batch.column(0))[0])
            n_texts, n_words = n_texts + batch.num_rows, n_words + len(held[-1])
            if n_words >= COUNT_AT_ONCE:
                yield flush()
                held, n_texts, n_words = [], 0, 0
        if n_texts:
            yield flush()

    return docs.select(doc_bytes().alias("b")).mapInArrow(run, "token binary, n long") \
               .groupBy("token").agg(F.sum("n").alias("c"))


class Network:
    """Symbols: 0 is "rare", then the vocabulary by descending count."""

    def __init__(self, counts: np.ndarray, rare: float, width: int = WIDTH, classes: int = CLASSES, seed: int = 11):
        rng = np.random.default_rng(seed)
        mass = np.concatenate([[max(rare, 1.0)], counts.astype(float)])
        n = len(mass)
        root = np.sqrt(mass[1:])
        share = (np.cumsum(root) - root / 2) / max(root.sum(), 1e-9)
        self.cls = np.concatenate([[0], 1 + np.unique((share * classes).astype(np.int64), return_inverse=True)[1]])
        self.first = np.flatnonzero(np.diff(self.cls, prepend=-1))          # first symbol of each class
        self.last = np.append(self.first[1:], n)
        k = len(self.first)
        total = np.add.reduceat(mass, self.first)
        small = lambda *s: rng.normal(0, 0.1, s).astype(np.float32)
        self.p = {"x": small(n, 3 * width), "u": small(width, 3 * width), "wc": small(width, k),
                  "bc": np.log(total / total.sum()).astype(np.float32), "w": small(n, width) * np.float32(0.3),
                  "b": np.log(mass / total[self.cls]).astype(np.float32)}
        self.p["x"][:, :width] += 1.0                                      # keep the state at first
        # squared gradients so far (Adagrad), by row for the layers that have a row of each symbol
        self.past = {k: np.full(v.shape if k in ("u", "wc", "bc") else v.shape[:1], 1e-4, np.float32) for k, v in self.p.items()}
        self.width = width

    def flat(self) -> np.ndarray:
        return np.concatenate([v.ravel() for part in (self.p, self.past) for v in part.values()])

    def load(self, flat: np.ndarray) -> None:
        at = 0
        for part in (self.p, self.past):
            for k, v in part.items():
                part[k] = flat[at:at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size

    def inputs(self, symbols: np.ndarray) -> np.ndarray:
        """What the symbols (step x lane) add to the gates, (step x 3 width x lane)."""
        return np.ascontiguousarray(self.p["x"][symbols].transpose(0, 2, 1))

    def advance(self, h: np.ndarray, x: np.ndarray):
        """One step of all lanes, which are columns: (new state, gates for the way back)."""
        d = self.width
        u = self.p["u"].T @ h
        zr = x[:2 * d] + u[:2 * d]
        np.negative(zr, out=zr)
        np.exp(zr, out=zr)
        zr += 1
        np.reciprocal(zr, out=zr)
        z, r, u = zr[:d], zr[d:], u[2 * d:]
        c = r * u
        c += x[2 * d:]
        np.tanh(c, out=c)
        new = h - c
        new *= z
        new += c
        return new, (z, r, c, u)

    def step(self, h: np.ndarray, symbol: np.ndarray):
        """``advance`` with a row for each lane."""
        new, gates = self.advance(h.T, self.inputs(symbol[None])[0])
        return new.T, gates

    def output(self, h: np.ndarray, symbol: np.ndarray, gradient: bool = False):
        """ln P(symbol | state) for each row; with ``gradient`` also the state's
        gradient and those of the output layers. Rows are taken in the order of
        their symbols, so a class's rows are neighbours; in a product they are
        the columns, so sums over classes or symbols run along memory."""
        p, n = self.p, len(symbol)
        order = _in_order(symbol)
        symbol, h = symbol[order], h[order]
        cls, lp = self.cls[symbol], np.zeros(n, h.dtype)
        if gradient:
            back = np.empty_like(h)
            grads = {k: np.zeros_like(p[k]) for k in ("wc", "bc", "w", "b")}
        for i in range(0, n, ROWS_AT_ONCE):
            part, own = h[i:i + ROWS_AT_ONCE], cls[i:i + ROWS_AT_ONCE]
            lp[i:i + ROWS_AT_ONCE], e = _log_softmax(p["wc"].T @ part.T + p["bc"][:, None], own, gradient)
            if gradient:
                np.matmul(e.T, p["wc"].T, out=back[i:i + ROWS_AT_ONCE])
                grads["wc"] += (e @ part).T
                grads["bc"] += e.sum(axis=1)
        bounds = np.searchsorted(cls, np.arange(len(self.first) + 1))
        for k in np.flatnonzero((np.diff(bounds) > 0) & (self.last - self.first > 1)).tolist():
            lo, hi, at = self.first[k], self.last[k], slice(bounds[k], bounds[k + 1])
            w, part = p["w"][lo:hi], h[at]
            inside, e = _log_softmax(w @ part.T + p["b"][lo:hi, None], symbol[at] - lo, gradient)
            lp[at] += inside
            if gradient:
                back[at] += e.T @ w
                np.matmul(e, part, out=grads["w"][lo:hi])
                grads["b"][lo:hi] = e @ np.ones(e.shape[1], e.dtype)
        out = np.empty_like(lp)
        out[order] = lp
        if not gradient:
            return out
        unsorted = np.empty_like(back)
        unsorted[order] = back
        return out, unsorted, grads


def _in_order(symbol: np.ndarray) -> np.ndarray:
    """Rows by symbol; two-byte numbers are sorted by radix."""
    small = len(symbol) and symbol.max() < 1 << 16
    return np.argsort(symbol.astype(np.uint16) if small else symbol, kind="stable")


def _log_softmax(a: np.ndarray, own: np.ndarray, gradient: bool):
    """ln softmax of each column of ``a`` (overwritten) at its row ``own``, and
    the gradient of minus its sum (``gradient``; else of no use)."""
    columns = np.arange(a.shape[1])
    if a.size and (a.max() > SAFE or a.min() < -SAFE):
        a -= a.max(axis=0)
    out = a[own, columns]
    np.exp(a, out=a)
    s = np.ones(len(a), a.dtype) @ a                      # faster than a sum of short rows
    out -= np.log(s)
    if gradient:
        a *= 1 / s
        a[own, columns] -= 1
    return out, a


def sums_by_symbol(symbol: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(distinct symbols, sums of their rows): few rows of many symbols are
    added side by side, many rows of few symbols each by themselves."""
    order = _in_order(symbol)
    symbol, rows = symbol[order], rows[order]
    first = np.flatnonzero(np.diff(symbol, prepend=-1))
    size = np.diff(first, append=len(symbol))
    by_size = np.argsort(-size, kind="stable")
    first, size = first[by_size], size[by_size]
    out = rows[first]
    many = int(np.searchsorted(-size, -SIDE_BY_SIDE, side="left"))
    for i in range(many):
        out[i] = rows[first[i]:first[i] + size[i]].sum(axis=0)
    for k in range(1, SIDE_BY_SIDE):
        n = int(np.searchsorted(-size, -k, side="left"))             # symbols with more than k rows
        if n > many:
            out[many:n] += rows[first[many:n] + k]
    return symbol[first], out


class Lanes:
    """Texts dealt to ``n`` lanes, the longest first and each to the shortest
    lane; longer lanes come first. A lane holds its own symbols only, so one
    very long text beside short ones costs its length and no more."""

    def __init__(self, texts: list[np.ndarray], n: int):
        n = max(1, min(n, len(texts)))
        heap = [(0, k) for k in range(n)]
        dealt: list[list[int]] = [[] for _ in range(n)]
        for i in sorted(range(len(texts)), key=lambda i: -len(texts[i])):
            length, k = heapq.heappop(heap)
            dealt[k].append(i)
            heapq.heappush(heap, (length + len(texts[i]), k))
        dealt.sort(key=lambda own: -sum(len(texts[i]) for i in own))
        self.symbols = [np.concatenate([texts[i] for i in own]) for own in dealt]
        self.ends = [np.cumsum([len(texts[i]) for i in own]) for own in dealt]
        self.texts = [np.array(own, dtype=np.int32) for own in dealt]
        self.length = np.array([len(x) for x in self.symbols])
        self.steps = int(self.length.max())

    def block(self, t0: int, t1: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(step x lane) symbols of the lanes that reach step ``t0``, -1 where a
        lane has ended; the index of the text there; where a text begins."""
        n = int(np.searchsorted(-self.length, -t0, side="left"))
        symbols, owner = np.full((n, t1 - t0), -1, dtype=np.int32), np.full((n, t1 - t0), -1, dtype=np.int32)
        begins = np.zeros((n, t1 - t0), dtype=bool)
        begins[:, :1] = t0 == 0
        for k in range(n):
            t2, ends = min(t1, len(self.symbols[k])), self.ends[k]
            symbols[k, :t2 - t0] = self.symbols[k][t0:t2]
            owner[k, :t2 - t0] = self.texts[k][np.searchsorted(ends, np.arange(t0, t2), side="right")]
            starts = ends[np.searchsorted(ends, t0):np.searchsorted(ends, t2)]
            begins[k, starts - t0] = True
        return np.ascontiguousarray(symbols.T), np.ascontiguousarray(owner.T), np.ascontiguousarray(begins.T)

    def windows(self, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """``block`` after block of ``steps``, without the lanes that have
        ended; several are laid out at once."""
        at_once = steps * max(1, BLOCK_STEPS // steps)
        for t0 in range(0, self.steps, at_once):
            t1 = min(t0 + at_once, self.steps)
            parts = self.block(t0, t1)
            for t in range(t0, t1, steps):
                n = int(np.searchsorted(-self.length, -t, side="left"))
                yield tuple(x[t - t0:t - t0 + steps, :n] for x in parts)


def score_texts(net: Network, texts: list[np.ndarray], n_lanes: int = SCORE_LANES, window: int = SCORE_STEPS) -> np.ndarray:
    """ln P of every text (symbol arrays, none empty)."""
    out = np.zeros(len(texts))
    if not texts:
        return out
    dealt = Lanes(texts, n_lanes)
    h = np.zeros((net.width, len(dealt.symbols)), np.float32)
    for symbols, owner, begins in dealt.windows(window):
        h, live = h[:, :symbols.shape[1]], symbols >= 0
        x, keep = net.inputs(np.maximum(symbols, 0)), (~begins).astype(np.float32)
        states = np.empty((*symbols.shape, net.width), np.float32)
        for t in range(len(symbols)):
            h = h * keep[t]
            states[t] = h.T
            h, _ = net.advance(h, x[t])
        lp = net.output(states[live], symbols[live])
        out += np.bincount(owner[live], weights=lp, minlength=len(texts))
    return out


def _lane_rows(a: np.ndarray, live: np.ndarray) -> np.ndarray:
    """``a`` (step x value x lane) as a row for each live step of a lane."""
    rows = np.ascontiguousarray(a.transpose(0, 2, 1)).reshape(-1, a.shape[1])
    return rows if live.all() else rows[live.ravel()]


def train_texts(net: Network, texts: list[np.ndarray], rate: float = RATE, n_lanes: int = LANES, window: int = STEPS) -> int:
    """One pass of truncated backpropagation over ``texts`` (Adagrad; a row of
    ``x`` moves when a window has its symbol). Returns the symbols seen."""
    if not texts:
        return 0
    dealt = Lanes(texts, n_lanes)
    d, p, past = net.width, net.p, net.past
    h = np.zeros((d, len(dealt.symbols)), np.float32)
    seen = 0

    def update(k: str, g: np.ndarray, rows=slice(None), slower: float = 1.0) -> None:
        np.clip(g, -CLIP, CLIP, out=g)
        past[k][rows] += g * g if past[k].ndim == g.ndim else np.einsum("ij,ij->i", g, g) / np.float32(g.shape[1])
        scale = np.float32(rate * slower) / np.sqrt(past[k][rows])
        g *= scale if scale.ndim == g.ndim else scale[:, None]
        p[k][rows] -= g

    for symbols, _, begins in dealt.windows(window):
        steps, n = symbols.shape
        live = symbols >= 0
        x, keep = net.inputs(np.maximum(symbols, 0)), (~begins).astype(np.float32)
        states, gates, h = np.empty((steps, d, n), np.float32), [], h[:, :n]
        for t in range(steps):
            np.multiply(h, keep[t], out=states[t])
            h, g = net.advance(states[t], x[t])
            gates.append(g)
        own = symbols[live]
        _, back, grads = net.output(_lane_rows(states, live), own, gradient=True)
        seen += len(own)
        from_out = np.zeros((steps, n, d), np.float32)
        from_out[live] = back
        from_out = np.ascontiguousarray(from_out.transpose(0, 2, 1))
        g_x, g_u = np.empty((steps, 3 * d, n), np.float32), np.zeros((3 * d, d), np.float32)
        dh = np.zeros((d, n), np.float32)                 # stays zero where a lane has ended
        for t in range(steps - 1, -1, -1):
            z, r, c, u = gates[t]
            prev, g = states[t], g_x[t]
            dz, dr, dc = g[:d], g[d:2 * d], g[2 * d:]
            np.subtract(1, z, out=dr)
            np.multiply(dh, dr, out=dc)
            np.subtract(prev, c, out=dz)
            dz *= z
            dz *= dc
            dc *= 1 - c * c
            np.subtract(1, r, out=dr)
            dr *= r
            dr *= u
            dr *= dc
            r *= dc                                       # the gates are of no further use
            z *= dh
            z += p["u"][:, :2 * d] @ g[:2 * d]
            z += p["u"][:, 2 * d:] @ r
            z += from_out[t]
            z *= keep[t]
            g_u[:2 * d] += g[:2 * d] @ prev.T
            g_u[2 * d:] += r @ prev.T
            dh = z
        inv = np.float32(1 / PER_SYMBOLS)
        touched, rows = sums_by_symbol(own, _lane_rows(g_x, live))
        update("x", rows * inv, touched)
        update("u", g_u.T * inv)
        update("wc", grads["wc"] * inv)
        update("bc", grads["bc"] * inv, slower=0.1)
        update("w", grads["w"] * inv)
        update("b", grads["b"] * inv, slower=0.1)
    return seen


def average(copies: DataFrame) -> np.ndarray | None:
    """The copies' weighted mean. Rows: chunk, weight (symbols seen), values."""
    return weighed(copies)[0]


def weighed(copies: DataFrame) -> tuple[np.ndarray | None, float]:
    """``average`` and the weight of all copies. Summed chunk by chunk in tasks;
    the driver gets one network."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}                        # a task's chunks of one network
        for batch in batches:
            for i in range(batch.num_rows):
                k, w, v = (batch.column(c)[i].as_py() for c in range(3))
                mine = sums.setdefault(k, [0.0, 0.0])
                mine[0] += w
                mine[1] = mine[1] + w * np.frombuffer(v, np.float32).astype(np.float64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([s[0] for s in sums.values()], pa.float64()),
             pa.array([(s[1] / s[0]).astype(np.float32).tobytes() for s in sums.values()], pa.binary())], names=["chunk", "weight", "values"])

    schema = "chunk int, weight double, values binary"
    rows = copies.repartition("chunk").mapInArrow(run, schema).collect()
    if not rows:
        return None, 0.0
    rows.sort(key=lambda r: r["chunk"])
    return np.concatenate([np.frombuffer(r["values"], np.float32) for r in rows]), rows[0]["weight"]


class Scorer:
    """What workers need: the tokens with counts they hold, and the network."""

    def __init__(self, held: list[tuple[bytes, int]], total: int, distinct: int, vocabulary: int = VOCABULARY):
        self.tokens = pa.array([t for t, _ in held], pa.binary())
        c = np.array([n for _, n in held], dtype=np.int64)
        self.log_c = np.log10(c + 1.0)
        self.vocabulary = min(vocabulary, len(held))
        self.total, self.distinct = total, distinct
        self.rare_total, self.rare_distinct = total - int(c[:self.vocabulary].sum()), distinct - self.vocabulary
        self.network = Network(c[:self.vocabulary], self.rare_total)
        self.kind = np.uint16 if self.vocabulary < 1 << 16 else np.int32   # of a stored symbol
        self.learned = 0                                              # tokens that trained the network

    def ranks(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Ranks of all tokens of ``texts``, ends included (-1: not held), the
        number of each text's tokens, and the tokens that are not held."""
        words, n = split_texts(texts)
        words = pa.concat_arrays([words, pa.array([END], pa.binary())])
        at = np.insert(np.arange(len(words) - 1), np.cumsum(n), len(words) - 1)
        rank = pc.fill_null(pc.index_in(words, value_set=self.tokens), -1).to_numpy()[at]
        return rank, n + 1, words.take(pa.array(at[rank < 0]))

    def symbols(self, ranks: np.ndarray) -> np.ndarray:
        return np.where((ranks >= 0) & (ranks < self.vocabulary), ranks + 1, 0).astype(np.int32)


def training_symbols(docs: DataFrame, scorer, rounds: int, copies: int) -> DataFrame:
    """``symbols, copy, round`` of every row of ``docs``, stored by round. Rows
    are dealt one by one, so repeated keys spread."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = scorer.value
        for batch in batches:
            rank, n, _ = own.ranks(batch.column(0))
            raw = own.symbols(rank).astype(own.kind)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32) * raw.itemsize
            got = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw)])
            yield pa.RecordBatch.from_arrays([got, batch.column(1), batch.column(2)], names=["symbols", "copy", "round"])

    place = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(rounds * copies))
    dealt = docs.select(doc_bytes().alias("b"), place.alias("place")).select(
        "b", (F.col("place") % copies).cast("int").alias("copy"), F.floor(F.col("place") / copies).cast("int").alias("round"))
    # a round's rows in few files: their number follows the rounds, not rounds times input files
    return stored(dealt.mapInArrow(run, "symbols binary, copy int, round int").repartition("round", "copy"), "train-symbols", by="round")


def train_round(symbols: DataFrame, network, kind, copies: int) -> DataFrame:
    """Rows for ``average``: a copy of the network trained on each slice."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = network.value
        net.load(net.flat())                              # a private copy: the broadcast value is shared
        seen, texts, held = 0, [], 0
        for batch in batches:
            for x in batch.column(0):
                texts.append(np.frombuffer(x.as_py(), kind))
                held += len(texts[-1])
                if held >= TOKENS_AT_ONCE:
                    seen += train_texts(net, texts)
                    texts, held = [], 0
        seen += train_texts(net, texts)
        if seen:
            flat = net.flat()
            parts = [flat[i:i + CHUNK] for i in range(0, len(flat), CHUNK)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(parts)), pa.int32()), pa.array([float(seen)] * len(parts), pa.float64()),
                 pa.array([v.tobytes() for v in parts], pa.binary())], names=["chunk", "weight", "values"])

    return symbols.repartitionById(copies, "copy").select("symbols").mapInArrow(run, "chunk int, weight double, values binary")


def learn(train: DataFrame, counts: DataFrame, share: int = SHARE, copies: int = COPIES, round_tokens: int = ROUND_TOKENS,
          held: int = HELD, vocabulary: int = VOCABULARY) -> Scorer:
    """A scorer with counts from all of ``train`` and a network trained on all
    of it (with ``share``, on one document in so many), slice by slice."""
    spark = train.sparkSession
    totals = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    top = most_frequent(counts, "c", held).select("token", "c").toArrow()
    pairs = sorted(zip(top.column("token").to_pylist(), top.column("c").to_pylist(), strict=True), key=lambda r: (-r[1], r[0]))
    scorer = Scorer(pairs, int(totals["n"] or 0), int(totals["v"]), vocabulary)
    del top, pairs
    rounds = max(1, round(scorer.total / (share * copies * round_tokens)))
    own = train if share == 1 else train.where(F.pmod(F.xxhash64("doc_id", F.lit("train")), F.lit(share)) == 0)
    sent = spark.sparkContext.broadcast(scorer)
    symbols = training_symbols(own, sent, rounds, copies)
    sent.unpersist()
    for k in range(rounds):
        sent = spark.sparkContext.broadcast(scorer.network)
        flat, seen = weighed(train_round(symbols.where(F.col("round") == k), sent, scorer.kind, copies))
        if flat is not None:
            scorer.network.load(flat)
            scorer.learned += int(seen)
        sent.unpersist()
    return scorer


def score_documents(docs: DataFrame, train: DataFrame, **settings) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_tokens, n_known, train_tokens,
    base_score, score, n_rare`` (log10; ``n_rare`` tokens outside the network's
    vocabulary).

    NULL text counts as empty: one end token. Tokens are compared as bytes.
    Texts are scored whole; a very long one costs memory by its own length.
    Repeated rows get equal scores up to rounding (lanes differ). Extra columns are not
    read. Without training documents every token has probability 1 in the
    base, and the untrained network's in the score.
    """
    counts = stored(token_counts(train), "token-counts")
    scorer = learn(train, counts, **settings)
    sent = docs.sparkSession.sparkContext.broadcast(scorer)
    kinds = {"row": pa.int64(), "doc_id": pa.int64(), "n_tokens": pa.int64(), "n_known": pa.int64(), "n_rare": pa.int64(),
             "base": pa.float64(), "rare": pa.float64(), "net": pa.float64(), "others": pa.list_(pa.binary())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, row = sent.value, TaskContext.get().partitionId() << 40
        parts, texts, held_tokens = [], [], 0

        def flush() -> pa.RecordBatch:
            cols = {k: pa.concat_arrays([part[k] for part in parts]) for k in kinds if k != "net"}
            cols["net"] = pa.array(score_texts(own.network, texts) / np.log(10))
            return pa.RecordBatch.from_arrays([cols[k] for k in kinds], names=list(kinds))

        for batch in batches:
            rank, n, others = own.ranks(batch.column(1))
            symbols, of = own.symbols(rank), np.repeat(np.arange(len(n)), n)
            texts += np.split(symbols, np.cumsum(n)[:-1])
            each = lambda chosen, weights=None: np.bincount(
                of[chosen], weights=None if weights is None else weights[chosen], minlength=len(n))
            logs = np.append(own.log_c, 0.0)[rank]                    # rank -1: 0
            unknown = each(rank < 0)
            until = np.concatenate([[0], np.cumsum(unknown)]).astype(np.int32)
            cols = {"row": row + np.arange(len(n)), "n_tokens": n, "n_known": n - unknown, "n_rare": each(symbols == 0),
                    "base": each(slice(None), logs), "rare": each(rank >= own.vocabulary, logs)}
            parts.append({"doc_id": batch.column(0), "others": pa.ListArray.from_arrays(until, others)}
                         | {k: pa.array(v, kinds[k]) for k, v in cols.items()})
            row, held_tokens = row + len(n), held_tokens + len(rank)
            if held_tokens >= TOKENS_AT_ONCE:
                yield flush()
                parts, texts, held_tokens = [], [], 0
        if texts:
            yield flush()

    part = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(
        run, "row long, doc_id long, n_tokens long, n_known long, n_rare long, base double, rare double, net double, "
             "others array<binary>"), "scored")
    others = part.select("row", F.explode("others").alias("token")).groupBy("row", "token").agg(F.count(F.lit(1)).alias("k"))
    found = (others.join(counts, "token").groupBy("row")
             .agg(F.sum("k").alias("k"), F.sum(F.col("k") * F.log10(F.col("c") + 1)).alias("logs")))
    logs, n = F.coalesce("logs", F.lit(0.0)), scorer.total + scorer.distinct + 1
    rare_n = scorer.rare_total + scorer.rare_distinct + 1
    return part.drop("others").join(found, "row", "left").select(
        "doc_id", "n_tokens", (F.col("n_known") + F.coalesce("k", F.lit(0))).cast("long").alias("n_known"),
        F.lit(scorer.total).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * float(np.log10(n))).alias("base_score"),
        (F.col("net") + F.col("rare") + logs - F.col("n_rare") * float(np.log10(rare_n))).alias("score"), "n_rare")


def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    remainder = lambda: F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    out = score_documents(docs, docs.where(remainder() != 2))
    return out.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                      "train_tokens", "base_score", "score", "n_rare")
