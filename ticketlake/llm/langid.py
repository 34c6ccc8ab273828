"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is lower-cased, everything but letters becomes a word boundary, and all
its byte n-grams (2 to 4 bytes, over word ends too) are hashed to embedding
rows. The text's vector is the mean of these rows and a linear softmax gives
the languages. Both layers are trained by stochastic gradient descent in numpy
on a bounded number of documents of each language, which reach the driver as
bags of embedding rows. On training documents that were held back, a temperature is fitted to the softmax and a rejection bound to
its largest probability.

Prediction needs one row of class values for each n-gram (embedding times
output layer, multiplied once), so a text is a gather and a mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_bytes, table

UNKNOWN = "und"
#: Embedding rows (a power of two), embedding width, n-gram lengths in bytes.
BITS, WIDTH, LENGTHS = 15, 16, (2, 3, 4)
#: Training documents of a language, passes, step size, share held back.
PER_LANGUAGE, EPOCHS, RATE, HELD_BACK = 600, 4, 0.5, 0.2
#: Share of correctly labelled held-back documents that rejection may cost.
REJECT_SHARE = 0.01

_BOUNDARY = bytes(b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def subwords(text: str) -> np.ndarray:
    """Embedding rows of all n-grams of ``text``."""
    words = text.lower().encode("utf-8", "replace").translate(_BOUNDARY).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", dtype=np.uint8).astype(np.uint32)
    out, gram = [], b
    for n in range(2, max(LENGTHS) + 1):
        gram = gram[:len(gram) - 1] * np.uint32(263) + b[n - 1:] + np.uint32(n)
        if n in LENGTHS and len(gram):
            out.append((gram * np.uint32(2654435761)) >> np.uint32(32 - BITS))
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


@dataclass
class Model:
    languages: list[str]
    table: np.ndarray          # embedding rows times output layer
    bias: np.ndarray
    temperature: float = 1.0
    reject_under: float = 0.0

    def logits(self, text: str) -> np.ndarray:
        rows = subwords(text)
        return (self.table.take(rows, axis=0).mean(axis=0) if len(rows) else 0) + self.bias

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        if not text or not self.languages or not has_letter(text):
            return UNKNOWN, 0.0, True
        p = softmax(self.logits(text) / self.temperature)
        i = int(p.argmax())
        return self.languages[i], float(p[i]), bool(p[i] < self.reject_under)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def bag(text: str) -> np.ndarray:
    """Embedding rows of ``text`` and their counts: at most 2^BITS columns."""
    return np.stack(np.unique(subwords(text), return_counts=True)).astype(np.uint32)


def train(texts: list[str], labels: list[str], seed: int = 3) -> Model:
    kept = [i for i, t in enumerate(texts) if t and has_letter(t)]
    return train_bags([bag(texts[i]) for i in kept], [labels[i] for i in kept], seed)


def train_bags(bags: list[np.ndarray], labels: list[str], seed: int = 3) -> Model:
    """Stochastic gradient descent, one document at a time; rare languages
    step further, so that each weighs the same."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    code = {v: k for k, v in enumerate(languages)}
    y = np.array([code[v] for v in labels])
    weight = len(y) / (len(languages) * np.bincount(y, minlength=len(languages)))
    order = rng.permutation(len(y))
    held = order[:int(len(y) * HELD_BACK)]
    fit = order[len(held):]
    embed = rng.normal(0, 0.1, (1 << BITS, WIDTH)).astype(np.float32)
    out, bias = np.zeros((WIDTH, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps = EPOCHS * len(fit)
    for step, i in enumerate(np.concatenate([rng.permutation(fit) for _ in range(EPOCHS)]) if steps else []):
        rows, counts = bags[i]
        share = (counts / counts.sum()).astype(np.float32)
        mean = share @ embed[rows]
        error = softmax(mean @ out + bias)
        error[y[i]] -= 1
        rate = np.float32(RATE * (1 - step / steps) * min(weight[y[i]], 5.0))
        back = out @ error
        out -= rate * np.outer(mean, error)
        bias -= rate * error * np.float32(0.1)
        # the mean spreads a step over all rows; scaled up so that rows move at the layer's pace
        embed[rows] -= (rate * 20) * share[:, None] * back
    model = Model(languages, (embed @ out).astype(np.float32), bias)
    if len(held):
        calibrate(model, np.stack([s @ model.table[r] + bias for r, s in
                                   ((bags[i][0], bags[i][1] / bags[i][1].sum()) for i in held)]), y[held])
    return model


def calibrate(model: Model, logits: np.ndarray, y: np.ndarray) -> None:
    """Temperature of the smallest log loss, and the rejection bound under
    which REJECT_SHARE of the correct documents lie."""
    best = np.inf
    for t in np.geomspace(0.05, 20, 120):
        p = softmax(logits / t)
        loss = -np.log(np.maximum(p[np.arange(len(y)), y], 1e-12)).mean()
        if loss < best - 1e-9:
            best, model.temperature = loss, float(t)
    p = softmax(logits / model.temperature)
    right = p.max(axis=1)[p.argmax(axis=1) == y]
    if len(right):
        model.reject_under = float(np.quantile(right, REJECT_SHARE))


def train_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``doc_id, lang, bag`` of at most ``per_language`` documents of each
    language: those with the smallest hashes, one row of each (of repeated
    rows with a letter, the text with the smallest hash). The choice is made
    without the texts, and texts become bags in tasks."""
    own = docs.select("doc_id", "lang").where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull()).distinct()
    w = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = own.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= per_language).select("doc_id", "lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, tuple[int, bytes]] = {}         # a task's chosen documents
        for batch in batches:
            ids, langs, hashes = (batch.column(c).to_pylist() for c in range(3))
            for i, x in enumerate(batch.column(3)):
                key = ids[i], langs[i]
                if key in best and best[key][0] <= hashes[i]:
                    continue
                text = x.as_py().decode("utf-8", "replace")
                if has_letter(text):
                    best[key] = hashes[i], bag(text).tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in best], pa.int64()), pa.array([k[1] for k in best], pa.string()),
             pa.array([v[0] for v in best.values()], pa.int64()), pa.array([v[1] for v in best.values()], pa.binary())],
            names=["doc_id", "lang", "h", "bag"])

    # languages x per_language ids
    rows = docs.join(F.broadcast(chosen), ["doc_id", "lang"], "left_semi").select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", F.xxhash64("text").alias("h"), doc_bytes().alias("b"))
    return rows.mapInArrow(run, "doc_id long, lang string, h long, bag binary").groupBy("doc_id", "lang").agg(F.min_by("bag", "h").alias("bag"))


def identify(docs: DataFrame, learn_from: DataFrame) -> DataFrame:
    """Every row of ``docs``: ``doc_id, lang_pred, score, rejected``. The model
    learns from ``learn_from`` (doc_id, text, lang).

    NULL text and texts without a letter are ``und``, score 0, rejected; so is
    every text if nothing could be learned. Texts are read whole. Repeated
    rows get equal answers. Extra columns are not read.
    """
    rows = sorted(train_rows(learn_from).collect(), key=lambda r: (r["lang"], r["doc_id"]))
    bags = [np.frombuffer(r["bag"], np.uint32).reshape(2, -1) for r in rows]
    model = docs.sparkSession.sparkContext.broadcast(train_bags(bags, [r["lang"] for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [model.value.predict(b.as_py().decode("utf-8", "replace")) for b in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                 pa.array([g[2] for g in got], pa.bool_())], names=["doc_id", "lang_pred", "score", "rejected"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(
        run, "doc_id long, lang_pred string, score double, rejected boolean")


def op1(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    remainder = lambda: F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4
    out = identify(docs, docs.where(remainder() != 2))
    return out.select("doc_id", F.coalesce(remainder() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
