"""Quality rules: an isolation forest over rule statistics.

Each document gets the statistics that hand-written quality rules look at
(word counts, symbols, repeated lines and word windows, case, word lengths).
Extended by ratios they form a point; an isolation forest scores how few
random splits separate that point from the rest. A tree is grown from a small
subsample (that is the method: path lengths need few points), drawn by hash
from all documents. The cut on the score is then calibrated on every labelled
row through a score histogram, so nothing that grows with the data reaches
the driver.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, hash_sample, stored, table, works_for

SYMBOLS = b"#*$%&|<>"
#: Trees, and rows from which one tree is grown.
TREES, SUBSAMPLE = 120, 256
#: Score bins of the calibration histogram.
BINS = 1000
#: Of the labelled documents that are good, the share that the cut must keep.
KEEP_GOOD = 0.995

STAT_FIELDS = [("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
               ("n_repeat_words", "long"), ("n_upper", "long"), ("n_lines", "long"), ("n_distinct", "long"),
               ("n_symbol_words", "long"), ("max_word", "long")]


def text_statistics(b: bytes) -> tuple[int, ...]:
    """The statistics of one text, in the order of STAT_FIELDS."""
    words = b.split()                       # ASCII white space: 0x20, 0x09-0x0D
    n = len(words)
    chars = len(b"".join(words).decode("utf-8", "replace"))
    symbols = len(b) - len(b.translate(None, SYMBOLS))
    seen, dup = set(), 0
    lines = 0
    for line in b.split(b"\n"):
        if line.strip():
            lines += 1
            if line in seen:
                dup += 1
            else:
                seen.add(line)
    repeat = 0
    if n > 3:
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) < len(windows):
            first: dict[tuple, int] = {}
            again = bytearray(n)
            for i, w in enumerate(windows):
                j = first.setdefault(w, i)
                if j != i:
                    again[i] = again[i + 1] = again[i + 2] = 1
                    again[j] = again[j + 1] = again[j + 2] = 1
            repeat = again.count(1)
    joined = b.translate(None, b" \t\n\r\x0b\x0c")
    upper = len(joined) - len(joined.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    symbol_words = sum(1 for w in words if w[-1] in SYMBOLS) if symbols else 0
    return (n, chars, symbols, dup, repeat, upper, lines, len(set(words)), symbol_words,
            max(map(len, words), default=0))


def rule_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and STAT_FIELDS for every row, in one pass over the texts
    (Arrow batches; one text at a time)."""
    schema = "doc_id long, " + ", ".join(f"{k} {t}" for k, t in STAT_FIELDS)
    names = ["doc_id", *[k for k, _ in STAT_FIELDS]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("rules")
        for batch in batches:
            stats = [text_statistics(x.as_py()) for x in batch.column(1)]
            cols = list(zip(*stats, strict=True)) if stats else [[] for _ in STAT_FIELDS]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(c, pa.int64()) for c in cols]], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(run, schema)


def base_failed(n_words="n_words", n_repeat="n_repeat_words"):
    return (F.col(n_words) < 50) | (F.lit(100) * F.col(n_repeat) > F.lit(50) * F.col(n_words))


#: Inside these limits a statistic says nothing against a text; the forest
#: sees how far it lies outside. Shares of upper-case letters, repeated lines,
#: repeated word windows; mean word length (low, high).
MAX_UPPER, MAX_DUP_LINES, MAX_REPEAT, WORD_LENGTH = 0.2, 0.34, 0.3, (2.5, 12.0)
FEATURES = 6


def features(stats: dict[str, np.ndarray]) -> np.ndarray:
    """Points for the forest: shares rather than counts, so that a long clean
    text is not odd for being long, and excesses over rule limits, so that
    ordinary variation is one dense point that no split isolates."""
    n = np.maximum(stats["n_words"], 1).astype(float)
    chars = np.maximum(stats["word_chars"], 1).astype(float)
    mean = chars / n
    return np.stack([
        stats["n_symbols"] / chars, stats["n_symbol_words"] / n,
        np.maximum(stats["n_upper"] / chars - MAX_UPPER, 0),
        np.maximum(stats["n_dup_lines"] / np.maximum(stats["n_lines"], 1) - MAX_DUP_LINES, 0),
        np.maximum(stats["n_repeat_words"] / n - MAX_REPEAT, 0),
        np.maximum(mean - WORD_LENGTH[1], 0) + np.maximum(WORD_LENGTH[0] - mean, 0)], axis=1)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    return 0.0 if n <= 1 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_tree(points: np.ndarray, rng: np.random.Generator) -> dict[str, np.ndarray]:
    """One isolation tree as flat arrays. A leaf has feature -1 and in ``cut``
    the path length that ends there."""
    limit = math.ceil(math.log2(max(len(points), 2)))
    feature, cut, left, right = [], [], [], []

    def node(rows: np.ndarray, depth: int) -> int:
        at = len(feature)
        feature.append(-1), left.append(-1), right.append(-1)
        cut.append(depth + _expected(len(rows)))
        if depth < limit and len(rows) > 1:
            low, high = rows.min(axis=0), rows.max(axis=0)
            open_ = np.flatnonzero(high > low)
            if len(open_):
                f = int(rng.choice(open_))
                c = float(rng.uniform(low[f], high[f]))
                feature[at], cut[at] = f, c
                side = rows[:, f] <= c
                left[at] = node(rows[side], depth + 1)
                right[at] = node(rows[~side], depth + 1)
        return at

    node(points, 0)
    return {"feature": np.array(feature), "cut": np.array(cut), "left": np.array(left), "right": np.array(right)}


def forest_scores(trees: list[dict[str, np.ndarray]], points: np.ndarray, subsample: int) -> np.ndarray:
    """Anomaly score 2^(-mean path / expected path), near 1: easily isolated."""
    if not len(points) or not trees:
        return np.zeros(len(points))
    total = np.zeros(len(points))
    for t in trees:
        at = np.zeros(len(points), dtype=np.int64)
        for _ in range(64):
            f = t["feature"][at]
            inner = f >= 0
            if not inner.any():
                break
            value = points[np.arange(len(points)), np.maximum(f, 0)]
            down = np.where(value <= t["cut"][at], t["left"][at], t["right"][at])
            at = np.where(inner, down, at)
        total += t["cut"][at]
    return np.exp2(-(total / len(trees)) / max(_expected(subsample), 1e-9))


def train_forest(stats: DataFrame, trees: int = TREES, subsample: int = SUBSAMPLE, seed: int = 7):
    """Trees from about ``trees * subsample`` rows, drawn by a hash of their key
    and statistics (the same rows at every run)."""
    names = [k for k, _ in STAT_FIELDS]
    rows = hash_sample(stats, trees * subsample, F.lit(seed), "doc_id", *names).select(*names).toPandas().sort_values(names)
    points = features({k: rows[k].to_numpy() for k in names}) if len(rows) else np.zeros((0, FEATURES))
    rng = np.random.default_rng(seed)
    points = points[rng.permutation(len(points))]
    size = min(subsample, max(len(points), 1))
    return [grow_tree(points[rng.choice(len(points), size, replace=False)], rng) for _ in range(trees)] \
        if len(points) else [], size


def with_scores(stats: DataFrame, trees, subsample: int) -> DataFrame:
    """``stats`` with ``anomaly`` (0 to 1). The forest is bounded: trees x
    2 x subsample nodes."""
    names = [k for k, _ in STAT_FIELDS]
    forest = stats.sparkSession.sparkContext.broadcast(trees)
    schema = "doc_id long, " + ", ".join(f"{k} {t}" for k, t in STAT_FIELDS) + ", anomaly double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("rules")
        for batch in batches:
            cols = {k: batch.column(k).to_numpy(zero_copy_only=False) for k in names}
            score = forest_scores(forest.value, features(cols), subsample)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], names=["doc_id", *names, "anomaly"])

    return stats.select("doc_id", *names).mapInArrow(run, schema)


def calibrate(scored: DataFrame, labels: DataFrame | None, keep_good: float = KEEP_GOOD) -> float:
    """The cut on ``anomaly``: among the cuts that keep ``keep_good`` of the
    labelled good documents, the one with the best Youden index (rejected bad
    minus rejected good). Counted over all labelled rows that pass the base
    rules, in BINS score bins. Without two kinds of labels nothing is cut."""
    if labels is None:
        return math.inf
    bin_ = F.least(F.floor(F.col("anomaly") * BINS), F.lit(BINS - 1)).cast("int")
    told = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality").dropna()
    rows = (scored.where(~base_failed()).select("doc_id", bin_.alias("bin"))
            .join(told, "doc_id").groupBy("bin")
            .agg(F.sum((F.col("quality") > 0).cast("long")).alias("good"),
                 F.sum((F.col("quality") <= 0).cast("long")).alias("bad")).collect())     # BINS rows at most
    good, bad = np.zeros(BINS), np.zeros(BINS)
    for r in rows:
        good[r["bin"]], bad[r["bin"]] = r["good"], r["bad"]
    if not good.sum() or not bad.sum():
        return math.inf
    lost = np.cumsum(good[::-1])[::-1] / good.sum()       # rejected when the cut is at this bin
    caught = np.cumsum(bad[::-1])[::-1] / bad.sum()
    gain = np.where(lost <= 1 - keep_good, caught - lost, -1.0)
    best = float(gain.max())
    if best <= 0:
        return math.inf
    flat = np.flatnonzero(gain >= best - 1e-12)            # all as good: the middle of the gap
    return float(flat[len(flat) // 2]) / BINS


def _fit(docs: DataFrame, labels: DataFrame | None):
    """(statistics, trees, subsample, cut)."""
    stats = stored(rule_statistics(docs), "rules")
    trees, size = train_forest(stats.where(~base_failed()))
    scored = stored(with_scores(stats, trees, size), "rules-scored")
    return scored, trees, size, calibrate(scored, labels)


def keep_documents(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """The rows of ``docs`` that ``judge_documents`` keeps, with all columns.
    Every row is judged by its own text (no join, so NULL or repeated doc_ids
    need no rule)."""
    _, trees, size, cut = _fit(docs, labels)
    forest = docs.sparkSession.sparkContext.broadcast(trees)
    names = [k for k, _ in STAT_FIELDS]
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("rules")
        for batch in batches:
            stats = [text_statistics((x.as_py() or "").encode()) for x in batch.column(at)]
            cols = {k: np.array(v, dtype=np.int64) for k, v in zip(names, zip(*stats, strict=True), strict=True)} if stats else {}
            if stats:
                ok = ~((cols["n_words"] < 50) | (100 * cols["n_repeat_words"] > 50 * cols["n_words"]))
                ok &= forest_scores(forest.value, features(cols), size) < cut
                yield batch.filter(pa.array(ok))

    return docs.mapInArrow(run, docs.schema)


def judge_documents(docs: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """Every document with its statistics, ``base_failed``, ``anomaly`` and
    ``kept`` (false if the base rules fail, else whether the forest's score is
    under the calibrated cut).

    NULL text has no words and fails the base rules, as do texts under 50
    words. Repeated rows get equal verdicts. Extra columns are not read. An
    empty table gives no rows; without labels only the base rules decide.
    """
    scored, _, _, cut = _fit(docs, labels)
    failed = base_failed()
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & (F.col("anomaly") < F.lit(cut))).alias("kept"),
        "anomaly")


def op7(spark, sf_dir):
    return judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
