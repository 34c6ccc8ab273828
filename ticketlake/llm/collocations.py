"""Phrase collocations by the stripes pattern.

A stripe belongs to a prefix of 0 to 3 words: an associative counter of the
words that follow the prefix inside a piece. Tasks build the stripes of some
million words at a time; stripes of a prefix are merged elementwise. One
structure gives everything asked for: cells are the extensions (the
candidates), a prefix's total is its own cell in the stripe of its shorter
prefix, and the largest cell that holds a phrase, as prefix or as suffix, tells
whether a longer candidate subsumes it.

One pass over the texts for each length of prefix. A phrase is as frequent as
its least frequent part at most, so a pass only counts phrases of which both
shorter parts stand in a set of bits (8 MB, a superset) of the frequent ones
of the pass before. Other phrases never leave the tasks' memory.

A frequent prefix has many next words: a stripe travels and is merged in
segments, by the hash of the next word. No stripe is ever whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_bytes, stored, table

#: Words of the longest candidate, its least frequency, the share (in
#: hundredths) of a longer one that subsumes it, rows of a language.
LONGEST, LEAST, SUBSUMED, TOP = 4, 30, 80, 2000
#: Words for which a task builds stripes at once.
HELD = 1 << 22
#: Segments of the stripe of a prefix of 0, 1, 2, 3 words.
SEGMENTS = (4096, 16, 4, 1)
#: Bits of the set of frequent phrases of a length (a superset).
BITMAP = 26
#: Score bins of the histogram that bounds what is ranked.
SCORE, BINS = 2_000_000, 1000

_BREAKS = bytes.maketrans(b",;:!?\n\x0b\x0c\r", b"." * 9)
_STRIPES = "lang string, prefix string, segment int, cells string"


def words_of(b: bytes) -> list[bytes]:
    """Lower-cased words; a full stop stands for the end of a piece."""
    return b.lower().translate(_BREAKS).replace(b".", b" . ").split()


class _Ids(dict):
    """Words numbered in order of appearance; 0 is the end of a piece."""

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def _word_hashes(lang: str, words: list[bytes]) -> np.ndarray:
    own = lang.encode() + b"\0"
    return np.fromiter((xxhash.xxh3_64_intdigest(own + w) for w in words), np.uint64, len(words))


def _pair_hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    z = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
    z *= np.uint64(0xFF51AFD7ED558CCD)
    return z ^ (z >> np.uint64(29))


def _in_bits(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    p = h & np.uint64(64 * len(bits) - 1)
    return (bits[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1) == 1


class _Chunk:
    """The words of one language that a task holds: stripes of them."""

    def __init__(self, lang: str):
        self.lang, self.ids, self.texts = lang, _Ids({b".": 0}), []

    def add(self, words: list[bytes]) -> None:
        self.texts.append(np.fromiter(map(self.ids.__getitem__, words), np.int32, len(words)))
        self.texts.append(np.zeros(1, np.int32))

    def open(self) -> None:
        self.at = np.concatenate([*self.texts, np.zeros(1, np.int32)])
        self.hashes = _word_hashes(self.lang, list(self.ids))
        self.words = pa.array(list(self.ids), pa.binary()).cast(pa.string())

    def _rows(self, prefixes: pa.Array, owner: np.ndarray, place: np.ndarray, count: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Stripes of ``prefixes`` from cells sorted by prefix and place of
        the next word in the order of ``_places``."""
        nxt = self.by_segment[place]
        seg = self.segment[nxt]
        starts = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (seg[1:] != seg[:-1])])) if len(owner) else np.zeros(0, np.int64)
        ends = np.append(starts[1:], len(owner))
        for i in range(0, len(starts), 1 << 16):
            s, e = starts[i:i + (1 << 16)], ends[i:i + (1 << 16)]
            offsets, cells = pa.array(np.append(s, e[-1]) - s[0], pa.int32()), slice(s[0], e[-1])
            words, n = self.words.take(pa.array(nxt[cells])), pc.cast(pa.array(count[cells], pa.int64()), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([self.lang] * len(s), pa.string()), prefixes.take(pa.array(owner[s])), pa.array(seg[s], pa.int32()),
                 pc.binary_join_element_wise(*(pc.binary_join(pa.ListArray.from_arrays(offsets, x), " ") for x in (words, n)), "\n")],
                names=["lang", "prefix", "segment", "cells"])

    def _places(self, k: int) -> np.ndarray:
        """Place of every word in an order by segment."""
        self.segment = (self.hashes >> np.uint64(40)).astype(np.int64) % SEGMENTS[k]
        self.by_segment = np.argsort(self.segment, kind="stable")
        place = np.empty(len(self.by_segment), np.int64)
        place[self.by_segment] = np.arange(len(place))
        return place

    def words_stripes(self) -> Iterator[pa.RecordBatch]:
        """The empty prefix."""
        place = self._places(0)
        counts = np.bincount(self.at, minlength=len(self.words))
        counts[0] = 0
        seen = np.sort(place[np.flatnonzero(counts)])
        yield from self._rows(pa.array([""], pa.string()), np.zeros(len(seen), np.int64), seen, counts[self.by_segment[seen]])

    def longer_stripes(self, k: int, bits: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Prefixes of ``k`` words: what follows them so that the first ``k``
        and the last ``k`` words both stand in ``bits``."""
        at, v = self.at.astype(np.int64), len(self.words)
        known = np.flatnonzero(at[:len(at) - k + 1] != 0)
        h = self.hashes[at[known]]
        for j in range(1, k):
            inside = at[known + j] != 0
            known, h = known[inside], h[inside]
            h = _pair_hashes(h, self.hashes[at[known + j]])
        known = known[_in_bits(bits, h)]
        dense = at[known]                                                  # numbers of the phrases at these places
        first = known
        for j in range(k):
            code = dense * v + at[known + j] if j else dense
            _, first, dense = np.unique(code, return_index=True, return_inverse=True)
        names = self.words.take(pa.array(at[known[first]]))
        for j in range(1, k):
            names = pc.binary_join_element_wise(names, self.words.take(pa.array(at[known[first] + j])), " ")
        phrase = np.full(len(at) + 1, -1, np.int64)
        phrase[known] = dense
        i = known[phrase[known + 1] >= 0]
        code, count = np.unique(phrase[i] * v + self._places(k)[at[i + k]], return_counts=True)
        yield from self._rows(names, code // v, code % v, count)


def stripes(docs: DataFrame, build, held: int = HELD) -> DataFrame:
    """Rows (lang, prefix, segment, cells): stripes in segments. A text takes a
    third of the room that arrays would: the next words, joined by spaces, a
    line end, and their numbers alike (words hold neither)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks: dict[str, _Chunk] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            while chunks:
                chunk = chunks.popitem()[1]
                chunk.open()
                yield from build(chunk)

        for batch in batches:
            for lang, b in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = words_of(b.as_py())
                if lang not in chunks:
                    chunks[lang] = _Chunk(lang)
                chunks[lang].add(own)
                size += len(own) + 1
                if size >= held:
                    yield from flush()
                    size = 0
        yield from flush()

    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return docs.select(lang.alias("lang"), doc_bytes().alias("b")).mapInArrow(run, _STRIPES)


def merged(rows: DataFrame) -> DataFrame:
    """Cells (lang, prefix, segment, next, f) of elementwise merged stripes.
    Stripes go to the task that merges them; cells are not shuffled again."""
    cells = F.split("cells", "\n")
    return (rows.repartition("lang", "prefix", "segment")
            .select("lang", "prefix", "segment", F.split(cells[0], " ").alias("next"), F.split(cells[1], " ").alias("n"))
            .select("lang", "prefix", "segment", F.explode(F.arrays_zip("next", "n")).alias("c"))
            .groupBy("lang", "prefix", "segment", F.col("c.next").alias("next")).agg(F.sum(F.col("c.n").cast("long")).alias("f")))


def frequent_bits(cells: DataFrame, bitmap: int = BITMAP) -> np.ndarray:
    """2^bitmap bits (8 MB), set for the phrases (prefix and next) of cells."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            place = []
            for lang, prefix, nxt in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                h = _word_hashes(lang, [w.encode() for w in (*prefix.split(" "), nxt) if w])
                for j in range(1, len(h)):
                    h[:1] = _pair_hashes(h[:1], h[j:j + 1])
                place.append(int(h[0]) & ((1 << bitmap) - 1))
            yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64())], names=["p"])

    own = cells.select("lang", "prefix", "next").mapInArrow(run, "p long")
    words = (own.groupBy(F.shiftright("p", 6).alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(p & 63 AS INT))")).alias("bits")).toPandas())
    out = np.zeros(1 << (bitmap - 6), dtype=np.int64)
    out[words["w"].to_numpy(dtype=np.int64)] = words["bits"].to_numpy(dtype=np.int64)
    return out.view(np.uint64)


def all_stripes(docs: DataFrame, least: int = LEAST, held: int = HELD, bitmap: int = BITMAP) -> tuple[DataFrame, DataFrame]:
    """(frequent cells (lang, k, prefix, next, f) of all prefixes, words of
    each language)."""
    words = stored(merged(stripes(docs, _Chunk.words_stripes, held)), "stripes-0")
    n = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = F.col("f") >= least
    levels = [words.where(frequent).withColumn("k", F.lit(0))]
    for k in range(1, LONGEST):
        bits = docs.sparkSession.sparkContext.broadcast(frequent_bits(levels[-1], bitmap))
        rows = stripes(docs, lambda chunk, k=k, bits=bits: chunk.longer_stripes(k, bits.value), held)
        levels.append(stored(merged(rows).where(frequent), f"stripes-{k}").withColumn("k", F.lit(k)))
    return reduce(DataFrame.unionByName, levels).select("lang", "k", "prefix", "next", "f"), n


def _exact(n: Column) -> Column:
    return n.cast("decimal(28,0)")


def scored(cells: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, score) of all candidates, by their lowest cut."""
    phrases = cells.select("lang", "k", F.when(F.col("k") == 0, F.col("next")).otherwise(F.concat_ws(" ", "prefix", "next")).alias("phrase"), "f")
    total = phrases.where(F.col("k") < LONGEST - 1).select("lang", F.col("phrase").alias("part"), F.col("f").alias("total"))
    found = phrases.where("k >= 1").select("lang", "phrase", F.col("f").alias("a"))
    w = F.split("phrase", " ")
    cut = found.withColumn("cut", F.explode(F.sequence(F.lit(1), F.size(w) - 1)))
    cut = cut.select("lang", "phrase", "a", "cut", F.array_join(F.slice(w, 1, F.col("cut")), " ").alias("first"),
                     F.array_join(F.slice(w, F.col("cut") + 1, F.size(w)), " ").alias("rest"))
    cut = cut.join(total.withColumnsRenamed({"part": "first", "total": "l"}), ["lang", "first"]) \
             .join(total.withColumnsRenamed({"part": "rest", "total": "r"}), ["lang", "rest"]) \
             .withColumn("score", F.expr(f"(CAST(a AS DECIMAL(20, 0)) * {SCORE}) DIV (CAST(l AS DECIMAL(20, 0)) + CAST(r AS DECIMAL(20, 0)))"))
    return (cut.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("score", "cut", "l", "r")).alias("low"))
            .select("lang", "phrase", "a", "low.l", "low.r", "low.score"))


def subsumption(cells: DataFrame) -> DataFrame:
    """(lang, phrase, longest): the most frequent candidate one word longer
    that has the phrase in it. (One two words longer is no more frequent.)"""
    longer = cells.where("k >= 2")
    tail = F.concat_ws(" ", F.expr("substring_index(prefix, ' ', 1 - k)"), "next")
    return (longer.select("lang", F.col("prefix").alias("phrase"), "f").union(longer.select("lang", tail.alias("phrase"), "f"))
            .groupBy("lang", "phrase").agg(F.max("f").alias("longest")))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, held: int = HELD, bitmap: int = BITMAP) -> DataFrame:
    """The ``top`` collocations of every language: ``lang, rank, phrase, a, l,
    r, n, score``.

    NULL and empty texts have no words; a NULL lang is ``und``, together with
    rows that say so. Repeated rows (also of one doc_id) count each time, very
    long texts are read whole. Equal scores are ranked by frequency, then by
    the phrase's bytes, so no two rows tie. Extra columns are not read. An
    empty table, or one without a frequent phrase, gives no rows.
    """
    cells, n = all_stripes(docs, least, held, bitmap)
    kept = scored(cells).join(subsumption(cells), ["lang", "phrase"], "left") \
                        .where(F.col("longest").isNull() | (_exact(F.col("longest")) * 100 < _exact(F.col("a")) * SUBSUMED))
    kept = stored(kept.drop("longest"), "collocations")
    # a histogram of scores says how low the first ``top`` can reach: only these rows are ranked
    bin_ = F.floor(F.col("score") / BINS)
    above = Window.partitionBy("lang").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    floor = (kept.groupBy("lang", bin_.alias("bin")).agg(F.count(F.lit(1)).alias("c"))
             .withColumn("above", F.coalesce(F.sum("c").over(above), F.lit(0))).where(F.col("above") < top)
             .groupBy("lang").agg(F.min("bin").alias("floor")))
    place = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (kept.join(floor, "lang").where(bin_ >= F.col("floor")).withColumn("rank", F.row_number().over(place))
              .where(F.col("rank") <= top).join(n, "lang"))
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12(spark, sf_dir):
    return collocations(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
w AS (SELECT lang, ws, len(ws) AS m FROM (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p)),
k AS (SELECT unnest([1, 2, 3, 4]) AS k),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, k, ws, unnest(range(1, m - k + 2)) AS i FROM w, k WHERE m >= k) GROUP BY ALL),
n AS (SELECT lang, CAST(sum(m) AS BIGINT) AS n FROM w GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM g WHERE k >= 2 AND f >= 30),
cuts AS (
  SELECT lang, k, phrase, a, cut, array_to_string(ws[1:cut], ' ') AS first, array_to_string(ws[cut + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS cut FROM c)),
s AS (
  SELECT t.lang, t.phrase, t.a, t.cut, x.f AS l, y.f AS r, CAST((2000000::HUGEINT * t.a) // (x.f + y.f) AS BIGINT) AS score
  FROM cuts t JOIN g x ON x.lang = t.lang AND x.k = t.cut AND x.phrase = t.first
              JOIN g y ON y.lang = t.lang AND y.k = t.k - t.cut AND y.phrase = t.rest),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
longer AS (
  SELECT DISTINCT lang, array_to_string(ws[i:i + j - 1], ' ') AS phrase, a
  FROM (SELECT lang, k, ws, a, j, unnest(range(1, k - j + 2)) AS i FROM c, (SELECT unnest([2, 3]) AS j) WHERE j < k)),
gone AS (SELECT low.lang, low.phrase FROM low JOIN longer USING (lang, phrase) WHERE 100 * longer.a >= 80 * low.a),
kept AS (SELECT * FROM low ANTI JOIN gone USING (lang, phrase))
SELECT * FROM (
  SELECT kept.lang, row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank,
         phrase, a, l, r, n, score
  FROM kept JOIN n ON n.lang = kept.lang) WHERE rank <= 2000
"""
