"""Repeated passages by sparse suffix arrays.

A suffix is kept where the text itself selects it: at positions whose word
k-gram has the smallest hash of some window of LENGTH words (minimisers).
Whatever LENGTH words two documents share, both select the same suffix inside
them, at about one word in twenty.

Only suffixes whose k-gram occurs in two documents or more are looked at. They
carry their context, LENGTH words to the right and what can precede to the
left. Equal contexts are one entry before anything is sorted. Entries are sorted
by what follows and, once more, by what precedes; comparing neighbours gives
the lengths of the common right and left extensions. Two suffixes match in a
window that begins ``a`` words before them if they lie in one stretch of right
extensions of at least LENGTH - a words and in one stretch of left extensions
of at least ``a`` words. Tested for every ``a``, this finds every repeated
window, not only those with the direct neighbour; longer passages are their
union.

Entries meet by k-gram. Where a k-gram has more entries than RANGE, they meet
by more of their context instead: the windows are halved by where they begin,
and a half that begins ``lo`` to ``hi`` words before the suffix lies in the
``lo`` words before it and the ``length - hi`` behind, which must be equal. An
entry goes on once for either half; groups that fit are sorted and compared as
ever, those that do not are halved again. At a single beginning the equal
context is the whole window, and what is left is a count.

Suffixes are stored with the digests of their contexts, contexts once for many
suffixes.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import doc_bytes, stored, table
from .ngram_join import _HASHES

#: Words of a passage, words of a k-gram, entries that meet in one task (a
#: context has about 400 bytes).
LENGTH, GRAM, RANGE = 50, 8, 1 << 15
#: Bits of the set of shared k-grams that workers hold (a superset).
BITMAP = 26


def word_hashes(b: bytes) -> np.ndarray:
    w = b.lower().split()
    return np.fromiter(map(_HASHES.__getitem__, w), dtype=np.uint64, count=len(w))


def grams(h: np.ndarray, k: int = GRAM) -> np.ndarray:
    """Hashes of all k-grams of a text of word hashes."""
    n = len(h) - k + 1
    z = np.zeros(max(n, 0), dtype=np.uint64)
    for i in range(k if n > 0 else 0):
        z = (z * np.uint64(0x9E3779B97F4A7C15)) ^ h[i:i + n]
        z *= np.uint64(0xFF51AFD7ED558CCD)
        z ^= z >> np.uint64(31)
    return z


def _sliding(x: np.ndarray, w: int, least) -> np.ndarray:
    """Least (or greatest) of every ``w`` neighbours, by doubling."""
    have = 1
    while have * 2 <= w:
        x = least(x[:-have], x[have:])
        have *= 2
    return least(x[:len(x) - (w - have)], x[w - have:]) if w > have else x


def minimisers(g: np.ndarray, length: int = LENGTH, k: int = GRAM) -> np.ndarray:
    """Positions of k-grams that are the smallest of some passage window."""
    w = length - k + 1
    if len(g) < w:
        return np.zeros(0, np.int64)
    low = _sliding(g, w, np.minimum)                           # of the window that begins here
    pad = np.zeros(w - 1, np.uint64)
    return np.flatnonzero(_sliding(np.concatenate([pad, low, pad]), w, np.maximum) == g)


def _place(h: np.ndarray) -> np.ndarray:
    return h & np.uint64((1 << BITMAP) - 1)


def shared_grams(docs: DataFrame, length: int) -> np.ndarray:
    """Bits of the selected k-grams that two rows or more select: 8 MB."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = []
            for x in batch.column(0):
                g = grams(word_hashes(x.as_py()))
                own.append(np.unique(g[minimisers(g, length)]))
            flat = np.concatenate([*own, np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["g"])

    found = docs.select(doc_bytes().alias("b")).mapInArrow(run, "g long").groupBy("g").agg(F.count(F.lit(1)).alias("c")).where("c > 1")
    # 64 bits to a row: as many rows as the bitmap has words, whatever the input, and no Python object for any of them
    p = F.col("g").bitwiseAND((1 << BITMAP) - 1)
    words = (found.select(F.shiftright(p, 6).alias("w"), F.expr("shiftleft(1L, CAST(g & 63 AS INT))").alias("bit"))
             .groupBy("w").agg(F.bit_or("bit").alias("bits")).toArrow())
    out = np.zeros(1 << (BITMAP - 6), dtype="<i8")
    out[words.column("w").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint8)


def _selected(h: np.ndarray, bits: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(k-grams, positions) of the suffixes of a text that are looked at."""
    g = grams(h)
    at = minimisers(g, length)
    if len(at):
        p = _place(g[at])
        at = at[(bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1]
    return g[at], at


def _contexts(h: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The words after (``length``) and before (``length - GRAM``) every
    position, as 32-bit hashes, nearest first on both sides, padded."""
    before = length - GRAM
    short = np.concatenate([np.zeros(before, np.uint32), (h >> np.uint64(32)).astype(np.uint32) | np.uint32(1), np.zeros(length, np.uint32)])
    right = short[(at + before)[:, None] + np.arange(length)]
    left = short[(at + before)[:, None] - 1 - np.arange(before)]
    return np.concatenate([right, left], axis=1)


def suffixes(docs: DataFrame, bits: np.ndarray, length: int) -> DataFrame:
    """Two kinds of rows from one pass. For each row of ``docs``: ``row,
    doc_id, n_words`` and ``kept``, position and entry (digest of the context)
    of every suffix. For each entry, once in some thousand: ``entry, g,
    context``. The columns of the other kind are NULL."""
    sent = docs.sparkSession.sparkContext.broadcast(bits)
    item = pa.struct([("pos", pa.int32()), ("entry", pa.binary())])
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("kept", pa.list_(item)),
                        ("entry", pa.binary()), ("g", pa.int64()), ("context", pa.binary())])

    def of(*columns) -> pa.RecordBatch:
        size = max(len(c) for c in columns if c is not None)
        return pa.RecordBatch.from_arrays([pa.nulls(size, f.type) if c is None else pa.array(c, f.type)
                                           for c, f in zip(columns, schema, strict=True)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, seen = TaskContext.get().partitionId() << 40, {}
        for batch in (b.slice(i, 256) for b in batches for i in range(0, b.num_rows, 256)):
            rows, words, kept = [], [], []
            for x in batch.column(1):
                h = word_hashes(x.as_py())
                g, at = _selected(h, sent.value, length)
                own = []
                for k, i, c in zip(g.view(np.int64).tolist(), at.tolist(), _contexts(h, at, length) if len(at) else (), strict=True):
                    c = c.tobytes()
                    entry = xxhash.xxh3_128_digest(c)
                    own.append({"pos": i, "entry": entry})
                    if entry not in seen:
                        seen[entry] = (k, c)
                rows.append(row), words.append(len(h)), kept.append(own)
                row += 1
            yield of(rows, batch.column(0).to_pylist(), words, kept, None, None, None)
            if len(seen) >= 20_000:
                yield of(None, None, None, None, list(seen), [k for k, _ in seen.values()], [c for _, c in seen.values()])
                seen = {}
        if seen:
            yield of(None, None, None, None, list(seen), [k for k, _ in seen.values()], [c for _, c in seen.values()])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(
        run, "row long, doc_id long, n_words long, kept array<struct<pos: int, entry: binary>>, entry binary, g long, context binary")


def _stretches(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows of ``x``, common words of neighbours in that order)."""
    order = np.argsort(np.ascontiguousarray(x.astype(">u4")).view(f"V{4 * x.shape[1]}").ravel(), kind="stable")
    y = x[order]
    differ = y[1:] != y[:-1]
    common = np.where(differ.any(axis=1), differ.argmax(axis=1), x.shape[1])
    return order, common


def repeated_windows(context: np.ndarray, low: np.ndarray, high: np.ndarray, lo: np.ndarray, hi: np.ndarray, length: int):
    """For entries (context, smallest and largest row that has them): (bit
    ``a`` set if the window that begins ``a`` words before the suffix occurs in
    two rows, smallest row of these windows). Only beginnings from ``lo`` to
    ``hi`` are looked at."""
    n = len(context)
    after, before = (context[:, :length] != 0).sum(axis=1), (context[:, length:] != 0).sum(axis=1)
    mask, first = np.zeros(n, np.int64), np.full(n, np.iinfo(np.int64).max)
    order_r, common_r = _stretches(context[:, :length])
    order_l, common_l = _stretches(context[:, length:])
    for a in range(int(lo.min()), int(hi.max()) + 1) if n else ():
        ok = np.flatnonzero((before >= a) & (after >= length - a) & (lo <= a) & (a <= hi))
        if not len(ok):
            continue
        label_r, label_l = np.empty(n, np.int64), np.empty(n, np.int64)
        label_r[order_r] = np.concatenate([[0], np.cumsum(common_r < length - a)])
        label_l[order_l] = np.concatenate([[0], np.cumsum(common_l < a)])
        key = label_r[ok] * n + label_l[ok]
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        least = np.minimum.reduceat(low[ok][order], starts)
        most = np.maximum.reduceat(high[ok][order], starts)
        size = np.diff(np.append(starts, len(order)))
        twice = np.repeat(least < most, size)
        hit = ok[order][twice]
        mask[hit] |= 1 << a
        first[hit] = np.minimum(first[hit], np.repeat(least, size)[twice])
    return mask, first


_ENTRY = "entry binary, mask long, first long"


def _sorted_matches(entries: DataFrame, length: int) -> DataFrame:
    """``entry, mask, first`` of entries that meet by ``key`` in tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush(t: pa.Table) -> pa.RecordBatch:
            col = lambda k: t.column(k).to_numpy()
            context = np.frombuffer(b"".join(t.column("context").to_pylist()), np.uint32).reshape(t.num_rows, -1)
            mask, first = repeated_windows(context, col("low"), col("high"), col("lo"), col("hi"), length)
            at = np.flatnonzero(mask)
            return pa.RecordBatch.from_arrays([t.column("entry").combine_chunks().take(pa.array(at)), pa.array(mask[at]), pa.array(first[at])],
                                              names=["entry", "mask", "first"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 20_000:
                continue
            t = pa.Table.from_batches(held)
            key = t.column("key").to_pylist()
            cut = bisect_left(key, key[-1])                            # the last group may go on
            held = t.slice(cut).to_batches()
            if cut:
                yield flush(t.slice(0, cut))
        if held:
            yield flush(pa.Table.from_batches(held))

    return entries.select("entry", "key", "context", "low", "high", "lo", "hi").repartition("key").sortWithinPartitions("key").mapInArrow(run, _ENTRY)


def _halved(entries: DataFrame, length: int) -> DataFrame:
    """Entries once for either half of their beginnings, with the key that the
    half's windows must share; only where the context reaches that far."""
    mid = F.shiftright(F.col("lo") + F.col("hi"), 1)
    half = F.explode(F.array(F.struct(F.col("lo").alias("lo"), mid.alias("hi")), F.struct((mid + 1).alias("lo"), F.col("hi").alias("hi"))))
    out = entries.withColumn("half", half).drop("lo", "hi", "key").select("*", "half.lo", "half.hi").drop("half")
    right = F.substring("context", F.lit(1), 4 * (length - F.col("hi")))
    left = F.substring("context", F.lit(4 * length + 1), 4 * F.col("lo"))
    # the last word of either part is there: contexts are padded with zeros behind the text's ends
    there = lambda part: (F.length(part) == 0) | (F.hex(F.substring(part, F.length(part) - 3, F.lit(4))) != "00000000")
    key = F.md5(F.concat(F.col("lo").cast("string").cast("binary"), right, F.lit("/").cast("binary"), left))
    return out.where(there(right) & there(left)).withColumn("key", key)


def _equal_windows(entries: DataFrame) -> DataFrame:
    """Entries whose key is one whole window: those of windows in two rows."""
    twice = entries.groupBy("key").agg(F.min("low").alias("first"), F.max("high").alias("last")).where("first < last").select("key", "first")
    return entries.join(twice, "key").select("entry", F.expr("shiftleft(1L, lo)").alias("mask"), "first")


def matches(entries: DataFrame, length: int, range_size: int = RANGE) -> DataFrame:
    """``entry, mask, first`` of all entries (entry, g, context, low, high)
    with repeated windows; an entry may have several rows."""
    todo = entries.select("entry", "context", "low", "high", F.lit(0).alias("lo"), F.lit(length - GRAM).alias("hi"),
                          F.col("g").cast("string").alias("key"))
    found = []
    while True:
        many = stored(todo.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > range_size).select("key"), "hot-keys")
        if many.isEmpty():
            found.append(_sorted_matches(todo, length))
            break
        found.append(_sorted_matches(todo.join(many, "key", "left_anti"), length))
        todo = stored(_halved(todo.join(many, "key", "left_semi"), length), "hot-entries")
        found.append(_equal_windows(todo.where("lo = hi")))
        todo = todo.where("lo < hi")
    return reduce(DataFrame.unionByName, found)


def repeated_passages(docs: DataFrame, length: int = LENGTH, range_size: int = RANGE) -> DataFrame:
    """Every row of ``docs``: ``doc_id, n_words, n_repeat_words, spans``
    (start, end of the stretches, in words, whose every word is in a passage of
    ``length`` words that another row has too) and ``first_doc_ids`` (of the
    first rows that have the passages).

    Words are compared after lower-casing A-Z. NULL and empty texts and texts
    under ``length`` words have no passages. Repeated rows (also of one doc_id)
    are different rows, so their words repeat. A passage that repeats only
    inside one row does not count. Texts are read whole; a very long text's
    suffixes are one row of the suffixes' table (20 bytes a suffix, about one
    in twenty words). Rows that tie as the first of a passage are all named.
    Extra columns are not read; an empty table gives no rows.
    """
    docs = docs.select("doc_id", "text")
    both = stored(suffixes(docs, shared_grams(docs, length), length), "suffixes")
    rows = both.where("row IS NOT NULL").select("row", "doc_id", "n_words", "kept")
    each = rows.select("row", F.explode("kept").alias("s")).select("row", "s.*")
    held = each.groupBy("entry").agg(F.min("row").alias("low"), F.max("row").alias("high"))
    once = both.where("entry IS NOT NULL").groupBy("entry").agg(F.first("g").alias("g"), F.first("context").alias("context"))
    entries = stored(once.join(held, "entry"), "suffix-entries")
    found = matches(entries, length, range_size).groupBy("entry").agg(F.bit_or("mask").alias("mask"), F.min("first").alias("first"))
    hits = each.join(found, "entry").groupBy("row").agg(
        F.collect_list(F.struct("pos", "mask")).alias("hits"), F.collect_set("first").alias("firsts"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans, words = [], []
            for i in range(batch.num_rows):
                starts = sorted({h["pos"] - a for h in batch.column(1)[i].as_py() for a in range(length - GRAM + 1) if h["mask"] >> a & 1})
                own: list[list[int]] = []
                for s in starts:
                    if own and s <= own[-1][1]:
                        own[-1][1] = s + length
                    else:
                        own.append([s, s + length])
                spans.append([{"start": s, "end": e} for s, e in own])
                words.append(sum(e - s for s, e in own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                 batch.column(2)], names=["row", "n_repeat_words", "spans", "firsts"])

    merged = stored(hits.select("row", "hits", "firsts").mapInArrow(
        merge, "row long, n_repeat_words long, spans array<struct<start: int, end: int>>, firsts array<long>"), "passages")
    names = rows.select("row", "doc_id")
    first = (merged.select("row", F.explode("firsts").alias("f")).join(names.withColumnsRenamed({"row": "f", "doc_id": "first_doc"}), "f")
             .groupBy("row").agg(F.array_sort(F.collect_set("first_doc")).alias("first_doc_ids")))
    return (rows.select("row", "doc_id", "n_words").join(merged.drop("firsts"), "row", "left").join(first, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_repeat_words", F.lit(0).cast("long")).alias("n_repeat_words"),
                    F.coalesce("spans", F.array().cast("array<struct<start: int, end: int>>")).alias("spans"),
                    F.coalesce("first_doc_ids", F.array().cast("array<long>")).alias("first_doc_ids")))


def op10(spark, sf_dir):
    return repeated_passages(table(spark, sf_dir, "documents"))
