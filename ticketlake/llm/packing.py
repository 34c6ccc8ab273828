"""Best-fit packing of tokenized documents by linear grouping.

Documents become pieces of at most ``capacity`` tokens. The plan is made from
the histogram of piece lengths, which has ``capacity`` bars however many
documents there are:

1. Large lengths (over capacity / SMALL) are cut into groups of about equal
   cardinality and rounded up to their group's largest length.
2. For these few sizes the best mix of configurations (multisets of sizes that
   fit a sequence, less some slack for small pieces) is found by linear
   programming with column generation; whole multiples are used, the remainder
   is packed largest first.
3. Every group's actual pieces are numbered and take the group's slots.
4. What a sequence then has left is known exactly; the histogram of these rests
   is filled with the small lengths, largest first, always into the smallest
   rest that fits. New sequences are opened for what fits nowhere.

Only the two histograms reach the driver. Pieces are numbered in hash buckets
(see ``sharding.numbered``), looked up in the plan's ranges, and placed.
"""

from __future__ import annotations

import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import doc_bytes, remembers, stored, table, works_for
from .sharding import numbered

CAPACITY, END_ID = 4096, 1
#: A length is small up to capacity / SMALL; groups of large lengths;
#: configurations of large lengths leave capacity / SLACK for small ones, or
#: less where there are few small ones.
SMALL, GROUPS, SLACK = 4, 40, 10
#: Words whose ids a worker remembers in each of two generations: when the
#: younger is full, the words that were not used since it began are forgotten.
CACHE_WORDS = 600_000

PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

_TOKENIZERS: dict[str, tuple] = {}


def word_ids(path: str):
    """(tokenizer, [ids of the words used lately, of those before], which ids
    end a word), once per worker and file. The tokenizer drops white space and joins nothing across
    it, so a text's ids are the ids of its words one after the other."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        vocabulary = tokenizer.get_vocab()
        last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        last[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        _TOKENIZERS[path] = (tokenizer, [{}, {}], last)
    return _TOKENIZERS[path]


def forget_words() -> None:
    """The tokenizers stay, the words that they were asked for go."""
    for _, generations, _ in _TOKENIZERS.values():
        generations[:] = {}, {}


remembers("packing", forget_words)

#: Words encoded as one text.
WORDS_AT_ONCE = 2000
_POINT = re.compile(rb"([a-z])([,.])(?=[ \n])")


def split_words(b: bytes) -> list[bytes]:
    """Pieces of a text whose ids, one after the other, are the text's: the
    tokenizer lower-cases, drops white space, and parts a letter from the point
    or comma after it."""
    return _POINT.sub(rb"\1 \2", b.lower()).split()


def _one_by_one(tokenizer, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    for w, e in zip(words, tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False), strict=True):
        yield w, np.array(e.ids, dtype="<u4").tobytes()


def _encode_words(tokenizer, last: np.ndarray, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(word, its ids as little-endian 32-bit numbers). Words of letters only
    are encoded many at a time: each ends at the only one of its ids that ends a
    word. Other words are encoded one by one."""
    letters, others = [], []
    for w in words:
        t = w.decode("utf-8", "replace")
        (letters if t.isalpha() and t.lower().isalpha() else others).append(w)
    yield from _one_by_one(tokenizer, others)
    parts = [letters[i:i + WORDS_AT_ONCE] for i in range(0, len(letters), WORDS_AT_ONCE)]
    texts = [b" ".join(part).decode("utf-8", "replace") for part in parts]
    for part, e in zip(parts, tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
        ids = np.array(e.ids, dtype="<u4")
        ends = (np.flatnonzero(last[ids]) + 1).tolist()
        if len(ends) != len(part) or ends[-1] != len(ids):
            yield from _one_by_one(tokenizer, part)
            continue
        raw, at = ids.tobytes(), 0
        for w, end in zip(part, ends, strict=True):
            yield w, raw[4 * at:4 * end]
            at = end


def encode(texts: list[bytes], path: str, end_id: int = END_ID) -> list[bytes]:
    """For each text its ids and the end id as little-endian 32-bit numbers."""
    tokenizer, generations, last = word_ids(path)
    if len(generations[0]) > CACHE_WORDS:
        generations[:] = {}, generations[0]
    known, before = generations
    split = [split_words(b) for b in texts]
    # words are looked up one by one: set operations with a dict would walk through all it holds
    new = [w for w in set().union(*split) if w not in known]
    known.update((w, before[w]) for w in new if w in before)
    known.update(_encode_words(tokenizer, last, [w for w in new if w not in before]))
    end = np.array([end_id], dtype="<u4").tobytes()
    return [b"".join(map(known.__getitem__, words)) + end for words in split]


def cut_pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """PIECE_SCHEMA: each document's ids cut into pieces of ``capacity``."""
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    step = capacity * 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("packing")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                out: list[list] = [[] for _ in names]
                for doc_id, ids in zip(part.column(0).to_pylist(), encode(part.column(1).to_pylist(), path), strict=True):
                    view = memoryview(ids)
                    for k, i in enumerate(range(0, len(ids), step)):
                        own = view[i:i + step]
                        for col, v in zip(out, (doc_id, k, i // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                            col.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names=names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), doc_bytes().alias("b")).mapInArrow(run, PIECE_SCHEMA)


def group_lengths(counts: dict[int, int], groups: int = GROUPS) -> dict[int, list[int]]:
    """Rounded length -> the lengths rounded up to it: neighbours, in groups of
    about equal cardinality, never more than ``groups`` of them."""
    lengths = sorted(counts, reverse=True)
    total, per, out = sum(counts.values()), 0, {}
    per = max(1, -(-total // groups))
    top, have = None, 0
    for n in lengths:
        if top is None or have >= per:
            top, have = n, 0
            out[top] = []
        out[top].append(n)
        have += counts[n]
    return out


def _best_configuration(sizes: np.ndarray, values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """The most valuable multiset of ``sizes`` within ``capacity``."""
    most = capacity // int(sizes.min())
    best = np.zeros(capacity + 1)
    took = []
    for _ in range(most):
        new, arg = best.copy(), np.full(capacity + 1, -1)
        for g, (s, v) in enumerate(zip(sizes, values, strict=True)):
            if v > 0:
                c = best[:capacity + 1 - s] + v
                better = c > new[s:] + 1e-12
                new[s:][better] = c[better]
                arg[s:][better] = g
        took.append(arg)
        best = new
    out, c = np.zeros(len(sizes), dtype=np.int64), capacity
    for arg in reversed(took):
        if arg[c] >= 0:
            out[arg[c]] += 1
            c -= int(sizes[arg[c]])
    return float(values @ out), out


def configurations(counts: dict[int, int], capacity: int, rounds: int = 400) -> list[tuple[dict[int, int], int]]:
    """[(size -> slots in a sequence, sequences)] with a slot for each of
    ``counts``; a size over ``capacity`` gets a sequence of its own. Linear
    program over configurations, columns generated by knapsack; its whole
    parts are used and the rest goes largest first."""
    alone = [({s: 1}, n) for s, n in counts.items() if s > capacity]
    counts = {s: n for s, n in counts.items() if s <= capacity}
    return alone + _shared_configurations(counts, capacity, rounds)


def _shared_configurations(counts: dict[int, int], capacity: int, rounds: int) -> list[tuple[dict[int, int], int]]:
    if not counts:
        return []
    sizes = np.array(sorted(counts, reverse=True), dtype=np.int64)
    need = np.array([counts[int(s)] for s in sizes], dtype=float)
    basis = np.diag((capacity // sizes).astype(float))
    amount = need / np.diag(basis)
    for _ in range(rounds):
        prices = np.linalg.solve(basis.T, np.ones(len(sizes)))
        worth, column = _best_configuration(sizes, prices, capacity)
        if worth <= 1 + 1e-7:
            break
        move = np.linalg.solve(basis, column.astype(float))
        ratio = np.where(move > 1e-9, amount / np.where(move > 1e-9, move, 1), np.inf)
        leave = int(ratio.argmin())
        t = ratio[leave]
        amount = np.maximum(amount - t * move, 0)
        amount[leave] = t
        basis[:, leave] = column
    used: dict[tuple, int] = defaultdict(int)
    left = need.astype(np.int64)
    for j in np.argsort(-amount):
        column = np.rint(basis[:, j]).astype(np.int64)
        in_column = column > 0
        times = min(int(amount[j] + 1e-9), int((left[in_column] // column[in_column]).min()))
        if times > 0:
            used[tuple(column)] += times
            left -= times * column
    while left.any():                      # each turn uses up a size, or all of it that pairs up
        column, room = np.zeros_like(left), capacity
        for g, s in enumerate(sizes):
            k = min(int(left[g]), room // int(s))
            column[g], room = k, room - k * int(s)
        in_column = column > 0
        times = int((left[in_column] // column[in_column]).min())
        used[tuple(column)] += times
        left -= times * column
    return [({int(s): int(k) for s, k in zip(sizes, c, strict=True) if k}, n) for c, n in used.items()]


def plan_slots(counts: dict[int, int], capacity: int, groups: int = GROUPS, slack: int = 0):
    """(length -> rounded length, {rounded length: [(first rank, slots in a
    sequence, first sequence)]}, sequences). Configurations leave ``slack``."""
    grouped = group_lengths(counts, groups)
    rounded = {n: top for top, own in grouped.items() for n in own}
    slots: dict[int, list] = defaultdict(list)
    taken: dict[int, int] = defaultdict(int)
    sequences = 0
    for column, times in configurations({t: sum(counts[n] for n in own) for t, own in grouped.items()}, capacity - slack):
        for s, k in column.items():
            slots[s].append((taken[s], k, sequences))
            taken[s] += k * times
        sequences += times
    return rounded, dict(slots), sequences


def plan_small(small: dict[int, int], rests: dict[int, int], capacity: int):
    """Fills rests with small lengths, largest first, into the smallest rest
    that fits. Returns ({length: [(first rank, pieces in a sequence, rest,
    first rank of the rest)]}, opened): rest ``capacity`` counts the opened
    sequences. Sequences with equal history stay one segment, so the plan has
    about one entry for each bar of the two histograms."""
    open_: dict[int, list[tuple[int, int, int]]] = defaultdict(list)    # rest now -> (rest at first, rank, sequences)
    for rest, n in rests.items():
        if rest > 0:
            open_[rest].append((rest, 0, n))
    out: dict[int, list] = defaultdict(list)
    opened = 0
    for s in sorted(small, reverse=True):
        rank, todo = 0, small[s]
        for rest in sorted(r for r in open_ if r >= s):
            while todo and open_[rest]:
                origin, first, n = open_[rest].pop()
                k = min(rest // s, todo)
                use = min(n, todo // k)
                out[s].append((rank, k, origin, first))
                open_[rest - k * s].append((origin, first, use))
                if use < n:
                    open_[rest].append((origin, first + use, n - use))
                rank, todo = rank + use * k, todo - use * k
            if not todo:
                break
        while todo:
            k = min(capacity // s, todo)
            use = todo // k
            out[s].append((rank, k, capacity, opened))
            open_[capacity - k * s].append((capacity, opened, use))
            opened, rank, todo = opened + use, rank + use * k, todo - use * k
    return dict(out), opened


def _lookup(rows: DataFrame, key: str, plan: dict[int, list], names: list[str]) -> DataFrame:
    """``rows`` (with ``key`` and ``slot``) and the plan's entry for them:
    entries are (first rank, pieces in a sequence, *rest); ``names`` get the
    rest, whose last number counts on by one for each full sequence."""
    sent = rows.sparkSession.sparkContext.broadcast({k: np.array(sorted(v), dtype=np.int64) for k, v in plan.items()})
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + "".join(f", {n} long" for n in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        works_for("packing")
        for batch in batches:
            size = batch.column(key).to_numpy(zero_copy_only=False)
            rank = batch.column("slot").to_numpy(zero_copy_only=False)
            out = np.zeros((len(names), len(size)), dtype=np.int64)
            for s in np.unique(size):
                mine, entries = np.flatnonzero(size == s), sent.value[int(s)]
                e = entries[np.searchsorted(entries[:, 0], rank[mine], side="right") - 1]
                out[:, mine] = e[:, 2:].T
                out[-1, mine] += (rank[mine] - e[:, 0]) // e[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, out)], names=[*batch.schema.names, *names])

    return rows.mapInArrow(run, schema)


def _histogram(rows: DataFrame, column: str) -> dict[int, int]:
    """At most ``capacity`` + 1 bars."""
    return {int(r[0]): int(r[1]) for r in rows.groupBy(column).agg(F.count(F.lit(1))).collect()}


def pack_pieces(pieces: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """``pieces`` (PIECE_SCHEMA, stored) with ``sequence_id`` and ``offset``."""
    spark, by = pieces.sparkSession, ["doc_id", "piece", "start", "length", "ids_crc32"]
    counts = _histogram(pieces, "length")
    limit = capacity // SMALL
    small = {n: c for n, c in counts.items() if n <= limit}
    tokens = lambda h: sum(n * c for n, c in h.items())
    slack = min(capacity // SLACK, capacity * tokens(small) // max(2 * tokens(counts), 1))
    rounded, slots, sequences = plan_slots({n: c for n, c in counts.items() if n > limit}, capacity, groups, slack)

    round_up = spark.createDataFrame([(n, t) for n, t in rounded.items()], "length long, size long")
    large = numbered(pieces.join(F.broadcast(round_up), "length").select(*by, "size"), "size", by)
    large = stored(_lookup(large, "size", slots, ["sequence_id"]).select(*by, "sequence_id"), "packed-large")
    rests = large.groupBy("sequence_id").agg((F.lit(capacity) - F.sum("length")).alias("rest"))
    rests = stored(numbered(rests, "rest", ["sequence_id"]), "packed-rests")
    plan, opened = plan_small(small, _histogram(rests, "rest"), capacity)

    placed = numbered(pieces.where(F.col("length") <= limit).select(*by, F.col("length").alias("size")), "size", by)
    placed = _lookup(placed, "size", plan, ["rest", "nth"]).select(*by, "rest", "nth")
    into_new = placed.where(F.col("rest") == capacity).select(*by, (F.col("nth") + sequences).alias("sequence_id"))
    into_old = (placed.where(F.col("rest") < capacity)
                .join(rests.withColumnRenamed("slot", "nth"), ["rest", "nth"]).select(*by, "sequence_id"))
    before = (Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "piece", "ids_crc32")
              .rowsBetween(Window.unboundedPreceding, -1))      # a sequence has at most ``capacity`` pieces
    return (large.unionByName(into_new).unionByName(into_old)
            .withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")))


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Every piece of every document with its place: PIECE_SCHEMA columns,
    ``sequence_id`` (any distinct numbers) and ``offset``.

    NULL and empty texts are one piece of the end id. Texts over ``capacity``
    tokens are cut, all others stay whole. Repeated rows are packed each by
    themselves; a NULL doc_id stays NULL. Extra columns are not read. An empty
    table gives no rows.
    """
    pieces = stored(cut_pieces(docs, path or public_tokenizers.path("word_bpe_49k.json"), capacity), "pieces")
    return pack_pieces(pieces, capacity)


def op6(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"))
